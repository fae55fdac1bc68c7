"""The training-data operators beside brute force, and on awkward rows: nulls, empty and long texts, ties, repeats, no rows, clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, t string, n string, node string, key string, line string, token string"


def words(n, seed, vocabulary=300):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def texts():
    base = [words(80, i) for i in range(6)]
    near = base[0].split(" ")
    near[40] = "other"
    long = words(30_000, 99, 5000)
    return [base[0], base[0], " ".join(near), base[1].upper(), base[1], base[2] + "\n" + base[3], base[3], "", None, "one two", "one two", "One two", " \n\t ", "a", long, long + " end", "Ünïcode ☃ 日本語 " * 20, "x" * 5000, "a b c d " * 200, "a <|endoftext|> b<|endoftext|>", "<|endoftext|>"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], "s", None if t is None else len(t)) + ("1",) * 7 for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def null_ids(spark):
    return spark.createDataFrame([(None, words(60, 1)), (None, words(60, 1)), (3, words(60, 1)), (3, words(60, 1)), (None, None)], "doc_id long, text string").withColumns({"lang": F.lit(None).cast("string")})


def brute_components(rows, n, num, den):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        sets[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if j < i and both and den * both >= num * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize(("n", "threshold"), [(4, (85, 100)), (5, (4, 5))])
def test_ngram_join(docs, n, threshold):
    from panelspark.llm.ngram_join import jaccard_components

    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs, n=n, threshold=threshold).collect()}
    assert got == brute_components(list(enumerate(texts())), n, *threshold)


def test_ngram_join_finds_chains_inside_one_list(spark):
    """Near copies that link only through one another, with a part that all share, and none lost."""
    from panelspark.llm.ngram_join import jaccard_components, keep_one

    r, rows = random.Random(5), []
    for g in range(4):
        now = words(60, 1000 + g).split(" ")
        for _ in range(15):
            rows.append(" ".join(now))
            now = list(now)
            now[r.randrange(60)] = f"n{len(rows)}"
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows, 4, 80, 100)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_components(df, n=4, threshold=(80, 100)).collect()} == want
    assert {x.doc_id for x in keep_one(df, n=4, threshold=(80, 100)).collect()} == {i for i, (_, c) in want.items() if c == i}


def test_ngram_join_awkward(empty, null_ids):
    from panelspark.llm.ngram_join import jaccard_components

    assert jaccard_components(empty).count() == 0
    got = sorted(((r.doc_id, r.component_id) for r in jaccard_components(null_ids).collect()), key=str)
    assert got == [(3, 3), (3, 3), (None, 3), (None, 3), (None, None)]


def test_packing(docs, empty, null_ids):
    import public_tokenizers
    import tokenizers

    from panelspark.llm.packing import pack

    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: [*t.encode(x or "", add_special_tokens=False).ids, 0] for i, x in enumerate(texts())}
    pieces = pack(docs).collect()
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append((p.start, np.frombuffer(p.ids, "<u4").tolist(), p.length, p.doc_tokens))
        by_seq[p.sequence_id].append((p.offset, p.length))
    for i, ids in want.items():
        parts = sorted(by_doc[i])
        assert sum((x for _, x, _, _ in parts), []) == ids
        assert [s for s, *_ in parts] == list(np.cumsum([0, *[n for _, _, n, _ in parts]])[:-1]) and {d for *_, d in parts} == {len(ids)}
    short = 0
    for parts in by_seq.values():
        parts.sort()
        assert [o for o, _ in parts] == list(np.cumsum([0, *[n for _, n in parts]])[:-1])
        total = sum(n for _, n in parts)
        assert total <= 1024
        short += total < 1024
    assert short <= docs.rdd.getNumPartitions()
    assert pack(empty).count() == 0
    assert pack(null_ids).where("start = 0").count() == 5


def test_least_squares_choice():
    from panelspark.llm.packing import LevelArray

    r, levels = random.Random(1), LevelArray(32)
    for _ in range(2000):
        size = r.randrange(1, 32)
        n = levels.count.copy()
        options = [0] + [h for h in range(1, 33 - size) if n[h]]

        def total(h):
            m = n.copy()
            if h:
                m[h] -= 1
            if h + size < 32:
                m[h + size] += 1
            return int((m[1:32] ** 2).sum())

        level, window = levels.place(size)
        assert total(level) == min(map(total, options))
        assert sum(window) == level
        window.append(size)
        if level + size < 32:
            levels.put(level + size, window)


def test_bpe_chunks():
    import public_tokenizers
    import tokenizers

    from panelspark.llm.bpe import ChunkTable

    t, table, r = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), ChunkTable(), random.Random(2)
    parts = [" ", "  ", "\n", "a", "the", "é", "日本", "\t", "😀", "\r\n", "\x00", "<|endoftext|>", "​", "12", "'s", "'ll", "!!", "\x1c", "\x85", " ", "\xa0", "　", "\x0b"]
    for _ in range(3000):
        x = "".join(r.choices(parts, k=r.randrange(12)))
        assert np.frombuffer(table.ids(x), "<u4").tolist() == t.encode(x, add_special_tokens=False).ids, repr(x)


def test_sentencepiece(docs, empty):
    import public_tokenizers
    import sentencepiece

    from panelspark.llm.sentencepiece_codec import PieceTable, chunks_are_separable, decode, encode

    sp, r, table = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")), random.Random(3), PieceTable()
    assert table.separable and not chunks_are_separable(["a▁b"]) and not chunks_are_separable(["a\nb"])
    parts = [" ", "  ", "\n", "a", "the", "▁", "é", "日本", "\t", "😀", "foo", "\r", "\x00", "</s>", "<unk>", "<0x0A>", "​"]
    for _ in range(3000):
        x = "".join(r.choices(parts, k=r.randrange(12)))
        assert np.frombuffer(table.encode([x])[0], "<u4").tolist() == sp.encode(x), repr(x)
    got = {x.doc_id: (list(x.ids), x.text) for x in decode(encode(docs)).collect()}
    for i, x in enumerate(texts()):
        ids = sp.encode(x or "")
        assert got[i] == (ids, sp.decode(ids))
    assert decode(encode(empty)).count() == 0


def test_quality_rules(docs, empty, null_ids):
    from panelspark.llm.rule_cascade import BASE, RULES, first_rejection, judge, keep_good, measure, order_rules

    got = {r.doc_id: r for r in judge(docs).collect()}
    for i, x in enumerate(texts()):
        w = WORD.findall(x or "")
        windows = collections.Counter(tuple(w[j : j + 3]) for j in range(len(w) - 2))
        covered = {j + k for j in range(len(w) - 2) if windows[tuple(w[j : j + 3])] > 1 for k in range(3)}
        lines = [y for y in (x or "").split("\n") if WORD.search(y)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words, got[i].base_failed) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in x or ""), len(lines) - len(set(lines)), len(covered), failed)
        assert got[i].kept == (not failed and first_rejection(x, RULES) is None)
    kept = {r.doc_id for r in keep_good(docs).collect()}
    assert kept == {i for i, x in enumerate(texts()) if first_rejection(x, BASE + RULES) is None}
    assert keep_good(docs).columns == docs.columns
    assert judge(empty).count() == 0 and keep_good(empty).count() == 0 and judge(null_ids).count() == 5
    m = measure(docs, "doc_id", "text", RULES)
    ordered = order_rules(RULES, m)
    assert set(ordered) == set(RULES)
    import pandas as pd

    fake = pd.DataFrame({"rule": ["symbols", "capitals"], "seconds": [1.0, 1.0], "rejected": [1, 50], "seen": [100, 100]})
    assert [r.name for r in order_rules(RULES, fake)][:2] == ["capitals", "symbols"]


def test_licenses(spark, empty):
    from panelspark.llm import licenses as L

    wrap = lambda t, n: "\n".join(re.sub(rf"(.{{1,{n}}})(?: |$)", r"\1\n", p).rstrip("\n") for p in t.split("\n"))
    rows = [
        (1, "The MIT Licence (MIT)\n\nCopyright (c) 2020 Me\n\n" + L.MIT.replace(". ", ".\n")), (2, None), (3, "text\nReleased under the MIT Licence\nmore"), (4, L.BSD_3.upper()), (5, L.BSD_3 + " more"), (None, L.ISC),
        (7, "ISC License\n\nCopyright 2004-2010 by X\n\n" + wrap(L.ISC, 72)), (8, "Copyright <YEAR> <HOLDER>\n" + wrap(L.BSD_3, 60)), (9, "© Me\nAll rights reserved.\n" + wrap(L.BSD_2, 79)), (10, wrap(L.UNLICENSE, 40)), (11, "Copyright law protects this.\n" + L.MIT), (12, L.MIT + "x" * 200_000),
    ]
    rows = [(*r, "x", ["x"], "x", "x") for r in rows]
    got = {r.doc_id: (r.license, r.notices) for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string, digest string, lines array<string>, notices string, license string")).collect()}
    assert got == {1: ("MIT", ""), 2: (None, ""), 3: (None, "MIT"), 4: ("BSD-3-Clause", ""), 5: (None, ""), None: ("ISC", ""), 7: ("ISC", ""), 8: ("BSD-3-Clause", ""), 9: ("BSD-2-Clause", ""), 10: ("Unlicense", ""), 11: (None, ""), 12: (None, "")}
    assert L.scan(empty).count() == 0
    assert {r.matched: 1 for r in L.scan(spark.createDataFrame([(1, L.MIT + "\n"), (2, "x\nSPDX-License-Identifier: MIT"), (3, "x")], "doc_id long, text string")).collect()} == {"text": 1, "notice": 1, None: 1}
    assert len({L.canonical_text(t) for _, t in L.KNOWN}) == len(L.KNOWN)
    own = spark.createDataFrame([("own", "My own\nTerms!"), ("none", " - "), ("other", "my OWN terms")], "license string, text string")
    table = L.digest_table(own)
    doubled = table.unionByName(table.withColumn("license", F.lit("zz")))
    assert [(r.doc_id, r.license) for r in L.scan(spark.createDataFrame([(1, "my own terms")], "doc_id long, text string"), known=doubled).collect()] == [(1, "other")]
    assert [r.license for r in table.collect()] == ["other"]
    assert {r.doc_id: r.license for r in L.scan(spark.createDataFrame([(1, "my own terms"), (2, "-")], "doc_id long, text string"), known=table).collect()} == {1: "other", 2: None}


def test_whole_licence_files(spark):
    """The licence texts that this machine's packages come with, rewrapped and in capitals, are known by their digests."""
    from pathlib import Path

    from panelspark.llm import licenses as L

    place = Path("/usr/share/common-licenses")
    files = {"Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0"}
    if not all((place / f).exists() for f in files):
        pytest.skip("no licence files")
    rows = [(i, t, name) for i, (f, name) in enumerate(files.items()) for t in [(place / f).read_text()]]
    rows = rows + [(100 + i, "\n".join(x if "copyright" in x.lower() else x.replace(", ", ",\n") for x in t.split("\n")).upper(), name) for i, t, name in rows] + [(200 + i, t[:-40], None) for i, t, _ in rows]
    got = {r.doc_id: r.license for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string, license string")).collect()}
    assert got == {i: name for i, _, name in rows}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def mutate(x, k, r):
    x = list(x)
    for _ in range(k):
        p, o = r.randrange(len(x)), r.random()
        if o < 0.33:
            x[p] = r.choice("abcé")
        elif o < 0.66:
            x.insert(p, r.choice("abcé"))
        elif len(x) > 8:
            del x[p]
    return "".join(x)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_banded_distance(spark, k):
    from panelspark.llm.line_dedup import banded_distance

    r = random.Random(k)
    rows = [(a, mutate(a, r.randrange(6), r)) for a in ("".join(r.choices("abcé", k=r.randrange(8, 70))) for _ in range(400))]
    df = spark.createDataFrame(rows, "a string, b string").where(F.abs(F.length("a") - F.length("b")) <= k)
    df = df.withColumns({"x": F.split("a", ""), "y": F.split("b", "")})
    assert df.where(banded_distance(F.col("x"), F.col("y"), k) != F.least(F.levenshtein("a", "b"), F.lit(k + 1))).count() == 0


def near_lines(rows, threshold=2, chars=10):
    """(id, pos) of lines with an earlier equal or near line, every pair compared."""
    lines = sorted((i, p, x) for i, t in rows if i is not None for p, x in enumerate((t or "").split("\n")) if WORD.search(x))
    allowed = lambda a, b: min(threshold, min(len(a), len(b)) // chars)
    return {b[:2] for n, b in enumerate(lines) if any(a[2] == b[2] or (abs(len(a[2]) - len(b[2])) <= allowed(a[2], b[2]) and levenshtein(a[2], b[2]) <= allowed(a[2], b[2])) for a in lines[:n])}


@pytest.mark.parametrize("threshold", [1, 2])
def test_line_dedup(spark, empty, null_ids, threshold):
    from panelspark.llm.line_dedup import dedup_lines, duplicate_lines, removed_lines

    r = random.Random(7)
    pool = ["".join(r.choices("abcdé ", k=r.randrange(5, 60))) for _ in range(40)] + ["ab" * 15, "a" * 25, "a" * 24, "ab" * 16]
    rows = [(i, "\n".join(mutate(r.choice(pool), r.choice([0, 0, 1, 2, 3, 4]), r) for _ in range(r.randrange(8))), "x") for i in range(60)] + [(60, None, "x"), (61, "", "x"), (62, "\n\n", "x"), (63, " " * 30 + "\n" + " " * 30, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, line string")
    want = near_lines([x[:2] for x in rows], threshold)
    assert {tuple(x) for x in duplicate_lines(df, threshold=threshold).collect()} == want
    cleaned = {x.doc_id: x.text for x in dedup_lines(df, threshold=threshold).collect()}
    assert cleaned == {i: None if t is None else "\n".join(x for p, x in enumerate(t.split("\n")) if (i, p) not in want) for i, t, _ in rows}
    found = {x.doc_id: x for x in removed_lines(df, threshold=threshold).collect()}
    assert {(i, p) for i, x in found.items() for p in x.removed} == want and found[60].n_lines == 0 and found[61].n_lines == 1
    assert dedup_lines(empty).count() == 0 and removed_lines(empty).count() == 0
    assert dedup_lines(null_ids).count() == 5


def test_line_dedup_of_groups_and_long_lines(spark):
    """Groups of copies with one changed word, with few changed characters, and lines of thousands of characters; ties inside one document."""
    from panelspark.llm.line_dedup import removed_lines

    r = random.Random(8)
    base, long = words(30, 1).split(" "), words(90, 2, 5000)
    rows = []
    for i in range(80):
        one = list(base)
        one[r.randrange(30)] = r.choice(["", "word", "another", "w1", f"w{i}", "longerword"])
        rows.append((i, "\n".join([" ".join(one), mutate(" ".join(base), r.randrange(4), r)])))
    rows += [(100 + i, mutate(long, r.choice([0, 1, 2, 3, 4]), r)) for i in range(8)] + [(200, long + "\n" + long[:-1] + "\n" + long), (201, "x" * 400 + "\n" + "x" * 402), (202, "😀" * 30 + "\n" + "😀" * 29)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(x.doc_id, p) for x in removed_lines(df).collect() for p in x.removed} == near_lines(rows)


def test_line_dedup_takes_equal_short_lines(spark):
    from panelspark.llm.line_dedup import removed_lines

    rows = [(0, "Share this\n\n  \nMenu"), (1, "Menu\nMenus\n\n  \nShare this"), (2, "Share thus\nMenu\nx"), (3, "x\nx")]
    found = {x.doc_id: list(x.removed) for x in removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {0: [], 1: [0, 4], 2: [0, 1], 3: [0, 1]}


def test_chat(spark):
    from panelspark.llm import chat

    log = [
        (1, 0, 0, "message", "user", "### hi </turn> \\ "), (1, 1, 1, "message", "assistant", ""), (1, 1, 3, "delta", None, "b\nc"), (1, 1, 2, "delta", None, "a"), (1, 2, 4, "message", "user", "q"), (1, 2, 5, "edit", None, "Q"), (1, 2, 6, "delta", None, "?"),
        (1, 3, 7, "message", "assistant", "wrong"), (1, 3, 8, "regenerate", None, None), (1, 3, 9, "delta", None, "right"), (1, 4, 10, "message", "user", "gone"), (1, 4, 11, "delete", None, None), (1, 5, 12, "odd", "user", "x"), (2, 0, 0, "message", "user", None), (None, 0, 0, "message", "assistant", "n"), (1, 3, None, "edit", None, "no"),
    ]
    df = spark.createDataFrame(log, "conv long, message long, seq long, kind string, role string, text string")
    made = chat.format_chats(df)
    back = {r.conv_id: (r.turns, r.loss, r.formatted, "".join(s.text for s in r.segments)) for r in made.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")).collect()}
    assert [tuple(t) for t in back[1][0]] == [("user", "### hi </turn> \\ "), ("assistant", "ab\nc"), ("user", "Q?"), ("assistant", "right")]
    assert back[1][1] == "ab\ncright" and back[1][2] == back[1][3]
    assert [tuple(t) for t in back[2][0]] == [("user", "")] and back[None][1] == "n"
    assert chat.format_chats(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "user", "z")], "conv_id long, turn long, role string, text string")
    kept = chat.format_chats(chat.streamed_events(twice)).select(chat.read_turns(F.col("formatted")).alias("t")).first().t
    assert [tuple(t) for t in kept] == [("user", "a"), ("user", "a"), ("user", "z")]


def test_chat_roles_and_repeated_events(spark):
    """Roles come back whatever they hold, an event delivered again counts once, and columns of any name are left alone."""
    from panelspark.llm import chat

    roles = ["us\ner", "\\n", "\\\\n\n", "a\\\nb", "#<\\", "\n\n", "n", "", "assistant"]
    log = [(i, 0, 0, "message", r, "t", "x") for i, r in enumerate(roles)] + [(50, 0, 0, "message", "user", "", "x"), (50, 0, 1, "delta", None, "ab", "x"), (50, 0, 1, "delta", None, "ab", "x"), (50, 0, 2, "delta", None, "ab", "x")]
    df = spark.createDataFrame(log, "conv long, message long, seq long, kind string, role string, text string, formatted string")
    back = {r.conv_id: r.t for r in chat.format_chats(df).select("conv_id", chat.read_turns(F.col("formatted")).alias("t")).collect()}
    assert [back[i][0].role for i in range(len(roles))] == roles and back[50][0].text == "abab"


def test_chat_query(spark, tmp_path):
    """The query's digests beside those worked out from the table by hand; long conversations, nulls and control strings."""
    from panelspark.llm import chat
    from panelspark.llm.queries import op7_chat_formatting

    odd = ["", None, "### Assistant: </turn>\n", "\\", "a\\nb\n", "#<\\" * 50, "é☃😀\n\n", "x"]
    turns = [(c, t, ["user", "assistant", "system"][(c + t) % 3], odd[(c * 3 + t) % len(odd)], "y") for c in range(6) for t in range(9)] + [(99, t, "assistant" if t % 2 else "user", f"w{t} " * 20, "y") for t in range(3000)]
    turns += [(70, None, "user", "z", "y"), (70, None, "assistant", "b", "y"), (70, None, "assistant", "a", "y"), (70, None, None, None, "y"), (70, 2**62, "user", "late", "y"), (70, -(2**62), "user", "early", "y"), (71, None, "user", None, "y")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, seq string").repartition(4).write.parquet(str(tmp_path / "conversations.parquet"))
    said = "\\### Assistant: </turn> ok"
    by = collections.defaultdict(list)
    for c, _, role, text, _ in sorted(turns, key=lambda x: (x[0], x[1] is None, x[1] or 0, x[2] or "", x[3] or "")):
        by[c].append((role or "", text or ""))
    by[-7] = [("user", said), ("assistant", said)]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {c: (len(v), sha("".join(f"{r}\n{t}\n" for r, t in v)), len(m := "".join(t for r, t in v if r == "assistant")), sha(m)) for c, v in by.items()}
    got = op7_chat_formatting(spark, str(tmp_path)).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == want
    log = chat.streamed_events(spark.read.parquet(str(tmp_path / "conversations.parquet")))
    assert {r.kind for r in log.select("kind").distinct().collect()} == {"message", "delta", "edit", "regenerate"}


def test_token_counts(spark, docs, empty):
    from panelspark.llm.token_counts import answer, suffix_sums, token_counts, token_lengths

    lengths = [r.length for r in token_lengths(docs).collect()]
    rows = {r.length: r for r in token_counts(docs).collect()}
    assert set(rows) == set(lengths)
    for n, r in rows.items():
        assert (r.n_docs, r.docs_over, r.tokens_over, r.truncated_total, r.total_docs, r.total_tokens) == (lengths.count(n), sum(x > n for x in lengths), sum(x for x in lengths if x > n), sum(min(x, n) for x in lengths), len(lengths), sum(lengths))
        assert r.quantile == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    limits = [0, 1, 100, 1000, 10**6]
    assert {r.context_limit: r.truncated_total for r in answer(token_counts(docs), limits).collect()} == {k: sum(min(x, k) for x in lengths) for k in limits}
    assert token_counts(empty).count() == 0
    h = spark.createDataFrame([(i, 1) for i in range(0, 2000, 7)], "length long, n_docs long")
    assert all(r.docs_over == sum(x > r.length for x in range(0, 2000, 7)) for r in suffix_sums(h).collect())


def test_minhash(spark, docs, empty, null_ids):
    from panelspark.llm import minhash as M
    from panelspark.llm._text import shingle_set, word_hashes

    rows = texts()
    for buckets in (1, 4):
        got = {r.doc_id: r for r in M.neighbour_fingerprints(docs, buckets=buckets).collect()}
        assert len(got) == len(rows)
        for i, x in enumerate(rows):
            x, nxt = x or "", rows[(i + 1) % len(rows)] or ""
            half = len(x) // 2
            edit = x[: len(x) - half] + nxt[:half]
            assert (got[i].n_chars, got[i].edited_sha256) == (len(x), hashlib.sha256(edit.encode()).hexdigest())
            assert got[i].fingerprint == M.text_signature(x).tobytes().hex() and got[i].edited_fingerprint == M.text_signature(edit).tobytes().hex()
    assert got[0].fingerprint == got[1].fingerprint and got[0].near_next == 1.0
    a, b = shingle_set(word_hashes(words(2000, 1)), 5), shingle_set(word_hashes(words(2000, 1)[:7000] + words(900, 2)), 5)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert M.likeness(M.signature(a), M.signature(b)) == pytest.approx(true, abs=0.15)
    assert M.neighbour_fingerprints(empty).count() == 0
    assert M.neighbour_fingerprints(null_ids).count() == 5
    want = {i: c for i, (_, c) in brute_components(list(enumerate(rows)), 5, 4, 5).items()}
    assert {r.doc_id: r.component_id for r in M.near_duplicate_classes(docs).collect()} == want
    assert M.fingerprints(docs).count() == len(rows)


def test_minhash_signatures_one_by_one():
    """The vectorised signature beside a loop over permutations and shingles with Python's own integers."""
    from panelspark.llm import minhash as M
    from panelspark.llm._text import shingle_set, word_hashes

    for text in (words(300, 5), "one two", "a b c d e", ""):
        shingles = [int(x) for x in shingle_set(word_hashes(text, True), 5)]
        want = [min([2**64 - 1, *[(x * int(a) + int(b)) % 2**64 for x in shingles]]) >> 32 for a, b in zip(M._A[:, 0], M._B[:, 0])]
        assert M.text_signature(text).tolist() == want


def test_minhash_classes_of_awkward_rows(spark, empty, null_ids):
    from panelspark.llm._graph import connected_components
    from panelspark.llm.minhash import near_duplicate_classes

    assert near_duplicate_classes(empty).count() == 0
    got = sorted(((r.doc_id, r.component_id) for r in near_duplicate_classes(null_ids).collect()), key=str)
    assert got == [(3, 3), (3, 3), (None, 3), (None, 3), (None, None)]
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 3), (5, 5), (None, 1), (7, None), (9, 8)], "a long, b long")
    assert {(r.node, r.label) for r in connected_components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (9, 8), (8, 8)}
    assert connected_components(edges.limit(0)).count() == 0


def test_minhash_recall(spark):
    """Pairs of similarity 0.8 and more that the bands must find, against every pair."""
    from panelspark.llm.minhash import near_duplicate_classes

    r, rows = random.Random(9), []
    for g in range(40):
        base = words(200, 500 + g, 10_000).split(" ")
        rows.append(" ".join(base))
        for k in (1, 3, 4):
            copy = list(base)
            for i in r.sample(range(0, 200, 5), k):
                copy[i] = f"n{len(rows)}_{i}"
            rows.append(" ".join(copy))
    want = {i: c for i, (_, c) in brute_components(list(enumerate(rows)), 5, 4, 5).items()}
    got = {x.doc_id: x.component_id for x in near_duplicate_classes(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert sum(got[i] == want[i] for i in want) >= 0.99 * len(want)


def test_queries_keep_their_contracts(spark, tmp_path):
    """op1, op2, op4, op9 and op10 as registered, on a table with nulls, a very long text and special strings."""
    import public_tokenizers
    import sentencepiece
    import tokenizers

    from panelspark.llm import queries as Q

    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts())]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    run = lambda q: q(spark, str(tmp_path)).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = run(Q.op1_packing)
    assert pieces[0].asDict().keys() >= {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}
    for i, x, *_ in rows:
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for p in (p for p in pieces if p.doc_id == i):
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) and p.doc_tokens == len(ids)
        assert sum(p.length for p in pieces if p.doc_id == i) == len(ids)
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in run(Q.op2_sentencepiece)} == {i: (len(k := sp.encode(x or "")), sha(",".join(map(str, k))), sha(sp.decode(k))) for i, x, *_ in rows}
    assert len(run(Q.op4_quality_rules)) == len(run(Q.op9_minhash)) == len(rows)
    want = brute_components([r[:2] for r in rows], 4, 85, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in run(Q.op10_ngram_jaccard_join)} == want
    assert sum(r.n_docs for r in run(Q.op8_token_counts)) == len(rows) and len(run(Q.op5_license_scan)) == len(run(Q.op6_line_dedup)) == len(rows)


def test_null_ids_of_lengths_and_pieces(null_ids):
    from panelspark.llm.sentencepiece_codec import decode, encode
    from panelspark.llm.token_counts import token_counts

    assert sum(r.n_docs for r in token_counts(null_ids).collect()) == 5
    assert decode(encode(null_ids)).count() == 5


def test_quality_classifier_on_long_texts(spark):
    """A text of 200,000 words is scored whole, like its own words one by one."""
    from panelspark.llm.kn_quality import classify

    r = random.Random(5)
    common = [f"word{i}" for i in range(50)]
    rows = [(i, " ".join(r.choices(common, k=40)), "en") for i in range(300)] + [(300, " ".join(r.choices(common, k=200_000)), "en"), (None, "word1 word2", "xx"), (301, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in classify(docs, labels).collect()}
    typical = sorted(got[i].perplexity for i in range(300))
    assert got[300].n_words == 200_000 and typical[0] < got[300].perplexity < typical[-1] and len(got) == len(rows)


def test_minhash_links_copies_that_are_unlike_one_another(spark):
    """A base and copies that are over 0.8 like it and under 0.8 like one another are one class, whichever heads a list."""
    from panelspark.llm.minhash import near_duplicate_classes

    r, base = random.Random(2), words(600, 77, 100_000).split(" ")
    made = [" ".join(base)]
    for i in range(200):
        copy = list(base)
        for k in r.sample(range(0, 600, 5), 13):
            copy[k] = f"n{i}_{k}"
        made.append(" ".join(copy))
    rows = list(enumerate(made))
    sets = [{tuple(w[j : j + 5]) for j in range(596)} for w in (t.split(" ") for t in made)]
    like = lambda a, b: len(a & b) / len(a | b)
    assert min(like(sets[0], s) for s in sets[1:]) >= 0.8 and sum(like(sets[i], sets[i + 1]) < 0.8 for i in range(1, 200)) > 190
    got = collections.Counter(x.component_id for x in near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got[0] >= 195  # a few pairs may share no band


def test_minhash_verifies_only_texts_of_pairs(spark, monkeypatch):
    """The sets of texts that no pair asks for aren't made again; the classes stay whole, also with repeated rows and null texts and ids."""
    from panelspark.llm import minhash as M

    seen, whole = [], M.verified

    def counted(base, *rest):
        seen.append(base.count())
        return whole(base, *rest)

    monkeypatch.setattr(M, "verified", counted)
    copy = words(200, 1).split(" ")
    rows = [(i, words(200, i)) for i in range(300)] + [(300, " ".join([*copy[:-1], "other"])), (300, " ".join([*copy[:-1], "other"])), (None, words(200, 2) + " more"), (301, None), (302, "")]
    got = M.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and {x.component_id for x in got if x.doc_id in (1, 300)} == {1}
    assert all(x.component_id == x.doc_id for x in got if x.doc_id not in (None, 300)) and [x.component_id for x in got if x.doc_id is None] == [2]
    assert seen and max(seen) < 30


def test_quality_classifier(spark, empty):
    from panelspark.llm.kn_quality import classify, keep_trusted, trusted_sample

    r = random.Random(11)
    common = [f"word{i}" for i in range(60)]
    good = [" ".join(r.choices(common, weights=range(60, 0, -1), k=60)) for _ in range(400)]
    bad = [" ".join(f"z{r.randrange(10**6)}%%" for _ in range(60)) for _ in range(40)]
    rows = [(i, t, "en" if i % 9 else "de", "x") for i, t in enumerate([*good, *bad, None, ""])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, total string")
    labels = spark.createDataFrame([(i, int(i < 400), 0) for i in range(0, 440)] + [(None, 1, 0), (5, None, 1), (10**6, 1, 0)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in classify(docs, labels).collect()}
    assert len(got) == len(rows)
    assert sum(got[i].kept for i in range(400)) >= 390 and not any(got[i].kept for i in range(400, 440))
    assert {got[i].lang for i in range(1, 9)} == {"en"}
    assert keep_trusted(docs, labels).columns == docs.columns
    assert classify(empty, labels).count() == 0
    alone = classify(docs, labels.limit(0)).collect()
    assert len(alone) == len(rows) and all(x.kept and x.perplexity is None for x in alone)
    sample = {x.id for x in trusted_sample(docs, labels, "doc_id", 8000).collect()}
    train = {x: [t for i, t, lang, _ in rows if i in sample and lang == x] for x in ("en", "de")}
    scores = {k: KneserNey(v) for k, v in train.items()}
    for i, t, lang, _ in rows[::7] + rows[-2:]:
        assert got[i].lang == lang and got[i].perplexity == pytest.approx(scores[lang].perplexity(t or ""), rel=1e-6)


def test_quality_classifier_by_language(spark):
    """A rare language has rows, a model and a threshold of its own, whatever share of the trusted rows it has."""
    from panelspark.llm.kn_quality import classify, trusted_sample

    r = random.Random(3)
    made = lambda name, size: " ".join(r.choices([f"{name}{i}" for i in range(size)], k=30))
    rows = [(i, made("a", 40), "en") for i in range(1500)] + [(i, made("b", 40), "fr") for i in range(1500, 1620)]
    rows += [(i, made("c", 400), "de") for i in range(1620, 1640)] + [(i, made("d", 40), "es") for i in range(1640, 1660)] + [(i, made("e", 40), None) for i in range(1660, 1680)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in rows], "doc_id long, quality int, toxic int")
    lang = {i: x for i, _, x in rows}
    sample = {x.id for x in trusted_sample(docs, labels, "doc_id", 60).collect()}
    assert collections.Counter(lang[i] for i in sample)["fr"] == collections.Counter(lang[i] for i in sample)["en"] == 60
    got = {x.doc_id: x for x in classify(docs, labels, train_docs=60).collect()}
    assert {x.lang for i, x in got.items() if lang[i] == "fr"} == {"fr"}
    for name in ("en", "fr", "de", "es", None):
        own = [x for i, x in got.items() if lang[i] == name]
        held = sorted(x.perplexity for x in own if x.doc_id not in sample)
        assert {x.threshold for x in own} == {held[math.ceil(0.995 * len(held)) - 1]}


def test_quality_classifier_sample_size(spark):
    """Training text isn't halved: 8,000 trusted rows of a language teach the model where there are as many."""
    from panelspark.llm import kn_quality as K

    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert K.trusted_sample(docs, labels, "doc_id", K.TRAIN_DOCS).count() == 8000


def test_quality_classifier_learns_from_all_trusted_rows(spark):
    """No language's training rows are capped: all trusted rows but the held-out quarter teach the model."""
    from panelspark.llm import kn_quality as K

    docs = spark.range(14_000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("a"), F.col("id") % 7, F.lit("b")).alias("text"), F.lit("en").alias("lang"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    model = K.fit(docs, labels)
    n = docs.where(F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(4)) != 0).count()
    assert model.sample.count() == n > K.TRAIN_DOCS
    assert model.tables[1].agg(F.sum("met")).first()[0] == 4 * n


def test_quality_classifier_packs_its_table(spark, monkeypatch):
    """The value table is stored once, packed by shard, each key that isn't hot once; rows scored by it, in parts, get what hot keys give."""
    import numpy as np

    from panelspark.llm import kn_quality as K

    for keys in ([], [-1], [5, 5, 1 << 40], [-1, 7, K.TRIGRAM, K.TRIGRAM + (3 << 48) + 9, K.TRIGRAM + (3 << 48) + 9]):
        assert K._keys(K._packed_keys(np.array(keys, dtype=np.int64))).tolist() == keys
    r = random.Random(8)
    rows = [(i, " ".join(r.choices([f"w{k}" for k in range(90)], weights=range(90, 0, -1), k=50)), "en") for i in range(600)] + [(None, None, "en"), (None, "w1 w2 w3", "de"), (5, "w1 w1", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    whole = sorted(((x.doc_id, x.n_words, x.kept, x.perplexity) for x in K.classify(docs, labels).collect()), key=str)
    monkeypatch.setattr(K, "HOT", 20)
    monkeypatch.setattr(K, "SHARD_KEYS", 500)
    model = K.fit(docs, labels)
    packed = model.packed.collect()
    found = [k for x in packed for k in K._keys(x["keys"]).tolist()]
    assert len(found) == len(set(found)) and len(found) + len(model.hot[0]) - 1 == sum(t.count() for t in model.tables[:2]) and len({x.shard for x in packed}) > 8
    old = 12 * len(found)  # bytes of keys and values as they are
    assert sum(len(x["keys"]) + len(x["data"]) for x in packed) < old
    cold = sorted(((x.doc_id, x.n_words, x.kept, x.perplexity) for x in K.classify(docs, labels).collect()), key=str)
    assert [x[:3] for x in cold] == [x[:3] for x in whole] and len(cold) == len(rows)
    assert [x[3] for x in cold] == pytest.approx([x[3] for x in whole], rel=1e-9)


def test_quality_classifier_leaves_nothing_in_the_driver(spark, monkeypatch):
    """The driver gets hot keys packed and filters compressed, keeps no array of the model beside its broadcasts, and frees those when rows are scored."""
    import numpy as np

    from panelspark.llm import kn_quality as K

    r = random.Random(9)
    docs = spark.createDataFrame([(i, " ".join(r.choices([f"w{k}" for k in range(90)], weights=range(90, 0, -1), k=50)), "en") for i in range(300)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(200)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(K, "HOT", 50)
    made, fit = [], K.fit
    monkeypatch.setattr(K, "fit", lambda *a: made.append(fit(*a)) or made[0])
    model = fit(docs, labels)
    assert not [k for k, v in vars(model).items() if isinstance(v, np.ndarray) or isinstance(v, dict) and k != "codes"]
    pairs, trigrams = model.tables[:2]
    rows = pairs.unionByName(trigrams.select("key", "value", "met")).orderBy(F.desc("met")).collect()
    least = rows[50].met  # a count that more than HOT keys reach
    assert model.hot[0].tolist() == [-1, *sorted(x.key for x in rows if x.met > least)]
    assert dict(zip(model.hot[0].tolist()[1:], model.hot[1].tolist()[1:], strict=True)) == {x.key: x.value for x in rows if x.met > least}
    keys = np.array([x.key for x in rows])
    assert K._passes(K._filter_bits(model.packed.select("keys").unionByName(spark.createDataFrame([(K._packed_keys(model.hot[0][1:]),)], "keys binary")), len(keys)), keys).all()
    assert K.classify(docs, labels).count() == 300
    assert not made[0].held._jbroadcast.isValid() and not made[0].known._jbroadcast.isValid()


class KneserNey:
    """Interpolated modified Kneser-Ney of order three, straight from the definition."""

    def __init__(self, train):
        count = collections.Counter(w for t in train for w in t.split())
        self.known = {w for w, n in count.items() if n > 1}
        self.spread = math.log(max(1, len(count) - len(self.known)))
        self.c = {3: collections.Counter()}
        for t in train:
            s = self.sequence(t)
            self.c[3].update(zip(s, s[1:], s[2:]))
        for k in (2, 1):
            self.c[k] = collections.Counter(g[1:] for g in self.c[k + 1])
        self.cut, self.total, self.mass = {}, collections.Counter(), collections.Counter()
        for k, c in self.c.items():
            n1, n2, n3, n4 = (max(sum(v == i for v in c.values()), 1e-3) for i in (1, 2, 3, 4))
            y = n1 / (n1 + 2 * n2)
            self.cut[k] = [min(max(v, 0.05), top - 0.05) for v, top in ((1 - 2 * y * n2 / n1, 1), (2 - 3 * y * n3 / n2, 2), (3 - 4 * y * n4 / n3, 3))]
            for g, n in c.items():
                self.total[k, g[:-1]] += n
                self.mass[k, g[:-1]] += self.cut[k][min(n, 3) - 1]
        for context in [(), *[g[:1] for g in list(self.c[2])[:5]], *[g[:2] for g in list(self.c[3])[:5]]]:
            assert sum(self.p((*context, w)) for w in [*self.known, "<unk>", "</s>"]) == pytest.approx(1.0)

    def sequence(self, text):
        return ["<s>", "<s>", *[w if w in self.known else "<unk>" for w in text.split()], "</s>"]

    def p(self, gram):
        k = len(gram)
        if not k:
            return 1 / (len(self.known) + 2)
        total = self.total[k, gram[:-1]]
        if not total:
            return self.p(gram[1:])
        n = self.c[k].get(gram, 0)
        return ((n - self.cut[k][min(n, 3) - 1]) / total if n else 0.0) + self.mass[k, gram[:-1]] / total * self.p(gram[1:])

    def perplexity(self, text):
        s = self.sequence(text)
        logs = [math.log(self.p(g)) - (self.spread if g[2] == "<unk>" else 0.0) for g in zip(s, s[1:], s[2:])]
        return math.exp(-sum(logs) / len(logs))


def test_shared_hashes():
    from panelspark.llm._text import shingle_set, stretches, word_hashes

    assert len(word_hashes("a b\tc\x0bd\x0ce\rf\ng")) == 7 and len(word_hashes("a\xa0b")) == 1
    assert (word_hashes("Ab É", fold=True) == word_hashes("ab É")).all() and (word_hashes("é", fold=True) != word_hashes("É", fold=True)).all()
    assert word_hashes("ab")[0] != word_hashes("ba")[0]
    assert len(shingle_set(word_hashes("a b"), 5)) == 1 and len(shingle_set(word_hashes(""), 5)) == 0
    x = "ab cd " * 1000
    assert "".join(stretches(x, re.compile("[^ ](?= )"), 50)) == x
