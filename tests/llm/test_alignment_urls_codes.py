"""Token alignment, URL filters and vector codes beside brute force, and on awkward rows."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

ODD = ["", None, " ", "  ", "a", " a", "a ", "\n", "\n\n a", "a\n\nb  c", "a\tb c", "x\u00a0y z", "\u2581", "a \u2581b", "<|endoftext|> b", "<s> <0x41> <unk>", "\u00dcn\u00efc\u00f6de \u2603 \u65e5\u672c\u8a9e " * 20, "x" * 3000, "\r\na b", " \n\t ", "\U0001f600 a\U0001f600b", "\u200bz z", "\ufb01 \u2122 \u2460", "a\x00b c", "it's they'll 123 4567", "word " * 20_000]


def alignment(rows):
    """The contract of op11 by both libraries on whole texts."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    names = {v: k for k, v in first.get_vocab(with_added_tokens=True).items()}
    plain = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
    letter = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("\u2581", " ").encode()

    def spans(ids, texts):
        at, out = 0, []
        for i, t in zip(ids, texts, strict=True):
            out.append((at, at := at + len(t), i))
        return out

    made, count = [], collections.Counter()
    for key, text in rows:
        a, b = (first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)) if text else ([], [])
        ta, tb = [bytes(letter[c] for c in names[i]) for i in a], [piece(i) for i in b]
        if not text or not b"".join(ta) == b"".join(tb) == (" " + text).encode():
            made.append((key, None))
            continue
        sa, sb = spans(a, ta), spans(b, tb)
        groups, links, i, j = [], [], 0, 0
        for end in sorted({x[1] for x in sa} & {x[1] for x in sb}):
            u, v = [], []
            while i < len(sa) and sa[i][1] <= end:
                u.append(sa[i])
                i += 1
            while j < len(sb) and sb[j][1] <= end:
                v.append(sb[j])
                j += 1
            groups.append(",".join(str(x[2]) for x in u) + "|" + ",".join(str(x[2]) for x in v))
            links += [(x[2], y[2]) for x in u for y in v if x[0] < y[1] and y[0] < x[1]]
        count.update(links)
        made.append((key, (len(a), len(b), groups, links)))
    best = collections.defaultdict(int)
    for (_, b), c in count.items():
        best[b] = max(best[b], c)
    none = (0, 0, 0, 0, 0, 0, "")
    rank = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    return sorted(((key, *none) if x is None else (key, x[0], x[1], len(x[2]), len(x[3]), sum(count[k] == best[k[1]] for k in x[3]), sum(count[k] for k in x[3]), hashlib.sha256(";".join(x[2]).encode()).hexdigest()) for key, x in made), key=rank)


def test_alignment_beside_the_libraries(spark, sf_dir):
    from panelspark.llm.token_alignment import token_links

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    rows = docs + [(10_000 + i, t) for i, t in enumerate(ODD)] + [(None, "a b"), (None, "a b"), docs[0], docs[0], (7, "x" * 40_000 + " y")]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, block long, keys string, row long").repartition(3)
    want = alignment(rows)
    rank = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in token_links(df).collect()), key=rank) == want
    # small blocks, few shards and a third of all rows alike: many dense vectors are summed
    assert sorted((tuple(r) for r in token_links(df, block_rows=2, shards=3).collect()), key=rank) == want
    assert token_links(df.limit(0)).count() == 0
    none = [tuple(r) for r in token_links(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()]
    assert sorted(none) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_dense_counts_are_summed_as_a_tree(spark):
    """Two hundred slices at a fan of three, beside a plain sum."""
    from panelspark.llm import token_alignment as T

    r = random.Random(2)
    rows = [(b, 0, sorted(r.sample(range(50), 20))) for b in range(400)]
    total = collections.Counter(k for _, _, keys in rows for k in keys for _ in range(1 + k % 3))
    pairs = spark.createDataFrame([(b, s, [k << 32 | k % 5 for k in keys], [1 + k % 3 for k in keys]) for b, s, keys in rows], "block long, shard int, keys array<long>, counts array<long>").withColumn("slice", F.pmod("block", F.lit(200)).cast("int"))
    row = T.pair_counts(pairs, T.pair_hashes(pairs), 200, 3).collect()
    keys, counts, best = (np.frombuffer(row[0][c], dtype=t) for c, t in (("stored", "<u8"), ("vector", "<i8"), ("best", np.uint8)))
    assert len(row) == 1 and {int(k) >> 32: c for k, c in zip(keys, counts, strict=True)} == total
    top = collections.defaultdict(int)
    for k, c in total.items():
        top[k % 5] = max(top[k % 5], c)
    assert all(bool(f) == (c == top[int(k) & 0xFFFFFFFF]) for k, c, f in zip(keys, counts, best, strict=True))


def test_perfect_hash():
    from panelspark.llm.mphf import PerfectHash, verified_index

    r = np.random.default_rng(5)
    for n in (0, 1, 2, 1000, 60_000):
        keys = np.unique(r.integers(0, 2**63, n, dtype=np.uint64))
        table = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
        assert table.n == len(keys) and sorted(table.index(keys).tolist()) == list(range(len(keys)))
        stored = np.zeros(len(keys), dtype=np.uint64)
        stored[table.index(keys)] = keys
        assert (stored[verified_index(table, stored, keys)] == keys).all()
        with pytest.raises(LookupError):
            verified_index(table, stored, np.array([2**63 + 5], dtype=np.uint64))
    with pytest.raises(ValueError):
        PerfectHash.build(np.array([3, 3], dtype=np.uint64))


URLS = ["http://A.Org/x", "https://www.example.org/es/1?q=/en/", "https://example.org/en/12", "https://example.org/EN/12", "http://b.com/fr/#x", "http://com/de/1", "http://xcom/de/1", "http://a.org:80/x", "http://org", "http://org/", "x://", "://h?p", "none", "", None, "a://b://c/d", "http://h.net/p" + "q" * 50_000, "http://h.example.org/en/1\nz"]


def by_hand(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, rule in rules:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fits.append((-len(rule), rule, verdict))
    return host, path, *(min(fits)[1:] if fits else (None, None))


@pytest.fixture(scope="module")
def url_model(spark):
    from panelspark.llm import url_filter as U

    return U.train(U.labelled_urls(spark))


def test_url_rules(spark, url_model):
    from panelspark.llm import url_filter as U

    rules = [*U.RULES, ("allow", "h.net/pq"), ("block", "h.net"), ("allow", "b.com/fr/")]
    pages = spark.createDataFrame([(i, u, "x", "y", 1.0) for i, u in enumerate(URLS + URLS[:3])] + [(None, URLS[0], "x", "y", 1.0)], "page_id long, url string, host string, verdict string, score double")
    want = {(i, *by_hand(u, rules)[:3]) for i, u in enumerate(URLS + URLS[:3])} | {(None, *by_hand(URLS[0], rules)[:3])}
    for given in (rules, spark.createDataFrame(rules + [(None, "q/"), rules[0]], "verdict string, rule string")):
        got = U.judge(pages, url_model, given).collect()
        assert {(r.page_id, r.host, r.path, r.rule) for r in got} == want and len(got) == len(URLS) + 4
        for r in got:
            assert r.verdict == (dict((b, a) for a, b in rules)[r.rule] if r.rule else "block" if (r.score or 0) >= U.BLOCK_AT else "allow")
            assert (r.score is None) == (r.host == "" and r.path == "")
    assert U.judge(pages.limit(0), url_model, rules).count() == 0
    assert {r.rule for r in U.judge(pages, url_model).collect()} == {None} == {r.rule for r in U.judge(pages, url_model, spark.createDataFrame([], "verdict string, rule string")).collect()}


def test_url_model_beside_numpy(spark):
    """The regression's loss on its own features is as low as plain gradient steps make it, and unseen hosts are told apart."""
    from panelspark.llm import url_filter as U

    rows = [(f"https://{a}{i}.example.net/{p}", int(a in ("casino", "pills"))) for i in range(6) for a in ("casino", "pills", "garden", "school") for p in ("x", "yz")] + [("https://odd.net/", None), (None, 0)]
    table = spark.createDataFrame(rows, "url string, label int")
    model = U.train(table, features=256, penalty=0.01, iterations=400)
    kept = table.where("label is not null").withColumns({"__host": U.host_of(F.col("url")), "__path": U.path_of(F.col("url"))})
    data = U._features(kept, 256).select("label", "__features").collect()
    x, y = np.array([r[1].toArray() for r in data]), np.array([r[0] for r in data], dtype=float)
    loss = lambda w, b: np.mean(np.log1p(np.exp(-(2 * y - 1) * (x @ w + b)))) + 0.005 * (w @ w)
    w, b = np.zeros(256), 0.0
    for _ in range(6000):
        g = 1 / (1 + np.exp(-(x @ w + b))) - y
        w, b = w - 0.2 * (x.T @ g / len(y) + 0.01 * w), b - 0.2 * g.mean()
    assert loss(model.coefficients.toArray(), model.intercept) <= loss(w, b) + 1e-6


def test_urls_of_held_out_words(spark, url_model):
    from panelspark.llm import url_filter as U

    bad, good = ["best-casino-games", "free-poker-win", "cheap-pills-shop", "spam-links"], ["wikipedia", "city-library", "new-museum", "thether", "ionther", "farmers-market"]
    pages = spark.createDataFrame([(i, f"https://{f}{h}.example.net/{g}/12") for i, h in enumerate(bad + good) for f in ("", "www.") for g in ("en", "de")], "page_id long, url string")
    seen = collections.Counter((r.page_id < len(bad), r.verdict) for r in U.judge(pages, url_model).collect())
    assert seen[True, "block"] >= 0.85 * 4 * len(bad) and seen[False, "block"] == 0


def codes_by_hand(rows, parts=8, entries=16, rounds=6, scale=4096):
    """The contract of op13 in plain numpy: every distance, the first least one."""
    good = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(scale * float(np.float32(c))) for c in v] for _, v, _ in good], dtype=np.int64)
    step = x.shape[1] // parts
    order = sorted(range(len(good)), key=lambda k: (good[k][0] is None, good[k][0] or 0, x[k].tolist()))[:entries]
    books = [x[order, p * step : (p + 1) * step].copy() for p in range(parts)]

    def near():
        d = [((x[:, None, p * step : (p + 1) * step] - books[p][None]) ** 2).sum(2) for p in range(parts)]
        return np.array([y.argmin(1) for y in d]), np.array([y.min(1) for y in d])

    for _ in range(rounds):
        code, _ = near()
        for p in range(parts):
            for e in range(len(order)):
                own = x[code[p] == e, p * step : (p + 1) * step]
                if len(own):
                    books[p][e] = own.sum(0) // len(own)
    code, d = near()
    total = collections.Counter()
    for (_, _, label), e in zip(good, d.sum(0), strict=True):
        total[label] += int(e)
    sha = hashlib.sha256(",".join(str(c) for b in books for c in b.reshape(-1)).encode()).hexdigest()
    return sorted((f"{g[0]}", "".join(f"{c:02x}" for c in code[:, k]), int(d[:, k].sum()), total[g[2]], sha) for k, g in enumerate(good))


def test_vector_codes(spark):
    from panelspark.llm.vector_codes import compress

    r = np.random.default_rng(3)
    rows = [(i, r.normal(0, 0.2, 16).astype(np.float32).tolist(), int(r.integers(3)) if i % 7 else None) for i in range(300)]
    rows += [(1000 + i, rows[5][1], 1) for i in range(150)]  # a third of all vectors are one
    rows += [(7, rows[7][1], 0), (7, rows[8][1], 0), (None, rows[9][1], 2), (2000, None, 1), (2001, [0.1] * 15 + [None], 1), (2002, [0.1] * 15 + [float("nan")], 1), (2003, [float("inf")] * 16, 1), (-3, [0.0] * 16, None), (2004, [1.5, -1.5] * 8, 0), (2005, [], 0)]
    df = spark.createDataFrame([(*x, "x", "y") for x in rows], "vec_id long, embedding array<float>, label int, code string, ints string").repartition(5)
    got = compress(df).collect()
    assert sorted((f"{x.vec_id}", *x[1:]) for x in got) == codes_by_hand([x for x in rows if x[1] != []])
    assert compress(df.limit(0)).count() == 0
    few = df.where("vec_id between 3 and 6")
    assert sorted((f"{x.vec_id}", *x[1:]) for x in compress(few).collect()) == codes_by_hand([x for x in rows if x[0] is not None and 3 <= x[0] <= 6])
    # another length, and one that the parts don't divide: kept without a code
    odd = spark.createDataFrame([(1, [0.5] * 8, 1), (2, [0.5] * 16, 1), (3, [1e30] * 8, 1)], "vec_id long, embedding array<double>, label int")
    assert {x.vec_id: (x.code, x.error) for x in compress(odd).collect()} == {1: ("00" * 8, 0), 2: (None, None), 3: ("01" * 8, 0)}
    assert {x.code for x in compress(spark.createDataFrame([(1, [0.5] * 9, 1)], "vec_id long, embedding array<float>, label int")).collect()} == {None}


def test_equal_average_search_finds_the_nearest():
    from panelspark.llm.vector_codes import nearest

    r = np.random.default_rng(8)
    for size, spread in ((16, 50), (200, 5), (1, 9), (16, 2**27)):
        book = r.integers(-spread, spread + 1, (size, 8))
        book[size // 2] = book[0]
        vectors = np.concatenate([r.integers(-spread, spread + 1, (3000, 8)), book])
        d = ((vectors[:, None] - book[None]) ** 2).sum(2)
        index, best = nearest(vectors, book)
        assert (index == d.argmin(1)).all() and (best == d.min(1)).all()
