"""Line deduplication by a segment-partition edit join, with DataFrame and SQL functions only.

Two lines are near if their edit distance is at most THRESHOLD, and at most one edit for CHARS_AN_EDIT characters of the
shorter one, so that short lines need to be more alike (under that many characters: equal). A line of length m that allows
k edits is cut into k + 1 segments of nearly equal length. Within k edits at least one of them stays whole in the other line, at
a place that the lengths bound. So each line indexes its own segments by (length, segment number, text) and
probes the substrings that can match the segments of lines of its length or up to k shorter. Of two lines of one length
each probes the other, so shifts to one side are enough.

The rows of one segment key are a list. Lists of a single line go first. In each list all lines meet the earliest line and the
earliest owner of the segment; the lines found near are settled, since one earlier near line is enough. What is left, lines not yet
settled against the earlier ones of their list, is joined under a bound on letter counts, which every edit changes by two at most, so
that a group of copies that are not near one another gives few pairs. Pairs are verified by a banded
bit-parallel edit distance on what lies between their common beginning and end.

A line goes if an equal line, or one near it, stands earlier in order of (document, line number),
whether or not that one stays. Equal lines go at any length if they have a word; only the first of equal lines takes part in
the edit join. Lines without a word stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm._graph import cut, drop

THRESHOLD, CHARS_AN_EDIT = 2, 10
#: Lines that occur most often, whose repeats are dropped before the shuffle: a fixed bound of what is broadcast.
HOT_LINES = 4096
#: Characters that the bound on letter counts looks at, eight to a number; any would do, frequent ones tell lines apart best.
LETTERS = ("etaonirs", "hdlucmg ")
WORD = r"[^\x20\x09-\x0D]"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def allowed_edits(n: str, threshold: int, chars: int) -> str:
    """SQL for the edits that a line of n characters allows."""
    return f"least({threshold}, ({n}) div {chars})"


def _segment(length: str, number: int, count: int) -> tuple[str, str]:
    """SQL for (start from 0, length) of a segment; the later ones are longer by one where lengths don't divide."""
    short = count - 1 - number  # segments after this one
    base, more = f"({length}) div {count}", f"({length}) % {count}"
    return f"(({base}) * {number} + greatest(0, {number} - {count} + ({more})))", f"(({base}) + if(({more}) > {short}, 1, 0))"


def _keys(k: int, less: int) -> list[tuple[int, int, str]]:
    """(segment, shift, SQL of the key) that a line of length n uses for segments of lines with n - less characters and k edits."""
    out = []
    for i in range(k + 1):
        start, size = _segment(f"n - {less}", i, k + 1)
        low = 0 if less == 0 else max(-i, less - (k - i))
        for shift in range(low, min(i, less + (k - i)) + 1):
            out.append((i, shift, f"xxhash64({i}, n - {less}, substring(line, {start} + {shift + 1}, {size}))"))
    return out


def segment_keys(threshold: int, chars: int) -> str:
    """SQL array of a line's keys; columns line and n. Its own segments are the first threshold + 1 entries; unused entries are null."""
    long, short_own, short_other = [], ["null"] * (threshold + 1), []
    for k in range(1, threshold + 1):
        for less in range(k + 1):
            fits = f"{allowed_edits(f'n - {less}', threshold, chars)} = {k}"
            for i, shift, key in _keys(k, less):
                if less == 0 and shift == 0:
                    short_own[i] = f"if({fits}, {key}, {short_own[i]})"
                else:
                    short_other.append(f"if({fits}, {key}, null)")
    own = [key for i, shift, key in _keys(threshold, 0) if shift == 0]
    other = [key for less in range(threshold + 1) for i, shift, key in _keys(threshold, less) if less or shift]
    long = f"array({', '.join(own + other)})"
    return f"if(n >= {threshold * chars + threshold}, {long}, array({', '.join(short_own + short_other)}))"


def letter_counts(line: str, letters: str) -> str:
    """SQL for eight counts of letters in one long, each up to 255."""
    parts = [f"shiftleft(cast(least(255, length({line}) - length(replace({line}, '{c}', ''))) as bigint), {8 * j})" for j, c in enumerate(letters)]
    return " | ".join(parts)


def letters_apart(x: str, y: str) -> str:
    """SQL for the sum of differences of two packed counts: a lower bound of twice the edit distance."""
    return " + ".join(f"abs((shiftrightunsigned({x}, {8 * j}) & 255) - (shiftrightunsigned({y}, {8 * j}) & 255))" for j in range(8))


def banded_distance(x: Column, y: Column, k: int) -> Column:
    """Edit distance of two arrays of characters if at most k, else k + 1; needs longer arrays than k.

    The 2k + 1 cells around the diagonal are one word: bit d of step i stands for character i - k + d of a against
    character i of b. up and down hold where the cell below is greater or less by one; the score follows the
    lower edge of the band until that reaches the end of a, and then the last row.
    """
    width = 2 * k + 1
    mask = (1 << width) - 1
    m, n = F.size(x), F.size(y)

    def step(s: Column, i: Column) -> Column:
        c = F.get(y, i)
        hit = F.lit(0).cast("long")
        for d in range(width):
            hit = hit.bitwiseOR(F.when(F.get(x, i - k + d) == c, 1 << d).otherwise(0).cast("long"))
        up, down = s["up"], s["down"]
        same = F.lit(mask).cast("long")
        zero = ((hit.bitwiseAND(up) + up).bitwiseXOR(up)).bitwiseOR(hit).bitwiseOR(down).bitwiseAND(same)
        return F.struct(s["up"].alias("up"), s["down"].alias("down"), s["score"].alias("score"), zero.alias("zero"), i.alias("i"))

    def move(s: Column) -> Column:
        same, up, down, zero, i = F.lit(mask).cast("long"), s["up"], s["down"], s["zero"], s["i"]
        plus = down.bitwiseOR(F.bitwise_not(zero.bitwiseOR(up))).bitwiseAND(same)
        minus = zero.bitwiseAND(up)
        edge = i + k < m
        last = F.expr("cast(1 as long)")
        last = F.call_function("shiftleft", last, F.when(edge, F.lit(width - 1)).otherwise(m - 1 - i + k).cast("int"))
        score = s["score"] + F.when(edge, F.when(zero.bitwiseAND(last) == 0, 1).otherwise(0)).otherwise(F.when(plus.bitwiseAND(last) != 0, 1).otherwise(0) - F.when(minus.bitwiseAND(last) != 0, 1).otherwise(0))
        half = F.shiftrightunsigned(zero, 1)
        return F.struct(minus.bitwiseOR(F.bitwise_not(half.bitwiseOR(plus))).bitwiseAND(same).alias("up"), half.bitwiseAND(plus).alias("down"), score.cast("int").alias("score"))

    start = F.struct(F.lit(((1 << (k + 1)) - 1) << k).cast("long").alias("up"), F.lit(0).cast("long").alias("down"), F.lit(k).cast("int").alias("score"))
    end = F.aggregate(F.sequence(F.lit(0), n - 1), start, lambda s, i: _let(step(s, i), move))
    return F.least(end["score"], F.lit(k + 1))


def _common(equal: Callable[[Column], Column], most: Column) -> Column:
    """The greatest length up to most at which equal(length) holds, by bisection; it holds for all shorter ones."""

    def halve(s: Column, _: Column) -> Column:
        half = F.ceil((s["low"] + s["high"]) / 2).cast("int")
        return _let(half, lambda h: F.when(equal(h), F.struct(h.alias("low"), s["high"].alias("high"))).otherwise(F.struct(s["low"].alias("low"), (h - 1).alias("high"))))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(most + 1)).cast("int"))
    return F.aggregate(steps, F.struct(F.lit(0).alias("low"), most.cast("int").alias("high")), halve)["low"]


def within(a: Column, b: Column, limit: Column, threshold: int) -> Column:
    """Whether the edit distance of two texts, both longer than 3 * threshold, is at most limit, which is at most threshold.

    Only what lies between the common beginning and end is compared, with threshold + 1 more characters on either side.
    """
    na, nb, more = F.length(a), F.length(b), threshold + 1
    most = F.least(na, nb)
    begin = _common(lambda n: F.left(a, n) == F.left(b, n), most)

    def rest(p: Column) -> Column:
        end = _common(lambda n: F.substr(a, na - n + 1, n) == F.substr(b, nb - n + 1, n), most - p)
        return _let(F.struct(F.greatest(p - more, F.lit(0)).alias("p"), F.greatest(end - more, F.lit(0)).alias("s")), middle)

    def middle(c: Column) -> Column:
        inner = lambda t, n: F.substr(t, c["p"] + 1, n - c["p"] - c["s"])
        return _let(F.struct(inner(a, na).alias("x"), inner(b, nb).alias("y")), lambda t: _let(F.struct(F.split(t["x"], "").alias("x"), F.split(t["y"], "").alias("y")), lambda q: banded_distance(q["x"], q["y"], threshold) <= limit))

    return (F.abs(na - nb) <= limit) & _let(begin, rest)


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, pos, line, n, h1, h2) of each line that has a word; h1 and h2 together name its content."""
    split = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("pos", "line"))
    return split.where(F.col("line").rlike(WORD)).select("id", "pos", "line", F.length("line").alias("n"), F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def _lists(lines: DataFrame, threshold: int, chars: int) -> DataFrame:
    """(key, at, own, owner, first, size) of lists with two lines and more: each line once, the earliest owner and line of its list."""
    keyed = lines.where(F.col("n") >= chars).select("id", "pos", "h1", F.posexplode(F.expr(segment_keys(threshold, chars))).alias("slot", "key")).where("key is not null")
    keyed = keyed.select("key", "h1", "id", "pos", (F.col("slot") <= threshold).alias("own"))
    whole = Window.partitionBy("key")
    several = keyed.withColumns({"low": F.min("h1").over(whole), "high": F.max("h1").over(whole)}).where("low <> high").drop("low", "high")
    before = F.lag("h1").over(whole.orderBy("h1", F.desc("own"), "id", "pos"))
    once = several.withColumn("before", before).where("before is null or before <> h1").select("key", F.struct("id", "pos").alias("at"), "own")
    return once.withColumns({"owner": F.min(F.when(F.col("own"), F.col("at"))).over(whole), "first": F.min("at").over(whole), "size": F.count("*").over(whole)}).where("owner is not null")


def _texts(docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(at, line, s1, s2) of the lines at (id, pos), with their packed letter counts."""
    places = members.groupBy(F.col("at.id").alias("__id")).agg(F.collect_list("at.pos").alias("__pos"))
    rows = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__t")).join(places.hint("merge"), "__id")
    picked = _let(F.split("__t", "\n"), lambda lines: F.transform("__pos", lambda p: F.struct(p.alias("pos"), F.get(lines, p).alias("line"))))
    found = rows.select("__id", F.explode(picked).alias("p")).select(F.struct(F.col("__id").alias("id"), "p.pos").alias("at"), F.col("p.line").alias("line")).where("line is not null")
    return found.withColumns({f"s{i + 1}": F.expr(letter_counts("line", letters)) for i, letters in enumerate(LETTERS)})


def _near(pairs: DataFrame, texts: DataFrame, threshold: int, chars: int) -> DataFrame:
    """(at) of the later line of each (a, b) pair that is near."""
    side = lambda name: texts.select(F.col("at").alias(name), F.col("line").alias(f"l{name}"), *[F.col(f"s{i}").alias(f"s{i}{name}") for i in (1, 2)])
    apart = F.expr(f"{letters_apart('s1a', 's1b')} + {letters_apart('s2a', 's2b')}")
    # neither side has a proven bound, so none is broadcast, however few pairs a small input has
    both = pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b").where(apart <= 2 * threshold)
    limit = F.least(F.lit(threshold), F.floor(F.least(F.length("la"), F.length("lb")) / chars)).cast("int")
    return both.where(within(F.col("la"), F.col("lb"), limit, threshold)).select(F.col("b").alias("at")).distinct()


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, chars_an_edit: int = CHARS_AN_EDIT) -> DataFrame:
    """(id, pos) of each line to remove, pos from 0.

    Lines are parts between line feeds; those shorter than chars_an_edit go only if an equal one stands earlier, and lines
    without a word stay. Null texts have no lines; rows with a null id
    neither lose lines nor make others go; rows that repeat an id count as one document with the lines of both. An
    empty table gives no rows.
    """
    if threshold < 1 or chars_an_edit < 3 * threshold + 1:
        raise ValueError("lines need more characters than three times the threshold for each edit")
    lines = _lines(docs, id_col, text_col)
    named = lines.select("id", "pos", "n", "h1", "h2")
    firsts = cut(named.groupBy("h1", "h2").agg(F.first("n").alias("n"), F.min(F.struct("id", "pos")).alias("first"), F.count("*").alias("times")).where("times > 1"))
    equal = named.join(firsts.drop("n"), ["h1", "h2"]).where((F.col("id") != F.col("first.id")) | (F.col("pos") != F.col("first.pos"))).select("id", "pos")

    hot = F.broadcast(firsts.where(F.col("n") >= chars_an_edit).orderBy(F.desc("times"), "h1", "h2").limit(HOT_LINES).select("h1", "h2", "first"))
    some = lines.join(hot, ["h1", "h2"], "left").where(F.col("first").isNull() | ((F.col("id") == F.col("first.id")) & (F.col("pos") == F.col("first.pos"))))
    lists = cut(_lists(some, threshold, chars_an_edit))
    texts = cut(_texts(docs, lists.select("at").distinct(), id_col, text_col))

    stars = lists.select(F.explode(F.array(F.struct(F.col("owner").alias("x"), F.col("at").alias("y")), F.struct(F.when(F.col("own"), F.col("first")).alias("x"), F.col("at").alias("y")))).alias("p")).select("p.*").where("x <> y")
    stars = stars.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    settled = cut(_near(stars, texts, threshold, chars_an_edit))

    large = lists.where("size > 2").join(texts.select("at", "s1", "s2"), "at")
    late = large.join(settled, "at", "left_anti").select("key", F.col("at").alias("b"), F.col("own").alias("own_b"), F.col("s1").alias("s1b"), F.col("s2").alias("s2b"))
    early = large.select("key", F.col("at").alias("a"), F.col("own").alias("own_a"), "owner", "first", F.col("s1").alias("s1a"), F.col("s2").alias("s2a"))
    untried = F.expr("a < b and (own_a or own_b) and a <> owner and b <> owner and not (own_b and a = first)")
    close = F.expr(f"{letters_apart('s1a', 's1b')} + {letters_apart('s2a', 's2b')} <= {2 * threshold}")
    more = cut(early.join(late, "key").where(untried & close).select("a", "b").distinct())
    drop(lists)
    near = settled.unionByName(_near(more, texts, threshold, chars_an_edit)).select("at.id", "at.pos")
    return equal.unionByName(near).distinct()


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, chars_an_edit: int = CHARS_AN_EDIT) -> DataFrame:
    """(id, n_lines, n_removed, removed) of each row: removed lists the line numbers, from 0, in order. Null texts have no lines."""
    gone = duplicate_lines(docs, id_col, text_col, threshold, chars_an_edit).groupBy("id").agg(F.array_sort(F.collect_list("pos")).alias("removed"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.size(F.split(F.col(text_col).cast("string"), "\n")), F.lit(0)).cast("long").alias("n_lines"))
    found = rows.join(gone, "id", "left")
    return found.select(F.col("id").alias(id_col), F.when(F.col("n_lines") > 0, F.col("n_lines")).otherwise(0).alias("n_lines"), F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD, chars_an_edit: int = CHARS_AN_EDIT) -> DataFrame:
    """docs with the duplicate lines taken out of the text; every row and column stays, a text may become empty."""
    gone = duplicate_lines(docs, id_col, text_col, threshold, chars_an_edit).groupBy(F.col("id").alias("__id")).agg(F.array_sort(F.collect_list("pos")).alias("__gone"))
    joined = docs.join(gone, F.col(id_col).cast("long") == F.col("__id"), "left")
    # stretches between removed lines, so that the work is linear in the number of lines
    begins = F.concat(F.array(F.lit(0)), F.transform("__gone", lambda p: p + 1))

    def stretches(lines: Column) -> Column:
        ends = F.concat("__gone", F.array(F.size(lines)))
        return F.flatten(F.zip_with(begins, ends, lambda b, e: F.slice(lines, b + 1, F.greatest(e - b, F.lit(0)))))

    kept = _let(F.split(F.col(text_col).cast("string"), "\n"), stretches)
    text = F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    return joined.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])
