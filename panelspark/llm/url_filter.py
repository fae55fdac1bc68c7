"""URLs judged by rules of host and path and, where no rule fits, by logistic regression on hashed character n-grams.

All of it runs in the JVM: hosts and paths are cut by string functions, their characters become n-grams that are
hashed to a vector of fixed size, and Spark's logistic regression is fitted on a small table of labelled URLs. The model's size
doesn't depend on the corpus and judging needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Lengths of the n-grams, entries of the hashed vector, weight of the penalty, and the probability from which a URL is blocked.
GRAMS, FEATURES, PENALTY, BLOCK_AT = (3, 4, 5), 1 << 15, 0.0001, 0.5
#: Rules that go into the plan as a literal; a longer table of rules is a DataFrame and is joined.
LITERAL_RULES = 1_000

#: (verdict, rule) of the query.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

#: Words of the labelled table: hosts are made from them by the rule of ``labelled_urls``.
BLOCKED = (
    "ads adserver track tracker banner clicks popup casino poker bet bets betting slots jackpot lottery win roulette pills pill pharmacy viagra dose adult adults porn xxx sex escort cams spam spammer farm linkfarm links "
    "loan loans payday cash cheap free bonus replica crack warez keygen torrents"
).split()
ALLOWED = (
    "news daily library school college museum health science weather recipes garden music history cooking travel sports market forum review open source city county park river mountain paper books letters theatre radio "
    "journal institute research teacher children family village bridge station weekend morning evening nature energy water stone green silver north south eastern western the other another rather nation motion session "
    "thought shares houses horses thing ring ending reading winter window author trading farming addition bakery cinema dental district engineering federal gallery harbour island kitchen language medical national "
    "observatory parliament quarterly railway society technology university valley wildlife academy archive atlas ballet biology castle chess choir climate council economy festival geology grammar guild"
).split()
FRONTS, TLDS, LANGS = ("", "www.", "m.", "blog."), ("com", "net", "org"), ("en", "de", "fr", "es")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or a text without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where there is no host's place."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(url, label 1 or 0): hosts of one word and of two joined by a hyphen. Every name comes with the same fronts, top-level domains and paths, so these
    tell nothing about the label."""
    def hosts(words: list[str], label: int) -> DataFrame:
        names = words + [f"{a}-{b}" for k in (1, 7) for a, b in zip(words, words[k:] + words[:k], strict=True)]
        return spark.range(1).select(F.explode(F.array(*map(F.lit, names))).alias("name"), F.lit(label).alias("label"))

    settings = [(front, tld, f"/{LANGS[(i + j) % len(LANGS)]}/{37 * i + 11 * j}") for i, front in enumerate(FRONTS) for j, tld in enumerate(TLDS)]
    setting = F.explode(F.array(*(F.struct(F.lit(a).alias("front"), F.lit(b).alias("tld"), F.lit(c).alias("path")) for a, b, c in settings)))
    named = hosts(BLOCKED, 1).unionByName(hosts(ALLOWED, 0)).coalesce(1).withColumn("at", setting)
    return named.select(F.concat(F.lit("https://"), "at.front", "name", F.lit("."), "at.tld", "at.path").alias("url"), "label")


def _marked(grams: str, mark: str) -> Column:
    return F.transform(grams, lambda g: F.concat(F.lit(mark), g))


def _features(urls: DataFrame, features: int) -> DataFrame:
    """Adds __features: which n-grams the columns __host and __path hold, each with its own marks of beginning and end."""
    grams = []
    for name in ("host", "path"):
        chars = F.when(F.length(f"__{name}") > 0, F.split(F.concat(F.lit("\x02"), F.col(f"__{name}"), F.lit("\x03")), "")).otherwise(F.array().cast("array<string>"))
        urls = urls.withColumn(f"__{name}_chars", chars)
        for n in GRAMS:
            urls = NGram(n=n, inputCol=f"__{name}_chars", outputCol=f"__{name}_{n}").transform(urls)
            grams.append(_marked(f"__{name}_{n}", name[0]))
    return HashingTF(numFeatures=features, binary=True, inputCol="__grams", outputCol="__features").transform(urls.withColumn("__grams", F.concat(*grams)))


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "label", features: int = FEATURES, penalty: float = PENALTY, iterations: int = 60) -> LogisticRegressionModel:
    """Logistic regression with an L2 penalty. Rows with a null label don't count; a null url has no n-grams. Labels other than 0 count as 1."""
    rows = labelled.where(F.col(label_col).isNotNull()).select((F.col(label_col) != 0).cast("double").alias("__label"), host_of(F.col(url_col)).alias("__host"), path_of(F.col(url_col)).alias("__path"))
    fit = LogisticRegression(featuresCol="__features", labelCol="__label", rawPredictionCol="__raw", probabilityCol="__probability", predictionCol="__prediction", regParam=penalty, standardization=False, maxIter=iterations, tol=1e-9)
    return fit.fit(_features(rows, features).select("__label", "__features"))


def _parts(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.translate(str.maketrans(UPPER, UPPER.lower())), slash + path


def _literal_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(size, rule, verdict) of the longest rule that fits, of equally long ones the first in order of text; else null."""
    by_host: dict[str, list[Column]] = {}
    for verdict, rule in sorted({(v, r) for v, r in rules}, key=lambda x: (-len(x[1]), x[1], x[0])):
        by_host.setdefault(_parts(rule)[0], []).append(F.struct(F.lit(-len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"), F.lit(_parts(rule)[1]).alias("path")))
    table = F.create_map(*(x for h, found in by_host.items() for x in (F.lit(h), F.array(*found))))
    labels = max(h.count(".") + 1 for h in by_host)
    fitting = [F.get(F.filter(F.coalesce(table[F.substring_index(host, ".", -k)], F.array()), lambda r: F.startswith(path, r["path"])), 0) for k in range(1, labels + 1)]
    return F.array_min(F.array_compact(F.array(*fitting))) if len(fitting) > 1 else fitting[0]


def _joined_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds __rule by equi-joins: each distinct host and path meets the rules under its host suffixes and path prefixes of the lengths that rules have.

    The lengths are collected: at most labels of a host times lengths of a rule's path.
    """
    slash = F.instr("rule", "/")
    host = F.translate(F.when(slash > 0, F.substring_index("rule", "/", 1)).otherwise(F.col("rule")), UPPER, UPPER.lower())
    path = F.when(slash > 0, F.substr(F.col("rule"), slash)).otherwise("")
    table = rules.where("rule is not null and verdict is not null").groupBy(host.alias("__h"), path.alias("__p")).agg(F.min(F.struct((-F.length("rule")).alias("size"), "rule", "verdict")).alias("__rule"))
    shapes = table.select(F.size(F.split("__h", r"\.")).alias("k"), F.length("__p").alias("n")).distinct().collect()
    keys = F.array(*(F.struct(F.substring_index("__host", ".", -s["k"]).alias("h"), F.substring("__path", 1, s["n"]).alias("p")) for s in shapes)) if shapes else F.array().cast("array<struct<h:string,p:string>>")
    found = urls.select("__host", "__path").distinct().withColumn("__key", F.explode(F.array_distinct(keys))).join(table, (F.col("__key.h") == F.col("__h")) & (F.col("__key.p") == F.col("__p")))
    best = found.groupBy("__host", "__path").agg(F.min("__rule").alias("__rule"))
    return urls.join(best, ["__host", "__path"], "left")


def judge(pages: DataFrame, model: LogisticRegressionModel, rules: Iterable[tuple[str, str]] | DataFrame = (), id_col: str = "page_id", url_col: str = "url", block_at: float = BLOCK_AT) -> DataFrame:
    """(id, host, path, rule, verdict, score) of each row: verdict is that of the longest fitting rule, else the model's.

    rules: (verdict, rule) pairs, up to LITERAL_RULES of them, or a DataFrame of these two columns of any size. A rule ``host/path``
    fits its host and all hosts below it, where the path of the url starts with the rule's; a host alone fits any path. score is
    the model's probability to block; a url without any n-gram (null, no ``://``, an empty host and path) is allowed with score null. Null and repeated ids and
    repeated urls are kept row for row, urls of any length are read whole, other columns of pages are ignored, no rows give no rows.
    """
    urls = pages.select(F.col(id_col).alias("__id"), host_of(F.col(url_col).cast("string")).alias("__host"), path_of(F.col(url_col).cast("string")).alias("__path"))
    if isinstance(rules, DataFrame):
        urls = _joined_rule(urls, rules)
    else:
        rules = list(rules)
        if len(rules) > LITERAL_RULES:
            raise ValueError(f"give more than {LITERAL_RULES} rules as a DataFrame of verdict and rule")
        urls = urls.withColumn("__rule", _literal_rule(F.col("__host"), F.col("__path"), rules) if rules else F.lit(None).cast("struct<size:int,rule:string,verdict:string>"))
    scored = model.transform(_features(urls, model.numFeatures))
    score = F.when(F.size("__grams") > 0, vector_to_array("__probability")[1])
    verdict = F.coalesce(F.col("__rule.verdict"), F.when(score >= block_at, "block").otherwise("allow"))
    return scored.select(F.col("__id").alias(id_col), F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule.rule").alias("rule"), verdict.alias("verdict"), score.alias("score"))
