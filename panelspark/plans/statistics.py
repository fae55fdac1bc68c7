"""Queries over profiles, segments, missingness and rank statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import panel as P
from panelspark.operators import profile as R
from panelspark.operators import stats as S
from panelspark.plans.catalogue import query, table

SEGMENTS = """b as (select l_extendedprice as v, 'p_brand' as dimension, p_brand as level from last join part on p_partkey = l_partkey union all select l_extendedprice, 'p_type', p_type from last join part on p_partkey = l_partkey),
r as (select *, row_number() over (partition by dimension, level order by v) - 1 as k, count(*) over (partition by dimension, level) as n from b),
s as (select *, floor(n * 0.1) as cut, greatest(0, least(floor((n - 1.959963984540054 * sqrt(n)) / 2), n - 1)) as lo, greatest(0, least(ceil(1 + (n + 1.959963984540054 * sqrt(n)) / 2) - 1, n - 1)) as hi from r where n >= 10)
select dimension, level, any_value(n) as n, round(median(v), 4) as median, round(avg(v), 4) as mean, round(quantile_cont(v, 0.25), 4) as p25, round(quantile_cont(v, 0.75), 4) as p75, round(min(v), 4) as min, round(max(v), 4) as max, round(stddev_samp(v), 4) as sd,
  round(avg(v) filter (k >= cut and k < n - cut), 4) as trimmed_mean, round(quantile_cont(v, 0.75) - quantile_cont(v, 0.25), 4) as iqr, round(max(v) filter (k = lo), 4) as median_ci_low, round(max(v) filter (k = hi), 4) as median_ci_high from s group by dimension, level"""
LAST = """last as (select l_partkey, l_extendedprice from (select *, row_number() over (partition by l_orderkey order by l_shipdate desc, l_linenumber desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) as rn from lineitem where l_shipdate <= timestamp '1998-06-30') where rn = 1)"""


@query("price_by_segment", f"with {LAST}, {SEGMENTS}")
def price_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 over J2: prices of each order's latest line as of an instant, by brand and type of the part."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    last = P.latest_as_of(lines, "l_orderkey", ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], F.col("l_shipdate") <= F.lit("1998-06-30").cast("timestamp"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    return R.segment_statistics(last.join(parts, "l_partkey"), ["p_brand", "p_type"], "l_extendedprice")


PCT = ", ".join(f"round(quantile_cont(value, {p}), 4) as {n}" for p, n in zip(R.PERCENTILES, ("p01", "p05", "p10", "p25", "median", "p75", "p90", "p95", "p99")))


@query("numeric_profile", f"""with l as (select unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax']) as variable, unnest([l_quantity, l_extendedprice, l_discount, l_tax]) as value from lineitem)
select variable, count(value) as count, count(*) filter (value is null) as missing, round(100.0 * avg((value is null)::int), 2) as missing_pct, round(avg(value), 4) as mean, round(stddev_samp(value), 4) as std, round(min(value), 4) as min, round(max(value), 4) as max, round(skewness(value), 4) as skewness,
  {PCT}, round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 4) as iqr, count(*) filter (value = 0) as zeros, count(*) filter (value < 0) as negatives, count(distinct value) as "distinct", case when abs(skewness(value)) > 1 then 'skewed; prefer the median' end as note from l group by variable""")
def numeric_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.numeric_profile(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query("categorical_distribution", """with l as (select unnest(['p_brand', 'p_type']) as variable, unnest([p_brand, p_type]) as value from part), c as (select variable, value, count(*) as n from l group by all),
r as (select *, sum(n) over (partition by variable) as total, row_number() over (partition by variable order by n desc, value) as rank from c)
select variable, value, n, round(100.0 * n / total, 4) as share_pct, n >= 10 as sufficient, rank from r where rank <= 10""")
def categorical_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.categorical_distribution(table(spark, sf_dir, "part"), ["p_brand", "p_type"])


@query("composition", """with l as (select unnest(['o_orderstatus', 'o_orderpriority']) as dimension, unnest([nullif(o_orderstatus, 'P'), o_orderpriority]) as value from orders), t as (select dimension, count(*) as total, count(value) as known from l group by 1)
select dimension, value, count(*) as n, round(100.0 * count(*) / any_value(known), 4) as share_known_pct, round(100.0 * count(*) / any_value(total), 4) as share_total_pct, round(100.0 * any_value(known) / any_value(total), 4) as coverage_pct from l join t using (dimension) where value is not null group by all""")
def composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), "o_orderpriority")
    return R.composition(rows, ["o_orderstatus", "o_orderpriority"])


@query("cross_tab", "select c_mktsegment, c_nationkey, count(*) as n, round(median(c_acctbal), 4) as median from customer group by all")
def cross_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.cross_tab(table(spark, sf_dir, "customer"), "c_mktsegment", "c_nationkey", "c_acctbal")


@query("inventory_summary", "select count(*) as rows, count(distinct o_custkey) as customers, min(o_orderdate) as first_day, max(o_orderdate) as last_day, count(*) filter (o_orderstatus = 'F') as final, round(min(o_totalprice), 2) as least, round(max(o_totalprice), 2) as most from orders")
def inventory_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").agg(F.count("*").alias("rows"), F.count_distinct("o_custkey").alias("customers"), F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day"), F.count_if(F.col("o_orderstatus") == "F").alias("final"), F.round(F.min("o_totalprice"), 2).alias("least"), F.round(F.max("o_totalprice"), 2).alias("most"))


@query("market_statistics", """select n_name, count(*) as orders, round(avg((o_orderstatus = 'F')::int), 4) as removal_rate, round(median(o_totalprice), 4) as median_price, round(avg((o_totalprice > 200000)::int), 4) as high_share from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey group by n_name""")
def market_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("n_nationkey") == F.col("c_nationkey")).select(F.col("c_custkey").alias("o_custkey"), "n_name")
    rows = table(spark, sf_dir, "orders").join(people, "o_custkey")
    return rows.groupBy("n_name").agg(F.count("*").alias("orders"), F.round(F.avg((F.col("o_orderstatus") == "F").cast("int")), 4).alias("removal_rate"), F.round(F.median("o_totalprice"), 4).alias("median_price"), F.round(F.avg((F.col("o_totalprice") > 200000).cast("int")), 4).alias("high_share"))


@query("comparable_segments", """select p_brand, p_type, case when p_size < 10 then 'small' when p_size < 30 then 'middle' else 'large' end as size_band, count(*) as n, round(median(l_extendedprice), 4) as median_price, round(avg((l_returnflag = 'R')::int), 4) as return_rate from lineitem join part on p_partkey = l_partkey group by all having count(*) >= 10""")
def comparable_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    from panelspark.functions.columns import band

    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", band(F.col("p_size"), [float("-inf"), 10, 30, float("inf")], ["small", "middle", "large"]).alias("size_band"))
    rows = table(spark, sf_dir, "lineitem").select("l_partkey", "l_extendedprice", "l_returnflag").join(parts, "l_partkey")
    return rows.groupBy("p_brand", "p_type", "size_band").agg(F.count("*").alias("n"), F.round(F.median("l_extendedprice"), 4).alias("median_price"), F.round(F.avg((F.col("l_returnflag") == "R").cast("int")), 4).alias("return_rate")).where("n >= 10")


ENRICHED = "e as (select d.doc_id, d.lang, l.quality, l.toxic, nullif(d.source, 'src1') as source, case when d.n_chars > 1000 then d.n_chars end as n_chars, null::varchar as blank from documents d left join labels l on l.doc_id = d.doc_id)"


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels where there are any."""
    labels = table(spark, sf_dir, "labels")
    return table(spark, sf_dir, "documents").select("doc_id", "lang", F.nullif("source", F.lit("src1")).alias("source"), F.when(F.col("n_chars") > 1000, F.col("n_chars")).alias("n_chars")).join(labels, "doc_id", "left").withColumn("blank", F.lit(None).cast("string"))


FIELDS = ["lang", "source", "n_chars", "quality", "toxic", "blank"]


@query("completeness", f"""with {ENRICHED}, l as (select unnest({FIELDS}) as variable, unnest([lang, source, n_chars::varchar, quality::varchar, toxic::varchar, blank]) as value from e)
select variable, count(value) as filled, round(100.0 * (1 - count(value) / count(*)), 4) as missing_pct, count(distinct value) as "distinct", count(distinct value) = 1 as constant, count(value) / count(*) >= 0.05 and count(distinct value) > 1 as usable,
  case when count(value) = 0 then 'all_null' when count(value) / count(*) < 0.05 then 'low_coverage' when count(distinct value) <= 1 then 'constant' end as reason from l group by variable""")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.completeness(enriched(spark, sf_dir), FIELDS)


@query("missing_patterns", f"""with {ENRICHED} select (case when source is null then '1' else '0' end) || (case when n_chars is null then '1' else '0' end) || (case when quality is null then '1' else '0' end) as pattern, count(*) as n from e group by 1""")
def missing_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.missing_patterns(enriched(spark, sf_dir), ["source", "n_chars", "quality"])


@query("missing_by_group", f"""with {ENRICHED}, l as (select lang, unnest(['source', 'n_chars', 'quality']) as variable, unnest([source, n_chars::varchar, quality::varchar]) as value from e) select lang, variable, round(100.0 * avg((value is null)::int), 4) as missing_pct from l group by all""")
def missing_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.missing_by_group(enriched(spark, sf_dir), "lang", ["source", "n_chars", "quality"])


@query("enrichment_coverage", "select count(*) as documents, count(l.doc_id) as matched, round(100.0 * count(l.doc_id) / count(*), 4) as matched_pct from documents d left join labels l on l.doc_id = d.doc_id")
def enrichment_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir).agg(F.count("*").alias("documents"), F.count("quality").alias("matched"), F.round(100.0 * F.count("quality") / F.count("*"), 4).alias("matched_pct"))


@query("calibration", """with s as (select least(1.0, n_chars / 5000.0) as score, quality from documents join labels using (doc_id)), b as (select least(floor(score * 10), 9)::bigint as band, count(*) as n, avg(quality) as rate, sum(count(*)) over () as total from s group by 1)
select band, n, round(case when n >= 10 then rate end, 4) as rate from b where total >= 40""")
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", F.least(F.lit(1.0), F.col("n_chars") / 5000.0).alias("score")).join(table(spark, sf_dir, "labels"), "doc_id")
    return R.calibration(rows, "score", "quality")


@query("pivot_long", "select o_custkey, " + ", ".join(f"min(o_totalprice) filter (o_orderpriority = '{p}') as \"{p}\"" for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")) + " from orders group by o_custkey")
def pivot_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.pivot_long(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", "o_totalprice", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])


@query("spec_catalogue", "select p_type, count(*) as n, count(distinct p_partkey) as keys, count(distinct p_brand) as distinct_values from part group by p_type")
def spec_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.catalogue_of(table(spark, sf_dir, "part"), "p_type", "p_brand", "p_partkey")


@query("stratified_sample", "select doc_id, lang from (select doc_id, lang, row_number() over (partition by lang order by doc_id) as n from documents) where n <= 25")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    return table(spark, sf_dir, "documents").select("doc_id", "lang", F.row_number().over(Window.partitionBy("lang").orderBy("doc_id")).alias("n")).where("n <= 25").drop("n")


@query("fastest_by_value", "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' order by o_totalprice desc, o_orderkey limit 50")
def fastest_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50).select("o_orderkey", "o_totalprice")


@query("label_ingest", """select case when d.doc_id is null then 'rejected' when l.quality is null then 'skipped' else 'accepted' end as outcome, count(*) as n from labels l left join (select doc_id from documents where coalesce(trim(text), '') <> '') d on d.doc_id = l.doc_id group by 1""")
def label_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: ids of a document with a text are known and accepted with a valid outcome."""
    known = table(spark, sf_dir, "documents").where("coalesce(trim(text), '') <> ''").select("doc_id", F.lit(True).alias("known"))
    rows = table(spark, sf_dir, "labels").join(known, "doc_id", "left")
    return rows.groupBy(F.when(F.col("known").isNull(), "rejected").when(F.col("quality").isNull(), "skipped").otherwise("accepted").alias("outcome")).agg(F.count("*").alias("n"))


RANKS = """p as (select l_quantity as x, l_extendedprice as y, 'l_quantity' as a, 'l_extendedprice' as b from lineitem union all select l_discount, l_tax, 'l_discount', 'l_tax' from lineitem),
k as (select *, rank() over (partition by a, b order by x) + (count(*) over (partition by a, b, x) - 1) / 2 as rx, rank() over (partition by a, b order by y) + (count(*) over (partition by a, b, y) - 1) / 2 as ry from p)"""


@query("correlations", f"""with {RANKS} select a, b, count(*) as n, round(corr(x, y), 4) as pearson, round(corr(rx, ry), 4) as spearman,
  case when abs(corr(rx, ry)) < 0.2 then 'negligible' when abs(corr(rx, ry)) < 0.4 then 'weak' when abs(corr(rx, ry)) < 0.6 then 'moderate' when abs(corr(rx, ry)) < 0.8 then 'strong' else 'very_strong' end as strength from k group by a, b""")
def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.correlations(table(spark, sf_dir, "lineitem"), [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax")]).drop("p_value")


@query("cramers_v", """with c as (select c_mktsegment as a, o_orderpriority as b, count(*) as o from orders join customer on c_custkey = o_custkey group by all), g as (select r.a, s.b, coalesce(c.o, 0) as o from (select distinct a from c) r cross join (select distinct b from c) s left join c on c.a = r.a and c.b = s.b),
e as (select *, sum(o) over (partition by a) * sum(o) over (partition by b) / sum(o) over () as ex, sum(o) over () as n from g), t as (select any_value(n) as n, count(distinct a) as r, count(distinct b) as k, sum((o - ex) * (o - ex) / ex) as chi2 from e)
select 'c_mktsegment' as variable_a, 'o_orderpriority' as variable_b, n::bigint as n, r as levels_a, k as levels_b, (r - 1) * (k - 1) as dof, round(chi2, 4) as chi2, round(sqrt(greatest(0, chi2 / n - (r - 1) * (k - 1) / (n - 1)) / least(r - pow(r - 1, 2) / (n - 1) - 1, k - pow(k - 1, 2) / (n - 1) - 1)), 4) as cramers_v from t""")
def cramers_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    return S.cramers_v(table(spark, sf_dir, "orders").join(people, "o_custkey"), "c_mktsegment", "o_orderpriority").drop("p_value")


@query("correlation_ratio", """with g as (select p_brand, count(*) as n, avg(l_extendedprice) as m, var_pop(l_extendedprice) as v from lineitem join part on p_partkey = l_partkey group by 1), t as (select sum(n) as n, sum(n * m) / sum(n) as m, sum(n * m * m) as s, sum(n * v) as w, count(*) as groups from g)
select n::bigint as n, groups, round(sqrt((s - n * m * m) / (s - n * m * m + w)), 4) as eta from t""")
def correlation_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return S.correlation_ratio(table(spark, sf_dir, "lineitem").join(parts, "l_partkey"), "p_brand", "l_extendedprice")


@query("trimmed_correlation", """with b as (select quantile_cont(l_quantity, 0.01) as x1, quantile_cont(l_quantity, 0.99) as x2, quantile_cont(l_extendedprice, 0.01) as y1, quantile_cont(l_extendedprice, 0.99) as y2 from lineitem)
select count(*) as n, round(corr(greatest(least(l_quantity, x2), x1), greatest(least(l_extendedprice, y2), y1)), 4) as trimmed_pearson from lineitem cross join b""")
def trimmed_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.trimmed_correlation(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice")


@query("group_differences", """with b as (select l_extendedprice as v, 'l_returnflag' as dimension, l_returnflag as g from lineitem union all select l_extendedprice, 'l_linestatus', l_linestatus from lineitem),
r as (select *, rank() over (partition by dimension order by v) + (count(*) over (partition by dimension, v) - 1) / 2 as rk from b), s as (select dimension, g, count(*)::double as n, sum(rk) as R from r group by all),
t as (select dimension, sum(c * c * c - c)::double as ties from (select dimension, v, count(*)::double as c from b group by all) group by dimension),
p as (select dimension, count(*) as groups, sum(n) as N, sum(R * R / n) as S, arg_min(n, g) as n1, arg_min(R, g) as R1, arg_max(n, g) as n2 from s group by dimension)
select dimension, case when groups = 2 then 'mann_whitney_u' else 'kruskal_wallis' end as test, groups, N::bigint as n,
  round(case when groups = 2 then R1 - n1 * (n1 + 1) / 2 else (12 / (N * (N + 1)) * S - 3 * (N + 1)) / (1 - ties / (N * N * N - N)) end, 4) as statistic,
  round(case when groups = 2 then 2 * (R1 - n1 * (n1 + 1) / 2) / (n1 * n2) - 1 else ((12 / (N * (N + 1)) * S - 3 * (N + 1)) / (1 - ties / (N * N * N - N)) - groups + 1) / (N - groups) end, 4) as effect_size from p join t using (dimension)""")
def group_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.group_differences(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice").drop("p_value", "p_holm")


@query("multiple_testing", """with t as (select event_type, count(*) as n, avg(value) as m, stddev_samp(value) as s from events group by 1), p as (select event_type, round(least(1.0, abs(m - 50) / s), 6) as p_value from t),
h as (select *, row_number() over (order by p_value) as r, count(*) over () as c from p)
select event_type, p_value, round(max(least(1.0, (c - r + 1) * p_value)) over (order by r), 6) as p_holm, round(min(least(1.0, p_value * c / r)) over (order by r desc), 6) as p_bh from h""")
def multiple_testing(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "events").groupBy("event_type").agg(F.round(F.least(F.lit(1.0), F.abs(F.avg("value") - 50) / F.stddev_samp("value")), 6).alias("p_value"))
    return S.benjamini_hochberg(S.holm(p, "p_value"), "p_value")


@query("distance_correlation")
def distance_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.distance_correlation(table(spark, sf_dir, "orders"), "o_orderkey", [("o_totalprice", "o_custkey"), ("o_custkey", "o_orderkey")])


@query("association_matrix", f"""with {RANKS}, c as (select a, b, round(corr(rx, ry), 4) as v from k group by a, b) select a as variable, b as other, v as spearman from c union all select b, a, v from c union all select distinct a, a, 1.0 from (select a from c union select b from c)""")
def association_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9 in long form: both directions and the unit diagonal."""
    c = S.correlations(table(spark, sf_dir, "lineitem"), [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax")]).select("a", "b", "spearman")
    names = c.select(F.explode(F.array("a", "b")).alias("variable")).distinct()
    return c.select(F.col("a").alias("variable"), F.col("b").alias("other"), "spearman").unionByName(c.select(F.col("b").alias("variable"), F.col("a").alias("other"), "spearman")).unionByName(names.select("variable", F.col("variable").alias("other"), F.lit(1.0).alias("spearman")))
