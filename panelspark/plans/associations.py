"""Queries over all pairs of features."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import associations as A
from panelspark.operators import stats as S
from panelspark.plans.catalogue import query, table

#: Price and its sums with tax are one measure; so are the two day columns.
NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "charge", "p_size", "ship_days")
CATEGORICAL = ("l_returnflag", "l_linestatus", "p_brand", "p_type", "o_orderpriority", "o_orderstatus")
FEATURES = A.Features(NUMERIC, CATEGORICAL, (("l_extendedprice", "charge"),))

BASE = """base as (select l_quantity, l_extendedprice, l_discount, l_tax, l_extendedprice * (1 + l_tax) as charge, p_size::double as p_size, date_diff('day', o_orderdate, l_shipdate)::double as ship_days,
  l_returnflag, l_linestatus, p_brand, p_type, o_orderpriority, o_orderstatus from lineitem join part on p_partkey = l_partkey join orders on o_orderkey = l_orderkey)"""
NUM_PAIRS = [p for p in combinations(NUMERIC, 2) if FEATURES.apart(*p)]


def ranked(source: str = "base", names: tuple[str, ...] = NUMERIC) -> str:
    return f"select *, {', '.join(f'rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2 as r_{c}' for c in names)} from {source}"


def clipped(names: tuple[str, ...] = NUMERIC) -> str:
    bounds = ", ".join(f"quantile_cont({c}, {p}) as q{round(100 * p)}_{c}" for c in names for p in (0.01, 0.99, 0.10, 0.90))
    values = ", ".join(f"greatest(least({c}, q{100 - low}_{c}), q{low}_{c}) as {kind}_{c}" for c in names for kind, low in (("trimmed", 1), ("robust", 10)))
    return f"select base.*, {values} from base, (select {bounds} from base)"


def h_of(source: str, number: str, category: str, least: int) -> str:
    """One row (groups, n, h, n1, r1, n2) of the ranks of a number over the levels of least rows; all its rows are in such levels here."""
    return f"""(select count(*) as groups, sum(n)::double as n, 12 / (sum(n) * (sum(n) + 1.0)) * sum(s * s / n) / (1 - any_value(ties) / (pow(sum(n), 3) - sum(n))) as h, arg_max(n, g)::double as n2, arg_max(r, g) as r2, arg_min(n, g)::double as n1
  from (select {category} as g, count(*) as n, sum(r_{number}) as r, sum(r_{number} - (select (count(*) + 1) / 2 from {source})) as s from {source} where {category} is not null group by 1 having count(*) >= {least}), (select sum(pow(c, 3) - c) as ties from (select count(*)::double as c from {source} group by {number})))"""


RANKED = f"clipped as ({clipped()}), ranked as ({ranked('clipped')})"
T = "{0} * sqrt((count(*) - 2) / (1 - {0} * {0}))"
NUM = "num as (" + " union all ".join(f"select '{a}' as a, '{b}' as b, 'num_num' as kind, count(*) as n, 'spearman' as measure, round(corr(r_{a}, r_{b}), 4) as value, round(corr({a}, {b}), 4) as pearson, round(corr(trimmed_{a}, trimmed_{b}), 4) as trimmed, round(corr(robust_{a}, robust_{b}), 4) as robust, round({T.format(f'corr(r_{a}, r_{b})')}, 4) as statistic, count(*) - 2.0 as dof from ranked" for a, b in NUM_PAIRS) + ")"


def chi(source: str, pairs: list[tuple[str, str]], name: str) -> str:
    """Tables name_cells, name_full and name (a, b, n, r, k, chi2, v) of pairs of categories; Yates' correction at one degree of freedom."""
    cells = " union all ".join(f"select '{a}' as a, '{b}' as b, {a} as x, {b} as y, count(*) as o from {source} where {a} is not null and {b} is not null group by all" for a, b in pairs)
    return f"""{name}_cells as ({cells}), {name}_full as (select r.a, r.b, r.x, s.y, r.rx * s.cy / r.n as e, r.n, r.k, s.m, coalesce(c.o, 0) as o from (select a, b, x, sum(o) as rx, sum(sum(o)) over (partition by a, b) as n, count(*) over (partition by a, b) as k from {name}_cells group by a, b, x) r
  join (select a, b, y, sum(o) as cy, count(*) over (partition by a, b) as m from {name}_cells group by a, b, y) s on s.a = r.a and s.b = r.b left join {name}_cells c on c.a = r.a and c.b = r.b and c.x = r.x and c.y = s.y),
{name}_sums as (select a, b, any_value(n) as n, any_value(k) as r, any_value(m) as k, sum(pow(case when k = 2 and m = 2 then greatest(abs(o - e) - 0.5, 0) else o - e end, 2) / e) as chi2 from {name}_full group by a, b),
{name} as (select *, round(sqrt(greatest(0, chi2 / n - (r - 1) * (k - 1) / (n - 1)) / least(r - pow(r - 1, 2) / (n - 1) - 1, k - pow(k - 1, 2) / (n - 1) - 1)), 4) as v from {name}_sums)"""


NONE = "null::double"
CAT = f"""{chi('base', list(combinations(CATEGORICAL, 2)), 'chi')}, cat as (select a, b, 'cat_cat' as kind, n::bigint as n, 'cramers_v' as measure, v as value, {NONE} as pearson, {NONE} as trimmed, {NONE} as robust, round(chi2, 4) as statistic, ((r - 1) * (k - 1))::double as dof from chi)"""
MIX = "mix_groups as (" + " union all ".join(f"select '{a}' as a, '{b}' as b, {b} as g, count(*) as n, avg({a}) as m, var_pop({a}) as s from base where {a} is not null and {b} is not null group by {b}" for a in NUMERIC for b in CATEGORICAL) + f"""),
mix_t as (select a, b, sum(n) as n, sum(n * m) / sum(n) as m, sum(n * m * m) as q, sum(n * s) as w from mix_groups group by a, b),
mix_h as ({" union all ".join(f"select '{a}' as a, '{b}' as b, h, groups from {h_of('ranked', a, b, 3)}" for a in NUMERIC for b in CATEGORICAL)}),
mix as (select a, b, 'num_cat' as kind, n::bigint as n, 'eta' as measure, round(sqrt(greatest(q - n * m * m, 0) / (greatest(q - n * m * m, 0) + w)), 4) as value, {NONE} as pearson, {NONE} as trimmed, {NONE} as robust, round(h, 4) as statistic, groups - 1.0 as dof from mix_t join mix_h using (a, b))"""
PAIRS = f"""{BASE}, {RANKED}, {NUM}, {CAT}, {MIX}, pairs as (select *, case when abs(value) < 0.2 then 'negligible' when abs(value) < 0.4 then 'weak' when abs(value) < 0.6 then 'moderate' when abs(value) < 0.8 then 'strong' when value is not null then 'very_strong' end as strength,
  coalesce(greatest(abs(value), abs(pearson)) > 0.95, false) as tautology from (select * from num union all select * from cat union all select * from mix))"""


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderpriority", "o_orderstatus")
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_size")
    rows = l.join(o, "l_orderkey").join(p, "l_partkey")
    return rows.withColumns({"charge": F.col("l_extendedprice") * (1 + F.col("l_tax")), "p_size": F.col("p_size").cast("double"), "ship_days": F.datediff("l_shipdate", "o_orderdate").cast("double")}).select(*NUMERIC, *CATEGORICAL)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.pairwise_associations(base(spark, sf_dir), FEATURES)


@query("pairwise_associations", f"with {PAIRS} select * from pairs")
def pairwise_associations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7. SQL has the tests' statistics and degrees of freedom; p-values follow from these alone and are tested beside published ones."""
    return pairs(spark, sf_dir).drop("p_value", "q_value")


@query("non_linear_pairs", f"with {PAIRS}, g as (select a, b, n, value as spearman, pearson, round(abs(value) - abs(pearson), 4) as gap from pairs where kind = 'num_num'), one as (select n, spearman, pearson, gap, min((a, b)) as p from g where gap >= 0.0001 group by n, spearman, pearson, gap) select p[1] as a, p[2] as b, n, spearman, pearson, gap from one order by gap desc, p limit 25")
def non_linear_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8, U3."""
    return A.non_linear(A.numeric_pairs(base(spark, sf_dir), FEATURES), 0.0001)


@query("pair_summary", f"with {PAIRS} select kind, count(*) as pairs, count(value) as computed, count(*) filter (strength in ('strong', 'very_strong')) as strong, count(*) filter (tautology) as tautologies from pairs group by kind")
def pair_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.pair_summary(pairs(spark, sf_dir)).drop("significant")


TARGET = "l_extendedprice"
OTHERS = [c for c in NUMERIC if c != TARGET and FEATURES.apart(c, TARGET)]
TARGET_SQL = f"""with {BASE}, priced as (select * from base where {TARGET} > 0), ranked as ({ranked('priced')}), t as (
  {" union all ".join(f"select '{c}' as feature, 'numeric' as kind, 'spearman' as test, null::int as groups, count(*) as n, round({T.format(f'corr(r_{c}, r_{TARGET})')}, 4) as statistic, count(*) - 2.0 as dof, round(corr(r_{c}, r_{TARGET}), 4) as effect_size from ranked" for c in OTHERS)}
  union all {" union all ".join(f"select '{c}', case when groups = 2 then 'boolean' else 'categorical' end, case when groups = 2 then 'mann_whitney_u' else 'kruskal_wallis' end, groups::int, n::bigint, round(case when groups = 2 then r2 - n2 * (n2 + 1) / 2 else h end, 4), case when groups > 2 then groups - 1.0 end, round(case when groups = 2 then 2 * (r2 - n2 * (n2 + 1) / 2) / (n1 * n2) - 1 else (h - groups + 1) / (n - groups) end, 4) from {h_of('ranked', TARGET, c, 30)}" for c in CATEGORICAL)})
select *, coalesce(abs(effect_size) > 0.95, false) as tautology, (row_number() over (order by abs(effect_size) desc, feature))::int as rank from t qualify rank <= 40"""
DIMENSION = "p_brand"
CATS = [c for c in CATEGORICAL if c != DIMENSION]
DIFFERING_SQL = f"""with {BASE}, largest as (select {DIMENSION} as g from base where {DIMENSION} is not null group by 1 having count(*) >= 10), kept as (select * from base where {DIMENSION} in (select g from largest)), ranked as ({ranked('kept')}), {chi('kept', [(c, DIMENSION) for c in CATS], 'chi')},
t as ({" union all ".join(f"select '{c}' as feature, 'numeric' as kind, 'kruskal_wallis' as test, groups::int as groups, n::bigint as n, round(h, 4) as statistic, groups - 1.0 as dof, round((h - groups + 1) / (n - groups), 4) as effect_size from {h_of('ranked', c, DIMENSION, 10)}" for c in NUMERIC)}
  union all select a, 'categorical', 'chi_square', k::int, n::bigint, round(chi2, 4), ((r - 1) * (k - 1))::double, v from chi where v is not null)
select '{DIMENSION}' as dimension, *, coalesce(abs(effect_size) > 0.95, false) as tautology, (row_number() over (order by abs(effect_size) desc, feature))::int as rank from t"""


@query("target_associations", TARGET_SQL)
def target_associations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12, Q19: price against every feature but its own aliases; p-values as in ``pairwise_associations``."""
    return A.target_associations(base(spark, sf_dir), FEATURES, TARGET).drop("p_value", "p_holm")


@query("differentiating_features", DIFFERING_SQL)
def differentiating_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q18: what tells the brands apart."""
    return A.differentiating_features(base(spark, sf_dir), FEATURES, DIMENSION).drop("p_value", "p_holm")


@query("feature_profiles", f"with {BASE} " + " union all ".join(f"select '{c}' as feature, 'numeric' as kind, count({c}) as filled, round(100.0 * count({c}) / count(*), 4) as filled_pct, count(distinct {c}) as distinct, round(avg({c}), 4) as mean, round(min({c}), 4) as least, round(max({c}), 4) as greatest, null as top_level, null::double as top_pct from base" for c in ("l_quantity", "l_discount", "l_tax", "p_size", "ship_days"))
       + "".join(f" union all select '{c}', 'categorical', count({c}), round(100.0 * count({c}) / count(*), 4), count(distinct {c}), null, null, null, (select {c} from base where {c} is not null group by {c} order by count(*) desc, {c} desc limit 1), round(100.0 * (select max(n) from (select count(*) as n from base where {c} is not null group by {c})) / count(*), 4) from base" for c in CATEGORICAL))
def feature_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q15."""
    return A.feature_profiles(base(spark, sf_dir), A.Features(("l_quantity", "l_discount", "l_tax", "p_size", "ship_days"), CATEGORICAL))


@query("level_distribution", f"with {BASE}, c as (" + " union all ".join(f"select '{c}' as feature, {c} as level, count(*) as n from base where {c} is not null group by {c}" for c in CATEGORICAL) + ") select feature, level, n, round(100.0 * n / sum(n) over (partition by feature), 4) as share_pct, row_number() over (partition by feature order by n desc, level) as rank, n >= 10 as sufficient from c qualify rank <= 25")
def level_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q16."""
    return A.level_distribution(base(spark, sf_dir), FEATURES)


SHAPES = (("l_quantity", "l_extendedprice"), ("l_discount", "l_tax"), ("p_size", "ship_days"))


@query("relationship_shapes", f"with {BASE}, {RANKED}, c as (" + " union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 4) as p, round(corr(r_{a}, r_{b}), 4) as s, (select round(corr(greatest(least({a}, x2), x1), greatest(least({b}, y2), y1)), 4) from base, (select quantile_cont({a}, 0.01) as x1, quantile_cont({a}, 0.99) as x2, quantile_cont({b}, 0.01) as y1, quantile_cont({b}, 0.99) as y2 from base)) as t from ranked" for a, b in SHAPES)
       + ") select a, b, p as pearson, s as spearman, t as trimmed_pearson, case when p is null or s is null then 'not_computed' when abs(s) - abs(p) > 0.1 then case when abs(t) - abs(p) > 0.1 then 'linear_within_trimmed_range' else 'monotone_nonlinear' end when abs(s) < 0.2 then 'no_detected_association' when abs(p) >= 0.2 then 'approximately_linear' else 'weak_or_unclear' end as shape from c")
def relationship_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6 without the sampled distance correlation."""
    both = A.numeric_pairs(base(spark, sf_dir), FEATURES, pairs=list(SHAPES)).select("a", "b", "pearson", F.col("value").alias("spearman"), F.col("trimmed").alias("trimmed_pearson"))
    return both.withColumn("shape", S.shape_name(F.col("pearson"), F.col("spearman"), F.lit(None).cast("double"), F.col("trimmed_pearson")))
