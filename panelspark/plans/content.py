"""Queries over text, URLs, numbers, merged records, re-listings and integrity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.functions import columns as C
from panelspark.operators import entity as E
from panelspark.operators import merge as M
from panelspark.operators import quality as Q
from panelspark.operators import text as T
from panelspark.plans import frames
from panelspark.plans.catalogue import query, table
from panelspark.plans.frames import OBS


@query("normalised_numbers", """with n as (select *, nullif(regexp_extract(n_chars::varchar, '[0-9]{3,4}'), '')::integer as y from documents)
select doc_id, n_chars::varchar as digits, nullif(n_chars, 0) as price, case when doc_id % 7 = 0 then 0 else n_chars end as mileage, case when y between 1300 and 1450 then y when y between 1900 and 2100 then y - 621 end as jalali from n""")
def normalised_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1, F4-F7 on numbers written in Persian digits with a unit, read back; a year is the first three or four digits."""
    rows = table(spark, sf_dir, "documents").select("doc_id", F.translate(F.col("n_chars").cast("string"), C.ASCII_DIGITS, C.PERSIAN_DIGITS).alias("shown"))
    spaced = F.concat(F.lit("  "), F.col("shown"), F.lit(" ​ "))
    return rows.select("doc_id", C.normalize_text(spaced).alias("digits"), C.price(F.concat("shown", F.lit(" تومان"))).alias("price"), C.mileage(F.when(F.col("doc_id") % 7 == 0, F.lit("صفر کیلومتر")).otherwise(F.concat("shown", F.lit(" km")))).alias("mileage"), C.year_pair(F.col("shown"))["jalali"].alias("jalali"))


@query("relative_times", """select event_id, floor(epoch(ts))::bigint - (event_id % 6 + 1) * case event_id % 3 when 0 then 60 when 1 then 3600 else 86400 end as published from events""")
def relative_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: '<n> <unit> ago' in Persian against each row's own time."""
    unit = F.element_at(F.array(F.lit("دقیقه"), F.lit("ساعت"), F.lit("روز")), (F.col("event_id") % 3 + 1).cast("int"))
    said = F.concat(F.translate((F.col("event_id") % 6 + 1).cast("string"), C.ASCII_DIGITS, C.PERSIAN_DIGITS), F.lit(" "), unit, F.lit(" پیش"))
    return table(spark, sf_dir, "events").select("event_id", C.relative_time(said, F.unix_seconds(F.col("ts").cast("timestamp"))).alias("published"))


@query("parsed_measures", "select p_partkey, p_retailprice as number, 'kg' as unit, case when p_size % 2 = 0 then true when p_size % 3 = 0 then false end as flag, -p_size::bigint as signed, lower(replace(p_name, ' ', '_')) as slug from part")
def parsed_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F12, F15-F18 on texts made of part columns."""
    p = table(spark, sf_dir, "part")
    m = C.measure(F.concat(F.col("p_retailprice").cast("string"), F.lit(" kg")))
    word = F.when(F.col("p_size") % 2 == 0, "yes").when(F.col("p_size") % 3 == 0, "ندارد").otherwise("?")
    return p.select("p_partkey", m["number"].alias("number"), m["unit"].alias("unit"), C.boolean_word(word).alias("flag"), C.signed_amount(F.concat(F.lit("-"), F.col("p_size"))).alias("signed"), C.slug(F.col("p_name")).alias("slug"))


@query("canonical_urls", r"""with u as (select page_id, url, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) as host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) as path, regexp_extract(url, '\?([^#]*)', 1) as q from pages),
k as (select *, list_filter(string_split(q, '&'), lambda p: regexp_matches(p, '^[^=]+=.+') and lower(split_part(p, '=', 1)) not in ('ref', 'from', 'source', 'utm_source', 'utm_medium', 'campaign', 'cid')) as kept from u)
select page_id, 'https://' || regexp_replace(lower(host), '^www\.', '') || regexp_replace(path, '/+$', '') || case when len(kept) > 0 then '?' || array_to_string(kept, '&') else '' end as canonical, nullif(regexp_extract(path, '/([0-9]+)', 1), '') as id from k""")
def canonical_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", C.canonical_url(F.col("url")).alias("canonical"), C.id_from_url(F.col("url"), "/([0-9]+)").alias("id"))


@query("contact_leaks", "select 'text' as \"column\", count(*) filter (" + " or ".join(f"regexp_matches(text, '{p}')" for p in (r"(^|[^0-9a-fA-F])0?9\d{9}($|[^0-9a-fA-F])", r"\b0\d{2,3}[-\s]?\d{7,8}\b", r"https?://\S+", r"@[A-Za-z0-9_]{3,}", r"\b[\w.+-]+@[\w-]+\.[\w.]+\b", r"(?i)(?:t\.me|telegram|whatsapp)\S*")) + ") as leaks from documents")
def contact_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.leak_report(table(spark, sf_dir, "documents"), ["text"])


@query("scrubbed_leaks", "select 'text' as \"column\", 0 * count(*) as leaks from documents")
def scrubbed_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """after scrubbing no contact is left in any document."""
    return T.leak_report(table(spark, sf_dir, "documents").select(C.scrub(F.col("text")).alias("text")), ["text"])


@query("description_statistics", r"""with m as (select length(text) as chars, len(list_filter(regexp_split_to_array(text, '[ \t\n\r\f\v]+'), lambda w: w <> '')) as words, len(list_filter(regexp_split_to_array(text, '[.!?\n]+'), lambda s: trim(s) <> '')) as sentences from documents where text is not null)
select count(*) as texts, round(median(chars), 4) as median_chars, round(quantile_cont(chars, 0.9), 4) as p90_chars, round(median(words), 4) as median_words, round(quantile_cont(words, 0.9), 4) as p90_words, round(median(sentences), 4) as median_sentences, round(quantile_cont(sentences, 0.9), 4) as p90_sentences from m""")
def description_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.description_statistics(table(spark, sf_dir, "documents"), "text")


@query("frequent_bigrams", r"""with w as (select doc_id, list_filter(string_split(text, ' '), lambda x: x <> '') as w from documents), g as (select doc_id, unnest(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) as term from w where len(w) >= 2)
select term, count(*)::bigint as n, count(distinct doc_id) as texts from g group by term order by n desc, term limit 50""")
def frequent_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.frequent_ngrams(table(spark, sf_dir, "documents"), "doc_id", F.filter(F.split("text", " "), lambda x: x != ""), 2)


@query("frequent_tokens")
def frequent_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q24 with F27's tokens, whose joined words need Unicode word classes that the SQL side lacks."""
    return T.frequent_ngrams(table(spark, sf_dir, "documents"), "doc_id", C.tokens(F.col("text")), 1)


@query("duplicate_texts", r"""with t as (select doc_id, trim(regexp_replace(lower(text), '[ \t\n\r\f\v]+', ' ', 'g')) as t from documents) select sha256(t) as text_hash, count(*) as n, min(doc_id) as first_key from t where length(t) >= 40 group by t having count(*) > 1""")
def duplicate_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.exact_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")


PHRASES = ("Licensed under", "Released under the MIT License", "the ", "los ")


@query("phrase_counts", " union all ".join(f"select '{p}' as phrase, count(*) filter (contains(text, '{p}')) as texts from documents" for p in PHRASES))
def phrase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.phrase_counts(table(spark, sf_dir, "documents"), "text", PHRASES)


@query("length_by_group", "select lang, count(*) as n, round(median(length(text)), 4) as median_chars, round(quantile_cont(length(text), 0.25), 4) as p25_chars, round(quantile_cont(length(text), 0.75), 4) as p75_chars from documents where text is not null group by lang")
def length_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.length_by_group(table(spark, sf_dir, "documents"), "lang", "text")


@query("filter_exits", """select o_orderkey, case when nullif(o_totalprice, 0) < 50000 - 1000 then 'price_below_filter' when o_totalprice > 300000 + 1000 then 'price_above_filter' when year(o_orderdate) - 621 < 1376 then 'year_outside_filter' else 'search_index_inconsistency' end as reason from orders where o_orderstatus = 'P'""")
def filter_exits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first search bound that an absent but live row fails, else the index is to blame."""
    reason = C.filter_reason(F.col("o_totalprice"), F.year("o_orderdate"), 50000, 300000, 1376, None, 1000)
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select("o_orderkey", F.coalesce(reason, F.lit("search_index_inconsistency")).alias("reason"))


@query("filter_exit_summary", """with r as (select o_orderpriority, o_totalprice, case when o_totalprice < 49000 then 'price_below_filter' when o_totalprice > 301000 then 'price_above_filter' end as reason from orders)
select reason, o_orderpriority, count(*) as n, round(median(o_totalprice), 4) as median_price from r where reason is not null group by grouping sets ((reason), (o_orderpriority), ())""")
def filter_exit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice", C.filter_reason(F.col("o_totalprice"), F.lit(None).cast("int"), 50000, 300000, epsilon=1000).alias("reason")).where("reason is not null")
    return rows.groupingSets([["reason"], ["o_orderpriority"], []], "reason", "o_orderpriority").agg(F.count("*").alias("n"), F.round(F.median("o_totalprice"), 4).alias("median_price"))


@query("publication_truncation", """with f as (select l_orderkey, min(l_shipdate) as seen from lineitem group by 1), d as (select o_orderkey, epoch(seen) - epoch(o_orderdate) as delay, o_orderpriority in ('1-URGENT', '2-HIGH') as good from orders left join f on l_orderkey = o_orderkey)
select o_orderkey, good and coalesce(delay >= -3600, false) as reliable, not coalesce(delay >= -3600 and delay <= 864000, false) as left_truncated, good and coalesce(delay >= -3600 and delay <= 864000, false) as eligible, case when delay >= -3600 then delay end::double as entry_delay_seconds from d""")
def publication_truncation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First shipment as first sighting, order date as publication."""
    seen = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("seen"))
    rows = table(spark, sf_dir, "orders").join(seen, "o_orderkey", "left")
    return rows.select("o_orderkey", C.truncation_status(F.col("o_orderdate"), F.col("o_orderpriority"), F.col("seen"), ("1-URGENT", "2-HIGH"), 864000).alias("t")).select("o_orderkey", "t.*")


@query("priority_targets", f"""with {OBS}, t as (select ad_id, 0 as priority from (select ad_id, min(run_id) as f from obs group by 1) where f > 19730 union all select ad_id, 1 from (select ad_id, max(run_id) as l from obs group by 1) where l < 19750
  union all select distinct ad_id, 2 from obs where price < 5), b as (select ad_id, min(priority) as priority from t group by 1) select ad_id, priority from b order by priority, ad_id limit 40""")
def priority_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20: tagged sets united, the best tag a key, capped by priority."""
    obs = frames.observations(spark, sf_dir)
    ends = obs.groupBy("ad_id").agg(F.min("run_id").alias("f"), F.max("run_id").alias("l"))
    tag = lambda df, n: df.select("ad_id", F.lit(n).alias("priority"))
    tagged = tag(ends.where("f > 19730"), 0).unionByName(tag(ends.where("l < 19750"), 1)).unionByName(tag(obs.where("price < 5"), 2))
    return tagged.groupBy("ad_id").agg(F.min("priority").alias("priority")).orderBy("priority", "ad_id").limit(40)


@query("merged_records", """with a as (select c_custkey as k, c_name as name, c_mktsegment as segment from customer), h as (select c_custkey as k, case when c_custkey % 3 = 0 then upper(c_name) when c_custkey % 3 = 1 then c_name || '!' else c_name end as name, case when c_custkey % 7 = 0 then 'OTHER' when c_custkey % 11 <> 0 then c_mktsegment end as segment from customer where c_custkey in (select o_custkey from orders))
select coalesce(a.k, h.k) as c_custkey, coalesce(a.name, h.name) as name, coalesce(h.segment, a.segment) as segment,
  case when a.name is null and h.name is null then '-' when h.name is null then 'A' when a.name is null then 'H' when a.name = h.name then 'B' else 'A' end as name_source,
  case when a.segment is null and h.segment is null then '-' when h.segment is null then 'A' when a.segment is null then 'H' when a.segment = h.segment then 'B' else 'H' end as segment_source,
  coalesce((a.name <> h.name)::int, 0) + coalesce((a.segment <> h.segment)::int, 0) as conflicts from a full join h on a.k = h.k""")
def merged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged(spark, sf_dir).withColumn("conflicts", F.size("conflicts"))


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source A has all customers, source H those with an order, some spelt otherwise or without a segment."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    a = c.select("c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    buyers = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    h = c.join(buyers, "c_custkey", "left_semi").select("c_custkey", F.when(k % 3 == 0, F.upper("c_name")).when(k % 3 == 1, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name")).alias("name"), F.when(k % 7 == 0, "OTHER").when(k % 11 != 0, F.col("c_mktsegment")).alias("segment"))
    return M.merge_records(a, h, "c_custkey", [M.Rule("name"), M.Rule("segment", first="H", severity="critical")])


@query("merge_report", """with a as (select c_custkey as k, c_name as name, c_mktsegment as segment from customer), h as (select c_custkey as k, case when c_custkey % 3 = 0 then upper(c_name) when c_custkey % 3 = 1 then c_name || '!' else c_name end as name, case when c_custkey % 7 = 0 then 'OTHER' when c_custkey % 11 <> 0 then c_mktsegment end as segment from customer where c_custkey in (select o_custkey from orders)),
m as (select a.name <> h.name as n, a.segment <> h.segment as s from a full join h on a.k = h.k)
select 'name' as field, 'minor' as severity, count(*) filter (n) as n, round(count(*) filter (n) / count(*), 6) as share, true as passes from m union all select 'segment', 'critical', count(*) filter (s), round(count(*) filter (s) / count(*), 6), count(*) filter (s) / count(*) < 0.01 from m""")
def merge_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.merge_report(merged(spark, sf_dir))


@query("merged_children", """select coalesce(a.k, b.k) as k, coalesce(a.p, b.p) as p, coalesce(a.v, b.v) as v, case when a.k is not null and b.k is not null then 'both' when a.k is not null then 'first' else 'second' end as source
from (select l_orderkey as k, l_linenumber as p, max(l_quantity) as v from lineitem where l_returnflag = 'A' group by all) a full join (select l_orderkey as k, l_linenumber as p, max(l_tax) as v from lineitem where l_returnflag = 'R' group by all) b on a.k = b.k and a.p = b.p""")
def merged_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")
    side = lambda flag, c: l.where(F.col("l_returnflag") == flag).groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("p")).agg(F.max(c).alias("v"))
    return M.merge_children(side("A", "l_quantity"), side("R", "l_tax"), ["k", "p"], ["v"])


@query("nested_export", """select c_custkey, coalesce(o.n, 0) as orders, coalesce(o.first_key, -1) as first_key from customer left join (select o_custkey, count(*)::integer as n, min(o_orderkey) as first_key from orders group by 1) o on o_custkey = c_custkey""")
def nested_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record a customer with its orders inlined; counted and read back here."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    record = M.nest(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", {"orders": (orders, ["o_orderkey", "o_totalprice"])})
    return record.select("c_custkey", F.coalesce(F.size("orders"), F.lit(0)).alias("n"), F.coalesce(F.try_element_at("orders", F.lit(1))["o_orderkey"], F.lit(-1)).alias("first_key")).select("c_custkey", F.when(F.col("n") < 0, 0).otherwise(F.col("n")).alias("orders"), "first_key")


@query("integrity_audit", """select 'duplicate_order' as "check", 'critical' as severity, count(*) as count from (select 1 from orders group by o_orderkey having count(*) > 1)
union all select 'duplicate_line', 'critical', count(*) from (select 1 from lineitem group by l_orderkey, l_linenumber having count(*) > 1)
union all select 'zero_price', 'warning', count(*) filter (o_totalprice = 0) from orders union all select 'negative_price', 'critical', count(*) filter (o_totalprice < 0) from orders union all select 'before_start', 'warning', count(*) filter (o_orderdate < timestamp '1995-02-01') from orders
union all select 'conflicting_status', 'warning', count(*) from (select 1 from orders group by o_custkey having count(distinct o_orderstatus) > 1) union all select 'provenance_columns', 'critical', 1""")
def integrity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, l = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    price = F.col("o_totalprice")
    return Q.audit([
        Q.duplicates(o, ["o_orderkey"], "duplicate_order"), Q.duplicates(l, ["l_orderkey", "l_linenumber"], "duplicate_line"),
        Q.count_where(o, [("zero_price", Q.WARNING, price == 0), ("negative_price", Q.CRITICAL, price < 0), ("before_start", Q.WARNING, F.col("o_orderdate") < F.lit("1995-02-01").cast("timestamp_ntz"))]),
        Q.conflicting(o, "o_custkey", "o_orderstatus", "conflicting_status"), Q.columns_present(o, ["o_orderkey", "run_id"])])


LISTINGS = """listings as (select o_orderkey as platform_ad_id, 'https://example.org/car/' || case when o_orderkey % 97 = 0 then 'zz' else o_orderkey::varchar end as canonical_url, o_orderdate as first_seen_at, o_orderdate + to_days((o_orderkey % 11)::int - 1) as last_seen_at,
  case when o_custkey % 3 = 0 then o_orderdate + to_days((o_custkey % 7)::int) end as first_missing_at, o_orderdate + to_days((o_custkey % 9)::int) as snapshot_at, case o_orderkey % 6 when 0 then 'active' when 1 then 'new' when 2 then 'reappeared' when 3 then 'likely_removed' when 4 then 'likely_sold' end as current_status,
  case o_custkey % 50 when 0 then 'likely_sold' when 1 then 'highly_likely_sold' else 'not_sold' end as sale_label, o_totalprice - 2000 as price, (o_orderkey % 101) * 1000 - 1000 as mileage, 1295 + o_custkey % 160 as year, case when o_orderkey % 13 = 0 then 'price' end as filter_exit_reason from orders)"""
LISTING_AUDIT = (
    ("ad_id_url_mismatch", "error", "not contains(canonical_url, platform_ad_id::varchar)"), ("last_seen_before_first_seen", "error", "last_seen_at < first_seen_at"), ("disappearance_before_last_seen", "error", "current_status in ('likely_removed', 'likely_sold') and first_missing_at < last_seen_at"),
    ("negative_price", "error", "price < 0"), ("zero_price", "warning", "price = 0"), ("negative_mileage", "error", "mileage < 0"), ("implausible_production_year", "error", "year not between 1300 and 1450"),
    ("sale_label_inconsistent_with_status", "error", "current_status in ('active', 'new', 'reappeared') and sale_label in ('likely_sold', 'highly_likely_sold')"), ("confirmed_sale_label_present", "critical", "sale_label = 'confirmed_sold'"),
    ("filter_exit_counted_as_disappearance", "error", "filter_exit_reason is not null and current_status in ('likely_removed', 'likely_sold')"), ("price_below_search_lower_bound", "warning", "price > 0 and price < 500"), ("future_snapshot_leaked_into_cross_section", "critical", "snapshot_at > (select max(first_seen_at) from listings)"),
)


@query("listing_audit", f"with {LISTINGS}" + " union all ".join(f" select '{n}' as \"check\", '{s}' as severity, count(*) as count, coalesce(array_to_string(list_sort(list(platform_ad_id))[:5], ','), '') as samples from listings where {c}" for n, s, c in LISTING_AUDIT))
def listing_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: orders as listings, every check with its count and its first five ids."""
    o, key, cust = table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    day = lambda n: F.col("o_orderdate") + F.make_dt_interval(n.cast("int"))
    status = F.element_at(F.array(*[F.lit(x) for x in ("active", "new", "reappeared", "likely_removed", "likely_sold", None)]), (key % 6 + 1).cast("int"))
    listings = o.select(
        key.alias("platform_ad_id"), F.concat(F.lit("https://example.org/car/"), F.when(key % 97 == 0, "zz").otherwise(key.cast("string"))).alias("canonical_url"), F.col("o_orderdate").alias("first_seen_at"), day(key % 11 - 1).alias("last_seen_at"),
        F.when(cust % 3 == 0, day(cust % 7)).alias("first_missing_at"), day(cust % 9).alias("snapshot_at"), status.alias("current_status"), F.when(cust % 50 == 0, "likely_sold").when(cust % 50 == 1, "highly_likely_sold").otherwise("not_sold").alias("sale_label"),
        (F.col("o_totalprice") - 2000).alias("price"), ((key % 101) * 1000 - 1000).alias("mileage"), (1295 + cust % 160).alias("year"), F.when(key % 13 == 0, "price").alias("filter_exit_reason"))
    end = o.agg(F.max("o_orderdate").alias("m")).first().m
    return Q.findings(listings, Q.listing_checks(500, F.lit(end).cast("timestamp_ntz")), "platform_ad_id")


@query("temporal_audit", """select 'shipped_before_order' as "check", 'critical' as severity, count(*) filter (l_shipdate < o_orderdate) as count from lineitem join orders on o_orderkey = l_orderkey""")
def temporal_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event before its entity: equi-join with a residual predicate."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    return Q.count_where(rows, [("shipped_before_order", Q.CRITICAL, F.col("l_shipdate") < F.col("o_orderdate"))])


PROFILES = """prof as (select o_orderkey as id, p_brand || '|' || p_type || '|' || (p_size % 10) as tax, c_name as seller, (o_orderkey % 97) * 1000 as mileage, floor(o_totalprice / 1000)::bigint as price, c_nationkey as city, p_name as image, string_split(p_name, ' ')[1] as body, c_mktsegment as interior, o_orderdate as t0
  from orders join customer on c_custkey = o_custkey join part on p_partkey = o_orderkey % (select count(*) from part)),
cand as (select c.id as c_id, p.id as p_id from prof c join prof p on c.tax = p.tax and p.t0 < c.t0 union select c.id, p.id from prof c join prof p on c.seller = p.seller and p.t0 < c.t0
  union select c.id, p.id from prof c join prof p on c.image = p.image and c.city = p.city and c.interior = p.interior and p.t0 < c.t0),
s as (select c_id, p_id, round(least(1, 0.30 * (c.tax = p.tax)::int + 0.20 * (c.seller = p.seller)::int + 0.15 * (abs(c.mileage - p.mileage) <= 5000)::int + 0.10 * (p.price <> 0 and c.price <> 0 and abs(p.price - c.price) / greatest(p.price, 1) <= 0.12)::int + 0.05 * (c.city = p.city)::int
  + 0.20 * (c.image = p.image)::int + 0.05 * (c.body = p.body and c.interior = p.interior)::int), 4) as score from cand join prof c on c.id = c_id join prof p on p.id = p_id)"""


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as listings: the customer sells, the part gives taxonomy, colour and an image hash that differs by two bits at most."""
    n = table(spark, sf_dir, "part").count()
    o = table(spark, sf_dir, "orders").withColumn("p_partkey", F.col("o_orderkey") % n)
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "c_nationkey")
    rows = o.join(people, "o_custkey").join(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size", "p_name"), "p_partkey")
    image = F.concat(F.substring(F.md5("p_name"), 1, 15), (F.col("o_orderkey") % 4).cast("string"))
    return rows.select(F.col("o_orderkey").alias("id"), F.col("p_brand").alias("brand"), F.col("p_type").alias("model"), (F.col("p_size") % 10).cast("string").alias("year"), F.col("c_name").alias("seller"), ((F.col("o_orderkey") % 97) * 1000).alias("mileage"), F.floor(F.col("o_totalprice") / 1000).alias("price"), F.col("c_nationkey").cast("string").alias("city"), F.array(image).alias("images"), F.lit(None).cast("string").alias("description"), F.substring_index("p_name", " ", 1).alias("body_color"), F.col("c_mktsegment").alias("interior_color"), F.col("o_orderdate").alias("at"))


@query("relisting_pairs", f"with {PROFILES} select c_id, p_id, score from s where score >= 0.70")
def relisting_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 over every order as a child and every earlier one as a parent; the tables hold no descriptions, which a test covers."""
    rows = profiles(spark, sf_dir)
    return E.scored_pairs(rows, rows, order="at").select("c_id", "p_id", "score")


@query("relisting_matches", f"""with recursive {PROFILES},
g as (select * from s where score >= 0.70), ord as (select c_id, row_number() over (order by c_id) as i from (select distinct c_id from g)),
w as (select 0::bigint as i, [-1::bigint] as taken, -1::bigint as c_id, -1::bigint as p_id union all
  select o.i, case when b.p_id is null then w.taken else list_append(w.taken, b.p_id) end, o.c_id, coalesce(b.p_id, -1) from w join ord o on o.i = w.i + 1 left join lateral (select g.p_id from g where g.c_id = o.c_id and not list_contains(w.taken, g.p_id) order by g.score desc, g.p_id limit 1) b on true)
select c_id, p_id from w where p_id >= 0""")
def relisting_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profiles(spark, sf_dir)
    return E.matches(rows, rows, order="at").select("c_id", "p_id")


@query("entity_closure", """with recursive e as (select o_custkey as a, min(o_custkey) over (partition by o_orderdate, o_orderpriority) as b from orders), u as (select a, b from e where a <> b union select b, a from e where a <> b), r as (select a as node, b as reach from u union select r.node, u.b from r join u on u.a = r.reach)
select node, least(node, min(reach)) as entity from r group by node""")
def entity_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers who ordered on one day with one priority are linked, as stars around the least of them."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderpriority")
    least = orders.groupBy("o_orderdate", "o_orderpriority").agg(F.min("o_custkey").alias("b"))
    links = orders.join(least, ["o_orderdate", "o_orderpriority"]).select(F.col("o_custkey").alias("a"), "b")
    return E.entity_closure(links, "a", "b")


@query("json_numbers", "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def json_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a typed read of a JSON payload."""
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("year_inference", """with p as (select user_id, ts, event_id, month(ts) as m, lag(month(ts)) over (partition by user_id order by ts desc, event_id desc) as later from events)
select event_id, 2024 - sum(coalesce((m > later)::int, 0)) over (partition by user_id order by ts desc, event_id desc)::integer as inferred_year from p""")
def year_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest to oldest, a month greater than the later row's starts the year before."""
    w = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    rows = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", F.month("ts").alias("m")).withColumn("wrap", F.coalesce((F.col("m") > F.lag("m").over(w)).cast("int"), F.lit(0)))
    return rows.select("event_id", (F.lit(2024) - F.sum("wrap").over(w)).cast("int").alias("inferred_year"))
