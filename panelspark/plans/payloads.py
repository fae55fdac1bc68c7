"""Queries over JSON payloads, which are made of the supplied tables and read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.functions import columns as C
from panelspark.functions import listings as V
from panelspark.operators import payload as J
from panelspark.operators import text as T
from panelspark.plans.catalogue import query, table


def _contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested record a supplier with contact fields at two depths."""
    s = table(spark, sf_dir, "supplier")
    inner = F.struct(F.col("s_nationkey").alias("nation"), F.lit("021").alias("phone"), F.array(F.struct(F.col("s_acctbal").alias("balance"), F.lit("x").alias("email"))).alias("accounts"))
    return s.select("s_suppkey", F.to_json(F.struct(F.col("s_name").alias("name"), F.lit("091").alias("mobile"), inner.alias("seller"))).alias("payload"))


PATHS = """select s_suppkey, 'name' as path, s_name as value from supplier union all select s_suppkey, 'seller.nation', s_nationkey::varchar from supplier union all select s_suppkey, 'seller.accounts[0].balance', s_acctbal::varchar from supplier"""


@query("json_paths", f"{PATHS} union all select s_suppkey, 'mobile', '091' from supplier union all select s_suppkey, 'seller.phone', '021' from supplier union all select s_suppkey, 'seller.accounts[0].email', 'x' from supplier")
def json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F28, X5."""
    return J.flatten_json(_contacts(spark, sf_dir), "s_suppkey", "payload")


@query("stripped_paths", PATHS)
def stripped_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """what is left once private keys are gone at any depth."""
    rows = _contacts(spark, sf_dir).select("s_suppkey", J.strip_keys(F.col("payload")).alias("payload"))
    return J.flatten_json(rows, "s_suppkey", "payload")


def _specs() -> Column:
    item = lambda key, value, kind: F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"), F.lit(kind).alias("type"))
    size = F.concat(F.col("p_size"), F.lit(" cm"))
    body = F.struct(F.lit("Body").alias("name"), F.array(item("Outer Size", size, "String"), item("Outer Size", F.col("p_type"), "String"), item("Has Brand", F.when(F.col("p_size") % 2 == 0, "true").otherwise("false"), "Boolean")).alias("items"))
    price = F.struct(F.lit("Price").alias("name"), F.array(item("Outer Size", F.col("p_retailprice"), "String")).alias("items"))
    return F.to_json(F.struct(F.array(body, price).alias("groups")))


@query("specification_rows", """select p_partkey, 'Body' as "group", 0 as position, 'outer_size' as slug, p_size || ' cm' as text, null::boolean as boolean, p_size::double as number, 'cm' as unit from part
union all select p_partkey, 'Body', 1, 'outer_size_2', p_type, null, null, null from part union all select p_partkey, 'Body', 2, 'has_brand', (p_size % 2 = 0)::varchar, p_size % 2 = 0, null, null from part
union all select p_partkey, 'Price', 0, 'outer_size', p_retailprice::varchar, null, p_retailprice, null from part""")
def specification_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F41, W16."""
    return J.specification_rows(table(spark, sf_dir, "part").select("p_partkey", _specs().alias("payload")), "p_partkey", "payload")


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price payload a customer: one series a priority, its orders as points."""
    o = table(spark, sf_dir, "orders")
    point = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("at"), F.floor("o_totalprice").alias("price"), "o_orderkey")
    points = o.groupBy("o_custkey", "o_orderpriority").agg(F.array_sort(F.collect_list(point)).alias("h"))
    history = F.transform("h", lambda p: F.struct(p["at"].alias("at"), p["price"].alias("price")))
    item = F.struct(F.col("o_orderpriority").alias("detail"), F.when(F.col("o_orderpriority") < "3", "Free Market").otherwise("x factory").alias("provider"), history.alias("history"))
    return points.select("o_custkey", item.alias("i")).groupBy("o_custkey").agg(F.collect_list("i").alias("items")).select("o_custkey", F.to_json(F.struct("items")).alias("payload"))


POINTS = """pts as (select o_custkey, substr(sha1(o_custkey || '|' || o_orderpriority), 1, 16) as series_id, o_orderpriority as detail, case when o_orderpriority < '3' then 'market' else 'factory' end as provider_kind, (row_number() over (partition by o_custkey, o_orderpriority order by o_orderdate, floor(o_totalprice), o_orderkey) - 1)::integer as point, o_orderdate as "at", nullif(floor(o_totalprice)::bigint, 0) as price from orders)"""


@query("price_points", f"with {POINTS} select * from pts")
def price_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F43, W17."""
    return J.price_points(_series(spark, sf_dir), "o_custkey", "payload").withColumn("at", F.col("at").cast("timestamp_ntz"))


@query("series_sanity", f"with {POINTS}, s as (select o_custkey, count(*) as n, count(*) - count(distinct cast(pts.at as date)) as repeated from pts group by 1), r as (select c_custkey, (floor(c_acctbal)::bigint) % 20 as reported from customer) select count(*) as series, count(*) filter (n not between 2 and 400) as odd_size, 0::bigint as untimed_points, sum(repeated)::bigint as repeated_days, count(*) filter (n is distinct from reported) as differing_counts from s left join r on c_custkey = o_custkey")
def series_sanity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: a number of points that customers report is set beside those listed."""
    reported = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), (F.floor("c_acctbal") % 20).alias("reported"))
    return J.series_sanity(price_points(spark, sf_dir), "o_custkey", "at", reported)


@query("price_tree_paths", """with p as (select p_brand, p_type, p_name, floor(p_retailprice)::bigint as price, row_number() over (partition by p_brand, p_type, p_name order by p_partkey desc) as n from part)
select 1 as k, p_brand as path, 'brand' as level, null::bigint as price from part group by p_brand union all select 1, p_brand || '/' || p_type, 'model', null from part group by p_brand, p_type union all select 1, p_brand || '/' || p_type || '/' || p_name, 'trim', price from p where n = 1""")
def price_tree_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one tree payload a brand, trims of one name repeated."""
    p = table(spark, sf_dir, "part")
    trim = F.struct("p_partkey", F.col("p_name").alias("name"), F.floor("p_retailprice").alias("price"))
    models = p.groupBy("p_brand", "p_type").agg(F.array_sort(F.collect_list(trim)).alias("t"))
    model = F.struct(F.col("p_type").alias("name"), F.transform("t", lambda t: F.struct(t["name"].alias("name"), t["price"].alias("price"))).alias("trims"))
    brands = models.groupBy("p_brand").agg(F.collect_list(model).alias("models"))
    rows = brands.select(F.lit(1).alias("k"), F.to_json(F.struct(F.array(F.struct(F.col("p_brand").alias("name"), "models")).alias("brands"))).alias("payload"))
    return J.tree_paths(rows, "k", "payload")


@query("dealer_inventory", """select s_suppkey::varchar as dealer, s_name as name, case when s_suppkey % 50 <= 5 then (s_suppkey % 50)::double else (s_suppkey % 50) / 10 end as score, p_partkey::varchar as code, nullif(floor(p_retailprice)::bigint, 0) as price, p_size::bigint as mileage, p_partkey in (select l_partkey from lineitem where l_returnflag = 'A') as in_seed
from supplier join part on p_partkey % (select count(*) from supplier) = s_suppkey""")
def dealer_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts dealt over suppliers."""
    s = table(spark, sf_dir, "supplier")
    n = s.count()
    listing = F.struct(F.col("p_partkey").cast("string").alias("code"), F.concat(F.floor("p_retailprice").cast("string"), F.lit(" تومان")).alias("price"), F.concat("p_size", F.lit(" km")).alias("mileage"))
    stock = table(spark, sf_dir, "part").groupBy((F.col("p_partkey") % n).alias("s_suppkey")).agg(F.collect_list(listing).alias("inventory"))
    rows = s.join(stock, "s_suppkey").select(F.to_json(F.struct(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"), (F.col("s_suppkey") % 50).cast("double").alias("score"), "inventory")).alias("payload"))
    seed = table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'").select("l_partkey")
    return J.dealer_rows(rows, "payload", seed, "l_partkey")


@query("review_rows", "select p_partkey, p_name as title, p_type as summary, p_size / 10 as score, null::double as quality, nullif(floor(p_retailprice)::bigint, 0) as price_from, null::bigint as price_to from part")
def review_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F42."""
    score = F.concat((F.col("p_size") / 10).cast("string"), F.lit(" از ۵"))
    body = F.struct(F.concat(F.lit("  "), "p_name").alias("title"), F.col("p_type").alias("summary"), F.struct(score.alias("total"), F.lit("نامشخص").alias("quality")).alias("scores"), F.struct(F.floor("p_retailprice").cast("string").alias("from"), F.lit("توافقی").alias("to")).alias("price"))
    return J.review_row(table(spark, sf_dir, "part").select("p_partkey", F.to_json(body).alias("payload")), "p_partkey", "payload")


@query("search_cards", "select p_partkey::varchar as code, p_name as title, case when p_size % 3 = 0 then nullif(floor(p_retailprice)::bigint, 0) end as price, p_size % 4 = 0 or p_size % 5 = 0 as promoted from part where p_size % 7 <> 0")
def search_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of sizes that seven divides are banners."""
    size = F.col("p_size")
    entry = F.struct(F.when(size % 7 == 0, "banner").otherwise("ad").alias("type"), F.col("p_partkey").cast("string").alias("code"), F.col("p_name").alias("title"), F.when(size % 3 == 0, "lumpsum").otherwise("installment").alias("price_type"), F.floor("p_retailprice").cast("string").alias("price"), (size % 4 == 0).alias("pin"), F.when(size % 5 == 0, "hot").alias("badge"))
    pages = table(spark, sf_dir, "part").groupBy("p_brand", "p_type").agg(F.collect_list(entry).alias("ads"))
    return J.cards(pages.select(F.to_json(F.struct("ads")).alias("payload")), "payload")


@query("price_structs", """select o_orderkey, case k when 0 then 'lumpsum' when 1 then 'installment' when 2 then 'presale' when 3 then 'hidden' else 'negotiable' end as price_type, case when k in (0, 2) and p > 0 then p end as price, k = 4 as is_negotiable, k = 1 as is_installment, k = 3 as price_hidden, k = 2 as is_presale, case when k = 1 and p // 5 > 0 then p // 5 end as down_payment, case when k = 1 then 12 end as installment_months, case when k = 2 then 90 end as delivery_days from (select o_orderkey, o_custkey % 5 as k, floor(o_totalprice)::bigint as p from orders)""")
def price_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sale type follows from the customer."""
    k, p = F.col("o_custkey") % 5, F.floor("o_totalprice")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("lumpsum", "installment", "presale", "hidden", "negotiable")]), (k + 1).cast("int"))
    terms = F.struct(F.struct(F.expr("floor(o_totalprice) div 5").alias("value")).alias("prepayment"), F.struct(F.floor(p / 12).alias("value")).alias("payment"), F.lit(12).alias("month"))
    body = F.struct(kind.alias("type"), F.when(k == 0, F.struct(p.cast("string").alias("text"), p.alias("value"))).alias("fixed"), F.when(k == 1, terms).alias("installment"), F.when(k == 2, F.struct(p.alias("value"), F.lit(90).alias("deliveryDays"))).alias("presale"))
    return table(spark, sf_dir, "orders").select("o_orderkey", V.price_struct(F.to_json(body)).alias("s")).select("o_orderkey", "s.*").drop("installment_amount")


@query("publication_sources", "select event_id, case event_id % 5 when 0 then 'detail_absolute' when 1 then 'detail_relative' when 2 then 'detail_relative' when 3 then 'detail_coarse' else 'unknown' end as source from events")
def publication_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times said in four ways, with a fifth that says none."""
    said = F.element_at(F.array(F.lit("۱۴۰۳/۰۲/۰۱"), F.lit("دیروز"), F.lit("۳ روز پیش"), F.lit("لحظاتی پیش"), F.lit(None).cast("string")), (F.col("event_id") % 5 + 1).cast("int"))
    rows = table(spark, sf_dir, "events").select("event_id", said.alias("said"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("anchor"))
    return rows.select("event_id", V.publication_source(F.col("said"), C.published_time(F.col("said"), F.col("anchor"))).alias("source"))


@query("verdicts", "select event_type, case event_type when 'view' then 'available' when 'click' then 'gone' when 'purchase' then 'reports_unavailable' when 'error' then 'temporarily_unavailable' else 'unknown' end as availability, count(*) as n from events group by 1, 2")
def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types stand for verdicts."""
    kind = F.create_map(*[F.lit(x) for x in ("view", "detail_page_still_active", "click", "http_404", "purchase", "redirected_to_search", "error", "temporary_server_error", "signup", "odd")])
    rows = table(spark, sf_dir, "events").select("event_type", V.availability(F.try_element_at(kind, F.col("event_type"))).alias("availability"))
    return rows.groupBy("event_type", "availability").agg(F.count("*").alias("n"))


@query("terminations", "select o_orderpriority, o_orderpriority = '1-URGENT' as verified_end, o_orderpriority = '2-HIGH' as blocked, o_orderpriority in ('2-HIGH', '3-MEDIUM') as page_failed, count(*) as n from orders group by 1")
def terminations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P28."""
    reason = F.when(F.col("o_orderpriority") == "1-URGENT", "api_exhausted_2").when(F.col("o_orderpriority") == "2-HIGH", "blocked_http_403").when(F.col("o_orderpriority") == "3-MEDIUM", "network_error").when(F.col("o_orderpriority") == "5-LOW", "max_pages")
    return table(spark, sf_dir, "orders").select("o_orderpriority", V.termination(reason).alias("t")).groupBy("o_orderpriority", "t").agg(F.count("*").alias("n")).select("o_orderpriority", "t.*", "n")


MEDIA = "md as (select c_custkey, 4 + c_custkey % 5 as n from customer)"


@query("media_profiles", f"with {MEDIA} select c_custkey, n::integer as media, list_transform(generate_series(1, least(n, 6)), lambda i: substr(sha1('/img/' || c_custkey || '/' || i), 1, 16)) as profile, n > 5 as rich from md")
def media_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted in a JSON array; the first six paths hashed, whatever host and query."""
    c = table(spark, sf_dir, "customer").select("c_custkey", (4 + F.col("c_custkey") % 5).alias("n"))
    urls = F.transform(F.sequence(F.lit(1).cast("bigint"), F.col("n")), lambda i: F.concat(F.lit("https://cdn"), i.cast("string"), F.lit(".example.com/img/"), F.col("c_custkey").cast("string"), F.lit("/"), i.cast("string"), F.lit("?w=300")))
    rows = c.select("c_custkey", F.to_json(urls).alias("media"))
    return rows.select("c_custkey", V.media_count(F.col("media")).alias("media"), V.media_profile(F.from_json("media", "array<string>")).alias("profile"), (V.media_count(F.col("media")) > 5).alias("rich"))


@query("item_conditions", "select l_returnflag, case l_returnflag when 'A' then 'new' when 'R' then 'used' end as condition, count(*) as n from lineitem group by 1")
def item_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F38."""
    said = F.when(F.col("l_returnflag") == "A", '{"itemCondition": "https://schema.org/NewCondition"}').when(F.col("l_returnflag") == "R", '{"offers": {"itemCondition": "UsedCondition"}}').otherwise("{}")
    return table(spark, sf_dir, "lineitem").select("l_returnflag", V.item_condition(said).alias("condition")).groupBy("l_returnflag", "condition").agg(F.count("*").alias("n"))


@query("payload_audit", """select count(*) as payloads, count(*) filter (event_type <> 'error') as with_price, count(*) filter (json_extract(props, '$.k') is not null) as with_key, count(*) filter (cast(json_extract(props, '$.k') as bigint) >= 50) as large_key, count(*) filter (not json_valid(props)) as broken from events""")
def payload_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over payloads in one scan."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf_dir, "events").agg(F.count("*").alias("payloads"), F.count_if(F.col("event_type") != "error").alias("with_price"), F.count_if(k.isNotNull()).alias("with_key"), F.count_if(k >= 50).alias("large_key"), F.count_if(F.try_parse_json("props").isNull()).alias("broken"))


@query("agreement_audit", """with a as (select case when p_size % 4 = 0 then 'text_only' when p_size % 4 = 1 then 'mismatch' when p_retailprice = floor(p_retailprice) then 'scaled_x10' else 'other' end as g from part) select g as agreement, count(*) as n from a where g in ('text_only', 'mismatch') group by 1""")
def agreement_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How integers agree with the texts beside them; classes whose SQL needs no decimal text."""
    size = F.col("p_size")
    pair = C.reconcile_dotless(F.when(size % 4 == 0, None).when(size % 4 == 1, F.lit(-1)).otherwise(F.floor(F.col("p_retailprice") * 10)), F.col("p_retailprice").cast("string"))
    return table(spark, sf_dir, "part").select(pair["agreement"].alias("agreement")).groupBy("agreement").agg(F.count("*").alias("n")).where("agreement in ('text_only', 'mismatch') and n > 0")


@query("composed_texts", "select c_custkey, nfc_normalize(c_name || chr(101) || chr(769)) as name from customer")
def composed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A letter and its accent become one character."""
    return table(spark, sf_dir, "customer").select("c_custkey", T.nfc(F.concat("c_name", F.lit("e\u0301"))).alias("name"))


@query("first_versions", "select o_custkey, min(o_orderkey) as o_orderkey from orders group by 1")
def first_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw page corpus of order lists, read once a code, the first occurrence staying."""
    o = table(spark, sf_dir, "orders")
    pages = o.groupBy("o_orderdate").agg(F.collect_list(F.struct("o_custkey", "o_orderkey")).alias("ads")).select(F.to_json(F.struct("ads")).alias("page"))
    ads = pages.select(F.explode(F.from_json("page", "ads array<struct<o_custkey: bigint, o_orderkey: bigint>>")["ads"]).alias("a")).select("a.*")
    return ads.withColumn("n", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))).where("n = 1").drop("n")
