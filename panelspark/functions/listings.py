"""Column builders for listing records: verdicts, price structs, cards, publication sources, media, run metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelspark.functions.columns import any_of, fold_digits

# Verdicts with what they say of a page, statuses that are disappearances, reasons that end a run, words of publication times.
AVAILABILITY = {
    "detail_page_still_active": "available", "detail_page_reports_unavailable": "reports_unavailable", "http_404": "gone", "http_410": "gone", "redirected_to_search": "reports_unavailable",
    "temporary_server_error": "temporarily_unavailable", "blocked_response": "blocked", "local_parse_error": "unknown", "unknown": "unknown",
}
MEANINGS = {
    "new": "observed: first counted", "active": "observed: in the latest valid run", "missing_once": "observed: absent from one valid run, no removal", "likely_removed": "observed: absent as often as confirms a removal",
    "likely_sold": "inferred: removal with evidence", "reappeared": "observed: back after an absence", "reposted": "matched: a newer listing of the item", "active_outside_filter": "observed: alive outside the search, no disappearance",
}
DISAPPEARANCES = ("likely_removed", "likely_sold")
ENDS, BLOCKED, PAGE_ERRORS = "api_exhausted", "blocked_http", ("http_error", "network_error", "blocked_http")
COARSE = ("لحظاتی پیش", "دقایقی پیش", "هم اکنون", "همین الان", "چند لحظه پیش")
AGO, DAYS_BACK = "پیش", ("دیروز", "پریروز")


def lookup(value: Column, table: dict[str, str], otherwise: str | None = None) -> Column:
    """A value's entry in a literal table."""
    found = F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), value)
    return F.coalesce(found, F.lit(otherwise)) if otherwise is not None else found


def availability(verdict: Column) -> Column:
    """What a verdict says about a listing; unknown ones say nothing."""
    return lookup(verdict, AVAILABILITY, "unknown")


def publication_source(raw: Column, parsed: Column) -> Column:
    """How precisely a publication time was stated: a coarse word, an absolute date, a relative offset; unknown without a parsed time."""
    t = F.trim(F.coalesce(raw, F.lit("")))
    digits = fold_digits(t).rlike(r"\d")
    return (F.when(parsed.isNull() | (t == ""), "unknown").when(any_of(t, COARSE), "detail_coarse").when(t.contains("/") | (digits & ~t.contains(AGO)), "detail_absolute")
            .when(any_of(t, (AGO, *DAYS_BACK)), "detail_relative").otherwise("detail_coarse"))


def termination(reason: Column) -> Column:
    """struct(verified_end, blocked, page_failed) from a run's termination reason; a ceiling on pages or time is no failed page."""
    r = F.coalesce(reason, F.lit("unknown"))
    failed = F.lit(False)
    for start in PAGE_ERRORS:
        failed = failed | r.startswith(start)
    return F.struct(r.startswith(ENDS).alias("verified_end"), r.startswith(BLOCKED).alias("blocked"), failed.alias("page_failed"))


PRICE = "type string, fixed struct<text: string, value: bigint>, installment struct<prepayment: struct<value: bigint>, payment: struct<value: bigint>, month: int>, presale struct<value: bigint, deliveryDays: int>"


def price_struct(payload: Column) -> Column:
    """struct(price_type, price, is_negotiable, is_installment, price_hidden, is_presale, down_payment, installment_amount,
    installment_months, delivery_days) of a JSON price; 0 is no price, a pre-sale's value stands in where there is no fixed one."""
    p = F.from_json(payload, PRICE)
    some = lambda c: F.when(c > 0, c)
    i, pre = p["installment"], p["presale"]
    kind = p["type"]
    return F.struct(
        kind.alias("price_type"), F.coalesce(some(p["fixed"]["value"]), some(pre["value"])).alias("price"), F.coalesce(kind == "negotiable", F.lit(False)).alias("is_negotiable"), i.isNotNull().alias("is_installment"),
        F.coalesce(kind.isin("hidden", "notShown"), F.lit(False)).alias("price_hidden"), (F.coalesce(kind == "presale", F.lit(False)) | pre.isNotNull()).alias("is_presale"), some(i["prepayment"]["value"]).alias("down_payment"),
        some(i["payment"]["value"]).alias("installment_amount"), i["month"].alias("installment_months"), pre["deliveryDays"].alias("delivery_days"))


def media_count(media: Column) -> Column:
    """P5: entries of a JSON array; null where it is none."""
    return F.when(F.json_array_length(media) >= 0, F.json_array_length(media))


def has_text(text: Column) -> Column:
    return F.coalesce(F.trim(text) != "", F.lit(False))


def media_profile(urls: Column, most: int = 6) -> Column:
    """hashes of the paths of the first media URLs, so that hosts and queries don't matter."""
    paths = F.filter(F.transform(urls, lambda u: F.try_parse_url(u, F.lit("PATH"))), lambda p: p.isNotNull() & (p != ""))
    return F.transform(F.slice(paths, 1, most), lambda p: F.substring(F.sha1(p), 1, 16))


def item_condition(block: Column) -> Column:
    """new, used or null from a JSON-LD block's itemCondition."""
    said = F.lower(F.coalesce(F.get_json_object(block, "$.itemCondition"), F.get_json_object(block, "$.offers.itemCondition")))
    return F.when(said.contains("newcondition"), "new").when(said.contains("usedcondition"), "used")


def absence_cause(missing_pct: Column, column: Column, structural: tuple[str, ...], recent: tuple[str, ...]) -> Column:
    """Why a field is missing: never, not collected at all, not applicable to some kinds, collected since lately, or not stated."""
    return (F.when(missing_pct == 0, "complete").when(missing_pct == 100, "not_collected").when(column.isin(*structural), "not_applicable").when(column.isin(*recent), "collected_later").otherwise("not_stated"))


def converted_year(year: Column) -> Column:
    """struct(year, converted): years of 1500 and more are Gregorian, lose 621 and are marked."""
    gregorian = F.coalesce(year >= 1500, F.lit(False))
    return F.struct(F.when(gregorian, year - 621).otherwise(year).alias("year"), gregorian.alias("converted"))


def snapshot_age(as_of: Column, scraped: Column, stale_hours: float = 72.0) -> Column:
    """struct(age_hours, stale) of a version as of an instant; without a version the age is null and it counts as stale."""
    age = F.round((F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(scraped.cast("timestamp"))) / 3.6e9, 4)
    return F.struct(age.alias("age_hours"), F.coalesce(age > stale_hours, F.lit(True)).alias("stale"))
