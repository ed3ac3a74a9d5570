"""The registered queries: every operator over whole tables, or over data Spark derives from them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fixed
from tidemark.functions import metrics
from tidemark.functions import scalars as fn
from tidemark.functions.text import literal, with_exprs
from tidemark.operators import cleaning, incremental, intervals, quality, ranking
from tidemark.plans import checks, dashboards, intermediate, jobs, marts, refine, staging, standin, warehouse
from tidemark.session import scratch_path
from tidemark.sources import fact_store, html_tables, landing
from tidemark.sources import lake as lk
from tidemark.streaming import dedup, polls

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CUTOFF = "timestamp_ntz'2024-01-20 00:00:00'"
NOW = "timestamp'2025-01-01 00:00:00'"
CLOCK = "timestamp'2025-01-01 00:00:00'"


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def naive(df: DataFrame) -> DataFrame:
    """Instants as zone-less timestamps, as the tables hold them."""
    stamps = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return with_exprs(df, {c: f"cast({c} as timestamp_ntz)" for c in stamps}) if stamps else df


# ----------------------------------------------------------------- cleaning and typing


@register
def clean_strip_non_ascii(spark, sf):
    return cleaning.strip_non_ascii(standin.table(spark, sf, "documents").select("doc_id", "text", "lang", "source"))


@register
def clean_trim(spark, sf):
    docs = standin.table(spark, sf, "documents")
    padded = "concat(repeat(' ', cast(doc_id % 3 as int)), text, repeat(' ', cast(doc_id % 4 as int))) as text"
    return cleaning.trim_spaces(docs.selectExpr("doc_id", padded))


@register
def clean_empty_to_null(spark, sf):
    docs = standin.table(spark, sf, "documents")
    blanked = docs.selectExpr(
        "doc_id", "case when doc_id % 5 = 0 then '' else lang end as lang",
        "case when doc_id % 3 = 0 then '' else source end as source",
    )
    return cleaning.empty_to_null(blanked)


@register
def clean_replace_suffix(spark, sf):
    part = standin.table(spark, sf, "part")
    text = (
        "concat(p_name, case p_partkey % 4 when 0 then concat(' ', p_size, '-Core Processor')"
        " when 1 then concat('  ', p_size, '-Cores Processor')"
        " when 2 then concat(' ', p_size, '-Core Processor ', p_brand) else '' end) as cpu_model_name"
    )
    return cleaning.strip_core_suffix(part.selectExpr("p_partkey", text))


@register
def clean_decimal_separator(spark, sf):
    orders = standin.table(spark, sf, "orders")
    text = orders.selectExpr(
        "o_orderkey", "replace(cast(cast(o_totalprice as decimal(18,2)) as string), '.', ',') as price_mkd_per_kwh"
    )
    fixed_text = cleaning.decimal_comma_to_point(text)
    return with_exprs(fixed_text, {"price": "try_cast(price_mkd_per_kwh as double)"})


@register
def parse_date_formats(spark, sf):
    orders = standin.table(spark, sf, "orders")
    form = "case when o_orderkey % 10 = 0 then 'yyyy/MM/dd' else 'dd.MM.yyyy' end"
    return cleaning.parse_valid_from(orders.selectExpr("o_orderkey", f"date_format(o_orderdate, {form}) as valid_from"))


@register
def cast_to_schema_permissive(spark, sf):
    events = standin.table(spark, sf, "events")
    loose = events.selectExpr(
        "concat(event_id, case when event_id % 11 = 0 then 'x' else '' end) as event_id",
        "cast(user_id as string) as user_id", "event_type", "props",
        "case when event_id % 2 = 0 then 'true' else 'no way' end as flag",
    )
    schema = T.StructType(
        [
            T.StructField("event_id", T.IntegerType()), T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()), T.StructField("flag", T.BooleanType()),
            T.StructField("absent", T.StringType()),
        ]
    )
    return cleaning.cast_to_schema(loose, schema, fill_missing=True)


@register
def null_filter(spark, sf):
    events = standin.table(spark, sf, "events")
    holes = events.selectExpr("event_id", "event_type", "case when event_id % 4 != 0 then value end as value")
    return cleaning.drop_null(holes, "value")


@register
def dedup_latest(spark, sf):
    items = standin.table(spark, sf, "lineitem")
    newest_first = "datediff(date'9999-12-31', l_shipdate)"
    return cleaning.deduplicate(items, ["l_orderkey", "l_linenumber"], [newest_first, "l_partkey", "l_suppkey"])


# ----------------------------------------------------------------- refine pipelines


@register
def refine_offers(spark, sf):
    silver = standin.silver_from(spark, sf)
    bronze = with_exprs(
        silver,
        {
            "cpu_model_name": "concat(' ', cpu_model_name, case when offer_id % 6 = 0 then '®' else '' end, ' ')",
            "disk_model_name": "case when offer_id % 5 = 0 then ' ' else disk_model_name end",
        },
    ).drop("processed_at")
    return naive(refine.REFINEMENTS[lk.OFFERS.name].transform(bronze, CLOCK))


@register
def refine_rates(spark, sf):
    bronze = standin.table(spark, sf, "events").selectExpr(
        "date_format(date_trunc('day', ts), \"yyyy-MM-dd'T'HH:mm:ss'Z'\") as ingested_at",
        "' USD' as from_currency", "concat(event_type, ' ') as to_currency", "round(value) as value",
        "date_format(date_trunc('hour', ts), \"yyyy-MM-dd'T'HH:mm:ss'Z'\") as timestamp",
    )
    return naive(refine.REFINEMENTS[lk.RATES.name].transform(bronze, CLOCK))


@register
def refine_tiers(spark, sf):
    bronze = standin.order_tariffs(standin.table(spark, sf, "orders")).selectExpr(
        "concat(date_format(valid_from, 'yyyy-MM-dd'), 'T06:00:00Z') as ingested_at",
        "concat(' ', tariff_description) as tariff_description",
        "replace(cast(cast(price_mkd_per_kwh as decimal(18,2)) as string), '.', ',') as price_mkd_per_kwh",
        "date_format(valid_from, 'dd.MM.yyyy') as valid_from",
    )
    return naive(refine.REFINEMENTS[lk.TIERS.name].transform(bronze, CLOCK))


@register
def refine_schedule(spark, sf):
    bronze = standin.order_schedule(standin.table(spark, sf, "orders")).selectExpr(
        "concat(date_format(valid_from, 'yyyy-MM-dd'), 'T06:00:00Z') as ingested_at",
        "concat(tariff_type, ' ') as tariff_type", "day_of_week", "start_hour", "end_hour",
        "date_format(valid_from, 'dd.MM.yyyy') as valid_from",
    )
    return naive(refine.REFINEMENTS[lk.SCHEDULE.name].transform(bronze, CLOCK))


# ----------------------------------------------------------------- scalars

_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@register
def scalar_inverse(spark, sf):
    items = standin.table(spark, sf, "lineitem")
    return items.selectExpr(
        *_LINE, f"{fn.inverse('l_discount')} as inverse_value", f"{fn.safe_ratio('l_quantity', 'l_tax')} as ratio"
    )


@register
def scalar_mb_to_gb(spark, sf):
    return standin.table(spark, sf, "part").selectExpr("p_partkey", f"{fn.mb_to_gb('p_size * 300')} as gb")


_SIZE_MB = "case when p_partkey % 3 = 0 then 2560 + p_partkey % 5 * 512 else p_retailprice * p_size end"


@register
def scalar_nearest_size(spark, sf):
    sized = standin.table(spark, sf, "part").selectExpr("p_partkey", f"cast({_SIZE_MB} as double) as mb")
    nearest = fn.nearest_size("mb")
    return sized.selectExpr("p_partkey", f"{nearest} as nearest_mb", f"{fn.to_whole(fn.mb_to_gb(nearest))} as nearest_gb")


@register
def scalar_country(spark, sf):
    customer, nation, region = (standin.table(spark, sf, t) for t in ("customer", "nation", "region"))
    placed = customer.join(nation, F.expr("c_nationkey = n_nationkey")).join(region, F.expr("n_regionkey = r_regionkey"))
    text = (
        "case c_custkey % 4 when 0 then concat(n_name, ', ', r_name) when 1 then n_name"
        " when 2 then concat(n_name, ', ', r_name, ', ', c_custkey) else concat(n_name, ',  ') end"
    )
    return placed.selectExpr("c_custkey", f"{fn.country_code(text)} as country_code")


@register
def scalar_tariff_type(spark, sf):
    notices = standin.order_tariffs(standin.table(spark, sf, "orders"))
    return notices.selectExpr("o_orderkey", f"{fn.tariff_type('tariff_description')} as tariff_type")


@register
def scalar_translate(spark, sf):
    notices = standin.order_tariffs(standin.table(spark, sf, "orders"))
    return notices.selectExpr("o_orderkey", f"{fn.tariff_code('tariff_description')} as tariff_description_en")


@register
def surrogate_key(spark, sf):
    items = standin.table(spark, sf, "lineitem")
    flag = "case when l_linenumber = 3 then null when l_linenumber = 4 then '' else l_returnflag end"
    return items.selectExpr(*_LINE, f"{fn.surrogate_key('l_orderkey', 'l_linenumber', flag)} as skey")


@register
def iso_weekday_hour(spark, sf):
    return naive(standin.table(spark, sf, "events").selectExpr(
        "event_id", f"{fn.iso_weekday('ts')} as day_of_week", f"{fn.hour_of_day('ts')} as hour_of_day",
        f"{fn.hour_bucket('ts')} as hour_bucket",
    ))


# ----------------------------------------------------------------- landing


@register
def landing_json_props(spark, sf):
    events = standin.table(spark, sf, "events")
    return events.selectExpr("event_id", "from_json(props, 'k bigint').k as k")


def _offer_payloads(spark, sf) -> DataFrame:
    """Events as poll responses of up to four offers, with keys left out, nulled or malformed here and there,
    values in other forms that still count, and some responses that hold no offers at all."""
    events = standin.table(spark, sf, "events")
    fields = {
        "ask_contract_id": "event_id", "machine_id": "user_id % 97", "host_id": "user_id % 31",
        "discounted_dph_total": "value / 100", "dph_base": "case when event_id % 19 != 0 then value / 125 end",
        "min_bid": "case when event_id % 3 = 0 then value / 200 end",
        "dlperf_per_dphtotal": "value",
        # Blanks are not only the ASCII ones.
        "gpu_arch": "case when event_id % 46 = 0 then '\\u00a0\\u2003' when event_id % 23 = 0 then '  ' else event_type end",
        "gpu_name": "concat('G', user_id % 7)", "gpu_ram": "8192",
        "cpu_name": "case when event_id % 37 = 0 then event_id end",
        "cpu_ram": "case when event_id % 29 = 0 then 'much' else '65536' end", "disk_space": "100.5",
        "inet_down": "500", "inet_up": "250",
        "verification": "case when event_id % 17 = 0 then 'unknown' else 'verified' end",
        "rentable": "case when event_id % 7 = 3 then if(event_id % 2 = 0, 'On', 'off') else if(event_id % 2 = 0, 'true', 'false') end",
        "rented": "event_id % 5 = 0",
    }
    structs = ", ".join(f"'{k}', {v}" for k, v in fields.items())
    # Nulls are written out, then the min_bid key is removed where it shall be absent.
    text = f"to_json(named_struct({structs}), map('ignoreNullFields', 'false'))"
    text = f"case when event_id % 3 = 1 then replace({text}, '\"min_bid\":null,', '') else {text} end"
    number = "concat(event_id % 4, case when event_id % 8 = 0 then '.0' else '' end)"
    gpus = f"replace({text}, '\"gpu_ram\"', concat('\"num_gpus\":', {number}, ',\"gpu_ram\"'))"
    text = f"case when event_id % 6 < 4 then {gpus} else {text} end"
    rows = events.selectExpr("event_id", "cast(floor(event_id / 4) as bigint) as response", f"{text} as offer")
    # At most four events share a response, as event ids are unique.
    grouped = rows.groupBy("response").agg(F.expr("array_join(collect_list(offer), ',') as offers"))
    payload = "case response % 50 when 7 then 'no json' when 8 then '{\"error\":1}' else concat('{\"offers\":[', offers, ']}') end"
    return grouped.selectExpr(f"{payload} as payload", "'on_demand' as offer_type", "timestamp'2024-02-01 00:00:00' as ingested_at")


@register
def landing_offers(spark, sf):
    valid, _ = landing.land_offers(_offer_payloads(spark, sf))
    return naive(valid.select(
        "ingested_at", "offer_id", "machine_id", "host_id", "offer_type", "total_price_usd_per_hr",
        "gpu_price_usd_per_hr", "minimum_bid_price_usd", "gpu_architecture", "gpu_model_name", "number_of_gpus",
        "ram_mb", "disk_space_gb", "cpu_model_name", "verification_flag", "rentable_flag", "rented_flag",
    ))


@register
def landing_validate_rejects(spark, sf):
    _, rejects = landing.land_offers(_offer_payloads(spark, sf))
    return rejects.select("offer_id", "failed_rules")


@register
def rates_payload_parse(spark, sf):
    events = standin.table(spark, sf, "events")
    rate = "case when event_id % 9 = 0 then '' else concat(',\"MKD\":', cast(value as string)) end"
    when = "date_format(ts, 'EEE, dd MMM yyyy HH:mm:ss')"
    payload = (
        f"concat('{{\"conversion_rates\":{{\"USD\":1.0', {rate}, '}},\"time_last_update_utc\":\"', {when}, ' +0000\"}}')"
    )
    valid, _ = landing.land_rates(events.selectExpr("cast(ts as timestamp) as ingested_at", f"{payload} as payload"))
    return naive(valid)


@register
def landing_html_items(spark, sf):
    return landing.html_list_items(standin.table(spark, sf, "pages")).selectExpr(
        "page_id", "cast(item_number as bigint) as item_number", "item_text"
    )


@register
def landing_html_tiers(spark, sf):
    notices = standin.order_tariffs(standin.table(spark, sf, "orders"))
    html = (
        "concat('<html><table class=\"t\"><thead><tr><td>Head</td><td>h</td><td>h</td><td>h</td></tr></thead>',"
        " '<tr><th>Name</th><th>Price</th></tr>\n<tr id=\"r\"><td>', tariff_description, '</td><td> ',"
        " replace(cast(price_mkd_per_kwh as string), '.', ','), '</td><td>x</td><td><b>',"
        " date_format(valid_from, 'dd.MM.yyyy'), '</b></td></tr>',"
        " case when o_orderkey % 4 = 0 then '<TR><td>A &amp; B</td><td>1</td></TR>' else '' end, '</table></html>')"
    )
    pages = notices.selectExpr("cast(valid_from as timestamp) as ingested_at", f"{html} as html")
    valid, _ = landing.land_tiers(pages)
    return naive(valid)


@register
def landing_drift_gate(spark, sf):
    pages = standin.table(spark, sf, "pages")
    plain = pages.selectExpr("page_id", "url", f"{landing.collapse_spaces(landing.tag_text('html'))} as expected")
    observed = (
        "case page_id % 3 when 0 then concat(' ', replace(expected, ' ', ' \n  '), '\t')"
        " when 1 then concat(expected, '1') else expected end as observed"
    )
    return landing.drift_gate(plain.selectExpr("*", observed), "observed", "expected").select("page_id", "url")


@register
def landing_schedule(spark, sf):
    customer = standin.table(spark, sf, "customer")
    shown = literal(fixed.SCHEDULE_PAGE_TEXT)
    text = f"case c_custkey % 3 when 0 then replace({shown}, '13:00', '12:00') when 1 then replace({shown}, ' ', '\n ') else {shown} end"
    pages = customer.selectExpr("c_custkey", f"{text} as text", "timestamp'2024-01-01 00:00:00' as ingested_at")
    landed = landing.land_schedule(pages.withColumn("ingested_at", F.expr("ingested_at + make_interval(0, 0, 0, 0, 0, 0, c_custkey)")))
    return naive(landed)


# ----------------------------------------------------------------- intervals and history


@register
def calendar_expand(spark, sf):
    return intervals.calendar_expand(standin.order_schedule(standin.table(spark, sf, "orders")))


@register
def changes_only_values(spark, sf):
    """Few, large keys: each event type's rows are windowed week by week, not in one task."""
    events = standin.table(spark, sf, "events").selectExpr("event_id", "ts", "event_type", "round(value / 10) as value")
    return intervals.changes_only(events, ["event_type"], "ts", "value", tie=["event_id"], chunk="trunc(ts, 'week')")


@register
def changes_only_rates(spark, sf):
    silver = standin.rates_silver(standin.table(spark, sf, "events"))
    staged = staging.stage(silver, lk.RATES.name)
    return naive(intervals.changes_only(staged, warehouse.RATE_KEYS, "timestamp", "value").drop("processed_at"))


@register
def scd2_rates(spark, sf):
    return standin.rates_dim(standin.table(spark, sf, "events"))


def _tariff_history(spark, sf) -> DataFrame:
    notices = standin.order_tariffs(standin.table(spark, sf, "orders"))
    enriched = intermediate.tiers(notices)
    keys = ["o_custkey", "tariff_description_mk"]
    return intervals.scd2(enriched, keys, "valid_from", [*keys, "valid_from"], tie=["o_orderkey"])


@register
def scd2_tiers(spark, sf):
    return _tariff_history(spark, sf)


@register
def scd2_schedule(spark, sf):
    hours = intermediate.schedule(standin.order_schedule(standin.table(spark, sf, "orders")))
    keys = ["o_custkey", "day_of_week", "hour"]
    return intervals.scd2(hours, keys, "valid_from", [*keys, "valid_from"], gap_days=0, tie=["o_orderkey"])


def _rated_offers(spark, sf, **how) -> DataFrame:
    offers = standin.offers(spark, sf).select("offer_id", "valid_from")
    rates = standin.rates_dim(standin.table(spark, sf, "events")).selectExpr("value", "valid_from as rate_from", "valid_to as rate_to")
    return naive(intervals.interval_join(offers, rates, "to_date(valid_from)", "rate_from", "rate_to", **how))


@register
def interval_join_rates(spark, sf):
    return _rated_offers(spark, sf)


@register
def interval_join_salted(spark, sf):
    """The form for hot days below a plan that cannot split them."""
    return _rated_offers(spark, sf, salts=4)


def _purchase_states(events: DataFrame) -> DataFrame:
    """What each user's last purchase says, for six hours or until the next one."""
    bought = cleaning.deduplicate(events.filter("event_type = 'purchase'"), ["user_id", "ts"], ["event_id"])
    following = intervals.with_next(bought, ["user_id"], "ts", "next_ts", chunk="trunc(ts, 'month')")
    return following.selectExpr("user_id", "event_id as state_id", "value as state_value", "ts as lo", "least(ts + interval 6 hours, coalesce(next_ts, ts + interval 6 hours)) as hi")


@register
def interval_join_asof(spark, sf):
    """Each event with the state of its user's last purchase; intervals begin and end at any second."""
    events = standin.table(spark, sf, "events")
    joined = intervals.asof_join(events.select("event_id", "user_id", "ts"), _purchase_states(events), "ts", "lo", "hi", keys=("user_id",))
    return joined.select("event_id", "state_id", "state_value")


@register
def interval_join_asof_hot(spark, sf):
    """Without keys: every event with the latest purchase of anyone, hours split further, as no key deals the events."""
    events = standin.table(spark, sf, "events")
    bought = cleaning.deduplicate(events.filter("event_type = 'purchase'"), ["ts"], ["event_id"]).selectExpr("event_id as state_id", "ts as lo", "ts + interval 90 seconds as latest")
    following = intervals.with_next(bought.selectExpr("*", "0 as feed"), ["feed"], "lo", "next_lo", chunk="date_trunc('hour', lo)")
    states = following.selectExpr("state_id", "lo", "least(latest, coalesce(next_lo, latest)) as hi")
    return intervals.asof_join(events.select("event_id", "ts"), states, "ts", "lo", "hi", chunk="date_trunc('hour', {t})", salts=8).select("event_id", "state_id")


@register
def tariff_pivot(spark, sf):
    return warehouse.tiers_by_code(_tariff_history(spark, sf))


@register
def calendar_hours(spark, sf):
    """Events per hour of the week in which their shift of five hours begins, with the hours that have none."""
    hour = fn.hour_of_day("ts")
    events = standin.table(spark, sf, "events").selectExpr(f"{fn.iso_weekday('ts')} as day_of_week", f"{hour} - {hour} % 5 as hour")
    counted = events.groupBy("day_of_week", "hour").count()
    joined = intervals.hourly_calendar(spark).join(counted, ["day_of_week", "hour"], "left")
    return joined.selectExpr("day_of_week", "hour", "coalesce(count, 0L) as events")


@register
def landing_html_nested(spark, sf):
    """Orders as tables with an inner table, spans, commented and scripted rows and open ends: every row and cell that counts."""
    html = (
        "concat('<table><!-- <tr><td>gone</td></tr> --><tr><th>Key</th><td colspan=\"2\">', o_orderkey, '</td><td>[<table><tr><td>in ', o_custkey,"
        " case when o_orderkey % 3 = 0 then '<tr><td>twice' else '' end, '</table>]<td>', o_orderstatus, ' &amp; more</td></tr>',"
        " '<script>\"<tr><td>not this</td></tr>\"</script><tbody><tr><td>last</tbody></table>')"
    )
    pages = standin.table(spark, sf, "orders").selectExpr("o_orderkey", f"{html} as html")
    return html_tables.table_rows(pages).selectExpr(
        "o_orderkey", "table_number", "depth", "section", "row_number", "posexplode(cells) as (cell, c)",
    ).selectExpr("o_orderkey", "table_number", "depth", "section", "row_number", "cell", "c.kind as kind", "c.text as text", "c.column as place")


# ----------------------------------------------------------------- warehouse


@register
def offers_enriched(spark, sf):
    return naive(standin.offers(spark, sf))


@register
def fact_offers(spark, sf):
    return naive(standin.fact(spark, sf))


@register
def fact_tiers_by_row(spark, sf):
    """Tariffs that change on different days, each pivoted by its own interval: days with several rows double offers."""
    fact = standin.fact(spark, sf, standin.tiers_dim(spark, stagger=3))
    return naive(fact.select("offer_id", "valid_from", *metrics.scenario_names(metrics.COST)))


@register
def fact_tiers_by_span(spark, sf):
    """The same tariffs, one complete row per span between any two changes, and no day uncovered."""
    fact = standin.fact(spark, sf, standin.tiers_dim(spark, gap_days=0, stagger=3), tiers_per_span=True)
    return naive(fact.select("offer_id", "valid_from", *metrics.scenario_names(metrics.COST)))


@register
def close_absent(spark, sf):
    events = standin.table(spark, sf, "events")
    offers = standin.offers(spark, sf, events).select("offer_id", "valid_from", "valid_to")
    return naive(warehouse.close_single_load(offers, standin.latest_poll(events), standin.latest_ids(events)))


@register
def close_absent_replay(spark, sf):
    offers = standin.offers(spark, sf).select("offer_id", "valid_from", "valid_to")
    return naive(incremental.close_by_replay(offers))


@register
def watermark_increment(spark, sf):
    events = standin.table(spark, sf, "events")
    return incremental.incremental_filter(events, events.filter(f"ts < {CUTOFF}"), "ts")


@register
def merge_upsert(spark, sf):
    events = standin.table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    keys = ["user_id", "event_type"]
    target = cleaning.deduplicate(events.filter("event_id % 3 != 0"), keys, ["event_id"])
    return incremental.merge_upsert(target, events.filter("event_id % 3 = 0"), keys, order_by=["event_id"])


@register
def schema_append(spark, sf):
    events = standin.table(spark, sf, "events")
    old = events.filter(f"ts < {CUTOFF}").select("event_id", "user_id", "value")
    return incremental.append_evolving(old, events.filter(f"ts >= {CUTOFF}").select("event_id", "event_type", "value"))


# ----------------------------------------------------------------- marts and dashboards


@register
def mart_opportunities(spark, sf):
    return naive(marts.opportunities(standin.fact(spark, sf)))


@register
def mart_opportunities_ranged(spark, sf):
    """The ranks alone, over more range partitions than there are offer types."""
    ranked = ranking.rank_rows(
        marts.available(standin.fact(spark, sf)), ["offer_type"], ["profit_per_tflop_business_high_usd desc", "valid_from asc", "offer_id asc"],
        "place", partitions=16,
    )
    return naive(ranked.select("offer_type", "offer_id", "valid_from", "place"))


@register
def mart_best_offers(spark, sf):
    return naive(marts.best_offers(standin.fact(spark, sf)))


def _rounded(df: DataFrame) -> DataFrame:
    """Averages to 6 places: engines add in different orders."""
    means = [f.name for f in df.schema.fields if f.name.startswith("avg_")]
    return with_exprs(df, {c: f"round({c}, 6)" for c in means})


@register
def mart_model_summary(spark, sf):
    return _rounded(naive(marts.model_summary(standin.fact(spark, sf))))


def _trends(spark, sf, tz: str | None = None) -> DataFrame:
    return marts.trends(standin.shared_offers(standin.fact(spark, sf)), standin.schedule_dim(spark), tz)


@register
def mart_trends_local(spark, sf):
    """Tariff hours looked up in a zone one hour east."""
    return _rounded(naive(_trends(spark, sf, "+01:00")))


@register
def mart_trends(spark, sf):
    return _rounded(naive(_trends(spark, sf)))


@register
def dash_rate_by_type(spark, sf):
    return dashboards.rate_by_type(marts.model_summary(standin.fact(spark, sf)))


@register
def dash_best_profit(spark, sf):
    return dashboards.best_profit(marts.best_offers(standin.fact(spark, sf)))


@register
def dash_profit_over_time(spark, sf):
    return _rounded(naive(dashboards.profit_over_time(_trends(spark, sf))))


@register
def dash_heatmap(spark, sf):
    cells = dashboards.heatmap(_trends(spark, sf))
    return with_exprs(cells, {c: f"round({c}, 6)" for c in cells.columns if c.startswith("h")})


@register
def dash_risk_reward(spark, sf):
    return dashboards.risk_reward(marts.opportunities(standin.fact(spark, sf)))


@register
def dash_profit_per_tflop(spark, sf):
    return _rounded(dashboards.profit_per_tflop(marts.opportunities(standin.fact(spark, sf))))


@register
def dash_live_count(spark, sf):
    return dashboards.live_count(marts.opportunities(standin.fact(spark, sf)))


# ----------------------------------------------------------------- data quality


@register
def dq_report(spark, sf):
    """All declared checks of the staged offers and the fact."""
    staged = staging.stage(standin.silver_from(spark, sf), lk.OFFERS.name)
    report = quality.run_checks(staged, "stg_compute_offers", checks.ALL["stg_compute_offers"], NOW)
    fact = quality.run_checks(standin.fact(spark, sf), "fct_compute_offers", checks.ALL["fct_compute_offers"], NOW)
    return report.unionByName(fact)


@register
def dq_duplicates(spark, sf):
    return quality.duplicate_keys(standin.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


INTERVAL_CHECKS = quality.Checks(
    not_null=("tariff_type",), row_holds=(checks.ORDERED,), unique=("skey",),
    unique_keys=(("o_custkey", "tariff_description_mk", "valid_from"),),
)


@register
def dq_intervals(spark, sf):
    return quality.run_checks(_tariff_history(spark, sf), "tariff_history", INTERVAL_CHECKS)


EVENT_CHECKS = quality.Checks(
    not_null=("user_id", "event_type"), accepted_warn={"event_type": ("view", "click", "purchase", "signup")},
    holds={"{c} > 0.5": ("value",), "{c} < 250": ("value",)}, unique_keys=(("user_id", "ts"), ("event_type", "ts")),
)


@register
def dq_by_load(spark, sf):
    """Checks of three loads of the hourly events, each of its own rows, merged into the report of all."""
    rows = standin.polled_events(standin.table(spark, sf, "events")).selectExpr("user_id", "event_type", "value", "ingested_at as ts")
    return quality.merge_reports([quality.run_checks(part, "events", EVENT_CHECKS, NOW) for part in _slices(rows, "ts")])


@register
def dq_hour_range(spark, sf):
    rows = standin.order_schedule(standin.table(spark, sf, "orders"))
    return quality.singular_check(rows.filter("start_hour >= end_hour"), "order_schedule", "hour range")


# ----------------------------------------------------------------- stored tables


def _slices(events: DataFrame, column: str, parts: int = 3) -> list[DataFrame]:
    """``events`` cut into ``parts`` spans of whole hours, in order; rows without a time come with the last."""
    lo, hi = events.agg(F.min(column), F.max(column)).first()
    edges = [lo + (hi - lo) * i / parts for i in range(1, parts)]
    edges = [e.replace(minute=0, second=0, microsecond=0) for e in edges]
    cuts = [F.lit(e) for e in edges]
    place = F.coalesce(F.size(F.filter(F.array(*cuts), lambda c: c <= F.col(column))), F.lit(0))
    place = F.when(F.col(column).isNull(), parts - 1).otherwise(place)
    return [events.filter(place == i) for i in range(parts)]


def _written(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` written to the shared folder and read back."""
    path = scratch_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _poll_rows(events: DataFrame) -> DataFrame:
    return standin.polled_events(events).selectExpr(
        "user_id as offer_id", "ingested_at as valid_from", f"{literal(fixed.OPEN_TIMESTAMP)} as valid_to", "event_id", "value",
    )


@register
def fact_store_polls(spark, sf):
    """Three loads of several polls each into a stored fact; the last is repeated."""
    path = f"{scratch_path(spark, 'fact-store')}/fact"
    slices = _slices(standin.table(spark, sf, "events"), "ts")
    for part in (*slices, slices[-1]):
        unique = cleaning.deduplicate(_poll_rows(part), ["offer_id", "valid_from"], ["event_id"])
        fact_store.apply_polls(spark, path, unique)
    return naive(fact_store.read_fact(spark, path))


@register
def fact_audit_publish(spark, sf):
    """What readers see while a load is refused, and after it was mended: the second of three loads doubles rows, which the audit
    of its candidate finds."""
    path = f"{scratch_path(spark, 'audited')}/fact"
    rules = quality.Checks(not_null=("value",), unique_keys=(("offer_id", "valid_from"),))

    def audit(rewritten: DataFrame) -> None:
        quality.gate(quality.run_checks(rewritten, "fact", rules))

    seen = []
    first, second, third = (cleaning.deduplicate(_poll_rows(p), ["offer_id", "valid_from"], ["event_id"]) for p in _slices(standin.table(spark, sf, "events"), "ts"))
    fact_store.apply_polls(spark, path, first, audit=audit)
    try:
        fact_store.apply_polls(spark, path, second.unionByName(second), audit=audit)
    except quality.QualityError:
        seen.append(fact_store.read_fact(spark, path).withColumn("state", F.lit("refused")))
    fact_store.apply_polls(spark, path, second, audit=audit)
    seen.append(fact_store.read_fact(spark, path).withColumn("state", F.lit("mended")))
    fact_store.apply_polls(spark, path, third, audit=audit)
    seen.append(fact_store.read_fact(spark, path).withColumn("state", F.lit("next")))
    return naive(reduce(DataFrame.unionByName, seen))


@register
def mart_trends_incremental(spark, sf):
    """The trends mart after three loads of the stored fact, each followed by a refresh of the days that it changed."""
    lake = lk.Lake(scratch_path(spark, "trends-lake"))
    lk.write_table(standin.schedule_dim(spark), lake.model_path("dim_electricity_tariff_schedule"))
    # Rows that share a poll stay together; the hour alone keys them here, as offers of a poll may share ids.
    # Written once, as each load reads its span of it.
    rows = _written(standin.shared_offers(standin.fact(spark, sf)), "trends-rows")
    for part in _slices(rows, "valid_from"):
        fact_store.apply_polls(spark, lake.model_path("fct_compute_offers"), part, written=True)
        jobs.refresh_trends(spark, lake)
    built = spark.read.parquet(lake.model_path("mart_profitability_trends"))
    return _rounded(naive(built.drop(jobs.BUCKET_DAY)))


@register
def close_absent_doubled(spark, sf):
    """Replay over offers of which every fifth row is there twice, as tariffs that change on different days double them."""
    offers = standin.offers(spark, sf).select("offer_id", "valid_from", "valid_to")
    return naive(incremental.close_by_replay(offers.unionByName(offers.filter("offer_id % 5 = 0"))))


@register
def upsert_stored(spark, sf):
    """A keyed merge into a stored table with null partition values, in two batches."""
    path = f"{scratch_path(spark, 'upsert')}/table"
    events = standin.table(spark, sf, "events").selectExpr(
        "event_id % 500 as k", "nullif(event_type, 'error') as kind", "event_id", "value",
    )
    for batch in (events.filter("event_id % 3 <> 0"), events.filter("event_id % 3 = 0 and k < 250")):
        fact_store.upsert_partitions(spark, path, batch, ["k", "kind"], "kind", ["event_id"])
    return lk.read_table(spark, path)


_FLOW_OFFER = {
    "machine_id": "1", "host_id": "2", "discounted_dph_total": "price", "dph_base": "0.5", "min_bid": "0.1", "storage_total_cost": "0.01",
    "inet_up_cost": "0.001", "inet_down_cost": "0.002", "dlperf_per_dphtotal": "9.5", "gpu_arch": "'nvidia'", "gpu_name": "concat('G', user_id % 7)",
    "gpu_ram": "24564", "gpu_max_power": "450", "num_gpus": "2", "cuda_max_good": "12.4", "total_flops": "165.2", "gpu_mem_bw": "880.1",
    "cpu_arch": "'amd64'", "cpu_name": "'CPU 64-Core Processor'", "cpu_cores_effective": "32.5", "cpu_ghz": "2.25", "cpu_ram": "128000",
    "disk_name": "'nvme'", "disk_space": "100.5", "disk_bw": "3000", "pci_gen": "4", "pcie_bw": "22.1", "inet_down": "800", "inet_up": "400",
    "reliability2": "0.99", "dlperf": "80.1", "geolocation": "'Skopje, MK'",
    "verification": "case when user_id % 11 = 0 then 'unknown' else 'verified' end", "rentable": "true", "rented": "user_id % 2 = 0",
}
_FLOW_POLLS = ("2024-02-01 18:00:00", "2024-02-02 00:00:00")


@register
def dataset_flow(spark, sf):
    """Payloads made of the events, landed and run poll by poll up to published marts: what each step has stored."""
    lake = lk.Lake(scratch_path(spark, "lake"))
    events = standin.table(spark, sf, "events")
    # A rate that changes from one day to the next is valid for no day, which the checks refuse: one rate per three days.
    span = "date_add(date'2024-01-01', cast(3 * floor(datediff(ts, date'2024-01-01') / 3) as int)) as day"
    rates = events.groupBy(F.expr(span)).agg(F.expr("round(avg(value)) + 1 as value")).selectExpr(
        "concat('{\"conversion_rates\":{\"MKD\":', value, '},\"time_last_update_utc\":\"', date_format(day, 'EEE, dd MMM yyyy'), ' 00:00:00 +0000\"}') as payload",
        "cast(day as timestamp) as ingested_at",
    )
    lines = "".join(f"<tr><td>{text}</td><td>{i + 1},5</td><td>-</td><td>01.01.2024</td></tr>" for i, text in enumerate(fixed.TARIFF_CODES))
    first = events.groupBy().agg(F.expr("cast(min(ts) as timestamp) as ingested_at"))
    jobs.run_dataset(spark, lake, lk.RATES, 1, payloads=rates)
    jobs.run_dataset(spark, lake, lk.TIERS, 1, payloads=first.selectExpr("ingested_at", f"{literal(f'<table>{lines}</table>')} as html"))
    jobs.run_dataset(spark, lake, lk.SCHEDULE, 1, payloads=first.selectExpr("ingested_at", f"{literal(fixed.SCHEDULE_PAGE_TEXT)} as text"))
    structs = ", ".join(f"'{k}', {v}" for k, v in _FLOW_OFFER.items())
    for i, poll in enumerate(_FLOW_POLLS):
        seen = events.filter(f"event_id % 2 = {i}").groupBy("user_id").agg(F.expr("1 + sum(cast(floor(abs(value)) as bigint)) as price"))
        payloads = seen.selectExpr(
            f"concat('{{\"offers\":[', to_json(named_struct('ask_contract_id', user_id, {structs})), ']}}') as payload", "'on_demand' as offer_type",
            f"timestamp'{poll}' as ingested_at",
        )
        jobs.run_dataset(spark, lake, lk.OFFERS, 2 + i, payloads=payloads)
    jobs.run_marts(spark, lake, 4)

    def counted(df: DataFrame, item: str, label: str = "''") -> DataFrame:
        return df.groupBy(F.expr(f"cast({label} as string) as label")).count().selectExpr(f"'{item}' as item", "label", "count as n")

    fact = fact_store.stored_fact(spark, lake.model_path("fct_compute_offers"))
    rejects = lk.read_table(spark, lake.reject_path(lk.OFFERS))
    parts = [
        spark.read.parquet(lake.marker_path()).selectExpr("'published' as item", "cast(name as string) as label", "version as n"),
        counted(fact, "fact day", fact_store.DAY), counted(fact.filter(fn.is_open("valid_to")), "fact open"),
        fact.groupBy(F.expr(f"cast({fact_store.DAY} as string) as label")).agg(F.expr("cast(sum(revenue_usd_per_hr) as bigint) as n"))
        .selectExpr("'fact revenue' as item", "label", "n"),
        counted(spark.table(lk.OFFERS.name), "silver poll", lk.POLL), counted(rejects, "reject", "failed_rules"),
        counted(spark.read.parquet(lake.model_path("mart_arbitrage_opportunities")), "opportunities"),
        counted(spark.read.parquet(lake.model_path("mart_profitability_trends")), "trend day", "bucket_date"),
    ]
    return reduce(DataFrame.unionByName, parts)


# ----------------------------------------------------------------- stream


def _streamed(spark, parts: list[DataFrame]) -> tuple[DataFrame, DataFrame | None]:
    """The stored fact and the rejects, if any, after the parts have landed and been merged one after the other."""
    work = scratch_path(spark, "stream")
    landed, fact, late = f"{work}/landed", f"{work}/fact", f"{work}/late"
    sink = polls.poll_merger(fact, late, _poll_rows, tie=("event_id",))
    for part in parts:
        part.write.mode("append").parquet(landed)
        polls.run_available(polls.poll_stream(spark, landed, part.schema), sink, f"{work}/checkpoint")
    rejects = lk.read_table(spark, late)
    return naive(fact_store.read_fact(spark, fact)), None if rejects is None else naive(rejects)


@register
def stream_poll_merge(spark, sf):
    """Events landed in three parts, each merged into a stored fact as it comes."""
    return _streamed(spark, _slices(standin.table(spark, sf, "events"), "ts"))[0]


@register
def stream_late_rows(spark, sf):
    """Where each landed row ends up: some come a part too late, some lack the id or the time."""
    events = standin.table(spark, sf, "events")
    early, middle, last = _slices(events.withColumns({
        "user_id": F.expr("case when event_id % 97 <> 0 then user_id end"),
        "ts": F.expr("case when event_id % 89 <> 0 then ts end"),
    }), "ts")
    held_back = "event_id % 50 = 7"
    parts = [early.filter(f"not ({held_back})"), middle.unionByName(early.filter(held_back)), last]
    fact, rejects = _streamed(spark, parts)
    return fact.selectExpr("event_id", "'fact' as fate").unionByName(rejects.selectExpr("event_id", "reason as fate"))


@register
def stream_dedup_state(spark, sf):
    """Events landed in three parts, each with the last six hours of the one before again: every event once."""
    work = scratch_path(spark, "stream-once")
    events = standin.table(spark, sf, "events").withColumn("ts", F.expr("cast(ts as timestamp)"))
    parts = _slices(events, "ts")
    again = [p.join(p.agg((F.max("ts") - F.expr("interval 6 hours")).alias("since")), F.expr("ts >= since")).drop("since") for p in parts]
    for part in (parts[0], parts[1].unionByName(again[0]), parts[2].unionByName(again[1])):
        part.write.mode("append").parquet(f"{work}/landed")
        stream = polls.poll_stream(spark, f"{work}/landed", part.schema)
        dedup.write_once(dedup.first_sightings(stream, ["event_id"], "ts", "12 hours"), f"{work}/once", f"{work}/checkpoint")
    return naive(spark.read.schema(events.schema).parquet(f"{work}/once")).select("event_id", "user_id", "ts", "value")


# ----------------------------------------------------------------- order at the sink


@register
def sorted_sink(spark, sf):
    """Events written in order of time: their places when files are read by name."""
    path = f"{scratch_path(spark, 'sorted')}/events"
    lk.write_table(standin.table(spark, sf, "events").select("ts", "event_id"), path, cluster_by=("ts", "event_id"))
    return lk.in_file_order(spark, path).select("event_id", "place")


@register
def schedule_in_order(spark, sf):
    """Orders per weekday and hour of the hourly calendar, stored in (day, hour) order."""
    path = f"{scratch_path(spark, 'schedule')}/hours"
    orders = standin.table(spark, sf, "orders").selectExpr(f"{fn.iso_weekday('o_orderdate')} as day_of_week", "cast(o_orderkey % 24 as int) as hour")
    counted = orders.groupBy("day_of_week", "hour").count()
    hours = intervals.hourly_calendar(spark).join(counted, ["day_of_week", "hour"], "left").selectExpr("day_of_week", "hour", "coalesce(count, 0L) as orders")
    lk.write_table(hours, path, cluster_by=("day_of_week", "hour"))
    return lk.in_file_order(spark, path).select("day_of_week", "hour", "orders", "place")
