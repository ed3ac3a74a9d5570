"""For each registered query, SQL over the same tables that DuckDB runs to the same rows."""

from __future__ import annotations

from catalog import queries
from tidemark.functions.text import literal
from tidemark import fixed
from tidemark.functions import metrics
from tidemark.plans import standin

OPEN_TS, OPEN_DAY = "TIMESTAMP '9999-12-31'", "DATE '9999-12-31'"
SCENARIOS = list(fixed.SCENARIOS)
ORACLES: dict[str, str] = {}


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(values) -> str:
    return ", ".join(q(v) for v in values)


def chain(ctes: dict[str, str], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({body})" for n, body in ctes.items()) + "\n" + final


def skey(*parts: str) -> str:
    marked = " || '-' || ".join(f"coalesce(CAST({p} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for p in parts)
    return f"md5({marked})"


# ----------------------------------------------------------------- cleaning and typing

ORACLES["clean_strip_non_ascii"] = (
    r"SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]+', '', 'g') AS text,"
    r" regexp_replace(lang, '[^\x00-\x7F]+', '', 'g') AS lang,"
    r" regexp_replace(source, '[^\x00-\x7F]+', '', 'g') AS source FROM documents"
)
ORACLES["clean_trim"] = (
    "SELECT doc_id, trim(repeat(' ', CAST(doc_id % 3 AS INT)) || text || repeat(' ', CAST(doc_id % 4 AS INT)), ' ') AS text"
    " FROM documents"
)
ORACLES["clean_empty_to_null"] = (
    "SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN nullif(lang, '') END AS lang,"
    " CASE WHEN doc_id % 3 <> 0 THEN nullif(source, '') END AS source FROM documents"
)
ORACLES["clean_replace_suffix"] = (
    "SELECT p_partkey, CASE WHEN p_partkey % 4 = 2 THEN concat(p_name, ' ', p_size, '-Core Processor ', p_brand)"
    " ELSE p_name END AS cpu_model_name FROM part"
)
ORACLES["clean_decimal_separator"] = (
    "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price_mkd_per_kwh,"
    " CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS DOUBLE) AS price FROM orders"
)
ORACLES["parse_date_formats"] = (
    "SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_orderdate AS DATE) END AS valid_from FROM orders"
)
ORACLES["cast_to_schema_permissive"] = (
    "SELECT CASE WHEN event_id % 11 <> 0 THEN CAST(event_id AS INTEGER) END AS event_id, user_id, event_type,"
    " CASE WHEN event_id % 2 = 0 THEN TRUE END AS flag, CAST(NULL AS VARCHAR) AS absent FROM events"
)
ORACLES["null_filter"] = "SELECT event_id, event_type, value FROM events WHERE event_id % 4 <> 0 AND value IS NOT NULL"
ORACLES["dedup_latest"] = (
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber"
    " ORDER BY l_shipdate DESC, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1"
)

# ----------------------------------------------------------------- stand-in offers

_SILVER_TYPES = {"int": "INTEGER", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


def _silver_columns() -> str:
    out = []
    for f in fixed.OFFERS_SILVER.fields:
        text = standin.OFFER_COLUMNS[f.name].replace("0.9D", "0.9::DOUBLE").replace("interval 5 minutes", "INTERVAL 5 MINUTE")
        out.append(f"CAST({text} AS {_SILVER_TYPES[f.dataType.simpleString()]}) AS {f.name}")
    return ", ".join(out)


POLLED = {
    "polled": "SELECT *, date_trunc('hour', ts) AS ingested_at FROM events"
    " QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id) = 1"
}
SILVER = POLLED | {
    "silver": f"SELECT {_silver_columns()} FROM polled LEFT JOIN part ON user_id = p_partkey"
    " LEFT JOIN nation ON user_id % 25 = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"
}


def _staged_columns() -> str:
    out = []
    for f in fixed.OFFERS_SILVER.fields:
        kind = f.dataType.simpleString()
        if f.name in fixed.WHOLE_NUMBER_MEASURES:
            out.append(f"CAST(round(CAST({f.name} AS DOUBLE)) AS BIGINT) AS {f.name}")
        else:
            wide = {"float": "DOUBLE", "int": "BIGINT"}.get(kind)
            out.append(f"CAST({f.name} AS {wide}) AS {f.name}" if wide else f.name)
    return ", ".join(out)


def nearest(value: str) -> str:
    sizes = ", ".join(map(str, fixed.GPU_MEMORY_SIZES_MB))
    return f"(SELECT t FROM (SELECT unnest([{sizes}]) AS t) AS s ORDER BY abs(t - {value}), t LIMIT 1)"


STAGED = SILVER | {"staged": f"SELECT {_staged_columns()} FROM silver"}
# Sizes are looked up per distinct value, then joined.
OFFERS = STAGED | {
    "sizes": f"SELECT gpu_memory_mb AS mb, {nearest('gpu_memory_mb')} AS size_mb"
    " FROM (SELECT DISTINCT gpu_memory_mb FROM staged WHERE gpu_memory_mb IS NOT NULL)",
    "offers": "SELECT * EXCLUDE (gpu_memory_mb, gpu_tflops, ram_mb, disk_bandwidth_mbytes_per_sec, geolocation,"
    " ingested_at, mb, size_mb, gpu_max_cuda_version_supported),"
    " CAST(round(size_mb / 1024) AS BIGINT) AS gpu_memory_gb,"
    " round(gpu_max_cuda_version_supported, 1) AS gpu_max_cuda_version_supported,"
    " gpu_tflops / number_of_gpus AS tflops_per_gpu, gpu_tflops AS total_system_tflops, ram_mb / 1024 AS ram_gb,"
    " disk_bandwidth_mbytes_per_sec / 1024 AS disk_bandwidth_gbytes_per_sec,"
    " nullif(trim(split_part(geolocation, ',', 2)), '') AS country_code,"
    f" ingested_at AS valid_from, {OPEN_TS} AS valid_to FROM staged LEFT JOIN sizes ON mb = gpu_memory_mb",
}
RATES = {
    "daily": "SELECT CAST(ts AS DATE) AS day, CAST(CAST(round(avg(value) / 5) AS FLOAT) AS DOUBLE) AS value"
    " FROM events GROUP BY 1",
    "changed": "SELECT * FROM (SELECT *, lag(value) OVER (ORDER BY day) AS prev FROM daily)"
    " WHERE value <> prev OR prev IS NULL",
    "rates": "SELECT 'USD' AS from_currency, 'MKD' AS to_currency, value, 1.0 / nullif(value, 0) AS inverse_value,"
    f" day AS valid_from, coalesce(CAST(lead(day) OVER (ORDER BY day) - INTERVAL 1 DAY AS DATE), {OPEN_DAY}) AS valid_to,"
    " lead(day) OVER (ORDER BY day) IS NULL AS is_latest, "
    + skey("'USD'", "'MKD'", "value", "CAST(day AS TIMESTAMP)") + " AS skey FROM changed",
}


def _tier_rows() -> str:
    first, second = standin.TIER_VERSIONS
    rows = []
    for start, end, place in ((first, None, 0), (second, None, 1)):
        stop = f"DATE '{second}' - INTERVAL 1 DAY" if place == 0 else OPEN_DAY
        prices = ", ".join(f"CAST({p[place]} AS DOUBLE) AS {code}" for code, p in standin.TIER_PRICES.items())
        rows.append(f"SELECT DATE '{start}' AS tier_from, CAST({stop} AS DATE) AS tier_to, {prices}")
    return " UNION ALL ".join(rows)


def _priced_columns() -> str:
    kwh = "gpu_tdp_watts * number_of_gpus / 1000"
    cost = [
        f"({kwh}) * ({code} + distribution_fee) / nullif(r.value, 0) AS {metrics.COST.format(s)}"
        for s, code in fixed.SCENARIOS.items()
    ]
    return (
        f"o.*, r.skey AS exchange_rate_skey, r.value AS usd_to_mkd_rate, {kwh} AS total_system_kwh_per_hr,"
        f" ({kwh}) / nullif(total_system_tflops, 0) AS kwh_per_tflop,"
        f" total_price_usd_per_hr AS revenue_usd_per_hr, {', '.join(cost)}"
    )


def _margin_columns() -> str:
    out = []
    for s in SCENARIOS:
        cost = metrics.COST.format(s)
        profit = f"(revenue_usd_per_hr - {cost})"
        out.append(f"{profit} AS {metrics.PROFIT.format(s)}")
        out.append(f"{cost} / nullif(total_system_tflops, 0) AS {metrics.COST_PER_TFLOP.format(s)}")
        out.append(f"{profit} / nullif(total_system_tflops, 0) AS {metrics.PROFIT_PER_TFLOP.format(s)}")
    return ", ".join(out)


FACT = OFFERS | RATES | {
    "tiers": _tier_rows(),
    "priced": f"SELECT {_priced_columns()} FROM offers AS o"
    " LEFT JOIN rates AS r ON CAST(o.valid_from AS DATE) >= r.valid_from AND CAST(o.valid_from AS DATE) < r.valid_to"
    " LEFT JOIN tiers ON CAST(o.valid_from AS DATE) >= tier_from AND CAST(o.valid_from AS DATE) < tier_to",
    "last_poll": "SELECT max(valid_from) AS latest FROM offers",
    "live": "SELECT DISTINCT offer_id FROM offers, last_poll WHERE valid_from = latest",
    "fact": "SELECT priced.* REPLACE (CASE WHEN valid_from < latest AND offer_id NOT IN (SELECT offer_id FROM live)"
    f" THEN latest ELSE valid_to END AS valid_to), {_margin_columns()} FROM priced, last_poll",
}
_FACT_COLUMNS = [
    *fixed.FACT_ATTRIBUTES,
    *[p.format(s) for p in (metrics.COST, metrics.PROFIT, metrics.COST_PER_TFLOP, metrics.PROFIT_PER_TFLOP) for s in SCENARIOS],
]

# ----------------------------------------------------------------- refine pipelines


def _first_rows(source: str, keys: list[str], order: list[str], out: str) -> str:
    ranked = ", ".join(f"{c} ASC NULLS FIRST" for c in order)
    return (
        f"SELECT {out} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {ranked}) AS rn"
        f" FROM {source}) WHERE rn = 1"
    )


_CLOCK = "TIMESTAMP '2025-01-01'"
_bronze = [f.name for f in fixed.OFFERS_SILVER.fields if f.name != "processed_at"]
ORACLES["refine_offers"] = chain(
    SILVER
    | {
        "clean": "SELECT * REPLACE (CASE WHEN offer_id % 5 <> 0 THEN disk_model_name END AS disk_model_name,"
        r" regexp_replace(cpu_model_name, '\s+\d+-Cores? Processor$', '') AS cpu_model_name) FROM silver"
    },
    _first_rows(
        "clean", ["offer_id", "offer_type"], [c for c in _bronze if c not in ("offer_id", "offer_type")],
        ", ".join(f"{_CLOCK} AS processed_at" if c == "processed_at" else c for c in fixed.OFFERS_SILVER.names),
    ),
)
ORACLES["refine_rates"] = (
    "SELECT date_trunc('day', min(ts)) AS ingested_at, " + _CLOCK + " AS processed_at, 'USD' AS from_currency,"
    " event_type AS to_currency,"
    " CAST(arg_min(round(value), (CAST(date_trunc('day', ts) AS VARCHAR), round(value))) AS FLOAT) AS value,"
    " date_trunc('hour', ts) AS timestamp FROM events GROUP BY event_type, date_trunc('hour', ts)"
)
_notice = (
    f"list_extract([{listed(standin._DESCRIPTIONS)}], CAST(o_orderkey % {len(standin._DESCRIPTIONS)} + 1 AS INT))"
)
NOTICES = {
    "notices": f"SELECT o_orderkey, o_custkey, {_notice} AS tariff_description,"
    " floor(o_totalprice / 10) / 100 AS price_mkd_per_kwh, CAST(o_orderdate AS DATE) AS valid_from FROM orders"
}
ORACLES["refine_tiers"] = chain(
    NOTICES
    | {
        "clean": "SELECT CAST(valid_from AS TIMESTAMP) + INTERVAL 6 HOUR AS ingested_at,"
        " nullif(tariff_description, '') AS tariff_description,"
        " CAST(CAST(price_mkd_per_kwh AS DECIMAL(18,2)) AS VARCHAR) AS price, valid_from FROM notices"
    },
    _first_rows(
        "clean", ["tariff_description", "valid_from"], ["ingested_at", "price"],
        f"ingested_at, {_CLOCK} AS processed_at, tariff_description, CAST(price AS FLOAT) AS price_mkd_per_kwh, valid_from",
    ),
)
HOURS = {
    "ranges": "SELECT o_orderkey, o_custkey, CAST(isodow(o_orderdate) AS BIGINT) AS day_of_week,"
    " o_orderkey % 22 AS start_hour, o_orderkey % 22 + o_custkey % 7 AS end_hour,"
    " CASE WHEN o_orderstatus = 'F' THEN 'low' ELSE 'high' END AS tariff_type,"
    " CAST(o_orderdate AS DATE) AS valid_from FROM orders",
    "hours": "SELECT o_orderkey, o_custkey, day_of_week, tariff_type, valid_from, h AS hour"
    " FROM ranges JOIN (SELECT CAST(unnest(range(24)) AS BIGINT) AS h) ON start_hour <= h AND h < end_hour",
}
ORACLES["refine_schedule"] = chain(
    {"ranges": HOURS["ranges"]},
    f"SELECT DISTINCT CAST(valid_from AS TIMESTAMP) + INTERVAL 6 HOUR AS ingested_at, {_CLOCK} AS processed_at,"
    " tariff_type, CAST(day_of_week AS INTEGER) AS day_of_week, CAST(start_hour AS INTEGER) AS start_hour,"
    " CAST(end_hour AS INTEGER) AS end_hour, valid_from FROM ranges",
)

# ----------------------------------------------------------------- scalars

_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
ORACLES["scalar_inverse"] = (
    f"SELECT {_LINE}, 1.0::DOUBLE / nullif(l_discount, 0) AS inverse_value, l_quantity / nullif(l_tax, 0) AS ratio FROM lineitem"
)
ORACLES["scalar_mb_to_gb"] = "SELECT p_partkey, CAST(p_size * 300 AS DOUBLE) / 1024 AS gb FROM part"
ORACLES["scalar_nearest_size"] = chain(
    {
        "sized": "SELECT p_partkey, CAST(CASE WHEN p_partkey % 3 = 0 THEN 2560 + p_partkey % 5 * 512"
        " ELSE p_retailprice * p_size END AS DOUBLE) AS mb FROM part",
        "ranked": "SELECT p_partkey, t, row_number() OVER (PARTITION BY p_partkey ORDER BY abs(t - mb), t) AS rn FROM sized,"
        f" (SELECT unnest([{', '.join(map(str, fixed.GPU_MEMORY_SIZES_MB))}]) AS t)",
    },
    "SELECT p_partkey, t AS nearest_mb, CAST(round(t / 1024) AS BIGINT) AS nearest_gb FROM ranked WHERE rn = 1",
)
ORACLES["scalar_country"] = (
    "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN r_name WHEN 2 THEN r_name END AS country_code"
    " FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
)
_TYPE = (
    f"CASE WHEN split_part(tariff_description, ' ', -1) IN ({listed(fixed.HIGH_TARIFF_WORDS)}) THEN 'high'"
    f" WHEN split_part(tariff_description, ' ', -1) IN ({listed(fixed.LOW_TARIFF_WORDS)}) THEN 'low' END"
)
_CODES = ", ".join(f"({q(text)}, {q(code)})" for text, code in fixed.TARIFF_CODES.items())
_CODE = "coalesce((SELECT code FROM codes WHERE codes.text = tariff_description), 'unknown_tariff')"
CODES = {"codes": f"SELECT * FROM (VALUES {_CODES}) AS v(text, code)"}
ORACLES["scalar_tariff_type"] = chain(NOTICES, f"SELECT o_orderkey, {_TYPE} AS tariff_type FROM notices")
ORACLES["scalar_translate"] = chain(
    NOTICES | CODES, f"SELECT o_orderkey, {_CODE} AS tariff_description_en FROM notices"
)


ORACLES["surrogate_key"] = (
    f"SELECT {_LINE}, "
    + skey("l_orderkey", "l_linenumber", "(CASE l_linenumber WHEN 3 THEN NULL WHEN 4 THEN '' ELSE l_returnflag END)")
    + " AS skey FROM lineitem"
)
ORACLES["iso_weekday_hour"] = (
    "SELECT event_id, CAST(isodow(ts) AS BIGINT) AS day_of_week, CAST(hour(ts) AS BIGINT) AS hour_of_day,"
    " date_trunc('hour', ts) AS hour_bucket FROM events"
)

# ----------------------------------------------------------------- landing

ORACLES["landing_json_props"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"
_BAD = {
    "gpu_price_usd_per_hr:required": "event_id % 19 = 0",
    "gpu_architecture:required": "event_id % 23 = 0",
    "cpu_model_name:type": "event_id % 37 = 0",
    "ram_mb:type": "event_id % 29 = 0",
    "verification_flag:enum": "event_id % 17 = 0",
}
_REASONS = ", ".join(f"CASE WHEN {cond} THEN {q(rule)} END" for rule, cond in _BAD.items())
ORACLES["landing_offers"] = (
    "SELECT TIMESTAMP '2024-02-01' AS ingested_at, event_id AS offer_id, user_id % 97 AS machine_id, user_id % 31 AS host_id,"
    " 'on_demand' AS offer_type, value / 100 AS total_price_usd_per_hr, value / 125 AS gpu_price_usd_per_hr,"
    " CASE event_id % 3 WHEN 0 THEN value / 200 WHEN 1 THEN 0.0::DOUBLE END AS minimum_bid_price_usd,"
    " event_type AS gpu_architecture, concat('G', user_id % 7) AS gpu_model_name,"
    " CASE WHEN event_id % 6 < 4 THEN event_id % 4 ELSE 1 END AS number_of_gpus, 65536::DOUBLE AS ram_mb,"
    " 100.5::DOUBLE AS disk_space_gb, CAST(NULL AS VARCHAR) AS cpu_model_name, 'verified' AS verification_flag,"
    " event_id % 2 = 0 AS rentable_flag, event_id % 5 = 0 AS rented_flag FROM events"
    f" WHERE NOT ({' OR '.join(_BAD.values())}) AND event_id // 4 % 50 NOT IN (7, 8)"
)
ORACLES["landing_validate_rejects"] = (
    f"SELECT CAST(event_id AS VARCHAR) AS offer_id, concat_ws(',', {_REASONS}) AS failed_rules FROM events"
    f" WHERE ({' OR '.join(_BAD.values())}) AND event_id // 4 % 50 NOT IN (7, 8) UNION ALL"
    " SELECT NULL, CASE response % 50 WHEN 7 THEN 'payload:json' ELSE 'payload:offers' END"
    " FROM (SELECT DISTINCT event_id // 4 AS response FROM events) WHERE response % 50 IN (7, 8)"
)
ORACLES["rates_payload_parse"] = (
    "SELECT ts AS ingested_at, 'USD' AS from_currency, 'MKD' AS to_currency, value,"
    " date_trunc('second', ts) AS timestamp FROM events WHERE event_id % 9 <> 0"
)


def page_text(value: str) -> str:
    text = f"regexp_replace({value}, '(?is)<!--.*?-->', '', 'g')"
    for tag in ("script", "style"):
        text = rf"regexp_replace({text}, '(?is)<{tag}\b.*?</{tag}\s*>', '', 'g')"
    text = f"regexp_replace({text}, '(?s)<[^>]*>', '', 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = f"replace({text}, {q(entity)}, {q(char)})"
    return rf"trim(regexp_replace({text}, '[ \t\n\v\f\r]+', ' ', 'g'), ' ')"


ORACLES["landing_html_items"] = chain(
    {
        "found": r"SELECT page_id, regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li\s*>', 1) AS items FROM pages",
        "placed": "SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS item_number FROM found",
    },
    f"SELECT page_id, CAST(item_number AS BIGINT) AS item_number, {page_text('item')} AS item_text FROM placed",
)
ORACLES["landing_html_tiers"] = chain(
    NOTICES,
    "SELECT CAST(valid_from AS TIMESTAMP) AS ingested_at, tariff_description,"
    " ' ' || replace(CAST(price_mkd_per_kwh AS VARCHAR), '.', ',') AS price_mkd_per_kwh,"
    " strftime(valid_from, '%d.%m.%Y') AS valid_from FROM notices",
)
ORACLES["landing_drift_gate"] = "SELECT page_id, url FROM pages WHERE page_id % 3 <> 1"
ORACLES["landing_schedule"] = (
    "SELECT TIMESTAMP '2024-01-01' + to_seconds(CAST(c_custkey AS INTEGER)) AS ingested_at, tariff_type,"
    " CAST(d AS BIGINT) AS day_of_week, CAST(s AS BIGINT) AS start_hour, CAST(e AS BIGINT) AS end_hour,"
    " '01.01.2026' AS valid_from FROM customer, (SELECT unnest(range(1, 7)) AS d, 0 AS s, 7 AS e, 'low' AS tariff_type"
    " UNION ALL SELECT unnest(range(1, 7)), 7, 13, 'high' UNION ALL SELECT unnest(range(1, 7)), 13, 15, 'low'"
    " UNION ALL SELECT unnest(range(1, 7)), 15, 22, 'high' UNION ALL SELECT unnest(range(1, 7)), 22, 24, 'low'"
    " UNION ALL SELECT 7, 0, 24, 'low') WHERE c_custkey % 3 <> 0"
)

# ----------------------------------------------------------------- intervals and history

ORACLES["calendar_expand"] = chain(HOURS, "SELECT * FROM hours")
ORACLES["changes_only_values"] = (
    "SELECT event_id, ts, event_type, value FROM (SELECT event_id, ts, event_type, round(value / 10) AS value,"
    " lag(round(value / 10)) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev FROM events)"
    " WHERE value <> prev OR prev IS NULL"
)
ORACLES["changes_only_rates"] = chain(
    RATES,
    "SELECT 'USD' AS from_currency, 'MKD' AS to_currency, value, CAST(day AS TIMESTAMP) AS timestamp,"
    " CAST(day AS TIMESTAMP) AS ingested_at FROM changed",
)
ORACLES["scd2_rates"] = chain(RATES, "SELECT * FROM rates")
_NEXT = "lead(valid_from) OVER (PARTITION BY o_custkey, tariff_description ORDER BY valid_from, o_orderkey)"
HISTORY = NOTICES | CODES | {
    "history": f"SELECT {_TYPE} AS tariff_type, {_CODE} AS tariff_description_en,"
    " tariff_description AS tariff_description_mk, o_orderkey, o_custkey, price_mkd_per_kwh, valid_from, "
    + skey("o_custkey", "tariff_description", "valid_from")
    + f" AS skey, coalesce(CAST({_NEXT} - INTERVAL 1 DAY AS DATE), {OPEN_DAY}) AS valid_to,"
    f" {_NEXT} IS NULL AS is_latest FROM notices"
}
ORACLES["scd2_tiers"] = chain(HISTORY, "SELECT * FROM history")
_NEXT_HOUR = "lead(valid_from) OVER (PARTITION BY o_custkey, day_of_week, hour ORDER BY valid_from, o_orderkey)"
ORACLES["scd2_schedule"] = chain(
    HOURS,
    "SELECT *, " + skey("o_custkey", "day_of_week", "hour", "valid_from")
    + f" AS skey, coalesce({_NEXT_HOUR}, {OPEN_DAY}) AS valid_to, {_NEXT_HOUR} IS NULL AS is_latest FROM hours",
)
ORACLES["interval_join_rates"] = ORACLES["interval_join_salted"] = chain(
    POLLED | RATES,
    "SELECT user_id AS offer_id, ingested_at AS valid_from, r.value AS value, r.valid_from AS rate_from,"
    " r.valid_to AS rate_to FROM polled LEFT JOIN rates AS r"
    " ON CAST(ingested_at AS DATE) >= r.valid_from AND CAST(ingested_at AS DATE) < r.valid_to",
)
_PIVOT = ", ".join(
    f"max(CASE WHEN tariff_description_en = {q(c)} THEN price_mkd_per_kwh END) AS {c}" for c in fixed.TARIFF_CODES.values()
)
ORACLES["tariff_pivot"] = chain(HISTORY, f"SELECT valid_from, valid_to, {_PIVOT} FROM history GROUP BY valid_from, valid_to")

# ----------------------------------------------------------------- warehouse

ORACLES["offers_enriched"] = chain(OFFERS, "SELECT * FROM offers")
ORACLES["fact_offers"] = chain(FACT, f"SELECT {', '.join(_FACT_COLUMNS)} FROM fact")


def staggered(gap: int, by_span: bool) -> str:
    """Tariffs whose second versions start three days apart, as rows of each one's interval or as spans between changes."""
    second = standin.TIER_VERSIONS[1]
    parts = []
    for i, code in enumerate(fixed.TARIFF_CODES.values()):
        before, after = standin.TIER_PRICES[code]
        start = f"CAST(DATE '{second}' + INTERVAL {3 * i} DAY AS DATE)"
        parts.append(
            f"SELECT '{code}' AS code, CAST({before} AS DOUBLE) AS price, DATE '{standin.TIER_VERSIONS[0]}' AS lo,"
            f" CAST({start} - INTERVAL {gap} DAY AS DATE) AS hi UNION ALL SELECT '{code}', CAST({after} AS DOUBLE), {start}, {OPEN_DAY}"
        )
    prices = ", ".join(f"max(price) FILTER (WHERE code = '{c}') AS {c}" for c in fixed.TARIFF_CODES.values())
    versions = " UNION ALL ".join(parts)
    if not by_span:
        return f"SELECT lo AS tier_from, hi AS tier_to, {prices} FROM ({versions}) GROUP BY lo, hi"
    spans = f"SELECT lo AS f, lead(lo, 1, {OPEN_DAY}) OVER (ORDER BY lo) AS t FROM (SELECT DISTINCT lo FROM ({versions}))"
    return f"SELECT f AS tier_from, t AS tier_to, {prices} FROM ({spans}) JOIN ({versions}) ON lo <= f AND f < hi GROUP BY f, t"


_COSTS = ", ".join(metrics.COST.format(s) for s in SCENARIOS)
ORACLES["fact_tiers_by_row"] = chain(FACT | {"tiers": staggered(1, False)}, f"SELECT offer_id, valid_from, {_COSTS} FROM fact")
ORACLES["fact_tiers_by_span"] = chain(FACT | {"tiers": staggered(0, True)}, f"SELECT offer_id, valid_from, {_COSTS} FROM fact")
ORACLES["calendar_hours"] = (
    "SELECT d AS day_of_week, h AS hour, count(ts) AS events FROM (SELECT unnest(range(1, 8)) AS d), (SELECT unnest(range(24)) AS h)"
    " LEFT JOIN events ON isodow(ts) = d AND hour(ts) - hour(ts) % 5 = h GROUP BY d, h"
)
_CELLS = [
    (0, 0, None, 0, 0, "th", "'Key'", 0), (0, 0, None, 0, 1, "td", "CAST(o_orderkey AS VARCHAR)", 1),
    (0, 0, None, 0, 2, "td", "'[in ' || o_custkey || CASE WHEN o_orderkey % 3 = 0 THEN 'twice' ELSE '' END || ']'", 3),
    (0, 0, None, 0, 3, "td", "o_orderstatus || ' & more'", 4), (1, 1, None, 0, 0, "td", "'in ' || o_custkey", 0),
    (0, 0, "tbody", 1, 0, "td", "'last'", 0),
]
ORACLES["landing_html_nested"] = " UNION ALL ".join(
    f"SELECT o_orderkey, {t}::INTEGER AS table_number, {d}::INTEGER AS depth, {literal(section)}::VARCHAR AS section, {r}::INTEGER AS row_number,"
    f" {c}::INTEGER AS cell, '{kind}' AS kind, {text} AS text, {place}::INTEGER AS place FROM orders"
    for t, d, section, r, c, kind, text, place in _CELLS
) + (
    " UNION ALL SELECT o_orderkey, 1::INTEGER, 1::INTEGER, NULL::VARCHAR, 1::INTEGER, 0::INTEGER, 'td', 'twice', 0::INTEGER FROM orders WHERE o_orderkey % 3 = 0"
)
ORACLES["interval_join_asof"] = chain(
    {
        "bought": "SELECT * FROM events WHERE event_type = 'purchase' QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) = 1",
        "states": "SELECT user_id, event_id AS state_id, value AS state_value, ts AS lo, least(ts + INTERVAL 6 HOUR,"
        " coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts), ts + INTERVAL 6 HOUR)) AS hi FROM bought",
    },
    "SELECT e.event_id, state_id, state_value FROM events AS e LEFT JOIN states AS s ON e.user_id = s.user_id AND e.ts >= lo AND e.ts < hi",
)
ORACLES["interval_join_asof_hot"] = chain(
    {
        "bought": "SELECT * FROM events WHERE event_type = 'purchase' QUALIFY row_number() OVER (PARTITION BY ts ORDER BY event_id) = 1",
        "states": "SELECT event_id AS state_id, ts AS lo, least(ts + INTERVAL 90 SECOND, coalesce(lead(ts) OVER (ORDER BY ts), ts + INTERVAL 90 SECOND)) AS hi FROM bought",
    },
    "SELECT e.event_id, state_id FROM events AS e LEFT JOIN states AS s ON e.ts >= lo AND e.ts < hi",
)
_BY_LOAD = {
    ("not_null", "user_id", "error"): "count(*) FILTER (WHERE user_id IS NULL)",
    ("not_null", "event_type", "error"): "count(*) FILTER (WHERE event_type IS NULL)",
    ("accepted_values", "event_type", "warn"): "count(*) FILTER (WHERE event_type NOT IN ('view', 'click', 'purchase', 'signup'))",
    ("expression", "value > 0.5", "error"): "count(*) FILTER (WHERE NOT value > 0.5)",
    ("expression", "value < 250", "error"): "count(*) FILTER (WHERE NOT value < 250)",
    ("unique_keys", "user_id, ts", "error"): "max((SELECT count(*) FROM (SELECT 1 FROM hourly GROUP BY user_id, t HAVING count(*) > 1)))",
    ("unique_keys", "event_type, ts", "error"): "max((SELECT count(*) FROM (SELECT 1 FROM hourly GROUP BY event_type, t HAVING count(*) > 1)))",
}
ORACLES["dq_by_load"] = "WITH hourly AS (SELECT *, date_trunc('hour', ts) AS t FROM events) " + " UNION ALL ".join(
    f"SELECT 'events' AS table_name, '{check}' AS check_name, '{target}' AS target, '{severity}' AS severity, CAST({n} AS BIGINT) AS failures FROM hourly"
    for (check, target, severity), n in _BY_LOAD.items()
)
ORACLES["stream_dedup_state"] = "SELECT event_id, user_id, ts, value FROM events"
ORACLES["sorted_sink"] = "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS place FROM events"
ORACLES["schedule_in_order"] = (
    "SELECT d AS day_of_week, h AS hour, count(o_orderkey) AS orders, row_number() OVER (ORDER BY d, h) AS place"
    " FROM (SELECT CAST(unnest(range(1, 8)) AS BIGINT) AS d), (SELECT CAST(unnest(range(24)) AS BIGINT) AS h)"
    " LEFT JOIN orders ON isodow(o_orderdate) = d AND o_orderkey % 24 = h GROUP BY d, h"
)
ORACLES["close_absent"] = chain(
    POLLED | {"last_poll": "SELECT max(ingested_at) AS latest FROM polled"},
    "SELECT user_id AS offer_id, ingested_at AS valid_from, CASE WHEN user_id IN (SELECT user_id FROM polled, last_poll"
    f" WHERE ingested_at = latest) OR ingested_at = latest THEN {OPEN_TS} ELSE latest END AS valid_to FROM polled, last_poll",
)
REPLAY = POLLED | {
    "numbered": "SELECT ingested_at, row_number() OVER (ORDER BY ingested_at) AS n FROM (SELECT DISTINCT ingested_at FROM polled)",
    "islands": "SELECT user_id, event_id, value, p.ingested_at, n,"
    " n - row_number() OVER (PARTITION BY user_id ORDER BY n) AS island FROM polled AS p JOIN numbered USING (ingested_at)",
    "runs": "SELECT *, max(n) OVER (PARTITION BY user_id, island) AS last_n FROM islands",
    "closed": "SELECT user_id AS offer_id, event_id, value, runs.ingested_at AS valid_from,"
    f" coalesce(nx.ingested_at, {OPEN_TS}) AS valid_to FROM runs LEFT JOIN numbered AS nx ON nx.n = last_n + 1",
}
ORACLES["close_absent_replay"] = chain(REPLAY, "SELECT offer_id, valid_from, valid_to FROM closed")
ORACLES["close_absent_doubled"] = chain(
    REPLAY,
    "SELECT offer_id, valid_from, valid_to FROM closed UNION ALL SELECT offer_id, valid_from, valid_to FROM closed WHERE offer_id % 5 = 0",
)
ORACLES["stream_poll_merge"] = ORACLES["fact_store_polls"] = chain(
    REPLAY, "SELECT offer_id, valid_from, valid_to, event_id, value FROM closed"
)
def replayed_until(cut: str) -> str:
    """The fact after the polls before ``cut``, as rows of ``REPLAY``'s columns."""
    return (
        "SELECT user_id AS offer_id, runs.ingested_at AS valid_from, coalesce(nx.ingested_at, " + OPEN_TS + ") AS valid_to, event_id, value FROM ("
        f"SELECT *, max(n) OVER (PARTITION BY user_id, island) AS last_n FROM islands, span WHERE ingested_at < {cut}) AS runs"
        f" LEFT JOIN (SELECT numbered.* FROM numbered, span WHERE ingested_at < {cut}) AS nx ON nx.n = last_n + 1"
    )


_CUTS = {f"cut{i}": f"date_trunc('hour', lo + (hi - lo) / 3 * {i})" for i in (1, 2)}
ORACLES["fact_audit_publish"] = chain(
    REPLAY | {"span": f"SELECT {', '.join(f'{e} AS {c}' for c, e in _CUTS.items())} FROM (SELECT min(ts) AS lo, max(ts) AS hi FROM events)"},
    f"SELECT *, 'refused' AS state FROM ({replayed_until('cut1')}) UNION ALL SELECT *, 'mended' FROM ({replayed_until('cut2')})"
    " UNION ALL SELECT offer_id, valid_from, valid_to, event_id, value, 'next' FROM closed",
)
ORACLES["stream_late_rows"] = chain(
    {
        "marked": "SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN user_id END AS id,"
        " CASE WHEN event_id % 89 <> 0 THEN ts END AS ts FROM events",
        "span": "SELECT min(ts) AS lo, max(ts) AS hi FROM marked",
        "placed": "SELECT event_id, id, date_trunc('hour', ts) AS poll, CASE WHEN ts IS NULL THEN 3"
        " WHEN ts < date_trunc('hour', lo + (hi - lo) / 3) THEN CASE WHEN event_id % 50 = 7 THEN 2 ELSE 1 END"
        " WHEN ts < date_trunc('hour', lo + (hi - lo) / 3 * 2) THEN 2 ELSE 3 END AS part FROM marked, span",
        "numbered": "SELECT *, row_number() OVER (PARTITION BY part, id, poll ORDER BY event_id) AS nth FROM placed",
        "highs": "SELECT part + 1 AS part, max(max(poll)) OVER (ORDER BY part) AS high FROM placed WHERE id IS NOT NULL GROUP BY part",
    },
    "SELECT event_id, CASE WHEN id IS NULL OR poll IS NULL THEN 'no key' WHEN nth > 1 THEN 'double'"
    " WHEN poll <= high THEN 'late' ELSE 'fact' END AS fate FROM numbered LEFT JOIN highs USING (part)",
)
ORACLES["upsert_stored"] = (
    "SELECT event_id % 500 AS k, nullif(event_type, 'error') AS kind, event_id, value FROM events"
    " WHERE event_id % 3 <> 0 OR event_id % 500 < 250 QUALIFY"
    # Null keys match nothing: of each batch one row stays for them, the second does not replace the first.
    " row_number() OVER (PARTITION BY k, kind, CASE WHEN kind IS NULL THEN event_id % 3 = 0 END"
    " ORDER BY event_id % 3 <> 0, event_id) = 1"
)
_CUT = "TIMESTAMP '2024-01-20'"
ORACLES["watermark_increment"] = f"SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < {_CUT})"
ORACLES["merge_upsert"] = (
    "SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type"
    " ORDER BY CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END, event_id) AS rn FROM events) WHERE rn = 1"
)
ORACLES["schema_append"] = (
    f"SELECT event_id, CASE WHEN ts < {_CUT} THEN user_id END AS user_id, value,"
    f" CASE WHEN ts >= {_CUT} THEN event_type END AS event_type FROM events"
)

_POLL_TIMES = " UNION ALL ".join(f"SELECT {i} AS p, TIMESTAMP '{t}' AS polled" for i, t in enumerate(queries._FLOW_POLLS))
ORACLES["dataset_flow"] = chain(
    {
        "times": _POLL_TIMES,
        "sent": "SELECT event_id % 2 AS p, user_id AS id, 1 + sum(CAST(floor(abs(value)) AS BIGINT)) AS price FROM events GROUP BY 1, 2",
        "seen": "SELECT p, id, price, polled FROM sent JOIN times USING (p) WHERE id % 11 <> 0",
        "open": "SELECT s.* FROM seen AS s WHERE (SELECT count(*) FROM seen AS t WHERE t.id = s.id AND t.p >= s.p) = 2 - s.p",
    },
    "SELECT 'published' AS item, unnest(['exchange_rates', 'electricity_tariff_tiers', 'electricity_tariff_schedule', 'compute_offers', 'marts'])"
    " AS label, CAST(unnest([1, 1, 1, 3, 4]) AS BIGINT) AS n"
    " UNION ALL SELECT 'fact day', CAST(CAST(polled AS DATE) AS VARCHAR), count(*) FROM seen GROUP BY 2"
    " UNION ALL SELECT 'fact open', '', count(*) FROM open"
    " UNION ALL SELECT 'fact revenue', CAST(CAST(polled AS DATE) AS VARCHAR), CAST(sum(price) AS BIGINT) FROM seen GROUP BY 2"
    " UNION ALL SELECT 'silver poll', strftime(polled, '%Y%m%d%H%M%S'), count(*) FROM seen GROUP BY 2"
    " UNION ALL SELECT 'reject', 'verification_flag:enum', count(*) FROM sent WHERE id % 11 = 0"
    " UNION ALL SELECT 'opportunities', '', count(*) FROM open WHERE id % 2 = 1"
    " UNION ALL SELECT 'trend day', CAST(CAST(polled AS DATE) AS VARCHAR), count(DISTINCT (polled, id % 7)) FROM seen GROUP BY 2",
)

# ----------------------------------------------------------------- marts

AVAILABLE = FACT | {
    "available": f"SELECT * FROM fact WHERE valid_to = {OPEN_TS} AND total_system_tflops > 0 AND revenue_usd_per_hr > 0"
    " AND gpu_tdp_watts > 0 AND rentable_flag AND NOT rented_flag AND verification_flag = 'verified'"
}
_BEST_FIRST = [
    "profit_per_tflop_business_high_usd DESC NULLS LAST", "reliability_score DESC NULLS LAST", "gpu_tdp_watts NULLS FIRST",
    "pcie_bandwidth_gbytes_per_sec DESC NULLS LAST", "gpu_bandwidth_gbytes_per_sec DESC NULLS LAST",
    "valid_from DESC", "offer_id",
]
_BOTH = [p.format(s) for p in (metrics.PROFIT, metrics.PROFIT_PER_TFLOP) for s in SCENARIOS]
OPPORTUNITIES = AVAILABLE | {
    "opportunities": "SELECT *, CAST(row_number() OVER (PARTITION BY offer_type ORDER BY "
    + ", ".join(_BEST_FIRST) + ") AS INTEGER) AS arbitrage_rank FROM available"
}
ORACLES["mart_opportunities_ranged"] = chain(
    AVAILABLE,
    "SELECT offer_type, offer_id, valid_from, CAST(row_number() OVER (PARTITION BY offer_type ORDER BY"
    " profit_per_tflop_business_high_usd DESC NULLS LAST, valid_from, offer_id) AS INTEGER) AS place FROM available",
)
ORACLES["mart_opportunities"] = chain(
    OPPORTUNITIES,
    f"SELECT {', '.join([*fixed.OPPORTUNITY_ATTRIBUTES, *_BOTH, 'valid_from'])} FROM opportunities",
)
_PER_GPU = ["revenue_usd_per_hr / nullif(number_of_gpus, 0) AS revenue_per_gpu_usd_per_hr"] + [
    f"{kind}_{s}_usd_per_hr / nullif(number_of_gpus, 0) AS {kind}_{s}_per_gpu_usd_per_hr"
    for kind in ("cost", "profit") for s in SCENARIOS
]
_TFLOP_PROFITS = [metrics.PROFIT_PER_TFLOP.format(s) for s in SCENARIOS]
BEST = AVAILABLE | {
    "best": f"SELECT {', '.join([*fixed.BEST_OFFER_ATTRIBUTES, *_PER_GPU, *_TFLOP_PROFITS, 'valid_from'])} FROM available"
    " QUALIFY row_number() OVER (PARTITION BY offer_type, gpu_architecture, gpu_model_name, gpu_memory_gb ORDER BY"
    " valid_from DESC, profit_business_high_usd_per_hr / nullif(number_of_gpus, 0) DESC NULLS LAST, offer_id) = 1"
}
ORACLES["mart_best_offers"] = chain(BEST, "SELECT * FROM best")


def share(condition: str) -> str:
    return f"round(100.0::DOUBLE * count(*) FILTER (WHERE {condition}) / count(*), 2)"


_SUMMARY = [
    "count(*) AS total_offer_observations", "avg(kwh_per_tflop) AS avg_kwh_per_tflop",
    "avg(revenue_usd_per_hr / nullif(number_of_gpus, 0)) AS avg_revenue_per_gpu_usd_per_hr",
    *[f"{share(metrics.PROFIT.format(s) + ' > 0')} AS pct_profitable_{s}" for s in SCENARIOS],
    share("verification_flag = 'verified'") + " AS pct_verified", share("NOT rented_flag") + " AS pct_available",
    "avg(reliability_score) AS avg_reliability_score", "max(valid_from) AS last_seen_at",
]
SUMMARY = FACT | {
    "summary": f"SELECT {', '.join([*fixed.SUMMARY_KEYS, *_SUMMARY])} FROM fact WHERE valid_to = {OPEN_TS} GROUP BY ALL"
}
_MEANS = ["avg_kwh_per_tflop", "avg_revenue_per_gpu_usd_per_hr", "avg_reliability_score"]
ORACLES["mart_model_summary"] = chain(
    SUMMARY, f"SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in _MEANS)}) FROM summary"
)

_FIRST, _CHANGE = (f"DATE '{d}'" for d in (standin.SCHEDULE_FROM, standin.SCHEDULE_CHANGE))
_HOURS = " UNION ALL ".join(
    f"SELECT unnest(range({days.start}, {days.stop})) AS s_day, {start} AS s_start, {end} AS s_end, {q(kind)} AS kind"
    for days, start, end, kind in fixed.WEEKLY_SCHEDULE
)
_STATS = [
    f"{stat}({c}) AS {stat}_{c}"
    for p in (metrics.PROFIT, metrics.PROFIT_PER_TFLOP)
    for stat in ("avg", "min", "max")
    for c in [p.format(s) for s in SCENARIOS]
]
_TREND_GROUP = [
    {"offer_type": "offer_type", "gpu_model_name": "concat('M', offer_id % 2) AS gpu_model_name", "gpu_architecture": "'A' AS gpu_architecture"}.get(
        c, f"CASE WHEN false THEN {c} END AS {c}"
    )
    for c in fixed.TREND_KEYS
]


def trends(local: str) -> dict[str, str]:
    """``local`` is the time at which tariff hours are looked up."""
    return FACT | {
        "hours": _HOURS,
        "week": f"SELECT s_day, s_start, s_end, kind, {_FIRST} AS s_from, CASE WHEN s_day < 7 THEN"
        f" CAST({_CHANGE} - INTERVAL 1 DAY AS DATE) ELSE {OPEN_DAY} END AS s_to FROM hours UNION ALL"
        " SELECT s_day, s_start, s_end, CASE WHEN s_day > 3 THEN kind WHEN kind = 'low' THEN 'high' ELSE 'low' END,"
        f" {_CHANGE}, {OPEN_DAY} FROM hours WHERE s_day < 7",
        "polled6": "SELECT * REPLACE (date_trunc('day', valid_from) + to_hours(CAST(floor(hour(valid_from) / 6) * 6 AS BIGINT))"
        " AS valid_from) FROM fact",
        "timed": f"SELECT *, {local} AS local FROM polled6",
        "trends": "SELECT date_trunc('hour', valid_from) AS hour_bucket, CAST(isodow(local) AS BIGINT) AS day_of_week,"
        " CAST(hour(local) AS BIGINT) AS hour_of_day, kind AS tariff_window, "
        + ", ".join(_TREND_GROUP)
        + ", count(*) AS offer_count, avg(revenue_usd_per_hr) AS avg_revenue_usd_per_hr, " + ", ".join(_STATS)
        + " FROM timed LEFT JOIN week ON isodow(local) = s_day AND hour(local) >= s_start AND hour(local) < s_end"
        " AND CAST(local AS DATE) >= s_from AND CAST(local AS DATE) < s_to GROUP BY ALL",
    }


TRENDS = trends("valid_from")
_TREND_MEANS = ["avg_revenue_usd_per_hr", *[f"avg_{c}" for c in _BOTH]]
_TREND_ROWS = f"SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in _TREND_MEANS)}) FROM trends"
ORACLES["mart_trends"] = chain(TRENDS, _TREND_ROWS)
ORACLES["mart_trends_incremental"] = ORACLES["mart_trends"]
ORACLES["mart_trends_local"] = chain(trends("valid_from + INTERVAL 1 HOUR"), _TREND_ROWS)

_PROFIT = "profit_business_high_usd_per_hr"
ORACLES["dash_rate_by_type"] = chain(
    SUMMARY, f"SELECT {', '.join([*fixed.SUMMARY_KEYS, *[f'pct_profitable_{s}' for s in SCENARIOS]])} FROM summary"
)
ORACLES["dash_best_profit"] = chain(
    BEST,
    "SELECT gpu_model_name, max(profit_business_high_per_gpu_usd_per_hr) AS best_profit_per_gpu FROM best GROUP BY 1",
)
ORACLES["dash_profit_over_time"] = chain(
    TRENDS,
    "SELECT hour_bucket, gpu_model_name, CAST(sum(offer_count) AS BIGINT) AS offers,"
    f" round(sum(avg_{_PROFIT} * offer_count) / sum(CASE WHEN avg_{_PROFIT} IS NOT NULL THEN offer_count END), 6)"
    " AS avg_profit FROM trends GROUP BY ALL",
)
ORACLES["dash_heatmap"] = chain(
    TRENDS,
    "SELECT day_of_week, "
    + ", ".join(f"round(avg(CASE WHEN hour_of_day = {h} THEN avg_{_PROFIT} END), 6) AS h{h:02d}" for h in range(24))
    + " FROM trends GROUP BY 1",
)
ORACLES["dash_risk_reward"] = chain(
    AVAILABLE, f"SELECT offer_id, offer_type, gpu_model_name, reliability_score, {_PROFIT} FROM available"
)
_TFLOP = "profit_per_tflop_business_high_usd"
ORACLES["dash_profit_per_tflop"] = chain(
    AVAILABLE,
    f"SELECT gpu_model_name, round(avg({_TFLOP}), 6) AS avg_profit_per_tflop, max({_TFLOP}) AS max_profit_per_tflop,"
    " count(*) AS offers FROM available GROUP BY 1",
)
ORACLES["dash_live_count"] = chain(AVAILABLE, "SELECT count(*) AS live_offers FROM available")

# ----------------------------------------------------------------- data quality


def report(table: str, source: str, rules: list[tuple[str, str, str, str]], keys: list[tuple[str, list[str], bool]]) -> str:
    """One SELECT per check, each scanning the table for itself. ``rules``: check, target, severity, failing condition."""
    row = "SELECT {} AS table_name, {} AS check_name, {} AS target, {} AS severity, count(*) AS failures FROM {}"
    parts = [
        row.format(q(table), q(check), q(target), q(severity), source) + f" WHERE {condition}"
        for check, target, severity, condition in rules
    ]
    for check, columns, skip_nulls in keys:
        there = f" WHERE {' AND '.join(f'{k} IS NOT NULL' for k in columns)}" if skip_nulls else ""
        doubled = f"(SELECT 1 FROM {source}{there} GROUP BY {', '.join(columns)} HAVING count(*) > 1)"
        parts.append(row.format(q(table), q(check), q(", ".join(columns)), "'error'", doubled))
    return " UNION ALL ".join(parts)


def absent(columns: str, severity: str = "error") -> list[tuple[str, str, str, str]]:
    return [("not_null", c, severity, f"{c} IS NULL") for c in columns.split()]


def low(columns: str, severity: str = "error", zero: bool = False) -> list[tuple[str, str, str, str]]:
    """Below zero, or zero too unless that is allowed."""
    return [("expression", f"{c} >= 0", severity, f"{c} < 0") if zero else ("expression", f"{c} > 0", severity, f"{c} <= 0") for c in columns.split()]


_KEPT_IDS = "offer_id machine_id host_id"
_KEPT_HOST = (
    "gpu_architecture gpu_model_name number_of_gpus gpu_bandwidth_gbytes_per_sec cpu_architecture number_of_cpu_cores disk_space_gb"
    " pcie_generation network_download_mbits_per_sec network_upload_mbits_per_sec reliability_score verification_flag rentable_flag rented_flag"
)
_KEPT_SOFT = "gpu_tdp_watts cpu_model_name disk_model_name pcie_bandwidth_gbytes_per_sec deep_learning_score"
_SPEEDS = (
    "gpu_bandwidth_gbytes_per_sec number_of_cpu_cores pcie_bandwidth_gbytes_per_sec network_download_mbits_per_sec network_upload_mbits_per_sec"
)
_UNSIGNED = (
    "total_price_usd_per_hr deep_learning_score_per_usd minimum_bid_price_usd storage_cost_usd_per_hr"
    " network_upload_cost_usd_per_gbit network_download_cost_usd_per_gbit"
)
_VERIFICATION = ("accepted_values", "verification_flag", "error", "verification_flag NOT IN ('verified', 'unverified', 'deverified')")
_STAGED_RULES = [
    *absent(f"{_KEPT_IDS} offer_type gpu_price_usd_per_hr {_UNSIGNED} {_KEPT_HOST} gpu_memory_mb gpu_tflops ram_mb ingested_at processed_at"),
    *absent(f"{_KEPT_SOFT} cpu_clock_speed_ghz disk_bandwidth_mbytes_per_sec", "warn"),
    ("accepted_values", "offer_type", "error", "offer_type NOT IN ('on_demand', 'bid', 'reserved')"), _VERIFICATION,
    *low(f"{_UNSIGNED} reliability_score", zero=True),
    ("expression", "gpu_price_usd_per_hr <= total_price_usd_per_hr", "error", "gpu_price_usd_per_hr > total_price_usd_per_hr"),
    *low("number_of_gpus disk_space_gb pcie_generation gpu_memory_mb gpu_tflops"),
    *low(f"{_SPEEDS} cpu_clock_speed_ghz ram_mb disk_bandwidth_mbytes_per_sec", "warn"),
]
_cost, _cost_per_tflop = (" ".join(p.format(s) for s in SCENARIOS) for p in ("cost_{}_usd_per_hr", "cost_per_tflop_{}_usd"))
_FACT_RULES = [
    *absent(f"{_KEPT_IDS} {_KEPT_HOST} gpu_memory_gb ram_gb deep_learning_score_per_usd gpu_price_usd_per_hr revenue_usd_per_hr"),
    *absent(
        f"{_KEPT_SOFT} country_code tflops_per_gpu disk_bandwidth_gbytes_per_sec total_system_kwh_per_hr total_system_tflops usd_to_mkd_rate {_cost}",
        "warn",
    ),
    _VERIFICATION,
    *low("number_of_gpus disk_space_gb pcie_generation gpu_memory_gb reliability_score"),
    *low("ram_gb deep_learning_score_per_usd gpu_price_usd_per_hr revenue_usd_per_hr", zero=True),
    *low(
        f"{_SPEEDS} disk_bandwidth_gbytes_per_sec total_system_kwh_per_hr total_system_tflops kwh_per_tflop usd_to_mkd_rate {_cost} {_cost_per_tflop}",
        "warn",
    ),
    ("expression", "country_code = upper(country_code)", "warn", "country_code <> upper(country_code)"),
    ("expression", "valid_from < valid_to", "error", "valid_from >= valid_to"),
]
ORACLES["dq_report"] = chain(
    FACT,
    report("stg_compute_offers", "staged", _STAGED_RULES, [("unique_keys", ["offer_id", "ingested_at"], False)])
    + " UNION ALL " + report("fct_compute_offers", "fact", _FACT_RULES, [("unique_keys", ["offer_id", "valid_from"], False)]),
)
ORACLES["dq_duplicates"] = (
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"
)
ORACLES["dq_intervals"] = chain(
    HISTORY,
    report(
        "tariff_history", "history",
        [*absent("tariff_type"), ("expression", "valid_from < valid_to", "error", "valid_from >= valid_to")],
        [("unique", ["skey"], True), ("unique_keys", ["o_custkey", "tariff_description_mk", "valid_from"], False)],
    ),
)
ORACLES["dq_hour_range"] = chain(
    {"ranges": HOURS["ranges"]},
    "SELECT 'order_schedule' AS table_name, 'singular' AS check_name, 'hour range' AS target, 'error' AS severity,"
    " count(*) AS failures FROM ranges WHERE start_hour >= end_hour",
)
