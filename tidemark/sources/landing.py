"""Landed payloads (JSON, HTML) to typed rows, with rejects kept."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import fixed
from tidemark.functions.text import aliased, computed_once, literal, literals, name, names, with_exprs
from tidemark.sources import html_tables
from tidemark.sources.html_tables import ENTITIES

# ----------------------------------------------------------------- offers


#: Python's idea of white space in text, which the record model strips; more than ASCII blanks.
BLANK = r"[\p{IsWhite_Space}\x1C-\x1F]*"


def explode_offers(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per element of the payload's ``offers`` list, as text columns under table names.

    ``payloads`` carries ``offer_type`` and ``ingested_at`` beside the payload. A default
    applies only to an absent key: an explicit null stays null, so the keys are looked up,
    but only for rows where the value is null. ``_not_text`` lists text columns whose value is
    no JSON string.
    """
    keys = [key for key, _, _ in fixed.OFFER_FIELDS.values() if key]
    shape = literal(", ".join(f"{name(k)} string" for k in keys))
    listed = payloads.selectExpr(
        "ingested_at", "offer_type", f"explode(from_json({name(payload)}, 'offers array<string>').offers) as _offer"
    )
    parsed = computed_once(listed, {"_o": f"from_json(_offer, {shape})"})

    def value(key: str) -> str:
        text = f"_o.{name(key)}"
        if key not in fixed.OFFER_KEY_DEFAULTS:
            return text
        absent = f"{text} is null and not array_contains(json_object_keys(_offer), {literal(key)})"
        return f"case when {absent} then {literal(fixed.OFFER_KEY_DEFAULTS[key])} else {text} end"

    texts = {c: key for c, (key, kind, _) in fixed.OFFER_FIELDS.items() if key and kind == T.StringType()}
    # Without escaped quotes, a quoted key before a quote can only be that key with a text; the pattern is for all other offers.
    def bare(plainly: str) -> str:
        return "array(" + ", ".join(
            rf"""case when _o.{name(key)} is not null {plainly.format(key=key)} and not _offer rlike r'(?<!\\)"{key}"\s*:\s*"' then {literal(c)} end"""
            for c, key in texts.items()
        ) + ")"

    not_text = f"""if(contains(_offer, r'\\"'), {bare("")}, {bare("and not contains(_offer, r'\"{key}\":\"')")})"""
    return parsed.selectExpr(
        "ingested_at", *aliased({c: value(key) if key else name(c) for c, (key, _, _) in fixed.OFFER_FIELDS.items()}),
        f"array_compact({not_text}) as _not_text",
    )


def unreadable_payloads(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Payloads that hold no list of offers, with the rule they fail."""
    listed = f"from_json({name(payload)}, 'offers array<string>').offers"
    rule = f"case when json_object_keys({name(payload)}) is null then 'payload:json' else 'payload:offers' end"
    missing = payloads.filter(f"{listed} is null")
    return missing.selectExpr("ingested_at", "offer_type", name(payload), f"{rule} as failed_rules")


def _inked(char: str) -> str:
    """Whether the first character of a text is ASCII and not blank; false for an empty text. Cheaper than a pattern."""
    return rf"{char} >= '!' and {char} < '\u007f'"


def _each(columns: Sequence[str], value: Callable[[str], str]) -> str:
    """``value`` of each of ``columns``, as an array.

    The expression is written once for all of them. Repeated for each column of a wide table it fills one generated method with
    more code than HotSpot compiles, and every row is interpreted.
    """
    return f"transform(array({names(columns)}), _text -> {value('_text')})"


def blank_text_to_null(df: DataFrame) -> DataFrame:
    """Whitespace-only text to null in every string column; other text stays as it is."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df
    rows = computed_once(df, {"_texts": _each(texts, lambda t: rf"case when {_inked(t)} or not {t} rlike r'^{BLANK}$' then {t} end")})
    return with_exprs(rows, {c: f"get(_texts, {i})" for i, c in enumerate(texts)}).drop("_texts")


def coerced(column: str, kind: T.DataType) -> str:
    """``column``, a text, as ``kind`` by the record model's rules, else null: whole floats are ints, on and off are booleans."""
    own = name(column)
    bare = f"{_inked(own)} and {_inked(f'right({own}, 1)')}"
    text = rf"case when {bare} then {own} else regexp_replace({own}, r'^{BLANK}|{BLANK}$', '') end"
    if isinstance(kind, (T.LongType, T.IntegerType)):
        text = rf"case when contains({own}, '.') then regexp_replace({text}, r'\.0*$', '') else {text} end"
    elif isinstance(kind, T.BooleanType):
        # Cheaper than lower case.
        text = f"case when {text} rlike '^(?i:on)$' then 'true' when {text} rlike '^(?i:off)$' then 'false' else {text} end"
        text = f"case when length({own}) in (4, 5) and {bare} then {own} else {text} end"
    elif isinstance(kind, T.StringType):
        return name(column)
    return f"try_cast({text} as {kind.simpleString()})"


def validate(
    df: DataFrame, types: Mapping[str, T.DataType], required: Sequence[str], accepted: Mapping[str, Sequence[str]],
    wrong_type: Mapping[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Typed rows that pass, and raw rows that fail with ``failed_rules`` naming each reason.

    ``wrong_type`` gives conditions under which a column's value is of the wrong type although it can be read.
    """
    wrong = wrong_type or {}
    kinds: dict[T.DataType, list[str]] = {}
    for c, kind in types.items():
        if kind != T.StringType():
            kinds.setdefault(kind, []).append(c)
    read = {kind: f"_read_{kind.simpleString()}" for kind in kinds}
    value = {c: f"get({name(read[kind])}, {i})" for kind, columns in kinds.items() for i, c in enumerate(columns)}
    # Read once: rules and valid rows both need the values.
    rows = df
    if kinds:
        rows = computed_once(df, {read[kind]: _each(columns, lambda t, kind=kind: coerced(t, kind)) for kind, columns in kinds.items()})
    rules = {f"{c}:required": f"{name(c)} is null" for c in required}
    rules |= {f"{c}:type": wrong.get(c, f"{name(c)} is not null and {value.get(c, name(c))} is null") for c in types if c in wrong or c in value}
    rules |= {f"{c}:enum": f"{name(c)} not in ({literals(values)})" for c, values in accepted.items()}
    reasons = ", ".join(f"case when {cond} then {literal(rule)} end" for rule, cond in rules.items())
    # A list without its nulls stays out of the generated method, unlike one text joined from as many rules.
    checked = rows.selectExpr("*", f"nullif(array_join(array_compact(array({reasons})), ','), '') as failed_rules")
    valid = with_exprs(checked.filter("failed_rules is null"), value)
    return valid.drop("failed_rules", *read.values()), checked.filter("failed_rules is not null").drop(*read.values())


def land_offers(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Offers payloads to (bronze rows, rejects). Whole numbers land as long, measures as double.

    Rejects are raw offers, and whole payloads that hold no list of offers.
    """
    widened = {T.IntegerType(): T.LongType(), T.FloatType(): T.DoubleType()}
    types = {c: widened.get(kind, kind) for c, (_, kind, _) in fixed.OFFER_FIELDS.items()}
    required = [c for c, (_, _, needed) in fixed.OFFER_FIELDS.items() if needed]
    accepted = {"offer_type": fixed.OFFER_TYPES, "verification_flag": fixed.VERIFICATION_FLAGS}
    bare = {c: f"array_contains(_not_text, {literal(c)})" for c, (key, _, _) in fixed.OFFER_FIELDS.items() if key and types[c] == T.StringType()}
    valid, rejects = validate(blank_text_to_null(explode_offers(payloads)), types, required, accepted, bare)
    rejects = rejects.drop("_not_text").unionByName(unreadable_payloads(payloads), allowMissingColumns=True)
    return valid.drop("_not_text"), rejects


# ----------------------------------------------------------------- exchange rates


def rfc1123_timestamp(value: str) -> str:
    """``Fri, 02 Jan 2026 00:00:01 +0000`` to an instant; the weekday name is not parsed."""
    return f"try_to_timestamp(substring({value}, 6), 'dd MMM yyyy HH:mm:ss Z')"


def land_rates(
    payloads: DataFrame, payload: str = "payload",
    from_currency: str = fixed.FROM_CURRENCY, to_currency: str = fixed.TO_CURRENCY,
) -> tuple[DataFrame, DataFrame]:
    """Rates payloads to (bronze rows, rejects); a payload without the rate or the time is rejected."""
    shape = literal("conversion_rates map<string,double>, time_last_update_utc string")
    parsed = payloads.selectExpr("*", f"from_json({name(payload)}, {shape}) as _p")
    rows = parsed.selectExpr(
        name(payload), "ingested_at",
        f"{literal(from_currency)} as from_currency", f"{literal(to_currency)} as to_currency",
        f"try_element_at(_p.conversion_rates, {literal(to_currency)}) as value",
        f"{rfc1123_timestamp('_p.time_last_update_utc')} as timestamp",
    )
    whole = "value is not null and timestamp is not null"
    return rows.filter(whole).drop(payload), rows.filter(f"not ({whole})").select("ingested_at", payload)


# ----------------------------------------------------------------- HTML

def tag_text(value: str) -> str:
    """Text of an HTML fragment: comments, scripts and tags dropped, common entities resolved."""
    text = rf"regexp_replace({value}, r'(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>', '')"
    text = f"regexp_replace({text}, r'(?s)<[^>]*>', '')"
    for entity, char in ENTITIES.items():
        text = f"replace({text}, {literal(entity)}, {literal(char)})"
    return text


def collapse_spaces(value: str) -> str:
    return rf"trim(regexp_replace({value}, r'\s+', ' '))"


def html_table_rows(
    pages: DataFrame, html: str = "html", cells: Sequence[int] = (0, 1, 3),
    into: Sequence[str] = ("tariff_description", "price_mkd_per_kwh", "valid_from"), direct_rows: bool = True,
) -> DataFrame:
    """Table rows that hold a ``td``, with the text of the cells at the given places; a place held by ``th`` gives null.

    ``direct_rows`` leaves out rows inside thead, tbody and tfoot, as a child selector does. Rows are numbered in their table.
    """
    rows = html_tables.table_rows(pages, html).filter("exists(cells, c -> c.kind = 'td')")
    if direct_rows:
        rows = rows.filter("section is null")
    taken = {c: f"case when get(cells, {i}).kind = 'td' then get(cells, {i}).text end" for c, i in zip(into, cells)}
    return rows.selectExpr(*map(name, pages.columns), "table_number", "row_number", *aliased(taken))


def land_tiers(pages: DataFrame, html: str = "html") -> tuple[DataFrame, DataFrame]:
    """Tariff pages to (bronze rows, rejects)."""
    fields = ["tariff_description", "price_mkd_per_kwh", "valid_from"]
    rows = html_table_rows(pages, html).select("ingested_at", *fields)
    return validate(rows, {f: T.StringType() for f in fields}, fields, {})


def html_list_items(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per list item: its place on the page and its text."""
    items = rf"posexplode(regexp_extract_all({name(html)}, r'(?is)<li\b[^>]*>(.*?)</li\s*>', 1)) as (item_number, _item)"
    placed = pages.selectExpr("*", items)
    return with_exprs(placed, {"item_text": collapse_spaces(tag_text("_item"))}).drop("_item")


def drift_gate(df: DataFrame, observed: str, expected: str) -> DataFrame:
    """Only rows whose text, whitespace aside, equals the expected text."""
    return df.filter(f"{collapse_spaces(observed)} = trim({expected})")


# ----------------------------------------------------------------- schedule


def weekly_rows(valid_from: str = fixed.SCHEDULE_VALID_FROM) -> str:
    """The weekly schedule as one literal array of structs."""
    rows = [
        f"named_struct('tariff_type', {literal(kind)}, 'day_of_week', {day}L, 'start_hour', {start}L,"
        f" 'end_hour', {end}L, 'valid_from', {literal(valid_from)})"
        for days, start, end, kind in fixed.WEEKLY_SCHEDULE
        for day in days
    ]
    return f"array({', '.join(rows)})"


def weekly_schedule(spark: SparkSession, valid_from: str = fixed.SCHEDULE_VALID_FROM) -> DataFrame:
    return spark.range(1).selectExpr(f"inline({weekly_rows(valid_from)})")


def land_schedule(
    pages: DataFrame, text: str = "text", expected: str = fixed.SCHEDULE_PAGE_TEXT,
    valid_from: str = fixed.SCHEDULE_VALID_FROM,
) -> DataFrame:
    """The weekly schedule, stamped by each page that still shows the expected text; else no rows."""
    unchanged = drift_gate(pages, name(text), literal(expected))
    return unchanged.selectExpr("ingested_at", f"inline({weekly_rows(valid_from)})")


def snapshot_stamp(df: DataFrame, poll: str, poll_id: str | None = None) -> DataFrame:
    """Give all rows of one poll the same ``ingested_at`` and, if asked, a ``poll_id``."""
    stamps = {"ingested_at": f"cast({poll} as timestamp)"}
    return with_exprs(df, stamps | ({"poll_id": poll_id} if poll_id else {}))
