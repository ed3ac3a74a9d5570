"""The registered queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    ann, exact_dedup, hard_negatives, html_text, mixing, near_dedup, packing, quality_model, quality_rules, secret_scan, sharding, token_files, vector_codes,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@register
def op1_html_text(spark, sf):
    return html_text.extract(table(spark, sf, "pages"))


@register
def op2_mixing(spark, sf):
    return mixing.mix_report(table(spark, sf, "documents"))


@register
def op3_secret_scan(spark, sf):
    return secret_scan.secret_report(table(spark, sf, "documents"))


@register
def op4_token_files(spark, sf):
    return token_files.token_report(table(spark, sf, "documents"))


@register
def op5_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"))


@register
def op6_sharding(spark, sf):
    return sharding.shard_by_bytes(table(spark, sf, "documents"))


@register
def op7_exact_dedup(spark, sf):
    return exact_dedup.exact_groups(table(spark, sf, "documents"))


@register
def op8_ann(spark, sf):
    return ann.search(table(spark, sf, "embeddings"))


@register
def op9_near_dedup(spark, sf):
    return near_dedup.near_components(table(spark, sf, "documents"))


@register
def op10_quality(spark, sf):
    return quality_model.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register
def op11_vector_codes(spark, sf):
    return vector_codes.code_report(table(spark, sf, "embeddings"))


@register
def op12_quality_rules(spark, sf):
    return quality_rules.rule_report(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register
def op13_hard_negatives(spark, sf):
    return hard_negatives.negative_report(table(spark, sf, "embeddings"))


#: Rows with a finite vector, as SQL.
_FINITE = "embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"


def _codes_sql(rounds: int = 4) -> str:
    """The training of codebooks written out, one pair of tables per round, by measuring all pairs of parts and entries."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        near{r} as materialized (
            select vec_id, label, p, w, min((w2 + e2 - 2 * list_inner_product(w, ew))::bigint * 256 + e) as best
            from parts join book{r} using (p) group by all
        )""")
        if r < rounds:
            steps.append(f"""
        moved{r} as (select p, e, list(m order by i)::double[] as mw from (
            select p, best % 256 as e, i, floor(sum(w[i]) / count(*)) as m from near{r}, range(1, 17) as t(i) group by all) group by p, e),
        book{r + 1} as materialized (select p, e, coalesce(mw, ew) as ew, list_inner_product(coalesce(mw, ew), coalesce(mw, ew)) as e2 from book{r} left join moved{r} using (p, e))""")
    return f"""
        with parts as materialized (
            select vec_id, label, p, w, list_inner_product(w, w) as w2 from (
                select vec_id, label, p, list_transform(embedding[p * 16 + 1 : p * 16 + 16], lambda x: floor(1024 * x::double)) as w
                from embeddings, range(4) as t(p) where {_FINITE})
        ),
        book0 as materialized (
            select p, row_number() over (partition by p order by vec_id) - 1 as e, w as ew, w2 as e2 from parts
            qualify row_number() over (partition by p order by vec_id) <= 256
        ),{",".join(steps)},
        books as (select sha256(string_agg(ew[i]::bigint::varchar, ',' order by p, e, i)) as codebooks_sha256 from book{rounds}, range(1, 17) as t(i)),
        codes as (select vec_id, label, string_agg(printf('%02x', best % 256), '' order by p) as code, sum(best // 256)::bigint as error from near{rounds} group by all)
        select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from codes, books
    """


ORACLES: dict[str, str] = {
    "op11_vector_codes": _codes_sql(),
    "op13_hard_negatives": f"""
        with rows as materialized (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings where label is not null and {_FINITE}
        ),
        scores as materialized (
            select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same, list_inner_product(a.v, r.v)::bigint as score
            from rows a join rows r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0
        ),
        positives as (
            select anchor_id, vec_id as positive_id, score as positive_score from scores where same
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
        ),
        found as (
            select p.*, s.vec_id as negative_id, s.score as negative_score,
                row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id)::int as rank
            from positives p join scores s on p.anchor_id = s.anchor_id and not s.same
                and 80 * positive_score <= 100 * s.score and s.score <= positive_score
        )
        select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from found where rank <= 5
    """,
    "op7_exact_dedup": """
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
            doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
        from documents window same as (partition by coalesce(text, ''))
    """,
}
