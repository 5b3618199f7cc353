"""The registered queries of these operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streammart.llm import bpe, decontamination, exactdup, fingerprints, html, langid, mixing, neardup, negatives, pii, resampling, sharding, toxicity
from streammart.llm.common import table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(spark, table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(spark, table(spark, sf_dir, "documents"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.rendered(spark, table(spark, sf_dir, "pages"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(spark, table(spark, sf_dir, "documents"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.digests(spark, table(spark, sf_dir, "documents"))


def op6_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.digests(spark, table(spark, sf_dir, "documents"))


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digests(spark, table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digests(spark, table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digests(spark, table(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.query(spark, sf_dir)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.query(spark, sf_dir)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.query(spark, sf_dir)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_pii,
        op3_html_text,
        op4_language,
        op5_near_duplicates,
        op6_exact_duplicates,
        op7_shards,
        op8_toxicity,
        op9_fingerprints,
        op10_mixing,
        op11_decontamination,
        op12_resampling,
        op13_hard_negatives,
    )
}

MIXING = """
with rows as (
    select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) as size,
           md5(coalesce(cast(doc_id as varchar), 'null'))[1:15] as key
    from documents
), sizes as (
    select source, cast(sum(size) as bigint) as source_size,
           ([5, 2, 1])[cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)] as weight
    from rows group by source
), levels as (
    select *, 3 * source_size as cap, 3 * source_size / weight as ratio,
           (sum(source_size) over ()
            - coalesce(sum(3 * source_size) over (order by 3 * source_size / weight, source nulls last
                                                  rows between unbounded preceding and 1 preceding), 0))
           / sum(weight) over (order by 3 * source_size / weight, source nulls last
                               rows between current row and unbounded following) as level
    from sizes
), goals as (
    select source, source_size,
           coalesce(least(cast(cap as double), weight * max(case when level <= ratio then level end) over ()), 0.0) as target
    from levels
), placed as (
    select r.doc_id, r.size, g.source_size, g.target,
           cast(floor(g.target) as bigint) as budget,
           coalesce(sum(r.size) over (partition by r.source order by r.key, r.doc_id
                                      rows between unbounded preceding and 1 preceding), 0) as before
    from rows r join goals g on r.source is not distinct from g.source
)
select doc_id, size, source_size, target,
       cast(case when source_size > 0 then budget // source_size * size
                 + greatest(0, least(size, budget - budget // source_size * source_size - before)) else 0 end as bigint) as taken
from placed
"""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = f"regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

# An occurrence is a run of document words equal to a window, so runs of every length that windows have are joined.
DECONTAMINATION = f"""
with items as (
    select item_id, {WORDS} as words from benchmark where text is not null
), windows as (
    select distinct item_id, least(10, len(words)) as width, array_to_string(words[spot:spot + 9], ' ') as line
    from (select *, unnest(range(1, greatest(1, len(words) - 9) + 1)) as spot from items where len(words) > 0)
), docs as (
    select doc_id, row_number() over () as number, case when text is null then [] else {WORDS} end as words from documents
), runs as (
    select number, spot, width, array_to_string(words[spot:spot + width - 1], ' ') as line
    from (select *, unnest(range(1, len(words) - width + 2)) as spot from docs, (select distinct width from windows))
), found as (
    select number, spot, runs.width, item_id from runs join windows on runs.width = windows.width and runs.line = windows.line
), hit as (
    select number, count(distinct place) as n_hit
    from (select number, unnest(range(spot, spot + width)) as place from (select distinct number, spot, width from found)) group by number
), named as (
    select number, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as names
    from found group by number
)
select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (number) left join named using (number)
"""

HARD_NEGATIVES = """
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q, row_number() over () as number
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
    select a.number, a.vec_id as anchor_id, r.vec_id, a.label = r.label as alike,
           cast(list_dot_product(a.q, r.q) as bigint) as score
    from rows a join rows r on a.number <> r.number
    where a.vec_id % 100 = 0
), positives as (
    select *, row_number() over (partition by number order by score desc, vec_id) as place from pairs where alike
    qualify place <= 5
), mined as (
    select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
           row_number() over (partition by p.number, p.place order by n.score desc, n.vec_id) as rank
    from positives p join pairs n on p.number = n.number and not n.alike
    where 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
    qualify rank <= 10
)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from mined
"""

ORACLE: dict[str, str] = {"op10_mixing": MIXING, "op11_decontamination": DECONTAMINATION, "op13_hard_negatives": HARD_NEGATIVES}
