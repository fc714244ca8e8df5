"""One registered query for each corpus operator, and check SQL where DuckDB can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyloom.llm import (
    balanced_mix,
    cover_tree,
    decontaminate,
    filter_audit,
    importance,
    language,
    line_dedup,
    personal_data,
    quality,
    sentencepiece_dropout,
    simhash,
    toxicity,
    url_rules,
)
from supplyloom.llm.common import table
from supplyloom.session import apply_defaults

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(apply_defaults(spark), folder)

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register


DECONTAMINATION_SQL = r"""
WITH d AS (
    SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM benchmark
), phrase AS (
    SELECT DISTINCT item, least(len(w), 10) AS n,
        array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS p
    FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)
), place AS (
    SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS p
    FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
          FROM d, (SELECT DISTINCT n FROM phrase) WHERE len(w) >= n)
), hit AS (
    SELECT doc_id, item, place.n, i FROM place JOIN phrase USING (p) WHERE place.n = phrase.n
), inside AS (
    SELECT doc_id, count(DISTINCT pos) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS pos FROM hit) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN inside USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op5_benchmark_decontamination", DECONTAMINATION_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that stand inside a ten-word window of a benchmark item."""
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op6_simhash_near_dedup")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op9_line_dedup")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its lines, how many of them repeat an earlier line, and their numbers from 0."""
    return line_dedup.dedup_lines(table(spark, folder, "documents")).select(
        "doc_id",
        F.col("__lines").alias("n_lines"),
        F.size("__gone").cast("long").alias("n_removed"),
        F.array_join("__gone", ",").alias("removed"),
    )


SEARCH_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(d.v AS DOUBLE[])) AS BIGINT) AS score
    FROM v AS q JOIN v AS d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""


@query("op1_exact_top_k_search", SEARCH_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """The five largest inner products of every query vector."""
    vectors = cover_tree.quantized(table(spark, folder, "embeddings"))
    return cover_tree.top_k(vectors, vectors.filter("vec_id % 50 = 0"))


@query("op2_personal_data")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base spans, all accepted spans."""
    return personal_data.report(table(spark, folder, "documents"))


@query("op3_url_rules")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every URL by given and mined rules."""
    return url_rules.judge(table(spark, folder, "pages"), table(spark, folder, "labels"))


@query("op4_sentencepiece_dropout")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: number of pieces under merge-dropout, digest of their ids, and whether they decode to the text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    coded = docs.select("doc_id", sentencepiece_dropout.encode_checked(F.col("text"), F.col("doc_id")).alias("coded"))
    return coded.select(
        "doc_id",
        F.size("coded.pieces").cast("long").alias("n_pieces"),
        F.xxhash64("coded.pieces").alias("pieces_hash"),
        F.col("coded.lossless").alias("lossless"),
    )


@query("op7_quality_classifier")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    return quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op8_language_id")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document."""
    return language.identify(table(spark, folder, "documents"))


@query("op10_toxicity")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


AUDIT_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
        length(coalesce(text, '')) AS n_chars, length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS n_capitals
    FROM documents
), l AS (
    SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id
), f AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, MAP {
        'A': len(words) < 200,
        'B': 100 * len(list_distinct(words)) < 50 * len(words),
        'C': 100 * n_capitals > 3 * n_chars,
        'D': regexp_matches(text, '[#$%&*|]'),
        'E': coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)} AS fails
    FROM d LEFT JOIN l USING (doc_id)
), cell AS (
    SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails
), letter AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), chain AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letter a, letter b, letter c, letter d, letter e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), step AS (
    SELECT filter_order, step, filter_order[step] AS x, string_split(filter_order[1:step - 1], '') AS before,
        list_filter(['A', 'B', 'C', 'D', 'E'], lambda y: y <> filter_order[step]) AS others
    FROM chain, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), judged AS (
    SELECT part, filter_order, step, x, n, good, toxic, fails[x] AS failing,
        coalesce(list_bool_or(list_transform(list_filter(before, lambda y: y <> ''), lambda y: fails[y])), false) AS gone,
        list_bool_or(list_transform(others, lambda y: fails[y])) AS fails_other
    FROM cell, step
), counted AS (
    SELECT part, filter_order, step, x,
        sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN gone AND failing THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN failing AND NOT fails_other THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN NOT gone AND failing THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN NOT gone AND failing THEN toxic ELSE 0 END) AS toxic_lost
    FROM judged GROUP BY part, filter_order, step, x
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM counted
"""


@query("op12_filter_audit", AUDIT_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of five filters at every step of all their orders, per language."""
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op13_importance_resampling")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Weight, score and draw of every document towards the benchmark texts."""
    ranked = importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


@query("op11_source_mix")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of every document a mix of the sources at their target weights takes."""
    plan = balanced_mix.mix_plan(table(spark, folder, "documents"))
    return balanced_mix.per_row(plan).select("doc_id", "size", "source_size", "target", "taken")
