"""Registered queries of the llm operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strobe.llm import chat, decontamination, hard_negatives, html_text, licenses, near_dedup, packing, periodic_runs, pii, quality_rules, substring_dedup, token_counts, toxicity
from strobe.llm.shared import documents, held_out_column
from strobe.plans.tables import table

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(fn: Builder) -> Builder:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    forest = quality_rules.fit_forest(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality_rules.apply_rules(docs, forest)

@register
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    machine = toxicity.fit_machine(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), ~held_out_column())
    return toxicity.score_documents(docs, machine).select(
        "doc_id",
        held_out_column().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@register
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_spans(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), F.size("spans").cast("long").alias("n_spans"))


@register
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), size=3, percent=85)


@register
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))


#: The added conversation of the chat query.
ADDED_CONVERSATION = -7
ADDED_TEXT = "\\### Assistant: </turn> ok"


@register
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    added = spark.createDataFrame(
        [(ADDED_CONVERSATION, 0, "user", ADDED_TEXT), (ADDED_CONVERSATION, 1, "assistant", ADDED_TEXT)], rows.schema
    )
    read = chat.read_back(chat.render(chat.fold(chat.as_events(rows.unionByName(added)))))
    turns = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("roles").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLES["op9_chat_formatting"] = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
    SELECT *,
        length(replace(replace(replace(role, '\', '\\'), '<', '\l'), '>', '\g'))
        + length(replace(replace(replace(text, '\', '\\'), '<', '\l'), '>', '\g'))
        + length('<turn role=') + length('>') + length('</turn>') + 1 AS size
    FROM rows
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(size)::BIGINT AS formatted_chars
FROM sized
GROUP BY conv_id
"""


@register
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = pii.find_spans(docs, pii.fit_trees(docs))
    return found.select(
        "doc_id",
        *(pii.count_of(F.col(pii.BASE), k).alias(f"n_{k}") for k in pii.PATTERNS),
        F.sha2(pii.span_list(F.col(pii.BASE)), 256).alias("base_sha256"),
        pii.span_list(F.concat(pii.BASE, pii.ADDED)).alias("spans"),
    )


@register
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.flag_documents(documents(spark, sf_dir), table(spark, sf_dir, "benchmark", "item_id", "text"), text=False)
    return found.select(
        "doc_id",
        F.col(decontamination.ITEM_COLUMN).isNotNull().alias("contaminated"),
        F.col(decontamination.ITEM_COLUMN).alias("item_id"),
        F.col(decontamination.SHARE_COLUMN).alias("covered"),
        F.col(decontamination.COSINE_COLUMN).alias("cosine"),
    )


@register
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


@register
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages", "page_id", "html"))


#: Tokens above which a text is over the limit of the token counts query.
TOKEN_LIMIT = 4096


@register
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return found.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@register
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.planted(documents(spark, sf_dir)))
    line = F.transform("runs", lambda x: F.concat(x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"), F.lit("\n")))
    best = found.withColumn("best", periodic_runs.greatest(F.col("runs")))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@register
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite).select(
        F.col("vec_id").alias("id"), moved.alias("label"), F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("vector")
    )
    return hard_negatives.mine(vectors, F.col("id") % 100 == 0)


ORACLES["op11_hard_negatives"] = """
WITH given AS (
    SELECT vec_id, label, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), vectors AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) for x in embedding] AS vector
    FROM given
), scores AS (
    SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_inner_product(a.vector, b.vector)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.id % 100 = 0 AND a.id <> b.id
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
    (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank,
    id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
