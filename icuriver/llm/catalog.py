"""Registered queries over the operators of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from icuriver.llm import bpe, dart_minhash, edit_fingerprint, hard_negatives, licenses, line_templates, packing, pq_dedup, quality, ranked_search, residual_packing, sharding, suffix_dedup
from icuriver.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op9_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 of near-equal bytes, equal texts together."""
    out = sharding.balanced_shards(table(spark, sf_dir, "documents"), shards=24)
    return out.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query("op1_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text, from a model that never saw the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    weights = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", quality.held_out().alias("held_out"), quality.quality_score(docs, weights).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all whole texts that repeat 50 bytes of an earlier document, removed."""
    found = suffix_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "cut.n_bytes", "cut.n_removed", "cut.n_spans", F.sha2("cut.kept", 256).alias("kept_sha256"))


@query("op3_byte_bpe")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all whole texts and what they decode to, as digests."""
    return bpe.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), ids=False)


@query("op4_licenses")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of license phrases in all whole texts, with the labels that templates add."""
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: ~s["template"])

    def joined(spans: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    starts = F.transform(base, lambda s: s["first"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"), joined(F.col("spans")).alias("labels"), "score",
    )


@query("op5_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all whole texts and their likeness to the edited and the next text."""
    found = edit_fingerprint.compare_with_next(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("cells")).alias("fingerprint"),
        F.lower(F.hex("edited_cells")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


@query("op6_line_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all whole texts without those whose template recurs across documents."""
    found = line_templates.without_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.kept", 256).alias("kept_sha256"))


@query("op7_embedding_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.95."""
    return pq_dedup.near_vectors(table(spark, sf_dir, "embeddings"), 0.95)


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ids=False)


@query("op10_minhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op13_best_fit_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in few sequences of at most 1024 tokens, cut only where they are longer."""
    return residual_packing.pack_best_fit(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ids=False)


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_RANKED = f"""WITH d AS (SELECT doc_id, {_TERMS} AS terms FROM documents), l AS (SELECT doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM l), tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d) GROUP BY ALL),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s WHERE term IN (SELECT term FROM q) GROUP BY term),
sc AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // total)))) AS BIGINT) AS score
 FROM q JOIN w USING (term) JOIN tf USING (term) JOIN l USING (doc_id), s GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM sc WHERE score > 0) WHERE rank <= 20"""


@query("op12_ranked_search", _RANKED)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that score highest for each benchmark item, over all whole texts."""
    return ranked_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 20)


_WHOLE = "list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))"
_NEGATIVES = f"""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_WHOLE} AS x FROM embeddings
 WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id, CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS INTEGER) AS rank, s.b AS negative_id,
 p.score AS positive_score, s.score AS negative_score FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score QUALIFY rank <= 5"""


@query("op11_hard_negatives", _NEGATIVES)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives close below the nearest five of the same label, for every hundredth vector against all."""
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0)
