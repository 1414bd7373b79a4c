"""The opN_ queries: each runs its operator on the whole of `documents` and derives the columns asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, exact_dedup, katz, licenses, mixing, packing, quality, sharding, simhash, tiff, token_files, toxicity, whitening

SHARDS = 40
#: Parameter: where the public tokenizer's vocabulary lies.
VOCABULARY = "word_bpe_49k.json"
#: The two tokenizers that are aligned.
SIDES = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.fit_and_score(_table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), SHARDS)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_documents(_table(spark, sf_dir, "documents"), vocabulary(), end_id=2)


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", simhash.hex64(F.col("fp")).alias("fingerprint"), "component_id")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("_row")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary())


def op9_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.text_media(_table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(_table(spark, sf_dir, "documents"), *map(vocabulary, SIDES))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_exact_dedup, op2_katz, op3_sharding, op4_token_files, op5_simhash, op6_licenses, op7_toxicity, op8_packing, op9_tiff, op10_mixing, op11_quality, op12_whitening, op13_alignment)}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def oracle_sql() -> dict[str, str]:
    """op3 has none, as DuckDB has no CRC-32, and op6 none, as its spans are taken one after the other; tests/llm holds it and the others against plain versions."""
    return {
        "op1_exact_dedup": f"""
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
            FROM (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents) t WINDOW w AS (PARTITION BY text_sha256)""",
        "op10_mixing": r"""
            WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
            s AS (SELECT source, sum(size)::BIGINT AS source_size, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w FROM d GROUP BY source),
            r AS (SELECT *, 3.0 * source_size / w AS ratio, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(w) OVER (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s),
            l AS (SELECT *, (SELECT level FROM r WHERE level <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1) AS common FROM r),
            t AS (SELECT source, source_size, least(3.0 * source_size, common * w)::DOUBLE AS target FROM l),
            p AS (SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
                  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
            SELECT doc_id, size::BIGINT AS size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE
                (round(target)::BIGINT // source_size) * size + greatest(0, least(size, round(target)::BIGINT % source_size - before)) END::BIGINT AS taken FROM p""",
    }
