"""Queries op1 to op10: each operator on its whole table with production parameters."""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipweave.llm import bpe, chat, exact_dedup, fingerprint, jaccard, langid, line_dedup, mixing, quality, secrets
from clipweave.llm.common import table

#: Where the public tokenizers are; every executor has them there.
TOKENIZERS = "/opt/tokenizers"
RANKS = "byte_bpe_multi_50k.tiktoken"


def tokenizer(folder: str = TOKENIZERS) -> tuple[str, str]:
    """The rank file's path and the pattern."""
    try:
        import public_tokenizers
    except ImportError:
        import importlib.util

        spec = importlib.util.spec_from_file_location("public_tokenizers", str(Path(folder) / "__init__.py"))
        public_tokenizers = importlib.util.module_from_spec(spec)
        sys.modules["public_tokenizers"] = public_tokenizers
        spec.loader.exec_module(public_tokenizers)
    return public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def remainder(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fingerprint.with_edits(table(spark, sf_dir, "documents"))
    mine, edited, following = F.col("f"), F.col("edited_f"), F.col("next_f")
    return made.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint.printed(mine).alias("fingerprint"), fingerprint.printed(edited).alias("edited_fingerprint"),
        fingerprint.likeness(mine, edited).alias("near_edited"), fingerprint.likeness(mine, following).alias("near_next"),
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    net = langid.fit(docs.where(~held_out))
    return langid.predict(docs.select("doc_id", "text"), net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.quotas(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), jaccard.JoinSpec(words=4, percent=85)).drop("set_name")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), *tokenizer())


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return lines.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    forest = quality.fit(docs.where(~held_out), table(spark, sf_dir, "labels"))
    return quality.predict(docs, forest).select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    planted = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", planted), (-1, 1, "assistant", planted)], "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.render(turns.unionByName(more)))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents")).drop("sender", "ord")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_document_fingerprints, op2_language_id, op3_source_mix, op4_secret_scan, op5_ngram_jaccard_join, op6_byte_bpe, op7_line_dedup, op8_quality_classifier, op9_chat_format, op10_exact_dedup]
    return {f.__name__: f for f in found}


BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
LINE_KEY = f"translate(trim(line, {BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op7_line_dedup": f"""
        WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        lines AS (
            SELECT doc_id, i, line, {LINE_KEY} AS key
            FROM (SELECT doc_id, generate_subscripts(parts, 1) AS i, unnest(parts) AS line
                  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM docs))),
        common AS (SELECT key, max(doc_id) AS top FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        marked AS (SELECT l.*, c.key IS NOT NULL AND l.doc_id <> c.top AS gone FROM lines l LEFT JOIN common c USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
