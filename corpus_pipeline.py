"""A training corpus from documents: language, exact copies, near copies, source weights, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's result as Parquet
in the shared folder and reads it again as the next one's input. What else a stage stored is deleted then.

In every stage a null text is the empty text, a null doc_id comes below all others, null sources are one source, repeated
rows are rows of their own up to exact dedup, which keeps one, long texts are worked on whole, empty tables give empty
results, and further columns pass through, whatever their names; only the last stage replaces columns named token_ids,
exact and n_tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipweave.llm import bpe, exact_dedup, jaccard, langid, mixing
from clipweave.llm.common import fresh, table
from clipweave.llm.queries import tokenizer
from clipweave.storage import drop_stored, stored, written

#: A document goes if no language is found, or none with at least this much of its text's windows' votes.
LEAST_SCORE = 0.35


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 2: keeps documents in one of the learned languages."""
    lang, score = fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    scored = langid.predict(docs, langid.fit(docs), lang_out=lang, score_out=score)
    return scored.where((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).drop(lang, score)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 10: of equal texts, the one of the largest doc_id stays."""
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 5: five-word shingles, similarity of 0.8 or more; the smallest doc_id of a component stays."""
    return jaccard.keep_one(docs, jaccard.JoinSpec(words=5, percent=80))


def source_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 3: rows in the order of the mix, a document once for each draw."""
    shard = fresh(docs, "shard")
    return mixing.mix(docs, shard_out=shard).drop(shard)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 6: the documents with their ids, and whether the ids decode to the text."""
    ranks, pattern = tokenizer()
    return bpe.encode(docs, ranks, pattern, exact_col="exact").withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", source_weights),
    ("byte-level BPE encoding and decoding", tokens),
]

#: A trained model, near-copy components and ids can't be told in SQL; the tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        before = written()
        after = stored(stage(spark, docs, sf_dir), f"stage{i}")
        for path in written() - before - {after.clipweave_path}:
            drop_stored(spark, path)
        if i:
            drop_stored(spark, docs.clipweave_path)
        docs = after
    return docs
