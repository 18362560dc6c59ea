"""Line dedup with levelled sorted runs of line hashes.

The store holds runs sorted by line hash. A new batch of documents is aggregated to one row per line key
(distinct documents, largest id) and merge-anti-joined with the runs: keys no run has become the batch's
own run, keys already there become updates. When a level has `fanout` runs they are compacted into one
run of the next level; runs never share keys, so compaction is a merge.

A line's key is the line stripped of [\\x20\\x09-\\x0D] at both ends, A-Z lower-cased, named by two 64-bit
hashes. Nulls: a null text is one empty line, a null doc_id is an id below all others. Rows that share a
doc_id are one document. Empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipweave.llm.common import id_key, joined, stored, text_of

BLANKS = " \t\n\x0b\x0c\r"
KEY = ["h1", "h2"]
RUN = "h1 long, h2 long, n long, top long"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else; searching bytes 26 times beats translate(), which maps character by character."""
    for letter in string.ascii_uppercase:
        text = F.replace(text, F.lit(letter), F.lit(letter.lower()))
    return text


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_keys(text: Column) -> Column:
    return F.transform(lines_of(ascii_lower(text)), lambda x: F.btrim(x, F.lit(BLANKS)))


def key_hashes(key: Column) -> Column:
    """The salt comes first: xxhash64 seeds each argument's hash with that of those before it."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2"))


class LineRuns:
    """The levelled store. add() takes (doc_id, h1, h2) rows; a document must be whole in one batch."""

    def __init__(self, spark: SparkSession, fanout: int = 4):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []
        self.updates: list[DataFrame] = []

    def runs(self) -> DataFrame | None:
        out = None
        for run in (r for level in self.levels for r in level):
            out = run if out is None else out.unionByName(run)
        return out

    def add(self, batch: DataFrame) -> DataFrame:
        """Adds a batch; returns the rows (h1, h2, n, top, seen) of its keys, seen: some earlier batch had it."""
        own = batch.groupBy(*KEY).agg(F.countDistinct("doc_id").alias("n"), F.max("doc_id").alias("top"))
        runs = self.runs()
        if runs is None:
            marked = own.withColumn("seen", F.lit(False))
        else:
            marked = own.join(runs.select(*KEY, F.lit(True).alias("seen")), KEY, "left").withColumn("seen", F.coalesce("seen", F.lit(False)))
        marked = stored(marked.select(*KEY, "n", "top", "seen").sortWithinPartitions(*KEY), "run", partition_by="seen")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(marked.where(~F.col("seen")).drop("seen"))
        self.updates.append(marked.where("seen").drop("seen"))
        self._compact()
        return marked

    def _compact(self) -> None:
        for i in range(len(self.levels)):
            if len(self.levels[i]) >= self.fanout:
                whole = self.levels[i][0]
                for run in self.levels[i][1:]:
                    whole = whole.unionByName(run)
                merged = stored(whole.repartition(*KEY).sortWithinPartitions(*KEY), f"level{i + 1}")
                if i + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[i + 1].append(merged)
                self.levels[i] = []

    def totals(self) -> DataFrame:
        """(h1, h2, n, top) over all batches."""
        runs = self.runs()
        if runs is None:
            return self.spark.createDataFrame([], RUN)
        more = self.updates[0]
        for update in self.updates[1:]:
            more = more.unionByName(update)
        more = more.groupBy(*KEY).agg(F.sum("n").alias("m"), F.max("top").alias("later"))
        return runs.join(more, KEY, "left").select(*KEY, (F.col("n") + F.coalesce("m", F.lit(0))).alias("n"), F.greatest("top", F.coalesce("later", "top")).alias("top"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = 4, fanout: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs' rows as (doc_id, n_lines, n_dropped, kept_text)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("body")).withColumn("key", id_key())
    long_lines = F.filter(line_keys(F.col("body")), lambda x: F.length(x) >= min_chars)
    hashes = F.array_distinct(F.transform(long_lines, key_hashes))
    lines = stored(
        rows.select("key", F.explode(hashes).alias("h")).select(F.col("key").alias("doc_id"), "h.h1", "h.h2", F.pmod(F.xxhash64("key"), F.lit(batches)).cast("int").alias("batch")),
        "lines", partition_by="batch",
    )
    store = LineRuns(spark, fanout)
    for i in range(batches):
        store.add(lines.where(F.col("batch") == i))
    common = stored(store.totals().where(F.col("n") >= min_docs).select(*KEY, "top"), "common")
    gone = joined(lines.select("doc_id", *KEY), common, KEY, "inner", 48).where("doc_id <> top")
    per_doc = gone.groupBy(F.col("doc_id").alias("key")).agg(F.collect_set(F.struct(*KEY)).alias("gone"))
    body = F.col("body")
    marked = F.zip_with(lines_of(body), line_keys(body), lambda x, k: F.struct(x.alias("line"), ((F.length(k) < min_chars) | ~F.array_contains(F.col("gone"), key_hashes(k))).alias("stays")))
    stays = F.transform(F.filter(marked, lambda x: x["stays"]), lambda x: x["line"])
    return (
        rows.join(per_doc, "key", "left")
        .withColumn("stays", F.when(F.col("gone").isNotNull(), stays))
        .select(
            "doc_id", F.size(lines_of(body)).cast("long").alias("n_lines"),
            F.coalesce(F.size(lines_of(body)) - F.size("stays"), F.lit(0)).cast("long").alias("n_dropped"),
            F.coalesce(F.array_join("stays", "\n"), body).alias("kept_text"),
        )
    )
