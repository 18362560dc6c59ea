"""File catalogs: duplicates, classes, folder trees, resumption."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipweave import config
from clipweave.functions.text import is_video, like_any, suffix
from clipweave.storage import extended, new_path, stored


def duplicate_groups(files: DataFrame, digest: str, order: str) -> DataFrame:
    """(digest, kept, copies) of digests that several files have. Aggregates before it shuffles, so one huge group is no task's load."""
    named = files.where(F.col(digest).isNotNull() & (F.col(digest) != ""))
    return named.groupBy(digest).agg(F.min(order).alias("kept"), F.count("*").alias("copies")).where("copies > 1")


def with_duplicates(files: DataFrame, digest: str, order: str) -> DataFrame:
    """files plus kept and copies (null outside duplicate groups) and redundant: a file whose group keeps another."""
    out = files.join(duplicate_groups(files, digest, order), digest, "left")
    return out.withColumn("redundant", F.coalesce(F.col(order) != F.col("kept"), F.lit(False)))


def classified(files: DataFrame, name: str, digest: str, order: str) -> DataFrame:
    """files plus class: junk, duplicate, document or kept; the first that fits."""
    junk, document = like_any(F.col(name), config.JUNK), suffix(F.col(name)).isin(*config.DOCUMENTS)
    return with_duplicates(files, digest, order).withColumn("class", F.when(junk, "junk").when(F.col("redundant"), "duplicate").when(document, "document").otherwise("kept"))


def unprocessed(sources: DataFrame, ledger: DataFrame, key: str, failed) -> DataFrame:
    """Sources without a ledger row that did not fail. A null or empty key never matches."""
    done = ledger.where(~failed).select(F.nullif(F.col(key), F.lit("")).alias(key) if dict(ledger.dtypes)[key] == "string" else key).where(F.col(key).isNotNull())
    return sources.join(done, key, "left_anti")


def tree_paths(edges: DataFrame, node: str, parent: str, name: str) -> DataFrame:
    """(node, path, depth): names from the root, by one self-join a level until a level is empty; levels are stored. A cycle
    below a root, which would have no end, is an error."""
    spark = edges.sparkSession
    rest = stored(edges.select(F.col(node).alias("node"), F.col(parent).alias("parent"), F.col(name).cast("string").alias("name")), "edges")
    most, path, depth = rest.where("parent IS NOT NULL").count(), new_path(spark, "tree"), 0
    level = rest.where("parent IS NULL").select("node", F.col("name").alias("path"))
    while True:
        level.write.parquet(f"{path}/depth={depth}")
        level = spark.read.schema(level.schema).parquet(f"{path}/depth={depth}")
        if level.isEmpty():
            return spark.read.schema(extended(level.schema, depth="int")).parquet(path).select("node", "path", "depth")
        if depth > most:
            raise ValueError("the tree has a cycle below a root")
        above = level.select(F.col("node").alias("parent"), F.col("path").alias("above"))
        level, depth = rest.join(above, "parent").select("node", F.concat("above", F.lit("/"), "name").alias("path")), depth + 1


def ranked(rows: DataFrame, keys: list[str], order: list, most: int) -> DataFrame:
    """The first rows of each key; Spark limits each partition's groups before it shuffles."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= most)


def resolved(edges: DataFrame, node: str, parent: str, name: str, path: str):
    """The node at a path of names from the root, by one lookup a part; of children of one name the least. A missing part is an error."""
    at, seen = None, []
    for part in path.split("/"):
        under = F.col(parent).isNull() if at is None else F.col(parent) == F.lit(at)
        seen.append(part)
        at = child(edges.where(under), node, name, part)
        if at is None:
            raise FileNotFoundError("/".join(seen))
    return at


def child(children: DataFrame, node: str, name: str, wanted: str):
    """The least node of this very name, or None."""
    return children.where(F.col(name) == wanted).agg(F.min(node)).first()[0]


def scanned(edges: DataFrame, node: str, parent: str, name: str) -> DataFrame:
    """(node, path, depth, scan_ord): a tree's nodes in the order of their paths, which says what is seen first."""
    from clipweave.operators.ledgers import numbered

    return numbered(tree_paths(edges, node, parent, name), ["path", "node"], "scan_ord")


def videos(files: DataFrame, mime: str, name: str) -> DataFrame:
    return files.where(is_video(F.col(mime), F.col(name)))


def trash(files: DataFrame, name: str, digest: str, order: str) -> DataFrame:
    """The files that go, junk and redundant copies, each once."""
    return files.transform(lambda f: classified(f, name, digest, order)).where("class IN ('junk', 'duplicate') OR redundant")


def summary(files: DataFrame, name: str, digest: str, order: str) -> DataFrame:
    """One row of counts: scanned, junk, redundant copies, groups that keep one, documents, trashed files."""
    rows = classified(files, name, digest, order)
    junk, document = like_any(F.col(name), config.JUNK), suffix(F.col(name)).isin(*config.DOCUMENTS)
    return rows.agg(
        F.count("*").alias("scanned"), F.count_if(junk).alias("junk"), F.count_if("redundant").alias("redundant"), F.count_if(F.col("copies").isNotNull() & ~F.col("redundant")).alias("kept"),
        F.count_if(document & ~junk & ~F.col("redundant")).alias("documents"), F.count_if(junk | F.col("redundant")).alias("trashed"),
    )


def shown(rows: DataFrame, order: list, most: int = 20) -> tuple[DataFrame, int]:
    """The first rows, and how many more there are."""
    return rows.orderBy(*order).limit(most), max(0, rows.count() - most)
