"""Readers and writers of the formats that catalogs, ledgers, evidence and indexes come in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DECISION = "index int, start double, end double, category string, reason string, speech string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    local = [c for c, kind in df.dtypes if kind == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in local}) if local else df


def files(spark: SparkSession, folder: str, pattern: str = "*", hash_content: bool = False) -> DataFrame:
    """A folder tree's files: id, name, size, modified; md5 if asked for (that reads them)."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    digest = F.md5("content") if hash_content else F.lit(None).cast("string")
    return found.select(F.col("path").alias("id"), F.regexp_extract("path", "[^/]*$", 0).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), digest.alias("md5"))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of text files; lines are numbered in their file."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))


def scripts(spark: SparkSession, path: str) -> DataFrame:
    """One script for each line that isn't blank."""
    return text_lines(spark, path).where(F.trim("line") != "")


def decisions(spark: SparkSession, path: str) -> DataFrame:
    """Cut decisions from JSON arrays; types are strict, unknown keys are errors."""
    wanted = StructType.fromDDL(DECISION)
    seen = spark.read.json(path, multiLine=True)
    unknown = set(seen.columns) - set(wanted.names)
    if unknown:
        raise ValueError(f"unknown keys: {sorted(unknown)}")
    return spark.read.schema(wanted).json(path, multiLine=True, mode="FAILFAST")


def task_form(spark: SparkSession, path: str) -> DataFrame:
    """(item, answer) of a CSV form with the columns item, plan, fill: what was filled in, else the plan."""
    rows = spark.read.csv(path, header=True, multiLine=True).select("item", "plan", "fill")
    return rows.select(F.trim("item").alias("item"), F.coalesce(F.nullif(F.trim("fill"), F.lit("")), F.trim("plan")).alias("answer")).where("item <> ''")


def row_list(answer: Column, n: int | Column) -> Column:
    """The rows, numbered from 1, that an answer lists, split at commas of both widths and new lines, in its order; parts that
    are no number or not among n rows are left out. An answer without numbers means all rows."""
    n = F.lit(n).cast("bigint") if isinstance(n, int) else n.cast("bigint")
    parts = F.transform(F.split(F.coalesce(answer, F.lit("")), r"[,\uFF0C\r\n]"), lambda x: F.btrim(F.translate(x, "０１２３４５６７８９", "0123456789"), F.lit(" \t\u3000")))
    digits = F.filter(parts, lambda x: x.rlike("^[0-9]+$"))
    kept = F.filter(F.transform(digits, lambda x: x.try_cast("bigint")), lambda i: (i > 0) & (i <= n))
    every = F.when(n > 0, F.sequence(F.lit(1).cast("bigint"), F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<bigint>"))
    return F.when(F.size(digits) == 0, every).otherwise(kept)


def usage(spark: SparkSession, path: str) -> DataFrame:
    """(key, n) of a JSON object of counts; what can't be read counts as empty."""
    counts = F.from_json("value", "map<string,bigint>")
    return spark.read.text(path, wholetext=True).select(F.explode(counts).alias("key", "n"))


def write_by_category(rows: DataFrame, path: str, column: str = "category") -> None:
    rows.write.mode("append").partitionBy(column).parquet(path)


def write_lines(rows: DataFrame, order: list[str], line: str, path: str) -> None:
    """A text file; the order is total, so it is written by one task. For reports, not for tables."""
    rows.orderBy(*order).select(line).coalesce(1).write.mode("overwrite").text(path)
