"""Cut decisions: faults, lookup by digest, templates, projection to cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipweave import config
from clipweave.operators.intervals import neighbour_overlaps


def faults(decisions: DataFrame, key: str, categories: tuple[str, ...] = tuple(config.CATEGORIES), slack: float = 0.01) -> DataFrame:
    """(key, index, fault) of decisions (key, index, start, end, category): an unknown category, an empty span, or a beginning before
    the end of the one before. An unedited template has the review category, which is unknown: that is the gate."""
    told = lambda rows, fault: rows.select(key, "index", F.lit(fault).alias("fault"))
    overlaps = neighbour_overlaps(decisions, key, "start", "end", "index", slack)
    return (
        told(decisions.where(~F.coalesce(F.col("category").isin(*categories), F.lit(False))), "category")
        .unionByName(told(decisions.where("end <= start"), "span")).unionByName(told(overlaps, "overlap"))
    )


def looked_up(sources: DataFrame, files: DataFrame, md5: str, name: str, value: str) -> DataFrame:
    """sources plus the value of the decision file that is named by their digest, else by its first eight characters, else null. File
    names are distinct; a null digest finds none."""
    whole = files.select(F.col(name).alias(md5), F.col(value).alias("_whole"))
    short = files.select(F.col(name).alias("_short"), F.col(value).alias("_value"))
    both = sources.join(whole, md5, "left").withColumn("_short", F.left(F.col(md5), F.lit(8))).join(short, "_short", "left")
    return both.withColumn(value, F.coalesce("_whole", "_value")).drop("_whole", "_value", "_short")


def template(segments: DataFrame, keys: list[str]) -> DataFrame:
    """Decisions to be edited: one for each segment (keys, index, start, end), to be reviewed."""
    return segments.select(*keys, "index", "start", "end", F.lit(config.REVIEW).alias("category"), F.lit("").alias("reason"))


def cuts(decisions: DataFrame, key: str) -> DataFrame:
    """(key, cuts): start, end, category, reason, speech in order of start."""
    row = F.struct("start", "index", "end", "category", "reason", "speech")
    told = F.transform(F.array_sort(F.collect_list(row)), lambda x: F.struct(*(x[c].alias(c) for c in ("start", "end", "category", "reason", "speech"))))
    return decisions.groupBy(key).agg(told.alias("cuts"))


def evidence(segments: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, json): a source's segments (index, start, end, speech) as one JSON document, with the rules they were made by."""
    rules = config.SliceRules()
    rows = F.array_sort(F.collect_list(F.struct("index", "start", "end", F.round(F.col("end") - F.col("start"), 2).alias("duration"), "speech")))
    limits = F.struct(F.lit(rules.shortest).alias("min_seconds"), F.lit(rules.longest).alias("max_seconds"))
    return segments.groupBy(*keys).agg(rows.alias("segments")).select(*keys, F.to_json(F.struct(limits.alias("rules"), "segments")).alias("json"))
