"""Transcript segments: refining long ones, joining repeated and unfinished ones. Times are whole milliseconds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipweave import config
from clipweave.functions.text import split_after, ustrip
from clipweave.operators.folds import ordered_fold


def refined(segments: DataFrame, keys: list[str], longest_ms: int = 9000, marks: str = config.REFINE_MARKS) -> DataFrame:
    """Segments (keys, start_ms, end_ms, text); those too long are split after delimiters, time shared by characters. Adds part."""
    parts = F.filter(F.transform(split_after(F.col("text"), marks), ustrip), lambda p: p != "")
    long = (F.col("end_ms") - F.col("start_ms") > longest_ms) & (F.size(parts) > 1)
    texts = F.when(long, parts).otherwise(F.array("text"))
    return (
        segments.withColumn("_parts", texts)
        .withColumn("_total", F.aggregate("_parts", F.lit(0), lambda a, p: a + F.length(p)))
        .select(*keys, "start_ms", "end_ms", "_total", F.posexplode(_running(F.col("_parts"))).alias("part", "_p"))
        .select(*keys, "part", _share(F.col("_p.before")).alias("start_ms"), _share(F.col("_p.upto")).alias("end_ms"), F.col("_p.text").alias("text"))
    )


def _share(chars: Column) -> Column:
    return F.when(F.col("_total") == 0, F.when(chars == 0, F.col("start_ms")).otherwise(F.col("end_ms"))).otherwise(F.col("start_ms") + F.floor((F.col("end_ms") - F.col("start_ms")) * chars / F.greatest("_total", F.lit(1))).cast("long"))


def _running(parts: Column) -> Column:
    """Each part with the characters before it and up to its end."""
    empty = F.array().cast("array<struct<before:int,upto:int,text:string>>")
    done = F.aggregate(
        parts, F.struct(F.lit(0).alias("n"), empty.alias("out")),
        lambda acc, p: F.struct((acc["n"] + F.length(p)).alias("n"), F.concat(acc["out"], F.array(F.struct(acc["n"].alias("before"), (acc["n"] + F.length(p)).alias("upto"), p.alias("text")))).alias("out")),
    )
    return done["out"]


def _similar(a: str, b: str, percent: int) -> bool:
    x, y = set(a), set(b)
    return bool(x and y) and 100 * len(x & y) > percent * len(x | y)


SEGMENT = "start_ms bigint, end_ms bigint, text string"


def without_repeats(segments: DataFrame, key: str, order: list[str], percent: int = 75) -> DataFrame:
    """Joins a segment to the one kept before it if their character sets are more alike than percent; the longer text stays."""
    kind = dict(segments.dtypes)[key]

    def step(last, row):
        if last is not None and _similar(last["text"], row["text"], percent):
            return last | {"end_ms": row["end_ms"], "text": row["text"] if len(row["text"]) > len(last["text"]) else last["text"]}, []
        return {c: row[c] for c in (key, "start_ms", "end_ms", "text")}, [] if last is None else [last]

    return ordered_fold(segments, [key], order, lambda: None, step, lambda last: [last] if last else [], f"{key} {kind}, {SEGMENT}")


def merged(segments: DataFrame, key: str, order: list[str], longest_ms: int = 20_000, ends: tuple[str, ...] = config.UNFINISHED_ENDS, starts: tuple[str, ...] = config.CONTINUING_STARTS) -> DataFrame:
    """Joins a segment to the one before if that is unfinished, or this continues it, and that is still short enough."""
    kind = dict(segments.dtypes)[key]

    def step(held, row):
        if held is not None and (held["text"].strip().endswith(ends) or row["text"].strip().startswith(starts)) and held["end_ms"] - held["start_ms"] < longest_ms:
            return held | {"end_ms": row["end_ms"], "text": f"{held['text']} {row['text']}".strip()}, []
        return {c: row[c] for c in (key, "start_ms", "end_ms", "text")}, [] if held is None else [held]

    return ordered_fold(segments, [key], order, lambda: None, step, lambda held: [held] if held else [], f"{key} {kind}, {SEGMENT}")
