"""Captions: lines, their times, and subtitle events. Times are whole milliseconds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipweave.functions.text import caption_lines, clock, highlighted


def lines(texts: DataFrame, keys: list[str], text: str, width: int, marks: str) -> DataFrame:
    return texts.select(*keys, F.posexplode(caption_lines(F.col(text), width, marks)).alias("line_no", "line"))


def timed(rows: DataFrame, keys: list[str], total_ms: str) -> DataFrame:
    """Lines plus start_ms and end_ms: the total shared by characters, one at least for each line."""
    weight = F.greatest(F.length("line"), F.lit(1))
    w = Window.partitionBy(*keys)
    upto = F.sum(weight).over(w.orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum(weight).over(w)
    share = lambda n: F.expr("0L") + F.floor(F.col(total_ms) * n / whole)
    return rows.withColumn("start_ms", share(upto - weight)).withColumn("end_ms", share(upto))


def events(rows: DataFrame, highlight: bool = False) -> DataFrame:
    """Rows plus event, a subtitle file's line."""
    text = highlighted(F.col("line")) if highlight else F.replace(F.replace("line", F.lit("{"), F.lit("｛")), F.lit("}"), F.lit("｝"))
    return rows.withColumn("event", F.concat(F.lit("Dialogue: 0,"), clock(F.col("start_ms")), F.lit(","), clock(F.col("end_ms")), F.lit(",sub,,0,0,0,,"), text))


def subtitle_file(rows: DataFrame, key: str, width: int = 1080, height: int = 1920, font: str = "sans-serif", size: int = 64) -> DataFrame:
    """(key, line_no, text): a subtitle file's lines, its head and then the events in order."""
    head = [
        "[Script Info]", "ScriptType: v4.00+", f"PlayResX: {width}", f"PlayResY: {height}", "", "[V4+ Styles]",
        "Format: Name, Fontname, Fontsize, PrimaryColour, OutlineColour, Bold, Outline, Alignment, MarginL, MarginR, MarginV",
        f"Style: sub,{font},{size},&H00FFFFFF,&H00000000,1,3,2,40,40,{height // 6}", "", "[Events]", "Format: Layer, Start, End, Style, Name, MarginL, MarginR, MarginV, Effect, Text",
    ]
    opened = rows.select(key).distinct().select(key, F.posexplode(F.array(*map(F.lit, head))).alias("line_no", "text"))
    return opened.select(key, F.col("line_no").cast("long").alias("line_no"), "text").unionByName(rows.select(key, (F.col("line_no") + len(head)).cast("long").alias("line_no"), F.col("event").alias("text")))
