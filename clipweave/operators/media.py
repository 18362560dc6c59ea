"""What is known of media files: probe documents, statuses, names of exports and frames, escapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipweave import config
from clipweave.functions.text import clip_fault, probe_times

PROBE = "streams array<struct<codec_type:string,codec_name:string,width:string,height:string,avg_frame_rate:string,r_frame_rate:string>>, format struct<duration:string>"


def probed(document: Column) -> Column:
    """struct<duration, width, height, fps, has_audio, vcodec> of a probe's JSON. The first video stream that has a width counts, else
    the last one; what can't be read is 0, a rate over 0 as well."""
    parsed = F.from_json(document, PROBE)
    streams = F.coalesce(parsed["streams"], F.from_json(F.lit("{}"), PROBE)["streams"], F.expr(f"from_json('{{\"streams\":[]}}', '{PROBE}').streams"))
    videos = F.filter(streams, lambda s: s["codec_type"] == "video")
    wide = F.filter(videos, lambda s: F.coalesce(s["width"].try_cast("int"), F.lit(0)) != 0)
    video = F.coalesce(F.get(wide, F.lit(0)), F.try_element_at(videos, F.lit(-1)))
    rate = F.coalesce(F.nullif(video["avg_frame_rate"], F.lit("")), F.nullif(video["r_frame_rate"], F.lit("")), F.lit("0/1"))
    over, under = (F.get(F.split(rate, "/"), F.lit(i)).try_cast("double") for i in (0, 1))
    whole = lambda c: F.coalesce(video[c].try_cast("int"), F.lit(0)).alias(c)
    return F.struct(
        F.coalesce(parsed["format"]["duration"].try_cast("double"), F.lit(0.0)).alias("duration"), whole("width"), whole("height"),
        F.coalesce(F.when(under != 0, over / under), F.lit(0.0)).alias("fps"), F.coalesce(F.exists(streams, lambda s: s["codec_type"] == "audio"), F.lit(False)).alias("has_audio"),
        F.coalesce(video["codec_name"], F.lit("")).alias("vcodec"),
    )


def is_portrait(info: Column) -> Column:
    return (info["height"] >= info["width"]) & (info["width"] > 0)


def is_landscape(info: Column) -> Column:
    return info["width"] > info["height"]


def status(duration: Column, faulty: Column, shorts: bool = False, rules: config.SliceRules = config.SliceRules()) -> Column:
    """done, failed, or, of a source to be sliced that is too short, skipped_short; shorts are taken whole."""
    done = F.when(faulty, "failed").otherwise("done")
    return done if shorts else F.when(duration < rules.skip_below, "skipped_short").otherwise(done)


def exports(slices: DataFrame, key: str, order: list[str], md5: str, category: str, fault: Column) -> DataFrame:
    """slices that pass, with their number and name. Numbers are given before faulty ones go, so they have gaps; from 1000 up they
    have more than three digits."""
    numbered = slices.withColumn("number", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return numbered.where(fault.isNull()).withColumn("name", export_name(F.col(md5), F.col("number"), F.col(category)))


def export_name(md5: Column, number: Column, category: Column) -> Column:
    return F.concat(F.left(md5, F.lit(8)), F.format_string("_%03d_", number), category, F.lit(".mp4"))


def short_exports(sources: DataFrame, md5: str, category: str, info: Column, size: tuple[int, int]) -> DataFrame:
    """Short sources as one slice each: number 1, the name, and failed where the whole file is at fault."""
    fault = clip_fault(info["duration"], info["width"], info["height"], info["duration"], F.lit(size[0]), F.lit(size[1]))
    return sources.withColumns({"number": F.lit(1), "name": export_name(F.col(md5), F.lit(1), F.col(category)), "fault": fault, "status": status(info["duration"], fault.isNotNull(), shorts=True)})


def frame_jobs(segments: DataFrame, keys: list[str], index: str, start_ms: str, end_ms: str) -> DataFrame:
    """(keys, index, frame, at_ms, name): three frames of each segment."""
    each = segments.select(*keys, index, F.posexplode(probe_times(F.col(start_ms), F.col(end_ms))).alias("frame", "at_ms"))
    return each.withColumn("name", F.concat(F.format_string("seg_%03d_f", F.col(index)), F.col("frame"), F.lit(".jpg")))


def sample_name(at_ms: Column) -> Column:
    """Of a sampled frame: seconds with one digit, at least seven characters."""
    return F.format_string("sub_%07.1f.jpg", at_ms / 1000)


def drawn_text(text: Column) -> Column:
    """Escaped for a text filter."""
    for mark in ("\\", "'", ":", "%"):
        text = F.replace(text, F.lit(mark), F.lit("\\" + mark))
    return text


def filter_path(path: Column) -> Column:
    """Escaped for a quoted path in a filter."""
    return F.replace(F.replace(path, F.lit("'"), F.lit("'\\''")), F.lit(":"), F.lit("\\:"))
