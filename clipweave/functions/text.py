"""Text and format expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipweave import config


def ustrip(text: Column) -> Column:
    """Strips white space of any script at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def char_class(marks: str) -> str:
    return "[" + re.escape(marks).replace("]", r"\]") + "]"


def seconds_to_say(text: Column, rate: float = config.CHARS_A_SECOND) -> Column:
    """Tenths are rounded half even; every character counts."""
    return F.bround(F.length(ustrip(text)) / F.lit(rate), 1)


def chars_for(seconds: Column, rate: float = config.CHARS_A_SECOND) -> Column:
    return (seconds * F.lit(rate)).cast("int")


def sentences(text: Column, marks: str = config.SENTENCE_MARKS) -> Column:
    """Sentences without their delimiter, stripped; none is blank."""
    return F.filter(F.transform(F.split(text, char_class(marks)), ustrip), lambda s: s != "")


def split_after(text: Column, marks: str) -> Column:
    """Parts that each end in a delimiter (the last may not)."""
    return F.filter(F.split(F.regexp_replace(text, f"({char_class(marks)})", "$1\u0001"), "\u0001", -1), lambda s: s != "")


def caption_lines(text: Column, width: int = 13, marks: str = config.CAPTION_MARKS) -> Column:
    """Parts after each delimiter, cut hard at width; blank lines go."""
    def cut(part: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.length(part) - 1) / width).cast("int")), lambda i: F.substring(part, i * width + 1, F.lit(width)))

    return F.filter(F.flatten(F.transform(split_after(ustrip(text), marks), cut)), lambda x: ustrip(x) != "")


def characters(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def ends_with_any(text: Column, ends: tuple[str, ...]) -> Column:
    return ustrip(text).rlike("(?:" + "|".join(map(re.escape, ends)) + ")$")


def starts_with_any(text: Column, starts: tuple[str, ...]) -> Column:
    return ustrip(text).rlike("^(?:" + "|".join(map(re.escape, starts)) + ")")


def highlighted(text: Column, units: str = config.HIGHLIGHT_UNITS) -> Column:
    return F.regexp_replace(text, rf"(?U)(\d+\s*{char_class(units)})", r"{\\c&H0000FF&}$1{\\c&HFFFFFF&}")


def clock(ms: Column) -> Column:
    """h:mm:ss.cc of whole milliseconds, hundredths cut."""
    s = F.floor(ms / 1000)
    return F.format_string("%d:%02d:%02d.%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60, F.floor(ms / 10) % 100)


def megabytes(size: Column) -> Column:
    return F.format_string("%.0fMB", size / 1e6)


def source_prefix(name: Column) -> Column:
    return F.split_part(name, F.lit("_"), F.lit(1))


def safe_name(name: Column, most: int = 40) -> Column:
    return F.substring(F.regexp_replace(F.replace(name, F.lit(" "), F.lit("_")), r"[^\p{L}\p{N}\-_.]", ""), 1, most)


def suffix(name: Column) -> Column:
    """The lower-cased suffix; a name that only begins with a dot has none."""
    return F.lower(F.regexp_extract(name, r".(\.[^.]+)$", 1))


def like_any(name: Column, patterns: tuple[str, ...]) -> Column:
    """Shell patterns, letter case aside."""
    parts = [re.escape(p.lower()).replace(r"\*", ".*").replace(r"\?", ".") for p in patterns]
    return F.lower(name).rlike("^(?:" + "|".join(parts) + ")$")


def is_video(mime: Column, name: Column) -> Column:
    return mime.startswith("video") | F.lower(name).rlike(r"\.(mp4|mov|avi|mkv|webm|m4v)$")


def picture_size(text: Column) -> tuple[Column, Column]:
    """WxH as whole numbers, 1080 x 1920 where it can't be read."""
    w, h = (F.split_part(F.lower(text), F.lit("x"), F.lit(i)).try_cast("int") for i in (1, 2))
    good = w.isNotNull() & h.isNotNull()
    return F.when(good, w).otherwise(1080), F.when(good, h).otherwise(1920)


def violations(script: Column, price: Column, appearance: Column, forbidden: Column, units: str = config.PRICE_UNITS, colours: str = config.COLOURS) -> Column:
    """What a script says against its fact sheet: array of 'forbidden: x', 'price', 'colour'."""
    numbers = F.array_distinct(F.regexp_extract_all(script, F.lit(rf"(\d+)\s*{char_class(units)}"), F.lit(1)))
    known = F.regexp_extract_all(price, F.lit(r"\d+"), F.lit(0))
    hues = F.array_distinct(F.regexp_extract_all(script, F.lit(char_class(colours)), F.lit(0)))
    seen = F.regexp_extract_all(appearance, F.lit(char_class(colours)), F.lit(0))
    said = F.transform(F.filter(forbidden, lambda w: (w != "") & F.contains(script, w)), lambda w: F.concat(F.lit("forbidden: "), w))
    wrong_price = F.when(F.size(F.array_except(numbers, known)) > 0, F.array(F.lit("price"))).otherwise(F.array().cast("array<string>"))
    wrong_hue = F.when(F.size(F.array_except(hues, seen)) > 0, F.array(F.lit("colour"))).otherwise(F.array().cast("array<string>"))
    return F.concat(said, wrong_price, wrong_hue)


def clip_fault(duration: Column, width: Column, height: Column, want: Column, want_width: Column, want_height: Column, tolerance: float = 1.0) -> Column:
    """Why an exported clip fails, or null; the first reason counts. Durations may differ by the tolerance."""
    return (
        F.when(duration <= 0, "no duration")
        .when((width != want_width) | (height != want_height), "wrong size")
        .when(F.abs(duration - want) > tolerance, "wrong duration")
    )


def first_category(name: Column, keywords: dict[str, str], otherwise: str = config.REVIEW) -> Column:
    """The category of the first keyword, in order, that the name contains."""
    out = None
    for word, category in keywords.items():
        out = F.when(F.contains(name, F.lit(word)), category) if out is None else out.when(F.contains(name, F.lit(word)), category)
    return F.lit(otherwise) if out is None else out.otherwise(otherwise)


def sample_times(duration_ms: Column, every_ms: int = 5000) -> Column:
    """1 s, then every so often, while before the end less half a second."""
    last = duration_ms - 501
    return F.when(last >= 1000, F.sequence(F.lit(1000).cast("long"), last, F.lit(every_ms).cast("long"))).otherwise(F.array().cast("array<bigint>"))


def probe_times(start_ms: Column, end_ms: Column) -> Column:
    """Near the start, the middle, near the end; none in the last tenth of a second."""
    points = F.array(start_ms + 300, F.floor((start_ms + end_ms) / 2), F.greatest(start_ms + 300, end_ms - 300))
    return F.transform(points, lambda t: F.least(t, end_ms - 100))


def category_reason(name: Column, keywords: dict[str, str], otherwise: str = config.REVIEW) -> Column:
    """struct<category, reason>: of the first keyword, in order, that the name contains."""
    word = first_category(name, {w: w for w in keywords}, "")
    return F.struct(first_category(name, keywords, otherwise).alias("category"), F.when(word == "", "none").otherwise(F.concat(F.lit("keyword "), word)).alias("reason"))
