"""Ledgers as sectioned text: anchored tables in two layouts, full renderings with numbers, appends.

A ledger is lines (file, line_no, line). Rows are typed once they are read; a missing cell is the empty text, a count that
is no number is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipweave.functions.text import ustrip
from clipweave.storage import stored

SLICES = ("source_path", "filename", "md5", "size", "slice_count", "output_dir", "status", "note", "time")
MIXES = ("source", "script", "count", "output_dir", "status", "time", "seed", "batch")
#: A file's lines are sorted in stretches of 2 to this power.
STRETCH_BITS = 14


def numbered(rows: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """rows numbered from 1 in a total order, sorted by range: tasks count their own rows, and only the counts meet."""
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    held = stored(ranged.withColumn("_part", F.shiftright("_at", 33)), "numbered")
    counts = held.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(counts.select("_part", before.alias("_before")))  # a row for each task
    return held.join(starts, "_part").withColumn(name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_at", "_part", "_before")


def table_cells(lines: DataFrame, anchor: str) -> DataFrame:
    """(file, line_no, cells) of the rows under the line that is the anchor, up to the next heading of its kind; header, rule and rows
    whose first cell is empty go."""
    bare = ustrip(F.col("line"))
    is_anchor = bare == anchor
    mark = F.when(is_anchor, True).when(F.col("line").startswith("## "), False)
    placed = lines.select("file", "line_no", bare.alias("_bare"), mark.alias("_mark"), F.shiftright("line_no", STRETCH_BITS).alias("_stretch")).where(F.col("_mark").isNotNull() | F.col("_bare").startswith("|"))
    within = _last_mark(placed).where(F.col("_in") & ~F.coalesce(F.col("_mark"), F.lit(False)) & F.col("_bare").startswith("|"))
    cells = F.transform(F.split(F.regexp_replace("_bare", r"^\|+|\|+$", ""), r"\|", -1), ustrip)
    rows = within.select("file", "line_no", cells.alias("cells"))
    first = F.col("cells")[0]
    return rows.where((first != "#") & ~first.rlike("^[-:]*$"))


def _last_mark(placed: DataFrame) -> DataFrame:
    """placed plus _in: the last mark in the file up to the line. Stretches of a file are sorted apart, and only a row of each meets the
    others, so that a file of any length is no task's load."""
    here = Window.partitionBy("file", "_stretch").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    above = Window.partitionBy("file").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    ends = placed.groupBy("file", "_stretch").agg(F.max_by("_mark", F.when(F.col("_mark").isNotNull(), F.col("line_no"))).alias("_end"))
    starts = ends.select(F.col("file").alias("_file"), F.col("_stretch").alias("_of"), F.last("_end", ignorenulls=True).over(above).alias("_start"))
    found = placed.withColumn("_in", F.last("_mark", ignorenulls=True).over(here))
    same = F.col("file").eqNullSafe(F.col("_file")) & F.col("_stretch").eqNullSafe(F.col("_of"))
    return found.join(starts, same).withColumn("_in", F.coalesce("_in", "_start"))


def _cell(i: int) -> Column:
    return F.coalesce(F.get("cells", F.lit(i)), F.lit(""))


def _count(i: int) -> Column:
    return F.coalesce(F.when(_cell(i).rlike("^[0-9]+$"), _cell(i).try_cast("long")), F.lit(0))


def slice_rows(cells: DataFrame) -> DataFrame:
    """Of at least nine cells; with nine, the old layout, the time comes last and there is no note."""
    new = F.size("cells") >= 10
    kept = cells.where(F.size("cells") >= 9)
    text = [_cell(i + 1).alias(c) for i, c in enumerate(SLICES[:7])]
    text[4] = _count(5).alias("slice_count")
    return kept.select("file", "line_no", *text, F.when(new, _cell(8)).otherwise("").alias("note"), F.when(new, _cell(9)).otherwise(_cell(8)).alias("time"))


def mix_rows(cells: DataFrame) -> DataFrame:
    """Of at least seven cells; seed and batch may be missing."""
    text = [_cell(i + 1).alias(c) for i, c in enumerate(MIXES)]
    text[2] = _count(3).alias("count")
    return cells.where(F.size("cells") >= 7).select("file", "line_no", *text)


def row_line(number: Column, *cells: Column) -> Column:
    """A bar in a cell would shift the others, so it becomes a full-width one."""
    safe = [F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("|"), F.lit("｜")) for c in cells]
    return F.concat(F.lit("| "), number.cast("string"), *(x for c in safe for x in (F.lit(" | "), c)), F.lit(" |"))


def rendered(parts: list[tuple[str, list[str], DataFrame, list[str], list[str]]], title: str) -> DataFrame:
    """(line_no, line) of a whole ledger. parts: anchor, header names, rows, their total order, the columns of the cells. Rows are
    numbered from 1 in each part."""
    spark = parts[0][2].sparkSession
    out, start = spark.createDataFrame([(1, title), (2, "")], "line_no long, line string"), 3
    for anchor, header, rows, order, cells in parts:
        head = [anchor, "", "| # | " + " | ".join(header) + " |", "|" + "---|" * (len(header) + 1)]
        body = stored(numbered(rows, order).select("number", row_line(F.col("number"), *map(F.col, cells)).alias("line")), "body")
        out = out.unionByName(spark.createDataFrame([(start + i, x) for i, x in enumerate(head)], "line_no long, line string"))
        out = out.unionByName(body.select((F.col("number") + (start + len(head) - 1)).alias("line_no"), "line"))
        start += len(head) + body.count() + 1
        out = out.unionByName(spark.createDataFrame([(start - 1, "")], "line_no long, line string"))
    return out


def appended(ledger: DataFrame, new: DataFrame, time: str, now: Column) -> DataFrame:
    """The ledger with new rows; those without a time get this one."""
    return ledger.unionByName(new.withColumn(time, F.coalesce(F.nullif(F.col(time), F.lit("")), now)))


def mix_entry(clips: DataFrame, keys: list[str], place: str, name: str, category: str, speed: str, transition: str) -> DataFrame:
    """(keys, used, transitions) of a mix: its clips in order with the speeds that aren't 1, 200 characters at most as the ledger
    keeps them, and its distinct transitions in order of name."""
    fast = F.when(F.abs(F.col(speed) - 1) > 1e-6, F.concat(F.lit("@"), F.round(speed, 2).cast("string"), F.lit("x"))).otherwise("")
    item = F.struct(F.col(place).alias("at"), F.concat(F.col(name), F.lit("["), F.col(category), F.lit("]"), fast).alias("said"))
    used = F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["said"]), "; ")
    return clips.groupBy(*keys).agg(F.left(used, F.lit(200)).alias("used"), F.array_join(F.array_sort(F.collect_set(transition)), ",").alias("transitions"))


def minute(at: Column, zone: str = "+08:00") -> Column:
    """A time of UTC as a ledger writes it, in its zone."""
    return F.date_format(F.from_utc_timestamp(at, zone), "yyyy-MM-dd HH:mm")
