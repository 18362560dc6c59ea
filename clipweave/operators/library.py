"""Clip libraries and ledgers as text: indexes, tables, appends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipweave.functions.text import ustrip


def _cell(cells: Column, i: int) -> Column:
    return F.coalesce(F.get(cells, F.lit(i)), F.lit(""))


def index_rows(lines: DataFrame, line: str = "line") -> DataFrame:
    """Adds name, duration, position, speech from bullet lines `- name.mp4 | 6.0s | position | speech`; other lines go."""
    body = F.transform(F.split(F.expr(f"substring({line}, 3)"), r"\|"), ustrip)
    return (
        lines.where(F.col(line).startswith("- ")).withColumn("_cells", body)
        .where((F.size("_cells") >= 2) & F.endswith(_cell(F.col("_cells"), 0), F.lit(".mp4")))
        .withColumn("name", _cell(F.col("_cells"), 0))
        .withColumn("duration", F.regexp_replace(_cell(F.col("_cells"), 1), "s+$", "").try_cast("double"))
        .withColumn("position", _cell(F.col("_cells"), 2)).withColumn("speech", _cell(F.col("_cells"), 3))
        .where("duration is not null").drop("_cells")
    )


def index_line(name: Column, duration: Column, position: Column, speech: Column) -> Column:
    return F.concat(F.lit("- "), name, F.lit(" | "), F.format_string("%.1fs", duration), F.lit(" | "), position, F.lit(" | "), speech)


def with_files(index: DataFrame, files: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Index rows of existing files; of files of one name the last counts."""
    last = files.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in files.columns if c not in keys]), F.col(order)).alias("_f")).select(*keys, "_f.*")
    return index.join(last, keys)


def new_lines(new: DataFrame, existing: DataFrame, columns: list[str]) -> DataFrame:
    """Lines to append: not there yet, each once."""
    return new.select(*columns).distinct().join(existing.select(*columns).distinct(), columns, "left_anti")


def ledger_line(number: Column, *cells: Column) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", number.cast("string"), *[c.cast("string") for c in cells]), F.lit(" |"))


def ledger_rows(lines: DataFrame, names: list[str], line: str = "line") -> DataFrame:
    """Rows of a text table by cell name; header, rules and rows of too few or empty first cells go."""
    cells = F.transform(F.split(F.expr(f"substring({line}, 2, length({line}) - 2)"), r"\|", -1), ustrip)
    rows = lines.where(F.col(line).startswith("|")).withColumn("_cells", cells)
    first = _cell(F.col("_cells"), 0)
    good = rows.where((F.size("_cells") > len(names)) & (first != "") & (first != "#") & ~first.rlike("^[-: ]+$"))
    return good.select(*[c for c in lines.columns if c != line], *(_cell(F.col("_cells"), i + 1).alias(n) for i, n in enumerate(names)))


def carried(rows: DataFrame, keys: list[str], order: str, label: str) -> DataFrame:
    """A blank label continues the label above it."""
    from pyspark.sql import Window

    above = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(label, F.last(F.nullif(F.col(label), F.lit("")), ignorenulls=True).over(above))
