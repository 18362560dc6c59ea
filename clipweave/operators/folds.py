"""Ordered folds: operators whose step depends on what was kept or merged before.

`ordered_fold` streams rows in order through a Python step with constant state, so a key of any size is
folded without being gathered, in time that grows with its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def ordered_fold(rows: DataFrame, keys: list[str], order: list[str], start: Callable[[], Any], step: Callable[[Any, dict], tuple[Any, list[dict]]], finish: Callable[[Any], list[dict]], schema: str) -> DataFrame:
    """For each key, state = start(); each row in order: state, out = step(state, row); then finish(state). out: rows of the schema."""
    names = rows.columns
    fields = StructType.fromDDL(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, begun = None, None, False
        for batch in batches:
            out: list[dict] = []
            for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = dict(zip(names, values, strict=True))
                key = tuple(row[k] for k in keys)
                if not begun or key != now:
                    if begun:
                        out += finish(state)
                    now, state, begun = key, start(), True
                state, more = step(state, row)
                out += more
            if out:
                yield _batch(out, fields, kinds)
        if begun and (out := finish(state)):
            yield _batch(out, fields, kinds)

    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(StructType.fromDDL(schema))
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def _batch(rows: list[dict], fields: list[str], kinds: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f] for r in rows], kinds.field(f).type) for f in fields], names=fields)


def gap_dedup(rows: DataFrame, key: str, at: str, gap: int) -> DataFrame:
    """(key, at): whole-number times of which each is more than gap after the last one kept. The state is that one."""
    kinds = dict(rows.dtypes)

    def step(last, row):
        keeps = last is None or row[at] - last > gap
        return (row[at] if keeps else last), [row] if keeps else []

    named = rows.select(key, at).where(F.col(at).isNotNull())
    return ordered_fold(named, [key], [at], lambda: None, step, lambda last: [], f"{key} {kinds[key]}, {at} {kinds[at]}")


def size_batches(rows: DataFrame, key: str, order: list[str], size: str, limit: int, keep: list[str]) -> DataFrame:
    """Rows plus batch: a batch closes when one more would pass the limit, unless it is empty; an oversize row is alone."""
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in [key, *keep]) + ", batch bigint"

    def step(state, row):
        batch, held, total = state
        add = row[size] or 0
        if held and total + add > limit:
            batch, held, total = batch + 1, 0, 0
        return (batch, held + 1, total + add), [{c: row[c] for c in (key, *keep)} | {"batch": batch}]

    return ordered_fold(rows.select(*dict.fromkeys([key, *keep, *order, size])), [key], order, lambda: (0, 0, 0), step, lambda s: [], schema)
