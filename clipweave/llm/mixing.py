"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Sizes are words. A source's documents stand in an order that is a random permutation of them, and are cut into blocks
of about as many words in every source. A source's target is met by whole passes over its blocks and one partial pass:
the blocks below a cut, which is searched by sums of ever smaller ranges, and one last block, made of the documents
between, and of chosen ones that end nearest to the target. The blocks to draw, counted by source, are the root of a
binary tree over output shards: each node deals its counts to its two children with a multivariate hypergeometric draw
of the left child's exact size. A leaf so holds its shard's exact quota of each source, and takes its next blocks in
the source's permuted order, which makes the draws disjoint; what is taken of a document is counted from the leaves.
Rows are ordered by a hash inside their shard.

All draws come from seeds and hashes: reruns agree. Nulls: a null text has no words, the null source is a source of its
own that comes last, a null doc_id hashes as a value of its own. Rows that repeat id and text are drawn together, ties
of the order with them. Documents without words are never drawn, long texts whole, like others. An empty table gives an
empty mix. Sources and blocks (their number is bounded) are driver-sized tables; documents never are. Other columns
pass through mix(), whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipweave.llm.common import fresh, partitions, small_side, stored, text_of, without

WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a document's place in its source; bits by which a step of the search narrows a range.
PLACE, STEP = 62, 6
#: Most places of the range that the search ends in; documents of each size class beyond it that may be chosen besides.
ENDING, SPARE = 64, 4
#: Steps in which sums are told apart when the last documents are chosen.
GRAIN = 1 << 16


@dataclass(frozen=True)
class MixSpec:
    """shards: of the output; unless given, one for shard_words of the mix, 16 at least and 1024 at most. blocks_a_shard: how many
    blocks a shard is dealt, about."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    share: float = 1.5
    most: float = 2.0
    shards: int | None = None
    shard_words: int = 1 << 24
    blocks_a_shard: int = 64
    seed: int = 20240607


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Water filling: shares by weight, none above most times its size, the excess reshared by weight."""
    out, open_, left = [0.0] * len(sizes), set(range(len(sizes))), total
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = {i for i in open_ if weights[i] * unit > most * sizes[i]}
        if not full:
            for i in open_:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        open_ -= full
    return out


def split_tree(counts: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """counts: blocks to draw of each source. Exact quotas, shards x sources, summing to counts."""
    out = np.zeros((shards, len(counts)), np.int64)

    def deal(held: np.ndarray, lo: int, hi: int) -> None:
        if hi - lo == 1:
            out[lo] = held
            return
        mid, total = (lo + hi) // 2, int(held.sum())
        take = total * (mid - lo) // (hi - lo)
        rng = np.random.Generator(np.random.PCG64([seed, lo, hi]))
        left = rng.multivariate_hypergeometric(held, take, method="marginals") if 0 < take < total else held * (take > 0)
        deal(left, lo, mid)
        deal(held - left, mid, hi)

    deal(np.asarray(counts, np.int64), 0, shards)
    return out


def measured(docs: DataFrame, spec: MixSpec, id_col: str, text_col: str, source_col: str) -> tuple[Column, Column, Column]:
    """Of a document: its size, a name of its source that is never null, and its place in the source's order."""
    text = text_of(text_col)
    src = F.when(F.col(source_col).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(source_col).cast("string")))
    place = F.xxhash64(F.lit(spec.seed), F.coalesce(F.col(id_col).cast("string"), F.lit("-")), text).bitwiseAND(F.lit((1 << PLACE) - 1))
    return n_words(text), src, place


def block_of(place, blocks):
    """Which of a source's blocks a place is in; for numbers and columns."""
    if isinstance(place, Column):
        return F.shiftright(F.shiftright(place, PLACE // 2) * blocks, PLACE // 2)
    return ((place >> PLACE // 2) * blocks) >> PLACE // 2


def nearest(units: list[tuple[int, int]], want: float) -> list[int]:
    """Places of units whose sizes sum as close to want as steps of want / GRAIN tell; sums are bits of one whole number a unit."""
    step = max(1.0, want / GRAIN)
    fit = [(place, round(size / step)) for place, size in units if 0 < size < 2 * want]
    top, sums = int(2 * want / step) + 1, [1]
    for _, size in fit:
        sums.append((sums[-1] | sums[-1] << size) & ((1 << (top + 1)) - 1))
    goal = round(want / step)
    below = (sums[-1] & ((1 << (goal + 1)) - 1)).bit_length() - 1
    above = sums[-1] >> (goal + 1)
    total = below
    if above and (up := goal + (above & -above).bit_length()) - goal < goal - below:
        total = up
    chosen = []
    for i in range(len(fit) - 1, -1, -1):
        if not sums[i] >> total & 1:
            chosen.append(fit[i][0])
            total -= fit[i][1]
    return chosen[::-1]


def _searched(slim: DataFrame, want: dict[str, float], counts: dict[str, int]) -> tuple[dict[str, tuple[int, int]], dict[str, float]]:
    """For each source the range of places [low, high) in which the running sum passes what is wanted, of ENDING places at most,
    and what is still wanted before it."""
    spark, bits = slim.sparkSession, PLACE
    ranges = {n: (0, 1 << PLACE) for n in want}
    left, open_ = dict(want), [n for n in want if counts[n] > ENDING and want[n] > 0]
    while open_ and bits > 0:
        step = min(STEP, bits)
        bits -= step
        lows = spark.createDataFrame([(n, ranges[n][0], ranges[n][1]) for n in open_], "src string, low long, high long")
        inside = slim.join(small_side(lows, 48), "src").where("place >= low and place < high")
        parts: dict[str, list] = {n: [] for n in open_}
        for r in inside.groupBy("src", F.shiftright(F.col("place") - F.col("low"), bits).alias("part")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect():
            parts[r["src"]].append((r["part"], r["size"], r["n"]))
        still = []
        for n in open_:
            low, high = ranges[n]
            for part, size, rows in sorted(parts[n]):
                ranges[n] = (low + (part << bits), low + ((part + 1) << bits))
                if size >= left[n]:
                    if rows > ENDING:
                        still.append(n)
                    break
                left[n] -= size
            else:  # by rounding, all of the range is wanted
                ranges[n] = (high, high)
        open_ = still
    return ranges, left


@dataclass
class Plan:
    """sources: (src, source_size, target, blocks, cut, low, chosen, last: shard of the last block); draws: (src, block, draws)."""

    sources: DataFrame
    draws: DataFrame
    shards: int


def plan(slim: DataFrame, spec: MixSpec) -> Plan:
    """From (src, size, place) rows."""
    spark = slim.sparkSession
    rows = slim.groupBy("src").agg(F.sum("size").alias("size"), F.count_if(F.col("size") > 0).alias("n")).collect()
    named = sorted((r["src"][0] == "-", r["src"], r["size"], r["n"]) for r in rows)
    names, sizes, counts = [x[1] for x in named], [int(x[2]) for x in named], {x[1]: x[3] for x in named}
    weights = [spec.weights[i % len(spec.weights)] for i in range(len(names))]
    total = spec.share * sum(sizes)
    goal = targets(sizes, weights, total, spec.most)
    passes = [int(t // s) if s else 0 for t, s in zip(goal, sizes, strict=True)]
    want = {n: t - p * s for n, t, p, s in zip(names, goal, passes, sizes, strict=True)}
    shards = spec.shards or int(min(1024, max(16, total // spec.shard_words)))
    words = max(1.0, total / (shards * spec.blocks_a_shard))
    blocks = [max(1, round(s / words)) for s in sizes]

    some = slim.where("size > 0")
    ranges, left = _searched(some, want, counts)
    bounds = spark.createDataFrame([(n, *ranges[n], b) for n, b in zip(names, blocks, strict=True)], "src string, low long, high long, blocks long")
    placed = some.join(small_side(bounds, 64), "src")
    beyond = Window.partitionBy("src", "class").orderBy("place")
    further = placed.where("place >= high").withColumn("class", F.floor(F.log2("size"))).withColumn("i", F.row_number().over(beyond)).where(F.col("i") <= SPARE)
    ending = stored(placed.where("place >= low and place < high").select("src", "place").unionByName(further.select("src", "place")).distinct(), "ending")
    units: dict[str, list] = {n: [] for n in names}
    for r in some.join(small_side(ending, 48), ["src", "place"]).groupBy("src", "place").agg(F.sum("size").alias("size")).collect():
        units[r["src"]].append((r["place"], r["size"]))
    chosen = {n: nearest(sorted(units[n]), left[n]) if left[n] > 0 else [] for n in names}
    cut = {n: block_of(ranges[n][0], b) for n, b in zip(names, blocks, strict=True)}

    full: dict[str, list] = {n: [] for n in names}
    for r in placed.select("src", block_of(F.col("place"), F.col("blocks")).alias("block")).distinct().collect():
        full[r["src"]].append(r["block"])
    draws, last = [], len(names) * [None]
    for i, n in enumerate(names):
        mine = np.array(sorted(full[n]), np.int64)
        for p in range(passes[i] + 1):
            order = np.random.Generator(np.random.PCG64([spec.seed, i, p])).permutation(mine)
            draws += [(i, p, int(b)) for b in order if p < passes[i] or want[n] > 0 and b < cut[n]]
        if want[n] > 0:
            draws.append((i, passes[i], -1))
    quota = np.bincount([d[0] for d in draws], minlength=len(names)) if draws else np.zeros(len(names), np.int64)
    ends = np.cumsum(split_tree(quota, shards, spec.seed), axis=0) if names else np.zeros((shards, 0))
    seen, dealt = [0] * len(names), {}
    for i, p, b in draws:
        shard = int(np.searchsorted(ends[:, i], seen[i], side="right"))
        seen[i] += 1
        if b < 0:
            last[i] = shard
        else:
            dealt.setdefault((names[i], b), []).append((p, shard))
    sources = spark.createDataFrame(
        [(n, sizes[i], float(goal[i]), blocks[i], cut[n], ranges[n][0], chosen[n], passes[i], last[i]) for i, n in enumerate(names)],
        "src string, source_size long, target double, blocks long, cut long, low long, chosen array<long>, passes int, last int",
    )
    flat = spark.createDataFrame([(n, b, d) for (n, b), d in dealt.items()], "src string, block long, draws array<struct<pass:int,shard:int>>")
    return Plan(sources, flat, shards)


def drawn(rows: DataFrame, made: Plan, size: str, src: str, place: str) -> DataFrame:
    """(row: all columns of rows, source_size, target, draws: array of (pass, shard)), the draws as the tree's leaves have them."""
    out = rows.select(F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"))
    mine = lambda c: F.col("row").getField(c)
    out = out.withColumn("src", mine(src)).join(small_side(made.sources, 2048), "src", "left")
    out = out.withColumn("block", block_of(mine(place), F.col("blocks"))).join(small_side(made.draws, 64), ["src", "block"], "left")
    ends = F.col("last").isNotNull() & (((F.col("block") == F.col("cut")) & (mine(place) < F.col("low"))) | F.array_contains("chosen", mine(place)))
    none = F.expr("array()").cast("array<struct<pass:int,shard:int>>")
    more = F.when(ends, F.array(F.struct(F.col("passes").alias("pass"), F.col("last").alias("shard")))).otherwise(none)
    return out.select("row", "source_size", "target", F.when(mine(size) > 0, F.concat(F.coalesce("draws", none), more)).otherwise(none).alias("draws"))


def quotas(docs: DataFrame, spec: MixSpec = MixSpec(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken, shards: of each draw) of each row of docs."""
    size, src, place = measured(docs, spec, id_col, text_col, source_col)
    slim = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), size.alias("size"), src.alias("src"), place.alias("place")), "sizes")
    out = drawn(slim, plan(slim, spec), "size", "src", "place")
    return out.select("row.doc_id", "row.size", "source_size", "target", (F.col("row.size") * F.size("draws")).alias("taken"), F.transform("draws", lambda d: d["shard"]).alias("shards"))


def mix(docs: DataFrame, spec: MixSpec = MixSpec(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shard_out: str = "shard") -> DataFrame:
    """The mixed corpus: docs' columns plus the shard, in place of a column of this name, one row per draw, shards apart and
    shuffled inside. A shard is dealt to as many tasks as fill the partitions."""
    docs = without(docs, shard_out)
    size, src, place = (fresh(docs, n) for n in ("size", "src", "place"))
    rows = docs.withColumns(dict(zip((size, src, place), measured(docs, spec, id_col, text_col, source_col), strict=True)))
    made = plan(stored(rows.select(F.col(size).alias("size"), F.col(src).alias("src"), F.col(place).alias("place")), "sizes"), spec)
    each = drawn(rows, made, size, src, place).select("row", F.explode("draws").alias("draw"))
    spread = max(1, 4 * partitions(docs.sparkSession) // made.shards)
    return (
        each.withColumn("shard", F.col("draw.shard")).withColumn("order", F.xxhash64(F.col("row").getField(place), "draw.pass", F.lit(spec.seed)))
        .repartition("shard", F.pmod("order", F.lit(spread))).sortWithinPartitions("shard", "order")
        .select(*(F.col("row").getField(n).alias(n) for n in docs.columns), F.col("shard").alias(shard_out))
    )
