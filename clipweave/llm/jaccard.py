"""N-gram Jaccard join of whole texts with signature trees; exact, with connected components.

Sets. A document's set holds the 64-bit hashes of its word shingles. Documents with the same set (128 bits
of it) are one class from the start, so copies never meet in pairs; a block of texts passes on a set once.

Families. Two sets of similarity t or more must share a shingle among the first n - ceil(t n) + 1 of each, in
any fixed order of all shingles. The order puts rare shingles first: those whose hash is under a fixed bound are
counted over all documents, by sending owners of hash ranges Golomb-coded messages and getting each shingle's
level (the logarithm of its count) back; the others come last. A shingle that only one set has can't be shared,
so only rows of shared ones are shuffled. Sets held together by shared first shingles are a family; a link never
leaves one.

Links. A family's sets are ordered by a minhash and cut, by range, into chunks of bounded rows; a chunk goes to a
signature tree. Leaves are documents, nodes hold the OR of their shingle bitmaps, their range of sizes and their
component if it is but one. A dual traversal from the root drops node pairs of one component, of sizes too far
apart, or whose largest possible overlap (common bits, plus shingles that share bits) is too small. Remaining
pairs are verified on their sets, unless a link found before has joined their components. A family of one chunk
is done then. Of larger ones, one set for each component goes through further rounds in other orders, which joins
most components of near copies at linear cost. What is still apart is looked into exactly: chunks, the roots of
their trees in a tree of the family, and the pairs of chunks that this tree leaves. No pair across components is
dropped otherwise, so no link is lost, nor is any cap set.

Wide tables are kept on the executors' disks, not written: each file written starts processes on a local file system.

Components are labelled by the smallest doc_id: blocks of edges become stars where they lie, with alternating
large-star and small-star steps until the stars that are left fit a block.

Nulls: a null text is the empty text; documents without words have an empty set and link with nothing. A
null doc_id counts as an id below all others. Rows that share a doc_id count as one document with several
texts. Repeated rows and ties need no order. A long text is worked on alone, in memory of some ten times its size.
An empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipweave.llm.common import NULL_ID, drop, fresh, id_key, joined, kept, partitions, small_side, stored, text_of, in_arrow
from clipweave.llm.exact_dedup import golomb_decode, golomb_encode
from clipweave.llm.shingles import all_sets, mixed, slices

#: Bytes of text whose sets are made together; offered hashes of a block; bits of the slot of an offered hash beyond those
#: that tell all of them apart.
SLICE, BLOCK, SPARE = 4 << 20, 1 << 18, 7
#: Bits of the smallest bitmap; children of a tree node; node pairs looked at together.
BITS, FANOUT, TOGETHER = 512, 8, 8192
#: Orders in which a family's sets meet, one a round.
ORDERS = 3
#: Edges that a task turns into stars at once (16 MB).
FOREST = 1 << 20
SIGNED = np.int64


@dataclass(frozen=True)
class JoinSpec:
    """words: of a shingle; percent: least similarity. chunk_rows, chunk_shingles: most rows of a chunk of a family, and most
    shingles before its last set; all pairs of chunks that can link are looked into.
    owner_values: hashes that an owner should get. name_bits: of a set's first name (fewer only in tests, to make names clash)."""

    words: int = 5
    percent: int = 80
    chunk_rows: int = 512
    chunk_shingles: int = 1 << 21
    owner_values: int = 1 << 21
    name_bits: int = 64

    @property
    def offered(self) -> np.uint64:
        """Shingles up to this hash are counted: two and a half times as many as a prefix holds."""
        return np.uint64(min(1.0, 0.025 * (100 - self.percent)) * ((1 << 64) - (1 << 12)))

    def prefix(self, sizes: np.ndarray) -> np.ndarray:
        """How many first shingles a set passes on."""
        return sizes - -(-self.percent * sizes // 100) + 1


def set_names(sets: list[np.ndarray], bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of each set (0 for the empty set)."""
    a, b = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
    full = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    if len(full):
        whole = np.concatenate([sets[i] for i in full])
        starts = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
        a[full] = np.add.reduceat(mixed(whole ^ np.uint64(0xA5A5)), starts)
        b[full] = np.add.reduceat(mixed(whole ^ np.uint64(0xC3C3C3)), starts)
    size = np.array([len(s) for s in sets], np.uint64)
    return mixed(a + size) >> np.uint64(64 - bits), mixed(b + size)


def settled(a: np.ndarray, b: np.ndarray, clashed: np.ndarray) -> np.ndarray:
    """The names that classes go by: the first one, or, where different sets share it, one made of both."""
    return np.where(np.isin(a, clashed), mixed(a ^ mixed(b)), a) if len(clashed) else a


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Common members of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x):
        return 0
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def dealt(df: DataFrame, tag: str) -> DataFrame:
    """df, kept; not by the key it was grouped by, since a join on that key would then leave a frequent key to one task. (A hint to
    rebalance is no way: read locally, rows stay where they were.)"""
    return kept(df.repartition(F.xxhash64(*df.columns)), tag)


def _batch(**cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def _long(x) -> pa.Array:
    return pa.array(np.asarray(x).astype(np.uint64).view(SIGNED) if getattr(x, "dtype", None) == np.uint64 else np.asarray(x, np.int64))


NAMED = "kind int, key long, a long, b long, n long, sets binary, more binary, hashes binary"


def _name_pass(rows: DataFrame, spec: JoinSpec) -> DataFrame:
    """kind 0: (key, names a and b, size n) of each row. kind 1: blocks of distinct sets; key names the block; sets: a, b, size, how
    many offered and how many further hashes for each set; hashes: the offered ones; more: what a prefix may take after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, seen, held, rest, about, size = TaskContext.get().partitionId() << 24, set(), [], [], [], 0

        def out() -> pa.RecordBatch:
            data = [np.array(about, np.uint64).reshape(-1, 5), np.concatenate(rest), np.concatenate(held)]
            one = [pa.array([None], pa.int64())] * 3
            return pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), pa.array([block], pa.int64()), *one, *(pa.array([x.tobytes()], pa.binary()) for x in data)], names=names)

        names = [x.split()[0] for x in NAMED.split(", ")]
        for batch in (part for whole in batches for part in slices(whole, "body", most=SLICE)):
            keys = batch.column("key").to_numpy(zero_copy_only=False)
            for row, sets in all_sets(batch.column("body"), spec.words):
                a, b = set_names(sets, spec.name_bits)
                n = len(sets)
                sizes = np.array([len(s) for s in sets], np.int64)
                none = [pa.nulls(n, pa.binary())] * 3
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), _long(keys[row : row + n]), _long(a), _long(b), pa.array(sizes), *none], names=names)
                take = spec.prefix(sizes)
                for i in np.flatnonzero(sizes).tolist():
                    name = (int(a[i]), int(b[i]))
                    if name in seen:
                        continue
                    seen.add(name)
                    cut = int(np.searchsorted(sets[i], spec.offered, side="right"))
                    further = sets[i][cut : cut + max(0, int(take[i]) - cut)].copy()
                    held.append(sets[i][:cut].copy())
                    rest.append(further)
                    about.append((*name, int(sizes[i]), cut, len(further)))
                    size += cut + len(further) + 5
                    if size >= BLOCK:
                        yield out()
                        block, seen, held, rest, about, size = block + 1, set(), [], [], [], 0
        if about:
            yield out()

    return kept(in_arrow(rows, run, NAMED), "sets")


# -- the exchange: how often is a shingle found?


def _slots(hashes: bytes, shift: int) -> np.ndarray:
    return np.frombuffer(hashes, np.uint64) >> np.uint64(shift)


def _first_prefixes(blocks: DataFrame, spec: JoinSpec, clashed: np.ndarray) -> DataFrame:
    """(key, sid, n): the shingles, of those first in order, that more sets than one may have."""
    spark = blocks.sparkSession
    total = blocks.agg(F.sum(F.length("hashes"))).first()[0] or 0
    shift = max(0, 64 - max(16, int(total // 8).bit_length() + SPARE))
    limit = (int(spec.offered) >> shift) + 1
    owners = int(max(partitions(spark), total // 8 // spec.owner_values))
    starts = [(i * limit) // owners for i in range(owners)]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = np.array(starts, np.uint64)
        for batch in batches:
            for key, hashes in zip(batch.column("key").to_pylist(), batch.column("hashes"), strict=True):
                mine, times = np.unique(_slots(hashes.as_py(), shift), return_counts=True)
                cut = np.append(np.searchsorted(mine, start), len(mine))
                full = np.flatnonzero(np.diff(cut))
                coded = [golomb_encode(mine[cut[o] : cut[o + 1]], starts[o]) for o in full]
                counts = [np.minimum(times[cut[o] : cut[o + 1]], 255).astype(np.uint8) for o in full]
                told = [zlib.compress(c.tobytes(), 1) if c.max() > 1 else b"" for c in counts]
                yield _batch(owner=pa.array(full, pa.int32()), key=pa.array([key] * len(full), pa.int64()), message=pa.array(coded, pa.binary()), times=pa.array(told, pa.binary()))

    def answer(messages: pa.Table) -> pa.Table:
        start = starts[messages["owner"][0].as_py()]
        lists = [golomb_decode(m.as_py(), start) for m in messages["message"].combine_chunks()]
        times = [np.frombuffer(zlib.decompress(t), np.uint8) if t else np.ones(len(x), np.uint8) for t, x in zip(messages["times"].to_pylist(), lists, strict=True)]
        _, at = np.unique(np.concatenate(lists), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate(times))
        level = np.floor(np.log2(counts)).astype(np.uint8)[at]
        ends = np.cumsum([len(x) for x in lists])
        told = [zlib.compress(x.tobytes(), 1) for x in np.split(level, ends[:-1])]
        return pa.table({"owner": messages["owner"], "key": messages["key"], "levels": pa.array(told, pa.binary())})

    def receive(block: pa.Table, answers: pa.Table) -> pa.Table:
        empty = pa.table({c: pa.array([], pa.int64()) for c in ("key", "sid", "n")})
        if not block.num_rows:
            return empty
        raw = block["hashes"][0].as_py()
        hashes, further = np.frombuffer(raw, np.uint64), np.frombuffer(block["more"][0].as_py(), np.uint64)
        a, b, sizes, counts, extra = np.frombuffer(block["sets"][0].as_py(), np.uint64).reshape(-1, 5).T
        told = sorted(zip(answers["owner"].to_pylist(), answers["levels"].to_pylist(), strict=True))  # owners hold ranges in order
        levels = np.frombuffer(b"".join(zlib.decompress(x) for _, x in told), np.uint8)
        level = levels[np.unique(_slots(raw, shift), return_inverse=True)[1]] if len(hashes) else levels
        sid, sizes = settled(a, b, clashed), sizes.astype(np.int64)
        take, ends, later = spec.prefix(sizes), np.cumsum(counts.astype(np.int64)), np.cumsum(extra.astype(np.int64))
        alone = np.diff(np.concatenate([[0], np.cumsum(level == 0)])[np.concatenate([[0], ends])])
        keys, names = [], []
        for i in np.flatnonzero(alone < take).tolist():
            lo, hi = ends[i] - int(counts[i]), ends[i]
            mine = level[lo:hi]
            order = np.argsort(mine, kind="stable")[: take[i]]
            shared = hashes[lo:hi][order[mine[order] > 0]]
            keys += [shared, further[later[i] - int(extra[i]) : later[i]]]
            names.append(np.full(len(shared) + int(extra[i]), i))
        if not names:
            return empty
        who = np.concatenate(names)
        return pa.table({"key": _long(np.concatenate(keys)), "sid": _long(sid[who]), "n": _long(sizes[who])})

    messages = in_arrow(blocks.select("key", "hashes"), send, "owner int, key long, message binary, times binary")
    answers = messages.groupBy("owner").applyInArrow(answer, "owner int, key long, levels binary")
    found = blocks.select("key", "sets", "more", "hashes").groupBy("key").cogroup(answers.groupBy("key")).applyInArrow(receive, "key long, sid long, n long")
    return kept(found, "prefixes")


# -- signature trees


def width_of(size: int) -> int:
    """Bits for a set of this size: a power of two of at least two bits a shingle, which tells strangers apart at two thirds
    of the overlap that a link needs, and travels at a twentieth of the set's bytes."""
    bits = BITS
    while bits < 2 * size:
        bits *= 2
    return bits


def bitmap(s: np.ndarray) -> np.ndarray:
    """The set's bits as words; a wider bitmap folds into a narrower one."""
    width = width_of(len(s))
    bits = np.zeros(width, np.uint8)
    bits[(mixed(s ^ np.uint64(0x1B17)) % np.uint64(width)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (the last axis) folded to so many words."""
    return np.bitwise_or.reduce(bits.reshape(*bits.shape[:-1], -1, words), axis=-2)


class SignatureTree:
    """Levels from the leaves up: OR-ed bitmaps, range of sizes, shared bits, and the labels (-1: several). Nodes that agree in
    one of the labels, the component or the side, have no pair to look for."""

    def __init__(self, bits: np.ndarray, lo: np.ndarray, hi: np.ndarray, shared: np.ndarray, labels: list[np.ndarray]):
        self.levels = [(bits, lo, hi, shared, labels)]
        while len(self.levels[-1][1]) > 1:
            b, lo, hi, sh, labels = self.levels[-1]
            at = np.arange(0, len(lo), FANOUT)
            ends = [(np.minimum.reduceat(x, at), np.maximum.reduceat(x, at)) for x in labels]
            self.levels.append((
                np.bitwise_or.reduceat(b, at, axis=0), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.maximum.reduceat(sh, at),
                [np.where((low == high) & (low >= 0), low, -1) for low, high in ends],
            ))

    def _may_link(self, level: int, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        b, lo, hi, sh, labels = self.levels[level]
        ok = (100 * hi[i] >= percent * lo[j]) & (100 * hi[j] >= percent * lo[i])
        for x in labels:
            ok &= ~((x[i] == x[j]) & (x[i] >= 0))
        at = np.flatnonzero(ok)
        common = np.bitwise_count(b[i[at]] & b[j[at]]).sum(axis=1, dtype=np.int64) + np.minimum(sh[i[at]], sh[j[at]])
        # similarity s needs an overlap of s / (1 + s) of both sizes together
        ok[at] = (100 + percent) * common >= percent * (lo[i[at]] + lo[j[at]])
        return ok

    def pairs(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Dual traversal: leaf pairs (i < j) of different components that no bound excludes."""
        top = len(self.levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, i, j = stack.pop()
            if len(i) > TOGETHER:
                half = len(i) // 2
                stack += [(level, i[half:], j[half:]), (level, i[:half], j[:half])]
                continue
            if level == 0:
                apart = i != j
                i, j = i[apart], j[apart]
            ok = self._may_link(level, i, j, percent)
            i, j = i[ok], j[ok]
            if not len(i):
                continue
            if level == 0:
                yield i, j
                continue
            kids = np.arange(FANOUT)
            x = (i[:, None, None] * FANOUT + kids[None, :, None] + 0 * kids[None, None, :]).ravel()
            y = (j[:, None, None] * FANOUT + kids[None, None, :] + 0 * kids[None, :, None]).ravel()
            n = len(self.levels[level - 1][1])
            good = (x < n) & (y < n) & (x <= y)
            stack.append((level - 1, x[good], y[good]))


def grouped(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[list[tuple]]:
    """Rows of one key (the first column) at a time, from rows in order of it."""
    group: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            if group and group[-1][0] != row[0]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def labels_of(values) -> np.ndarray:
    """Values as labels from 0 on."""
    return np.unique(np.asarray(values), return_inverse=True)[1].astype(np.int64)


def candidate_pairs(marks: list[np.ndarray], sizes: np.ndarray, label: np.ndarray, percent: int, side: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a unit's documents, of different labels and sides, that the trees leave: one tree for each width of bitmaps,
    and one for each two widths over the documents whose sizes can meet, the wider bitmaps folded."""
    width = np.array([len(m) for m in marks])
    known = [label] if side is None else [label, side]

    def tree(words: np.ndarray, idx: np.ndarray, more: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        shared = sizes[idx] - np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        for i, j in SignatureTree(words, sizes[idx], sizes[idx], shared, [x[idx] for x in known] + more).pairs(percent):
            yield idx[i], idx[j]

    widths = np.unique(width).tolist()
    for k, w in enumerate(widths):
        mine = np.flatnonzero(width == w)
        yield from tree(np.stack([marks[i] for i in mine]), mine, [])
        for v in widths[k + 1 :]:
            other = np.flatnonzero(width == v)
            near = mine[100 * sizes[mine] >= percent * sizes[other].min()]
            far = other[percent * sizes[other] <= 100 * sizes[mine].max()]
            if len(near) and len(far):
                words = np.stack([marks[i] for i in near] + [folded(marks[i], w) for i in far])
                yield from tree(words, np.concatenate([near, far]), [np.repeat(np.arange(2), [len(near), len(far)])])


def links_of(sets: list[np.ndarray], comps: np.ndarray, percent: int, sides: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links between different components and sides of a unit, as many as join what is linked: pairs already joined are passed over."""
    sizes = np.array([len(s) for s in sets], np.int64)
    label = labels_of(comps)
    if label.max() == 0:
        return
    now = label.copy()
    for i, j in candidate_pairs([bitmap(s) for s in sets], sizes, label, percent, labels_of(sides)):
        apart = now[i] != now[j]
        for x, y in zip(i[apart].tolist(), j[apart].tolist(), strict=True):
            if now[x] == now[y]:
                continue
            common = overlap(sets[x], sets[y])
            if 100 * common >= percent * (sizes[x] + sizes[y] - common):
                yield x, y
                now[now == now[y]] = now[x]


def chunked(members: DataFrame, spec: JoinSpec) -> DataFrame:
    """From (key, comp, n, sid): (chunk, key, comp, n, sid). Rows are sorted by range, so many tasks share a large family, and
    numbered on across tasks, so that chunks are full however many tasks there are; those without a link go by size, the others
    by component. A chunk is a part of one family."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, held = None, 0, 0
        for batch in batches:
            at, before = [], []
            for k, n in zip(batch.column("key").to_pylist(), batch.column("n").to_pylist(), strict=True):
                if k != key:
                    key, rows, held = k, 0, 0
                at.append(rows)
                before.append(held)
                rows, held = rows + 1, held + n
            part = pa.array(np.full(batch.num_rows, TaskContext.get().partitionId(), np.int64))
            yield _batch(part=part, at=pa.array(at, pa.int64()), held=pa.array(before, pa.int64()), **{c: batch.column(c) for c in ("key", "comp", "n", "sid")})

    order = ["key", "kin", "n", "sid"]
    ordered = members.withColumn("kin", F.when(F.col("comp") != F.col("sid"), F.col("comp"))).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(in_arrow(ordered.select("key", "comp", "n", "sid"), run, "part long, at long, held long, key long, comp long, n long, sid long"), "ordered")
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("key", "part").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    starts = sums.select("key", "part", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s"))
    numbered = joined(rows, starts, ["key", "part"], "inner", 32, dealt)
    chunk = F.xxhash64("key", F.floor((F.col("c") + F.col("at")) / spec.chunk_rows), F.floor((F.col("s") + F.col("held")) / spec.chunk_shingles))
    return stored(numbered.select(chunk.alias("chunk"), "key", "comp", "n", "sid"), "chunks")


def merged(part: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The parts (each named by its smallest index) once those of i[k] and j[k] are one, for each k."""
    while len(i):
        a, b = part[i], part[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        root = np.arange(len(part))
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, up := root[root]):
            root = up
        part = root[part]
    return part


def _bitmap_pass(units: DataFrame, percent: int) -> DataFrame:
    """From (unit, side, comp, n, sid, bits): the rows, without bits, that a tree leaves a partner for. Only these rows' sets
    travel. Each part of a unit that such pairs hold together is a unit of its own, its sides named by their least sid, so
    that documents that meet in many groups, each time among other strangers, are compared once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ("unit", "side", "comp", "n", "sid", "bits")):
            label = labels_of([r[2] for r in group])
            if label.max() == 0:
                continue
            alive, part = np.zeros(len(group), bool), np.arange(len(group))
            for i, j in candidate_pairs([np.frombuffer(r[5], np.uint64) for r in group], np.array([r[3] for r in group], np.int64), label, percent, labels_of([r[1] for r in group])):
                alive[i] = alive[j] = True
                part = merged(part, i, j)
            least: dict[tuple[int, int], int] = {}
            kept = [(int(part[i]), *group[i][:5]) for i in np.flatnonzero(alive)]
            for p, _, side, _, _, sid in kept:
                least[p, side] = min(sid, least.get((p, side), sid))
            rows = np.array([(unit, p, least[p, side], comp, n, sid) for p, unit, side, comp, n, sid in kept], np.int64).reshape(-1, 6)
            if len(rows):
                yield _batch(**{c: pa.array(rows[:, k]) for k, c in enumerate(("unit", "part", "side", "comp", "n", "sid"))})

    ordered = units.repartition("unit").sortWithinPartitions("unit", "comp", "n", "sid").select("unit", "side", "comp", "n", "sid", "bits")
    found = in_arrow(ordered, run, "unit long, part long, side long, comp long, n long, sid long")
    return stored(found.withColumn("unit", F.xxhash64("unit", "part")).drop("part"), "alive")


def _root_pass(rows: DataFrame) -> DataFrame:
    """From (chunk, key, comp, n, sid, bits): each chunk's root (key, chunk, comp or null, lo, hi, bits as wide as its narrowest
    row's, shared bits at each width up to that, the narrowest first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ("chunk", "key", "comp", "n", "bits")):
            marks, sizes = [np.frombuffer(r[4], np.uint64) for r in group], np.array([r[3] for r in group], np.int64)
            width, words, shared = min(len(m) for m in marks), BITS // 64, []
            while words <= width:
                bits = np.stack([folded(m, words) for m in marks])
                shared.append(int((sizes - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)).max()))
                words *= 2
            comps = {r[2] for r in group}
            yield _batch(
                key=pa.array([group[0][1]], pa.int64()), chunk=pa.array([group[0][0]], pa.int64()), comp=pa.array([comps.pop() if len(comps) == 1 else None], pa.int64()),
                lo=pa.array(sizes.min(keepdims=True)), hi=pa.array(sizes.max(keepdims=True)), bits=pa.array([np.bitwise_or.reduce(bits, axis=0).tobytes()], pa.binary()), shared=pa.array([shared], pa.list_(pa.int64())),
            )

    ordered = rows.repartition("chunk").sortWithinPartitions("chunk", "n", "sid").select("chunk", "key", "comp", "n", "bits")
    return in_arrow(ordered, run, "key long, chunk long, comp long, lo long, hi long, bits binary, shared array<long>")


def chunk_pairs(roots: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of a group's chunks that the tree over their roots leaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ("key", "chunk", "comp", "lo", "hi", "bits", "shared")):
            marks = [np.frombuffer(r[5], np.uint64) for r in group]
            words = min(len(m) for m in marks)
            at = (words * 64 // BITS).bit_length() - 1
            whole = {c: i for i, c in enumerate({r[2] for r in group} - {None})}
            label = np.array([whole.get(r[2], -1) for r in group], np.int64)
            lo, hi, shared = (np.array(x, np.int64) for x in ([r[3] for r in group], [r[4] for r in group], [r[6][at] for r in group]))
            chunk = np.array([r[1] for r in group], np.int64)
            for i, j in SignatureTree(np.stack([folded(m, words) for m in marks]), lo, hi, shared, [label]).pairs(percent):
                yield _batch(a=pa.array(chunk[i]), b=pa.array(chunk[j]))

    ordered = roots.repartition("key").sortWithinPartitions("key", "lo", "chunk")
    return stored(in_arrow(ordered, run, "a long, b long"), "chunkpairs")


def _tree_pass(units: DataFrame, percent: int) -> DataFrame:
    """From (unit, side, comp, n, sid, set): links (a, b) that join components of a unit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ("unit", "side", "comp", "sid", "set")):
            sids = [r[3] for r in group]
            found = [(sids[x], sids[y]) for x, y in links_of([np.frombuffer(r[4], np.uint64) for r in group], np.array([r[2] for r in group], np.int64), percent, np.array([r[1] for r in group], np.int64))]
            if found:
                x = np.array(found, np.int64)
                yield _batch(a=pa.array(x.min(axis=1)), b=pa.array(x.max(axis=1)))

    ordered = units.repartition("unit").sortWithinPartitions("unit", "comp", "n", "sid").select("unit", "side", "comp", "sid", "set")
    return stored(in_arrow(ordered, run, "a long, b long").distinct(), "more")


def _tree_links(rest: DataFrame, texts: DataFrame, spec: JoinSpec) -> DataFrame:
    """Links between components of the open families' members (key, comp, n, sid)."""
    cut = chunked(rest, spec)
    suspects = lambda rows: joined(texts.select("sid", "body"), rows.select("sid").distinct(), "sid", "left_semi", 16, dealt)
    marks = stored(_bitmaps(suspects(cut), spec), "marks")
    chunks = cut.groupBy("key", "chunk").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    mixed_chunks = chunks.where("lo <> hi").select(F.col("chunk").alias("unit"), "chunk")
    pairs = chunk_pairs(_root_pass(cut.join(marks, "sid")), spec.percent).withColumn("unit", F.xxhash64("a", "b"))
    sides = pairs.select("unit", F.col("a").alias("chunk")).unionByName(pairs.select("unit", F.col("b").alias("chunk")))
    within = cut.join(mixed_chunks, "chunk").select("unit", F.col("sid").alias("side"), "comp", "n", "sid")
    across = cut.join(sides, "chunk").select("unit", F.col("chunk").alias("side"), "comp", "n", "sid")
    alive = _bitmap_pass(within.unionByName(across).join(marks, "sid"), spec.percent)
    return _tree_pass(alive.join(_held_sets(suspects(alive), spec), "sid"), spec.percent)


# -- rounds


def _texts_of(found: DataFrame, spec: JoinSpec, clashed: np.ndarray) -> DataFrame:
    """(fam, sid, n, body, order0 and so on: minhashes) of rows whose text has the set of that name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "body", most=SLICE)):
            sids = batch.column("sid").to_numpy(zero_copy_only=False).view(np.uint64)
            good, least = np.zeros(len(sids), bool), np.zeros((ORDERS, len(sids)), np.int64)
            for row, sets in all_sets(batch.column("body"), spec.words):
                names = settled(*set_names(sets, spec.name_bits), clashed)
                for i in np.flatnonzero(names == sids[row : row + len(sets)]).tolist():
                    good[row + i] = len(sets[i]) > 0
                    for k in range(ORDERS if len(sets[i]) else 0):
                        least[k, row + i] = int(mixed(sets[i] ^ np.uint64(0x777 + k)).min() >> np.uint64(1))
            mask = pa.array(good)
            cols = {c: batch.column(c) for c in ("fam", "sid", "n", "body")} | {f"order{k}": pa.array(x) for k, x in enumerate(least)}
            yield _batch(**{c: x.filter(mask) for c, x in cols.items()})

    return kept(in_arrow(found.select("fam", "sid", "n", "body"), run, "fam long, sid long, n long, body string, " + ", ".join(f"order{k} long" for k in range(ORDERS))), "texts")


def _round(texts: DataFrame, spec: JoinSpec, order: int) -> DataFrame:
    """Chunks of families in an order. kind 0: links (a, b) of sets that met in a chunk; kind 1: (a: family, b: chunk)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, fam, sids, sets, size = (TaskContext.get().partitionId() << 32) - 1, None, [], [], 0

        def out() -> pa.RecordBatch:
            links = [(sids[x], sids[y]) for x, y in links_of(sets, np.arange(len(sets)), spec.percent, np.arange(len(sets)))]
            rows = np.array([(min(p), max(p)) for p in links] + [(fam, chunk)], np.int64)
            return _batch(kind=pa.array([0] * len(links) + [1], pa.int32()), a=pa.array(rows[:, 0]), b=pa.array(rows[:, 1]))

        for batch in (part for whole in batches for part in slices(whole, "body", most=SLICE)):
            families, names = batch.column("fam").to_pylist(), batch.column("sid").to_pylist()
            for row, made in all_sets(batch.column("body"), spec.words):
                for i, s in enumerate(made, row):
                    if sids and families[i] == fam and names[i] == sids[-1]:  # a row that is repeated
                        continue
                    if families[i] != fam or len(sids) >= spec.chunk_rows or size + len(s) > spec.chunk_shingles:
                        if sids:
                            yield out()
                        chunk, fam, sids, sets, size = chunk + 1, families[i], [], [], 0
                    sids.append(names[i])
                    sets.append(s)
                    size += len(s)
        if sids:
            yield out()

    by = ["fam", f"order{order}", "n", "sid"]
    ordered = texts.repartitionByRange(*by).sortWithinPartitions(*by).select("fam", "sid", "body")
    return kept(in_arrow(ordered, run, "kind int, a long, b long"), "round")


def _links(texts: DataFrame, spec: JoinSpec) -> DataFrame:
    """Links (a, b) that hold together what similar sets of the families hold together."""
    met = _round(texts, spec, 0)
    links = met.where("kind = 0").select("a", "b")
    large = met.where("kind = 1").groupBy("a").agg(F.countDistinct("b").alias("chunks")).where("chunks > 1").select(F.col("a").alias("fam"))
    large = dealt(large, "large")
    if large.isEmpty():
        return links
    members = stored(joined(texts.select("fam", "sid", "n").distinct(), large, "fam", "left_semi", 16, dealt), "members")

    def labelled() -> DataFrame:
        label = components(links).select(F.col("node").alias("sid"), "comp")
        return stored(members.join(small_side(label, 24), "sid", "left").select(F.col("fam").alias("key"), F.coalesce("comp", "sid").alias("comp"), "n", "sid"), "labelled")

    rows, before = labelled(), None
    for order in range(1, ORDERS):
        heads = rows.groupBy("key", "comp").agg(F.min("sid").alias("sid"))
        open_ = heads.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
        now = open_.agg(F.sum("c")).first()[0] or 0
        if not now or before and now > 0.7 * before:
            break
        chosen = heads.join(open_, "key", "left_semi").select("sid")
        links = links.unionByName(_round(joined(texts, chosen, "sid", "left_semi", 16, dealt), spec, order).where("kind = 0").select("a", "b"))
        rows, before = labelled(), now
    several = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    rest = stored(joined(rows, several, "key", "left_semi", 16, dealt), "open")
    return links if rest.isEmpty() else links.unionByName(_tree_links(rest, texts, spec))


# -- components


def _forest(edges: DataFrame, most: int, roots: bool = False) -> DataFrame:
    """From edges (u, v): for each block of at most so many (or of one batch), an edge (u, v) from each node to the least node that the block's edges join it
    with; with roots, also from that node to itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            x = np.concatenate(held, axis=1)
            nodes, at = np.unique(x, return_inverse=True)
            i, j = at.reshape(x.shape)
            least = nodes[merged(np.arange(len(nodes)), i, j)]
            keep = np.ones(len(nodes), bool) if roots else least != nodes
            yield _batch(u=pa.array(nodes[keep]), v=pa.array(least[keep]))

        for batch in batches:
            if held and size + batch.num_rows > most:
                yield from out()
                held, size = [], 0
            held.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("u", "v")]))
            size += batch.num_rows
        if size:
            yield from out()

    return in_arrow(edges, run, "u long, v long")


def components(edges: DataFrame, most: int = FOREST) -> DataFrame:
    """(node, comp): the smallest node reachable over edges (a, b), for all nodes of edges between different nodes. Blocks of edges
    become stars, without a shuffle; once no more edges are left than a block holds (`most`), they are one block, which one task
    turns into the result. While there are more, steps of large and small stars go before."""
    stars = kept(_forest(edges.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")), most), "stars")
    before = None
    while True:
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] <= most:
            return stored(_forest(stars.coalesce(1), most, roots=True).select(F.col("u").alias("node"), F.col("v").alias("comp")), "components")
        if now == before:
            break
        before = now
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(down.select("u", F.col("m").alias("v"))).distinct()
        stars = stored(_forest(small, most), "stars")
    return stored(stars.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()), "components")


# -- the join


def join(docs: DataFrame, spec: JoinSpec = JoinSpec(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, set_name) of each row of docs."""
    rows = docs.select(id_key(id_col).alias("key"), text_of(text_col).alias("body"))
    named = _name_pass(rows, spec)
    first = kept(named.where("kind = 0").select("key", F.col("a").alias("sid"), F.col("b").alias("second"), "n"), "named")
    twice = first.where("n > 0").groupBy("sid").agg(F.min("second").alias("x"), F.max("second").alias("y")).where("x <> y").select("sid")
    # sets that share a 64-bit name: of N sets some N * N / 2^65, none but in the largest tables
    clashed = np.array([r["sid"] for r in twice.collect()], np.int64).view(np.uint64)
    sets = _settled_rows(first, clashed) if len(clashed) else first
    classes = dealt(sets.where("n > 0").groupBy("sid").agg(F.min("key").alias("rep"), F.max("n").alias("n")), "classes")

    prefixes = _first_prefixes(named.where("kind = 1"), spec, clashed)
    drop(named)
    heads = prefixes.groupBy("key").agg(F.min("sid").alias("b"), F.max("sid").alias("top")).where("b <> top").select("key", "b")
    families = components(joined(prefixes.select("key", F.col("sid").alias("a")), heads, "key", "inner", 24, dealt).select("a", "b"))
    drop(prefixes)
    reps = kept(families.select(F.col("node").alias("sid"), F.col("comp").alias("fam")).join(classes, "sid").select("sid", "fam", F.col("rep").alias("key"), "n"), "suspects")
    texts = _texts_of(joined(rows, reps, "key", "inner", 40), spec, clashed)
    links = _links(texts, spec)

    name = classes.select("sid", "rep")
    edges = links.join(name.select(F.col("sid").alias("a"), F.col("rep").alias("u")), "a").join(name.select(F.col("sid").alias("b"), F.col("rep").alias("v")), "b").select(F.col("u").alias("a"), F.col("v").alias("b"))
    # a doc_id with several texts binds their classes
    binds = sets.where("n > 0").groupBy("key").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi")).where("lo <> hi").select("key")
    tied = sets.where("n > 0").join(binds, "key", "left_semi").join(name, "sid").select(F.col("key").alias("a"), F.col("rep").alias("b")).where("a <> b")
    labels = components(edges.unionByName(tied))
    out = sets.join(name, "sid", "left").join(labels.select(F.col("node").alias("rep"), "comp"), "rep", "left")
    if not binds.isEmpty():  # then also by the id itself
        out = out.join(labels.select(F.col("node").alias("key"), F.col("comp").alias("own")), "key", "left").withColumn("comp", F.least(F.coalesce("comp", "own"), F.coalesce("own", "comp")))
    label = F.coalesce("comp", "rep", "key")
    real = lambda c: F.when(c != NULL_ID, c)
    return out.select(real(F.col("key")).alias("doc_id"), F.col("n").alias("n_shingles"), real(label).alias("component_id"), F.col("sid").alias("set_name"))


def _settled_rows(sets: DataFrame, clashed: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("sid", "second"))
            yield _batch(key=batch.column("key"), sid=_long(settled(a, b, clashed)), second=batch.column("second"), n=batch.column("n"))

    return sets.mapInArrow(run, sets.schema)


def _bitmaps(texts: DataFrame, spec: JoinSpec) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids = batch.column("sid")
            for row, sets in all_sets(batch.column("body"), spec.words):
                yield _batch(sid=sids.slice(row, len(sets)), bits=pa.array([bitmap(s).tobytes() for s in sets], pa.binary()))

    return in_arrow(texts, run, "sid long, bits binary").dropDuplicates(["sid"])


def _held_sets(texts: DataFrame, spec: JoinSpec) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sids = batch.column("sid")
            for row, sets in all_sets(batch.column("body"), spec.words):
                yield _batch(sid=sids.slice(row, len(sets)), set=pa.array([s.tobytes() for s in sets], pa.binary()))

    return in_arrow(texts, run, "sid long, set binary").dropDuplicates(["sid"])


def keep_one(docs: DataFrame, spec: JoinSpec = JoinSpec(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each group of links: the one of smallest doc_id. Documents without words all stay."""
    key = fresh(docs, "key")
    marks = join(docs, spec, id_col, text_col)
    gone = stored(marks.where(F.col("n_shingles") > 0).where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(id_key().alias(key)).distinct(), "gone")
    return joined(docs.withColumn(key, id_key(id_col)), gone, key, "left_anti", 16).drop(key)
