"""Exact dedup by an exchange of Golomb-coded fingerprints.

1. Every document gets a 64-bit fingerprint and a SHA-256 name; a map task packs them into blocks
   ("senders") of bounded size, which are kept as a slim table.
2. Each sender sorts its distinct fingerprints, cuts them by owner (ranges of the fingerprint space) and
   sends the owner the Golomb-Rice coded gaps.
3. An owner merges its messages and answers each with a bitmap: bit i is set if another sender also has
   the i-th fingerprint. Copies inside one sender are visible to the sender itself.
4. Only rows whose bit is set are suspects. Their texts are grouped by their bytes (with map-side
   combination, so a huge group of copies costs one row per task), which verifies the groups.

Nulls: a null text is the empty text; a null doc_id is smaller than every other. Of rows that share both
doc_id and text just one is kept. A long text is hashed like any other and moves only if it is a suspect. An empty
table gives an empty result. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipweave.llm.common import fresh, id_key, joined, partitions, stored, text_of, in_arrow

#: Documents of one sender at most.
BLOCK_ROWS = 1 << 16
#: Fingerprints an owner should get, on average, at large sizes.
OWNER_ROWS = 1 << 20

SLIM = "sender long, ord int, doc_id long, fp long, sha string"


def golomb_encode(sorted_values: np.ndarray, start: int) -> bytes:
    """Golomb-Rice code of ascending uint64 values at or above start: header, unary quotients, remainders."""
    n = len(sorted_values)
    if n == 0:
        return b""
    gaps = np.diff(sorted_values, prepend=np.uint64(start))
    mean = max(1.0, float(sorted_values[-1] - np.uint64(start)) / n)
    k = int(max(0, np.floor(np.log2(mean * 0.6931) + 1e-9))) if mean > 1.5 else 0
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotient + 1)
    unary = np.ones(int(ends[-1]), np.uint8)
    unary[ends - 1] = 0
    shifts = np.arange(k - 1, -1, -1, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8) if k else np.zeros((n, 0), np.uint8)
    head = np.array([n, k, len(unary)], "<i8").tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(rest.ravel()).tobytes()


def golomb_decode(message: bytes, start: int) -> np.ndarray:
    if not message:
        return np.zeros(0, np.uint64)
    n, k, bits = (int(x) for x in np.frombuffer(message, "<i8", 3))
    body = np.frombuffer(message, np.uint8, offset=24)
    cut = (bits + 7) // 8
    unary = np.unpackbits(body[:cut], count=bits)
    quotient = np.diff(np.flatnonzero(unary == 0), prepend=-1).astype(np.uint64) - np.uint64(1)
    gaps = quotient << np.uint64(k)
    if k:
        rest = np.unpackbits(body[cut:], count=n * k).reshape(n, k)
        for j in range(k):
            gaps |= rest[:, j].astype(np.uint64) << np.uint64(k - 1 - j)
    return np.cumsum(gaps, dtype=np.uint64) + np.uint64(start)


def owner_starts(owners: int) -> np.ndarray:
    """First fingerprint of each owner's range."""
    return np.array([(i << 64) // owners for i in range(owners)], np.uint64)


def _as_unsigned(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _pack(batches):
    """Cuts a task's rows into senders."""
    from pyspark import TaskContext

    task, block, held, rows = TaskContext.get().partitionId(), 0, [], 0

    def out():
        whole = pa.Table.from_batches(held)
        size = whole.num_rows
        sender = np.full(size, (task << 24) | block, np.int64)
        cols = [pa.array(sender), pa.array(np.arange(size, dtype=np.int32)), *(whole[c] for c in ("doc_id", "fp", "sha"))]
        return pa.Table.from_arrays(cols, names=["sender", "ord", "doc_id", "fp", "sha"]).to_batches()

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            yield from out()
            block, held, rows = block + 1, [], 0
    if rows:
        yield from out()


def slim_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("fp"), F.sha2(text, 256).alias("sha"))
    return stored(in_arrow(rows, _pack, SLIM), "slim")


def suspects(slim: DataFrame, owners: int) -> DataFrame:
    """Rows of the slim table whose fingerprint occurs more than once anywhere."""

    def send(block: pa.Table) -> pa.Table:
        mine, start = np.unique(_as_unsigned(block["fp"])), owner_starts(owners)
        cut = np.append(np.searchsorted(mine, start), len(mine))
        full = np.flatnonzero(np.diff(cut))
        messages = [golomb_encode(mine[cut[o] : cut[o + 1]], int(start[o])) for o in full]
        return pa.table({"owner": pa.array(full, pa.int32()), "sender": pa.array([block["sender"][0].as_py()] * len(full), pa.int64()), "message": pa.array(messages, pa.binary())})

    def answer(messages: pa.Table) -> pa.Table:
        owner = messages["owner"][0].as_py()
        start = int(owner_starts(owners)[owner])
        lists = [golomb_decode(m, start) for m in messages["message"].to_pylist()]
        values, counts = np.unique(np.concatenate(lists), return_counts=True)
        twice = values[counts > 1]
        bits = [np.packbits(np.isin(x, twice)).tobytes() for x in lists]
        return pa.table({"owner": messages["owner"], "sender": messages["sender"], "bits": pa.array(bits, pa.binary())})

    def receive(block: pa.Table, answers: pa.Table) -> pa.Table:
        fp = _as_unsigned(block["fp"])
        mine, inverse, counts = np.unique(fp, return_inverse=True, return_counts=True)
        flagged, start = counts > 1, owner_starts(owners)
        cut = np.append(np.searchsorted(mine, start), len(mine))
        for owner, bits in zip(answers["owner"].to_pylist(), answers["bits"].to_pylist(), strict=True):
            a, b = cut[owner], cut[owner + 1]
            flagged[a:b] |= np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
        return block.filter(pa.array(flagged[inverse]))

    messages = slim.select("sender", "fp").groupBy("sender").applyInArrow(send, "owner int, sender long, message binary")
    answers = messages.groupBy("owner").applyInArrow(answer, "owner int, sender long, bits binary")
    return slim.groupBy("sender").cogroup(answers.groupBy("sender")).applyInArrow(receive, SLIM)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: sender, ord (naming the row), doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    slim = slim_table(docs, id_col, text_col)
    owners = max(partitions(spark), slim.count() // OWNER_ROWS)
    found = stored(suspects(slim, owners), "suspects")
    names = found.select("fp").distinct()
    text = text_of(text_col)
    texts = joined(docs.select(F.xxhash64(text).alias("fp"), text.alias("body")), names, "fp", "left_semi", 16)
    verified = (
        texts.groupBy("fp", "body").agg(F.count("*").alias("n"))
        .groupBy("fp", F.sha2("body", 256).alias("sha"))
        .agg(F.count("*").alias("texts"), F.sum("n").alias("group_size"))
        .select("fp", "sha", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts share fingerprint and SHA-256")).cast("long")).alias("group_size"))
    )
    keepers = found.groupBy("fp", "sha").agg(F.max(F.struct(id_key().alias("key"), "sender", "ord")).alias("keep"), F.max("doc_id").alias("keep_id"))
    groups = stored(keepers.join(verified, ["fp", "sha"]), "groups")
    alone = F.col("group_size").isNull()
    return joined(slim, groups, ["fp", "sha"], "left", 160).select(
        "sender", "ord", "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | ((F.col("keep.sender") == F.col("sender")) & (F.col("keep.ord") == F.col("ord")))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that dedup() drops, columns as they were. Of rows that share id and text but differ in other columns,
    the one that comes first as JSON stays."""
    names = [F.col(f"`{c}`") for c in docs.columns]
    key, sha = fresh(docs, "key"), fresh(docs, "sha")
    marks = stored(dedup(docs, id_col, text_col), "marks").select("kept", id_key().alias(key), F.col("text_sha256").alias(sha))
    gone, stay = marks.where(~F.col("kept")).select(key, sha), marks.where("kept").select(key, sha)
    repeated = stored(gone.join(stay, [key, sha], "left_semi").distinct(), "repeated")
    tagged = docs.withColumns({key: id_key(id_col), sha: F.sha2(text_of(text_col), 256)})
    once = joined(tagged, gone.distinct(), [key, sha], "left_anti", 120).select(*names)
    if repeated.isEmpty():
        return once
    again = joined(tagged, repeated, [key, sha], "left_semi", 120)
    first = again.groupBy(key, sha).agg(F.min_by(F.struct(*names), F.to_json(F.struct(*names))).alias("row"))
    return once.unionByName(first.select("row.*"))
