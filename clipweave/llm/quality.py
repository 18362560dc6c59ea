"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts are computed on the executors. The trees are grown on the driver from a bounded
sample of labelled rows, with at most 64 bins a statistic, and flattened into arrays of equal depth, which
numpy walks for a whole batch at once.

Nulls: a null text is the empty text; rows of null label are not learned from. Without labelled rows every
score is the prior 0.5. A long text takes memory of some times its size, one at a time. Repeated rows get equal scores,
repeated labels count each; of equal splits the first statistic's wins. An empty table gives an empty result. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipweave.llm.common import extended, text_of, in_arrow

STATS = (
    "log_bytes", "log_words", "word_bytes", "upper", "lower", "digit", "blank", "comma_dot", "marks", "symbols", "above_127",
    "control", "line_bytes", "distinct_words", "top_word", "distinct_lines", "longest_word", "same_neighbours", "byte_entropy", "capitals_a_word",
    "pipes", "stars", "short_lines", "no_end",
)
_SETS = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "blank": (9, 10, 11, 12, 13, 32), "comma_dot": (44, 46),
    "marks": (33, 63), "symbols": tuple(b"#$%&*+/<=>@[\\]^_`{|}~"), "above_127": range(128, 256), "control": (*range(9), *range(14, 32), 127), "pipes": (124,), "stars": (42, 35, 36, 37, 38),
}
_CLASS = np.array([[b in _SETS[k] for k in _SETS] for b in range(256)], np.float64)


@dataclass(frozen=True)
class BoostSpec:
    """sample: most labelled rows that are learned from, chosen by a hash."""

    sample: int = 20_000
    trees: int = 60
    depth: int = 4
    bins: int = 64
    rate: float = 0.15
    least: int = 8
    ridge: float = 1.0


def statistics(text: str) -> list[float]:
    data = text.encode("utf-8", "replace")
    hist = np.bincount(np.frombuffer(data, np.uint8), minlength=256).astype(np.float64)
    n = max(1, len(data))
    share = dict(zip(_SETS, hist @ _CLASS / n, strict=True))
    words, lines = text.split(), text.split("\n")
    w = max(1, len(words))
    tally: dict[str, int] = {}
    for x in words:
        tally[x] = tally.get(x, 0) + 1
    p = hist[hist > 0] / n
    same = sum(map(str.__eq__, words, words[1:])) / w
    return [
        np.log1p(len(data)), np.log1p(len(words)), n / w, share["upper"], share["lower"], share["digit"], share["blank"], share["comma_dot"], share["marks"], share["symbols"], share["above_127"],
        share["control"], n / len(lines), len(tally) / w, max(tally.values(), default=0) / w, len(set(lines)) / len(lines), max(map(len, tally), default=0), same, float(-(p * np.log2(p)).sum()), share["upper"] * n / w,
        share["pipes"], share["stars"], sum(len(x) < 30 for x in lines) / len(lines), sum(x[-1:] not in ".!?" for x in lines) / len(lines),
    ]


def with_statistics(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns plus `stats`, an array of STATS."""
    rows = docs.select(*(F.col(k) for k in keep), text_of(text_col).alias("_body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = pa.array([statistics(t.as_py()) for t in batch.column(len(keep))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], stats], names=[*keep, "stats"])

    return in_arrow(rows, run, extended(rows.drop("_body").schema, stats="array<double>"))


@dataclass
class Forest:
    """Trees flattened level by level: node i's children are 2i+1 and 2i+2; leaves are the last level."""

    start: float
    column: np.ndarray  # (trees, inner nodes)
    limit: np.ndarray
    value: np.ndarray  # (trees, leaves)
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows, out = np.arange(len(x)), np.full(len(x), self.start)
        for column, limit, value in zip(self.column, self.limit, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, column[node]] > limit[node])
            out += value[node - len(column)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def boost(x: np.ndarray, y: np.ndarray, spec: BoostSpec) -> Forest:
    """Newton boosting of the log loss on binned columns; all trees have equal depth, a node that can't be split sends all left."""
    n, columns = x.shape
    edges = [np.unique(np.quantile(x[:, c], np.linspace(0, 1, spec.bins + 1)[1:-1])) for c in range(columns)]
    binned = np.stack([np.searchsorted(edges[c], x[:, c], side="left") for c in range(columns)], axis=1)
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    start = float(np.log(mean / (1 - mean)))
    margin, inner = np.full(n, start), 2**spec.depth - 1
    trees: tuple[list, list, list] = ([], [], [])
    for _ in range(spec.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        column, limit, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(spec.depth):
            low, width = 2**level - 1, 2**level
            at = node - low
            best = np.full(width, 1e-6)
            for c in range(columns):
                size = len(edges[c]) + 1
                key = at * size + binned[:, c]
                hist = [np.bincount(key, v, minlength=width * size).reshape(width, size).cumsum(axis=1) for v in (g, h, np.ones(n))]
                (gl, hl, nl), (gt, ht, nt) = hist, (q[:, -1:] for q in hist)
                gain = gl**2 / (hl + spec.ridge) + (gt - gl) ** 2 / (ht - hl + spec.ridge) - gt**2 / (ht + spec.ridge)
                gain[(nl < spec.least) | (nt - nl < spec.least)] = -1
                cut = gain[:, :-1].argmax(axis=1) if size > 1 else np.zeros(width, np.int64)
                found = gain[np.arange(width), cut] if size > 1 else np.full(width, -1.0)
                better = found > best
                best[better] = found[better]
                column[low : low + width][better] = c
                limit[low : low + width][better] = edges[c][cut[better]] if size > 1 else np.inf
            node = 2 * node + 1 + (x[np.arange(n), column[node]] > limit[node])
        leaf = node - inner
        gs, hs = (np.bincount(leaf, v, minlength=inner + 1) for v in (g, h))
        value = spec.rate * gs / (hs + spec.ridge)
        margin += value[leaf]
        for held, new in zip(trees, (column, limit, value), strict=True):
            held.append(new)
    return Forest(start, *(np.array(t) for t in trees), depth=spec.depth)


def fit(docs: DataFrame, labels: DataFrame, spec: BoostSpec = BoostSpec(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Forest | None:
    """Learns from the labelled documents among docs, at most spec.sample of them."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("y")).where("id is not null and y is not null")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # the ids are cut to the bound before any text moves; the bound also bounds the broadcast
    chosen = known.join(texts.select("id"), "id", "left_semi").orderBy(F.xxhash64("id"), "id", "y").limit(spec.sample)
    found = with_statistics(texts.join(F.broadcast(chosen), "id"), "text", keep=("id", "y")).collect()
    if not found:
        return None
    found.sort(key=lambda r: (r["id"], r["y"], r["stats"]))
    return boost(np.array([r["stats"] for r in found]), np.array([r["y"] for r in found]), spec)


def predict(docs: DataFrame, forest: Forest | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score): how likely label 1 is."""
    stats = with_statistics(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column("stats").flatten()).reshape(batch.num_rows, len(STATS))
            score = forest.score(x) if forest else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"])

    return in_arrow(stats, run, "doc_id long, score double")
