"""Language identification by a byte convolutional network, trained in numpy.

Windows of 256 bytes go through one-hot convolutions of widths 2, 3 and 4, max pooling over the window and
a softmax over the learned languages. A document's scores are its windows' probabilities weighted by their
bytes; every byte of the text is in a window. At prediction, the filters of two neighbouring bytes are one
table lookup, and windows run in batches.

Nulls: a text that is null or has no letter is `und` with score 0, and so is every text if nothing could be
learned (no labelled rows). Rows of null text or language are not learned from. A long text is cut into windows like
any other, one text at a time. Repeated rows get equal results, and of languages of equal probability the first by name
wins. An empty table gives an empty result. Other columns are ignored, and pass through predict().
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipweave.llm.common import extended, fresh, in_arrow, without

UNKNOWN = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: Windows that run at once.
BATCH = 96


@dataclass(frozen=True)
class TrainSpec:
    """The training sample's bound: about docs_per_lang documents of each language, windows_per_doc of each. All languages found are learned."""

    docs_per_lang: int = 500
    windows_per_doc: int = 3
    epochs: int = 6
    rate: float = 0.01
    seed: int = 7


@dataclass
class ByteNet:
    langs: list[str]
    filters: dict[int, np.ndarray]  # width -> (width, 256, FILTERS)
    bias: np.ndarray  # all filters
    dense: np.ndarray
    offset: np.ndarray

    def compiled(self) -> Compiled:
        return Compiled(self)


class Compiled:
    """The network with the filters of byte pairs as one table."""

    def __init__(self, net: ByteNet):
        f2, f3, f4 = (net.filters[w] for w in WIDTHS)
        pair = lambda f, i: (f[i][:, None, :] + f[i + 1][None, :, :]).reshape(65536, FILTERS)
        self.net = net
        self.first = np.ascontiguousarray(np.concatenate([pair(f2, 0), pair(f3, 0), pair(f4, 0)], axis=1), np.float32)
        self.third = np.ascontiguousarray(f3[2], np.float32)
        self.second = np.ascontiguousarray(pair(f4, 2), np.float32)

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        """(n, WINDOW) bytes -> (n, filters) maxima over the window."""
        b = windows.astype(np.int32)
        pairs = (b[:, :-1] << 8) | b[:, 1:]
        at = WINDOW - WIDTHS[-1] + 1
        x = np.take(self.first, pairs[:, :at], axis=0)
        x[:, :, FILTERS : 2 * FILTERS] += np.take(self.third, b[:, 2 : at + 2], axis=0)
        x[:, :, 2 * FILTERS :] += np.take(self.second, pairs[:, 2 : at + 2], axis=0)
        return x.max(axis=1)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        out = np.empty((len(windows), len(self.net.langs)))
        for i in range(0, len(windows), BATCH):
            hidden = np.maximum(self.pooled(windows[i : i + BATCH]) + self.net.bias, 0)
            out[i : i + BATCH] = softmax(hidden @ self.net.dense + self.net.offset)
        return out


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def cut_windows(data: bytes) -> np.ndarray:
    n = max(1, -(-len(data) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(n, WINDOW)


def train(windows: np.ndarray, labels: list[str], spec: TrainSpec) -> ByteNet:
    """Adam on cross entropy; the gradient of a maximum goes to the bytes where it was reached."""
    langs = sorted(set(labels))
    y = np.array([langs.index(x) for x in labels])
    rng = np.random.Generator(np.random.PCG64(spec.seed))
    shapes = [(w, 256, FILTERS) for w in WIDTHS] + [(FILTERS * len(WIDTHS),), (FILTERS * len(WIDTHS), len(langs)), (len(langs),)]
    params = [rng.normal(0, 0.3 if len(s) == 3 else 0.2, s) if len(s) > 1 else np.zeros(s) for s in shapes]
    first, second, steps = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
    at = WINDOW - WIDTHS[-1] + 1
    share = np.bincount(y, minlength=len(langs))
    weight = len(y) / (len(langs) * share)
    for _ in range(spec.epochs):
        order = rng.permutation(len(y))
        for i in range(0, len(y), 64):
            rows = order[i : i + 64]
            x, t = windows[rows], y[rows]
            peaks, where = [], []
            for k, w in enumerate(WIDTHS):
                z = sum(params[k][j][x[:, j : j + at]] for j in range(w))
                p = z.argmax(axis=1)
                where.append(p)
                peaks.append(np.take_along_axis(z, p[:, None, :], axis=1)[:, 0])
            raw = np.concatenate(peaks, axis=1) + params[3]
            hidden = np.maximum(raw, 0)
            d = softmax(hidden @ params[4] + params[5])
            d[np.arange(len(t)), t] -= 1
            d *= weight[t][:, None] / len(t)
            back = (d @ params[4].T) * (raw > 0)
            grads = [np.zeros(s) for s in shapes]
            grads[4], grads[5], grads[3] = hidden.T @ d, d.sum(axis=0), back.sum(axis=0)
            for k, w in enumerate(WIDTHS):
                g = back[:, k * FILTERS : (k + 1) * FILTERS]
                for j in range(w):
                    np.add.at(grads[k][j], (np.take_along_axis(x, where[k] + j, axis=1), np.arange(FILTERS)[None, :]), g)
            steps += 1
            for q in range(6):
                first[q] += 0.1 * (grads[q] - first[q])
                second[q] += 0.001 * (grads[q] ** 2 - second[q])
                params[q] -= spec.rate * (first[q] / (1 - 0.9**steps)) / (np.sqrt(second[q] / (1 - 0.999**steps)) + 1e-8)
    return ByteNet(langs, dict(zip(WIDTHS, params[:3], strict=True)), params[3], params[4], params[5])


def sample(docs: DataFrame, spec: TrainSpec, id_col: str, text_col: str, lang_col: str) -> tuple[np.ndarray, list[str]]:
    """A bounded, repeatable sample of labelled windows, about as many documents of each language."""
    named = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = named.groupBy(lang_col).count().collect()
    if not counts:
        return np.zeros((0, WINDOW), np.uint8), []
    draw = F.pmod(F.xxhash64(F.lit(spec.seed), F.col(id_col), F.col(text_col)), F.lit(1 << 30)) / float(1 << 30)
    chances = F.create_map(*(F.lit(x) for lang, n in counts for x in (lang, min(1.0, spec.docs_per_lang / n))))
    chance = F.try_element_at(chances, F.col(lang_col))
    each = spec.windows_per_doc

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, labels, keys = [], [], []
            for key, text, lang in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                whole = cut_windows(text.encode("utf-8", "replace"))
                for i in range(min(each, len(whole))):
                    w = whole[(i * len(whole)) // each if len(whole) > each else i].copy()
                    if (key + i) % 3 == 0:  # short texts must be known too
                        w[16 + (key >> 8) % (WINDOW - 16) :] = 0
                    out.append(w.tobytes())
                    labels.append(lang)
                    keys.append(key + i)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(labels, pa.string()), pa.array(out, pa.binary())], names=["key", "lang", "bytes"])

    key = F.xxhash64(F.col(id_col), F.col(text_col)).bitwiseAND(F.lit((1 << 40) - 1))
    chosen = named.where(draw < chance).select(key.alias("key"), F.col(text_col).cast("string"), F.col(lang_col).cast("string"))
    rows = in_arrow(chosen, windows, "key long, lang string, bytes binary").orderBy("key", "lang", "bytes").limit(spec.docs_per_lang * max(64, 2 * len(counts)) * each).collect()
    return np.array([np.frombuffer(r["bytes"], np.uint8) for r in rows]).reshape(-1, WINDOW), [r["lang"] for r in rows]


def fit(docs: DataFrame, spec: TrainSpec = TrainSpec(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteNet | None:
    windows, labels = sample(docs, spec, id_col, text_col, lang_col)
    return train(windows, labels, spec) if labels else None


def predict(docs: DataFrame, net: ByteNet | None, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """docs plus the language and its score, in place of columns of these names. The network sees nothing but the text."""
    docs = without(docs, lang_out, score_out)
    names = docs.columns
    tagged = docs.withColumn(fresh(docs, "letter"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    schema = extended(docs.schema, **{lang_out: "string", score_out: "double"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = net.compiled() if net else None
        for batch in batches:
            langs, scores, held = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows, []
            if model:
                texts, letters = batch.column(names.index(text_col)), batch.column(len(names))
                size = 0
                for i in range(batch.num_rows):
                    if letters[i].as_py():
                        held.append((i, texts[i].as_py().encode("utf-8", "replace")))
                        size += len(held[-1][1])
                    if held and (size >= 1 << 20 or i + 1 == batch.num_rows):
                        _score(model, held, langs, scores)
                        held, size = [], 0
                if held:
                    _score(model, held, langs, scores)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*names, lang_out, score_out])

    return in_arrow(tagged, run, schema)


def _score(model: Compiled, held: list[tuple[int, bytes]], langs: list[str], scores: list[float]) -> None:
    parts = [cut_windows(data) for _, data in held]
    counts = np.array([len(p) for p in parts])
    starts = np.cumsum(counts) - counts
    p = model.probabilities(np.concatenate(parts))
    size = np.full(len(p), float(WINDOW))
    size[starts + counts - 1] = [max(1, len(d) - (c - 1) * WINDOW) for (_, d), c in zip(held, counts, strict=True)]
    mean = np.add.reduceat(p * size[:, None], starts, axis=0) / np.add.reduceat(size, starts)[:, None]
    for (i, _), row in zip(held, mean, strict=True):
        best = int(row.argmax())
        langs[i], scores[i] = model.net.langs[best], float(min(1.0, row[best]))
