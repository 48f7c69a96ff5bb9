"""Text quality by a generalised additive model with pairwise interactions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import arrow_batches, written
from tallyforge.llm.tokens import forget_encoders, slices, word_hashes

FEATURES = [
    "log_words", "word_length", "upper", "digits", "marks", "marked_words", "bars", "line_length", "distinct_words",
    "repeated_next", "repeated_shingles", "sentence_length", "other_bytes", "capital_words", "longest_run",
]

_CLASS = {name: np.zeros(256, bool) for name in ("upper", "lower", "digit", "mark", "stop", "blank", "bar", "line", "other", "odd")}
for _name, _chars in {
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": "abcdefghijklmnopqrstuvwxyz", "digit": "0123456789",
    "mark": "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", "stop": ".!?", "blank": " \t\n\r\v\f", "bar": "|", "line": "\n", "odd": "!#$%&*|",
}.items():
    _CLASS[_name][[ord(c) for c in _chars]] = True
_CLASS["other"][128:] = True


def features(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text of a slice; an empty text has zeros."""
    docs = len(bounds) - 1
    out = np.zeros((docs, len(FEATURES)), np.float32)
    size = np.diff(bounds)
    full = np.flatnonzero(size)
    if not len(full):
        return out

    def per_doc(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[bounds[1:]] - total[bounds[:-1]]).astype(np.float64)

    starts, ends, hashes = word_hashes(data, bounds)
    of = np.searchsorted(bounds, starts, "right") - 1
    words = np.bincount(of, minlength=docs).astype(np.float64)
    some, chars = np.maximum(words, 1), np.maximum(size, 1)
    next_same = np.zeros(len(starts), bool)
    next_same[1:] = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])

    def distinct(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Distinct values of each document, by 48 bits of hash below the document's number."""
        keys = np.unique((owner.astype(np.uint64) << np.uint64(44)) | (values >> np.uint64(20)))
        return np.bincount((keys >> np.uint64(44)).astype(np.int64), minlength=docs)

    trios = (hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(5) + hashes[2:] * np.uint64(7)) * np.uint64(0x9E3779B97F4A7C15)
    inside = of[:-2] == of[2:]
    owner = of[:-2][inside]
    shingles = np.maximum(np.bincount(owner, minlength=docs), 1)
    odd_end = _CLASS["odd"][data[ends - 1]] if len(ends) else np.zeros(0, bool)
    runs = np.zeros(docs)
    if len(starts):  # longest run of marked words
        same = np.cumsum(np.concatenate([[True], (odd_end[1:] != odd_end[:-1]) | (of[1:] != of[:-1])])) - 1
        first = np.flatnonzero(np.concatenate([[True], np.diff(same) > 0]))
        np.maximum.at(runs, of[first], np.bincount(same) * odd_end[first])
    out[:, 0] = np.log1p(words)
    out[:, 1] = np.bincount(of, ends - starts, minlength=docs) / some
    letters = np.maximum(per_doc(_CLASS["upper"][data] | _CLASS["lower"][data]), 1)
    out[:, 2] = per_doc(_CLASS["upper"][data]) / letters
    out[:, 3] = per_doc(_CLASS["digit"][data]) / chars
    out[:, 4] = per_doc(_CLASS["mark"][data]) / chars
    out[:, 5] = np.bincount(of, odd_end, minlength=docs) / some
    out[:, 6] = per_doc(_CLASS["bar"][data]) / some
    out[:, 7] = np.log1p(chars / (1 + per_doc(_CLASS["line"][data])))
    out[:, 8] = distinct(hashes, of) / some
    out[:, 9] = np.bincount(of, next_same, minlength=docs) / some
    out[:, 10] = 1 - distinct(trios[inside], owner) / shingles
    out[:, 11] = np.log1p(words / (1 + per_doc(_CLASS["stop"][data])))
    out[:, 12] = per_doc(_CLASS["other"][data]) / chars
    out[:, 13] = np.bincount(of, _CLASS["upper"][data[starts]], minlength=docs) / some
    out[:, 14] = np.log1p(runs)
    out[size == 0] = 0
    return out


@dataclass
class AdditiveModel:
    """Edges of the bins of each feature, a table for each, and a table for each pair of features."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)
    base: float = 0.0

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, rows[:, i], "right") for i, e in enumerate(self.edges)], 1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1: additions of looked-up values."""
        bins = self.bins(rows)
        total = np.full(len(rows), self.base)
        for i, table in enumerate(self.tables):
            total += table[bins[:, i]]
        for (i, j), grid in self.pairs.items():
            total += grid[bins[:, i], bins[:, j]]
        return 1 / (1 + np.exp(-total))


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """A shallow tree over ordered bins: best splits first; the step of each bin's leaf."""
    g, w = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(weight)])
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (w[b] - w[a] + 1)
    parts = [(0, len(gradient))]
    while len(parts) < leaves:
        best = (1e-9, None, 0)
        for a, b in parts:
            cuts = np.arange(a + 1, b)
            cuts = cuts[(w[cuts] - w[a] >= least) & (w[b] - w[cuts] >= least)]
            if len(cuts):
                gains = gain(a, cuts) + gain(cuts, b) - gain(a, b)
                if gains.max() > best[0]:
                    best = (gains.max(), (a, b), int(cuts[gains.argmax()]))
        if best[1] is None:
            break
        a, b = best[1]
        parts.remove((a, b))
        parts += [(a, best[2]), (best[2], b)]
    step = np.zeros(len(gradient))
    for a, b in parts:
        step[a:b] = (g[b] - g[a]) / (w[b] - w[a] + 1)
    return step


def _grid(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree of one cut in each of two features: its gain and the step of each cell."""
    g, w = gradient.cumsum(0).cumsum(1), weight.cumsum(0).cumsum(1)
    a, b = g[:-1, :-1], w[:-1, :-1]
    right, below = g[:-1, -1:], g[-1:, :-1]
    quads = [(a, b), (right - a, w[:-1, -1:] - b), (below - a, w[-1:, :-1] - b)]
    quads.append((g[-1, -1] - right - below + a, w[-1, -1] - w[:-1, -1:] - w[-1:, :-1] + b))
    gains = sum(x**2 / (y + 1) for x, y in quads)
    if not gains.size:
        return 0.0, np.zeros_like(gradient)
    i, j = np.unravel_index(gains.argmax(), gains.shape)
    step = np.zeros_like(gradient)
    for (x, y), rows, columns in zip(
        quads, (np.s_[: i + 1], np.s_[: i + 1], np.s_[i + 1 :], np.s_[i + 1 :]), (np.s_[: j + 1], np.s_[j + 1 :]) * 2, strict=True
    ):
        step[rows, columns] = x[i, j] / (y[i, j] + 1)
    return float(gains[i, j]), step


def train(
    rows: np.ndarray, labels: np.ndarray, bins: int = 48, rounds: int = 150, rate: float = 0.15, pairs: int = 6, leaves: int = 4
) -> AdditiveModel:
    """Boost one shallow tree per feature in turn, round after round; then the pairs that explain most of the rest."""
    if not len(rows) or labels.min() == labels.max():
        base = 0.0 if not len(rows) else (4.0 if labels[0] else -4.0)
        return AdditiveModel([np.zeros(0)] * len(FEATURES), [np.zeros(1)] * len(FEATURES), {}, base)
    edges = [np.unique(np.quantile(rows[:, i], np.linspace(0, 1, bins + 1)[1:-1])) for i in range(rows.shape[1])]
    share = labels.mean()
    model = AdditiveModel(edges, [np.zeros(len(e) + 1) for e in edges], {}, float(np.log(share / (1 - share))))
    at = model.bins(rows)
    total = np.full(len(rows), model.base)
    residual = lambda: ((p := 1 / (1 + np.exp(-total))), labels - p, p * (1 - p))[1:]
    least = max(1.0, 0.0005 * len(rows) * share * (1 - share))
    for _ in range(rounds):
        for i, table in enumerate(model.tables):
            g, w = residual()
            step = rate * _tree(
                np.bincount(at[:, i], g, len(table)), np.bincount(at[:, i], w, len(table)), leaves, least
            )
            table += step
            total += step[at[:, i]]
    shape = lambda i, j: (len(model.tables[i]), len(model.tables[j]))

    def cells(i: int, j: int) -> np.ndarray:
        return at[:, i] * shape(i, j)[1] + at[:, j]

    g, w = residual()
    found = []
    for i in range(len(edges)):
        for j in range(i + 1, len(edges)):
            many = int(np.prod(shape(i, j)))
            sums = [np.bincount(cells(i, j), x, many).reshape(shape(i, j)) for x in (g, w)]
            found.append((_grid(*sums)[0], i, j))
    for _, i, j in sorted(found, reverse=True)[:pairs]:
        model.pairs[i, j] = np.zeros(shape(i, j))
    for _ in range(rounds // 3):
        for (i, j), grid in model.pairs.items():
            g, w = residual()
            sums = [np.bincount(cells(i, j), x, grid.size).reshape(grid.shape) for x in (g, w)]
            step = rate * _grid(*sums)[1]
            grid += step
            total += step[at[:, i], at[:, j]]
    return model


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget_encoders()
    for batch in batches:
        for first, data, bounds in slices(batch.column(1)):
            rows = features(data, bounds)
            ids = batch.column(0).slice(first, len(rows))
            flat = pa.array(rows.ravel())
            cut = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES))
            carried = batch.slice(first, len(rows)).select(batch.schema.names[2:])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.ListArray.from_arrays(cut, flat), *carried.columns], ["id", "features", *carried.schema.names]
            )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))


def _scorer(model: AdditiveModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(_matrix(batch.column(1)))
            names = ["id", "score", *batch.schema.names[2:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), *batch.columns[2:]], names)

    return run


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    sample: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Score every whole text; high scores mean that label 1 is likely.

    Features of the text's form are measured once for each document and written.  The
    model is fitted in the driver on at most ``sample`` labelled documents for which
    ``learn``, a condition on the id, holds, taken in the order of a hash of the id.  Scoring adds looked-up values.

    Returns id, ``score`` and the columns ``carry``, whole numbers that key the rows.  A null or empty text has zero features and is scored like any
    other; without labels, or with one label only, all scores are equal.  Null labels and ids
    teach nothing; repeated rows are scored each.  No other column is read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *carry)
    carried = "".join(f", `{c}` long" for c in carry)
    with arrow_batches(docs.sparkSession, 1000):
        measured = written(rows.mapInArrow(_measure, f"id long, features array<float>{carried}"), "features")
    known = labels.filter(F.lit(True) if learn is None else learn).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("label")
    )
    chosen = (
        measured.join(known.dropna(), "id").orderBy(F.xxhash64("id"), "id", "label").limit(sample).select("features", "label").toArrow()
    )
    columns = [c.combine_chunks() for c in chosen.columns]
    model = train(_matrix(columns[0]).astype(np.float64), columns[1].to_numpy())
    return measured.mapInArrow(_scorer(model), f"id long, score double{carried}").withColumnRenamed("id", id_col)
