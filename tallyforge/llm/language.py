"""Language of a text by a byte convolutional network over fixed-length windows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import written
from tallyforge.llm.tokens import lower_ascii, slices

WINDOW = 128
WIDTHS = (2, 3, 4, 5)
_REACH = max(WIDTHS)

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def windows(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of the texts in rows of WINDOW bytes, zero-padded; the text of each row, and its bytes of letters."""
    size = np.diff(bounds)
    many = -(-size // WINDOW)
    doc = np.repeat(np.arange(len(size)), many)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    start = bounds[doc] + nth * WINDOW
    stop = np.minimum(start + WINDOW, bounds[doc + 1])
    at = start[:, None] + np.arange(WINDOW)
    lowered = lower_ascii(data)
    rows = np.where(at < stop[:, None], lowered[np.minimum(at, max(0, len(data) - 1))] if len(data) else 0, 0).astype(np.uint8)
    return rows, doc, ((rows >= 97) & (rows <= 122) | (rows >= 128)).sum(1)


def has_letter(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether each text has a letter; other than ASCII letters are looked for only where there are none."""
    total = np.concatenate([[0], np.cumsum(_LETTER[data])])
    found = total[bounds[1:]] > total[bounds[:-1]]
    high = np.concatenate([[0], np.cumsum(data >= 128)])
    for i in np.flatnonzero(~found & (high[bounds[1:]] > high[bounds[:-1]])):
        found[i] = any(c.isalpha() for c in data[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


@dataclass
class ByteNet:
    """Byte vectors, filters of several widths in one matrix over the widest reach, max pooling, softmax."""

    names: list[str]
    vectors: np.ndarray  # 256 x size
    filters: np.ndarray  # (reach x size) x filters
    offset: np.ndarray
    weights: np.ndarray  # filters x languages
    bias: np.ndarray

    def patches(self, rows: np.ndarray) -> np.ndarray:
        padded = np.concatenate([rows, np.zeros((len(rows), _REACH - 1), np.uint8)], 1)
        near = np.lib.stride_tricks.sliding_window_view(self.vectors[padded], _REACH, 1)  # row, place, size, reach
        return np.ascontiguousarray(near.transpose(0, 1, 3, 2)).reshape(len(rows) * rows.shape[1], -1)

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        return (self.patches(rows) @ self.filters).reshape(len(rows), rows.shape[1], -1).max(1)

    def log_probabilities(self, rows: np.ndarray, batch: int = 256) -> np.ndarray:
        out = np.empty((len(rows), len(self.names)), np.float32)
        for at in range(0, len(rows), batch):
            hidden = np.maximum(self.pooled(rows[at : at + batch]) + self.offset, 0)
            z = hidden @ self.weights + self.bias
            z -= z.max(1, keepdims=True)
            out[at : at + batch] = z - np.log(np.exp(z).sum(1, keepdims=True))
        return out

    def predict(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the language of each text (-1: no letter) and its probability.

        The windows' log probabilities are averaged by their letters.
        """
        docs = len(bounds) - 1
        if not self.names:
            return np.full(docs, -1), np.zeros(docs)
        rows, doc, letters = windows(data, bounds)
        use = letters > 0
        rows, doc, letters = rows[use], doc[use], letters[use]
        total = np.zeros((docs, len(self.names)))
        logs = self.log_probabilities(rows) * letters[:, None]
        for k in range(len(self.names)):
            total[:, k] = np.bincount(doc, logs[:, k], minlength=docs)
        total /= np.maximum(1, np.bincount(doc, letters, minlength=docs))[:, None]
        total = np.exp(total - total.max(1, keepdims=True, initial=-1e9))
        total /= np.maximum(total.sum(1, keepdims=True), 1e-9)
        known = has_letter(data, bounds)
        best = total.argmax(1)
        return np.where(known, best, -1), np.where(known, total[np.arange(docs), best], 0.0)


def train(
    rows: np.ndarray, labels: np.ndarray, names: list[str], size: int = 8, filters: int = 12, steps: int = 700, batch: int = 96, seed: int = 7
) -> ByteNet:
    """Fit by Adam on windows; languages are drawn equally often."""
    rng = np.random.default_rng(seed)
    wide = filters * len(WIDTHS)
    mask = np.zeros((_REACH, size, wide), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[:width, :, i * filters : (i + 1) * filters] = 1
    mask = mask.reshape(_REACH * size, wide)
    net = ByteNet(
        names,
        rng.normal(0, 0.5, (256, size)).astype(np.float32),
        (rng.normal(0, 0.4, mask.shape) * mask).astype(np.float32),
        np.zeros(wide, np.float32),
        rng.normal(0, 0.2, (wide, len(names))).astype(np.float32),
        np.zeros(len(names), np.float32),
    )
    if len(names) < 2:
        return net
    parts = ["vectors", "filters", "offset", "weights", "bias"]
    first, second = ({p: np.zeros_like(getattr(net, p)) for p in parts} for _ in range(2))
    of = [np.flatnonzero(labels == k) for k in range(len(names))]
    for step in range(1, steps + 1):
        pick = np.array([rng.choice(of[k]) for k in rng.integers(0, len(names), batch)])
        x, y = rows[pick], labels[pick]
        near = net.patches(x)
        response = (near @ net.filters).reshape(batch, WINDOW, wide)
        place = response.argmax(1)
        top = np.take_along_axis(response, place[:, None], 1)[:, 0] + net.offset
        hidden = np.maximum(top, 0)
        z = hidden @ net.weights + net.bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(batch), y] -= 1
        p /= batch
        back = (p @ net.weights.T) * (top > 0)
        # only the place of each maximum passes the gradient on
        spot = (np.arange(batch)[:, None] * WINDOW + place).ravel()
        patch = near[spot].reshape(batch, wide, -1)
        g_filters = np.einsum("bfd,bf->df", patch, back) * mask
        g_patch = (back[:, :, None] * net.filters.T[None]).reshape(batch * wide, _REACH, size)
        padded = np.concatenate([x, np.zeros((batch, _REACH - 1), np.uint8)], 1)
        letters = padded[np.repeat(np.arange(batch), wide)[:, None], place.ravel()[:, None] + np.arange(_REACH)]
        g_vectors = np.zeros_like(net.vectors)
        np.add.at(g_vectors, letters, g_patch)
        grads = dict(zip(parts, (g_vectors, g_filters, back.sum(0), hidden.T @ p, p.sum(0)), strict=True))
        rate = 0.01 * min(1.0, 2 * (1 - step / (steps + 1)))
        for name, g in grads.items():
            first[name] += 0.1 * (g - first[name])
            second[name] += 0.001 * (g * g - second[name])
            unit = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
            setattr(net, name, (getattr(net, name) - rate * unit).astype(np.float32))
    return net


def _sampler(most: int):
    """Up to ``most`` windows of each document, spread evenly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in slices(batch.column(1)):
                rows, doc, letters = windows(data, bounds)
                rows, doc = rows[letters > WINDOW // 8], doc[letters > WINDOW // 8]
                total = np.bincount(doc, minlength=len(bounds) - 1)
                nth = np.arange(len(doc)) - (np.cumsum(total) - total)[doc]
                pick = np.flatnonzero((nth * most // np.maximum(total[doc], 1)) != ((nth - 1) * most // np.maximum(total[doc], 1)))
                lang = batch.column(0).take(pa.array(first + doc[pick], pa.int64()))
                yield pa.RecordBatch.from_arrays([lang, pa.array([r.tobytes() for r in rows[pick]], pa.binary())], ["lang", "bytes"])

    return run


def _predictor(net: ByteNet):
    names = [*net.names, "und"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, bounds in slices(batch.column(1), 1 << 20):
                best, score = net.predict(data, bounds)
                ids = batch.column(0).slice(first, len(best))
                yield pa.RecordBatch.from_arrays([ids, pa.array([names[k] for k in best]), pa.array(score)], ["id", "lang_pred", "score"])

    return run


def identify_language(
    docs: DataFrame,
    learn: Column | None = None,
    per_language: int = 600,
    per_document: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Predict the language of every whole text.

    The network is fitted in the driver on at most ``per_language`` documents of each
    language, the first by a hash of the id among those with a language and for which ``learn``, a
    condition on the id, holds, and ``per_document`` windows of each.  All bytes of a text are then read in
    windows of 128.

    Returns id, ``lang_pred``, ``score``.  A null text, or one without a letter, is ``und`` with
    score 0; so is every text if there is nothing to learn from.  Repeated rows are
    predicted each; no other column is read, and the language only to learn.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang")
    )
    usable = docs.filter(F.lit(True) if learn is None else learn).select(F.col(id_col).cast("long").alias("id"), F.col(lang_col).alias("lang"))
    usable = usable.filter("id IS NOT NULL AND lang IS NOT NULL")
    order = F.xxhash64("id")
    # a language's share of hash values that holds a few more than enough, so that ranks are taken of a bounded number of rows
    shares = [(r["lang"], min(1.0, 2 * per_language / r["count"])) for r in usable.groupBy("lang").count().collect()]
    spark = docs.sparkSession
    known = spark.createDataFrame(shares, "lang string, share double")
    close = F.pmod(order, F.lit(1 << 30)) < F.col("share") * (1 << 30)
    few = usable.join(F.broadcast(known), "lang").filter(close).select("id", "lang")
    ranked = few.selectExpr("*", "row_number() OVER (PARTITION BY lang ORDER BY xxhash64(id), id) AS nth")
    chosen = written(ranked.filter(F.col("nth") <= per_language).select(F.col("id").alias("of")), "sample")
    sampled = rows.filter("lang IS NOT NULL").join(F.broadcast(chosen.distinct()), F.col("id") == F.col("of"))
    found = sampled.select("lang", "text").mapInArrow(_sampler(per_document), "lang string, bytes binary").toArrow()
    languages = found.column(0).to_pylist()
    names = sorted(set(languages))
    number = {n: i for i, n in enumerate(names)}
    raw = b"".join(found.column(1).to_pylist())
    data = np.frombuffer(raw, np.uint8).reshape(-1, WINDOW)
    by_content = np.lexsort(data[:, ::8].T) if len(data) else np.zeros(0, np.int64)  # the same order on every run
    net = train(data[by_content], np.array([number[n] for n in languages], np.int64)[by_content], names)
    predicted = rows.select("id", "text").mapInArrow(_predictor(net), "id long, lang_pred string, score double")
    return predicted.withColumnRenamed("id", id_col)
