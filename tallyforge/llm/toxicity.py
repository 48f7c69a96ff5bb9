"""Toxic texts by a subsequence-kernel support vector machine on landmark words."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import written
from tallyforge.llm.tokens import lower_ascii, slices, word_hashes

#: Longer units are read in overlapping windows of this width.
WIDTH = 24
ORDER, DECAY, SHARED = 3, 0.6, 0.7
#: Pairs of words that are compared at a time.
BLOCK = 8192
#: Kernels are summed in this power, so that a sum is about the number of units that are like the landmark.
POWER = 4
#: A word is a candidate if toxic documents hold it this many times as often as clean ones.
LIFT = 4

# Digits that stand for letters.
_READ = np.arange(256, dtype=np.uint8)
for _digit, _letter in {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}.items():
    _READ[ord(_digit)] = ord(_letter)
_KEEP = np.zeros(256, bool)
_KEEP[[*range(97, 123), *range(128, 256)]] = True


@dataclass
class Units:
    """Words of letters, and words spelled letter by letter: bytes, place and document of each."""

    data: np.ndarray
    start: np.ndarray
    size: np.ndarray
    doc: np.ndarray

    def texts(self, which: np.ndarray) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a : a + n] for a, n in zip(self.start[which].tolist(), self.size[which].tolist(), strict=True)]

    def padded(self, which: np.ndarray) -> np.ndarray:
        at = self.start[which][:, None] + np.arange(WIDTH)
        inside = np.arange(WIDTH) < self.size[which][:, None]
        return np.where(inside, self.data[np.minimum(at, len(self.data) - 1)], 0)


def units(data: np.ndarray, bounds: np.ndarray) -> Units:
    """Units of the texts of a slice: lower case, marks inside words left out, digits read as letters."""
    starts, ends, _ = word_hashes(data, bounds)
    read = _READ[lower_ascii(data)]
    keep = _KEEP[read]
    before = np.concatenate([[0], np.cumsum(keep)])
    doc = np.searchsorted(bounds, starts, "right") - 1
    first, size = before[starts], before[ends] - before[starts]
    some = size > 0
    first, size, doc = first[some], size[some], doc[some]

    single = size == 1
    change = np.flatnonzero(np.diff(np.concatenate([[False], single, [False]]).astype(np.int8)))
    runs = [(a, b) for a, b in change.reshape(-1, 2).tolist() if b - a >= 3]
    spelled = [
        (first[a], last - a, doc[a])
        for low, high in runs
        for cuts in [[low, *(low + 1 + np.flatnonzero(np.diff(doc[low:high]))).tolist(), high]]
        for a, last in zip(cuts[:-1], cuts[1:], strict=True)
        if last - a >= 3
    ]
    if spelled:
        more = np.array(spelled, np.int64).T
        first, size, doc = (np.concatenate([x, y]) for x, y in zip((first, size, doc), more, strict=True))

    long = np.flatnonzero(size > WIDTH)
    if len(long):
        half = WIDTH // 2
        times = -(-(size[long] - WIDTH) // half) + 1
        row = np.repeat(long, times)
        step = half * (np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times))
        pick = np.delete(np.arange(len(size)), long)
        first, size, doc = (
            np.concatenate([x[pick], y])
            for x, y in ((first, first[row] + step), (size, np.minimum(WIDTH, size[row] - step)), (doc, doc[row]))
        )
    return Units(read[keep], first, size, doc)


def subsequence_kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row: the weight of the common subsequences of ORDER letters, each gap decayed; rows are zero-padded."""
    sizes = (a != 0).sum(1)
    order = np.argsort(-sizes, kind="stable")
    out = np.zeros(len(a), np.float32)
    for low in range(0, len(order), BLOCK):
        rows = order[low : low + BLOCK]
        out[rows] = _block_kernel(np.ascontiguousarray(a[rows].T), np.ascontiguousarray(b[rows].T), sizes[rows])
    return out


def _block_kernel(a: np.ndarray, b: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The kernel of columns, the longest of ``a`` first; a letter's step takes only the columns that have it."""
    many, other = len(sizes), int((b != 0).any(1).sum())
    inner = [[np.zeros(many, np.float32)] * (other + 1) for _ in range(ORDER)]
    total = np.zeros(many, np.float32)
    square, decay = np.float32(DECAY**2), np.float32(DECAY)
    for i in range(int(sizes[0])):
        n = int(np.searchsorted(-sizes, -i))
        same = [(a[i, :n] == b[j, :n]).astype(np.float32) * square for j in range(other)]
        for j in range(other):
            total[:n] += same[j] * inner[ORDER - 1][j][:n]
        for k in range(ORDER - 1, 0, -1):
            run, row = np.zeros(n, np.float32), [inner[k][0]]
            for j in range(other):
                run = run * decay + (same[j] * inner[k - 1][j][:n] if k > 1 else same[j])
                row.append(decay * inner[k][j + 1][:n] + run)
            inner[k] = row
    return total


def _pad(words: list[bytes]) -> np.ndarray:
    out = np.zeros((len(words), WIDTH), np.uint8)
    for i, w in enumerate(words):
        out[i, : len(w)] = np.frombuffer(w[:WIDTH], np.uint8)
    return out


def inverse_root(gram: np.ndarray, floor: float = 1e-3) -> np.ndarray:
    """The symmetric matrix whose square inverts ``gram``; eigenvalues below ``floor`` count as ``floor``."""
    values, vectors = np.linalg.eigh(gram)
    return (vectors / np.sqrt(np.maximum(values, floor))) @ vectors.T


@dataclass
class Landmarks:
    """``words``: the first ``toxic`` of them mark toxic texts, the others look like them.

    ``shared``: part of a toxic landmark's letters that a word has to share in order, or its kernels count as zero;
    0 takes the kernels of all words as they are.
    """

    words: list[bytes]
    toxic: int
    shared: float = SHARED

    def __post_init__(self):
        self.rows = _pad(self.words)
        self.own = subsequence_kernel(self.rows, self.rows)
        self._forget()
        # landmarks as texts of one word each, by the kernel that texts are compared with
        self.root = inverse_root(self.kernel(self.rows).astype(np.float64) ** POWER) if self.words else np.zeros((0, 0))

    def __getstate__(self):
        return {"words": self.words, "toxic": self.toxic, "shared": self.shared}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def _forget(self) -> None:
        self.known, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.values = np.zeros((0, len(self.words)), np.float32)

    def look_up(self, hashes: np.ndarray, rows_of) -> tuple[np.ndarray, np.ndarray]:
        """Number of each unit (sorted distinct hashes) in a table of kernels, -1 if it is near no landmark; the table.

        Units met before are remembered, at most a million and 50 000 that are near.
        """
        if len(self.known) > 1_000_000 or len(self.values) > 50_000:
            self._forget()
        at = np.searchsorted(self.known, hashes)
        there = np.minimum(at, max(0, len(self.known) - 1))
        new = np.flatnonzero(self.known[there] != hashes) if len(self.known) else np.arange(len(hashes))
        if len(new):
            rows = rows_of(new)
            near = np.flatnonzero(self.near(rows))
            number = np.full(len(new), -1)
            number[near] = len(self.values) + np.arange(len(near))
            if len(near):
                self.values = np.concatenate([self.values, self.kernel(rows[near])])
            self.known = np.insert(self.known, at[new], hashes[new])
            self.number = np.insert(self.number, at[new], number)
        return self.number[np.searchsorted(self.known, hashes)], self.values

    def near(self, rows: np.ndarray) -> np.ndarray:
        """Rows that share, in order, enough letters of a toxic landmark."""
        found = np.full(len(rows), self.shared <= 0)
        if self.shared <= 0:
            return found
        sizes = (rows != 0).sum(1)
        order = np.argsort(-sizes, kind="stable")
        letters = np.ascontiguousarray(rows[order].T)
        longer = np.searchsorted(-sizes[order], -np.arange(rows.shape[1])).tolist()  # rows that have a letter there
        for word in self.words[: self.toxic]:
            place = np.zeros(256, np.uint32)
            for i, c in enumerate(word):
                place[c] |= np.uint32(1 << i)
            full = np.uint32((1 << len(word)) - 1)
            free = np.full(len(rows), full, np.uint32)
            for i, n in enumerate(longer):  # bits that turn to zero count the longest common subsequence
                if not n:
                    break
                part = free[:n]
                hit = part & place[letters[i, :n]]
                free[:n] = ((part + hit) | (part - hit)) & full
            found[order] |= len(word) - np.bitwise_count(free) >= int(np.ceil(self.shared * len(word)))
        return found

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        """Normalised kernel of each row with each landmark."""
        own = np.maximum(subsequence_kernel(rows, rows), 1e-12)
        out = np.zeros((len(rows), len(self.words)), np.float32)
        sizes = np.array([len(w) for w in self.words])
        for size in np.unique(sizes):
            group = np.flatnonzero(sizes == size)
            marks = np.repeat(self.rows[group, :size], len(rows), 0)
            found = subsequence_kernel(np.tile(rows, (len(group), 1)), marks).reshape(len(group), len(rows))
            out[:, group] = (found / np.sqrt(own * np.maximum(self.own[group], 1e-12)[:, None])).T
        return out


def pooled(landmarks: Landmarks, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the texts with a unit near a landmark: document, and its Nyström features.

    A text's kernel with a landmark pools those of its units (in POWER): the largest, the logarithm of their sum, and that
    of their sum for 100 units.  Each pooled row K(text, landmarks) is mapped by K(landmarks, landmarks)^(-1/2).
    """
    wide = 3 * len(landmarks.words)
    found = units(data, bounds)
    if not len(found.start) or not landmarks.toxic:
        return np.zeros(0, np.int64), np.zeros((0, wide))
    edges = np.zeros(len(found.start) + 1, np.int64)
    np.cumsum(found.size, out=edges[1:])
    flat = found.data[np.repeat(found.start - edges[:-1], found.size) + np.arange(edges[-1])]
    _, _, hashes = word_hashes(flat, edges)  # no unit is empty or has a blank, so there is one hash for each
    distinct, pick, back = np.unique(hashes, return_index=True, return_inverse=True)
    number, values = landmarks.look_up(distinct, lambda which: found.padded(pick[which]))
    unit = np.flatnonzero(number[back] >= 0)
    if not len(unit):
        return np.zeros(0, np.int64), np.zeros((0, wide))
    order = unit[np.argsort(found.doc[unit], kind="stable")]
    first = np.flatnonzero(np.concatenate([[True], np.diff(found.doc[order]) > 0]))
    docs, kernels = found.doc[order[first]], values[number[back[order]]].astype(np.float64)
    total = np.add.reduceat(kernels**POWER, first)
    share = total * (100 / np.bincount(found.doc, minlength=len(bounds) - 1)[docs][:, None])
    best = np.maximum.reduceat(kernels, first) ** POWER
    return docs, np.concatenate([rows @ landmarks.root for rows in (best, np.log1p(total), np.log1p(share))], 1)


@dataclass
class Machine:
    """Landmarks, the separating plane, and the curve from decision to probability."""

    landmarks: Landmarks
    plane: np.ndarray
    bias: float
    curve: tuple[float, float]

    def score(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Probability of each text of a slice; one without units near a landmark has the lowest."""
        best = np.full(len(bounds) - 1, self.bias)
        docs, values = pooled(self.landmarks, data, bounds)
        np.maximum.at(best, docs, values @ self.plane + self.bias)
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * best + self.curve[1], -40, 40)))


def _separate(rows: np.ndarray, labels: np.ndarray, penalty: float = 3e-3, steps: int = 400) -> tuple[np.ndarray, float]:
    """Plane and bias of a linear support vector machine: squared hinge, both classes weighing the same, by accelerated descent."""
    sign = np.where(labels > 0, 1.0, -1.0)
    weight = np.where(labels > 0, 0.5 / max(1, (labels > 0).sum()), 0.5 / max(1, (labels <= 0).sum()))
    full = np.concatenate([rows, np.ones((len(rows), 1))], 1)
    rate = 1 / (2 * (weight[:, None] * full**2).sum() + penalty)
    w = look = np.zeros(full.shape[1])
    for t in range(steps):
        slack = np.maximum(0, 1 - sign * (full @ look))
        new = look - rate * (-2 * full.T @ (weight * sign * slack) + penalty * look)
        look, w = new + t / (t + 3) * (new - w), new
    return w[:-1], float(w[-1])


def train(landmarks: Landmarks, values: np.ndarray, labels: np.ndarray) -> Machine:
    """Fit on documents: ``labels`` has one value for each, ``values`` their rows of ``pooled``, zeros without one."""
    if not len(labels) or not landmarks.toxic or labels.min() == labels.max():
        rate = float(labels.mean()) if len(labels) else 0.0
        return Machine(landmarks, np.zeros(3 * len(landmarks.words)), 0.0, (1.0, 4.0 if rate == 1 else -4.0))
    # every column of the same spread; the machine's plane is put back on the values as they are
    mean, spread = values.mean(0), (values.std(0) + 1e-6) * np.sqrt(values.shape[1])
    plane, bias = _separate((values - mean) / spread, labels)
    plane = plane / spread
    bias -= float(mean @ plane)
    best = np.maximum(values @ plane + bias, bias)
    a, b = 1.0, 0.0
    for _ in range(50):  # a logistic curve by Newton's method, targets kept off 0 and 1
        p = 1 / (1 + np.exp(-(a * best + b)))
        goal = np.where(labels > 0, 1 - 1 / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))
        g = np.array([((p - goal) * best).sum(), (p - goal).sum()])
        w = p * (1 - p) + 1e-9
        h = np.array([[(w * best**2).sum() + 1e-3, (w * best).sum()], [(w * best).sum(), w.sum() + 1e-3]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a - step[0], b - step[1]
    return Machine(landmarks, plane, bias, (max(a, 1e-3), b))


def _batches(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for first, data, bounds in slices(batch.column("text")):
            yield batch.slice(first, len(bounds) - 1), data, bounds


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, bounds in _batches(batches):
        found = units(data, bounds)
        fit = np.flatnonzero((found.size >= 3) & (found.size <= 16))
        texts = found.texts(fit)
        rows = sorted({(d, t) for d, t in zip(found.doc[fit].tolist(), texts, strict=True)})
        ids = batch.column("id").take(pa.array([d for d, _ in rows], pa.int64()))
        labels = batch.column("label").take(pa.array([d for d, _ in rows], pa.int64()))
        words = pa.array([t for _, t in rows], pa.binary())
        yield pa.RecordBatch.from_arrays([ids, labels, words], ["id", "label", "unit"])


def _lookalikes(landmarks: Landmarks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, bounds in _batches(batches):
            found = units(data, bounds)
            texts = sorted(set(found.texts(np.arange(len(found.start)))) - set(landmarks.words))
            rows = _pad(texts)
            near = np.flatnonzero(landmarks.near(rows)) if texts else []
            value = landmarks.kernel(rows[near]).max(1) if len(near) else np.zeros(0)
            out = [pa.array([texts[i] for i in near], pa.binary()), pa.array(value, pa.float64())]
            yield pa.RecordBatch.from_arrays(out, ["unit", "value"])

    return run


def _pooled(landmarks: Landmarks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in _batches(batches):
            docs, values = pooled(landmarks, data, bounds)
            found = pa.array(values.astype(np.float32).tolist(), pa.list_(pa.float32()))
            ids = batch.column("id").take(pa.array(docs, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, found], ["id", "pooled"])

    return run


def _scorer(machine: Machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, bounds in _batches(batches):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(machine.score(data, bounds))], ["id", "score"])

    return run


def _toxic_words(sampled: DataFrame, toxic_docs: int, clean_docs: int, most: int) -> list[bytes]:
    """Units that tell toxic documents: the fewest that cover them, each more frequent there than in clean ones.

    Clean ones may hold them too, and how much one tells is left to the machine; among the candidates, those that tell most by
    their counts come first, and one that covers documents with others already chosen counts less.
    """
    rows = written(sampled.mapInArrow(_unit_rows, "id long, label int, unit binary"), "units")
    counts = rows.groupBy("unit").agg(F.sum("label").alias("yes"), F.sum(1 - F.col("label")).alias("no"))
    lift = (F.col("yes") / max(1, toxic_docs)) / ((F.col("no") + 1) / max(1, clean_docs))
    known = counts.withColumn("tells", F.log(lift)).filter((lift >= LIFT) & (F.col("yes") >= max(2, 0.004 * toxic_docs)))
    best = known.orderBy(F.desc(F.col("yes") * F.col("tells")), "unit").limit(1000).collect()
    tells = {bytes(r["unit"]): r["tells"] for r in best}
    words = [bytes(r["unit"]) for r in best]
    if not words:
        return []
    held = rows.filter("label = 1").filter(F.col("unit").isin([bytearray(w) for w in words])).select("id", "unit").collect()
    docs_of: dict[bytes, set[int]] = {}
    for r in held:
        docs_of.setdefault(bytes(r["unit"]), set()).add(r["id"])
    chosen: list[bytes] = []
    covered: Counter[int] = Counter()
    while len(chosen) < most and docs_of:
        gain = {w: tells[w] * sum(0.5 ** covered[d] for d in found) for w, found in docs_of.items()}
        word = max(gain, key=lambda w: (gain[w], w))
        if gain[word] < 2:
            break
        covered.update(docs_of.pop(word))
        chosen.append(word)
    return chosen


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    sample: tuple[int, int] = (4000, 8000),
    landmarks: tuple[int, int] = (96, 32),
    shared: float = SHARED,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> DataFrame:
    """Score every whole text by all its words; high scores mean that label 1 is likely.

    The kernel weighs the common subsequences of three letters of two words, less for each
    letter between, so inserted letters, marks and blanks lower it little.  A text's kernels with the landmarks pool
    those of its words, the largest and the sums, as they are and by length, so a word that clean texts hold too tells
    where it comes often; the Nyström map K(text, landmarks) K(landmarks, landmarks)^(-1/2) makes them features of a
    linear machine.  Words that share less than ``shared`` of a toxic landmark's letters count as zero, with 0
    none do.  Landmarks, at most ``landmarks`` of each kind, are words more
    frequent in toxic documents and the clean words that look most like them.  They, the machine
    and its curve are fitted on at most ``sample`` toxic and clean labelled documents for which ``learn``, a condition
    on the id, holds, taken in the order of a hash of the id.

    Returns id, ``score``.  A text without words like a landmark, as a null or empty one, has the lowest score; without labels all
    scores are equal.  Null labels and ids teach nothing; repeated rows are scored each.  No other column is read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    known = labels.filter(F.lit(True) if learn is None else learn).select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")
    )
    known = known.filter("id IS NOT NULL AND label IN (0, 1)").distinct()
    part = lambda value, most: known.filter(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(most)
    chosen = written(part(1, sample[0]).union(part(0, sample[1])), "sample")
    sampled = written(rows.join(F.broadcast(chosen), "id"), "sampled")
    truth = {r["id"]: r["label"] for r in sampled.select("id", "label").distinct().collect()}
    yes = sum(truth.values())

    words = _toxic_words(sampled, yes, len(truth) - yes, landmarks[0])
    toxic = Landmarks(words, len(words), shared)
    alike: list[bytes] = []
    if words:
        likes = sampled.filter("label = 0").mapInArrow(_lookalikes(toxic), "unit binary, value double")
        likes = likes.groupBy("unit").agg(F.max("value").alias("value")).orderBy(F.desc("value"), "unit")
        alike = [bytes(r["unit"]) for r in likes.limit(landmarks[1]).collect()]
    marks = Landmarks(words + alike, len(words), shared)
    found = sampled.mapInArrow(_pooled(marks), "id long, pooled array<float>").toArrow() if words else None
    place = {d: i for i, d in enumerate(sorted(truth))}
    matrix = np.zeros((len(truth), 3 * len(marks.words)))
    if words:
        own = [place[i] for i in found.column(0).to_pylist()]
        values = found.column(1).combine_chunks().flatten().to_numpy(zero_copy_only=False)
        matrix[own] = values.reshape(len(own), matrix.shape[1])  # rows that repeat an id count once
    machine = train(marks, matrix, np.array([truth[i] for i in sorted(truth)], np.float64))
    return rows.mapInArrow(_scorer(machine), "id long, score double").withColumnRenamed("id", id_col)
