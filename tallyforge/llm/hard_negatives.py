"""Hard negatives of anchors, by slots between the upper limits of their positives."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import written
from tallyforge.llm.shared_files import resolve

#: Sums of products below this are exact in double precision.
EXACT = float(1 << 53)
LONG = (1 << 63) - 1

#: Anchors compared with rows at a time, however short the vectors are.
MOST_ANCHORS = 512

_FOUND = "anchor long, slot int, score long, id long"


def _parts(score: Column, percent: int, more: int) -> Column:
    """(percent * score + more) div 100 without overflow; score is 0 or more."""
    div = lambda x: F.call_function("div", x, F.lit(100))
    return div(score) * percent + div(score % 100 * percent + more)


def share_below(score: Column, percent: int) -> Column:
    """The largest whole number with 100 * number <= percent * score."""
    return _parts(score, percent, 0)


def share_above(score: Column, percent: int) -> Column:
    """The smallest whole number with 100 * number >= percent * score."""
    return _parts(score, percent, 99)


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole-number rows; beyond a long its ends."""
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0))
    if most * max(1, a.shape[1]) < EXACT:
        return a.astype(np.float64) @ b.astype(np.float64).T
    return np.clip(a.astype(object) @ b.astype(object).T, -LONG, LONG).astype(np.int64)


def best_of(anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each anchor: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, anchor))
    first = np.r_[True, anchor[order][1:] != anchor[order][:-1]] if len(order) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - start < k]


class Kept:
    """The combiner of one block of anchors: for each anchor and slot, the ``k`` best rows so far.

    A slot holds the scores in (above, upto] that are not below ``least``.
    """

    def __init__(self, least: np.ndarray, above: np.ndarray, upto: np.ndarray, k: int):
        self.least, self.above, self.upto, self.k = least.copy(), above, upto, k
        self.rows = [tuple(np.zeros(0, np.int64) for _ in range(3)) for _ in range(least.shape[1])]

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of all anchors (rows) with the rows ``ids`` (columns); hidden pairs are below every slot."""
        inside = (scores >= self.least.min(1)[:, None]) & (scores <= self.upto.max(1)[:, None])
        anchors, columns = np.nonzero(inside)
        values = scores[anchors, columns]
        for s, kept in enumerate(self.rows):
            least, above, upto = (limit[anchors, s] for limit in (self.least, self.above, self.upto))
            at = np.flatnonzero((values >= least) & (values > above) & (values <= upto))
            if not len(at):
                continue
            new = (anchors[at], values[at].astype(np.int64), ids[columns[at]])
            anchor, score, names = (np.concatenate(x) for x in zip(kept, new, strict=True))
            best = best_of(anchor, score, names, self.k)
            self.rows[s] = anchor, score, names = anchor[best], score[best], names[best]
            full = np.flatnonzero(np.bincount(anchor, minlength=len(self.least)) >= self.k)
            # An equal score may still win by its id.
            self.least[full, s] = score[np.searchsorted(anchor, full, side="right") - 1]


def _slabs(batches: Iterator[pa.RecordBatch], values: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, matrix) of at most about ``values`` numbers, each of vectors of one length."""
    held: dict[int, list] = {}
    for batch in batches:
        sizes = batch["vector"].value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes):
            part = batch.filter(pa.array(sizes == size))
            step = max(1, values // max(1, int(size)))
            for at in range(0, len(part), step):
                held.setdefault(int(size), []).append(part.slice(at, step))
                if sum(map(len, held[int(size)])) >= step:
                    yield _packed(held.pop(int(size)))
    for parts in held.values():
        yield _packed(parts)


def _packed(parts: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    whole = pa.Table.from_batches(parts)
    ids, labels = whole["id"].to_numpy(), whole["label"].to_numpy()
    order = np.argsort(labels, kind="stable")
    return ids[order], labels[order], _matrix(whole["vector"])[order]


def _anchor_blocks(files: list[str], size: int, values: int) -> Iterator[pa.Table]:
    """The anchors of one vector length from the shared folder, block by block."""
    step = max(1, min(MOST_ANCHORS, values // max(1, size)))
    for uri in files:
        system, path = resolve(uri)
        with system.open_input_file(path) as source:
            for batch in pq.ParquetFile(source).iter_batches(batch_size=step):
                same = np.flatnonzero(batch["vector"].value_lengths().to_numpy(zero_copy_only=False) == size)
                if len(same):
                    yield pa.Table.from_batches([batch]).take(same)


def _limits(column: pa.ChunkedArray, slots: int, fill: int) -> np.ndarray:
    out = np.full((len(column), slots), fill, np.int64)
    for i, row in enumerate(column.to_pylist()):
        out[i, : len(row)] = row
    return out


def _scan(files: list[str], same_label: bool, slots: int, k: int, slab: int, block: int, chunk: int) -> Callable:
    """Rows of a task against all anchors: the ``k`` best of each anchor and slot among each slab of rows."""

    def of_block(anchors: pa.Table, ids: np.ndarray, labels: np.ndarray, body: np.ndarray) -> Kept:
        own, theirs = anchors["id"].to_numpy(), anchors["label"].to_numpy()
        matrix = _matrix(anchors["vector"])
        least, above, upto = (_limits(anchors[c], slots, f) for c, f in (("least", LONG), ("above", LONG), ("upto", -LONG)))
        kept = Kept(least, above, upto, k)
        for at in range(0, len(ids), chunk):
            part, names, kinds = body[at : at + chunk], ids[at : at + chunk], labels[at : at + chunk]
            if same_label:  # rows are sorted by label, so an anchor's label is one run of them
                wanted = np.isin(kinds, theirs)
                part, names, kinds = part[wanted], names[wanted], kinds[wanted]
            if not len(names):
                continue
            scores = products(matrix, part)
            equal = kinds[None, :] == theirs[:, None]
            allowed = equal & (names[None, :] != own[:, None]) if same_label else ~equal
            kept.add(np.where(allowed, scores, -np.inf if scores.dtype == np.float64 else -LONG - 1), names)
        return kept

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, body in _slabs(batches, slab):
            for anchors in _anchor_blocks(files, body.shape[1], block):
                kept = of_block(anchors, ids, labels, body)
                names = anchors["id"].to_numpy()
                for s, (anchor, score, found) in enumerate(kept.rows):
                    if len(anchor):
                        columns = [names[anchor], np.full(len(anchor), s, np.int32), score, found]
                        yield pa.record_batch([pa.array(c) for c in columns], names=["anchor", "slot", "score", "id"])

    return scan


def _first(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The ``k`` best per key, with ``rank``; Spark drops the rest of a task's rows before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    slab: int = 1 << 22,
    block: int = 1 << 15,
    chunk: int = 8192,
) -> DataFrame:
    """For each anchor and each of its positives, the hardest rows of other labels within a window of scores.

    A component x counts as floor(``scale`` * x); a score is the inner product of such whole numbers,
    and of equal scores the smaller id comes first.  The positives of an anchor are its first
    ``positives`` other rows of its label; the negatives of a positive are the first ``negatives`` rows of other
    labels with low * positive <= 100 * negative <= high * positive.

    The windows of an anchor overlap, so they are not searched one by one: the upper limits of its positives
    split the scores into disjoint slots.  Each slab of rows, in one task, is multiplied with the anchors block by
    block; a combiner keeps the ``negatives`` best of each anchor and slot, and the partial lists are
    merged after one shuffle.  A window is answered from the slots below its upper limit in descending
    order, cut at its lower limit; no slot has to give more than ``negatives`` rows.

    Anchors (``is_anchor``) are a stated query set that grows with the input: they are read from the shared folder in
    blocks of ``block`` numbers, rows are held in slabs of ``slab`` numbers, neither is broadcast.  Rows
    are never shuffled, only the lists are.

    Returns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.  Rows with a null id, label
    or vector, or any null or non-finite component take no part; vectors of different lengths are not
    compared; an empty vector scores 0.  Rows with the anchor's id are not its positives; rows
    that repeat another id are rows of their own; equal anchors count once.  A positive with a score below 0 has an empty window.
    Products beyond a long count as its end.  No other column is read.
    """
    body = F.col(vector_col).cast("array<double>")
    finite = "vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        body.alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    rows = rows.filter(f"id IS NOT NULL AND label IS NOT NULL AND coalesce({finite}, false)")
    rows = written(rows.withColumn("vector", F.expr(f"transform(vector, x -> floor({float(scale)}D * x))")), "rows")
    spark = rows.sparkSession

    anchors = rows.filter("anchor").drop("anchor").dropDuplicates()
    whole = anchors.withColumns({c: F.array(F.lit(v).cast("long")) for c, v in (("least", -LONG), ("above", -LONG - 1), ("upto", LONG))})
    files = written(whole, "anchors").inputFiles()
    near = rows.drop("anchor").mapInArrow(_scan(files, True, 1, positives, slab, block, chunk), _FOUND)
    pairs = _first(near, positives, "anchor").filter("score >= 0")
    pairs = written(pairs.select("anchor", F.col("id").alias("positive"), F.col("score").alias("positive_score")), "positives")

    # Slots in ascending order; each begins above the one before.
    limits = pairs.groupBy("anchor").agg(F.sort_array(F.collect_list("positive_score")).alias("scores"))
    each = lambda f, percent: F.transform("scores", lambda s: f(s, percent))
    limits = limits.select("anchor", each(share_above, low).alias("least"), each(share_below, high).alias("upto"))
    below = F.concat(F.array(F.lit(-LONG - 1).cast("long")), F.expr("slice(upto, 1, size(upto) - 1)"))
    limits = limits.withColumn("above", below)
    windowed = anchors.join(limits.withColumnRenamed("anchor", "id"), "id")
    files = written(windowed, "windows").inputFiles()
    partial = rows.drop("anchor").mapInArrow(_scan(files, False, positives, negatives, slab, block, chunk), _FOUND)
    slots = _first(partial, negatives, "anchor", "slot").groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("slot", "score", (-F.col("id")).alias("id"))), asc=False).alias("slots")
    )

    joined = pairs.join(slots, "anchor").withColumns(
        {"_low": share_above(F.col("positive_score"), low), "_high": share_below(F.col("positive_score"), high)}
    )
    suffix = f"slice(filter(slots, s -> s.score <= _high AND s.score >= _low), 1, {int(negatives)})"
    return joined.select("anchor", "positive", "positive_score", F.posexplode(F.expr(suffix)).alias("place", "n")).select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        (F.col("place") + 1).cast("int").alias("rank"),
        (-F.col("n.id")).alias("negative_id"),
        "positive_score",
        F.col("n.score").alias("negative_score"),
    )
