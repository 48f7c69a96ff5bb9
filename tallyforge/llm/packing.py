"""Best-fit packing of token documents into sequences, by large-item matching."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import arrow_batches, random_key, running_total, written
from tallyforge.llm.tokens import SLICE, encoder, give_back, slices, with_end

PIECES = "id long, piece int, start long, length long, ids_crc32 long"


def pack_plan(counts: Mapping[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Place ``counts[length]`` pieces into bins of ``capacity``.

    The plan works on counts of lengths, never on single pieces, so it is as large as the
    number of lengths allows and not as the corpus is.  Pieces above a third of the capacity
    go first, longest first: each takes the longest other such piece that fits, so at
    most two share a bin.  The others, longest first, go to the bins with the least room that holds
    them, else to new bins.  Rows: length, first rank, pieces, pieces per bin, first bin, offset.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    bins: list[list] = []  # how many alike, what they hold as (length, times), room
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]

    def open_bins(many: int, holds: list[tuple[int, int]]) -> None:
        room = capacity - sum(n * t for n, t in holds)
        rooms[room].append(len(bins))
        bins.append([many, holds, room])

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for n in large:
        fits = [m for m in large if m <= min(n, capacity - n)]
        for m in fits:
            if not left[n]:
                break
            many = min(left[n], left[m]) if m != n else left[n] // 2
            if many:
                open_bins(many, [(n, 1), (m, 1)] if m != n else [(n, 2)])
                left[n] -= many if m != n else 2 * many
                left[m] -= many if m != n else 0
        if left[n]:
            open_bins(left[n], [(n, 1)])
            left[n] = 0

    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        todo = left[n]
        room = n
        while todo:
            while room <= capacity and not rooms[room]:
                room += 1
            if room > capacity:
                each = capacity // n
                if todo >= each:
                    open_bins(todo // each, [(n, each)])
                if todo % each:
                    open_bins(1, [(n, todo % each)])
                break
            which = rooms[room][-1]
            many, holds, _ = bins[which]
            times = min(room // n, max(1, todo // many))
            used = min(many, todo)
            if used < many:
                bins[which][0] -= used
            else:
                rooms[room].pop()
                bins[which][0] = 0
            open_bins(used, [*holds, (n, times)])
            todo -= used * times
            if room - n * times >= n:
                room -= n * times
    plan, rank, first = [], dict.fromkeys(counts, 0), 0
    for many, holds, _ in bins:
        offset = 0
        for n, times in holds if many else []:
            plan.append((n, rank[n], many * times, times, first, offset))
            rank[n] += many * times
            offset += n * times
        first += many
    return plan


def _cut(path: str, end: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            give_back()  # of the batch or the task before
            ids_of = batch.column(0)
            for first, data, bounds in slices(batch.column(1), SLICE // 4):
                ids, ends = with_end(*encode(data, bounds), end)
                raw = memoryview(ids.astype("<u4").tobytes())
                row, piece, start, length, crc = [], [], [], [], []
                for i in range(len(ends) - 1):
                    low, high = int(ends[i]), int(ends[i + 1])
                    for number, at in enumerate(range(low, high, capacity)):
                        stop = min(at + capacity, high)
                        row.append(first + i)
                        piece.append(number)
                        start.append(at - low)
                        length.append(stop - at)
                        crc.append(zlib.crc32(raw[4 * at : 4 * stop]))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids_of.take(pa.array(row, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["id", "piece", "start", "length", "ids_crc32"],
                )

    return run


def _placed(plan: list[tuple[int, int, int, int, int, int]]):
    table = np.array(sorted(plan), np.int64).reshape(-1, 6)
    span = 1 << 44  # ranks of one length stay below
    keys = table[:, 0] * span + table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            length = columns["length"].to_numpy(zero_copy_only=False)
            rank = columns.pop("before").to_numpy(zero_copy_only=False)
            found = table[np.searchsorted(keys, length * span + rank, "right") - 1]
            nth = rank - found[:, 1]
            each = found[:, 3]
            columns["sequence_id"] = pa.array(found[:, 4] + nth // each, pa.int64())
            columns["offset"] = pa.array(found[:, 5] + nth % each * length, pa.int64())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    capacity: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack token documents into sequences of at most ``capacity`` tokens.

    A document is its ids and ``end_id``; a null text counts as empty, so every row
    has a token.  Documents longer than ``capacity`` are cut into full pieces and a rest.
    Only the number of pieces of each length, at most ``capacity`` numbers, comes to the driver; there
    ``pack_plan`` says what the bins hold.  Pieces find their place by their rank among
    the pieces of their length, which is counted in ranges, so that one very frequent length is no hot group.

    Returns one row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``,
    ``offset``.  Repeated rows and null ids are packed like any other; an empty table gives no rows.
    """
    pieces = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    pieces = pieces.mapInArrow(_cut(tokenizer, end_id, capacity), PIECES)
    with arrow_batches(docs.sparkSession, 500):
        pieces = written(pieces.withColumn("key", random_key("pack", "id", "piece")), "pieces")
    counts = {int(n): int(c) for n, c in pieces.groupBy("length").count().collect()}
    ranked = running_total(pieces, ["length"], "key", ["id", "piece"], None).select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", F.col("before").cast("long").alias("before")
    )
    schema = f"`{id_col}` long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(_placed(pack_plan(counts, capacity)), schema)
