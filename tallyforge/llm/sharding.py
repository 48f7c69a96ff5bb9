"""Shards of nearly equal bytes, by sampled splitters and ranges of keys."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import written

#: Rows are in order of these hashes: of the text, of the id, of the row's number.
LEVELS = ("key", "id", "row")
#: Ranges a shard at least, ranges at most, and drawn keys a range.
RANGES, MOST_RANGES, DRAWN = 64, 1 << 16, 16
_TOP = np.iinfo(np.int64).max


def cuts_of(values: np.ndarray, weights: np.ndarray, pieces: float) -> np.ndarray:
    """First values of the ranges after the first one, of about equal weight; a value as heavy as a range is one by itself."""
    found, place = np.unique(values, return_inverse=True)
    weight = np.bincount(place, weights, len(found))
    share = weight.sum() / max(1.0, pieces)
    upto = np.cumsum(weight)
    heavy = weight >= share
    ends = heavy | (np.floor(upto / share) > np.floor((upto - weight) / share))
    return np.union1d(found[ends & (found < _TOP)] + 1, found[heavy])


@dataclass
class Splitters:
    """Cuts of the keys, and deeper ones: of the ids of a key (path of one), of the rows of a key and id (path of two)."""

    keys: np.ndarray
    deep: dict[tuple[int, ...], np.ndarray] = field(default_factory=dict)

    def cut(self, path: tuple[int, ...], cuts: np.ndarray) -> None:
        if path:
            self.deep[path] = np.union1d(self.deep.get(path, np.zeros(0, np.int64)), cuts)
        else:
            self.keys = np.union1d(self.keys, cuts)

    def of(self, *levels: np.ndarray) -> np.ndarray:
        """The range of each row, from its hashes."""
        found = np.searchsorted(self.keys, levels[0], side="right")
        new = len(self.keys) + 1
        for path in sorted(self.deep, key=len):
            cuts = self.deep[path]
            at = np.flatnonzero(np.logical_and.reduce([levels[i] == v for i, v in enumerate(path)]))
            piece = np.searchsorted(cuts, levels[len(path)][at], side="right")
            found[at] = np.where(piece == 0, found[at], new + piece - 1)
            new += len(cuts)
        return found

    def column(self) -> Column:
        def of(key: pd.Series, id_: pd.Series, row: pd.Series) -> pd.Series:
            return pd.Series(self.of(key.to_numpy(), id_.to_numpy(), row.to_numpy()))

        return F.pandas_udf(of, "long")(*[F.col(c) for c in LEVELS])


@dataclass
class Ranges:
    """Exact figures of the ranges that hold rows, in order of their keys."""

    splitters: Splitters
    name: np.ndarray
    rows: np.ndarray
    bytes: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def measured(cls, rows: DataFrame, splitters: Splitters) -> Ranges:
        ends = [f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in LEVELS]
        found = rows.withColumn("range", splitters.column()).groupBy("range").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), *ends)
        table = found.toArrow()
        column = lambda c: table[c].to_numpy().astype(np.int64)
        low, high = (np.stack([column(f"{f}_{c}") for c in LEVELS], 1) for f in ("min", "max"))
        order = np.lexsort(low.T[::-1])
        return cls(splitters, column("range")[order], column("rows")[order], column("bytes")[order], low[order], high[order])

    def path(self, i: int) -> tuple[int, ...] | None:
        """What all rows of the range share; None where nothing is left to split by."""
        same = self.low[i] == self.high[i]
        return None if same.all() else tuple(int(x) for x in self.low[i][: same.argmin()])

    def weight(self, i: int) -> float:
        """The range's part of bytes and rows, on the average."""
        return float(self.bytes[i] / self.bytes.sum() + self.rows[i] / self.rows.sum()) / 2


def _drawn(rows: DataFrame, total: int, count: int, rate: float, seed: int) -> pa.Table:
    """Rows drawn with a probability by their weight (half by size, half by number), each with the weight it stands for.

    About ``rate`` rows for all weight; the choice hangs on the row's hash, so a task that runs again draws the same rows.
    """
    weight = F.col("size") / F.lit(2.0 * total) + F.lit(0.5 / count)
    chance = F.least(F.lit(1.0), weight * F.lit(rate))
    dice = F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return rows.withColumns({"weight": weight / chance, "chance": chance}).filter(dice < F.col("chance")).drop("chance").toArrow()


def _split(rows: DataFrame, ranges: Ranges, wanted: dict[int, float], seed: int) -> Ranges:
    """Subdivide ranges (by place) into about so many pieces each; every one of them gives two or more."""
    names = {int(ranges.name[i]): i for i in wanted}
    rate = max(DRAWN * pieces / ranges.weight(i) for i, pieces in wanted.items())
    inside = rows.withColumn("range", ranges.splitters.column()).filter(F.col("range").isin(list(names)))
    table = _drawn(inside, int(ranges.bytes.sum()), int(ranges.rows.sum()), rate, seed)
    columns = {c: table[c].to_numpy() for c in (*LEVELS, "range", "weight")}
    for name, i in names.items():
        path = ranges.path(i)
        level = len(path)
        low, high = int(ranges.low[i][level]), int(ranges.high[i][level])
        at = columns["range"] == name
        cuts = np.zeros(0, np.int64)
        if at.any():
            cuts = cuts_of(columns[LEVELS[level]][at], columns["weight"][at], wanted[i])
            cuts = cuts[(cuts > low) & (cuts <= high)]
        ranges.splitters.cut(path, cuts if len(cuts) else np.array([low + (high - low + 1) // 2]))
    return Ranges.measured(rows, ranges.splitters)


def _items(ranges: Ranges, shards: int, apart: set[int]) -> Iterator[list[int]]:
    """Ranges that go to a shard together: those of one text, as far as they fill no shard; keys in ``apart`` don't."""
    share = ranges.bytes.sum() / shards
    held: list[int] = []
    filled = 0
    for i in range(len(ranges.name)):
        one_text = ranges.low[i][0] == ranges.high[i][0] and int(ranges.low[i][0]) not in apart
        joins = held and one_text and ranges.low[held[-1]][0] == ranges.high[held[-1]][0] == ranges.low[i][0]
        if held and not (joins and filled + ranges.bytes[i] <= share):
            yield held
            held, filled = [], 0
        held.append(i)
        filled += ranges.bytes[i]
    if held:
        yield held


def assign(ranges: Ranges, shards: int, apart: set[int]) -> tuple[np.ndarray, np.ndarray]:
    """(shard of each range, bytes of each shard): the largest item first, each to the shard with the fewest bytes."""
    shard, load = np.zeros(len(ranges.name), np.int64), np.zeros(shards, np.int64)
    heap = [(0, s) for s in range(shards)]
    items = [(int(ranges.bytes[i].sum()), i) for i in _items(ranges, shards, apart)]
    for size, item in sorted(items, key=lambda x: (-x[0], x[1])):
        _, s = heapq.heappop(heap)
        shard[item] = s
        load[s] += size
        heapq.heappush(heap, (int(load[s]), s))
    return shard, load


def _finer(ranges: Ranges, shard: np.ndarray, load: np.ndarray, tolerance: float, apart: set[int]) -> dict[int, float] | None:
    """What to split where a shard has too many bytes; texts are set apart only if no other range helps.  None: nothing helps."""
    most = float(load.mean())
    if load.max() <= most * (1 + tolerance):
        return None
    grain = max(1.0, most * tolerance / 4)
    inside = [i for i in np.flatnonzero(shard == load.argmax()) if ranges.bytes[i] > grain]
    inside.sort(key=lambda i: -ranges.bytes[i])
    one_text = lambda i: ranges.low[i][0] == ranges.high[i][0]
    mixed = {int(i): float(ranges.bytes[i] / grain) for i in inside if not one_text(i)}
    if mixed:
        return mixed
    for i in inside:
        key = int(ranges.low[i][0])
        if ranges.path(i) is not None:
            apart.add(key)
            return {int(i): float(ranges.bytes[i] / grain)}
        if key not in apart and (ranges.low[:, 0] == key).sum() > 1:
            apart.add(key)
            return {}
    return None


def shard_documents(
    docs: DataFrame, shards: int = 8, tolerance: float = 0.005, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Deal all rows to ``shards`` shards with nearly equal sums of size: UTF-8 bytes of the text (null: none) plus 1.

    Rows are in the order of hashes of the text, the id and the row's number.  Keys are drawn by weight, quantiles of
    them become splitters, and the rows are cut into ranges of about equal weight, at least 64 a shard and four for each shuffle
    partition, at most 65 536.  The ranges are then measured exactly; an overfull one (twice its share of bytes or
    of rows) is drawn from again and subdivided, one text's rows by their ids, one id's by row.  Whole
    ranges, the largest first, go to the shard with the fewest bytes, and more are subdivided while a shard is more than
    ``tolerance`` above the mean.

    Equal texts are one group.  A group goes to one shard if it is no larger than an average shard; a larger one
    fills as few as it can.  It is spread further only where the bytes could not be nearly equal otherwise.  A single row is never cut, so
    rows larger than a shard decide how equal the shards can be.

    The driver sees drawn keys (16 a range) and a row of figures per range, whatever the input; rows are shuffled once, by range.

    Returns one row per input row: ``doc`` (the row with all its columns), ``size``, ``shard`` (0 to ``shards`` - 1) and ``slot``, gapless
    from 0 within the shard, in the order of the ranges.  Null and empty texts are equal; ids may be null or repeat; equal rows
    are rows of their own, in any order among each other.  An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = written(
        docs.select(
            F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.xxhash64(text).alias("key"),
            F.xxhash64(F.col(id_col).cast("string")).alias("id"),
            F.xxhash64(F.monotonically_increasing_id()).alias("row"),
        ),
        "keyed",
    )
    rows = keyed.select("size", *LEVELS)
    total, count = rows.agg(F.sum("size"), F.count("*")).first()
    if not count:
        return keyed.select("doc", "size", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    number = min(MOST_RANGES, max(RANGES * shards, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    drawn = _drawn(rows, total, count, DRAWN * number, 0)
    ranges = Ranges.measured(rows, Splitters(cuts_of(drawn["key"].to_numpy(), drawn["weight"].to_numpy(), number)))
    seed, apart = 0, set()
    while True:
        seed += 1
        share = np.maximum(ranges.bytes / total, ranges.rows / count) * number
        wanted = {int(i): float(share[i]) for i in np.flatnonzero(share > 2) if ranges.path(i) is not None}
        if not wanted:
            shard, load = assign(ranges, shards, apart)
            wanted = _finer(ranges, shard, load, tolerance, apart)
            if wanted is None:
                break
        if wanted:
            ranges = _split(rows, ranges, wanted, seed)

    order = np.lexsort((np.arange(len(shard)), shard))
    before = np.cumsum(ranges.rows[order]) - ranges.rows[order]
    first = np.searchsorted(shard[order], shard[order])
    offset = before - before[first]
    plan = pd.DataFrame({"range": ranges.name[order], "shard": shard[order].astype(np.int32), "offset": offset})
    plan = docs.sparkSession.createDataFrame(plan, "range long, shard int, offset long")
    inside = Window.partitionBy("range").orderBy(*LEVELS)
    placed = keyed.withColumn("range", ranges.splitters.column()).withColumn("place", F.row_number().over(inside) - 1)
    return placed.join(F.broadcast(plan), "range").select(
        "doc", "size", "shard", (F.col("offset") + F.col("place")).cast("long").alias("slot")
    )
