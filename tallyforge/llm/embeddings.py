"""Near-duplicate vectors by a subspace join with uneven shares."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tallyforge.llm.common import in_bitmap, slot_bitmap, written
from tallyforge.llm.components import components
from tallyforge.llm.shared_files import create, fresh_file, open_random
from tallyforge.session import scratch_path

#: Blocks of at most so many rows have bounds of their own; up to TALL of them at once are multiplied with another.
STEP, TALL = 256, 4

#: Links of a unit that are held before they are folded into its trees, and pairs before they are compared exactly.
HELD, PAIRS = 1 << 18, 1 << 14

#: Bits of the maps that spare most rows a shuffle.
BITS = 1 << 22


def subspaces(size: int, blocks: int) -> list[slice]:
    cuts = np.linspace(0, size, min(blocks, size) + 1).astype(int)
    return [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _unit(raw: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; scaled first, so that squares stay finite."""
    scaled = raw / np.abs(raw).max(1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(1, keepdims=True))


def rotation(few: np.ndarray) -> np.ndarray:
    """The axes of a sample of unit vectors, the widest first; any rotation gives the same links."""
    values, axes = np.linalg.eigh(np.cov(few, rowvar=False, bias=True).reshape(few.shape[1], -1))
    return np.ascontiguousarray(axes[:, np.argsort(-values, kind="stable")])


def _limits(turned: np.ndarray, lead: int) -> np.ndarray:
    """The leading subspace and the length of the rest: products of such rows are upper limits of cosines."""
    rest = np.sqrt((turned[:, lead:] ** 2).sum(1, keepdims=True))
    return np.concatenate([turned[:, :lead], rest], 1).astype(np.float32)


def _floor(bound: float, lead: int) -> float:
    """What a limit in single precision is at least, if the cosine is ``bound``."""
    return bound - (lead + 8) * 2.0**-22


def leading(turned: np.ndarray, bound: float, blocks: int, most: float = 1 / 2048) -> int:
    """Axes of the fewest subspaces whose limits let no more than this share of a sample's pairs through that don't link."""
    size = turned.shape[1]
    some = turned[:: max(1, len(turned) // 256)]
    links = np.count_nonzero(some @ turned.T >= bound)
    for part in subspaces(size, blocks):
        passed = np.count_nonzero(_limits(some, part.stop) @ _limits(turned, part.stop).T >= _floor(bound, part.stop))
        if passed - links <= most * len(some) * len(turned):
            return part.stop
    return size


class Tree:
    """Cells of a subspace: halves of a sample, cut at the median of the widest axis again and again."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.cuts: list[tuple[int, float]] = []
        depth = max(0, int(np.ceil(np.log2(max(1, cells)))))
        groups = [sample]
        for _ in range(depth):
            halves = []
            for g in groups:
                axis = int((g.max(0) - g.min(0)).argmax()) if len(g) else 0
                at = float(np.median(g[:, axis])) if len(g) else 0.0
                self.cuts.append((axis, at))
                halves += [g[g[:, axis] < at], g[g[:, axis] >= at]]
            groups = halves

    def cell(self, rows: np.ndarray) -> np.ndarray:
        at, low, wide = np.zeros(len(rows), np.int64), 0, 1
        while low < len(self.cuts):
            axes, values = (np.array(x) for x in zip(*self.cuts[low : low + wide], strict=True))
            at = 2 * at + (rows[np.arange(len(rows)), axes[at]] >= values[at])
            low, wide = low + wide, 2 * wide
        return at


def _rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _turned(raw: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, and the same turned."""
    unit = _unit(raw.astype(np.float64))
    return unit, unit @ axes


def _cells(axes: np.ndarray, tree: Tree):
    """Each vector with its cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = tree.cell(_turned(_rows(batch.column("vector")), axes)[1])
                yield pa.RecordBatch.from_arrays([pa.array(cell), *batch.columns], ["cell", *batch.schema.names])

    return run


def _store(axes: np.ndarray, folder: str, most: int):
    """Rows, sorted by cell, as chunks of at most ``most`` in a file of the task: where each is, and its bounds on all axes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, sink, at, done, held = fresh_file(folder, ".vectors"), None, 0, [], []

        def put() -> None:
            nonlocal sink, at
            whole = pa.Table.from_batches(held)
            raw = _rows(whole["vector"])
            turned = _turned(raw, axes)[1]
            sink = sink or create(name)
            parts = [whole["id"].to_numpy(), whole["copies"].to_numpy(), raw]
            for part in parts:
                sink.write(np.ascontiguousarray(part).tobytes())
            done.append((name, at, len(raw), whole["cell"][0].as_py(), whole["id"][0].as_py(), turned.min(0), turned.max(0)))
            at += sum(part.nbytes for part in parts)
            held.clear()

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, most - sum(map(len, held)))
                held.append(part)
                batch = batch.slice(len(part))
                if sum(map(len, held)) == most:
                    put()
        if held:
            put()
        if sink:
            sink.close()
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            columns = [pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["path", "at", "rows", "cell", "id", "low", "high"])

    return run


def _roots(many: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest number connected to each, by hooking."""
    label = np.arange(many)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


class Slab:
    """Neighbouring chunks, read from the shared folder: unit vectors, their limits, and the bounds of blocks of STEP rows."""

    def __init__(self, chunks: list[tuple[str, int, int]], size: int, kind: np.dtype, axes: np.ndarray, lead: int):
        many = sum(rows for _, _, rows in chunks)
        self.ids, self.copies = np.empty(many, np.int64), np.empty(many, np.int64)
        self.unit, self.limits = np.empty((many, size)), np.empty((many, lead + 1), np.float32)
        starts, low, high, to = [], [], [], 0
        for path, at, rows in chunks:
            with open_random(path) as source:
                raw = source.read_at(rows * (16 + size * kind.itemsize), at)
            here = slice(to, to + rows)
            self.ids[here] = np.frombuffer(raw, np.int64, rows)
            self.copies[here] = np.frombuffer(raw, np.int64, rows, 8 * rows)
            self.unit[here], turned = _turned(np.frombuffer(raw, kind, rows * size, 16 * rows).reshape(rows, size), axes)
            self.limits[here] = _limits(turned, lead)
            for a in range(0, rows, STEP):
                starts.append(to + a)
                low.append(turned[a : a + STEP].min(0))
                high.append(turned[a : a + STEP].max(0))
            to += rows
        self.cuts, self.low, self.high = np.array([*starts, many]), np.array(low), np.array(high)


def _near(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray, bound: float) -> np.ndarray:
    """Which of many boxes are near enough to one to hold a vector that links with one in it."""
    gaps = np.maximum(np.maximum(low - highs, lows - high), 0)
    return (gaps**2).sum(1) <= 2 - 2 * bound + 1e-9


class Links:
    """The links between two slabs (or in one): per vector their number, weighed by copies, and its tree; never pairs."""

    def __init__(self, a: Slab, b: Slab):
        self.a, self.b, self.same = a, b, a is b
        self.off = 0 if self.same else len(a.ids)
        self.ids = a.ids if self.same else np.concatenate([a.ids, b.ids])
        self.many, self.label = np.zeros(len(self.ids), np.int64), np.arange(len(self.ids))
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        self.edges.append((i, j))
        if sum(len(e[0]) for e in self.edges) >= HELD:
            self.fold()

    def fold(self) -> None:
        if self.edges:
            i, j = (self.label[np.concatenate(e)] for e in zip(*self.edges, strict=True))
            self.edges = []
            apart = i != j
            if apart.any():
                self.label = _roots(len(self.label), i[apart], j[apart])[self.label]

    def pairs(self, i: np.ndarray, j: np.ndarray, bound: float) -> None:
        """Pairs of places in the slabs, of which some link."""
        if self.same:
            i, j = i[i < j], j[i < j]
        step = max(1, (1 << 20) // self.a.unit.shape[1])
        for cut in range(0, len(i), step):  # exact, in slices of bounded size
            ii, jj = i[cut : cut + step], j[cut : cut + step]
            true = np.einsum("ij,ij->i", self.a.unit[ii], self.b.unit[jj]) >= bound
            ii, jj = ii[true], jj[true]
            np.add.at(self.many, ii, self.b.copies[jj])
            np.add.at(self.many, self.off + jj, self.a.copies[ii])
            self.join(ii, self.off + jj)

    def block(self, r: slice, c: slice, bound: float) -> None:
        """All pairs of two runs of places, of which many link."""
        x, y = self.a.unit[r], self.b.unit[c]
        cosine = x @ y.T
        true = cosine >= bound
        i, j = np.nonzero(np.abs(cosine - bound) <= 1e-11)
        true[i, j] = np.einsum("ij,ij->i", x[i], y[j]) >= bound  # as in pairs()
        if self.same:
            true &= np.arange(r.start, r.stop)[:, None] < np.arange(c.start, c.stop)
        weights = true.astype(np.float64)  # sums of copies are whole numbers below 2^53
        rows, columns = np.arange(r.start, r.stop), self.off + np.arange(c.start, c.stop)
        self.many[rows] += (weights @ self.b.copies[c]).astype(np.int64)
        self.many[columns] += (self.a.copies[r] @ weights).astype(np.int64)
        i, j = np.nonzero(true & (self.label[rows][:, None] != self.label[columns]))
        if len(i):
            places = np.concatenate([rows, columns])
            self.join(places, places[_roots(len(places), i, len(rows) + j)])
            self.fold()

    def compare(self, bound: float) -> None:
        a, b = self.a, self.b
        across, floor = np.ascontiguousarray(b.limits.T), np.float32(_floor(bound, b.limits.shape[1] - 1))
        room, held, many = np.empty(TALL * STEP * STEP, np.float32), [], 0
        for m, (low, high) in enumerate(zip(b.low, b.high, strict=True)):
            c = slice(b.cuts[m], b.cuts[m + 1])
            wide = c.stop - c.start
            near = np.flatnonzero(_near(low, high, a.low, a.high, bound))
            near = near[near <= m] if self.same else near
            for run in np.split(near, np.flatnonzero(np.diff(near) > 1) + 1):
                for k in range(0, len(run), TALL):
                    r = slice(a.cuts[run[k]], a.cuts[run[min(k + TALL, len(run)) - 1] + 1])
                    limit = room[: (r.stop - r.start) * wide].reshape(-1, wide)
                    np.matmul(a.limits[r], across[:, c], out=limit)
                    passed = np.flatnonzero(limit.ravel() >= floor)
                    if len(passed) * 32 > limit.size:
                        self.block(r, c, bound)
                    elif len(passed):
                        i, j = np.divmod(passed, wide)
                        held.append((r.start + i, c.start + j))
                        many += len(passed)
                        if many >= PAIRS:
                            self.pairs(*(np.concatenate(x) for x in zip(*held, strict=True)), bound)
                            held, many = [], 0
        if held:
            self.pairs(*(np.concatenate(x) for x in zip(*held, strict=True)), bound)

    def found(self) -> pa.RecordBatch:
        self.fold()
        root = np.full(len(self.ids), np.iinfo(np.int64).max)
        np.minimum.at(root, self.label, self.ids)
        some = np.flatnonzero(self.many)
        columns = [self.ids[some], self.many[some], root[self.label[some]]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "links", "root"])


def _verify(units: np.ndarray, slabs: list, size: int, kind: np.dtype, axes: np.ndarray, lead: int, bound: float):
    """Units, pairs of slabs, by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit in batch.column(0).to_pylist():
                a, b = units[unit]
                first = Slab(slabs[a], size, kind, axes, lead)
                links = Links(first, first if a == b else Slab(slabs[b], size, kind, axes, lead))
                links.compare(bound)
                yield links.found()

    return run


def _joined(vectors: DataFrame, few: np.ndarray, count: int, bound: float, blocks: int, chunk: int, slab: int) -> DataFrame:
    """Links and a tree's root, per pair of slabs, of classes of vectors (id, copies, vector) of one length."""
    spark, size = vectors.sparkSession, few.shape[1]
    kind = np.dtype(np.float32 if vectors.schema["vector"].dataType.elementType == FloatType() else np.float64)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    axes = rotation(_unit(few))
    turned = _turned(few, axes)[1]
    lead = leading(turned, bound, blocks)
    tree = Tree(turned, min(-(-count // min(chunk, STEP)), max(1, len(few) // 4)))
    inner = vectors.schema["vector"].dataType.simpleString()
    placed = vectors.mapInArrow(_cells(axes, tree), f"cell long, id long, copies long, vector {inner}")
    # ranges of cells and ids: neighbouring cells are in one task, a crowded one in several
    placed = placed.repartitionByRange(tasks, "cell", "id").sortWithinPartitions("cell", "id")
    schema = "path string, at long, rows long, cell long, id long, low array<double>, high array<double>"
    chunks = written(placed.mapInArrow(_store(axes, scratch_path(spark, "slabs"), min(chunk, max(1, slab // size))), schema), "chunks").toArrow()
    chunks = chunks.sort_by([(c, "ascending") for c in ("cell", "id", "path", "at")])
    places = list(zip(*(chunks[c].to_pylist() for c in ("path", "at", "rows")), strict=True))

    # slabs fit in memory twice, and there are enough of them for several pairs a task
    most = max(1, min(slab // size, -(-count // int(np.ceil((8 * tasks) ** 0.5)))))
    cuts, held = [0], 0
    for k, (_, _, rows) in enumerate(places):
        if held and held + rows > most:
            cuts.append(k)
            held = 0
        held += rows
    low, high = (f.reduceat(_rows(chunks[c]), cuts, 0) for f, c in ((np.minimum, "low"), (np.maximum, "high")))
    slabs = [places[a:b] for a, b in zip(cuts, [*cuts[1:], len(places)], strict=True)]
    near = [np.flatnonzero(_near(low[a], high[a], low[a:], high[a:], bound)) + a for a in range(len(slabs))]
    units = np.concatenate([np.stack([np.full(len(b), a), b], 1) for a, b in enumerate(near)])
    units = np.random.default_rng(len(units)).permutation(units)  # near slabs have more to do, so they are dealt out
    every = spark.range(0, len(units), 1, min(len(units), 8 * tasks))
    return every.mapInArrow(_verify(units, slabs, size, kind, axes, lead, bound), "id long, links long, root long")


def near_duplicate_vectors(
    vectors: DataFrame,
    bound: float = 0.9,
    blocks: int = 4,
    chunk: int = 4096,
    sample: int = 8192,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    slab: int = 1 << 22,
) -> DataFrame:
    """Link vectors whose cosine in double precision is ``bound`` or more.

    Equal vectors are one class.  Unit vectors are turned to the axes of a bounded ``sample`` and split into ``blocks``
    subspaces.  Of the squared distance that two vectors may have, the leading subspaces get the whole share, as many as keep
    nearly all pairs of the sample that don't link apart; the others get none, so only the leading ones are joined.  There the
    product, with that of the lengths of what is left, is an upper limit of the cosine; pairs whose limit
    reaches ``bound`` are compared exactly.  The sample settles only what is compared first and who lies beside whom.

    Vectors are sorted by the cells of a tree and stored once in the shared folder, in chunks of at most ``chunk``; a task reads two
    slabs of neighbouring chunks, each of at most about ``slab`` numbers.  Slabs, and blocks of slabs, whose bounds are too far apart are
    not compared.  Nothing is shuffled or written per pair of chunks; a pair of slabs gives a count and a root per linked vector, never pairs.

    Returns one row per input row: id, ``n_links`` (other rows linked directly), ``component_id``
    (smallest id reachable), ``kept`` (id = component_id).  Vectors that are null, empty, zero or hold null or
    non-finite parts link with nothing, nor do vectors of different lengths.  A null id links with nothing;
    rows that repeat an id and its vector count as linked rows.  No other column is read.
    """
    kind = vectors.schema[vector_col].dataType
    single = isinstance(kind, ArrayType) and kind.elementType == FloatType()
    body = F.col(vector_col).cast("array<float>" if single else "array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), body.alias("vector"))
    finite = "forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')) AND exists(vector, x -> x <> 0)"
    good = F.coalesce(F.expr(f"id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0 AND {finite}"), F.lit(False))
    same = F.unhex(F.sha2(F.concat_ws(",", F.col("vector").cast("array<string>")), 256))
    rows = rows.withColumn("good", good).withColumn("same", F.when(F.col("good"), same))
    rows = written(rows.withColumn("vector", F.when(F.col("good"), F.col("vector"))), "vectors")
    counted = [F.min("id").alias("id"), F.count("*").alias("copies")]
    classes = written(rows.filter("good").groupBy("same").agg(*counted, F.min(F.size("vector")).alias("size")), "classes")
    often = written(slot_bitmap(classes.filter("copies > 1"), F.xxhash64("same"), BITS), "often")
    found = None
    for size, count in classes.groupBy("size").count().collect():
        mine = rows.filter("good").filter(F.size("vector") == size)
        picked = classes.filter(F.col("size") == size).orderBy(F.xxhash64("same")).limit(sample).select("same")
        few = mine.join(F.broadcast(picked), "same").groupBy("same").agg(F.min("vector").alias("vector")).toArrow()
        marked = in_bitmap(mine, F.xxhash64("same"), often, BITS)  # only vectors that may come again are shuffled to meet
        again = marked.filter("hit").groupBy("same").agg(*counted, F.min("vector").alias("vector"))
        once = marked.filter("NOT hit").withColumn("copies", F.lit(1).cast("long"))
        bodies = once.select("id", "copies", "vector").union(again.select("id", "copies", "vector"))
        part = _joined(bodies, _rows(few.sort_by("same")["vector"]), count, bound, blocks, chunk, slab)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = written(found, "links")
    totals = found.groupBy("id").agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    # the other classes have one row and no links
    linked = in_bitmap(classes, F.xxhash64("id"), written(slot_bitmap(totals, F.xxhash64("id"), BITS), "linked"), BITS)
    known = linked.filter("hit OR copies > 1").select("same", "id", "copies").join(totals, "id", "left").join(labels, "id", "left")
    known = written(
        known.select(
            "same",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "id").alias("component"),
        ),
        "known",
    )
    marks = written(slot_bitmap(known, F.xxhash64("same"), BITS), "known_marks")
    rows = in_bitmap(rows.withColumn("key", F.coalesce(F.xxhash64("same"), F.lit(0))), F.col("key"), marks, BITS)
    rows = rows.withColumn("hit", F.col("good") & F.col("hit"))
    none = [F.lit(None).cast("long").alias(c) for c in ("links", "component")]
    each = rows.filter("hit").select("same", "id").join(known, "same", "left").select("id", "links", "component")
    each = each.union(rows.filter("NOT hit").select("id", *none))
    component = F.coalesce("component", "id")
    return each.select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
