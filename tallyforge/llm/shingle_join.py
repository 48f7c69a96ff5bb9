"""Near-duplicate texts by an exact Jaccard join of their shingles: partition, pigeonhole, verify."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.common import arrow_batches, in_bitmap, slot_bitmap, written
from tallyforge.llm.components import components
from tallyforge.llm.tokens import forget_encoders, lower_ascii, mixed, slices, word_hashes

WORDS = 5
#: Least Jaccard similarity, as a fraction.
UP, DOWN = 75, 100

_TURN = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def shingles(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of the texts of a slice, sorted within each, and the bounds of the texts in them.

    With fewer than WORDS words, the whole sequence is one shingle.
    """
    docs = len(bounds) - 1
    starts, _, hashes = word_hashes(lower_ascii(data), bounds)
    edges = np.searchsorted(starts, bounds)
    many = np.diff(edges)
    out: list[np.ndarray] = []
    if len(hashes) >= WORDS:
        last = len(hashes) - WORDS + 1
        joined = sum(hashes[i : i + last] * _TURN[i] for i in range(WORDS))
        joined = mixed(joined)
    for doc in range(docs):
        a, n = edges[doc], many[doc]
        if n >= WORDS:
            out.append(np.unique(joined[a : a + n - WORDS + 1]))
        elif n:
            out.append(mixed((hashes[a : a + n] * np.array(_TURN[:n])).sum(keepdims=True) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    sizes = np.array([len(s) for s in out], np.int64)
    return (np.concatenate(out) if docs else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def most_apart(small: int, large: int) -> int:
    """Elements by which two linked sets of these sizes differ at most."""
    return (small + large) * (DOWN - UP) // (DOWN + UP)


#: Bands of sets up to this size have a coarse scheme too.
COARSE = 256


def _capacity(size: int, segments: int, deletions: bool) -> float:
    """What nearly all sets of a size can spend: the mean less four deviations, or two where there are deletions.

    A set that can't spend enough in its coarse scheme still has the fine one.
    """
    if segments == 1:
        return 1.0 + (deletions and size > 1)
    empty = np.exp(-size / segments)
    single = empty * size / segments
    mean = 1 - empty + deletions * (1 - empty - single)
    square = single + (4 if deletions else 1) * (1 - empty - single)
    return segments * mean - (2 if deletions else 4) * (segments * max(0.0, square - mean**2)) ** 0.5


@lru_cache(maxsize=1)
def bands() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest set size of each band, and the segments of its fine and its coarse scheme (0: none).

    Sets that link are in one band or in two that follow each other.  A scheme is allocated
    by cost: the fewest segments, so the most telling ones, whose capacity is, for the smallest and the largest
    set of the band, more than the elements by which linked sets may differ.  In a fine scheme a segment
    counts 1 and has one signature.  In a coarse one it has one-deletion neighbourhoods and
    counts 2; it has a signature for each element, which pays for small sets, where fine segments have an element or two.
    """
    low = [1]
    while low[-1] < 1 << 40:
        low.append(-(-low[-1] * DOWN // UP))
    fine, coarse = [], []
    for k, a in enumerate(low):
        b = low[k + 1] - 1 if k + 1 < len(low) else a
        enough = lambda m, d: all(_capacity(x, m, d) >= most_apart(x, x * DOWN // UP) + 1 for x in (a, b))  # noqa: B023, E731
        tries = sorted({64, *(int(a * x / 20) for x in range(8, 21)), 4 * a, 16 * a})
        fine.append(next((m for m in tries if m >= 64 and enough(m, False)), max(64, 16 * a)))
        if a > COARSE:
            coarse.append(0)
        elif b <= 10:  # too few elements for an estimate: one segment less than what must be spent, as most count 2
            coarse.append(max(1, most_apart(b, b * DOWN // UP)))
        else:
            coarse.append(next(m for m in range(1, 4 * a) if enough(m, True)))
    return np.array(low), np.array(fine), np.array(coarse)


def band_of(sizes: np.ndarray) -> np.ndarray:
    return np.searchsorted(bands()[0], sizes, "right") - 1


def signatures(elements: np.ndarray, sizes: np.ndarray, band: np.ndarray, coarse: bool):
    """Signatures of the segments of sets that have elements, each set under a scheme of ``band``.

    A signature hashes what a set has in a segment; in a coarse scheme also what is
    left without one element.  Returns signatures, their set, whether an element was left out, and
    each set's capacity: the differences that must at least be spent to change all its segments.
    """
    segments = bands()[1 + coarse]
    of = np.repeat(np.arange(len(sizes)), sizes)
    segment = ((elements >> np.uint64(20)) % segments[band[of]].astype(np.uint64)).astype(np.int64)
    order = np.argsort((of << 32) | segment, kind="stable")
    of, segment, value = of[order], segment[order], mixed(elements[order] + _TURN[1])
    first = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (segment[1:] != segment[:-1])]))
    total = np.add.reduceat(value, first)
    count = np.diff(first, append=len(of))
    place = (band[of[first]].astype(np.uint64) << np.uint64(40)) + segment[first].astype(np.uint64)
    tag = mixed(place + _TURN[3 if coarse else 2])
    capacity = np.bincount(of[first], 1.0 + (coarse & (count > 1)), minlength=len(sizes)).astype(np.int64)
    if not coarse:
        return mixed(total ^ tag), of[first], np.zeros(len(first), bool), capacity
    back = np.repeat(np.arange(len(first)), count)
    less = np.flatnonzero((count > 1)[back])
    sums = np.concatenate([total, (total[back] - value)[less]])
    owner = np.concatenate([of[first], of[less]])
    return mixed(sums ^ np.concatenate([tag, tag[back][less]])), owner, np.arange(len(sums)) >= len(first), capacity


def sketch(elements: np.ndarray) -> bytes:
    """Parities of the elements in a power of two of slots: two sketches differ in no more slots than the sets in elements."""
    slots = max(64, 4 << int(len(elements) - 1).bit_length()) if len(elements) else 64
    odd = np.bincount((elements >> np.uint64(9)).astype(np.int64) & (slots - 1), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def sketches_apart(a: bytes, b: bytes) -> int:
    """Elements by which two sets differ at least."""
    x, y = (np.frombuffer(s, np.uint64) for s in (a, b))
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget_encoders()
    for batch in batches:
        for first, data, bounds in slices(batch.column(1)):
            elements, edges = shingles(data, bounds)
            prints, odd = [], []
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                own = elements[a:b]
                prints.append(int(mixed(own + _TURN[3]).sum(dtype=np.uint64)) << 64 | int(mixed(own + _TURN[4]).sum(dtype=np.uint64)))
                odd.append(sketch(own))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, len(odd)),
                    pa.array(np.diff(edges)),
                    pa.array([p.to_bytes(16, "big") for p in prints], pa.binary()),
                    pa.array(odd, pa.binary()),
                ],
                ["id", "n", "print", "sketch"],
            )


def _index(buckets: int):
    """Signatures of each slice, packed by bucket; and how many of each set's segments may be too frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        names = ["bucket", "ids", "signs", "who", "slack"]
        kinds = [pa.int32(), *[pa.binary()] * 4]
        for batch in batches:
            column = batch.column(0).to_numpy(zero_copy_only=False)
            for first, data, bounds in slices(batch.column(1)):
                elements, edges = shingles(data, bounds)
                sizes = np.diff(edges)
                ids, band = column[first : first + len(sizes)], band_of(np.maximum(sizes, 1))
                some = sizes > 0
                rows, signs, who, slack = [], [], [], []
                low, _, coarse = bands()
                for role in range(4):  # 1: under the scheme of the band below, where its smaller partners may be; 2: coarse
                    scheme = band - (role & 1)
                    fit = some & (scheme >= 0)
                    if role & 2:
                        fit &= coarse[scheme] > 0
                    if not fit.any():
                        continue
                    mine = np.flatnonzero(fit)
                    part = elements[np.repeat(fit, sizes)]
                    found, of, less, capacity = signatures(part, sizes[mine], scheme[mine], bool(role & 2))
                    large = low[scheme[mine] + 1] - 1 if role & 1 else sizes[mine] * DOWN // UP
                    need = (sizes[mine] + large) * (DOWN - UP) // (DOWN + UP) + 1
                    signs.append(found)
                    who.append(mine[of] * 8 + role + 4 * less)
                    slack.append(np.stack([ids[mine], np.full(len(mine), role), capacity - need], 1).astype(np.int64))
                if not signs:
                    continue
                sign, owner = np.concatenate(signs), np.concatenate(who).astype(np.uint32)
                bucket = (sign >> np.uint64(40)).astype(np.int64) % buckets
                order = np.argsort(bucket, kind="stable")
                sign, owner, bucket = sign[order], owner[order], bucket[order]
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    local, back = np.unique(owner[a:b] >> 3, return_inverse=True)
                    packed = (back.astype(np.uint32) << np.uint32(3)) | (owner[a:b] & np.uint32(7))
                    rows.append((int(bucket[a]), ids[local].astype(np.int64).tobytes(), sign[a:b].tobytes(), packed.tobytes(), None))
                # slacks belong to no bucket: a hash deals them out
                rows.append((int(sign[0] & np.uint64(0xFFFFFFFF)) % buckets, None, None, None, np.concatenate(slack).tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def _match(most: int):
    """Of each bucket: stars of the sets that share a signature, their members, and slacks.

    Two sets that both left an element out need not meet, nor two that are both under the scheme of the
    band below.  Rows: kind 0 the first set a with a signature, and another set b; kind 1 a set a of a
    frequent signature c, one of more than ``most`` pairs, in role b, weight d; kind 2 slack c of set a in
    role b; kind 3 as kind 1, of another signature; with the first two, d = 0 if an element was left out.
    """

    def pack(kind: int, a, b, c, d) -> pa.RecordBatch:
        fill = np.zeros(len(a), np.int64)
        columns = [fill.astype(np.int32) + kind, *(fill if x is None else x for x in (a, b, c, d))]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["kind", "a", "b", "c", "d"])

    def match(parts) -> Iterator[pa.RecordBatch]:
        base, ids, signs, who = 0, [], [], []
        for i, s, w in parts:
            ids.append(np.frombuffer(i, np.int64))
            signs.append(np.frombuffer(s, np.uint64))
            who.append(np.frombuffer(w, np.uint32).astype(np.int64) + 8 * base)
            base += len(ids[-1])
        ids, sign, who = (np.concatenate(x) for x in (ids, signs, who))
        order = np.lexsort((ids[who >> 3], who >> 2 & 1, sign))  # of a signature: whole segments first, the smallest id first
        sign, who = sign[order], who[order]
        first = np.flatnonzero(np.concatenate([[True], sign[1:] != sign[:-1]]))
        count = np.diff(first, append=len(sign))
        whole = np.add.reduceat(1 - (who >> 2 & 1), first)
        upper = np.add.reduceat(who & 1, first)
        use = (count > 1) & (whole > 0) & (upper < count)
        pairs = whole * count
        often = use & (whole > 1) & (pairs > most)

        star = np.repeat(use & ~often, count)
        hub = np.repeat(who[first], count)[star] >> 3
        edge = np.stack([ids[hub], ids[who[star] >> 3]], 1)
        edge = np.unique(edge[edge[:, 0] != edge[:, 1]], axis=0)
        if len(edge):
            yield pack(0, edge[:, 0], edge[:, 1], None, None)

        few = use & ~often & (whole > 1) & (count > 2)  # groups with the same members count once
        if few.any():
            prints = np.add.reduceat(mixed(ids[who >> 3].astype(np.uint64) * np.uint64(8) + (who & 5).astype(np.uint64)), first)
            _, one = np.unique(prints[few], return_index=True)
            kept = np.zeros(len(first), bool)
            kept[np.flatnonzero(few)[one]] = True
            mine = np.repeat(kept, count)
            yield pack(3, ids[who[mine] >> 3], who[mine] & 3, np.repeat(prints, count)[mine].view(np.int64), 1 - (who[mine] >> 2 & 1))
        if often.any():
            mine = np.repeat(often, count)
            part = who[mine]
            # a segment counts 2 in a coarse scheme, of which one signature without an element is 1
            weight = 1 + ((part >> 1 & 1) & ~(part >> 2) & 1)
            yield pack(1, ids[part >> 3], part & 3, sign[mine].view(np.int64), weight * 2 + 1 - (part >> 2 & 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            for bucket, ids, signs, who, slack in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if slack is not None:
                    rows = np.frombuffer(slack, np.int64).reshape(-1, 3)
                    yield pack(2, rows[:, 0], rows[:, 1], rows[:, 2], None)
                    continue
                if bucket != now and parts:
                    yield from match(parts)
                    parts = []
                now = bucket
                parts.append((ids, signs, who))
        if parts:
            yield from match(parts)

    return run


def _narrow(words: np.ndarray, width: int) -> np.ndarray:
    """Rows of sketches folded to ``width`` words."""
    while words.shape[1] > width:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


def _near(rows: list[tuple], low: int, high: int) -> np.ndarray:
    """Pairs of two chunks of a signature's sets that are in different components and may link, by their sketches.

    Rows: id, role, whole, label, size, sketch, chunk.
    """
    ids, role, whole, label, size, _, chunk = (np.array(c) if i != 5 else None for i, c in enumerate(zip(*rows, strict=True)))
    width = np.array([len(r[5]) // 8 for r in rows])
    found = [np.zeros((0, 2), np.int64)]
    for narrow in np.unique(width):
        for wide in (narrow, 2 * narrow):
            x, y = np.flatnonzero(width == narrow), np.flatnonzero(width == wide)
            if not len(x) or not len(y):
                continue
            p, q = (_narrow(np.frombuffer(b"".join(rows[i][5] for i in part), np.uint64).reshape(len(part), -1), narrow) for part in (x, y))
            step = max(1, (1 << 21) // (len(y) * int(narrow)))
            for at in range(0, len(x), step):
                i = x[at : at + step]
                apart = np.bitwise_count(p[at : at + step, None] ^ q[None]).sum(2, dtype=np.int64)
                total = size[i, None] + size[y]
                good = apart <= total * (DOWN - UP) // (DOWN + UP)
                good &= (label[i, None] != label[y]) & (role[i, None] + role[y] < 2) & (whole[i, None] + whole[y] > 0)
                good &= np.minimum(size[i, None], size[y]) * DOWN >= np.maximum(size[i, None], size[y]) * UP
                if low != high:
                    good &= chunk[i, None] != chunk[y]
                a, b = np.nonzero(good)
                pair = np.stack([ids[i[a]], ids[y[b]]], 1)
                found.append(np.sort(pair, 1))
    return np.unique(np.concatenate(found), axis=0)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of ``_near`` of all chunk pairs of a task, each once as far as they are held together."""
    key, rows, held = None, [], [np.zeros((0, 2), np.int64)]

    def out(pairs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    for batch in batches:
        for sign, low, high, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != (sign, low, high):
                if len(rows) > 1:
                    held.append(_near(rows, *key[1:]))
                    if sum(map(len, held)) > 1_000_000:
                        held = [np.unique(np.concatenate(held), axis=0)]
                        if len(held[0]) > 500_000:
                            yield out(held.pop())
                            held = [np.zeros((0, 2), np.int64)]
                key, rows = (sign, low, high), []
            rows.append(tuple(row))
    if len(rows) > 1:
        held.append(_near(rows, *key[1:]))
    yield out(np.unique(np.concatenate(held), axis=0))


def _screen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches do not show that they differ too much."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        keep = [
            min(n, m) * DOWN >= max(n, m) * UP and sketches_apart(s, t) <= most_apart(n, m)
            for n, m, s, t in zip(*columns[2:], strict=True)
        ]
        yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of texts whose shingle sets link."""

    def sets(column: pa.Array) -> list[np.ndarray]:
        out = []
        for _, data, bounds in slices(column):
            elements, edges = shingles(data, bounds)
            out += [elements[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
        return out

    forget_encoders()
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            names = part.column(0).to_numpy(zero_copy_only=False)
            _, first, back = np.unique(names, return_index=True, return_inverse=True)
            left = sets(part.column(2).take(pa.array(first)))  # the same text stands on the left of many pairs
            keep = []
            for x, y in zip((left[i] for i in back), sets(part.column(3)), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(both) and both * DOWN >= (len(x) + len(y) - both) * UP)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in part.columns[:2]], ["a", "b"])


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after more links; ``links`` are between ids, or labels if there are labels already."""
    if labels is None:
        return written(components(links), "labels")
    name = labels.select(F.col("id").alias("x"), F.col("component").alias("c"))
    on = lambda df, c: df.join(name.withColumnRenamed("x", c).withColumnRenamed("c", f"{c}_c"), c, "left").withColumn(c, F.coalesce(f"{c}_c", c)).drop(f"{c}_c")
    more = components(on(on(links, "a"), "b").select("a", "b"))
    known = labels.union(links.select("a", "a").union(links.select("b", "b")).distinct().join(labels, F.col("a") == F.col("id"), "left_anti"))
    moved = known.join(more.select(F.col("id").alias("component"), F.col("component").alias("to")), "component", "left")
    return written(moved.select("id", F.coalesce("to", "component").alias("component")), "labels")


def _apart(labels: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that are not yet in one component."""
    name = lambda c: labels.select(F.col("id").alias(c), F.col("component").alias(f"{c}_label"))
    both = pairs.join(name("a"), "a", "left").join(name("b"), "b", "left")
    return both.filter(F.coalesce("a_label", "a") != F.coalesce("b_label", "b")).select("a", "b")


def link_texts(
    docs: DataFrame,
    often: int = 600,
    chunk: int = 2048,
    bucket_rows: int = 1_000_000,
    filter_bits: int = 1 << 22,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_rows: int = 500,
) -> DataFrame:
    """Components of the texts whose sets of 5-word shingles have a Jaccard similarity of 0.75 or more.

    Words are runs of characters other than ASCII blanks, A-Z in lower case.  Texts with
    equal sets are one class, and one of each class goes on.  Its shingles are dealt by hash into segments, as many as its size band
    has (``bands``), and each segment's content is a signature: linked sets differ in fewer
    elements than the segments could show, so they share one.  A signature of more than ``often`` pairs is passed over
    for the sets that have enough others.  The sets of a signature are first compared with one of them; only sets that
    are in different components after that are compared with each other, so copies of one text are not paired.
    Pairs are screened by parity sketches, which lose none, and verified on the texts.  Packed signatures and pairs of texts are large rows, so tasks hold ``batch_rows`` of
    them at once.

    Hashes have 64 bits (128 for whole sets), so a result is exact unless they collide, or unless all of a
    set's elements fall into too few segments (four deviations from the mean in either scheme, both sets).  Returns one row per
    input row: id, ``n_shingles``, ``component_id`` (smallest id reachable).  A text without words is
    empty and links with nothing, as does a null id; rows that repeat an id must repeat its text.  No other column is read.
    """
    with arrow_batches(docs.sparkSession, batch_rows):
        return _linked(docs, often, chunk, bucket_rows, filter_bits, id_col, text_col)


def _linked(docs: DataFrame, often: int, chunk: int, bucket_rows: int, filter_bits: int, id_col: str, text_col: str) -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sets = written(rows.mapInArrow(_measure, "id long, n long, print binary, sketch binary"), "sets")
    real = sets.filter("n > 0 AND id IS NOT NULL")
    classes = written(real.groupBy("print").agg(F.min("id").alias("rep"), F.count("*").alias("rows")).filter("rows > 1"), "classes")
    copies = written(real.join(classes.select("print", "rep"), "print").filter("id <> rep").select("id", "rep").distinct(), "copies")

    # one text per id, however often its row is repeated
    again = real.groupBy("id").count().filter("count > 1")
    repeated = written(slot_bitmap(again, F.xxhash64("id"), filter_bits), "repeated")
    told = in_bitmap(rows.filter("id IS NOT NULL"), F.xxhash64("id"), repeated, filter_bits)
    texts = told.filter("NOT hit").select("id", "text").union(told.filter("hit").select("id", "text").dropDuplicates(["id"]))

    # texts of copies are left out: what the bitmap does not hold is read in place, the rest is compared by id
    slots = written(slot_bitmap(copies, F.xxhash64("id"), filter_bits), "slots")
    marked = in_bitmap(texts, F.xxhash64("id"), slots, filter_bits)
    distinct = marked.filter("hit").join(copies.select("id"), "id", "left_anti").select("id", "text")
    single = marked.filter("NOT hit").select("id", "text").union(distinct)
    total = real.agg(F.sum("n")).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * tasks, -(-total // bucket_rows))
    schema = "bucket int, ids binary, signs binary, who binary, slack binary"
    # buckets are dealt round, so no task has more of them than another
    dealt = single.mapInArrow(_index(buckets), schema).repartitionById(tasks, F.col("bucket") % tasks).sortWithinPartitions("bucket")
    found = written(dealt.mapInArrow(_match(often), "kind int, a long, b long, c long, d long"), "found")

    frequent = found.filter("kind = 1").selectExpr("a", "b AS role", "c AS sign", "d DIV 2 AS weight", "d % 2 AS whole")
    slack = found.filter("kind = 2").selectExpr("a AS of", "b AS in_role", "c AS slack")
    spent = frequent.groupBy("a", "role").agg(F.sum("weight").alias("weight"))
    tight = slack.join(spent, (F.col("a") == F.col("of")) & (F.col("role") == F.col("in_role")), "left")
    tight = tight.filter("coalesce(weight, 0) > slack").select(F.col("of").alias("a"), F.col("in_role").alias("role"))
    # a set is bound to its frequent signatures if neither of its schemes has enough others; those of the fine scheme hold all partners
    schemes = slack.filter("in_role >= 2").selectExpr("of AS a", "in_role - 2 AS role", "2 AS schemes")
    bound = tight.groupBy("a", F.expr("role % 2").alias("role")).agg(F.count("*").alias("n"), F.min("role").alias("least"))
    bound = bound.join(schemes, ["a", "role"], "left").filter("least < 2 AND n = coalesce(schemes, 1)")
    bound = written(bound.select(F.col("a").alias("of"), F.col("role").alias("in_role")), "bound")
    crowd = frequent.join(bound, (F.col("a") == F.col("of")) & (F.col("role") == F.col("in_role"))).select("sign", "a", "role", "whole")
    few = found.filter("kind = 3").selectExpr("c AS sign", "a", "b % 2 AS role", "d AS whole")
    # signatures that the same sets share count once
    who = F.xxhash64("a", "role", "whole")
    every = crowd.union(few)
    sums = every.groupBy("sign").agg(F.count("*").alias("n"), F.sum(who.cast("decimal(38,0)")).alias("sum"), F.bit_xor(who).alias("xor"))
    groups = sums.filter("n > 1").groupBy("n", "sum", "xor").agg(F.min("sign").alias("sign")).select("sign")
    members = written(every.join(written(groups, "groups"), "sign"), "members")

    known = written(real.select("id", "n", "sketch").dropDuplicates(["id"]), "known")

    def screened(pairs: DataFrame) -> DataFrame:
        side = lambda c: known.select(*[F.col(x).alias(y) for x, y in (("id", c), ("n", f"n_{c}"), ("sketch", f"sketch_{c}"))])
        both = pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        both = both.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
        return written(both.mapInArrow(_screen, "a long, b long"), "screened")

    def verified(pairs: DataFrame) -> DataFrame:
        # few texts are in a pair: a bitmap leaves the others out before texts are shuffled
        ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
        wanted = written(slot_bitmap(ends, F.xxhash64("id"), filter_bits), "wanted")
        some = in_bitmap(texts, F.xxhash64("id"), wanted, filter_bits, "paired").filter("paired")
        side = lambda c: some.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}"))
        both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "text_a", "text_b")
        return written(both.mapInArrow(_verify, "a long, b long"), "verified")

    def opened(labels: DataFrame) -> DataFrame:
        """The members of signatures whose sets are in several components."""
        label = labels.select(F.col("id").alias("a"), F.col("component").alias("label"))
        named = members.join(label, "a", "left").select("sign", "a", "role", "whole", F.coalesce("label", "a").alias("label"))
        several = named.groupBy("sign").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("many"))
        return written(named.join(several.filter("low < high").select("sign", "many"), "sign"), "open")

    stars = found.filter("kind = 0").select("a", "b").union(
        crowd.groupBy("sign").agg(F.min("a").alias("hub")).join(crowd, "sign").filter("a <> hub").select(F.col("hub").alias("a"), F.col("a").alias("b"))
    )
    # of each text the star with the smallest partner first; then those that are still apart
    stars = written(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "stars")
    labels = _merged(None, verified(screened(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))))
    labels = _merged(labels, verified(screened(_apart(labels, stars))))
    for turn in range(3):
        left = opened(labels)
        if not left.head(1):
            break
        if turn < 2:  # another first set
            lead = left.filter("whole = 1").groupBy("sign").agg(
                F.min(F.struct(F.xxhash64("a", F.lit(turn)), "a", "label")).alias("lead")
            )
            across = left.join(lead.select("sign", "lead.label", F.col("lead.a").alias("b")).withColumnRenamed("label", "label_b"), "sign")
            across = screened(across.filter("label <> label_b").select("a", "b"))
        else:  # what is still apart, each with each: by their sketches within a task, a chunk of a signature's sets with another
            parts = left.join(known.withColumnRenamed("id", "a"), "a").withColumn("chunks", F.ceil(F.col("many") / chunk))
            parts = parts.withColumn("chunk", F.pmod(F.xxhash64("a"), F.col("chunks")))
            parts = parts.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
            parts = parts.select(
                "sign", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
                "a", "role", "whole", "label", "n", "sketch", "chunk",
            )
            parts = parts.repartition(tasks, "sign", "low", "high").sortWithinPartitions("sign", "low", "high")
            across = written(parts.mapInArrow(_across, "a long, b long").distinct(), "across")
        labels = _merged(labels, verified(across))

    final = sets.select("id", "n").join(copies.withColumnRenamed("id", "copy"), F.col("id") == F.col("copy"), "left")
    final = final.withColumn("rep", F.coalesce("rep", "id")).join(
        labels.select(F.col("id").alias("of"), "component"), F.col("rep") == F.col("of"), "left"
    )
    return final.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
