"""Token ids in shards compressed by a Re-Pair grammar, with random access to documents."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.llm.common import written
from tallyforge.llm.shared_files import create, fresh_file, open_random
from tallyforge.llm.tokens import encoder, slices, with_end
from tallyforge.session import scratch_path

MAGIC = b"TFRP0001"
_HEADER = struct.Struct("<8sIIQQQ")  # magic, first nonterminal, bytes of a symbol, rules, documents, symbols

#: Pairs are replaced down to this count; a rule with its length takes the room of about four symbols.
LEAST = 4


def _odd(at: np.ndarray, following: np.ndarray, equal: np.ndarray) -> np.ndarray:
    """Of pairs of equal symbols, those that every other one of their run leaves out."""
    n = np.arange(len(at))
    linked = np.concatenate([[False], (at[1:] == following[:-1]) & equal[1:] & equal[:-1]])
    return equal & ((n - np.maximum.accumulate(np.where(linked, 0, n))) & 1 == 1)


def _chosen(at: np.ndarray, following: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which of the pairs that start ``at`` are taken: heavier ones first, none that overlap, and as many as then fit.

    ``following`` is the place after each.  Pairs that overlap have different weights.
    """
    taken, left = np.zeros(len(at), bool), np.arange(len(at))
    beside = at[1:] == following[:-1]
    while len(left):
        rise = weight[1:] > weight[:-1]
        win = np.ones(len(left), bool)
        win[1:] &= rise | ~beside
        win[:-1] &= ~(rise & beside)
        taken[left[win]] = True
        stay = ~win
        stay[1:] &= ~(win[:-1] & beside)
        stay[:-1] &= ~(win[1:] & beside)
        beside = (beside & stay[1:])[stay[:-1]][: max(0, int(stay.sum()) - 1)]
        left, weight = left[stay], weight[stay]
    return taken


class _Text:
    """Symbols in a chain, the number of the pair that starts at each (0: too rare, or the end of a document), counts of pairs."""

    def __init__(self, ids: np.ndarray, last: np.ndarray, least: int):
        self.symbols, self.last, self.least = ids, last, least
        self.pairs = np.zeros(len(ids), np.int32)
        self.counts = np.zeros(1, np.int64)
        at = np.flatnonzero(~last)
        if len(at):
            self._number(at, (ids[at].astype(np.uint64) << np.uint64(32)) | ids[at + 1])
        self.alive = np.ones(len(ids), bool)
        self._chain()

    def _number(self, at: np.ndarray, codes: np.ndarray) -> None:
        """Give pairs that were never seen before their numbers; one that is too rare now will always be."""
        bits = max(1, len(codes) - 1).bit_length()
        size = int(self.symbols.max()).bit_length()
        if 2 * size + bits <= 64:  # place and pair in one number, so that one sort of numbers groups the places
            packed = ((codes >> np.uint64(32) << np.uint64(size) | (codes & np.uint64(0xFFFFFFFF))) << np.uint64(bits)) | np.arange(
                len(codes), dtype=np.uint64
            )
            packed.sort()
            order, keys = (packed & np.uint64((1 << bits) - 1)).astype(np.int64), packed >> np.uint64(bits)
        else:
            order = np.argsort(codes, kind="stable")
            keys = codes[order]
        edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        many = np.diff(edges)
        often = many >= self.least
        number = np.where(often, len(self.counts) - 1 + np.cumsum(often), 0)
        self.pairs[at[order]] = np.repeat(number, many)
        self.counts = np.concatenate([self.counts, many[often]])

    def _chain(self) -> None:
        self.after = np.arange(1, len(self.symbols) + 1, dtype=np.int32)
        self.before = np.arange(-1, len(self.symbols), dtype=np.int32)

    def pack(self, most: float = 0.75) -> None:
        """Drop the places that are no longer used, if they are many."""
        if self.alive.mean() > most:
            return
        self.symbols, self.last, self.pairs = self.symbols[self.alive], self.last[self.alive], self.pairs[self.alive]
        self.alive = np.ones(len(self.symbols), bool)
        self._chain()

    def replace(self, at: np.ndarray, new: np.ndarray) -> np.ndarray:
        """Put ``new`` for the pairs at these places; counts change beside them only.  Returns the places with new pairs."""
        gone = self.after[at]
        self.alive[gone] = False
        left = self.before[at]
        left = left[left >= 0]
        old = self.pairs[np.concatenate([at, gone, left[self.alive[left]]])]
        np.subtract.at(self.counts, old[old > 0], 1)
        self.symbols[at], self.last[at], self.pairs[gone] = new, self.last[gone], 0
        self.after[at] = self.after[gone]
        self.before[self.after[gone]] = at  # one place more than symbols, for the end
        left = self.before[at]
        left = left[left >= 0]
        left = left[self.symbols[left] < new.min()]
        places = np.concatenate([at, left])
        ends = self.last[places]
        self.pairs[places[ends]] = 0
        places = places[~ends]
        if len(places):
            right = self.symbols[self.after[places]]
            self._number(places, (self.symbols[places].astype(np.uint64) << np.uint64(32)) | right)
        return places


def compress(ids: np.ndarray, bounds: np.ndarray, least: int = LEAST):
    """Replace pairs by nonterminals, frequent ones first, until none can be replaced ``least`` times; no pair crosses documents.

    Pairs are counted once; afterwards only the counts beside replaced places change.  The queue of pairs has a level for
    each halving of the count: all pairs of a level are replaced together, where they overlap the more frequent one,
    and pairs that come up on the way and reach the level are too.  Runs of one symbol are paired from the left.

    Returns the symbols, the bounds of the documents in them, the first nonterminal and
    the rules, a row of two symbols each.  A nonterminal's rule has smaller symbols only.
    """
    first = int(ids.max(initial=0)) + 1
    last = np.zeros(len(ids), bool)
    last[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = True
    text = _Text(ids.astype(np.uint32), last, least)
    rules: list[np.ndarray] = []
    new, level = first, int(text.counts.max())
    while level >= least:
        final = level // 2 <= least
        level = max(least, level // 2)
        text.pack()
        at = np.flatnonzero((text.counts >= level)[text.pairs])
        while len(at):
            pairs, after, many = text.pairs[at], text.after[at], text.counts
            equal, odd = text.symbols[at] == text.symbols[after], np.zeros(len(at), bool)
            if equal.any():
                odd = _odd(at, after, equal)
                many = many.copy()
                many[pairs[equal]] = np.bincount(pairs[equal & ~odd], minlength=len(many))[pairs[equal]]
            fit = np.flatnonzero(~odd & (many[pairs] >= level))
            if not len(fit):
                break
            # a pair waits for the more frequent ones that it overlaps, or repeats would be cut across their ends
            count, beside = many[pairs[fit]], at[fit[1:]] == after[fit[:-1]]
            waits = np.zeros(len(fit), bool)
            waits[1:] = beside & (count[1:] < count[:-1])
            waits[:-1] |= beside & (count[:-1] < count[1:])
            fit = fit[~waits]
            weight = (many[pairs[fit]] << 32) - pairs[fit]
            taken = fit[_chosen(at[fit], after[fit], weight)]
            used = np.bincount(pairs[taken], minlength=len(many))
            taken = taken[(used >= least)[pairs[taken]]]  # the heaviest pair is always among them
            here, pair = at[taken], pairs[taken]
            some = np.flatnonzero(used >= least)
            some = some[np.argsort(-many[some], kind="stable")]
            number, place = np.zeros((2, len(many)), np.int64)
            number[some], place[pair] = new + np.arange(len(some)), here
            one = place[some]
            rules.append(np.stack([text.symbols[one], text.symbols[text.after[one]]], 1))
            fresh = text.replace(here, number[pair].astype(np.uint32))
            new += len(some)
            at = np.concatenate([np.delete(at, taken), fresh])
            at = at[(text.counts >= level)[text.pairs[at]] & text.alive[at]]
            at.sort()
            at = at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at
        if final:
            break
    text.pack(most=1)
    ends = np.concatenate([[0], np.flatnonzero(text.last) + 1])
    many = np.cumsum(np.concatenate([[0], bounds[1:] > bounds[:-1]]))
    return text.symbols, ends[many], first, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)


def expansions(first: int, rules: np.ndarray) -> np.ndarray:
    """Number of ids that each nonterminal stands for."""
    lengths: list[int] = []
    for a, b in rules.tolist():
        lengths.append((lengths[a - first] if a >= first else 1) + (lengths[b - first] if b >= first else 1))
    return np.array(lengths, np.int64)


def expand(symbols: np.ndarray, first: int, rules: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
    """The ids that symbols stand for; ``lengths`` are the rules' expansions, if they are known."""
    lengths = expansions(first, rules) if lengths is None else lengths
    size_of = np.concatenate([np.ones(first, np.int64), lengths])
    ends = np.cumsum(size_of[symbols])
    places = ends - size_of[symbols]
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
    while len(symbols):
        ruled = symbols >= first
        out[places[~ruled]] = symbols[~ruled]
        left, right = rules[symbols[ruled] - first].T
        at = places[ruled]
        symbols, places = np.concatenate([left, right]), np.concatenate([at, at + size_of[left]])
    return out


def _narrow(symbols: np.ndarray, wide: int) -> bytes:
    """The low ``wide`` bytes of each symbol."""
    return symbols.astype("<u4").view("<u1").reshape(-1, 4)[:, :wide].tobytes()


def _widened(raw: bytes, wide: int) -> np.ndarray:
    out = np.zeros((len(raw) // wide, 4), "<u1")
    out[:, :wide] = np.frombuffer(raw, "<u1").reshape(-1, wide)
    return out.reshape(-1).view("<u4")


def write_shard(out, doc_ids: list[int | None], ids: np.ndarray, bounds: np.ndarray) -> None:
    """Header, rules, expansion lengths, document ids with a null flag, places and counts of documents, symbols."""
    symbols, places, first, rules = compress(ids, bounds)
    wide = 2 if first + len(rules) <= 1 << 16 else 3 if first + len(rules) <= 1 << 24 else 4
    out.write(_HEADER.pack(MAGIC, first, wide, len(rules), len(doc_ids), len(symbols)))
    out.write(rules.astype("<u4").tobytes())
    out.write(expansions(first, rules).astype("<u4").tobytes())
    out.write(np.array([0 if i is None else i for i in doc_ids], "<i8").tobytes())
    out.write(np.array([i is None for i in doc_ids], "<u1").tobytes())
    out.write(places.astype("<u8").tobytes())
    out.write(bounds.astype("<u8").tobytes())
    out.write(_narrow(symbols, wide))
    out.close()


class Shard:
    """A shard file; reads the rules and the index, then symbols of the documents that are asked for."""

    def __init__(self, source):
        self.source = source
        magic, self.first, self.wide, rules, docs, self.symbols = _HEADER.unpack(source.read_at(_HEADER.size, 0))
        if magic != MAGIC:
            raise ValueError("not a shard of token ids")
        self.at = _HEADER.size
        self.rules = self._take("<u4", 2 * rules).reshape(-1, 2)
        self.lengths = self._take("<u4", rules)
        ids, absent = self._take("<i8", docs), self._take("<u1", docs)
        self.doc_ids = [None if gone else int(i) for i, gone in zip(ids, absent, strict=True)]
        self.places = self._take("<u8", docs + 1).astype(np.int64)
        self.bounds = self._take("<u8", docs + 1).astype(np.int64)

    def _take(self, kind: str, many: int) -> np.ndarray:
        size = many * np.dtype(kind).itemsize
        found = np.frombuffer(self.source.read_at(size, self.at), kind)
        self.at += size
        return found

    def documents(self, low: int, high: int) -> np.ndarray:
        """Ids of the documents number ``low`` to ``high`` (exclusive), one after the other."""
        start, stop = int(self.places[low]), int(self.places[high])
        raw = self.source.read_at((stop - start) * self.wide, self.at + start * self.wide)
        return expand(_widened(raw, self.wide), self.first, self.rules, self.lengths)

    def span(self, doc: int, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of one document; symbols before and after are passed over by their lengths."""
        low, high = int(self.places[doc]), int(self.places[doc + 1])
        raw = self.source.read_at((high - low) * self.wide, self.at + low * self.wide)
        symbols = _widened(raw, self.wide).astype(np.int64)
        ruled = symbols >= self.first
        sizes = np.ones(len(symbols), np.int64)
        sizes[ruled] = self.lengths[symbols[ruled] - self.first]
        ends = np.cumsum(sizes)
        a, b = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(ends, stop, "left")) + 1
        before = int(ends[a - 1]) if a else 0
        return expand(symbols[a:b], self.first, self.rules, self.lengths)[start - before : stop - before]


def _writer(path: str, end: int, folder: str, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []
        held, rows = 0, []

        def flush() -> None:
            nonlocal held
            name = fresh_file(folder, ".rp")
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            write_shard(create(name), doc_ids, np.concatenate(parts), bounds)
            rows.append((name, len(rows), held))
            doc_ids.clear(), parts.clear(), sizes.clear()
            held = 0

        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, data, bounds in slices(batch.column(1)):
                ids, ends = with_end(*encode(data, bounds), end)
                doc_ids += names[first : first + len(ends) - 1]
                parts.append(ids)
                sizes.append(np.diff(ends))
                held += len(ids)
                if held >= shard_tokens:
                    flush()
        if held:
            flush()
        if rows:
            part = TaskContext.get().partitionId()
            paths, numbers, tokens = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths), pa.array([part] * len(rows)), pa.array(numbers), pa.array(tokens)],
                ["path", "part", "shard", "tokens"],
            )

    return run


def _reader(read_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with open_random(path) as source:
                    shard = Shard(source)
                    bounds, low = shard.bounds, 0
                    while low < len(shard.doc_ids):
                        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + read_tokens, "right")) - 1)
                        raw = memoryview(shard.documents(low, high).astype("<u4").tobytes())
                        cut = 4 * (bounds[low : high + 1] - bounds[low])
                        crc = [zlib.crc32(raw[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(shard.doc_ids[low:high], pa.int64()),
                                pa.array(base + bounds[low:high]),
                                pa.array(np.diff(bounds[low : high + 1])),
                                pa.array(crc, pa.int64()),
                            ],
                            ["id", "start", "n_tokens", "ids_crc32"],
                        )
                        low = high

    return run


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    folder: str | None = None,
    shard_tokens: int = 2_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Write the ids of all documents in ascending order of id; returns the manifest.

    The documents are range-partitioned by id and sorted, so the shards of one task
    follow one another and those of the next task follow them.  Each shard of about
    ``shard_tokens`` ids is compressed by itself.  Manifest: path, ``base`` (ids in all shards
    before), ``tokens``.  A null text counts as empty and gives ``end_id`` only; null ids come first;
    rows with one id stand next to each other, and many of them are spread over tasks.  Each shard is
    compressed until no pair of symbols can be replaced LEAST times.  A lost attempt leaves a file that no manifest names.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    ordered = rows.repartitionByRange(tasks, "id", "row").sortWithinPartitions("id", "row").drop("row")
    schema = "path string, part long, shard long, tokens long"
    shards = written(ordered.mapInArrow(_writer(tokenizer, end_id, folder, shard_tokens), schema), "shards")
    # one row per task is accumulated over all, then one row per shard within its task
    before = lambda w: F.coalesce(F.sum("tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks_done = shards.groupBy(F.col("part").alias("of")).agg(F.sum("tokens").alias("tokens"))
    tasks_done = written(tasks_done.select("of", before(Window.orderBy("of")).alias("first")), "parts")
    inside = shards.withColumn("inside", before(Window.partitionBy("part").orderBy("shard")))
    joined = inside.join(tasks_done, inside["part"] == tasks_done["of"])
    return written(joined.select("path", (F.col("first") + F.col("inside")).alias("base"), "tokens"), "manifest")


def read_tokens(manifest: DataFrame, read_at_once: int = 500_000) -> DataFrame:
    """Documents of the shards in ``path``: id, ``start``, ``n_tokens``, ``ids_crc32`` of the decoded ids."""
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paths = manifest.select("path", "base").repartition(tasks)
    return paths.mapInArrow(_reader(read_at_once), "id long, start long, n_tokens long, ids_crc32 long")
