"""Token ids of many texts with the tokenizers library; words met before are looked up."""

from __future__ import annotations

import ctypes
import gc
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

#: Bytes of text that are handled at once.
SLICE = 1 << 20
#: Longer pieces are encoded without the table.
LONGEST = 48
#: A power of two of places, each with the last piece that was found there.
SLOTS = 1 << 18

_rng = np.random.default_rng(20_240_601)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 1 << 63, LONGEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in '!"#$%&()*+,-./:;=?@|_']] = True
#: Bytes that a word can start with after a blank; lead bytes of other blanks are left out.
_OPENS = np.zeros(256, bool)
_OPENS[[*range(33, 127), *range(0xC3, 0xE0), *range(0xE4, 0xF5)]] = True


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string array (null: empty) and the bounds of its rows."""
    filled = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    body = filled.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``most`` bytes: first row, bytes, bounds.  One row is never cut."""
    data, bounds = text_bytes(texts)
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + most, "right")) - 1)
        yield first, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + np.uint8(32) * ((data >= 65) & (data <= 90))


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    hashes = (hashes ^ (hashes >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    hashes = (hashes ^ (hashes >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return hashes ^ (hashes >> np.uint64(31))


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and 64-bit hashes of the words (runs of bytes other than ASCII blanks) of a slice."""
    word = ~_BLANK[data]
    starts, ends = word.copy(), word.copy()
    starts[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    edge = bounds[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    starts[edge] = word[edge]
    ends[edge - 1] = word[edge - 1]
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    if not len(first):
        return first, last, np.zeros(0, np.uint64)
    sizes = last - first
    at = np.flatnonzero(word)
    begins = np.cumsum(sizes) - sizes
    inside = np.arange(len(at)) - np.repeat(begins, sizes)
    far = np.uint64(0x9E3779B97F4A7C15) * (inside // LONGEST).astype(np.uint64)
    hashes = np.add.reduceat(mixed(_BYTE[data[at]] + far) * _PLACE[inside % LONGEST], begins)
    return first, last, mixed(hashes + sizes.astype(np.uint64))


#: Hashes of pieces are polynomials of this; its inverse modulo 2**64 brings a piece to place zero.
_BASE = 0x9FB21C651E98DF25
_UNBASE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=2)
def _powers(base: int, many: int) -> np.ndarray:
    out = np.full(many, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def piece_hashes(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of the pieces that begin at ``starts`` and cover the data."""
    room = -(-len(data) // SLICE) * SLICE
    sums = np.add.reduceat(_BYTE[data] * _powers(_BASE, room)[: len(data)], starts)
    return mixed(sums * _powers(_UNBASE, room)[starts] + sizes.astype(np.uint64))


def byte_letters() -> dict[int, int]:
    """The character that byte-level vocabularies write for each byte: itself if it is visible in Latin-1, else the next from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: b for b in visible} | {b: 256 + i for i, b in enumerate(hidden)}


_LETTERS = byte_letters()
#: A blank and Latin letters.
_WORD = re.compile(" [A-Za-zÀ-ÖØ-öø-ɏ]+")


class Encoder:
    """Encodes as ``Tokenizer.encode(text, add_special_tokens=False)`` does, piece by piece.

    Texts are cut where no token of the byte-level or word-level BPE files can cross:
    before a blank that precedes a word, and between an ASCII letter and a mark.
    Pieces are found again by a 64-bit hash, most of them in a table with a place for each of its low bits.  A text that holds "<|" is not cut.
    At most ``entries`` pieces are remembered.
    """

    def __init__(self, path: str, entries: int = 1_000_000):
        self.tokenizer = Tokenizer.from_file(path)
        normalizer = getattr(self.tokenizer, "normalizer", None)
        self.lower = normalizer is not None and "Lowercase" in repr(normalizer)
        self.entries = entries
        rules = json.loads(self.tokenizer.to_str())
        before = rules["pre_tokenizer"] or {}
        self.bare = None
        if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not rules["normalizer"]:
            # a blank and letters are one word of such a vocabulary, so its merges alone give the ids
            self.bare = Tokenizer.from_str(json.dumps(rules | {"pre_tokenizer": None, "post_processor": None, "added_tokens": []}))
            self.sizes = np.zeros(1 + max(rules["model"]["vocab"].values()), np.int64)  # bytes of each token
            self.sizes[[*rules["model"]["vocab"].values()]] = [len(token) for token in rules["model"]["vocab"]]
        self._forget()

    def _forget(self) -> None:
        self.known, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.last, self.last_number = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int32)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _whole(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        return np.array(list(chain.from_iterable(coded)), np.uint32), np.fromiter(map(len, coded), np.int64, len(coded))

    def _coded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and how many each has."""
        plain = [_WORD.fullmatch(p) is not None for p in pieces] if self.bare else [False]
        if not any(plain):
            return self._whole(pieces)
        plain = np.array(plain)
        words = "\n".join(p for p, one in zip(pieces, plain.tolist(), strict=True) if one)
        words = words.encode().decode("latin-1").translate(_LETTERS).split(chr(_LETTERS[10]))
        whole = self.bare.encode_batch_fast([words], is_pretokenized=True, add_special_tokens=False)[0]
        ids = np.array(whole.ids, np.uint32)
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(w) for w in words])) + 1
        counts = np.zeros(len(pieces), np.int64)
        counts[plain] = np.diff(ends, prepend=0)
        if not plain.all():
            rest, counts[~plain] = self._whole([p for p, one in zip(pieces, plain.tolist(), strict=True) if not one])
            of_word = np.repeat(plain, counts)
            both = np.empty(len(of_word), np.uint32)
            both[of_word], both[~of_word] = ids, rest
            ids = both
        return ids, counts

    def _add(self, pieces: list[str]) -> np.ndarray:
        """Encode new pieces; their numbers."""
        flat, counts = self._coded(pieces)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(flat)), np.uint32)])
        self.ids[self.used : self.used + len(flat)] = flat
        numbers = len(self.start) + np.arange(len(pieces))
        self.start = np.concatenate([self.start, self.used + np.cumsum(counts) - counts])
        self.count = np.concatenate([self.count, counts])
        self.used += len(flat)
        return numbers

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and the bounds of the rows in them."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        if self.lower:
            data = lower_ascii(data)
        cut = np.zeros(len(data), bool)
        cut[:-1] = (data[:-1] == 32) & _OPENS[data[1:]]
        letter, mark = _LETTER[data], _MARK[data]
        cut[1:] |= (letter[:-1] & mark[1:]) | (mark[:-1] & letter[1:])
        special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
        for row in np.unique(np.searchsorted(bounds, special, "right") - 1):
            cut[bounds[row] : bounds[row + 1]] = False
        cut[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
        starts = np.flatnonzero(cut)
        sizes = np.diff(starts, append=len(data))
        hashes = piece_hashes(data, starts, sizes)

        if len(self.known) > self.entries:
            self._forget()
        short = sizes <= LONGEST
        slot = (hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        number = self.last_number[slot].astype(np.int64)
        rest = np.flatnonzero(short & ((self.last[slot] != hashes) | (hashes == 0)))
        distinct, first, back = np.unique(hashes[rest], return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        at_known = np.minimum(at, max(0, len(self.known) - 1))
        found = (self.known[at_known] == distinct) if len(self.known) else np.zeros(len(distinct), bool)
        value = np.empty(len(distinct), np.int64)
        value[found] = self.place[at_known[found]]
        raw = data.tobytes()

        def texts_at(which: np.ndarray) -> list[str]:
            low = starts[which]
            return [raw[a:b].decode("utf-8", "replace") for a, b in zip(low.tolist(), (low + sizes[which]).tolist(), strict=True)]

        if not found.all():
            where = rest[first[~found]]
            value[~found] = self._add(texts_at(where))
            self.known = np.insert(self.known, at[~found], distinct[~found])
            self.place = np.insert(self.place, at[~found], value[~found])
        number[rest] = value[back]
        self.last[slot[rest]], self.last_number[slot[rest]] = hashes[rest], number[rest]
        long = np.flatnonzero(~short)
        kept = (len(self.start), self.used)
        if len(long):
            number[long] = self._add(texts_at(long))

        counts = self.count[number]
        ends = np.cumsum(counts)
        ids = self.ids[np.repeat(self.start[number] - (ends - counts), counts) + np.arange(ends[-1])]
        if len(long):  # long pieces are not remembered
            self.start, self.count, self.used = self.start[: kept[0]], self.count[: kept[0]], kept[1]
        totals = np.concatenate([[0], ends])
        return ids, totals[np.searchsorted(starts, bounds)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of this worker process."""
    give_back()
    made = Encoder(path)
    give_back()  # the vocabulary was read several times over
    return made


def give_back() -> None:
    """Return what this worker process has freed to the system; its allocators keep most of it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim is not None:
        trim(0)


def forget_encoders() -> None:
    """Drop what this worker process keeps for encoding, before other work that needs the room."""
    encoder.cache_clear()
    give_back()


def with_end(ids: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same rows with ``end`` after each."""
    rows = len(bounds) - 1
    return np.insert(ids, bounds[1:], np.uint32(end)), bounds + np.arange(rows + 1)
