"""Token buckets over pieces of time: vectorised walks, and maps of pieces that compose.

A bucket on a clock of whole seconds holds (tokens, time of the last refill).  Elapsed time is divided by the
window before it is multiplied by the gain, so nothing is refilled until a whole window has passed, and the
refill moment becomes the time of the request, not a multiple of the window.

Two facts let a key's time line be cut:

* After ``full`` idle seconds a bucket is full whatever it was: a point of regeneration.
* When it is refilled hangs on the last refill only, not on the tokens; and what happens to the tokens between, taking
  and refilling, are functions min(max(x + shift, low), high), which compose to one of their kind.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: More tokens or seconds than any bucket or log has.
MUCH = 1 << 60
#: Seconds of a piece, and of one at most unless a bucket takes longer to fill up.
PIECE, MOST_SECONDS = 86400, 1 << 21


@dataclass(frozen=True)
class Rule:
    """Capacity, tokens gained per window, and the window in seconds."""

    capacity: int
    gain: int
    window: int

    @property
    def full(self) -> int:
        """Idle seconds after which a bucket is full."""
        return self.window * -(-self.capacity // self.gain) if self.gain > 0 else MUCH

    @property
    def reach(self) -> int:
        """How old the last refill of a bucket that is not yet full again can be when a piece begins, at most."""
        return self.full + self.window if self.gain > 0 else 1

    def refills(self, times: np.ndarray) -> np.ndarray:
        """For each place the first place a window or more later, where a bucket refilled there is refilled next."""
        return np.searchsorted(times, times + self.window) if self.gain > 0 else np.full(len(times), len(times))

    def gained(self, seconds):
        return np.minimum(seconds // self.window * self.gain, self.capacity)


def walk(
    rule: Rule, times: np.ndarray, before: np.ndarray, starts: np.ndarray, tokens: np.ndarray, refilled: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, tokens, time of refill) of all starts and of the refills between them.

    ``before`` has the requests before each place, and all of them at the end.  ``starts`` are places at which a bucket is
    known; the last refill may lie before.  Only refills are walked one by one, never requests or seconds.
    """
    following = rule.refills(times)
    known = refilled == times[starts]
    first = following[starts]
    if not known.all() and rule.gain > 0:
        first = np.where(known, first, np.searchsorted(times, refilled + rule.window))
        # A refill that is due before the start happens at the start.
        first = np.maximum(first, starts)
    ends = np.r_[starts[1:], len(times)]
    places, held, since = [starts], [tokens], [refilled]
    more_places, more_tokens = [], []
    for s in np.flatnonzero((first < ends) & (rule.gain > 0)).tolist():
        at, x, last, j, end = int(starts[s]), int(tokens[s]), int(refilled[s]), int(first[s]), int(ends[s])
        while j < end:
            now = int(times[j])
            x = min(max(x - int(before[j] - before[at]), 0) + (now - last) // rule.window * rule.gain, rule.capacity)
            more_places.append(j)
            more_tokens.append(x)
            at, last, j = j, now, int(following[j])
    places.append(np.array(more_places, np.int64))
    held.append(np.array(more_tokens, np.int64))
    since.append(times[places[1]])
    places, held, since = (np.concatenate(x) for x in (places, held, since))
    # A refill at the very place of a start takes its place.
    order = np.argsort(places, kind="stable")
    places, held, since = places[order], held[order], since[order]
    last_of = np.r_[places[1:] != places[:-1], True] if len(places) else np.zeros(0, bool)
    return places[last_of], held[last_of], since[last_of]


@dataclass(frozen=True)
class Exit:
    """What a piece makes of a bucket.

    ``refilled`` and ``tokens`` if it ends the same whatever it began with; else ``by_age``, whose columns hold from an age of the last
    refill when the piece begins (row 0, ascending from 1 second) up to the next one: the time of the last refill
    behind the piece (-1: as before), shift, low and high.  There are no more columns than seconds with requests in a window, and
    windows in which a bucket fills up.
    """

    refilled: int | None
    tokens: int | None
    by_age: np.ndarray


def ages_of(rule: Rule, times: np.ndarray, begin: int) -> np.ndarray:
    """Ages of the last refill at which the first refill in a piece comes to another place, or gains more."""
    if rule.gain <= 0:
        return np.array([1])
    moved = begin + rule.window - times[: np.searchsorted(times, begin + rule.window)]
    edges = np.unique(np.r_[1, moved[(moved >= 1) & (moved <= rule.reach)], rule.reach + 1])
    found = [edges[:-1]]
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        at = np.searchsorted(times, begin - low + rule.window)
        if at < len(times):  # one window more is over at these ages
            found.append(np.arange(low + (begin - int(times[at]) - low) % rule.window, high, rule.window))
    return np.unique(np.concatenate(found))


def exit_of(rule: Rule, times: np.ndarray, wanted: np.ndarray, fresh: bool, begin: int) -> Exit:
    """The map of a piece that begins at second ``begin``; ``fresh`` says that its first second finds a full bucket."""
    before = np.r_[0, np.cumsum(wanted)]
    known = np.flatnonzero(np.diff(times) >= rule.full) + 1
    if fresh or len(known):
        at = int(known[-1]) if len(known) else 0
        places, tokens, refilled = walk(
            rule, times[at:], before[at:], np.array([0]), np.array([rule.capacity]), times[at : at + 1]
        )
        left = max(int(tokens[-1]) - int(before[-1] - before[at + places[-1]]), 0)
        return Exit(int(refilled[-1]), left, np.zeros((5, 0), np.int64))
    count = len(times)
    following = rule.refills(times)
    # From a refill at each place (its tokens given) to the end of the piece.
    behind = np.zeros((4, count + 1), np.int64)
    for i in range(count - 1, -1, -1):
        j = int(following[i])
        taken = int(before[min(j, count)] - before[i])
        if j >= count:
            behind[:, i] = times[i], -taken, 0, MUCH
            continue
        gain = int(rule.gained(times[j] - times[i]))
        _, shift, low, high = behind[:, j]
        put = lambda x: min(max(x + shift, low), high)  # noqa: B023, E731
        behind[:, i] = behind[0, j], gain - taken + shift, put(gain), put(rule.capacity)
    ages = ages_of(rule, times, begin)
    refilled = begin - ages
    first = np.searchsorted(times, refilled + rule.window) if rule.gain > 0 else np.full(len(refilled), count)
    late = first >= count
    at = np.minimum(first, count - 1)
    gain = rule.gained(times[at] - refilled) if rule.gain > 0 else np.zeros(len(refilled), np.int64)
    last, shift, low, high = behind[:, at]
    put = lambda x: np.minimum(np.maximum(x + shift, low), high)
    found = np.stack([last, gain - before[first] + shift, put(gain), put(np.full(len(at), rule.capacity))])
    rest = np.stack([np.full(len(at), -1), np.full(len(at), -before[count]), np.zeros(len(at), np.int64), np.full(len(at), MUCH)])
    return Exit(None, None, np.vstack([ages, np.where(late, rest, found)]))


def _changes(columns: list[pa.Array], last: list | None) -> np.ndarray:
    """Whether a row differs from the one before in any column; the first one from ``last``."""
    found = np.zeros(len(columns[0]), bool)
    for i, column in enumerate(columns):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        if len(column) > 1:
            same = pc.fill_null(pc.equal(column[1:], column[:-1]), False).to_numpy(zero_copy_only=False)
            both_null = pc.and_(pc.is_null(column[1:]), pc.is_null(column[:-1])).to_numpy(zero_copy_only=False)
            found[1:] |= ~(same | both_null)
        found[0] |= last is None or column[0].as_py() != last[i]
    return found


def exits(rule: Rule, piece: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per (key, piece) with its ``Exit``, from rows (key, piece, second, requests, fresh) in order; holds one piece."""
    held: list = []
    last = None

    def packed() -> pa.RecordBatch:
        times, wanted = (np.concatenate([h[i] for h in held]) for i in (0, 1))
        out = exit_of(rule, times, wanted, held[0][2], last[1] * piece)
        columns = [[last[0]], [last[1]], [out.refilled], [out.tokens], *[[list(x)] for x in out.by_age]]
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 5]
        names = ["key", "piece", "refilled", "tokens", "age", "last", "shift", "low", "high"]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    for batch in batches:
        if not len(batch):
            continue
        cuts = np.flatnonzero(_changes([batch["key"], batch["piece"]], last))
        times, wanted = (batch[c].to_numpy() for c in ("second", "requests"))
        fresh = batch["fresh"].to_numpy(zero_copy_only=False)
        bounds = np.r_[cuts, len(batch)]
        if held and bounds[0]:
            held.append((times[: bounds[0]], wanted[: bounds[0]], held[0][2]))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if held:
                yield packed()
            held = [(times[a:b], wanted[a:b], bool(fresh[a]))]
            last = [batch["key"][int(a)].as_py(), batch["piece"][int(a)].as_py()]
    if held:
        yield packed()


def entries(piece: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bucket with which each piece begins, from rows of ``exits`` with ``fresh``, by key and piece in order.

    The maps of a key's pieces are composed one after the other: a row a piece, however many requests it has.
    """
    names = ["key", "piece", "refilled", "tokens"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
    key, state = None, None
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            if state is None or row["key"] != key:
                key, state = row["key"], (0, 0)
            if not row["fresh"]:
                rows.append((key, row["piece"], *state))
            if row["refilled"] is not None:
                state = row["refilled"], row["tokens"]
            else:
                at = bisect_right(row["age"], row["piece"] * piece - state[0]) - 1
                last, shift, low, high = (row[c][at] for c in ("last", "shift", "low", "high"))
                state = state[0] if last < 0 else last, min(max(state[1] + shift, low), high)
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def decisions(rule: Rule, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add ``allowed`` to rows (key, piece, second, requests, refilled, tokens) in order, where tokens is null for a full bucket.

    Batches are walked as they come; one bucket is held between them.
    """
    last: list | None = None
    time = refilled = tokens = 0
    for batch in batches:
        if not len(batch):
            continue
        second, wanted = batch["second"].to_numpy(), batch["requests"].to_numpy()
        changed = _changes([batch["key"], batch["piece"]], last)
        given = pc.fill_null(batch["tokens"], -1).to_numpy(), pc.fill_null(batch["refilled"], 0).to_numpy()
        gap = np.diff(second, prepend=time if last is not None else second[0])
        # Groups are set so far apart on one clock that no refill of one is sought in the next.
        spread = min(rule.full, MUCH >> 20) + rule.window + 1
        shift = np.cumsum(np.where(changed, spread - gap, 0))
        clock = second - second[0] + shift
        known = np.where(changed, given[0] >= 0, False)
        full = np.where(changed, given[0] < 0, gap >= rule.full)
        starts = np.flatnonzero(known | full | (np.arange(len(second)) == 0))
        held = np.where(full[starts], rule.capacity, given[0][starts])
        since = np.where(full[starts], clock[starts], clock[starts] + given[1][starts] - second[starts])
        if not (changed[0] or full[0]):
            held[0], since[0] = tokens, clock[0] + refilled - second[0]
        before = np.r_[0, np.cumsum(wanted)]
        places, held, since = walk(rule, clock, before, starts, held, since)
        at = np.searchsorted(places, np.arange(len(second)), side="right") - 1
        left = held[at] - (before[:-1] - before[places[at]])
        allowed = np.clip(left, 0, wanted)
        tokens = max(int(held[-1] - (before[-1] - before[places[-1]])), 0)
        time = int(second[-1])
        refilled = time + int(since[-1] - clock[-1])
        last = [batch["key"][len(batch) - 1].as_py(), batch["piece"][len(batch) - 1].as_py()]
        columns = [batch["key"], batch["second"], batch["requests"], pa.array(allowed, pa.int64())]
        yield pa.record_batch(columns, names=["key", "second", "requests", "allowed"])
