"""Hard negatives, shards and conversation repair against plain loops, with nulls, ties, repeated rows and clashing columns."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from functools import cache
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyforge.llm import sharding
from tallyforge.llm.conversations import END, START, damage, kind_of, repair_conversations, repaired_turns, walk
from tallyforge.llm.hard_negatives import hard_negatives, share_above, share_below
from tallyforge.llm.sharding import cuts_of, shard_documents

VECTORS = "vec_id long, embedding array<double>, label int, id string, slot string, score string, anchor string, rank string"


def mined(rows, anchors, positives=5, negatives=10, low=30, high=90):
    good = [
        (i, y, [math.floor(256 * x) for x in v])
        for i, v, y in rows
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    found, done = [], set()
    for a, kind, body in good:
        if not anchors(a) or (a, kind, tuple(body)) in done:
            continue
        done.add((a, kind, tuple(body)))
        near = [(-sum(x * y for x, y in zip(body, v, strict=True)), i, y) for i, y, v in good if i != a and len(v) == len(body)]
        for score, i, _ in sorted(n for n in near if n[2] == kind)[:positives]:
            fit = sorted(n for n in near if n[2] != kind and low * -score <= 100 * -n[0] <= high * -score)
            found += [(a, i, r, n[1], -score, -n[0]) for r, n in enumerate(fit[:negatives], 1)]
    return sorted(found)


def vector_rows(seed, count, labels, coarse):
    """Random vectors; rounded to a few values if ``coarse``, so that scores tie."""
    rng = np.random.default_rng(seed)
    body = rng.normal(0.3, 0.5, (count, 6))
    body = np.round(body * 2) / 2 if coarse else body
    return [(i, [float(x) for x in body[i]], int(rng.integers(0, labels))) for i in range(count)]


@pytest.mark.parametrize("coarse", [False, True])
def test_hard_negatives(spark, coarse):
    rows = vector_rows(4, 400, 4, coarse) + [(i, [0.5, 1.0], i % 2) for i in range(1000, 1040)] + [(i, [], 1) for i in (2000, 2001)]
    rows += [(3000, None, 1), (3010, [1.0] * 6, None), (None, [1.0] * 6, 1), (3020, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (3030, [float("nan")] * 6, 1)]
    rows += [(3040, [float("inf")] * 6, 2), (3050, [0.0] * 6, 3), (3060, [-3.0] * 6, 2), rows[0], rows[0], rows[11], (5, *rows[7][1:])]
    table = spark.createDataFrame([(*r, "x", "y", "z", "a", "r") for r in rows], VECTORS).repartition(5)
    anchors = lambda i: i % 10 == 0
    for sizes in ({}, {"slab": 60, "block": 24, "chunk": 7}):
        got = hard_negatives(table, F.col("vec_id") % 10 == 0, **sizes)
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
        assert sorted(map(tuple, got.collect())) == mined(rows, anchors)
    got = hard_negatives(table, F.col("vec_id") % 10 == 0, positives=2, negatives=3, low=10, high=100, slab=600)
    assert sorted(map(tuple, got.collect())) == mined(rows, anchors, 2, 3, 10, 100)
    assert hard_negatives(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives(table, F.lit(None).cast("boolean")).count() == 0


def test_hard_negatives_of_large_numbers(spark):
    """Beyond 2^53 doubles would round; products stay exact."""
    rows = [(i, [float((1 << 21) + (i * 7919) % 1000), float(1 << 20), 3.0 + i], i % 3) for i in range(60)]
    table = spark.createDataFrame([(*r, "x", "y", "z", "a", "r") for r in rows], VECTORS)
    got = hard_negatives(table, F.col("vec_id") % 20 == 0, low=30, high=100)
    assert sorted(map(tuple, got.collect())) == mined(rows, lambda i: i % 20 == 0, high=100)


def test_limits_of_windows(spark):
    scores = [0, 1, 9, 10, 11, 99, 100, 101, 12345, (1 << 62) + 77]
    frame = spark.createDataFrame([(s,) for s in scores], "s long")
    got = frame.select("s", share_above(F.col("s"), 30), share_below(F.col("s"), 90)).collect()
    assert [tuple(r) for r in got] == [(s, -(-30 * s // 100), 90 * s // 100) for s in scores]


DOCS = "doc_id long, text string, size string, shard string, slot string, doc string, key string, row string"


def sharded(spark, rows, shards, **more):
    table = spark.createDataFrame([(*r, "a", "b", "c", "d", "e", "f") for r in rows], DOCS).repartition(6)
    placed = shard_documents(table, shards, **more)
    assert placed.columns == ["doc", "size", "shard", "slot"] and placed.select("doc.*").columns == table.columns
    got = placed.select("doc.doc_id", "doc.text", "size", "shard", "slot").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    assert all(r.size == len((r.text or "").encode()) + 1 for r in got)
    slots, load, spread = defaultdict(list), Counter(), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
        spread[r.text or ""].add(r.shard)
    assert set(slots) <= set(range(shards)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    return load, spread


def test_shards_are_near_equal_and_keep_groups(spark):
    rng = np.random.default_rng(5)
    texts = ["é" * int(n) for n in rng.pareto(1.5, 3000) * 20 + 1]
    rows = [(i, f"{t}{i}") for i, t in enumerate(texts)] + [(i, "twin" * 40) for i in range(4000, 4200)] + [(None, None), (None, ""), (7, None)]
    load, spread = sharded(spark, rows, 8)
    assert max(load.values()) <= 1.005 * sum(load.values()) / 8
    assert all(len(s) == 1 for s in spread.values())


def test_shards_of_hot_rows(spark):
    rows = [(i, f"text {i} " * 4) for i in range(900)]
    hot = [(i, "hot " * 30) for i in range(2000, 2900)]  # most bytes are copies of one text
    same = [(5, "same")] * 1500 + [(None, None)] * 1500  # and many rows are equal in all columns
    load, spread = sharded(spark, rows + hot + same, 8)
    assert max(load.values()) <= 1.01 * sum(load.values()) / 8
    assert len(spread["hot " * 30]) <= 7 and len(spread["same"]) == 1 and len(spread[""]) == 1
    load, _ = sharded(spark, [(1, "one")] * 3000, 7)
    assert max(load.values()) <= 1.02 * sum(load.values()) / 7


def test_shards_of_few_rows(spark):
    assert sharded(spark, [], 4) == ({}, {})
    load, _ = sharded(spark, [(1, "x" * 5000), (2, "y"), (None, None)], 4)
    assert sorted(load.values()) == [1, 2, 5001]
    load, _ = sharded(spark, [(i, "z" * i) for i in range(40)], 1)
    assert set(load) == {0}


def test_overfull_ranges_are_subdivided(spark):
    rng = np.random.default_rng(2)
    keys = np.r_[rng.integers(-(1 << 62), 1 << 62, 500), np.full(700, 77), rng.integers(1000, 1400, 800)]
    table = spark.createDataFrame([(1, int(k), i // 3, i) for i, k in enumerate(keys)], "size long, key long, id long, row long")
    ranges = sharding.Ranges.measured(table, sharding.Splitters(np.zeros(0, np.int64)))
    assert len(ranges.name) == 1
    for seed in range(12):
        wanted = {int(i): float(n / 50) for i, n in enumerate(ranges.rows) if n > 100 and ranges.path(i) is not None}
        if not wanted:
            break
        before = len(ranges.name)
        ranges = sharding._split(table, ranges, wanted, seed)
        assert len(ranges.name) >= before + len(wanted)
    assert ranges.rows.max() <= 100 and ranges.rows.sum() == len(keys)
    ends = [tuple(x) for pair in zip(ranges.low, ranges.high, strict=True) for x in pair]
    assert ends == sorted(ends)
    assert cuts_of(np.array([5, 5, 5, 9]), np.array([1.0, 1, 1, 1]), 2).tolist() == [5, 6, 10]


ROLES = ["system", "user", "assistant", "tool", "", "User", None]
TEXTS = ["Fine.", "What?", "Yes!", "cut off", "tail. \n", "", " \t", None, "no end \x0b", " ", "Fine."]


def slow_audit(rows):
    """(faults, cost, audit, repaired lines) of rows (role, text), suffix by suffix without checkpoints."""
    faults, seen = [], set()
    for role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated")
        seen.add((role, text))

    @cache
    def best(i, out, inserted):
        """Cheapest (cost, audit, lines) from row i after the initial ``out``; more than three insertions in a row never pay."""
        due = {"": ["s", "u"], "s": ["u"], "u": ["a"], "a": ["u"]}[out]
        name = {"u": "user", "a": "assistant"}[due[-1]]
        found = [(0, "", ())] if i == len(rows) and out in ("", "a") else []
        more = best(i, due[-1], inserted + 1) if inserted < 3 else None
        if more:
            found.append((more[0] + 3, "I" + more[1], (f"{name}:", *more[2])))
        if i < len(rows):
            role, text = rows[i]
            steps = [(4, "D", out, ())]
            if faults[i] not in ("blank", "duplicate"):
                extra = 3 * (faults[i] == "truncated")
                steps += [(extra, "K", role[:1], (f"{role}:{text}",))] if role[:1] in due else []
                steps += [(extra + 3, "R", due[-1], (f"{name}:{text}",))]
            for cost, letter, to, line in steps:
                rest = best(i + 1, to, 0)
                found.append((cost + rest[0], letter + rest[1], line + rest[2]))
        return min(found, default=None)

    return faults, *best(0, "", 0)


def test_walk_finds_the_least_of_all_edit_sequences():
    rng = np.random.default_rng(1)
    fits = re.compile(r"(s?(ua)+)?\Z")
    gaps = ["", "u", "a", "ua", "au"]
    for size in (0, 1, 2, 2, 2, 2, 2, 2, 3, 3):
        rows = [("suat"[rng.integers(0, 4)], [None, "blank", "truncated"][rng.choice(3, p=[0.5, 0.2, 0.3])]) for _ in range(size)]
        found = []
        for edits in product(*[["D"] if f == "blank" else ["D", "K", "u", "a"] for _, f in rows]):
            for inserted in product(gaps, repeat=size + 1):
                out = inserted[0] + "".join(("" if e == "D" else r if e == "K" else e) + g for (r, _), e, g in zip(rows, edits, inserted[1:], strict=True))
                if fits.match(out):
                    kept = sum(f == "truncated" and e != "D" for (_, f), e in zip(rows, edits, strict=True))
                    cost = 3 * kept + sum({"D": 4, "K": 0}.get(e, 3) for e in edits) + 3 * sum(map(len, inserted))
                    audit = "I" * len(inserted[0]) + "".join((e if e in "DK" else "R") + "I" * len(g) for e, g in zip(edits, inserted[1:], strict=True))
                    found.append((cost, audit))
        kinds = [kind_of(f == "blank", r, f == "truncated") for r, f in rows]
        codes, _ = walk(kinds, END, START, True)
        assert "".join(codes).translate(str.maketrans("uaUA", "IIRR")) == min(found)[1]


def conversation_rows(seed, count, longest):
    rng = np.random.default_rng(seed)
    rows = []
    for conv in range(count):
        for turn in range(int(rng.integers(1, longest))):
            role = ROLES[rng.choice(len(ROLES), p=[0.1, 0.35, 0.35, 0.05, 0.05, 0.05, 0.05])]
            turn = None if rng.random() < 0.05 else turn * int(rng.integers(1, 3))
            text = TEXTS[rng.integers(0, len(TEXTS))] if rng.random() < 0.4 else f"word {rng.integers(0, 30)}{'.' if rng.random() < 0.8 else ''}"
            rows.append((None if conv == 3 else conv, turn, role, text))
    return rows


def slow_repair(rows):
    space = lambda x: " " if x is None else x
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        held[conv] += [(turn is not None, turn or 0, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    found = {}
    for conv, live in held.items():
        live = sorted(live, key=lambda r: (*r[:2], r[2].encode(), r[3].encode()))
        turns = {r[1] for r in live if r[0]}
        faults, cost, audit, lines = slow_audit([r[2:] for r in live])
        count = Counter(faults)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(live, live[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        found[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, digest), lines
    return found


@pytest.mark.parametrize("block", [4096, 2])
def test_conversation_repair(spark, block):
    """With blocks of two rows, all conversations count as long."""
    rows = conversation_rows(7, 60, 9) + conversation_rows(8, 2, 60)
    rows += [(900, 1, "user", "Hm.")] * 5 + [(901, None, None, None)] * 3 + [(None, None, None, None)]
    rows += [(902, t, "user", "x" * 100_000 + ".") for t in range(2)]
    dropped = next(i for i in range(1000, 2000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "All gone."))
    schema = "conv_id long, turn long, role string, text string, live string, place string, kind string, state string"
    table = spark.createDataFrame([(*r, "l", "p", "k", "s") for r in rows], schema).repartition(5)
    want = slow_repair(rows)
    live = damage(table)
    got = repair_conversations(live, F.col("live"), block).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == {c: w for c, (w, _) in want.items()} and len(got) == len(want)
    assert want[dropped][0] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    lines = defaultdict(list)
    for r in repaired_turns(live, F.col("live"), block).orderBy("conv_id", "place", "line").collect():
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert lines == {c: list(x) for c, (_, x) in want.items() if x}
    assert repair_conversations(live.limit(0), F.col("live"), block).count() == 0


def test_long_conversation_in_blocks(spark):
    """A conversation of most rows, in blocks of the square root of its length, gives what one walk gives."""
    rng = np.random.default_rng(11)
    rows = [(1, i, ["user", "assistant", "system"][rng.choice(3, p=[0.45, 0.45, 0.1])], f"t{rng.integers(0, 900)}{'.' * int(rng.random() < 0.8)}") for i in range(3000)]
    rows += [(c, i, "user", f"u{i}.") for c in range(2, 40) for i in range(5)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    whole = repair_conversations(table).collect()
    cut = repair_conversations(table, block=16).collect()
    assert sorted(whole) == sorted(cut) and len(whole) == 39
