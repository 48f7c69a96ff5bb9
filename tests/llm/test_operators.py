"""The operators on small tables, against plain loops, with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import hashlib
import base64
import io
import re
import struct
import zipfile
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyforge.llm import language, quality, repair, toxicity, warc
from tallyforge.llm.common import arrow_batches, remainder, without
from tallyforge.llm.components import components
from tallyforge.llm.embeddings import near_duplicate_vectors
from tallyforge.llm.exact_dedup import exact_dedup
from tallyforge.llm.mixing import mix_sources
from tallyforge.llm.packing import pack_documents, pack_plan
from tallyforge.llm.shingle_join import _index, _measure, _near, band_of, bands, link_texts, most_apart, sketch
from tallyforge.llm.tokens import Encoder, encoder, slices
from tallyforge.session import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, size long, key long, component string, kept string, hit string"

LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
BASE = " ".join(f"plain{i}" for i in range(60))
TEXTS = [
    "Hello there general", "hello THERE general", None, "", "", "   \n\t ", "École", "école", "ÉCOLE", "a b c d", "A B C D", "a b c e",
    LONG, LONG.upper(), LONG + " tail", BASE, BASE + " more", "other " + BASE, " ".join(BASE.split()[:30]), "one two three four five",
    "one two three four five six", "x" * 70 + "y", "x" * 70 + "z", "\x00 odd \x7f bytes", "<|endoftext|> is text", "nur Wörter, très façon",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "fr", None][i % 3], [None, "b", "a", "ä", "B"][i % 5], None, 7, 7, 7, "c", "k", "h") for i, t in enumerate(TEXTS)]
    rows += [rows[0], rows[0], (None, "hello there general", "en", None, None, *rows[0][5:]), (None, None, None, None, None, *rows[0][5:])]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.collect()]


def shingle_set(text):
    words = WORD.findall((text or "").translate(FOLD))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def groups(links, ids):
    label = {i: i for i in ids}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in links:
        x, y = find(a), find(b)
        label[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_exact_dedup(docs, none):
    assert exact_dedup(none).count() == 0
    members = defaultdict(list)
    for i, t, _ in plain(docs):
        members[(t or "").translate(FOLD)].append(i)
    for digest in (False, True):
        got = sorted(map(tuple, exact_dedup(docs, filter_bits=64, digest=digest).select("doc_id", "keep_id", "group_size", "kept").collect()), key=repr)
        want = []
        for ids in members.values():
            keep = max((i for i in ids if i is not None), default=None)
            want += [(i, keep, len(ids), i == keep) for i in ids]
        assert got == sorted(want, key=repr)
    full = {r.doc_id: r.text_sha256 for r in exact_dedup(docs, digest=True).collect()}
    assert full[6] == hashlib.sha256("École".translate(FOLD).encode()).hexdigest()


def test_shingle_join(docs, none):
    assert link_texts(none).count() == 0
    rows = {i: shingle_set(t) for i, t, _ in plain(docs) if i is not None}
    links = [
        (a, b) for a in rows for b in rows if a < b and rows[a] and 100 * len(rows[a] & rows[b]) >= 75 * max(1, len(rows[a] | rows[b])) and rows[b]
    ]
    want = groups(links, rows)
    for often in (600, 2):  # with 2, all larger groups count as frequent
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in link_texts(docs, often=often, filter_bits=64).collect()}
        assert got.pop(None)[1] is None
        assert got == {i: (len(s), want[i]) for i, s in rows.items()}
    assert link_texts(docs).count() == docs.count()


def test_shingle_join_of_repeated_rows(spark):
    near = BASE + " more"
    rows = [(1, BASE)] + [(5, BASE)] * 30 + [(7, near)] * 20 + [(8, near)] * 10 + [(9, LONG)] * 3
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for bits in (64, 1 << 22):
        got = [(r.doc_id, r.component_id) for r in link_texts(table, filter_bits=bits).collect()]
        assert sorted(got) == sorted((i, 9 if i == 9 else 1) for i, _ in rows)


def test_shingle_join_of_many_mutations(spark):
    rng = np.random.default_rng(3)
    texts = []
    for size in (5, 6, 8, 9, 12, 20, 33, 47, 90, 180):
        for _ in range(3):
            origin = [f"w{x}" for x in rng.integers(0, 10**6, size)]
            texts.append(origin)
            for changes in (1, 1, 2, 3, 5, 8):
                copy = list(origin)
                for at in rng.integers(0, size, min(changes, size // 3)):
                    copy[at] = f"n{rng.integers(0, 10**6)}"
                texts += [copy, copy[: -1 - changes // 2]]
    rows = {i: shingle_set(" ".join(t)) for i, t in enumerate(texts)}
    links = [(a, b) for a in rows for b in rows if a < b and rows[a] and 100 * len(rows[a] & rows[b]) >= 75 * len(rows[a] | rows[b])]
    want = groups(links, rows)
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    for often, chunk in ((600, 2048), (2, 3)):
        assert {r.doc_id: r.component_id for r in link_texts(table, often=often, chunk=chunk).collect()} == want


def texts_batch(many, kind=0):
    texts = [" ".join(f"w{d}x{i}x{kind}" for i in range(30)) for d in range(many)]
    return pa.RecordBatch.from_arrays([pa.array(range(many), pa.int64()), pa.array(texts)], ["id", "text"])


def test_slacks_are_dealt_over_buckets():
    rows = [row for kind in range(20) for out in _index(64)([texts_batch(40, kind)]) for row in out.to_pylist()]
    where = Counter(row["bucket"] for row in rows if row["slack"] is not None)
    assert len(where) > 1 and 0 <= min(where) and max(where) < 64


def test_batches_are_small_and_set_back(spark):
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = [spark.conf.get(n) for n in names]
    with arrow_batches(spark, 500):
        assert [spark.conf.get(n) for n in names] == ["500", "500"]
        with arrow_batches(spark, 1000):
            assert [spark.conf.get(n) for n in names] == ["500", "500"]
    assert [spark.conf.get(n) for n in names] == before


def test_shingles_drop_the_encoder_of_a_worker():
    encoder(public_tokenizers.path("word_bpe_49k.json")).encode(*next(slices(pa.array(["some text"])))[1:])
    assert encoder.cache_info().currsize
    assert sum(out.num_rows for out in _measure([texts_batch(3)])) == 3 and not encoder.cache_info().currsize


def test_near_compares_chunks():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 62, 90).astype(np.uint64)
    sets = []
    for i in range(40):
        kept = np.unique(np.concatenate([base[: 90 - i], rng.integers(0, 1 << 62, i // 2).astype(np.uint64)]))
        sets.append(kept)
    rows = [(i, 0, i % 2, i % 5, len(s), sketch(s), i % 2) for i, s in enumerate(sets)]
    linked = {
        (a, b) for a in range(40) for b in range(a + 1, 40)
        if a % 5 != b % 5 and a % 2 + b % 2 > 0 and 4 * len(np.intersect1d(sets[a], sets[b])) >= 3 * len(np.union1d(sets[a], sets[b]))
    }
    whole = set(map(tuple, _near(rows, 0, 0).tolist()))
    assert linked <= whole and not any(a % 5 == b % 5 for a, b in whole)
    assert {(a, b) for a, b in linked if a % 2 != b % 2} <= set(map(tuple, _near(rows, 0, 1).tolist()))


def test_bands_hold_partners():
    low, _, _ = bands()
    for large in [*range(1, 400), 5000, 77_777]:
        smallest = -(-large * 75 // 100)
        assert band_of(np.array([large]))[0] - band_of(np.array([smallest]))[0] in (0, 1)
    assert most_apart(4, 3) == 1 and most_apart(2, 2) == 0


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 9), (9, 1), (20, 21), (7, 7)] + [(100, i) for i in range(101, 160)] + [(i, i + 1) for i in range(300, 340)]
    ids = {i for e in edges for i in e}
    want = groups(edges, ids)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: c for i, c in want.items() if i != 7}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_without(docs, spark):
    gone = spark.createDataFrame([(0,), (3,)], "id long")
    got = without(docs, gone, "doc_id", bits=64)
    assert got.columns == docs.columns
    assert got.count() == docs.count() - 4
    assert got.filter("doc_id IS NULL").count() == 2


def test_mixing(docs, none):
    assert mix_sources(none).count() == 0
    sizes = defaultdict(int)
    for _, t, s in plain(docs):
        sizes[s] += len(WORD.findall(t or ""))
    order = sorted((s for s in sizes if s is not None), key=lambda s: s) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:  # share what is left by weight; those above their limit stop there
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    got = mix_sources(docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mix_sources(docs.repartition(2)).collect()), key=repr)
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert abs(r.target - target[r.source]) < 1e-6 * max(1, r.target)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)


def test_encoder_equals_the_library():
    odd = ["a  b\n\n c", "It's we'll x's,y <|endoftext|> z", "  x   y", "É é İ ſ Σας ΣΑΣ", "x" * 300 + "   " + "." * 100, "a.b!!'s 's", " \x85 a   b\t\r\n"]
    import pyarrow as pa

    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        whole, own = Tokenizer.from_file(public_tokenizers.path(name)), Encoder(public_tokenizers.path(name), entries=3)
        texts = pa.array([*odd, None, *[t for t in TEXTS if t is not LONG], *odd])
        for first, data, bounds in slices(texts, 200):
            ids, ends = own.encode(data, bounds)
            for i in range(len(ends) - 1):
                assert ids[ends[i] : ends[i + 1]].tolist() == whole.encode(texts[first + i].as_py() or "", add_special_tokens=False).ids


def checksum(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_token_shards(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert repair.read_tokens(repair.write_tokens(none, path)).count() == 0
    whole = Tokenizer.from_file(path)
    want = Counter()
    for i, t, _ in plain(docs):
        ids = whole.encode(t or "", add_special_tokens=False).ids + [0]
        want[i, len(ids), checksum(ids)] += 1
    got = repair.read_tokens(repair.write_tokens(docs, path, shard_tokens=500), read_at_once=100).collect()
    got.sort(key=lambda r: r.start)
    assert Counter((r.id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    ids = [-1 if r.id is None else r.id for r in got]
    assert ids == sorted(ids)


def most_left(symbols, bounds):
    """How often the most frequent pair could still be replaced."""
    many = Counter()
    for a, b in zip(bounds[:-1], bounds[1:]):
        skip = False
        for x, y, z in zip(symbols[a:b], symbols[a + 1 : b], [*symbols[a + 2 : b], None]):
            if x == y and skip:
                skip = False
                continue
            many[x, y] += 1
            skip = x == y == z
    return max(many.values(), default=0)


@pytest.mark.parametrize("seed", range(30))
def test_grammar_is_complete(seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, rng.integers(1, 7), rng.integers(0, 400)).astype(np.uint32)
    bounds = np.concatenate([[0], np.sort(rng.integers(0, len(ids) + 1, 5)), [len(ids)]])
    least = int(rng.integers(2, 6))
    symbols, places, first, rules = repair.compress(ids, bounds, least)
    assert most_left(symbols.tolist(), places.tolist()) < least
    for low, high, a, b in zip(bounds[:-1], bounds[1:], places[:-1], places[1:]):
        assert (repair.expand(symbols[a:b], first, rules) == ids[low:high]).all()


def test_grammar_shrinks_runs_and_repeats():
    passage = np.random.default_rng(1).integers(0, 5000, 1000).astype(np.uint32)
    for ids, most in ((np.full(100_000, 7, np.uint32), 20), (np.tile(passage, 12), 12), (np.tile(passage, 2000), 20)):
        symbols, _, first, rules = repair.compress(ids, np.array([0, len(ids)]))
        assert len(symbols) <= most and (repair.expand(symbols, first, rules) == ids).all()


def test_grammar_and_random_access():
    rng = np.random.default_rng(5)
    ids = np.concatenate([np.tile(rng.integers(0, 9, 50), 40), rng.integers(0, 50_000, 500), np.zeros(300, np.int64)]).astype(np.uint32)
    bounds = np.array([0, 1, 1, 700, 2300, len(ids)])
    out = io.BytesIO()
    out.close, data = (lambda: None), out
    repair.write_shard(out, [3, None, 5, 9, 11], ids, bounds)

    class Source:
        def read_at(self, size, place):
            return data.getvalue()[place : place + size]

    shard = repair.Shard(Source())
    assert len(shard.rules) and shard.symbols < len(ids) and shard.doc_ids == [3, None, 5, 9, 11]
    assert (shard.documents(0, 5) == ids).all() and (shard.documents(2, 3) == ids[1:700]).all()
    for doc, start, stop in ((2, 0, 5), (2, 100, 333), (3, 1599, 1600), (4, 7, 400)):
        assert (shard.span(doc, start, stop) == ids[bounds[doc] + start : bounds[doc] + stop]).all()
    whole = repair.expansions(shard.first, shard.rules)
    assert (whole == [len(repair.expand(np.array([shard.first + i]), shard.first, shard.rules)) for i in range(len(whole))]).all()


def test_packing(docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert pack_documents(none, path).count() == 0
    whole = Tokenizer.from_file(path)
    rows = sorted(tuple(r) for r in pack_documents(docs, path, capacity=256).filter("doc_id IS NOT NULL").collect())
    want = sorted(
        (i, n, 256 * n, len(ids[256 * n : 256 * n + 256]), checksum(ids[256 * n : 256 * n + 256]))
        for i, t, _ in plain(docs) if i is not None
        for ids in [whole.encode(t or "", add_special_tokens=False).ids + [1]]
        for n in range(-(-len(ids) // 256))
    )
    assert [r[:5] for r in rows] == want


@pytest.mark.parametrize("seed", range(4))
def test_pack_plan(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(3, 300))
    counts = {int(n): int(c) for n, c in zip(rng.integers(1, capacity + 1, 60), rng.integers(0, 500, 60), strict=True)}
    bins, seen = defaultdict(list), defaultdict(set)
    for n, rank, many, times, first, offset in pack_plan(counts, capacity):
        for i in range(many):
            seen[n].add(rank + i)
            bins[first + i // times].append((offset + i % times * n, n))
    assert {n: len(s) for n, s in seen.items()} == {n: c for n, c in counts.items() if c}
    assert all(s == set(range(len(s))) for s in seen.values())
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= capacity and sum(3 * n > capacity for _, n in held) <= 2
    least = -(-sum(n * c for n, c in counts.items()) // capacity)
    big = sum(c for n, c in counts.items() if 2 * n > capacity)
    assert len(bins) <= 1.25 * max(least, big) + 2


def test_warc_round_trip(spark):
    schema = "page_id long, url string, html string, sha1 string, latest long, path string"
    same, long = "<p>same</p>", "<html>" + "é" * 200_000
    rows = [(1, "http://a/1", same, None, 1, "p"), (9, None, same, None, 1, "p"), (4, "u\r\nX: y", same, None, 1, "p"), (9, None, same, None, 1, "p"),
            (2, "u", None, None, 1, "p"), (3, "u", "", None, 1, "p"), (5, "u", long, None, 1, "p"), (6, "u", "a\r\n\r\nb", None, 1, "p"), (None, "u", same, None, 1, "p")]
    pages = spark.createDataFrame(rows, schema)
    for bits in (64, 1 << 20):
        got = warc.read_archives(warc.write_archives(pages, archive_bytes=300, filter_bits=bits), split_bytes=50).collect()
        want = []
        for page, _, html, *_ in rows:
            last = max(r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None)
            payload = (html or "").encode()
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            want.append((page, len(payload), digest, "response" if page == last else "revisit", None if page == last else last))
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    few = warc.read_archives(warc.write_archives(pages, min_bytes=12)).collect()
    assert {r.record_type for r in few} == {"response"}
    assert warc.read_archives(warc.write_archives(spark.createDataFrame([], schema))).count() == 0


def test_package_is_a_zip64_file():
    out = io.BytesIO()
    out.close, package = (lambda: None), warc.Package(out)
    for name, parts in ((warc.DATA, [b"abc", b"defg"]), (warc.INDEX, [b"{}"]), ("empty", [])):
        package.begin(name)
        assert [package.write(p) for p in parts] == [sum(map(len, parts[:i])) for i in range(len(parts))]
        package.end()
    package.close()
    whole = out.getvalue()

    class Source:
        def size(self):
            return len(whole)

        def read_at(self, size, place):
            return whole[place : place + size]

    found = warc.members(Source())
    assert {n: whole[a : a + s] for n, (a, s) in found.items()} == {warc.DATA: b"abcdefg", warc.INDEX: b"{}", "empty": b""}
    with zipfile.ZipFile(io.BytesIO(whole)) as other:
        assert other.testzip() is None and other.read(warc.DATA) == b"abcdefg"
    plain_zip = io.BytesIO()
    with zipfile.ZipFile(plain_zip, "w") as other:
        other.writestr("x", b"stored")
        other.writestr("y", b"packed" * 99, zipfile.ZIP_DEFLATED)
    whole = plain_zip.getvalue()
    (place, size), = warc.members(Source()).values()
    assert whole[place : place + size] == b"stored"


def test_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 12))
    rows = [list(map(float, v)) for v in base]
    rows += [list(map(float, base[0] + 0.05 * rng.normal(size=12))) for _ in range(60)] + [rows[3]] * 30 + [[3 * x for x in rows[3]], [-x for x in rows[3]]]
    ids = list(range(1, len(rows) + 1))
    bad = [None, [], [0.0] * 12, [1.0] * 11 + [None], [1.0] * 11 + [float("nan")], [float("inf")] + [1.0] * 11]
    rows += bad + [[1.0, 2.0], [2.0, 4.0]] + [[1e300] * 12, [1e-300] * 12]
    ids = list(range(1, len(rows) + 1))
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in zip(ids, rows, strict=True)] + [(None, rows[0], 1, 2)], "vec_id long, embedding array<double>, links int, same int")
    unit = [None if v in bad and v is not rows[0] else np.array(v) / max(abs(x) for x in v) for v in rows]
    unit = [None if v is None else v / np.sqrt((v**2).sum()) for v in unit]
    links = [
        (ids[i], ids[j]) for i in range(len(rows)) for j in range(i) if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9
    ]
    label, many = groups(links, ids), defaultdict(int)
    for a, b in links:
        many[a] += 1
        many[b] += 1
    for chunk, blocks in ((4096, 4), (7, 3)):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(table, chunk=chunk, blocks=blocks).collect()}
        assert got.pop(None) == (0, None, True)
        assert got == {i: (many[i], label[i], label[i] == i) for i in ids}
    assert near_duplicate_vectors(table.limit(0)).count() == 0


def linked(rows, bound):
    """Number of links and component of each row, by definition."""
    ids, unit = [i for i, _ in rows], np.array([v for _, v in rows], float)
    unit /= np.sqrt((unit**2).sum(1, keepdims=True))
    near = np.triu(unit @ unit.T >= bound, 1)
    label = groups([(ids[a], ids[b]) for a, b in zip(*np.nonzero(near), strict=True)], ids)
    return {i: (int(n), label[i], label[i] == i) for i, n in zip(ids, (near | near.T).sum(1), strict=True)}


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_across_slabs(spark, kind):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(300, 20))
    crowd = base[0] + 0.02 * rng.normal(size=(500, 20))  # more than a block of rows that all link
    chain = base[1] + np.linspace(0, 3, 40)[:, None] * base[2]
    some = base[100:200] + 0.15 * rng.normal(size=(100, 20))
    vectors = np.concatenate([base, crowd, chain, some, base[50:80], crowd[:30]]).astype(np.float32)
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(rng.permutation(len(vectors)), vectors, strict=True)]
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    for slab, chunk in ((20 * 150, 64), (1 << 22, 4096)):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(table, slab=slab, chunk=chunk).collect()}
        assert got == linked(rows, 0.9)


def test_vectors_take_disk_in_proportion(spark):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(8).normal(size=(4000, 32)).astype(np.float32))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").cache()
    table.count()
    shared = Path(scratch_path(spark, "x").removeprefix("file:")).parent

    def files():
        own = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        found = [Path(own.apply(k).getPath()) for k in range(own.size())] + [p for p in shared.rglob("*") if p.is_file()]
        return {str(p): p.stat().st_size for p in found if p.exists()}

    before = files()
    assert near_duplicate_vectors(table, chunk=64).filter("n_links = 0 AND kept").count() == 4000
    assert sum(size for path, size in files().items() if path not in before) < 8 * 4000 * 32 * 4
    table.unpersist()


def test_quality_separates(spark, docs, none):
    rng = np.random.default_rng(1)
    clean = [" ".join(f"w{x}" for x in rng.integers(0, 500, 80)) + "." for _ in range(120)]
    junk = [" ".join(f"w{x}***" for x in rng.integers(0, 500, 80)) for _ in range(60)] + ["spam " * 70] * 20
    texts = [(i, t, int(i < 120)) for i, t in enumerate(clean + junk)]
    table = spark.createDataFrame([(i, t, "x") for i, t, _ in texts], "doc_id long, text string, quality string")
    labels = spark.createDataFrame([(i, q, None) for i, _, q in texts] + [(None, 1, None), (3, None, None)], "doc_id long, quality int, text string")
    scores = {r.doc_id: r.score for r in quality.score_quality(table, labels, remainder("doc_id", 4) != 2).collect()}
    held = [(i, q) for i, _, q in texts if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 20 and all((scores[i] >= 0.7) == bool(q) for i, q in held)
    odd = quality.score_quality(docs, labels).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert quality.score_quality(none, labels).count() == 0
    assert {r.score for r in quality.score_quality(docs, labels.limit(0)).collect()} == {0.5}


def test_language_separates(spark, docs, none):
    rng = np.random.default_rng(4)
    parts = {"aa": ["tha", "ing", "her", "ou"], "bb": ["ße", "sch", "ung", "ä"], "cc": ["eau", "qué", "oi", "ç"]}
    rows = []
    for i in range(150):
        lang = list(parts)[i % 3]
        rows.append((i, " ".join("".join(rng.choice(parts[lang], 3)) for _ in range(40)), lang))
    rows += [(500, None, "aa"), (501, "123 -- 456", "bb"), (502, "", None), (503, "ungschung ungsch" * 3, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify_language(table, remainder("doc_id", 4) != 2).collect()}
    assert got[500] == got[501] == got[502] == ("und", 0.0) and got[503][0] == "bb"
    held = [(i, lang) for i, _, lang in rows[:150] if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([got[i][0] == lang for i, lang in held]) > 0.95
    assert language.identify_language(docs).count() == docs.count()
    assert language.identify_language(none).count() == 0
    assert {r.lang_pred for r in language.identify_language(docs, F.lit(False)).collect()} == {"und"}


def slow_kernel(s, t):
    """Weights of the common subsequences of three letters, by definition."""
    from itertools import combinations

    def weights(word):
        out = defaultdict(float)
        for at in combinations(range(len(word)), toxicity.ORDER):
            out[bytes(word[i] for i in at)] += toxicity.DECAY ** (at[-1] - at[0] + 1)
        return out

    a, b = weights(s), weights(t)
    return sum(w * b[u] for u, w in a.items() if u in b)


def test_subsequence_kernel():
    words = [b"idiot", b"idxiot", b"thing", b"ab", b"aaaa", b"moron"]
    rows = toxicity._pad(words)
    for other in words:
        mark = np.broadcast_to(np.frombuffer(other, np.uint8), (len(words), len(other)))
        assert np.allclose(toxicity.subsequence_kernel(rows, mark), [slow_kernel(w, other) for w in words], atol=1e-5)


def test_units_read_gaps():
    text = "You 1d.i-o-t! A b c d e word\nnext " + "z" * 40
    data = np.frombuffer(text.encode(), np.uint8)
    found = toxicity.units(data, np.array([0, len(data)]))
    words = found.texts(np.arange(len(found.start)))
    assert {b"idiot", b"abcde", b"word", b"next", b"z" * 24}.issubset(words)


def test_toxicity_separates(spark, docs, none):
    rng = np.random.default_rng(8)
    bad = ["blorgface", "wurmhirn", "stinkbert"]
    rows = []
    for i in range(400):
        words = ["".join(rng.choice(list("aeioutnrsl"), 6)) for _ in range(50)]
        if i % 4 == 0:
            words[int(rng.integers(0, 50))] = bad[i // 4 % 3]
        rows.append((i, ". ".join(" ".join(words[k : k + 10]) for k in range(0, 50, 10)), int(i % 4 == 0)))
    hidden = [(1000, "so b-l-o-r-g-f-a-c-e there"), (1001, "you w u r m h i r n you"), (1002, "stinnkbert"), (1003, None), (1004, "")]
    table = spark.createDataFrame([(i, t, "s") for i, t, _ in rows] + [(i, t, "s") for i, t in hidden], "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (7, None)], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(table, labels, remainder("doc_id", 3) != 1).collect()}
    assert all((got[i] >= 0.7) == bool(y) for i, _, y in rows)
    assert got[1000] >= 0.7 and got[1001] >= 0.7 and got[1002] >= 0.7 and got[1003] == got[1004] < 0.2
    assert toxicity.score_toxicity(docs, labels).count() == docs.count()
    assert toxicity.score_toxicity(none, labels).count() == 0
    assert len({r.score for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()}) == 1


def test_toxicity_counts_words_that_clean_texts_hold_too(spark):
    rng = np.random.default_rng(12)
    ends = ["al", "ent", "iro", "ous", "ul", "asse", "ino", "eru", "ost", "ais", "on", "ure"]
    rows = []
    for i in range(900):
        words = ["".join(rng.choice(list("aeioutnrsl"), 6)) for _ in range(60)]
        times = int(rng.integers(3, 6)) if i % 6 == 0 else int(rng.random() < 0.3)
        for at in rng.choice(60, times, replace=False):
            words[at] = "grimpf" + ends[int(rng.integers(0, len(ends)))]
        rows.append((i, ". ".join(" ".join(words[k : k + 10]) for k in range(0, 60, 10)), int(i % 6 == 0)))
    table = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r.doc_id: r.score >= 0.7 for r in toxicity.score_toxicity(table, labels, remainder("doc_id", 3) != 1).collect()}
    held = [(y, got[i]) for i, _, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    toxic, clean = [g for y, g in held if y], [g for y, g in held if not y]
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.02 * len(clean)


def test_nystrom_features_against_plain_loops():
    marks = toxicity.Landmarks([b"grobian", b"lumpen", b"grobheit"], 2, shared=0.0)
    texts = [b"ein grobian und g-r-o-bian", b"", b"lump lumpen lumpensack grobian", b"ganz ruhig hier", b"gr0bian l u m p e n"]
    data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])

    def kernel(a, b):
        a, b = slow_kernel(a, a), slow_kernel(a, b) / max(1e-12, slow_kernel(b, b)) ** 0.5
        return (b / max(1e-12, a) ** 0.5) ** toxicity.POWER

    gram = np.array([[kernel(a, b) for b in marks.words] for a in marks.words])
    assert np.allclose(marks.root @ gram @ marks.root, np.eye(3), atol=1e-4)
    values, vectors = np.linalg.eigh(gram)
    root = vectors @ np.diag(values**-0.5) @ vectors.T
    docs, got = toxicity.pooled(marks, data, bounds)
    assert docs.tolist() == [0, 2, 3, 4]
    for doc, row in zip(docs, got):
        found = toxicity.units(data[bounds[doc] : bounds[doc + 1]], np.array([0, len(texts[doc])]))
        all_of = np.array([[kernel(u, w) for w in marks.words] for u in found.texts(np.arange(len(found.start)))])
        total = all_of.sum(0)
        want = [all_of.max(0), np.log1p(total), np.log1p(total * 100 / len(all_of))]
        assert np.allclose(row, np.concatenate([x @ root for x in want]), atol=1e-3)
