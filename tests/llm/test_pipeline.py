"""The stages of the pipeline, one after the other, against plain loops."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The input and the output of every stage."""
    rng = np.random.default_rng(9)
    clean = [" ".join(f"w{x}" for x in rng.integers(0, 3000, int(n))) + "." for n in rng.integers(40, 120, 160)]
    texts = clean + [" ".join(f"w{x}***" for x in rng.integers(0, 500, 60)) for _ in range(60)]
    texts += [t.upper().replace("W", "w") if i % 2 else t for i, t in enumerate(clean[:20])]  # equal but for the case
    texts += [t + " one more" for t in clean[20:50]] + ["changed " + t for t in clean[20:30]] + [None, "", " \n"]
    rows = [(i, t, "en", ["a", "b", None][i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]
    folder = str(tmp_path_factory.mktemp("tables"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(not 160 <= i < 220), 0) for i in range(220)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    found, docs = [], spark.read.parquet(f"{folder}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        found.append(docs)
        stage(spark, docs, folder).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return [*found, docs], folder


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_schemas(stages):
    assert all(df.columns == COLUMNS for df in stages[0][:5])
    assert len(corpus_pipeline.STAGES) == 5


def test_quality(stages):
    before, after = rows_of(stages[0][0]), rows_of(stages[0][1])
    assert set(before) - set(after) == set(range(160, 220))
    assert all(after[i] == before[i] for i in after)


def test_exact(stages):
    before, after = rows_of(stages[0][1]), rows_of(stages[0][2])
    keep = {}
    for i, r in before.items():
        text = (r.text or "").lower()
        keep[text] = max(i, keep.get(text, i))
    assert set(after) == set(keep.values()) and all(after[i] == before[i] for i in after)


def test_near(stages):
    before, after = rows_of(stages[0][2]), rows_of(stages[0][3])
    sets = {}
    for i, r in before.items():
        words = WORD.findall((r.text or "").lower())
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    assert set(after) == {find(i) for i in sets} and len(after) < len(before)


def test_mix(stages):
    before, after = rows_of(stages[0][3]), stages[0][4].collect()
    size = lambda t: len(WORD.findall(t or ""))
    total = defaultdict(int)
    for r in before.values():
        total[r.source] += size(r.text)
    mixed = defaultdict(int)
    for r in after:
        mixed[r.source] += size(r.text)
        assert before[r.doc_id].text.startswith(r.text) and r.n_chars == len(r.text)
    assert all(mixed[s] <= 2 * total[s] for s in total)
    assert abs(sum(mixed.values()) - 1.5 * sum(total.values())) <= len(total)
    assert max(Counter(r.doc_id for r in after).values()) <= 2
    cut = [r for r in after if r.text != before[r.doc_id].text]
    assert len(cut) <= len(total)


def test_rows_of_files_are_keyed_without_a_copy(spark, tmp_path):
    source = str(tmp_path / "documents.parquet")
    table = spark.createDataFrame([(i % 5 or None, f"text {i}") for i in range(60)], "doc_id long, text string")
    table.repartition(4).write.parquet(source)
    docs = spark.read.parquet(source)
    rows = corpus_pipeline.keyed(docs)
    assert {f.rsplit("/", 1)[0] for f in rows.inputFiles() if "/files-" not in f} == {f.rsplit("/", 1)[0] for f in docs.inputFiles()}
    once = {(r[corpus_pipeline.ROW], r.doc_id, r.text) for r in rows.collect()}
    again = {(r[corpus_pipeline.ROW], r.doc_id, r.text) for r in rows.repartition(3).collect()}
    assert once == again and len({key for key, *_ in once}) == 60
    twice = corpus_pipeline.keyed(docs.join(spark.range(2).withColumnRenamed("id", "copy")))  # places that repeat
    assert twice.select(corpus_pipeline.ROW).distinct().count() == 120


def test_mix_takes_each_row_by_itself(spark):
    words = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    rows = [(None, words("x", 40)), (None, words("y", 30)), (None, words("x", 40)), (1, words("z", 20)), (2, words("u", 25))]
    rows += [(3, words("v", 50))] * 3 + [(4, words("q", 7)), (4, words("r", 9))]
    table = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.mix(spark, table.repartition(3), "").collect()
    total = sum(len(t.split()) for _, t in rows)
    assert sum(len(r.text.split()) for r in got) == total * 3 // 2  # the only source's budget, to the word
    whole, most = Counter((r.doc_id, r.text) for r in got), Counter(rows)
    assert all(most[row] <= whole[row] <= 2 * most[row] for row in most)  # every row once, none more than twice
    assert sum(n for row, n in whole.items() if row not in most) <= 1  # only the row at the cut is cut


ODD = "doc_id long, text string, lang string, source string, n_chars long, size long, _hit string, _row string, taken string, id string"


@pytest.fixture
def odd(spark):
    """Repeated rows and null ids, null and empty texts, and columns named like those that the stages use."""
    words = lambda name, n=40: " ".join(f"{name}{i}" for i in range(n))
    texts = [(1, words("a")), (1, words("a")), (None, words("a")), (None, words("b")), (None, words("b")), (2, words("c")), (3, words("c") + " end")]
    texts += [(None, words("c") + " other"), (None, words("d")), (None, words("d") + " more"), (4, None), (5, ""), (6, words("e", 3))]
    rows = [(i, t, "en", None if i == 2 else "a", None if t is None else len(t), n, "h", "r", "t", "i") for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, ODD).repartition(3)


def test_exact_keeps_one_row(spark, odd):
    got = corpus_pipeline.exact(spark, odd, "")
    assert got.columns == odd.columns
    rows = sorted((r.text or "", r.doc_id or 0) for r in got.collect())
    want = {}
    for r in odd.collect():
        want[r.text or ""] = max(r.doc_id or 0, want.get(r.text or "", 0))
    assert rows == sorted(want.items())


def test_near_keeps_one_row(spark, odd):
    got = corpus_pipeline.near(spark, odd, "")
    assert got.columns == odd.columns
    kept = Counter((r.doc_id, (r.text or "").split(" ")[0]) for r in got.collect())
    assert kept == {(1, "a0"): 1, (None, "b0"): 1, (2, "c0"): 1, (None, "d0"): 1, (4, ""): 1, (5, ""): 1, (6, "e0"): 1}


def test_quality_judges_each_row(spark, stages):
    docs = spark.read.parquet(f"{stages[1]}/documents.parquet")
    junk = docs.filter("doc_id = 160").withColumn("doc_id", F.lit(None).cast("long"))
    twice = docs.union(docs.filter("doc_id IN (0, 161)")).union(junk).withColumn("score", F.lit("x")).withColumn("features", F.lit("y"))
    got = corpus_pipeline.quality(spark, twice, stages[1])
    assert got.columns == twice.columns
    many = Counter(r.doc_id for r in got.collect())
    assert many[0] == 2 and not set(many) & {*range(160, 220), None} and len(many) == docs.count() - 60


def test_stages_on_odd_and_empty_tables(spark, odd, stages):
    none = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, stages[1]).count() == 0
    mixed = corpus_pipeline.mix(spark, odd, "")
    assert mixed.columns == odd.columns and mixed.count() > 0
    pieces = corpus_pipeline.pack(spark, odd, "")
    assert pieces.count() == odd.count()


def test_pack(stages):
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in stages[0][4].collect():
        ids = whole.encode(r.text or "", add_special_tokens=False).ids + [1]
        for n in range(-(-len(ids) // 4096)):
            part = np.array(ids[4096 * n : 4096 * n + 4096], "<u4")
            want[r.doc_id, n, 4096 * n, len(part), zlib.crc32(part.tobytes())] += 1
    got = stages[0][5]
    assert Counter(tuple(r) for r in got.select("doc_id", "piece", "start", "length", "ids_crc32").collect()) == want
    bins = got.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r.n == r.end <= 4096 for r in bins)


def test_run(stages, spark):
    got = corpus_pipeline.run(spark, stages[1])
    assert got.count() == stages[0][5].count() and corpus_pipeline.ORACLE_SQL is None
