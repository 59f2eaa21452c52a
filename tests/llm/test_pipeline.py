"""The pipeline stage by stage, and that the rest of the library does without it."""

import inspect
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import decontaminate, langid, simhash, toxicity

from ..conftest import DATA, ROOT

SF = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no shared tables here")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, columns = docs, docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.columns == columns
        kept, had = {r.doc_id for r in after.collect()}, {r.doc_id: r for r in before.collect()}
        assert kept <= set(had) and after.count() == len(kept)
        if name == "toxicity":
            model = toxicity.train(before, spark.read.parquet(f"{SF}/labels.parquet").where(~toxicity.held_out()))
            assert kept == {r.doc_id for r in toxicity.score(before, model).collect() if r.score < 0.3}
        if name == "language_id":
            assert set(had) - kept == {r.doc_id for r in langid.predict(before, langid.train(before.where(~langid.held_out()))).collect() if r.lang_pred == "und"}
        if name == "simhash_dedup":
            first = {r.component_id for r in simhash.near_duplicates(before).collect()}
            sets = {k: simhash.shingle_set((had[k].text or "").encode()) for k in first}
            near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) > 0
            assert kept <= first and all(any(near(k, o) for o in first - {k}) for k in first - kept)
            assert not any(near(a, b) for a in kept for b in kept if a < b)
        if name == "decontamination":
            hit = decontaminate.scan(before, spark.read.parquet(f"{SF}/benchmark.parquet")).where(decontaminate.contaminated())
            assert set(had) - kept == {r.doc_id for r in hit.collect()} != set()
        before = after
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in before.collect()}
    assert all(sum(r.length for r in rows if r.doc_id == k) == n for k, n in {(r.doc_id, r.doc_tokens) for r in rows})


def test_empty_and_odd_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, 0), (3, "plain words here", "en", "s", 3), (3, "plain words here", "en", "s", 3), (4, "1 2 3", None, None, None)], schema)
    for docs in (odd, odd.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, SF)
            found.collect()
    assert [r.doc_id for r in corpus_pipeline.keep_one_of_each_group(spark, odd, SF).orderBy("doc_id").collect()] == [1, 3, 4]
    rows = [(7, "one text of its own", None), (7, "and another that is unlike it", "x"), (8, "and another that is unlike it", None), (None, "without an id", None), (None, "nor has this an id at all", None), (None, "without an id", None), (5, "alpha", None), (5, "beta", None)]
    shared = spark.createDataFrame(rows, "doc_id long, text string, row string")
    for n in (1, 3):  # unlike texts that share an id or have none all stay, however rows are dealt; copies go
        kept = [(r.doc_id, r.text) for r in corpus_pipeline.keep_one_of_each_group(spark, shared.repartition(n), SF).collect()]
        assert sorted(kept, key=str) == sorted([(7, "one text of its own"), (7, "and another that is unlike it"), (None, "without an id"), (None, "nor has this an id at all"), (5, "alpha"), (5, "beta")], key=str)


def test_the_rest_does_without(tmp_path):
    code = "import sys; sys.modules['ledgerloom.llm'] = None; import __spark_entry__ as e; n = e.queries(); assert 'price_spread' in n and 'pipeline' not in n; print(len(n))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr


def edits(rng, words, n, changes):
    """``n`` texts, each with ``changes`` words of ``words`` replaced by words of its own."""
    out = []
    for k in range(n):
        text = list(words)
        for j, at in enumerate(rng.sample(range(0, len(words), 6), changes)):
            text[at] = f"own{k}x{j}"
        out.append(" ".join(text))
    return out


def brute_classes(rows):
    sets = {k: simhash.shingle_set(t.encode()) for k, t in rows}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) > 0:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in sets if sum(find(o) == find(k) for o in sets) > 1}


@pytest.mark.parametrize("least_tile", [8, 128])
def test_star_of_copies(spark, least_tile):
    """Copies that are like their original, not like each other, meet it in full bands."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(240)]
    rows = [(0, " ".join(words))] + list(enumerate(edits(rng, words, 160, 5), 1))
    other = [f"z{k}" for k in range(240)]
    rows += list(enumerate([" ".join(other), *edits(rng, other, 5, 4)], 500)) + [(600, "alone " * 50)]
    want = brute_classes(rows)
    assert all(want[k] == 0 for k in range(161))
    found = simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), least_tile=least_tile).collect()
    assert {r.doc_id: r.class_id for r in found} == want


def test_copies_that_repeat_lines(spark):
    """The same shingles, repeated or not, are a copy, though fingerprints differ."""
    rng = random.Random(5)
    rows = []
    for k in range(40):
        words = [f"w{k}x{j}" for j in range(200)]
        for j, at in enumerate(rng.sample(range(0, 160), 2)):
            rows.append((2 * k + j, " ".join(words + (words[at : at + 14] + ["end"]) * 30)))
    want = brute_classes(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = simhash.near_copies(df, df).collect()
    assert {r.doc_id: r.class_id for r in found} == want and len(want) == 80


def test_set_links():
    """Every pair of one tile and across two, where parities say nothing, little or enough."""
    rng = np.random.default_rng(7)
    for size in (1, 4, 60, 3000):
        sets = [np.unique(rng.integers(-(1 << 63), (1 << 63) - 1, size)) for _ in range(40)]
        for k in range(260):
            own = sets[k % 40].copy()
            changed = rng.integers(0, size, int(size * rng.choice([0, 0.1, 0.11, 0.12, 0.3])))
            own[changed] = rng.integers(-(1 << 63), (1 << 63) - 1, len(changed))
            sets.append(np.unique(own[: max(1, size - k % 5)]))
        for tiles in (np.zeros(300), np.repeat([0, 1], [140, 160])):
            near = simhash.alike(sets, tiles, 0.8)
            want = simhash.spanning_forest(*np.nonzero(near), np.arange(300))
            got = simhash.set_links(sets, tiles, 0.8)
            assert near[got].all()
            assert [x.tolist() for x in simhash.spanning_forest(*got, np.arange(300))] == [x.tolist() for x in want]


def test_a_large_band_sends_its_rows_a_few_times(spark):
    """A band of unlike documents: rows grow in proportion, not with the tiles of its root."""
    members = spark.range(2000).selectExpr("1L as key", "id as doc_id", "150L as size", "id as comp")
    default = inspect.signature(simhash.copy_links).parameters["least_tile"].default
    groups = simhash.band_groups(members, default).groupBy("grp").agg(F.collect_set("doc_id").alias("ids")).collect()
    met = np.zeros((2000, 2000), bool)
    for g in groups:
        met[np.ix_(g.ids, g.ids)] = True
    assert met.all() and sum(len(g.ids) for g in groups) <= 3 * 2000
