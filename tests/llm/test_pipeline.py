"""The stages of the corpus pipeline over the smallest tables, each held against its own input."""

import collections
import os

import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def shingles(text, n=4):
    w = text.encode().lower().split()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def test_stages(spark, tmp_path):
    import corpus_pipeline as pipeline

    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "lines", "copies", "mixture", "packing"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert out.columns == columns
            before = {r["doc_id"]: r["text"] for r in docs.collect()}
            seen[name] = (before, {r["doc_id"]: r["text"] for r in out.collect()})
            assert out.count() == len(seen[name][1]) <= len(before)
        docs = out

    before, after = seen["toxicity"]
    labels = dict(spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", F.col("toxic")).collect())
    clean = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in clean) >= 0.95 * len(clean)
    assert all(after[i] == before[i] for i in after)

    before, after = seen["lines"]
    for i, text in after.items():
        lines = collections.Counter(before[i].split("\n"))
        assert not collections.Counter(text.split("\n")) - lines

    before, after = seen["copies"]
    sets = {i: shingles(t, 5) for i, t in before.items()}
    for i in before:
        linked = [j for j in before if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
        assert (i in after) or any(j < i for j in linked)
        if i in after and sets[i]:
            assert min(linked) == i

    before, after = seen["mixture"]
    total = sum(len(t.split()) for t in before.values())
    assert 0.8 * total <= sum(len(t.split()) for t in after.values()) <= total

    places, pieces = collections.defaultdict(list), collections.Counter()
    for r in docs.collect():
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]] += 1
    assert set(pieces) == set(after)
    for inside in places.values():
        end = 0
        for offset, length in sorted(inside):
            assert offset == end
            end += length
        assert end <= 4096


def test_copies_are_told_by_five_words_and_four_fifths(spark):
    import corpus_pipeline as pipeline

    def text(seed, n, edits=0):
        w = [f"w{seed}x{k}" for k in range(n)]
        for e in range(edits):
            w[(2 * e + 1) * n // (2 * edits)] = f"new{seed}y{e}of{edits}"
        return " ".join(w)

    # 4 edits in 190 words: 5-word sets agree to 0.8 and more, 4-word sets to less than 0.85
    texts = [text(s, n, e) for s, (n, edits) in enumerate([(190, (0, 4)), (190, (0, 1)), (190, (0, 5)), (90, (0, 2)), (400, (0, 8, 9))]) for e in edits]
    texts += [None, "", "few words", "few words", text(1, 190).upper()]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    sets = [shingles(t or "", 5) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
    narrow = [shingles(t or "", 4) for t in texts[:2]]
    assert group[1] == 0 and 100 * len(narrow[0] & narrow[1]) < 85 * len(narrow[0] | narrow[1])
    kept = sorted(r["doc_id"] for r in pipeline.copies(spark, docs, FOLDER).select("doc_id").collect())
    assert kept == [i for i in range(len(texts)) if group[i] == i]


def test_lines_are_cut_once_per_text(spark):
    """The stage filters on the cut's counts; Spark may not cut again for the columns."""
    import corpus_pipeline as pipeline

    docs = spark.createDataFrame([(1, "a b\nc", "en", "s", 5), (2, None, "en", "s", 0)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    left = pipeline.lines(spark, docs, FOLDER)
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython ") == 1
    assert sorted(map(tuple, left.collect())) == [(1, "a b\nc", "en", "s", 5), (2, None, "en", "s", 0)]
