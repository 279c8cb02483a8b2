"""Operators without SQL against plain re-computations of whole tables, and awkward tables for all."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaymill.llm import op1_ngram_join as op1
from assaymill.llm import op2_line_dedup as op2
from assaymill.llm import op3_html_text as op3
from assaymill.llm import op4_line_frequency as op4
from assaymill.llm import op5_topk as op5
from assaymill.llm import op6_mixing as op6
from assaymill.llm import op7_toxicity as op7
from assaymill.llm import op8_superkmers as op8
from assaymill.llm import op9_packing as op9
from assaymill.llm import op10_secrets as op10
from assaymill.llm.queries import QUERIES, tokenizer_path
from assaymill.llm.shared import ship

# --- op10 ---------------------------------------------------------------------------------------------------

BASE = (
    ("assign", re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
                          r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)"""), 6),
    ("access", re.compile("(AKIA[A-Z0-9]+)"), 20), ("hex", re.compile("([0-9a-f]+)"), 24))


def plain_base(text):
    """Every kind for itself, leftmost and non-overlapping; matches that fail are dropped afterwards."""
    found = []
    for place, (kind, pattern, least) in enumerate(BASE):
        found += [(m.start(), place, m.end(), kind, m[1]) for m in pattern.finditer(text) if len(m[1]) >= least]
    return sorted(found)


def random_looking(value):
    counts = collections.Counter(value)
    return -sum(c / len(value) * math.log2(c / len(value)) for c in counts.values()) >= 0.75 * math.log2(min(len(value), 16))


def plain_candidates(text):
    spans = {(end - len(value), end): value for _, _, end, _, value in plain_base(text)}
    for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", text):
        mixed = all(re.search(p, m[0]) for p in ("[0-9]", "[a-z]", "[A-Z]"))
        if mixed and all(m.end() <= s or e <= m.start() for s, e in spans):
            spans[m.span()] = m[0]
    return {span: v for span, v in spans.items() if random_looking(v)}


def secret_texts(seed, n):
    rng = random.Random(seed)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    pool = ["".join(rng.choice(letters) for _ in range(rng.choice([6, 12, 24, 40]))) for _ in range(25)]
    pool += ["AKIA" + "".join(rng.choice(letters[:26] + letters[52:]) for _ in range(16)) for _ in range(6)]
    pool += ["".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([23, 24, 32, 64]))) for _ in range(8)] + ["aaaaaaaa", "x" * 30, "A1a" * 9]
    frames = ["password = '{}'", 'TOKEN:"{}"', "api_key={}", "Passwd: {} ", "{}", "é {} ß", "secret : = {}", "apikey = {}.{}", "token token={}", "\n{}\n"]
    rows = []
    for k in range(n):
        parts = [rng.choice(frames).format(rng.choice(pool[:4] if rng.random() < .5 else pool), rng.choice(pool)) for _ in range(rng.randint(0, 5))]
        rows.append((k, rng.choice([" ", "", "; ", " text "]).join(parts), rng.choice(["a", "b", "c", "d", "e", None])))
    return [*rows, *rows[:3], (n, None, "a"), (n + 1, "", None), (None, rows[5][1], "f")]


def test_secrets_of_a_whole_table(spark):
    ship(spark)
    rows = secret_texts(3, 250)
    owners, repos, named = collections.defaultdict(set), collections.defaultdict(set), set()
    for _, text, owner in rows:
        for value in plain_candidates(text or "").values():
            owners[value].add(owner)
            repos[value].add(text)
            if owner is not None:
                named.add(value)
    live = {v for v in owners if len(owners[v]) <= 3 and (v in named or len(repos[v]) <= 10)}
    assert live and set(owners) - live
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"spans": F.lit("clash"), "base": F.lit(1)})
    got = collections.Counter(
        (r["doc_id"], tuple((s["kind"], s["start"], s["end"]) for s in r["base"]), tuple((s["start"], s["end"]) for s in r["live"]))
        for r in op10.find_secrets(df).collect())
    expected = collections.Counter(
        (i, tuple((kind, s, e) for s, _, e, kind, _ in plain_base(text or "")),
         tuple(sorted(span for span, v in plain_candidates(text or "").items() if v in live))) for i, text, _ in rows)
    assert got == expected


def test_secrets_query_digests(spark, tmp_path):
    rows = secret_texts(4, 40)
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    texts = {i: t or "" for i, t, _ in rows}
    for r in QUERIES["op10_secrets"](spark, str(tmp_path)).collect():
        base = plain_base(texts[r["doc_id"]])
        joined = ",".join(f"{kind}:{s}:{e}" for s, _, e, kind, _ in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(b[3] == k for b in base) for k, *_ in BASE]


# --- op7 ------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def toxic(spark):
    ship(spark)
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["alpha", "Beta", "gämma", "delta  x", "eps"]) for _ in range(rng.randint(0, 9)))
             + (" vilest" if i % 3 == 0 else "")) for i in range(90)]
    labels = [(i, int(i % 3 == 0)) for i in range(90)]
    return (rows, labels, spark.createDataFrame([*rows, (200, None), (201, "")], "doc_id long, text string"),
            spark.createDataFrame([*labels, (200, 0), (3, 0), (None, 1), (8, None), (9, 7)], "doc_id long, toxic int"))


def ngrams(text):
    """Character n-grams as such: over lower case, white space as single blanks."""
    plain = f" {' '.join(text.lower().split())} "
    return {plain[i:i + n] for n in op7.ORDERS for i in range(len(plain) - n + 1)}


def test_counts_and_ratios_of_a_whole_sample(spark, toxic):
    rows, labels, docs, given = toxic
    sample = op7.sample_of(docs, given, F.lit(True), 1000, "doc_id", "text", "toxic")
    assert sorted(map(tuple, sample.collect())) == sorted([(t, l) for (_, t), (_, l) in zip(rows, labels)] + [("", 0)])
    assert op7.sample_of(docs, given, F.lit(True), 10, "doc_id", "text", "toxic").count() == 10
    both, n = op7._document_counts(sample)
    assert n.tolist() == [61, 30]
    plain = [collections.Counter(), collections.Counter()]
    for (_, text), (_, label) in zip(rows, labels):
        plain[label].update(ngrams(text))
    for (_, text) in rows[:20]:  # a feature is its n-gram's hash: of the text's own n-grams, no more and no fewer
        assert len(set(op7.features(text).tolist())) <= len(ngrams(text)) <= len(op7.features(text)) or not text
    every = set(plain[0]) | set(plain[1])
    slot = {g: int(s) for g in every for s in [_slot(g)]}
    alone = {s for s, c in collections.Counter(slot.values()).items() if c == 1}
    checked = [g for g in every if slot[g] in alone]
    assert len(checked) > 0.9 * len(every)
    for g in checked:
        assert (both[0, slot[g]], both[1, slot[g]]) == (plain[0][g], plain[1][g]), g
    ratios = op7._log_ratios(both, n, 200)
    kept = np.flatnonzero(ratios)
    assert 0 < len(kept) <= 200
    for g in checked:
        if ratios[slot[g]]:
            assert math.isclose(ratios[slot[g]], math.log((plain[1][g] + 1) / 32) - math.log((plain[0][g] + 1) / 63), rel_tol=1e-5)
    # what is kept differs more from chance than what is not
    def distance(g):
        seen = plain[0][g] + plain[1][g]
        expected = 30 * seen / 91
        return abs(plain[1][g] - expected) / math.sqrt(max(expected * (1 - seen / 91), 1e-9)) if seen >= 3 else 0.0
    inside, outside = [distance(g) for g in checked if ratios[slot[g]]], [distance(g) for g in checked if not ratios[slot[g]]]
    assert min(inside) >= max(outside) - 1e-9


def _slot(gram):
    """The feature of one n-gram, from the text that consists of it: the last of its order."""
    h = 0
    mask = (1 << 64) - 1
    a, b, c = (int(x) for x in (op7._A, op7._B, op7._C))
    for ch in gram:
        h = (h * a + ord(ch) * b) & mask
        h ^= h >> 29
    return ((h * c) & mask) >> (64 - op7.BITS)


def test_one_gradient_step(spark):
    """A fit of one step, and of a few, against the formulas written out per text and feature."""
    rng = np.random.default_rng(3)
    ratios = np.zeros(1 << op7.BITS, np.float32)
    ids = np.sort(rng.choice(1 << op7.BITS, 12, replace=False)).astype(np.int32)
    ratios[ids] = rng.normal(size=12)
    found = [np.sort(rng.choice(ids, rng.integers(0, 6), replace=False)) for _ in range(15)]
    label = rng.integers(0, 2, 15).astype(float)
    for steps in (1, 4):
        w, bias = dict.fromkeys(ids.tolist(), 0.0), 0.0
        mean, square = collections.defaultdict(float), collections.defaultdict(float)
        for t in range(1, steps + 1):
            g = dict.fromkeys([*ids.tolist(), "bias"], 0.0)
            for f, y in zip(found, label):
                length = math.sqrt(sum(float(ratios[k]) ** 2 for k in f))
                x = {int(k): float(ratios[k]) / length for k in f}
                error = (1 / (1 + math.exp(-(sum(w[k] * v for k, v in x.items()) + bias))) - y) / len(label)
                for k, v in x.items():
                    g[k] += error * v
                g["bias"] += error
            for k in w:
                g[k] += 1e-6 * w[k]
            for k, v in g.items():
                mean[k] = 0.9 * mean[k] + 0.1 * v
                square[k] = 0.99 * square[k] + 0.01 * v * v
                step = 0.1 * (mean[k] / (1 - 0.9 ** t)) / (math.sqrt(square[k] / (1 - 0.99 ** t)) + 1e-9)
                if k == "bias":
                    bias -= step
                else:
                    w[k] -= step
        model = op7._fit(found, label, ratios, steps=steps)
        assert math.isclose(model.bias, bias, rel_tol=1e-6, abs_tol=1e-9)
        for k in ids.tolist():
            assert math.isclose(model.weight[k], w[k] * ratios[k], rel_tol=1e-4, abs_tol=1e-6)


# --- awkward tables ---------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def awkward(spark):
    """Repeated rows, null ids and texts, a very long text, and columns named like the operators' own."""
    ship(spark)
    rng = random.Random(9)
    texts = [None, "", " \n ", "one", " ".join(f"w{rng.randrange(60)}" for _ in range(20_000)),
             "\n".join(f"line {k} of a text that repeats itself" for k in range(12)), "token = Abc123XyZ987qweRTY456"]
    rows = [(i, t, "en", f"web{i % 2}" if i % 3 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], rows[4], (None, texts[5], None, None, None), (None, None, None, None, None)]
    clash = {c: F.lit("clash") for c in ("row", "key", "sid", "size", "copy", "doc", "pos", "runs", "score", "tokens", "domain", "epoch",
                                         "piece", "length", "sequence_id", "base", "found", "kept", "n_words", "component")}
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns(clash)


OPERATORS = {
    "op1": lambda d: op1.ngram_components(d).select("doc_id", "n_shingles", "component_id"),
    "op2": lambda d: op2.dedup_lines(d).select("row.doc_id", "text", "n_lines", "n_removed", "row.pos"),
    "op4": lambda d: op4.line_frequency_rules(d),
    "op6": lambda d: op6.mix(d, op6.share_of_corpus(100), F.coalesce("source", F.lit("x")), {"domain": {"web0": 1, "web1": 1, "x": 1}, "language": {}, "source": {}}).select(
        "row.doc_id", "row.epoch", "tokens"),
    "op8": lambda d: op8.remove_repeats(d).select("doc_id", "n_words"),
    "op9": lambda d: op9.tokenize_and_pack(d, tokenizer_path()).groupBy("doc_id").agg(F.sum("length").alias("n")),
    "op10": lambda d: op10.find_secrets(d).select("doc_id", F.size("base").alias("n")),
}


@pytest.mark.parametrize("name", list(OPERATORS))
def test_awkward_tables(spark, awkward, name):
    run = OPERATORS[name]
    out = run(awkward).collect()
    if name in ("op1", "op2", "op8", "op10"):
        assert collections.Counter(r["doc_id"] for r in out) == collections.Counter(r["doc_id"] for r in awkward.select("doc_id").collect())
    if name == "op10":
        assert len({tuple(r) for r in out if r["doc_id"] == 5}) == 1
    if name == "op9":
        n = {r["doc_id"]: r["n"] for r in out}
        assert set(n) == {None, *range(7)} and n[0] == n[1] == n[2] == 1 and n[4] % 2 == 0 and n[5] % 3 == 0
    assert run(awkward.limit(0)).count() == 0


def test_repeated_and_null_vectors(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [2.0, 1.0]), (1, [1.0, 1.0]), (None, [5.0, 5.0]), (2, None), (3, [float("nan"), 1.0])]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, embedding array<double>, score string, rank int")
    out = op5.top_k(df, df.where("vec_id % 50 = 0"), 5).select("query_id", "rank", "vec_id", "score").collect()
    scores = {q: sorted((r["vec_id"], r["score"]) for r in out if r["query_id"] == q) for q in (0, 50)}
    v = {0: (256, 512), 50: (512, 256), 1: (256, 256)}
    dot = lambda a, b: sum(x * y for x, y in zip(v[a], v[b]))
    assert scores[0] == [(1, dot(0, 1)), (50, dot(0, 50))]
    assert scores[50] == [(0, dot(50, 0)), (0, dot(50, 0)), (1, dot(50, 1))]


def test_pages_with_clashing_columns_and_repeats(spark):
    page = "<article><p>a text</p></article>"
    rows = [(1, "http://h/a", page), (1, "http://h/a", page), (None, None, page), (2, "http://h/b", None)]
    df = spark.createDataFrame([(*r, "clash", "clash", 7) for r in rows], "page_id long, url string, html string, text string, host string, copy int")
    out = op3.extract_text(df).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in out) == [(0, "a text", 6), (1, "a text", 6), (1, "a text", 6), (2, "", 0)]


def test_stages_on_awkward_tables(spark, awkward, tmp_path):
    import corpus_pipeline as pipeline

    spark.createDataFrame([(5, 0), (6, 1), (3, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    plain = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    for docs in (plain, plain.limit(0), awkward):
        before = collections.Counter(map(str, docs.select("doc_id", "text").collect()))
        for name, stage in pipeline.STAGES[:4]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            if name != "lines":
                assert not collections.Counter(map(str, out.select("doc_id", "text").collect())) - before, name
        packed = pipeline.packing(spark, docs, str(tmp_path))
        assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_op1_places_with_equal_ends_are_searched_as_one(spark, monkeypatch):
    """Sets that meet at several n-grams move once to all of them, and every pair is still found."""
    counts, real = {}, op1.staged

    def counted(df, name):
        out = real(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(op1, "staged", counted)
    met = {10: (1, 2, 9), 11: (1, 3, 9), 12: (1, 2, 3, 9), 13: (4, 9)}
    places = spark.createDataFrame([(t, s) for t, sids in met.items() for s in sids], "token long, sid long")
    bits = op1.bitmap(np.arange(10, dtype=np.uint64) << np.uint64(20))
    rows = spark.createDataFrame([(s, s, s, 10, bits) for s in (1, 2, 3, 4, 9)], "doc_id long, key long, sid long, size long, bits binary")
    comps = spark.createDataFrame([], "node long, component long")
    found = op1._tree_pairs(places, rows, rows.select("sid", "key"), comps, 85, None)
    assert {(r["u"], r["v"]) for r in found.collect()} == {(1, 2), (1, 3), (1, 9), (2, 3), (2, 9), (3, 9), (4, 9)}
    assert counts["members"] == 6
