"""Byte-level BPE, whitening and conversation repair against plain definitions."""

import collections
import functools
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from assaymill.llm import op11_byte_bpe as op11
from assaymill.llm import op12_whitening as op12
from assaymill.llm import op13_conversation_repair as op13
from assaymill.llm.queries import QUERIES
from assaymill.llm.shared import ship

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    return op11.load(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=op11.read_ranks(RANKS), special_tokens={})


def ids_of(data):
    return np.frombuffer(data, "<u4").tolist()


# --- op11 ---------------------------------------------------------------------------------------------

def test_bpe_equals_the_library_on_odd_strings(codec, library):
    rng = random.Random(7)
    letters = ["abcdefghijklmnopqrstuvwxyz", "ab", " \n\tab", "aeinst ", "é中\U0001f600ab  ", "0123456789 .",
               "!?.-_ \r\n\x85\xa0 a", "'strevmldSTR a\x1c\x00", "﻿́‍क ा"]
    for k in range(4000):
        text = "".join(rng.choice(letters[k % len(letters)]) for _ in range(rng.randint(0, 50)))
        expected = library.encode_ordinary(text)
        assert ids_of(codec.encode(text)) == expected, text
        assert ids_of(codec.encode(text, whole=True)) == expected, text
        assert codec.decode(expected) == text.encode()
    for text in ("a" * 30_000, " " * 30_000, "ab" * 20_000, "!" * 9_000, "".join(rng.choice("abcdefgh") for _ in range(30_000))):
        assert ids_of(codec.encode(text)) == library.encode_ordinary(text)


def test_bpe_equals_merging_by_rank_on_small_vocabularies():
    rng = random.Random(3)
    for trial in range(40):
        ranks = {bytes([b]): b for b in range(256)}
        while len(ranks) < 256 + 30:
            pair = [rng.choice([t for t in ranks if set(t) <= set(b"abc")]) for _ in range(2)]
            # regular vocabularies: the pair stands side by side once lower merges are done
            if b"".join(pair) not in ranks and (trial % 4 == 0 or op11.merged_by_rank(b"".join(pair), ranks) == pair):
                ranks[b"".join(pair)] = len(ranks)
        codec = op11.ByteBpe(ranks, r"[\s\S]+")
        assert codec.regular or trial % 4 == 0
        for _ in range(100):
            text = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 25)))
            expected = [ranks[text]] if text in ranks else [ranks[p] for p in op11.merged_by_rank(text, ranks)]
            assert codec.encode_match(text) == expected, (trial, text)


def test_bpe_lacking_bytes_and_unknown_ids(codec):
    with pytest.raises(ValueError):
        op11.ByteBpe({b"a": 0}, ".")
    with pytest.raises(KeyError):
        codec.decode([1 << 30])


def test_bpe_tables(spark, codec, library):
    ship(spark)
    texts = [None, "", " ", "It's  two\n\nlines.", "same", "same", "x" * 300_000, "Ünï  çode ß\t"]
    rows = [(k if k else None, t, b"clash", "clash") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids binary, bytes string")
    out = op11.decode(op11.encode(docs, codec), codec)
    got = {r["row"]["doc_id"]: r for r in out.select("*", op11.n_tokens().alias("n")).collect()}
    assert len(got) == len(texts)
    for (key, text, clash, other) in rows:
        expected = library.encode_ordinary(text or "")
        r = got[key]
        assert ids_of(r["ids"]) == expected and r["n"] == len(expected)
        assert bytes(r["bytes"]) == (text or "").encode()
        assert bytes(r["row"]["ids"]) == clash and r["row"]["bytes"] == other
    assert op11.encode(docs.limit(0), codec).count() == 0
    assert op11.decode(spark.createDataFrame([(1, None)], "row long, ids binary").select(F.struct("row").alias("row"), "ids"), codec) \
        .first()["bytes"] == b""


def test_op11_query(spark, library, tmp_path):
    texts = [None, "", "Hello  there,\nit's 2024!", "ßé", "ßé"]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for r in QUERIES["op11_byte_bpe"](spark, str(tmp_path)).collect():
        text = texts[r["doc_id"]] or ""
        ids = library.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


# --- op12 ---------------------------------------------------------------------------------------------

def whole_matrix(rng, d, rank=None):
    a = rng.integers(-20, 20, (rank or d + 2, d)).astype(object)
    return (a.T @ a).tolist()


def test_characteristic_polynomial_and_roots(spark):
    ship(spark)
    rng = np.random.default_rng(5)
    for d, rank in ((1, None), (2, 1), (5, None), (6, 3), (9, None)):
        m = whole_matrix(rng, d, rank)
        p = op12.characteristic_polynomial(spark, m)
        # Faddeev and LeVerrier, in whole numbers
        coefficients, work = [1], np.zeros((d, d), object)
        for k in range(1, d + 1):
            work = np.array(m, object) @ work + np.eye(d, dtype=int).astype(object) * coefficients[-1]
            coefficients.append(-int(np.trace(np.array(m, object) @ work)) // k)
        assert p == coefficients[::-1]
        values = np.linalg.eigvalsh(np.array(m, float))[::-1]
        values = values[values > 1e-6 * values[0]]
        got = op12.largest_roots(p, d)
        assert np.allclose([r.value / 2 ** r.bits for r in got for _ in range(r.multiplicity)], values, rtol=1e-9)


def test_multiple_roots_have_orthonormal_components():
    m = np.diag([4, 9, 9, 9, 2]).astype(object)
    turn = np.array([[1, 1, 1, 1, 0], [1, -1, 1, -1, 0], [1, 1, -1, -1, 0], [1, -1, -1, 1, 0], [0, 0, 0, 0, 2]], object)  # rows of length 2
    m = (turn.T @ m @ turn).tolist()  # eigenvalues 16, 36 three times, 8
    p = [1]
    for root in (16, 36, 36, 36, 8):
        p = [(p[k - 1] if k else 0) - root * (p[k] if k < len(p) else 0) for k in range(len(p) + 1)]
    roots = op12.largest_roots(p, 5)
    assert [(r.value >> r.bits, r.multiplicity) for r in roots] == [(36, 3), (16, 1), (8, 1)]
    v = np.array([[int(x) / 2 ** op12.BITS for x in u] for r in roots for u in op12.eigenvectors(m, r)])
    assert np.allclose(v @ v.T, np.eye(5), atol=1e-14)
    assert np.allclose(v @ np.array(m, float) @ v.T, np.diag([36, 36, 36, 16, 8]), atol=1e-12)


def check_whitening(out, vectors, scale, offset, components):
    """Everything again with numpy, rows with integers x."""
    x = {k: [int(np.floor(scale * c)) + offset for c in v] for k, v in vectors.items()}
    fit = np.array(sorted(set(map(tuple, x.values()))), object)
    n, s = len(fit), fit.sum(axis=0)
    centred = (fit * n - s).astype(float) / n
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    many = min(components, int((values > 1e-9 * values[0]).sum()))
    got = collections.defaultdict(dict)
    for r in out:
        got[r["vec_id"]][r["component"]] = r
        assert r["n"] == n and r["identity_error"] <= 1e-4
        assert np.isclose(r["explained"], values[r["component"] - 1] / values.sum(), rtol=1e-6)
        assert r["deviation"] == sum((n * a - b) ** 2 for a, b in zip(x[r["vec_id"]], s))
    assert set(got) == set(x) and all(sorted(c) == list(range(1, many + 1)) for c in got.values())
    for k in range(1, many + 1):
        expected = np.array([((np.array(x[i], object) * n - s).astype(float) / n) @ axes[:, k - 1] / np.sqrt(values[k - 1]) for i in x])
        mine = np.array([got[i][k]["whitened"] for i in x])
        assert min(np.abs(expected - mine).max(), np.abs(expected + mine).max()) < 1e-8


def test_whitening_against_numpy(spark):
    ship(spark)
    rng = np.random.default_rng(2)
    vectors = {k: (rng.normal(size=6) * [3, 2, 1, .7, .5, .3]).tolist() for k in range(300)}
    for k in range(300, 420):
        vectors[k] = vectors[7]  # a third are one vector
    vectors[500] = [*vectors[1][:4], 0.0, 0.0]
    rows = [(k, v, "clash", 5) for k, v in vectors.items()]
    rows[-1] = (500, vectors[1][:4], "clash", 5)  # shorter: ends in zeros
    bad = [(600, None, "", 1), (601, [1.0, None, 1., 1., 1., 1.], "", 1), (602, [float("nan")] * 6, "", 1), (603, [float("inf")] * 6, "", 1)]
    frame = spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<double>, y string, component int")
    check_whitening(op12.whiten(frame).collect(), vectors, 64, 1_000_000, 16)
    few = op12.whiten(frame, components=2).collect()
    assert {r["component"] for r in few} == {1, 2}
    repeated = op12.whiten(spark.createDataFrame([*rows, rows[0], (None, *rows[3][1:])], frame.schema)).collect()
    assert len(repeated) == 6 * (len(rows) + 2) and sum(r["vec_id"] is None for r in repeated) == 6


def test_whitening_of_few_equal_and_huge_vectors(spark):
    ship(spark)
    kind = "vec_id long, embedding array<double>"

    def run(*vectors):
        return op12.whiten(spark.createDataFrame(list(enumerate(vectors)), kind)).collect()

    assert run() == [] and run([]) == [] and run([1.0, 2.0], [1.0, 2.0]) == []
    line = run([0.0, 1.0], [1.0, 1.0], [3.0, 1.0])  # rank 1
    assert [r["component"] for r in line] == [1, 1, 1] and line[0]["explained"] == 1.0
    huge = run([1e300, 0.0], [-1e300, 1.0], [5.0, 7.0])
    assert {r["component"] for r in huge} == {1, 2} and all(r["deviation"] is None for r in huge[:4])
    big = {0: [1e8, 0.0, 3.0], 1: [-2e8, 4.0, 1.0], 2: [5e7, -7.0, 2.0], 3: [1.0, 2.0, 9.0]}
    out = run(*big.values())
    n, s = 4, [sum(int(np.floor(64 * v[i])) for v in big.values()) for i in range(3)]
    for r in out:
        expected = sum((n * int(np.floor(64 * c)) - t) ** 2 for c, t in zip(big[r["vec_id"]], s))
        assert r["deviation"] == (expected if expected < 1 << 63 else None) and r["identity_error"] <= 1e-4


# --- op13 ---------------------------------------------------------------------------------------------

def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if x is None else x for x in (conv, turn, role, text)]
        c = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        if c == 0:
            out.append((conv, turn, None, None, True))
            continue
        text = "" if c == 1 else re.sub("[.!?]", "", shown[3]) if c == 2 else shown[3]
        out += [(conv, turn, "user" if c == 4 else shown[2], text, False)] * (2 if c == 3 else 1)
    return out


def repaired(rows, costs):
    """The contract, edit by edit, for one conversation's (turn, role, text) in order."""
    faults, seen = [], set()
    for _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("b" if not body else "d" if (role, text) in seen else "k" if body[-1] in ".!?" else "t")
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]
    turns = [t for t, _, _ in rows if t is not None]
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @functools.lru_cache(None)
    def best(k, state, inserts):
        ways = []
        if k < len(rows):
            _, role, text = rows[k]
            cost, audit, out = best(k + 1, state, 0)
            ways.append((cost + costs.delete, "D" + audit, out))
            extra = costs.truncated if faults[k] == "t" else 0
            if faults[k] in "kt":
                for initial, new, price, name in ((initials[k], role, 0, "K"), ("u", "user", costs.rerole, "R"), ("a", "assistant", costs.rerole, "R")):
                    if initial in after[state]:
                        cost, audit, out = best(k + 1, after[state][initial], 0)
                        ways.append((cost + extra + price, name + audit, (f"{new}:{text}",) + out))
        elif state in ("", "a"):
            ways.append((0, "", ()))
        if inserts < 3:
            for initial, new in (("u", "user"), ("a", "assistant")):
                if initial in after[state]:
                    cost, audit, out = best(k, after[state][initial], inserts + 1)
                    ways.append((cost + costs.insert, "I" + audit, (f"{new}:",) + out))
        return min(ways) if ways else (10 ** 9, "", ())

    cost, audit, out = best(0, "", 0)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in "bdt"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def conversations(seed, n, longest, ids=None):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "unknown", "s"]
    texts = ["Yes.", "No", "What?", "", " \n", None, "Well!", "Right. ", "so", "é。"]
    rows = []
    for c in range(n):
        for turn in range(rng.randint(1, longest)):
            text = rng.choice(texts) if rng.random() < .5 else f"Text {rng.random()}" + rng.choice([".", ""])
            rows.append((ids[c] if ids else c, turn if rng.random() > .05 else None, rng.choice(roles[:4] if rng.random() < .7 else roles), text))
    return rows


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.mark.parametrize("costs", [op13.Costs(), op13.Costs(3, 7, 1, 2), op13.Costs(2, 4, 2, 0), op13.Costs(1, 1, 1, 5)])
@pytest.mark.parametrize("segment_rows", [4096, 3])
def test_repair_against_every_way_of_editing(spark, costs, segment_rows):
    ship(spark)
    rows = conversations(11, 60, 9) + conversations(12, 3, 150, [1001, 1002, None])
    # one turn's rows stand by role and hash: leave their order to no chance here
    rows = list({(r[0], r[1]): r for r in rows}.values())
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    out = op13.repair(op13.damage(frame), costs, "lost", segment_rows=segment_rows)
    got = {r[0]: tuple(r)[1:] for r in out.collect()}
    expected = collections.defaultdict(list)
    for conv, turn, role, text, lost in damaged(rows):
        expected[conv] += [] if lost else [(turn, role, text)]
    assert set(got) == set(expected)
    for conv, given in expected.items():
        assert got[conv] == repaired(in_order(given), costs), conv


def test_repair_with_or_without_rules(spark):
    ship(spark)
    rows = conversations(5, 40, 30)
    frame = op13.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    outs = [sorted(map(tuple, op13.repair(frame, lost_col="lost", rules=r, rounds=n, segment_rows=k).collect()))
            for r, n, k in ((1024, 10, 4096), (1, 1, 4096), (5, 3, 7))]
    assert outs[0] == outs[1] == outs[2] and len(outs[0]) == 40


def test_re_pair_compresses_and_expands_back(spark):
    ship(spark)
    strings = ["!\"#$" * 50, "\"#" * 30, "%", "!\"#"]
    rules = op13.re_pair(spark.createDataFrame([(s,) for s in strings], "s string"))
    grammar = op13.Grammar(rules, op13.Costs())
    for s in strings:
        short = grammar.compressed(s)
        while any(c in grammar.pair_of for c in short):
            short = "".join(grammar.pair_of.get(c, c) for c in short)
        assert short == s
    assert len(grammar.compressed(strings[0])) < 10


def test_repair_of_nothing_repeats_and_clashing_columns(spark):
    ship(spark)
    kind = "conv_id long, turn long, role string, text string, seg long, marks string, lost boolean"
    nothing = hashlib.sha256(b"").hexdigest()
    assert op13.repair(spark.createDataFrame([], kind)).count() == 0
    rows = [(1, 0, "user", "Hi.", 4, "x", True), (2, 0, "user", "Hi.", 4, "x", None), (2, 0, "user", "Hi.", 4, "x", False),
            (2, 1, "assistant", "So " * 100_000 + ".", 4, "x", False), (3, None, None, None, 4, "x", False)]
    got = {r[0]: tuple(r)[1:] for r in op13.repair(spark.createDataFrame(rows, kind), lost_col="lost").collect()}
    assert got[1] == (0, 0, 0, 0, 0, 0, "", nothing) and got[3] == (0, 1, 0, 0, 0, 2, "D", nothing)
    assert got[2][:7] == (0, 0, 1, 0, 1, 2, "KDK")
    with pytest.raises(ValueError):
        op13.Costs(insert=0)


def test_hot_conversation_is_divided(spark):
    ship(spark)
    rows = conversations(8, 1, 3000) + conversations(9, 300, 5, range(10, 310))
    rows = [(c, k, r, t) for k, (c, _, r, t) in enumerate(rows)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    parts = op13.segments(frame.withColumn("lost", F.lit(False)).na.fill(" "), 100).where("conv_id = 0")
    assert parts.count() >= len([r for r in rows if r[0] == 0]) // 100
    got = {r[0]: tuple(r)[1:] for r in op13.repair(op13.damage(frame), lost_col="lost", segment_rows=100).collect()}
    for conv in (0, 10, 200):
        given = [r[1:4] for r in damaged(rows) if r[0] == conv and not r[4]]
        import sys
        sys.setrecursionlimit(60_000)
        assert got[conv] == repaired(given, op13.Costs())
