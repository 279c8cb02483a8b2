"""op5's blocks, products and thresholds against plain sorting."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaymill.llm import op5_topk as op5
from assaymill.llm.shared import ship


@pytest.fixture
def small(monkeypatch):
    """Blocks and tiles so small that few rows make many, in this process."""
    for name, n in {"ROWS": 64, "WIDE": 16, "QUERIES": 8, "ASKED": 16, "HELD": 40, "STEP": 8, "TASK": 512, "GROUPS": 2}.items():
        monkeypatch.setattr(op5, name, n)


def _frame(spark, vectors, slices=3):
    rows = [(int(i), None if v is None else [float(x) for x in v]) for i, v in vectors]
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, slices), "vec_id long, embedding array<double>")


def _expected(vectors, asked, k, scale):
    v = [(i, [int(np.floor(float(x) * scale)) for x in v]) for i, v in vectors]
    out = set()
    for q in asked:
        question = min(x for i, x in v if i == q)
        best = sorted((-sum(a * b for a, b in zip(question, x)), i) for i, x in v if i != q)[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return out


def _got(df, asked, k, scale):
    rows = op5.top_k(df, df.where(F.col("vec_id").isin(asked)), k, scale=scale).collect()
    assert len(rows) == len({tuple(r)[:2] for r in rows})
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("size", [1, 2.0 ** 18, 2.0 ** 25])  # single floats, double floats, Python's integers
def test_blocks_of_every_kind_of_numbers(spark, size):
    rng = np.random.default_rng(7)
    vectors = [(i, np.floor(rng.normal(size=rng.integers(1, 7)) * 8 * size)) for i in range(400)]
    vectors += [(i, vectors[5][1]) for i in range(400, 460)]  # ties
    asked = list(range(0, 460, 23))
    assert _got(_frame(spark, vectors), asked, 4, 1) == _expected(vectors, asked, 4, 1)


def test_rows_are_not_copied_per_query_block(spark):
    """5,000 rows of one partition travel as one block of small numbers, and each block meets all queries once."""
    ship(spark)
    rng = np.random.default_rng(1)
    df = _frame(spark, [(i, x) for i, x in enumerate(rng.normal(size=(5000, 8)))], 1)
    blocks = op5._row_blocks(op5.quantized(df, "vec_id", "embedding", 256)).collect()
    assert len(blocks) == 1 and len(blocks[0]["ids"]) == 5000 * 8 and len(blocks[0]["data"]) == 5000 * 8 * 2
    seen = spark.sparkContext.accumulator(0)
    seen_rows = op5._local_lists

    class Meeting:
        def __init__(self, met):
            self.met = met

        def applyInArrow(self, look, schema):
            def counted(left, right):
                seen.add(sum(len(x) // 8 for x in left["ids"].to_pylist()))
                return look(left, right)

            return self.met.applyInArrow(counted, schema)

    try:
        op5._local_lists = lambda met, k, lists: seen_rows(Meeting(met), k, lists)
        assert op5.top_k(df, df.where("vec_id % 4 = 0"), 3).count() == 1250 * 3
    finally:
        op5._local_lists = seen_rows
    assert seen.value == 5000


def _block(ids, m, lists=4):
    m = np.asarray(m, float)
    dim, kind, data = (x[0].as_py() for x in op5._packed(m))
    return op5._Block({"ids": np.asarray(ids, np.int64).tobytes(), "dim": dim, "kind": kind, "data": data}, lists)


def test_many_groups_and_parts(spark, small):
    """Several groups of blocks meet several parts of the queries; results are the same."""
    rng = np.random.default_rng(11)
    vectors = [(i, rng.integers(-3, 4, 7)) for i in range(300)]
    asked = list(range(0, 300, 3))
    assert _got(_frame(spark, vectors), asked, 3, 1) == _expected(vectors, asked, 3, 1)


def test_tiles_and_places(small):
    """Lists' best entries and entries that reach the cutoff, with repeated ids, over many tiles."""
    rng = np.random.default_rng(3)
    ids = np.sort(rng.integers(0, 120, 203))
    rows, questions = rng.integers(-9, 10, (203, 10)), rng.integers(-9, 10, (8, 10))
    q_ids = np.arange(8) * 15
    block = _block(ids, rows)
    q = block.meet(questions.astype(float))
    for a, b in zip(block.cuts, block.cuts[1:]):
        for i, columns in enumerate(op5._list_best(block, q_ids, q, a, b, 5)):
            partial = rows[:, a:b] @ questions[i, a:b]
            assert len(set(columns)) == 5 and not (ids[columns] == q_ids[i]).any()
            assert sorted(partial[columns]) == sorted(partial[ids != q_ids[i]])[-5:]
    cutoffs = np.array([0, 50, 100, 150, op5._NO_CUTOFF, -200, 10 ** 12, 80])
    at, column, scores = op5._reached(q_ids, q, cutoffs, block.ids, block.rows, 5)
    found = sorted(zip(at, -scores.astype(int), ids[column]))
    exact = rows @ questions.T
    assert found == [x for i in range(8) for x in sorted(
        (i, -exact[j, i], ids[j]) for j in range(203) if ids[j] != q_ids[i] and exact[j, i] >= cutoffs[i])[:5]]


def test_rows_under_the_uniform_threshold_are_not_multiplied():
    """Norms of the lists rule rows out; none that reaches the cutoff is among them."""
    rng = np.random.default_rng(5)
    rows = np.floor(rng.normal(size=(500, 8)) * rng.choice([1, 3, 40], 500)[:, None])
    questions = np.floor(rng.normal(size=(6, 8)) * 20)
    block, exact = _block(range(500), rows), questions @ rows.T
    cutoffs = np.sort(exact, axis=1)[:, -5].astype(np.int64)
    may = op5._may_reach(block, questions, cutoffs, 4)
    assert may.sum() < 250 and may[(exact >= cutoffs[:, None]).any(axis=0)].all()
    cutoffs[2] = 0
    assert op5._may_reach(block, questions, cutoffs, 4).all()


def test_equal_vectors_stay_few(small):
    """In a table of equal vectors the smaller ids win, and no more than k entries per query are kept."""
    block = _block(range(500), np.ones((500, 4)))
    q = block.meet(np.ones((8, 4)))
    at, column, _ = op5._reached(np.arange(8), q, np.full(8, 4), block.ids, block.rows, 3)
    assert [sorted(column[at == i]) for i in range(8)] == [[j for j in range(4) if j != i][:3] for i in range(8)]
