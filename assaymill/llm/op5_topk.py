"""Exact top-k search by three-phase uniform threshold.

Scores are inner products of integer vectors, summed over ``lists`` groups of dimensions; each
group is a list of partial scores. Rows are packed in blocks as they lie in their partition; a task
has some blocks and all queries, or a part of them where there are more than ``TASK`` values. So
queries are copied once per task, and rows once per part, not once per few queries.

1. Each list of a block gives its k best entries per query; their scores are completed, and the k
   best of them go to the query. The k-th best over all blocks is a safe cutoff: k rows reach it.
2. The cutoff comes back to the blocks. A row whose partial scores all lie under cutoff / lists
   cannot reach it. Norms bound partial scores, so rows under this uniform threshold in every list,
   or whose whole norm stays under the cutoff, are dropped before anything is multiplied.
3. The scores of what is left are resolved exactly; those that reach the cutoff are ranked.

Products are taken over tiles of queries and rows that stay in a core's cache. A list's best entries
are found by places: row i stands at place i mod ``WIDE``, only the greatest partial score of each
place is kept, and the k best entries lie at the k places with the greatest ones.

Arithmetic is in integers, held in single or double floats while every sum stays below 2^24 or 2^53,
else in Python's.

Defined results: vectors that are null or hold null or non-finite components take no part, nor
rows with null vec_id; an empty vector scores 0; shorter vectors end in zeros; a vec_id given twice
is two candidates, and one query (its least vector); a query with no candidates gives no row; an
empty table gives an empty table. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..local import local_table
from .shared import map_arrow, staged

#: Rows and values of a packed block at most, rows packed at a time.
ROWS, VALUES, STEP = 1 << 16, 1 << 22, 2048
#: Queries and rows of a tile; queries read at a time.
QUERIES, WIDE, ASKED = 256, 1024, 2048
#: Found entries that are held before they are cut to the k best per query.
HELD = 1 << 16
#: Values of rows, and of queries, that a task has; groups that blocks are dealt to, if these values make no more.
TASK, GROUPS = 1 << 25, 128
_NONE = -np.inf
_NO_CUTOFF = np.iinfo(np.int64).min


def quantized(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) per component, in doubles; vectors that take part only."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"), F.coalesce(whole, F.lit(False)).alias("whole"))
        .where("whole AND vec_id IS NOT NULL")
        # floor() of a double is a long in SQL; rint of x - 0.5 isn't floor, so large ones stay exact as doubles
        .select("vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("double")).alias("v"))
    )


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of unequal length as one matrix, padded with zeros."""
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), int(lengths.max(initial=1)) or 1))
    out[np.arange(out.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _stacked(parts: list[np.ndarray]) -> np.ndarray:
    dim = max(p.shape[1] for p in parts)
    return np.concatenate([np.pad(p, ((0, 0), (0, dim - p.shape[1]))) for p in parts])


_PACKED = "dim int, kind string, data binary"


def _packed(m: np.ndarray) -> list[pa.Array]:
    """The columns of ``_PACKED``: a matrix in the smallest numbers that hold it."""
    top = np.abs(m).max(initial=0)
    kind = next((k for k in ("i1", "i2", "i4") if top < 2 ** (8 * np.dtype(k).itemsize - 1)), "f8")
    return [pa.array([m.shape[1]], pa.int32()), pa.array([kind]), pa.array([m.astype(kind).tobytes()], pa.binary())]


def _unpacked(row: dict) -> np.ndarray:
    return np.frombuffer(row["data"], row["kind"]).reshape(-1, row["dim"])


def _row_blocks(rows: DataFrame) -> DataFrame:
    """(block, ids, dim, kind, data): rows packed as they lie in their partition, by vec_id in a block."""

    def pack(batches: Iterator[pa.RecordBatch]):
        first, n, held = TaskContext.get().partitionId() << 32, 0, []

        def block():
            ids, m = np.concatenate([x for x, _ in held]), _stacked([x for _, x in held])
            order = np.argsort(ids, kind="stable")
            return pa.RecordBatch.from_arrays(
                [pa.array([first + n]), pa.array([ids[order].tobytes()], pa.binary()), *_packed(m[order])], names=["block", "ids", "dim", "kind", "data"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, STEP)
                m = _matrix(part.column("v"))
                size, dim = sum(len(x) for x, _ in held), max(m.shape[1], *(x.shape[1] for _, x in held), 1)
                room = max(1, min(ROWS, VALUES // dim)) - size
                if room <= 0:
                    yield block()
                    n, held = n + 1, []
                    continue
                held.append((part.column("vec_id").to_numpy()[:room], m[:room]))
                at += min(room, len(m))
        if held:
            yield block()

    return rows.mapInArrow(pack, f"block long, ids binary, {_PACKED}")


def _question_blocks(questions: DataFrame) -> DataFrame:
    """(q_ids, cutoffs, dim, kind, data): queries packed with their cutoffs."""

    def pack(batch: pa.RecordBatch):
        for at in range(0, batch.num_rows, STEP):
            part = batch.slice(at, STEP)
            cutoffs = pc.fill_null(part.column("cutoff"), pa.scalar(_NO_CUTOFF, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.to_numpy().tobytes()], pa.binary()) for x in (part.column("vec_id"), cutoffs)]
                + _packed(_matrix(part.column("v"))), names=["q_ids", "cutoffs", "dim", "kind", "data"])

    return map_arrow(questions, pack, f"q_ids binary, cutoffs binary, {_PACKED}")


def _asked(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, cutoffs and vectors of some queries at a time."""
    held, n = [], 0
    for i in range(table.num_rows):
        row = {name: table[name][i].as_py() for name in ("q_ids", "cutoffs", "dim", "kind", "data")}
        held.append((np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["cutoffs"], np.int64), _unpacked(row)))
        n += len(held[-1][0])
        if n >= ASKED or i == table.num_rows - 1:
            ids, cutoffs, m = zip(*held)
            yield np.concatenate(ids), np.concatenate(cutoffs), _stacked(m).astype(float)
            held, n = [], 0


def _norms(m: np.ndarray, cuts: np.ndarray | None = None) -> np.ndarray:
    """Per row the norm, or one per list."""
    if cuts is None:
        return np.sqrt(np.einsum("ij,ij->i", m, m))
    return np.stack([_norms(m[:, a:b]) for a, b in zip(cuts, cuts[1:])], axis=1)


class _Block:
    """A block's rows, ordered by vec_id, in numbers that hold every product with given queries."""

    def __init__(self, row: dict, lists: int) -> None:
        self.ids, self.packed = np.frombuffer(row["ids"], np.int64), _unpacked(row)
        self.cuts = np.linspace(0, self.packed.shape[1], lists + 1).astype(int)
        self.rows = self.packed.astype(float)
        self.norms, self.list_norms = _norms(self.rows), _norms(self.rows, self.cuts)
        self.widest = np.abs(self.rows).max(initial=0)
        self._places: dict = {}

    def meet(self, q: np.ndarray) -> np.ndarray:
        """Queries in the width and kind of ``rows``."""
        dim = self.packed.shape[1]
        q = np.pad(q[:, :dim], ((0, 0), (0, max(0, dim - q.shape[1]))))
        most = _norms(q).max(initial=0) * self.norms.max(initial=0) * (1 + 1e-6)
        narrow = max(most, self.widest, np.abs(q).max(initial=0)) < 2 ** 24
        kind = np.dtype(np.float32 if narrow else np.float64 if most < 2 ** 53 else object)
        if self.rows.dtype != kind:
            self.rows, self._places = _of_kind(self.packed, kind), {}
        return _of_kind(q, kind)

    def places(self, a: int, b: int) -> np.ndarray:
        """(place, member, value): a list's vectors as rows share places, ended with zeros."""
        if (a, b) not in self._places:
            wide = min(WIDE, len(self.rows))
            padded = np.zeros((-(-len(self.rows) // wide) * wide, b - a), self.rows.dtype)
            padded[:len(self.rows)] = self.rows[:, a:b]
            self._places[a, b] = np.ascontiguousarray(padded.reshape(-1, wide, b - a).transpose(1, 0, 2))
        return self._places[a, b]


def _of_kind(m: np.ndarray, kind: np.dtype) -> np.ndarray:
    return np.array([[int(c) for c in row] for row in m], object).reshape(m.shape) if kind == object else m.astype(kind)


def _products(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, r: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Tiles of the products with all queries, and their first row; a query's own rows count as least."""
    low, high = np.searchsorted(ids, q_ids, "left"), np.searchsorted(ids, q_ids, "right")
    held = np.empty(len(q) * min(WIDE, len(r)), q.dtype)
    for at in range(0, len(r), WIDE):
        tile = r[at:at + WIDE]
        p = np.matmul(q, tile.T, out=held[:len(q) * len(tile)].reshape(len(q), len(tile)))
        for i in np.flatnonzero((low < at + len(tile)) & (high > at) & (low < high)):
            p[i, max(low[i] - at, 0):high[i] - at] = _NONE
        yield at, p


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k greatest per row, in any order."""
    if scores.shape[1] <= k:
        return np.tile(np.arange(scores.shape[1]), (len(scores), 1))
    if scores.dtype == object:
        return np.array([sorted(range(scores.shape[1]), key=lambda j: -row[j])[:k] for row in scores]).reshape(len(scores), -1)
    return np.argpartition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k:]


def _scores(q: np.ndarray, groups: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The products of each query with groups of vectors of its own."""
    members, dim = groups.shape[1:]
    out = np.empty((len(q), chosen.shape[1] * members), q.dtype)
    step = max(1, VALUES // max(1, out.shape[1] * dim))
    for at in range(0, len(q), step):
        some = groups.take(chosen[at:at + step], axis=0).reshape(-1, out.shape[1], dim)
        out[at:at + step] = np.matmul(some, q[at:at + step, :, None])[:, :, 0]
    return out


def _list_best(block: _Block, q_ids: np.ndarray, q: np.ndarray, a: int, b: int, k: int) -> np.ndarray:
    """Per query the columns of the k greatest partial scores of the list of dimensions a to b, in any order."""
    ids, q, places = block.ids, np.ascontiguousarray(q[:, a:b]), block.places(a, b)
    most = np.full((len(q), len(places)), _NONE, q.dtype)
    for _, p in _products(q_ids, q, ids, block.rows[:, a:b]):
        np.maximum(most[:, :p.shape[1]], p, out=most[:, :p.shape[1]])
    chosen = _best(most, k)
    partial = _scores(q, places, chosen)
    columns = (chosen[:, :, None] + len(places) * np.arange(places.shape[1])).reshape(partial.shape)
    past = columns >= len(ids)
    columns[past] = 0
    partial[past | (ids[columns] == q_ids[:, None])] = _NONE
    return np.take_along_axis(columns, _best(partial, k), axis=1)


def _completed(block: _Block, q_ids: np.ndarray, q: np.ndarray, k: int):
    """The k best completed scores of the lists' best entries: places of the queries, and scores."""
    columns = np.sort(np.concatenate([
        _list_best(block, q_ids, q, a, b, k) for a, b in zip(block.cuts, block.cuts[1:]) if b > a], axis=1), axis=1)
    scores = _scores(q, block.rows[:, None], columns)
    again = np.zeros(columns.shape, bool)
    again[:, 1:] = columns[:, 1:] == columns[:, :-1]
    scores[again | (block.ids[columns] == q_ids[:, None])] = _NONE
    scores = np.take_along_axis(scores, _best(scores, k), axis=1)
    at, place = np.nonzero(scores != _NONE)
    return at, scores[at, place]


def _may_reach(block: _Block, q: np.ndarray, cutoffs: np.ndarray, lists: int) -> np.ndarray:
    """Whether a row can reach the cutoff of a query: one of its lists is not under cutoff / lists."""
    if not len(cutoffs) or cutoffs.min() <= 0:
        return np.ones(len(block.ids), bool)
    cutoffs = cutoffs.astype(float) * (1 - 1e-9)
    with np.errstate(divide="ignore"):
        least = (cutoffs / _norms(q)).min()
        threshold = (cutoffs[:, None] / lists / _norms(q, block.cuts)).min(axis=0)
    return (block.norms >= least) & (block.list_norms >= threshold).any(axis=1)


def _reached(q_ids: np.ndarray, q: np.ndarray, cutoffs: np.ndarray, ids: np.ndarray, r: np.ndarray, k: int):
    """The k best entries per query that reach the cutoff: places of the queries, columns, scores."""
    floors = cutoffs.astype(q.dtype)
    found, n = [], 0

    def cut():
        at, column, score = (np.concatenate([x[i] for x in found]) for i in range(3))
        order = np.lexsort((column, -score.astype(float) if score.dtype != object else _places(score), at))
        at, column, score = at[order], column[order], score[order]
        nth = np.arange(len(at)) - np.searchsorted(at, at)
        full = nth == k - 1
        # columns go by vec_id, and ties go to the smaller one: what comes later must be greater
        floors[at[full]] = score[full] + 1
        kept = nth < k
        return at[kept], column[kept], score[kept]

    for start, p in _products(q_ids, q, ids, r):
        some = np.flatnonzero(p.max(axis=1) >= floors)
        if len(some):
            at, column = np.nonzero((p[some] >= floors[some, None]) & (p[some] != _NONE))
            found.append((some[at], start + column, p[some[at], column]))
            n += len(at)
            if n > HELD:
                found, n = [cut()], 0
    return cut() if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def _places(score: np.ndarray) -> np.ndarray:
    """Numbers that sort as the scores do, the greatest first."""
    known = {s: -i for i, s in enumerate(sorted(set(score)))}
    return np.array([known[s] for s in score], int)


def _tiles(left: pa.Table, right: pa.Table, lists: int):
    """Each block of a task with some queries at a time, those of alike reach together."""
    for row in left.to_pylist():
        block = _Block(row, lists)
        for q_ids, cutoffs, vectors in _asked(right):
            q = block.meet(vectors)
            order = np.argsort(cutoffs / np.maximum(_norms(vectors), 1), kind="stable")
            for at in range(0, len(q), QUERIES):
                some = order[at:at + QUERIES]
                yield block, q_ids[some], cutoffs[some], q[some], vectors[some]


def _table(columns: list[list[np.ndarray]], names: list[str]) -> pa.Table:
    return pa.table([pa.array([int(x) for x in c] if c.dtype == object else c.astype(np.int64), pa.int64())
                     for c in (np.concatenate([np.zeros(0, np.int64), *x]) for x in columns)], names=names)


def _local_lists(met, k: int, lists: int) -> DataFrame:
    """Phase 1: per block and query, the k best completed scores of the lists' best entries."""

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list = [[], []]
        for block, q_ids, _, q, _ in _tiles(left, right, lists):
            at, scores = _completed(block, q_ids, q, k)
            out[0].append(q_ids[at])
            out[1].append(scores)
        return _table(out, ["query_id", "score"])

    return met.applyInArrow(look, "query_id long, score long")


def _reaching(met, k: int, lists: int) -> DataFrame:
    """Phases 2 and 3: per block and query, the k best entries that reach the cutoff, and its ties."""

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list = [[], [], []]
        for block, q_ids, cutoffs, q, vectors in _tiles(left, right, lists):
            may = _may_reach(block, vectors, cutoffs, lists)
            ids, r = (block.ids, block.rows) if may.all() else (block.ids[may], block.rows[may])
            at, column, scores = _reached(q_ids, q, cutoffs, ids, r, k)
            out[0].append(q_ids[at])
            out[1].append(ids[column])
            out[2].append(scores)
        return _table(out, ["query_id", "vec_id", "score"])

    return met.applyInArrow(look, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, lists: int = 4,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for every row of ``queries``,
    not counting the query's own row; ties go to the smaller vec_id."""
    rows = staged(_row_blocks(quantized(vectors, id_col, vector_col, scale)), "blocks")
    asked = staged(quantized(queries, id_col, vector_col, scale).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    blocks = rows.select("block", (F.octet_length("ids") / 8 * F.col("dim")).cast("long").alias("n")).collect()
    groups = max(1, min(len(blocks), max(GROUPS, -(-sum(b["n"] for b in blocks) // TASK))))
    parts = max(1, -(-(asked.agg(F.sum(F.size("v"))).first()[0] or 0) // TASK))
    group = local_table(vectors.sparkSession, [(b["block"], i % groups) for i, b in enumerate(blocks)], "block long, group int")
    dealt = rows.join(group, "block").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    # hashing deals few groups unevenly; empty tasks cost little
    tasks = 3 * groups * parts

    def meet(questions: DataFrame):
        copies = _question_blocks(questions).withColumn("part", F.pmod(F.xxhash64("q_ids"), F.lit(parts)).cast("int")).withColumn(
            "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        left, right = (x.repartition(tasks, "group", "part").groupBy("group", "part") for x in (dealt, copies))
        return left.cogroup(right)

    first = _local_lists(meet(asked.withColumn("cutoff", F.lit(None).cast("long"))), k, lists)
    cutoffs = (
        first.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"))))
        .where(F.col("rank") <= k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("cutoff"))
    )
    found = _reaching(meet(asked.join(cutoffs, "vec_id", "left").select("vec_id", "v", "cutoff")), k, lists)
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
