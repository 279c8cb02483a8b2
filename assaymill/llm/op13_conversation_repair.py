"""Conversation structure repair at least cost, by dynamic programming over a grammar.

A conversation's rows in order are a string of symbols, one per row: the class of its role (system,
user, assistant, other) and what its fault demands (must go, costs extra, nothing). The edits keep,
rerole, delete and insert turn it into roles of the form ``(s?(ua)+)?``, which an automaton of four
states reads: nothing yet, after s, after u, after a.

1. *Segments.* Rows are range-partitioned by conversation and order and cut into segments of bounded
   rows and bytes. Nearly all conversations lie in one segment; those that a task's edge or the bound
   divides are *open*. Rows whose role and text were seen before are told inside a segment; between
   the segments of an open conversation by the least segment of each digest, after one row per
   segment and digest.
2. *Grammar.* Re-Pair over the distinct strings of all segments: each round counts the adjacent pairs
   in the strings as compressed so far, and the most frequent ones that don't overlap each other
   become rules. Their number is bounded; what isn't compressed any more is read symbol by symbol, so
   the bound changes no result.
3. *Transfer matrices.* Each symbol, and each rule bottom-up, has one min-plus matrix over the states:
   the least cost from state to state, the state in the middle, which is the rope of the edits' audit,
   and the rank of that audit among those that leave the same state. Inserts belong to the row after
   them. Then no audit of a string is a prefix of another, and from one state an audit leads to one
   state, so ties are settled by ranks alone: the ASCII-least audit of a rule needs no expansion.
4. *Evaluation.* Rules are broadcast (bounded) and shared by all conversations; each segment is
   compressed and evaluated where it lies. Open segments give matrices of 16 numbers, which are joined
   per conversation from its end; then each segment expands its own audit and its repaired rows. The
   digest of an open conversation is taken by a task that streams its segments in order: SHA-256 is
   sequential, and the audit is one value. That task holds no more than a batch and the audit.

Defined results: null role or text is one space, a null conversation is one of its own, null turns come
first; rows of one turn stand by role, then by their text's hash; equal rows are duplicates of the
first; a role other than those three, or whose initial is not s, u or a, can be reroled or deleted; an
empty table gives an empty table. Rows marked as lost count for nothing, but their conversation gets a
result. Very long texts are segments of their own. Columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow, staged

#: Rows and characters after which a segment ends.
ROWS, CHARS = 4096, 1 << 22
#: Bounds on the grammar: rules in all, and rounds of counting.
RULES, ROUNDS = 1024, 10
_BLANK = " \t\n\x0b\x0c\r"
_CLASSES = "sua"
_LEGAL = {"su", "ua", "au"}
_STATES = 4  # nothing yet, after s, after u, after a
_NOTHING, _S, _U, _A = range(_STATES)
_FAR = 1 << 60
_FIRST_SYMBOL, _FIRST_RULE = 33, 256
_ROLES = {_NOTHING: "user", _S: "user", _U: "assistant", _A: "user"}
_AFTER = {_NOTHING: _U, _S: _U, _U: _A, _A: _U}


@dataclass(frozen=True)
class Costs:
    """Of edits: keeping is free; ``truncated`` is added to what isn't deleted of truncated rows."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def __post_init__(self):
        if min(self.rerole, self.delete, self.insert) < 1 or self.truncated < 0:
            raise ValueError("edits cost at least 1, and truncated rows nothing or more")


# --- matrices -----------------------------------------------------------------------------------------

@dataclass
class Matrix:
    """By start state: cost, rank of the audit among those from the same start, and how it is made
    (the edits of one row, or the state in the middle of a rule) for each end state."""

    cost: list[list[int]] = field(default_factory=lambda: [[_FAR] * _STATES for _ in range(_STATES)])
    rank: list[list[int]] = field(default_factory=lambda: [[0] * _STATES for _ in range(_STATES)])
    how: list[list] = field(default_factory=lambda: [[None] * _STATES for _ in range(_STATES)])


def _kept(state: int, role: int) -> int | None:
    """The state after a row of that class is kept, if it may be."""
    if role == 0:
        return _S if state == _NOTHING else None
    if role == 1:
        return _U if state != _U else None
    return _A if role == 2 and state == _U else None


def symbol_matrix(role: int, fault: int, costs: Costs) -> Matrix:
    """One row: up to two inserts, then one edit. ``fault``: 0 must go, 1 truncated, 2 none."""
    out = Matrix()
    for start in range(_STATES):
        state = start
        for inserts in range(3):
            paid = inserts * costs.insert
            extra = paid + (costs.truncated if fault == 1 else 0)
            moves = [("D", state, paid + costs.delete)]
            if fault:
                moves.append(("R", _AFTER[state], extra + costs.rerole))
                if _kept(state, role) is not None:
                    moves.append(("K", _kept(state, role), extra))
            for edit, end, cost in moves:
                audit = "I" * inserts + edit
                if (cost, audit) < (out.cost[start][end], out.how[start][end] or ""):
                    out.cost[start][end], out.how[start][end] = cost, audit
            state = _AFTER[state]
        order = sorted(x for x in out.how[start] if x)
        out.rank[start] = [order.index(x) if x else _STATES for x in out.how[start]]
    return out


def joined(left: Matrix, right: Matrix) -> Matrix:
    """A rule's matrix from those of its two sides."""
    out = Matrix()
    for start in range(_STATES):
        keys = [None] * _STATES
        for end in range(_STATES):
            best = min((left.cost[start][m] + right.cost[m][end], left.rank[start][m], m) for m in range(_STATES))
            if best[0] < _FAR:
                out.cost[start][end], out.how[start][end] = best[0], best[2]
                keys[end] = (best[1], right.rank[best[2]][end])
        order = sorted(k for k in keys if k)
        out.rank[start] = [order.index(k) if k else _STATES for k in keys]
    return out


class Grammar:
    """Rules in the order in which they apply, and the matrices of all symbols."""

    def __init__(self, rules: Sequence[str], costs: Costs):
        self.rules = [(pair, chr(_FIRST_RULE + k)) for k, pair in enumerate(rules)]
        self.pair_of = {name: pair for pair, name in self.rules}
        self.costs = costs
        self.matrix = {chr(_FIRST_SYMBOL + 3 * role + fault): symbol_matrix(role, fault, costs)
                       for role in range(4) for fault in range(3)}
        self.length = dict.fromkeys(self.matrix, 1)
        for pair, name in self.rules:
            self.matrix[name] = joined(self.matrix[pair[0]], self.matrix[pair[1]])
            self.length[name] = self.length[pair[0]] + self.length[pair[1]]
        self.expanded: dict[tuple[str, int, int], str] = {}
        self.results: dict[str, tuple[int, str]] = {}

    def compressed(self, text: str) -> str:
        """Each rule's pair replaced from left to right, rule after rule."""
        for pair, name in self.rules:
            text = text.replace(pair, name)
        return text

    def audit(self, symbol: str, start: int, end: int) -> str:
        """The rope from state to state, expanded; short ones are remembered."""
        key = (symbol, start, end)
        text = self.expanded.get(key)
        if text is None:
            out, todo = [], [key]
            while todo:
                s, i, j = todo.pop()
                if s in self.pair_of:
                    m = self.matrix[s].how[i][j]
                    left, right = self.pair_of[s]
                    todo += [(right, m, j), (left, i, m)]
                else:
                    out.append(self.matrix[s].how[i][j])
            text = "".join(out)
            if self.length[symbol] <= 64:
                self.expanded[key] = text
        return text

    def paths(self, symbols: str, start: int) -> tuple[list[int], list[int], list[list[int]]]:
        """Costs and ranks by end state, and for each symbol the state before it by the state after."""
        cost, rank, back = [_FAR] * _STATES, [_STATES] * _STATES, []
        cost[start], rank[start] = 0, 0
        for s in symbols:
            m = self.matrix[s]
            best = [min((cost[k] + m.cost[k][j], rank[k], k) for k in range(_STATES)) for j in range(_STATES)]
            keys = [(b[1], m.rank[b[2]][j]) for j, b in enumerate(best)]
            order = sorted(k for k, b in zip(keys, best) if b[0] < _FAR)
            cost = [min(b[0], _FAR) for b in best]
            rank = [order.index(k) if b[0] < _FAR else _STATES for k, b in zip(keys, best)]
            back.append([b[2] for b in best])
        return cost, rank, back

    def along(self, symbols: str, back: list[list[int]], end: int) -> str:
        out = []
        for s, before in zip(reversed(symbols), reversed(back)):
            out.append(self.audit(s, before[end], end))
            end = before[end]
        return "".join(reversed(out))

    def inserts_at_end(self, state: int) -> int:
        return {_NOTHING: 0, _S: 2, _U: 1, _A: 0}[state]

    def repaired(self, text: str) -> tuple[int, str]:
        """Least cost and ASCII-least audit of a whole conversation."""
        known = self.results.get(text)
        if known is None:
            symbols = self.compressed(text)
            cost, rank, back = self.paths(symbols, _NOTHING)
            total, _, end = min(
                (c + self.inserts_at_end(j) * self.costs.insert, rank[j], j) for j, c in enumerate(cost) if c < _FAR)
            known = total, self.along(symbols, back, end) + "I" * self.inserts_at_end(end)
            if len(text) <= 64 and len(self.results) < 100_000:
                self.results[text] = known
        return known


def symbols(classes: str, marks: str) -> str:
    """One character per row from its role's class and its fault."""
    return "".join(chr(_FIRST_SYMBOL + 3 * (_CLASSES.find(c) % 4) + (0 if m in "bd" else 1 if m == "t" else 2))
                   for c, m in zip(classes, marks))


def illegal_pairs(classes: str) -> int:
    return sum(a + b not in _LEGAL for a, b in zip(classes, classes[1:]))


def edited(audit: str, state: int, roles: Sequence[str], texts: Sequence[str]) -> str:
    """The rows that the edits leave, as ``role:text``, newline-joined."""
    out, at = [], 0
    for edit in audit:
        if edit == "I":
            out.append(f"{_ROLES[state]}:")
            state = _AFTER[state]
            continue
        if edit == "K":
            out.append(f"{roles[at]}:{texts[at]}")
            state = _kept(state, _CLASSES.find(roles[at][:1]))
        elif edit == "R":
            out.append(f"{_ROLES[state]}:{texts[at]}")
            state = _AFTER[state]
        at += 1
    return "\n".join(out)


# --- segments -----------------------------------------------------------------------------------------

_SEGMENT = ("conv_id {id}, seg long, open boolean, roles array<string>, texts array<string>, classes string, "
            "marks string, digests array<binary>, first_turn long, last_turn long, min_turn long, max_turn long, "
            "n_turns long")
_KINDS = [pa.int64(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string(), pa.string(),
          pa.list_(pa.binary()), *[pa.int64()] * 5]


class _Segment:
    def __init__(self, conv, seg: int, open_: bool):
        self.conv, self.seg, self.open = conv, seg, open_
        self.roles, self.texts, self.turns, self.chars = [], [], [], 0

    def full(self, rows: int) -> bool:
        return len(self.roles) >= rows or self.chars >= CHARS

    def row(self) -> list:
        classes = "".join(c if (c := r[:1]) in _CLASSES and c else "?" for r in self.roles)
        marks, digests, seen = [], [], set()
        for role, text in zip(self.roles, self.texts):
            body = text.strip(_BLANK)
            if not body:
                marks.append("b")
                digests.append(None)
                continue
            digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
            marks.append("d" if digest in seen else "k" if body[-1] in ".!?" else "t")
            seen.add(digest)
            digests.append(digest)
        turns = [t for t in self.turns if t is not None]
        ends = [self.turns[0], self.turns[-1]] if self.turns else [None, None]
        return [self.conv, self.seg, self.open, self.roles, self.texts, classes, "".join(marks),
                digests if self.open else [], *ends, min(turns, default=None), max(turns, default=None), len(set(turns))]


def segments(rows: DataFrame, segment_rows: int = ROWS) -> DataFrame:
    """Segments of (conv_id, turn, role, text, lost), see above."""
    kind = rows.schema["conv_id"].dataType
    keyed = rows.withColumns({"h": F.xxhash64("text"), "u": F.monotonically_increasing_id()})  # u parts equal rows
    order = ["conv_id", "turn", "role", "h", "u"]
    dealt = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("h", "u")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, now, ready, held = TaskContext.get().partitionId() << 33, 0, None, [], 0
        id_type = None

        def batch():
            columns = list(zip(*ready))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type), *(pa.array(c, k) for c, k in zip(columns[1:], _KINDS))],
                names=_SEGMENT.replace(",", "").split()[::2])

        for given in batches:
            id_type = given.column("conv_id").type
            for k in range(given.num_rows):
                conv, turn, role, text, lost = (c[k].as_py() for c in given.columns)
                other = now is None or conv != now.conv
                if other or now.full(segment_rows):
                    if now is not None:
                        now.open |= not other
                        ready.append(now.row())
                        held += now.chars + 100 * len(now.roles)
                        if held >= CHARS or len(ready) >= 10_000:
                            yield batch()
                            ready, held = [], 0
                    now = _Segment(conv, base + made, now is None or not other)
                    made += 1
                if not lost:
                    now.roles.append(role)
                    now.texts.append(text)
                    now.turns.append(turn)
                    now.chars += len(text)
        if now is not None:
            now.open = True  # the next task may go on with it
            ready.append(now.row())
            yield batch()

    return dealt.mapInArrow(cut, _SEGMENT.format(id=kind.simpleString()))


def with_repeats(parts: DataFrame) -> DataFrame:
    """Open segments, with rows marked whose role and text an earlier segment of theirs has."""
    met = parts.select("conv_id", "seg", F.explode(F.array_distinct(F.filter("digests", lambda d: d.isNotNull()))).alias("digest"))
    first = met.groupBy("conv_id", "digest").agg(F.min("seg").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = (
        met.alias("m").join(first.alias("f"), F.col("m.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("m.digest") == F.col("f.digest")))
        .where("seg > first").groupBy("seg").agg(F.collect_list("m.digest").alias("again"))  # at most ROWS of a segment
    )
    narrow = parts.select("seg", "marks", "digests").join(again, "seg", "left")

    def mark(batch: pa.RecordBatch):
        out = []
        for marks, digests, met_before in zip(*(batch.column(c).to_pylist() for c in ("marks", "digests", "again"))):
            known = set(met_before or ())
            out.append("".join("d" if d in known else m for m, d in zip(marks, digests)))
        yield pa.RecordBatch.from_arrays([batch.column("seg"), pa.array(out, pa.string())], names=["seg", "marks"])

    return map_arrow(narrow, mark, "seg long, marks string")


# --- grammar ------------------------------------------------------------------------------------------

def _counted_pairs(text: str) -> Counter:
    """Adjacent pairs of compressed strings, which newlines part."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    pairs = (code[:-1] << 21 | code[1:])[(code[:-1] != 10) & (code[1:] != 10)]
    values, counts = np.unique(pairs, return_counts=True)
    return Counter(dict(zip(values.tolist(), counts.tolist())))


def re_pair(strings: DataFrame, rules: int = RULES, rounds: int = ROUNDS) -> list[str]:
    """Rules (pairs of symbols) from the one column of ``strings``, most frequent pairs first. Pairs of
    one round don't overlap, so that one's replacement takes no occurrence of another."""
    found: list[str] = []
    for _ in range(rounds):
        applied = [(pair, chr(_FIRST_RULE + k)) for k, pair in enumerate(found)]

        def count(batches: Iterator[pa.RecordBatch], applied=applied) -> Iterator[pa.RecordBatch]:
            total: Counter = Counter()
            for batch in batches:
                for at in range(0, batch.num_rows, 1000):
                    text = "\n".join(x for x in batch.column(0).slice(at, 1000).to_pylist() if x)
                    for pair, name in applied:
                        text = text.replace(pair, name)
                    if len(text) > 1:
                        total.update(_counted_pairs(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["pair", "n"])

        best = (strings.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
                .where("n >= 2").orderBy(F.desc("n"), "pair").limit(rules - len(found)).collect())
        starts, ends, new = set(), set(), []
        for row in best:
            a, b = row["pair"] >> 21, row["pair"] & ((1 << 21) - 1)
            if a not in ends and b not in starts:
                starts.add(a)
                ends.add(b)
                new.append(chr(a) + chr(b))
        found += new
        if not new or len(found) >= rules:
            break
    return found


# --- results ------------------------------------------------------------------------------------------

_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
_COUNTS = ("blank", "duplicate", "truncated")


def _marked(marks: str) -> list[int]:
    return [marks.count(m) for m in "bdt"]


def _gaps(least, greatest, turns: int) -> int:
    return greatest - least + 1 - turns if least is not None else 0


def _whole(parts: DataFrame, grammar, id_type: str) -> DataFrame:
    """Results of conversations that lie in one segment."""

    def repair(batch: pa.RecordBatch):
        out = []
        for r in (batch.slice(k, 1).to_pylist()[0] for k in range(batch.num_rows)):
            cost, audit = grammar.value.repaired(symbols(r["classes"], r["marks"]))
            out.append([_gaps(r["min_turn"], r["max_turn"], r["n_turns"]), *_marked(r["marks"]), illegal_pairs(r["classes"]),
                        cost, audit, hashlib.sha256(edited(audit, _NOTHING, r["roles"], r["texts"]).encode()).hexdigest()])
        columns = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), *(pa.array(c, pa.int64()) for c in columns[:6]), *(pa.array(c, pa.string()) for c in columns[6:])],
            names=["conv_id", "gaps", *_COUNTS, "illegal", "cost", "audit", "repaired_sha256"])

    columns = ["conv_id", "roles", "texts", "classes", "marks", "min_turn", "max_turn", "n_turns"]
    return map_arrow(parts.select(*columns), repair, f"conv_id {id_type}, {_RESULT}repaired_sha256 string")


def _open(parts: DataFrame, grammar, costs: Costs, id_type: str) -> DataFrame:
    """Results of conversations in several segments, or whose neighbours only another task knows."""

    def summary(batch: pa.RecordBatch):
        out = []
        for r in batch.to_pylist():
            text = grammar.value.compressed(symbols(r["classes"], r["marks"]))
            ways = [grammar.value.paths(text, i) for i in range(_STATES)]
            out.append([*_marked(r["marks"]), illegal_pairs(r["classes"]), r["classes"][:1], r["classes"][-1:],
                        [c for w in ways for c in w[0]], [c for w in ways for c in w[1]]])
        kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = [*_COUNTS, "illegal", "first_class", "last_class", "costs", "ranks"]
        kept = ["conv_id", "seg", "first_turn", "last_turn", "min_turn", "max_turn", "n_turns"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], names=[*kept, *names])

    narrow = parts.select("conv_id", "seg", "first_turn", "last_turn", "min_turn", "max_turn", "n_turns", "classes", "marks")
    summaries = map_arrow(narrow, summary, (
        f"conv_id {id_type}, seg long, first_turn long, last_turn long, min_turn long, max_turn long, n_turns long, "
        "blank long, duplicate long, truncated long, illegal long, first_class string, last_class string, "
        "costs array<long>, ranks array<long>"))
    insert = costs.insert

    def chain(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["seg"])
        rest = [0, 2 * insert, insert, 0]  # what the end costs by state: nothing, after s, u, a
        ways = []
        for r in reversed(rows):
            best = [min((r["costs"][_STATES * i + j] + rest[j], r["ranks"][_STATES * i + j], j) for j in range(_STATES))
                    for i in range(_STATES)]
            ways.append([b[2] for b in best])
            rest = [b[0] for b in best]
        states = [_NOTHING]
        for way in reversed(ways):
            states.append(way[states[-1]])
        present = [r for r in rows if r["last_class"]]
        illegal = sum(r["illegal"] for r in rows) + sum(
            a["last_class"] + b["first_class"] not in _LEGAL for a, b in zip(present, present[1:]))
        turns = sum(r["n_turns"] for r in rows) - sum(
            a["last_turn"] is not None and a["last_turn"] == b["first_turn"] for a, b in zip(present, present[1:]))
        gaps = _gaps(min((r["min_turn"] for r in rows if r["min_turn"] is not None), default=None),
                     max((r["max_turn"] for r in rows if r["max_turn"] is not None), default=None), turns)
        totals = [gaps, *(sum(r[c] for r in rows) for c in _COUNTS), illegal, rest[_NOTHING]]
        n = len(rows)
        return pa.table([pa.array([r["seg"] for r in rows], pa.int64()), pa.array(states[:-1], pa.int32()), pa.array(states[1:], pa.int32()),
                         pa.array([k == n - 1 for k in range(n)]), *(pa.array([t] * n, pa.int64()) for t in totals)],
                        names=["seg", "enter", "leave", "last", "gaps", *_COUNTS, "illegal", "cost"])

    ways = summaries.groupBy("conv_id").applyInArrow(chain, (
        "seg long, enter int, leave int, last boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"))
    dealt = parts.select("conv_id", "seg", "roles", "texts", "classes", "marks").join(ways, "seg") \
        .repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    numbers = ["gaps", *_COUNTS, "illegal", "cost"]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audits, digest, any_ = [], hashlib.sha256(), False
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                text = grammar.value.compressed(symbols(r["classes"], r["marks"]))
                audit = grammar.value.along(text, grammar.value.paths(text, r["enter"])[2], r["leave"])
                audit += "I" * grammar.value.inserts_at_end(r["leave"]) if r["last"] else ""
                body = edited(audit, r["enter"], r["roles"], r["texts"])
                if body:
                    digest.update(("\n" if any_ else "").encode() + body.encode())
                    any_ = True
                audits.append(audit)
                if r["last"]:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("conv_id").slice(k, 1), *(pa.array([r[c]], pa.int64()) for c in numbers),
                         pa.array(["".join(audits)], pa.string()), pa.array([digest.hexdigest()], pa.string())],
                        names=["conv_id", *numbers, "audit", "repaired_sha256"])
                    audits, digest, any_ = [], hashlib.sha256(), False

    return dealt.mapInArrow(stream, f"conv_id {id_type}, {_RESULT}repaired_sha256 string")


def repair(rows: DataFrame, costs: Costs = Costs(), lost_col: str | None = None, rules: int = RULES,
           rounds: int = ROUNDS, segment_rows: int = ROWS) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256."""
    space = F.lit(" ")
    read = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        F.coalesce(F.col(lost_col), F.lit(False)).alias("lost") if lost_col else F.lit(False).alias("lost"))
    id_type = read.schema["conv_id"].dataType.simpleString()
    parts = staged(segments(read, segment_rows), "segments")
    whole = parts.where("NOT open")
    marks = staged(with_repeats(parts.where("open")), "marks")
    open_ = parts.where("open").drop("marks").join(marks, "seg")

    def spelled(batch: pa.RecordBatch):
        yield pa.RecordBatch.from_arrays(
            [pa.array([symbols(c, m) for c, m in zip(*(x.to_pylist() for x in batch.columns))], pa.string())], names=["s"])

    spell = whole.select("classes", "marks").unionByName(open_.select("classes", "marks"))
    strings = staged(map_arrow(spell, spelled, "s string").groupBy("s").agg(F.count(F.lit(1)).alias("n")), "strings")
    grammar = rows.sparkSession.sparkContext.broadcast(Grammar(re_pair(strings.select("s"), rules, rounds), costs))
    return _whole(whole, grammar, id_type).unionByName(_open(open_, grammar, costs, id_type))


def damage(conversations: DataFrame) -> DataFrame:
    """The contracted damage by crc32(conv_id:turn) modulo 20; nulls are one space. Lost rows are marked."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    text, role = (F.coalesce(F.col(c).cast("string"), space) for c in ("text", "role"))
    c = F.col("c")
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(F.encode(key, "utf-8")) % 20).alias("c")).select(
        "conv_id", "turn", F.when(c == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(c == 1, "").when(c == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (c == 0).alias("lost"), F.explode(F.when(c == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")
