"""Best-fit packing by a configuration linear program over the length histogram.

Documents are tokenized and cut into pieces of at most ``capacity`` tokens; only the histogram of
piece lengths (at most ``capacity`` numbers, whatever the corpus) reaches the driver. There the
lengths above a sixteenth of the capacity are rounded to 256 classes, and the covering program
"as few bins as possible, each filled by a configuration of classes" is solved by multiplicative
weights: every round prices the classes, a knapsack dynamic program finds the dearest
configuration, and the covered classes lose weight. The rounded-down configurations are filled
with real lengths; what is left, and the short pieces, go by best fit, longest first, into the
remaining room.

The plan is a list of (length, first rank, sequence, offset) whose size depends on the histogram
alone. Pieces take their rank among those of their length from counts per (length, bucket), so a
length that a third of the pieces share is numbered by many tasks.

Defined results: null or empty text is one piece with the end token alone; rows that repeat are
packed each; null doc_id is kept; an empty table gives an empty table.
"""

from __future__ import annotations

import bisect
import functools
import os
import re
import sys
import zlib
from array import array
from collections import defaultdict
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import map_arrow, partitions, staged, utf8

#: Distinct blank-separated chunks, and as many pieces of such chunks, in each of the two generations of ids
#: that a worker keeps at hand.
CACHED = 300_000
#: Parts of the capacity that classes of lengths are multiples of.
UNITS = 256


# --- tokens ------------------------------------------------------------------------------------------

# The tokenizer's own splitting rule, for chunks of ASCII and Latin-1 letters in lower case.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
_SIMPLE = re.compile(r"[!-~À-ÿ]+")


def _byte_letters() -> str:
    """Byte-level vocabularies write a byte as the character it prints, the others as 256, 257, ..."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = (b for b in range(256) if b not in shown)
    letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return "".join(letters[b] for b in range(256))


class ChunkTokenizer:
    """Ids of blank-separated chunks. No token reaches over white space, so each chunk has its own.

    A chunk not seen lately is cut into the pieces that the vocabulary's rule makes of it; what isn't
    plain ASCII or Latin-1, or might hold a special token, goes through the whole tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.chunks: dict[bytes, bytes] = {}
        self.old_chunks: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        # the short way is taken only where it is known to give what the whole tokenizer gives
        probe = "It's a Café, they're 12 (ÀÉ) naïve--no! schß"
        self.short = False
        self.short = sys.byteorder == "little" and self.text(probe.encode()) == self.text_as(probe, True)

    def text_as(self, text: str, short: bool) -> bytes:
        return b"".join(self._short(c) if short else self._whole(c) for c in text.split(" "))

    def _whole(self, chunk: str) -> bytes:
        return np.array(self.whole.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def _short(self, chunk: str) -> bytes:
        out = []
        for piece in _PIECES.findall(chunk.lower()):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = self.old_pieces.get(piece)
                if ids is None:
                    shown = piece.encode().decode("latin-1").translate(self.letters)
                    ids = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
                if len(self.pieces) >= CACHED:
                    self.old_pieces, self.pieces = self.pieces, {}
                if len(piece) <= 40:
                    self.pieces[piece] = ids
            out.append(ids)
        return b"".join(out)

    def chunk(self, chunk: bytes) -> bytes:
        ids = self.old_chunks.get(chunk)
        if ids is None:
            text = chunk.decode()
            ids = self._short(text) if self.short and _SIMPLE.fullmatch(text) and "<|" not in text else self._whole(text)
        if len(self.chunks) >= CACHED:
            self.old_chunks, self.chunks = self.chunks, {}
        if len(chunk) <= 40:
            self.chunks[chunk] = ids
        return ids

    def text(self, text: bytes) -> bytes:
        """The ids of a text as little-endian 32-bit numbers."""
        chunks = text.split()
        parts = list(map(self.chunks.get, chunks))
        if None in parts:
            known = self.chunks
            parts = [p if p is not None else known.get(c) or self.chunk(c) for c, p in zip(chunks, parts)]
        return b"".join(parts)


@functools.lru_cache(1)
def _tokenizer(path: str) -> ChunkTokenizer:
    return ChunkTokenizer(path)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1,
                 with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): every document's tokens in pieces."""
    end = np.array([end_id], "<u4").tobytes()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def cut(batch: pa.RecordBatch):
        out = [[] for _ in range(6)]
        for doc, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
            ids = _tokenizer(tokenizer).text(text) + end
            for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at:at + 4 * capacity]
                row = (doc, k, at // 4, len(part) // 4, zlib.crc32(part), part)
                for column, value in zip(out, row):
                    column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        n = 6 if with_ids else 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(out[:n], kinds)],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:n])

    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(read, cut, schema)


# --- the plan ----------------------------------------------------------------------------------------

def _dearest(sizes: np.ndarray, prices: np.ndarray, room: int) -> np.ndarray:
    """Knapsack with repetition: how often each class stands in the configuration of highest price."""
    best = np.zeros(room + 1)
    choice = np.full(room + 1, -1)
    for w in range(1, room + 1):
        best[w], choice[w] = best[w - 1], -1
        fit = np.searchsorted(sizes, w, side="right")
        if fit:
            value = best[w - sizes[:fit]] + prices[:fit]
            j = int(value.argmax())
            if value[j] > best[w]:
                best[w], choice[w] = value[j], j
    counts = np.zeros(len(sizes), int)
    w = room
    while w > 0:
        if choice[w] < 0:
            w -= 1
        else:
            counts[choice[w]] += 1
            w -= int(sizes[choice[w]])
    return counts


def configurations(sizes: Sequence[int], demand: Sequence[int], room: int, step: float = 0.1,
                   rounds: int = 1500) -> list[tuple[float, np.ndarray]]:
    """A fractional solution of: fewest bins whose configurations cover ``demand``.

    Multiplicative weights over the covering constraints. Each round adds the dearest
    configuration as often as it takes to fill its scarcest class by a fraction ``step``, and
    cools the weights by what was covered. Ends when the least covered class is covered often
    enough for the weights' guarantee, or after ``rounds``; the sum is scaled to cover everything.
    """
    sizes, need = np.asarray(sizes), np.asarray(demand, float)
    if not len(sizes):
        return []
    log_weight, covered = np.zeros(len(sizes)), np.zeros(len(sizes))
    enough = np.log(len(sizes) + 1) / step
    total: dict[bytes, float] = defaultdict(float)
    for _ in range(rounds):
        if covered.min() >= enough:
            break
        prices = np.exp(log_weight - log_weight.max()) / need
        c = _dearest(sizes, prices, room)
        used = c > 0
        amount = float((need[used] / c[used]).min())
        total[c.tobytes()] += amount
        gain = amount * c / need
        covered += gain
        log_weight -= step * gain
    least = covered.min()
    if least <= 0:  # stopped before every class was met: cover the rest one class to a bin
        for j in np.flatnonzero(covered <= 0):
            c = np.zeros(len(sizes), int)
            c[j] = room // sizes[j]
            total[c.tobytes()] += need[j] / c[j] * max(1.0, covered.max())
            covered[j] = max(1.0, covered.max())
        least = covered[covered > 0].min()
    return [(x / least, np.frombuffer(c, dtype=int)) for c, x in total.items()]


class _Open:
    """Groups of equal bins by the room left in them: (bins, lengths inside)."""

    def __init__(self) -> None:
        self.by_room: dict[int, list] = defaultdict(list)
        self.rooms: list[int] = []

    def add(self, room: int, bins: int, inside: tuple) -> None:
        if not self.by_room[room]:
            bisect.insort(self.rooms, room)
        self.by_room[room].append((bins, inside))

    def best_fit(self, length: int):
        i = bisect.bisect_left(self.rooms, length)
        if i == len(self.rooms):
            return None
        room = self.rooms[i]
        bins, inside = self.by_room[room].pop()
        if not self.by_room[room]:
            self.rooms.pop(i)
        return room, bins, inside


def _filled_configurations(left: dict[int, int], capacity: int, open_bins: _Open) -> None:
    """Rounds the program's solution down and fills its bins with real lengths, taken out of ``left``.

    A class holds the lengths of one unit, rounded down, so real lengths may not all fit: the last
    place of a bin takes the longest length that does, if it is of its class or the next lower one.
    """
    unit = -(-capacity // UNITS)
    groups: dict[int, list[int]] = defaultdict(list)
    for length in sorted(left, reverse=True):
        if length * 16 > capacity:
            groups[length // unit].append(length)
    sizes = sorted(groups)
    demand = [sum(left[x] for x in groups[s]) for s in sizes]
    there = sorted(x for x in left if left[x])
    for amount, config in sorted(configurations(sizes, demand, capacity // unit), key=lambda x: -x[0]):
        items = [sizes[j] for j in np.flatnonzero(config)[::-1] for _ in range(config[j])]
        bins = int(amount)
        while bins > 0:
            taken: dict[int, int] = defaultdict(int)
            room = capacity
            for k, s in enumerate(items):
                if k < len(items) - 1:
                    length = next((x for x in groups[s] if x <= room and left[x] > taken.get(x, 0)), None)
                else:
                    i = bisect.bisect_right(there, min(room, (s + 1) * unit - 1)) - 1
                    while i >= 0 and left[there[i]] <= taken.get(there[i], 0):
                        i -= 1
                    length = there[i] if i >= 0 and there[i] // unit >= s - 1 else None
                if length is None:
                    break
                taken[length] += 1
                room -= length
            if sum(taken.values()) < len(items):
                break
            same = min(bins, *(left[x] // k for x, k in taken.items()))
            for x, k in taken.items():
                left[x] -= k * same
                if not left[x]:
                    there.remove(x)
            open_bins.add(room, same, tuple(x for x, k in taken.items() for _ in range(k)))
            bins -= same


def _best_fit(left: dict[int, int], capacity: int, open_bins: _Open) -> None:
    """Everything in ``left``, longest first, each into the fullest bins that hold it."""
    for length in sorted(left, reverse=True):
        n = left[length]
        while n > 0:
            found = open_bins.best_fit(length)
            room, bins, inside = found or (capacity, n, ())
            placed = min(n, bins)
            if placed < bins and found:
                open_bins.add(room, bins - placed, inside)
            # as many into each bin as fit, while there are enough for all of them
            each = max(1, min(room // length, n // placed))
            if not found:
                each = min(capacity // length, n)
                placed = n // each
            n -= each * placed
            open_bins.add(room - each * length, placed, inside + (length,) * each)


def packing_plan(histogram: dict[int, int], capacity: int) -> tuple[dict[str, np.ndarray], int]:
    """Slots for every piece of the histogram: arrays length, rank, sequence, offset, and how many
    sequences there are. Entry i serves the ranks from ``rank[i]`` to the length's next entry.

    The rounded program is completed by best fit. Where best fit alone needs fewer sequences, as on
    histograms with many short pieces, rounding down to no configuration at all is the better rounding.
    """
    tries = []
    for fill in (_filled_configurations, None):
        left, open_bins = dict(histogram), _Open()
        if fill:
            fill(left, capacity, open_bins)
        _best_fit(left, capacity, open_bins)
        tries.append([group for groups in open_bins.by_room.values() for group in groups])
    full = min(tries, key=lambda groups: sum(bins for bins, _ in groups))
    entries, ranks, sequence = [], defaultdict(int), 0
    for bins, inside in full:
        offset = 0
        for length in inside:
            entries.append((length, ranks[length], sequence, offset))
            ranks[length] += bins
            offset += length
        sequence += bins
    table = np.array(sorted(entries), np.int64).reshape(-1, 4)
    return dict(zip(("length", "rank", "sequence", "offset"), table.T)), sequence


# --- packing -----------------------------------------------------------------------------------------

def _numbered(pieces: DataFrame) -> DataFrame:
    """``rank``: 0, 1, ... among the pieces of a length, counted per bucket and shifted."""
    keyed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(partitions(pieces.sparkSession))))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = keyed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    return (
        keyed.withColumn("own", F.row_number().over(own)).join(shift, ["length", "bucket"])
        .withColumn("rank", F.col("shift") + F.col("own") - 1).drop("bucket", "own", "shift")
    )


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Every piece with its sequence_id and offset. ``pieces`` has doc_id, piece, length and
    ids_crc32, among others, and is read twice: stage it if it is dear to make."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan, _ = packing_plan(histogram, capacity)
    shared = pieces.sparkSession.sparkContext.broadcast(plan)  # bounded by the histogram
    columns = [c for c in pieces.columns]
    ranked = _numbered(pieces).select(*columns, "rank")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"

    def place(batch: pa.RecordBatch):
        p = shared.value
        length = batch.column("length").to_numpy(zero_copy_only=False)
        rank = batch.column("rank").to_numpy(zero_copy_only=False)
        begins = np.searchsorted(p["length"], length, side="left")
        ends = np.searchsorted(p["length"], length, side="right")
        at = np.empty(len(length), np.int64)
        for x in np.unique(length):
            mine = length == x
            b, e = begins[mine][0], ends[mine][0]
            at[mine] = b + np.searchsorted(p["rank"][b:e], rank[mine], side="right") - 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in columns]
            + [pa.array(p["sequence"][at] + rank - p["rank"][at]), pa.array(p["offset"][at])],
            names=[*columns, "sequence_id", "offset"])

    return map_arrow(ranked, place, schema)


def tokenize_and_pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1,
                      with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    pieces = staged(token_pieces(docs, tokenizer, capacity, end_id, with_ids, id_col, text_col), "pieces")
    return pack(pieces, capacity)
