"""Substring dedup by super-k-mer partitioning.

A window is ``width`` consecutive words of a document; its minimiser is the word ``seed``-gram in
it with the least hash (the leftmost, where equal). Consecutive windows that share one minimiser
form a super-k-mer and travel as one packed string of words to the bucket of the minimiser's hash.
Equal windows have equal minimisers, so a bucket sees every copy of its windows; there they are
sorted and the runs of equal ones give each window's first place. Words in windows that start
earlier somewhere else are removed.

A task packs the super-k-mers of a bucket into compressed parcels. Before that it sets aside
repeats of the same packed string: every window of the later one is a later copy, whatever the
rest of the corpus holds, so only the earliest travels. A passage that a third of the documents
share therefore reaches its bucket about once per task, not once per document. In the bucket,
minimisers with one super-k-mer are skipped (a window cannot equal another one of its own
super-k-mer: both would have the minimiser at the same distance).

Order of occurrences: doc_id (null first), then position. Defined results: null or empty text has
no words; rows that repeat doc_id and text are one document and get the same result; rows of one
doc_id with other texts are compared by position alone; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .shared import map_arrow, partitions, utf8

#: Buckets per shuffle partition: they are read one at a time, so memory is a bucket's.
BUCKETS_PER_PART = 4
#: Bytes of packed strings a task holds before it sends its parcels.
HELD_BYTES = 48 << 20
_NULL_ID = -(1 << 63)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _copy(text_col: str) -> Column:
    return F.shiftright(F.xxhash64(text_col), 32).cast("int")


def _seed_hashes(words: list[bytes], seed: int) -> np.ndarray:
    """A 64-bit hash of every ``seed`` consecutive words."""
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - seed + 1
    out = np.zeros(n, np.uint64)
    for k in range(seed):
        out = (out ^ h[k:k + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def super_kmers(words: list[bytes], width: int, seed: int) -> Iterator[tuple[int, int, int]]:
    """(minimiser's hash, first window, number of windows) of a document, in order."""
    n_windows = len(words) - width + 1
    if n_windows < 1:
        return
    hashes = _seed_hashes(words, seed)
    per_window = np.lib.stride_tricks.sliding_window_view(hashes, width - seed + 1)
    place = np.arange(n_windows) + per_window.argmin(axis=1)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    counts = np.diff(np.append(first, n_windows))
    yield from zip(hashes[place[first]].tolist(), first.tolist(), counts.tolist())


# --- parcels -----------------------------------------------------------------------------------------

# The minimiser's upper half is enough to sort by: windows are told apart by their words. Of the text's
# hash, which only tells rows of one doc_id apart, 32 bits travel.
_COLUMNS = (("minimiser", "<u4"), ("doc", "<i8"), ("copy", "<i4"), ("start", "<i4"), ("windows", "<i4"))


def _parcel(items: list[tuple]) -> bytes:
    head = b"".join(np.array([x[i] >> 32 if i == 0 else x[i] for x in items], t).tobytes() for i, (_, t) in enumerate(_COLUMNS))
    body = b"\n".join(x[5] for x in items)
    return len(items).to_bytes(4, "little") + zstandard.ZstdCompressor(3).compress(head + body)


def _unpack(parcel: bytes) -> tuple[list[np.ndarray], list[bytes]]:
    n = int.from_bytes(parcel[:4], "little")
    data = zstandard.ZstdDecompressor().decompress(parcel[4:])
    columns, at = [], 0
    for _, t in _COLUMNS:
        size = n * np.dtype(t).itemsize
        columns.append(np.frombuffer(data[at:at + size], t))
        at += size
    return columns, data[at:].split(b"\n")


class _Held:
    """The super-k-mers a task holds back: by packed string, the earliest so far."""

    def __init__(self, buckets: int):
        self.buckets, self.bytes = buckets, 0
        self.earliest: dict[bytes, tuple] = {}
        self.equal: list[tuple] = []  # places equal to the earliest: the same document, given twice
        self.later: list[tuple] = []

    def add(self, minimiser: int, doc: int, copy: int, start: int, windows: int, packed: bytes) -> None:
        item = (minimiser, doc, copy, start, windows, packed)
        old = self.earliest.setdefault(packed, item)
        if old is item:
            self.bytes += len(packed) + 150
        elif (doc, start) == (old[1], old[3]):
            self.equal.append(item)
        elif (doc, start) < (old[1], old[3]):
            self.later.append(old)
            self.earliest[packed] = item
        else:
            self.later.append(item)

    def parcels(self) -> Iterator[tuple[int, bytes]]:
        by_bucket: dict[int, list] = {}
        for item in (*self.earliest.values(), *self.equal):
            by_bucket.setdefault(item[0] % self.buckets, []).append(item)
        for bucket, items in by_bucket.items():
            yield bucket, _parcel(items)


def _rows(bucket, parcels, runs) -> pa.RecordBatch:
    """Parcels and runs of removed windows in one table: (bucket, parcel) or (doc, copy, start, n)."""
    n, m = len(parcels), len(runs)
    doc, copy, start, count = zip(*runs) if runs else ((), (), (), ())
    return pa.RecordBatch.from_arrays([
        pa.array(list(bucket) + [(d ^ s) % (1 << 20) for d, s in zip(doc, start)], pa.int64()),
        pa.array(list(parcels) + [None] * m, pa.binary()),
        pa.array([None] * n + list(doc), pa.int64()), pa.array([None] * n + list(copy), pa.int32()),
        pa.array([None] * n + list(start), pa.int32()), pa.array([None] * n + list(count), pa.int32()),
    ], names=["bucket", "parcel", "doc", "copy", "start", "n"])


_SENT = "bucket long, parcel binary, doc long, copy int, start int, n int"
_RUN = "doc long, copy int, start int, n int"


def _send(keyed: DataFrame, width: int, seed: int, buckets: int) -> DataFrame:
    def pack(batches):
        held = _Held(buckets)

        def flush():
            sent = list(held.parcels())
            runs = _merged((x[1], x[2], x[3], x[4]) for x in held.later)
            held.__init__(buckets)
            for at in range(0, len(sent), 2000):
                part = sent[at:at + 2000]
                yield _rows([b for b, _ in part], [p for _, p in part], [])
            if runs:
                yield _rows([], [], runs)

        for batch in batches:
            docs = batch.column(0).to_pylist()
            for doc, copy, text in zip(docs, batch.column(1).to_pylist(), utf8(batch.column(2))):
                words = text.split()
                if len(words) < width:
                    continue
                doc = _NULL_ID if doc is None else doc
                joined = b" ".join(words)
                ends = list(accumulate(map(len, words), lambda a, x: a + x + 1))
                ends[0] = len(words[0])
                begins = [0] + [e + 1 for e in ends[:-1]]
                for minimiser, first, n in super_kmers(words, width, seed):
                    held.add(minimiser, doc, copy, first, n, joined[begins[first]:ends[first + n + width - 2]])
                if held.bytes > HELD_BYTES:
                    yield from flush()
        yield from flush()

    return keyed.mapInArrow(pack, _SENT)


def _later_windows(items: list[tuple], width: int) -> Iterator[tuple[int, int, int]]:
    """(doc, copy, start) of every window of one minimiser that starts earlier elsewhere."""
    windows = []
    for doc, copy, start, count, packed in items:
        words = packed.split(b" ")
        ends = list(accumulate(map(len, words), lambda a, x: a + x + 1))
        at = 0
        for i in range(count):
            windows.append((packed[at:ends[i + width - 1]], doc, start + i, copy))
            at = ends[i] + 1
    windows.sort()
    text, first = None, None
    for window, doc, start, copy in windows:
        if window != text:
            text, first = window, (doc, start)
        elif (doc, start) != first:
            yield doc, copy, start


def _merged(runs) -> list[tuple[int, int, int, int]]:
    """Runs (doc, copy, start, n) of window starts, joined where one begins before the last one ends."""
    out: list[list[int]] = []
    for doc, copy, start, n in sorted(runs):
        last = out[-1] if out else None
        if last and last[0] == doc and last[1] == copy and start <= last[2] + last[3]:
            last[3] = max(last[3], start + n - last[2])
        else:
            out.append([doc, copy, start, n])
    return [tuple(x) for x in out]


def _bucket_runs(parcels: list[bytes], width: int) -> list[tuple[int, int, int, int]]:
    columns, packed = [[] for _ in _COLUMNS], []
    for parcel in parcels:
        own, strings = _unpack(parcel)
        for c, x in zip(columns, own):
            c.append(x)
        packed.extend(strings)
    minimiser, doc, copy, start, count = (np.concatenate(c) for c in columns)
    order = np.argsort(minimiser, kind="stable")
    ordered = minimiser[order]
    cuts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    sizes = np.diff(np.append(cuts, len(ordered)))
    places: list[tuple[int, int, int]] = []
    for at, size in zip(cuts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
        items = [(int(doc[i]), int(copy[i]), int(start[i]), int(count[i]), packed[i]) for i in order[at:at + size]]
        places.extend(_later_windows(items, width))
    return _merged((doc, copy, start, 1) for doc, copy, start in places)


def _receive(sent: DataFrame, width: int) -> DataFrame:
    """Runs of removed windows. The rows of a bucket follow one another."""

    def count(batches):
        bucket, parcels = None, []

        def runs_of():
            runs = _bucket_runs(parcels, width) if parcels else []
            parcels.clear()
            if runs:
                columns = list(zip(*runs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.int32()))],
                    names=["doc", "copy", "start", "n"])

        for batch in batches:
            ready = batch.filter(pa.compute.is_null(batch.column("parcel"))).select(["doc", "copy", "start", "n"])
            if ready.num_rows:
                yield ready
            for b, p in zip(batch.column("bucket").to_pylist(), batch.column("parcel").to_pylist()):
                if p is None:
                    continue
                if b != bucket:
                    yield from runs_of()
                    bucket = b
                parcels.append(p)
        yield from runs_of()

    return sent.mapInArrow(count, _RUN)


def repeated_windows(docs: DataFrame, width: int = 20, seed: int = 3, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc, copy, start, n): runs of windows that also start earlier, at most one run per
    super-k-mer and bucket; ``copy`` is the text's hash, and null ids are the least long."""
    parts = partitions(docs.sparkSession)
    keyed = docs.select(F.col(id_col).cast("long"), _copy(text_col).alias("copy"), F.col(text_col).cast("string"))
    sent = _send(keyed, width, seed, parts * BUCKETS_PER_PART)
    dealt = sent.repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int"))
    return _receive(dealt.sortWithinPartitions("bucket"), width)


def remove_repeats(docs: DataFrame, width: int = 20, seed: int = 3, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each row's words less those of repeated windows."""
    runs = (
        repeated_windows(docs, width, seed, id_col, text_col)
        .groupBy("doc", "copy").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
        .withColumnsRenamed({"doc": "_doc", "copy": "_copy"})
        .hint("merge")  # they grow with the corpus: the same plan at every size
    )
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        F.coalesce(F.col(id_col).cast("long"), F.lit(_NULL_ID)).alias("_d"), _copy(text_col).alias("_c"))
    both = keyed.join(runs, (F.col("_d") == F.col("_doc")) & (F.col("_c") == F.col("_copy")), "left").select(
        "doc_id", "text", F.col("runs.start").alias("starts"), F.col("runs.n").alias("counts"))

    def cut(batch: pa.RecordBatch):
        n_words, n_removed, kept = [], [], []
        for text, starts, counts in zip(utf8(batch.column("text")), batch.column("starts").to_pylist(),
                                        batch.column("counts").to_pylist()):
            words = text.split()
            n_words.append(len(words))
            if starts:
                # a run of n windows covers n + width - 1 words
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, starts, 1)
                np.add.at(edge, np.asarray(starts) + np.asarray(counts) + (width - 1), -1)
                gone = np.cumsum(edge[:-1]) > 0
                n_removed.append(int(gone.sum()))
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            else:
                n_removed.append(0)
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return map_arrow(both, cut, "doc_id long, n_words long, n_removed long, kept string")
