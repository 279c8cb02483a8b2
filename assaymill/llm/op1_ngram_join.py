"""N-gram Jaccard join with signature trees.

Two documents link when 100 * intersection >= ``percent`` * union of their sets of word n-grams.
The result is each document's component. Sets are compared by 64-bit hashes of their n-grams.

1. *Sets.* Every text gives its set's size, hash (``sid``) and token bitmap. Equal sets are one
   class from here on, so exact copies cost one comparison in all. The same pass counts n-grams in
   a fixed number of counters; crowded counters mark the n-grams that very many documents share.
2. *Meeting places.* In one global order (common n-grams last, else by hash) two sets that link
   must share one of the first ``n - ceil(percent * n / 100) + 1`` n-grams of each. These are
   packed into parcels per bucket of n-grams, one shuffle in all. A bucket keeps the n-grams met
   by two sets of compatible size; unique ones, the bulk, end there.
3. *Leaders.* In each meeting place the sets are walked by size, and the smallest one that their
   size allows leads them. Each set is compared with the leader it meets most often: one pair per
   set, which already ties large groups of near copies together. Bitmaps are compared first: only
   pairs whose largest possible overlap is enough have their sets made and moved.
4. *Signature trees.* A meeting place whose sets still lie in different components is searched
   exhaustively; places with the same least and greatest set are searched as one, and a pair that meets
   in several of them is taken in one alone. Its sets are dealt to blocks of bounded size, each pair of blocks gets a tree per
   side, whose nodes hold the OR of their token bitmaps, their size range and their components.
   The dual traversal drops a pair of nodes whose sizes are incompatible, whose largest possible
   overlap by bitmaps is too small, or which lie in one component; every pair of sets that is left
   is compared exactly. Before that, ``FIRST_ROUNDS`` searches look at one of ``FIRST_PLACES`` places
   and compare each set with its likeliest partner of another component alone, which ties the parts
   of large groups together; then follow all places that are still open, and every pair. So nothing
   is capped, and a group whose members link is not compared pair by pair.

A set's bitmap has 4 to 8 bits per n-gram, a power of two, so it tells sets of any size apart; where
two widths meet, the wider one is folded by OR.

Defined results: null or empty text has an empty set, which links with nothing and is its own
component; rows with equal sets are one class, repeated rows included; a null doc_id takes part,
and is nobody's least id unless all ids of the component are null; an empty table gives an empty
table; only the named columns are read by the query form, others pass through ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .components import components
from .shared import map_arrow, partitions, staged, utf8

#: Counters of n-grams: a fixed size, whatever the corpus.
COUNTERS = 1 << 18
SLICES = 64
#: An n-gram is common if its counter holds this many times the mean.
CROWDED = 4
#: Bits of a set's token bitmap per n-gram, at least, and of the smallest one.
BITS_PER_NGRAM, LEAST_BITS = 4, 64
#: The trees see bitmaps folded this many times over, which still rule out what is unrelated; the pairs
#: they leave are checked by whole bitmaps.
COARSER = 2
#: Texts that a worker turns into sets at a time.
TEXTS = 256
#: Bits of the filter that tells which documents' sets are compared; it only saves work.
FILTER_WORDS = 1 << 20
#: Sets and bytes of bitmaps per block, and sets per leaf of a signature tree.
BLOCK, BLOCK_BYTES, LEAF = 1024, 1 << 24, 8
BUCKETS_PER_PART = 4
#: How many searches of the trees come first, and the places of which each looks at one.
FIRST_ROUNDS, FIRST_PLACES = 1, 8
_MIX = np.uint64(0x9E3779B97F4A7C15)


# --- sets --------------------------------------------------------------------------------------------

def ngram_set(text: bytes, n: int) -> np.ndarray:
    """The sorted hashes of the text's distinct word n-grams, in lower case (A-Z only); with fewer
    than n words, of the whole sequence."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(n, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        out = (out ^ h[k:k + len(out)]) * _MIX
        out ^= out >> np.uint64(31)
    return np.unique(out)


def set_id(hashes: np.ndarray) -> int:
    return xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def bitmap(hashes: np.ndarray) -> bytes:
    width = max(LEAST_BITS, 1 << (BITS_PER_NGRAM * len(hashes) - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(hashes >> np.uint64(20)) % np.uint64(width)] = True
    return np.packbits(bits).tobytes()


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Rows of bytes of a bitmap, ORed down to ``width`` bytes."""
    while bits.shape[1] > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def most_common(bits_a: bytes, size_a: int, bits_b: bytes, size_b: int) -> int:
    """The largest overlap that two sets can have by their bitmaps: of the n-grams behind a common bit
    at least one is shared, and what collisions hide are at most the n-grams beyond the bits."""
    width = min(len(bits_a), len(bits_b))
    a, b = (folded(np.frombuffer(x, np.uint8)[None, :], width)[0] for x in (bits_a, bits_b))
    surplus = min(size_a - int(np.bitwise_count(a).sum()), size_b - int(np.bitwise_count(b).sum()))
    return int(np.bitwise_count(a & b).sum()) + surplus


def needed(size: int, percent: int) -> int:
    """The least overlap a set of this size must have with one it links with."""
    return -(-percent * size // 100)


def _sets(keyed: DataFrame, n: int) -> DataFrame:
    """A row per document (doc_id, key, sid, size, bits), and per task its counters in slices."""

    def look(batches):
        counters = np.zeros(COUNTERS, np.uint32)
        for batch in (b.slice(at, TEXTS) for b in batches for at in range(0, b.num_rows, TEXTS)):
            sets = [ngram_set(text, n) for text in utf8(batch.column("text"))]
            every = np.concatenate(sets) % np.uint64(COUNTERS) if sets else np.zeros(0, np.uint64)
            counters += np.bincount(every.astype(np.int64), minlength=COUNTERS).astype(np.uint32)
            nothing = [None] * len(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), pa.array([set_id(s) for s in sets], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array([bitmap(s) for s in sets], pa.binary()),
                 pa.array(nothing, pa.int32()), pa.array(nothing, pa.binary())], names=names)
        nothing = [None] * SLICES
        yield pa.RecordBatch.from_arrays(
            [pa.array(nothing, pa.int64())] * 4 + [pa.array(nothing, pa.binary()), *sliced(counters)], names=names)

    names = ["doc_id", "key", "sid", "size", "bits", "slice", "counts"]
    return keyed.mapInArrow(
        look, "doc_id long, key long, sid long, size long, bits binary, slice int, counts binary")


def sliced(counters: np.ndarray) -> list[pa.Array]:
    """The columns (slice, counts) of a task's counters, byte by byte of all of them, which compresses the upper ones."""
    squeeze = zstandard.ZstdCompressor(1)
    planes = (np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T) for x in counters.reshape(SLICES, -1))
    return [pa.array(range(SLICES), pa.int32()), pa.array([squeeze.compress(x.tobytes()) for x in planes], pa.binary())]


def total_counts(counts: DataFrame, counters: int = COUNTERS) -> np.ndarray:
    """The tasks' counters, added up. Slices are added up where they meet; their number is fixed."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
                planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(part), np.uint8).reshape(4, -1)
                part = np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)
                sums[k] = sums[k] + part if k in sums else part
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
                names=["slice", "counts"])

    summed = counts.repartitionById(SLICES, F.col("slice")).mapInArrow(add, "slice int, counts binary")
    total = np.zeros((SLICES, counters // SLICES), np.int64)
    for row in summed.collect():
        total[row["slice"]] += np.frombuffer(row["counts"], np.int64)
    return total.ravel()


def _common(counts: DataFrame) -> np.ndarray:
    """Which counters are crowded."""
    total = total_counts(counts)
    return total > CROWDED * max(total.mean(), 1.0)


# --- meeting places ----------------------------------------------------------------------------------

def _meeting_places(keyed: DataFrame, n: int, percent: int, common, parts: int) -> DataFrame:
    """(token, sid, size, leader) of the n-grams where sets of compatible size meet."""
    buckets = parts * BUCKETS_PER_PART

    def send(batches):
        seen: set[int] = set()
        held: list[tuple[np.ndarray, int, int]] = []
        count = 0

        def flush():
            tokens = np.concatenate([t for t, _, _ in held]) if held else np.zeros(0, np.uint64)
            repeat = [len(t) for t, _, _ in held]
            sids = np.repeat(np.array([s for _, s, _ in held], np.int64), repeat)
            sizes = np.repeat(np.array([z for _, _, z in held], np.int32), repeat)
            held.clear()
            where = tokens % np.uint64(buckets)
            order = np.lexsort((tokens, where))
            where, tokens, sids, sizes = where[order], tokens[order], sids[order], sizes[order]
            cuts = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1]))) if len(where) else []
            ends = np.append(cuts[1:], len(where)) if len(where) else []
            squeeze = zstandard.ZstdCompressor(1)
            out = [(int(where[a]), squeeze.compress(
                np.uint32(b - a).tobytes() + tokens[a:b].tobytes() + sids[a:b].tobytes() + sizes[a:b].tobytes()))
                for a, b in zip(cuts, ends)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in out], pa.int64()), pa.array([p for _, p in out], pa.binary())],
                    names=["bucket", "parcel"])

        for batch in (b.slice(at, TEXTS) for b in batches for at in range(0, b.num_rows, TEXTS)):
            for text in utf8(batch.column("text")):
                s = ngram_set(text, n)
                sid = set_id(s)
                if not len(s) or sid in seen:
                    continue
                seen.add(sid)
                p = len(s) - needed(len(s), percent) + 1
                late = common.value[(s % np.uint64(COUNTERS)).astype(np.int64)]
                held.append((np.concatenate((s[~late], s[late]))[:p], sid, len(s)))
                count += p
                if count > 1_000_000:
                    yield from flush()
                    seen.clear()
                    count = 0
        yield from flush()

    def meet(batches):
        bucket, parcels = None, []

        def places():
            if not parcels:
                return
            data = [zstandard.ZstdDecompressor().decompress(p) for p in parcels]
            parcels.clear()
            ns = [int(np.frombuffer(d, np.uint32, 1)[0]) for d in data]
            token = np.concatenate([np.frombuffer(d, np.uint64, k, 4) for d, k in zip(data, ns)])
            sid = np.concatenate([np.frombuffer(d, np.int64, k, 4 + 8 * k) for d, k in zip(data, ns)])
            size = np.concatenate([np.frombuffer(d, np.int32, k, 4 + 16 * k) for d, k in zip(data, ns)])
            order = np.lexsort((sid, size, token))
            token, sid, size = token[order], sid[order], size[order].astype(np.int64)
            fresh = np.concatenate(([True], (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])))
            token, sid, size = token[fresh], sid[fresh], size[fresh]
            same = token[1:] == token[:-1]
            near = same & (100 * size[:-1] >= percent * size[1:])
            met = np.concatenate((near, [False])) | np.concatenate(([False], near))
            token, sid, size = token[met], sid[met], size[met]
            leader = np.empty(len(sid), np.int64)
            last = lead = low = None
            for i, (t, s, z) in enumerate(zip(token.tolist(), sid.tolist(), size.tolist())):
                if t != last or 100 * low < percent * z:
                    last, lead, low = t, s, z
                leader[i] = lead
            if len(sid):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token.astype(np.int64)), pa.array(sid), pa.array(size), pa.array(leader)],
                    names=["token", "sid", "size", "leader"])

        for batch in batches:
            for b, p in zip(batch.column("bucket").to_pylist(), batch.column("parcel").to_pylist()):
                if b != bucket:
                    yield from places()
                    bucket = b
                parcels.append(p)
        yield from places()

    sent = keyed.mapInArrow(send, "bucket long, parcel binary")
    dealt = sent.repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int")).sortWithinPartitions("bucket")
    return dealt.mapInArrow(meet, "token long, sid long, size long, leader long")


# --- comparing ---------------------------------------------------------------------------------------

def _packed(hashes: np.ndarray) -> bytes:
    """The upper 48 bits of sorted hashes, byte by byte of all of them, which compresses the leading ones."""
    columns = (hashes >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].T
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(columns).tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    columns = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(6, -1).T
    return np.ascontiguousarray(np.pad(columns, ((0, 0), (0, 2)))).view(np.uint64).ravel()


def _wanted(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(key): one document of every set that a pair asks for."""
    sids = pairs.select(F.col("u").alias("sid")).unionByName(pairs.select(F.col("v").alias("sid"))).distinct()
    return classes.select("sid", "key").join(sids, "sid", "left_semi").select("key")


_SLOT = f"pmod(key, {FILTER_WORDS * 64})"


def _key_filter(wanted: DataFrame):
    """A fixed-size bit filter over keys, broadcast. It keeps rows that nobody asks for from being read
    and moved; a false hit is only such a row, so no result depends on it."""
    slot = F.expr(_SLOT)
    rows = (
        wanted.select(F.shiftright(slot, 6).alias("word"), F.expr(
            f"shiftleft(1L, cast(pmod(key, {FILTER_WORDS * 64}) % 64 AS int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    )
    words = np.zeros(FILTER_WORDS, np.int64)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return wanted.sparkSession.sparkContext.broadcast(words)


def _hits(batch: pa.RecordBatch, words: np.ndarray) -> pa.RecordBatch:
    slots = batch.column("slot").to_numpy(zero_copy_only=False)
    return batch.filter(pa.array((words[slots >> 6] >> (slots & 63)) & 1 == 1))


def _compared_sets(keyed: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(sid, hashes) of the documents in ``wanted`` (key), and of a few others."""
    shared = _key_filter(wanted)

    def take(batch: pa.RecordBatch):
        found = _hits(batch, shared.value)
        for at in range(0, found.num_rows, TEXTS):
            # equal sets of one slice are sent once; of others, twice does no harm
            sets = {set_id(s): s for s in (ngram_set(t, n) for t in utf8(found.column("text").slice(at, TEXTS)))}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sets), pa.int64()), pa.array(map(_packed, sets.values()), pa.binary())],
                names=["sid", "hashes"])

    made = map_arrow(keyed.select("text", F.expr(_SLOT).alias("slot")), take, "sid long, hashes binary")
    return staged(made.groupBy("sid").agg(F.first("hashes").alias("hashes")), "compared")


def coarse(bits: bytes) -> bytes:
    return folded(np.frombuffer(bits, np.uint8)[None, :], max(len(bits) // COARSER, LEAST_BITS // 8))[0].tobytes()


def _signatures(rows: DataFrame, wanted: DataFrame, trees: bool = True) -> DataFrame:
    """(sid, size, bits, coarse) of the documents in ``wanted`` (key), and of a few others; ``coarse``, made
    where a set's row has arrived, only for the trees."""
    shared = _key_filter(wanted)

    def take(batch: pa.RecordBatch):
        yield _hits(batch, shared.value).select(["sid", "size", "bits"])

    def fold(batch: pa.RecordBatch):
        yield batch.append_column("coarse", pa.array(map(coarse, batch.column("bits").to_pylist()), pa.binary()))

    found = map_arrow(rows.select("sid", "size", "bits", F.expr(_SLOT).alias("slot")), take,
                      "sid long, size long, bits binary")
    own = found.groupBy("sid").agg(*[F.first(c).alias(c) for c in ("size", "bits")])
    return staged(map_arrow(own, fold, "sid long, size long, bits binary, coarse binary") if trees else own, "signatures")


def _possible(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that neither sizes nor bitmaps rule out."""

    def look(batch: pa.RecordBatch):
        columns = [batch.column(c).to_pylist() for c in ("a", "size_a", "b", "size_b")]
        yield batch.select(["u", "v"]).filter(pa.array([
            linked(x, y, min(most_common(a, x, b, y), x, y), percent) for a, x, b, y in zip(*columns)]))

    for side, as_ in (("v", "b"), ("u", "a")):
        own = signatures.select(F.col("sid").alias(side), F.col("size").alias(f"size_{as_}"), F.col("bits").alias(as_))
        pairs = pairs.join(own, side)
    fits = (100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))
    return map_arrow(pairs.where(fits).select("u", "v", "a", "size_a", "b", "size_b"), look, "u long, v long")


def linked(size_a: int, size_b: int, overlap: int, percent: int) -> bool:
    return 100 * overlap >= percent * (size_a + size_b - overlap)


def _links(pairs: DataFrame, keyed: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets link, by exact overlap. Only sets that a pair asks for are made,
    from the texts, once for both sides."""

    def compare(batch: pa.RecordBatch):
        keep = []
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = _unpacked(a), _unpacked(b)
            if len(a) > len(b):
                a, b = b, a
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            keep.append(linked(len(a), len(b), int((b[at] == a).sum()), percent))
        yield batch.select(["u", "v"]).filter(pa.array(keep))

    sets = _compared_sets(keyed, _wanted(pairs, classes), n)
    both = pairs.join(sets.select(F.col("sid").alias("v"), F.col("hashes").alias("b")), "v").join(
        sets.select(F.col("sid").alias("u"), F.col("hashes").alias("a")), "u")
    return map_arrow(both.select("u", "v", "a", "b"), compare, "u long, v long")


class Tree:
    """A signature tree: ``levels[0]`` are single sets, a node of a level above joins ``LEAF``
    neighbours below it. Per level: OR of the bitmaps, least and greatest size, least and greatest
    component, and the greatest surplus (a set's size less its bits, so what collisions can hide).

    Sets of one larger component stand together, the others are ordered by size."""

    def __init__(self, sids: np.ndarray, sizes: np.ndarray, bits: np.ndarray, comps: np.ndarray):
        _, group, count = np.unique(comps, return_inverse=True, return_counts=True)
        order = np.lexsort((sizes, np.where(count[group] >= LEAF, group, len(count))))
        self.sids, bits, sizes, comps = sids[order], bits[order], sizes[order], comps[order]
        surplus = sizes - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        self.levels = [(bits, sizes, sizes, comps, comps, surplus)]
        while len(self.levels[-1][1]) > 1:
            b, lo, hi, c0, c1, s = self.levels[-1]
            at = np.arange(0, len(lo), LEAF)
            self.levels.append((
                np.bitwise_or.reduceat(b, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at),
                np.minimum.reduceat(c0, at), np.maximum.reduceat(c1, at), np.maximum.reduceat(s, at)))

    def level(self, k: int):
        return self.levels[min(k, len(self.levels) - 1)]


def open_pairs(left: Tree, right: Tree, percent: int) -> Iterator[tuple[int, int]]:
    """The pairs of sets of different components that neither sizes nor bitmaps rule out."""
    i, j, _ = _open_leaves(left, right, percent)
    yield from zip(left.sids[i].tolist(), right.sids[j].tolist())


def likeliest_pairs(left: Tree, right: Tree, percent: int) -> Iterator[tuple[int, int]]:
    """Of these, for each set the one with the largest possible likeness: as many as there are sets."""
    i, j, likeness = _open_leaves(left, right, percent)
    for side, other in ((i, j), (j, i)):
        order = np.lexsort((other, -likeness, side))
        ranked = side[order]
        best = order[np.concatenate(([True], ranked[1:] != ranked[:-1]))[:len(order)]]
        yield from zip(left.sids[i[best]].tolist(), right.sids[j[best]].tolist())


def _open_leaves(left: Tree, right: Tree, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dual traversal, level by level, down to pairs of sets, with the greatest likeness each can have."""
    level = max(len(left.levels), len(right.levels)) - 1
    i = j = np.zeros(1, np.int64)
    while len(i):
        (bits_a, lo_a, hi_a, from_a, to_a, surplus_a), (bits_b, lo_b, hi_b, from_b, to_b, surplus_b) = (
            left.level(level), right.level(level))
        one = (from_a[i] == to_a[i]) & (from_b[j] == to_b[j]) & (from_a[i] == from_b[j])
        keep = ~one & (100 * hi_a[i] >= percent * lo_b[j]) & (100 * hi_b[j] >= percent * lo_a[i])
        i, j = i[keep], j[keep]
        # of a set's bits at most the common ones can be shared n-grams, and its surplus besides
        common = np.bitwise_count(bits_a[i] & bits_b[j]).sum(axis=1).astype(np.int64)
        most = common + np.minimum(surplus_a[i], surplus_b[j])
        keep = 100 * most >= percent * (lo_a[i] + lo_b[j] - most)
        i, j = i[keep], j[keep]
        if level == 0:
            return i, j, most[keep] / np.maximum(lo_a[i] + lo_b[j] - most[keep], 1)
        level -= 1
        i, j = _children(i, j, len(left.level(level)[1]) if level < len(left.levels) - 1 else None,
                         len(right.level(level)[1]) if level < len(right.levels) - 1 else None)
    return i, j, np.zeros(0)


def _children(i, j, n_left, n_right):
    """The pairs of children; a side that has no level of its own here stays as it is."""
    step = np.arange(LEAF)
    if n_left is not None:
        i, j = (i[:, None] * LEAF + step).ravel(), np.repeat(j, LEAF)
        i, j = i[i < n_left], j[i < n_left]
    if n_right is not None:
        j, i = (j[:, None] * LEAF + step).ravel(), np.repeat(i, LEAF)
        i, j = i[j < n_right], j[j < n_right]
    return i, j


def met_first(found: set[tuple[int, int]], token: int, tokens: dict[int, list[int]]) -> set[tuple[int, int]]:
    """The pairs that share no place of a lesser token: each pair is found in one place alone."""
    lesser = {s: frozenset(t for t in own if t < token) for s, own in tokens.items()}
    return {(u, v) for u, v in found if lesser[u].isdisjoint(lesser[v])}


def tree_pairs_of(left, right, percent: int, pairs=open_pairs) -> set[tuple[int, int]]:
    """(least, greatest) of the ``pairs`` that the trees of two blocks leave. A block is (sids, sizes,
    components, bitmaps); there is a tree per width of its bitmaps, and trees whose sizes allow links
    meet at the smaller width."""

    def by_width(block):
        sids, sizes, comps, bits = block
        width = np.array([len(b) for b in bits], int)
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            yield int(w), sids[at], sizes[at], comps[at], np.frombuffer(b"".join(bits[k] for k in at), np.uint8).reshape(len(at), -1)

    found = set()
    others = list(by_width(right))
    for w, sids, sizes, comps, bits in by_width(left):
        trees: dict[int, Tree] = {}
        for v, sids_b, sizes_b, comps_b, bits_b in others:
            if 100 * sizes.max() < percent * sizes_b.min() or 100 * sizes_b.max() < percent * sizes.min():
                continue
            at = min(v, w)
            if at not in trees:
                trees[at] = Tree(sids, sizes, folded(bits, at), comps)
            # a pair may come from either order of the two sides
            found.update((min(p), max(p)) for p in pairs(
                trees[at], Tree(sids_b, sizes_b, folded(bits_b, at), comps_b), percent))
    return found


def _open_members(places: DataFrame, comps: DataFrame) -> DataFrame:
    """(place, sid, component): the sets of the places that still hold several components. Places whose
    least and greatest sets are the same hold mostly the same sets and are searched as one, so that a set
    with many n-grams in common with its neighbours moves a few times, not once per n-gram. As set ids are
    hashes, places agree on both ends about as often as they share their sets."""
    tied = places.select("token", "sid").join(
        comps.select(F.col("node").alias("sid"), "component"), "sid", "left"
    ).select("token", "sid", F.coalesce("component", "sid").alias("component"))
    open_places = tied.groupBy("token").agg(
        F.min("component").alias("_a"), F.max("component").alias("_b"),
        F.xxhash64(F.min("sid"), F.max("sid")).alias("place")).where("_a <> _b").select("token", "place")
    return tied.join(open_places, "token").groupBy("place", "sid").agg(F.first("component").alias("component"))


def _tree_pairs(places: DataFrame, rows: DataFrame, classes: DataFrame, comps: DataFrame, percent: int,
                first: int | None) -> DataFrame:
    """(u, v): what the signature trees leave of the meeting places that are still open; ``first``: the
    likeliest pairs of one place of so many."""
    pairs = open_pairs if first is None else likeliest_pairs
    if first is not None:
        places = places.where(F.pmod(F.xxhash64("token"), F.lit(FIRST_PLACES)) == first % FIRST_PLACES)
    members = staged(_open_members(places, comps), "members")
    wanted = classes.select("sid", "key").join(members.select("sid").distinct(), "sid", "left_semi").select("key")
    signatures = _signatures(rows, wanted)
    sizes = members.join(signatures.select("sid", F.octet_length("coarse").alias("bytes")), "sid").groupBy("place").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("n_blocks"))
    of_set = members.groupBy("sid").agg(F.collect_list("place").alias("places"))
    n_blocks = F.col("n_blocks")
    dealt = (
        members.join(sizes, "place").join(signatures.select("sid", "size", F.col("coarse").alias("bits")), "sid").join(of_set, "sid")
        .withColumn("lesser", F.filter("places", lambda p: p < F.col("place")))
        .withColumn("block", F.pmod(F.xxhash64("sid"), n_blocks).cast("int"))
        # every block meets every other one and itself, each pair in a group of its own
        .withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
        .select("place", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
                "sid", "size", "bits", "component", "lesser")
    )

    def search(group: pa.Table) -> pa.Table:
        block = group.column("block").to_numpy()
        sids, sizes, comps = (group.column(c).to_numpy() for c in ("sid", "size", "component"))
        bits = group.column("bits").to_pylist()
        sides = []
        for k in ("i", "j"):
            m = np.flatnonzero(block == group.column(k)[0].as_py())
            sides.append((sids[m], sizes[m], comps[m], [bits[x] for x in m]))
        found = tree_pairs_of(*sides, percent, pairs) if len(sides[0][0]) and len(sides[1][0]) else set()
        if found:
            asked = {s for pair in found for s in pair}
            lesser = {s: p for s, p in zip(sids.tolist(), group.column("lesser").to_pylist()) if s in asked}
            found = {p for p in found if p[0] != p[1]}
            found = met_first(found, group.column("place")[0].as_py(), lesser)
        u, v = zip(*found) if found else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    found = staged(dealt.groupBy("place", "i", "j").applyInArrow(search, "u long, v long").distinct(), "found")
    return _possible(found, signatures, percent)


def ngram_components(docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """(doc_id, key, n_shingles, component_id, class_id) per row of ``docs``; ``key`` is the hash of
    id and text, ``class_id`` the hash of the set, equal for documents with equal sets."""
    spark = docs.sparkSession
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = keyed.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    first = staged(_sets(keyed, n), "sets")
    rows = first.where(F.col("slice").isNull()).select("doc_id", "key", "sid", "size", "bits")
    common = spark.sparkContext.broadcast(_common(first.where(F.col("slice").isNotNull()).select("slice", "counts")))
    places = staged(_meeting_places(keyed.select("text"), n, percent, common, partitions(spark)), "places")
    classes = staged(rows.where(F.col("size") > 0).groupBy("sid").agg(F.min("key").alias("key")), "classes")
    # each set is compared with the leader it meets most often
    led = staged(
        places.where(F.col("sid") != F.col("leader")).groupBy("sid", "leader").agg(F.count(F.lit(1)).alias("n"))
        .groupBy(F.col("sid").alias("v")).agg(F.max_by("leader", F.struct("n", "leader")).alias("u")), "led")
    led = staged(_possible(led, _signatures(rows, _wanted(led, classes), trees=False), percent), "possible")
    by_leader = staged(_links(led, keyed, classes, n, percent), "links")
    links = by_leader
    comps = components(links)
    for first in (*range(FIRST_ROUNDS), None):
        left = staged(_tree_pairs(places, rows, classes, comps, percent, first), "left")
        links = links.unionByName(staged(_links(left, keyed, classes, n, percent), "links"))
        comps = components(links)
    # from sets back to documents: a component's least id is pre-aggregated before it moves
    tied = staged(rows.drop("bits").join(comps.select(F.col("node").alias("sid"), "component"), "sid", "left").select(
        "doc_id", "key", "size", F.col("sid").alias("class_id"), F.coalesce("component", "sid").alias("component")), "tied")
    least = tied.where(F.col("size") > 0).groupBy("component").agg(F.min("doc_id").alias("least"))
    return tied.join(least, "component", "left").select(
        "doc_id", "key", F.col("size").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"), "class_id",
        F.when(F.col("size") > 0, F.col("component")).alias("component"))


def keep_one(docs: DataFrame, n: int = 4, percent: int = 85, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` less all but one of each component: the one of least id, then least
    text hash; of rows equal in both, one. Rows without words are all kept."""
    found = ngram_components(docs, n, percent, id_col, text_col)
    kept = found.where(F.col("component").isNotNull()).groupBy("component").agg(
        F.min(F.struct("doc_id", "key")).alias("kept")).select("kept.doc_id", "kept.key")
    wrapped = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("_id"),
        F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string")).alias("_key"),
        F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("worded"))
    chosen = wrapped.where("worded").join(
        kept, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("key")), "left_semi"
    ).dropDuplicates(["_id", "_key"])
    return chosen.select("row.*").unionByName(wrapped.where("NOT worded").select("row.*"))
