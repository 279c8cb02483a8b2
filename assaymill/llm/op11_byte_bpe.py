"""Byte-level BPE: encoding and decoding by a rank file, merge for merge as the ranks say.

A vocabulary holds byte strings; a string's rank is its id. The text is cut by a pattern, and in each
match the adjacent parts whose concatenation has the least rank are merged until none is left. Here
no merge is played through at run time:

* Bytes are mapped to Latin-1, so that an Aho-Corasick automaton over the vocabulary finds, in one
  pass over a match, the longest token that starts at each place.
* ``split`` names the two tokens that a token's last merge joined. Two adjacent tokens are
  *compatible* if encoding their concatenation gives just these two: walking down the right edge of
  the first and the left edge of the second, no merge across the border may come before the merges
  that finished either side. Answers are memoised.
* Encoding goes from left to right with the longest token that is compatible with the one before it,
  else with the next shorter token that is a prefix of it; where none is left, it steps back one
  token and tries that one shorter. A place from which the rest can't be encoded is never tried
  again, so the time is linear in the match. A sequence whose neighbours are all compatible is the
  one that the merges give, and there is only one.

Vocabulary tables are made once on the driver and broadcast: their size is that of the file.
Documents are encoded where they lie: no shuffle, whole texts, one at a time. Workers keep the ids of
recent chunks of text in two generations of fixed size; very long texts take memory in proportion to
their longest match of the pattern, and results leave in bounded batches.

Defined results: null or empty text has no tokens and decodes to no bytes; rows that repeat are
encoded each; null ids of documents are kept; an empty table gives an empty table; a column named
like one of the results is kept apart in ``row``. A null among the ids to decode is no bytes; an id
that the vocabulary lacks is an error. A vocabulary with tokens that merges of lower rank don't make,
which no training gives, has no unique sequence of this kind; its matches are merged by the definition.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import map_arrow

#: Entries in each of the two generations of chunks and of matches whose ids a worker keeps, and the
#: memoised answers about neighbours.
CACHED, COMPATIBLE = 200_000, 1_000_000
#: Bytes of ids or of texts after which a batch of results leaves the worker.
BATCH_BYTES = 4 << 20
#: White space of the pattern: Unicode's property, which is not that of the standard library's \s.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_CHUNK = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_NEVER = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one token per line, in base64, and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


def merged_by_rank(text: bytes, ranks: dict[bytes, int], below: int = _NEVER) -> list[bytes]:
    """The definition: merge the leftmost pair of least rank under ``below`` until there is none."""
    parts = [text[i:i + 1] for i in range(len(text))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= below:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class ByteBpe:
    """Tables of one vocabulary. What workers build and remember is left out when it is sent."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        lacking = [b for b in range(256) if bytes([b]) not in ranks]
        if lacking:
            raise ValueError(f"the vocabulary lacks {len(lacking)} single bytes")
        self.pattern = pattern
        self.ranks = ranks
        #: last merge of each token of two bytes or more
        self.split: dict[int, tuple[int, int]] = {}
        self.regular = True
        for token, rank in ranks.items():
            if len(token) > 1:
                parts = merged_by_rank(token, ranks, rank)
                if len(parts) == 2:
                    self.split[rank] = (ranks[parts[0]], ranks[parts[1]])
                else:
                    self.regular = False
        self._prepare()

    def __getstate__(self):
        return self.pattern, self.ranks, self.split, self.regular

    def __setstate__(self, state):
        self.pattern, self.ranks, self.split, self.regular = state
        self._prepare()

    def _prepare(self) -> None:
        self.matches = regex.compile(self.pattern).findall
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.length_of = {rank: len(token) for token, rank in self.ranks.items()}
        self.merge = {pair: rank for rank, pair in self.split.items()}
        self.automaton = None  # built by the first worker call that needs it
        self.compatible: dict[int, bool] = {}
        self.prefix: dict[int, int | None] = {}
        self.chunks: dict[str, bytes] = {}
        self.old_chunks: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.old_known: dict[str, bytes] = {}

    # --- one match ---------------------------------------------------------------------------------

    def _automaton(self):
        if self.automaton is None:
            found = ahocorasick.Automaton()
            for token, rank in self.ranks.items():
                found.add_word(token.decode("latin-1"), (rank, len(token)))
            found.make_automaton()
            self.automaton = found
        return self.automaton

    def shorter(self, token: int) -> int | None:
        """The longest other token that ``token`` starts with."""
        if token not in self.prefix:
            text = self.bytes_of[token]
            cuts = (self.ranks.get(text[:k]) for k in range(len(text) - 1, 0, -1))
            self.prefix[token] = next((t for t in cuts if t is not None), None)
        return self.prefix[token]

    def neighbours(self, first: int, second: int) -> bool:
        """Whether no merge across the border of the two comes before those that made them. Of merges
        of one rank the left one comes first."""
        a, b, until_a, until_b = first, second, _NEVER, _NEVER
        while True:
            across = self.merge.get((a, b))
            if across is not None and across < until_a and across <= until_b:
                return False
            made_a, made_b = a if a in self.split else -1, b if b in self.split else -1
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:  # made later, so it is taken apart first; of equals, the right one
                until_a, a = a, self.split[a][1]
            else:
                until_b, b = b, self.split[b][0]

    def _may_follow(self, first: int, second: int) -> bool:
        if len(self.compatible) >= COMPATIBLE:
            self.compatible.clear()
        answer = self.compatible[first << 32 | second] = self.neighbours(first, second)
        return answer

    def encode_match(self, text: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(text)
        if whole is not None:
            return [whole]
        if not self.regular:
            return [self.ranks[part] for part in merged_by_rank(text, self.ranks)]
        longest: dict[int, int] = {}
        for end, (token, length) in (self.automaton or self._automaton()).iter(text.decode("latin-1")):
            longest[end + 1 - length] = token  # at one start, later ends are longer
        n, size, answers, may_follow = len(text), self.length_of, self.compatible, self._may_follow
        out, dead = [], set()
        at, token, last = 0, longest[0], -1
        while True:
            while token is not None:
                end = at + size[token]
                if end not in dead:
                    ok = answers.get(last << 32 | token) if last >= 0 else True
                    if may_follow(last, token) if ok is None else ok:
                        break
                token = self.shorter(token)
            if token is not None:
                out.append(token)
                if end == n:
                    return out
                at, last, token = end, token, longest[end]
            else:
                dead.add(at)
                token = out.pop()
                at -= size[token]
                last = out[-1] if out else -1

    # --- texts -------------------------------------------------------------------------------------

    def _match(self, match: str) -> bytes:
        ids = self.known.get(match)
        if ids is None:
            ids = self.old_known.get(match)
            if ids is None:
                ids = array("I", self.encode_match(match.encode())).tobytes()
            if len(self.known) >= CACHED:
                self.old_known, self.known = self.known, {}
            if len(match) <= 40:
                self.known[match] = ids
        return ids

    def _chunk(self, chunk: str) -> bytes:
        ids = self.old_chunks.get(chunk)
        if ids is None:
            ids = b"".join(map(self._match, self.matches(chunk)))
        if len(self.chunks) >= CACHED:
            self.old_chunks, self.chunks = self.chunks, {}
        if len(chunk) <= 40:
            self.chunks[chunk] = ids
        return ids

    def encode(self, text: str, whole: bool = False) -> bytes:
        """Ids of a text as little-endian 32-bit numbers. No match of a pattern that takes white space
        only in front of other characters, or alone, reaches from them into white space; then chunks
        of white space with what follows it are encoded for themselves. ``whole``: any pattern."""
        if whole:
            return b"".join(map(self._match, self.matches(text)))
        get, chunk = self.chunks.get, self._chunk
        return b"".join([get(c) or chunk(c) for c in _CHUNK.findall(text)])

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join([self.bytes_of[i] for i in ids])


def load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(read_ranks(path), pattern)


def _batches(rows, values, kind, name):
    """Record batches of the ``row`` struct and the values made for its rows, of bounded bytes."""
    held, size, begin = [], 0, 0
    for k, value in enumerate(values):
        held.append(value)
        size += len(value)
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([rows.slice(begin, len(held)), pa.array(held, kind)], names=["row", name])
            begin, held, size = k + 1, [], 0
    if held:
        yield pa.RecordBatch.from_arrays([rows.slice(begin, len(held)), pa.array(held, kind)], names=["row", name])


def _mapped(spark: SparkSession, rows: DataFrame, value: str, name: str, codec: ByteBpe, fn) -> DataFrame:
    shared = spark.sparkContext.broadcast(codec)
    kept = rows.schema["row"].dataType.simpleString()

    def look(batch: pa.RecordBatch):
        column = batch.column(value)
        made = (fn(shared.value, None if x is None else x.as_py()) for x in column)
        yield from _batches(batch.column("row"), made, pa.binary(), name)

    return map_arrow(rows, look, f"row {kept}, {name} binary")


def encode(docs: DataFrame, codec: ByteBpe, text_col: str = "text", keep: Sequence[str] | None = None,
           whole: bool = False) -> DataFrame:
    """(row, ids): ``row`` holds the columns ``keep`` (all but the text, if not given); ``ids`` are
    little-endian unsigned 32-bit numbers. ``whole``: see :meth:`ByteBpe.encode`."""
    kept = [c for c in docs.columns if c != text_col] if keep is None else list(keep)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept] or [F.lit(None).alias("_")]).alias("row"),
                       F.col(text_col).cast("string").alias("text"))
    return _mapped(docs.sparkSession, rows, "text", "ids", codec,
                   lambda c, x: c.encode(x or "", whole))


def decode(encoded: DataFrame, codec: ByteBpe) -> DataFrame:
    """(row, ids, bytes) from (row, ids): the bytes that the ids stand for."""
    rows = encoded.select(F.struct("row", "ids").alias("row"), F.col("ids").alias("given"))
    out = _mapped(encoded.sparkSession, rows, "given", "bytes", codec,
                  lambda c, x: c.decode(np.frombuffer(x or b"", "<u4").tolist()))
    return out.select("row.row", "row.ids", "bytes")


def n_tokens(ids: str = "ids"):
    return (F.coalesce(F.octet_length(ids), F.lit(0)) / 4).cast("bigint")
