"""Secret scans with corpus-wide ownership frequency.

Each text is scanned once for the base kinds (assignments, access keys, hex runs) and for further
long mixed tokens. The values found are candidates; only their 128-bit digests leave the task.
Over the whole corpus a candidate's distinct owners are counted: one that few owners hold, in however
many documents, and that looks random for its length, is ``live``; one that many owners hold is a copied
example. Where no owner is named at all, few repositories decide instead. The base spans stay as they
are; the live candidates are added as spans of kind ``live``.

By default a document's source is the owner, and its text the repository, so that exact copies of a
text are one. Distinct owners and repositories are told apart per digest and pre-aggregated before
they move, so an example that a third of the documents hold is a few rows per task.

Defined results: null or empty text has no spans; null owner or repository counts as one owner or
repository; equal rows each get the same result; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow, staged, texts

KINDS = ("assign", "access", "hex", "live")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_KEYWORDS = ("passw", "secret", "token", "api_key", "apikey")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_LONG = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
# byte -> '1' if it may stand in such a run: a run of '1's shows where a pattern can match at all
_HEX_MAP = bytes(49 if chr(b) in "0123456789abcdef" else 48 for b in range(256))
_LONG_MAP = bytes(49 if re.match(r"[A-Za-z0-9+/_=-]", chr(b), re.A) else 48 for b in range(256))


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base kinds, leftmost and non-overlapping per kind."""
    found = []
    lower = text.lower()
    if any(k in lower for k in _KEYWORDS):
        found += [("assign", m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text)]
    if b"1" * 24 in text.encode().translate(_HEX_MAP):
        found += [("hex", m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def entropy(value: str) -> float:
    """Bits per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def candidates(text: str, base: list[tuple[str, int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, value) of the values that look random: those of the base spans, and long tokens
    that mix digits with letters of both cases. Random is three quarters of the entropy that the
    length allows, 3 bits from 16 characters on."""
    found = {(end - len(value), end): value for _, _, end, value in base}
    if b"1" * 20 in text.encode().translate(_LONG_MAP):
        for m in _LONG.finditer(text):
            v = m[0]
            if re.search("[0-9]", v) and re.search("[a-z]", v) and re.search("[A-Z]", v) and not any(
                    s < m.end() and m.start() < e for s, e in found):
                found[m.span()] = v
    return [(s, e, v) for (s, e), v in sorted(found.items()) if entropy(v) >= 0.75 * math.log2(min(len(v), 16))]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
         repo_col: str | None = None) -> DataFrame:
    """One row per document: row_no, doc_id, owner, repo, base spans, and candidates by digest."""
    schema = ("row_no long, doc_id long, owner string, repo string, "
              "base array<struct<kind:string,start:int,end:int>>, "
              "found array<struct<digest:string,start:int,end:int>>")
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    digests = pa.list_(pa.struct([("digest", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def look(batch: pa.RecordBatch):
        base, found = [], []
        for text in texts(batch.column("text")):
            spans = base_spans(text)
            base.append([dict(kind=k, start=s, end=e) for k, s, e, _ in spans])
            found.append([dict(digest=hashlib.blake2b(v.encode(), digest_size=16).hexdigest(), start=s, end=e)
                          for s, e, v in candidates(text, spans)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(c) for c in ("row_no", "doc_id", "owner", "repo")]
            + [pa.array(base, kinds), pa.array(found, digests)],
            names=["row_no", "doc_id", "owner", "repo", "base", "found"])

    return map_arrow(docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col(id_col).cast("long").alias("doc_id"),
        F.col(owner_col).cast("string").alias("owner"),
        (F.col(repo_col) if repo_col else F.xxhash64(text_col)).cast("string").alias("repo"),
        F.col(text_col).cast("string").alias("text")), look, schema)


def ownership(found: DataFrame) -> DataFrame:
    """(digest, n_repos, n_owners, owned) from (digest, owner, repo), over the whole corpus; ``owned``
    if an owner is named."""
    return found.groupBy("digest").agg(
        F.count_distinct(F.struct("repo")).alias("n_repos"), F.count_distinct(F.struct("owner")).alias("n_owners"),
        F.max(F.col("owner").isNotNull()).alias("owned"))


def find_secrets(docs: DataFrame, max_repos: int = 10, max_owners: int = 3, id_col: str = "doc_id",
                 text_col: str = "text", owner_col: str = "source", repo_col: str | None = None) -> DataFrame:
    """(doc_id, base, live): spans per row of ``docs``, in order; live ones carry their counts."""
    rows = staged(scan(docs, id_col, text_col, owner_col, repo_col), "scan")
    found = rows.select("row_no", "owner", "repo", F.explode("found").alias("f")).select("row_no", "owner", "repo", "f.*")
    rare = ownership(found).where(
        (F.col("n_owners") <= max_owners) & (F.col("owned") | (F.col("n_repos") <= max_repos)))
    live = found.join(rare, "digest").groupBy("row_no").agg(F.array_sort(F.collect_set(
        F.struct("start", "end", "n_repos", "n_owners"))).alias("live"))
    return rows.select("row_no", "doc_id", "base").join(live, "row_no", "left").select(
        "doc_id", "base", F.coalesce("live", F.array().cast("array<struct<start:int,end:int,n_repos:bigint,n_owners:bigint>>"))
        .alias("live"))


def joined(spans: Column) -> Column:
    """kind:start:end of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
