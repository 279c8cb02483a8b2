"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the presence of hashed character n-grams (over the lower-case text, white space as
single blanks). From labelled texts come per feature the counts of documents of either class;
their smoothed log ratio is the feature's scale, and the features whose counts differ most from
chance are kept. On the kept ones, scaled to length one per document, a logistic regression is
fitted by gradient steps. Texts are scored whole, one narrow pass over all documents.

The classifier is fitted on at most ``max_rows`` labelled rows (those of least hash), the one bound
here; the texts of the sample are found by broadcasting its ids, so no text moves for it. Counting
and feature extraction run on the executors; the driver holds a fixed number of counters, and the
kept features of the sample.

Defined results: null text is the empty text, which scores like any text without features; rows
that repeat score alike; labels other than 0 and 1, or without doc_id, are not used; an id labelled
twice counts as toxic if any label says so; with no label of one class at all, every score is the
share of toxic labels, (n1 + 1) / (n + 2); an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import map_arrow, partitions, staged, texts

ORDERS = (4, 5, 6, 7)
BITS = 20
SLICES = 64
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))


def features(text: str) -> np.ndarray:
    """The hashed character n-grams of a text, in no order, repeats included."""
    chars = f" {' '.join(text.lower().split())} ".encode("utf-32-le", "replace")
    a = np.frombuffer(chars, np.uint32).astype(np.uint64) * _B
    out, h = [], np.zeros(len(a), np.uint64)
    for k in range(min(max(ORDERS), len(a))):
        h = h[:len(a) - k] * _A + a[k:]
        h ^= h >> np.uint64(29)
        if k + 1 in ORDERS:
            out.append((h * _C >> np.uint64(64 - BITS)).astype(np.int32))
    return np.concatenate(out) if out else np.zeros(0, np.int32)


@dataclass
class Classifier:
    """``scale``: log-count ratio per kept feature, 0 for all others; ``weight``: scale times the fitted weight."""

    scale: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        f = features(text)
        f = np.unique(f[self.scale[f] != 0])
        norm = float(np.sqrt((self.scale[f].astype(float) ** 2).sum()))
        s = self.bias + (float(self.weight[f].sum(dtype=float)) / norm if norm else 0.0)
        return float(1 / (1 + np.exp(-np.clip(s, -500, 500))))


def sample_of(docs: DataFrame, labels: DataFrame, usable: Column, max_rows: int, id_col: str, text_col: str,
              label_col: str) -> DataFrame:
    """(text, label): at most ``max_rows`` labelled texts; ids that ``usable`` excludes are not looked up."""
    one_each = labels.where(usable & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(
        F.col(id_col).cast("long").alias("_id")).agg(F.max(label_col).cast("int").alias("label"))
    ids = one_each.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    found = docs.join(F.broadcast(ids), F.col(id_col).cast("long") == F.col("_id"))  # bounded by max_rows
    return staged(found.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), "label"), "sample")


def _document_counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(2, features) documents with each feature per class, and documents per class."""
    width = (1 << BITS) // SLICES

    def count(batches):
        both = np.zeros((2, 1 << BITS), np.int32)
        n = np.zeros(2, np.int64)
        for batch in batches:
            for text, label in zip(texts(batch.column("text")), batch.column("label").to_pylist()):
                both[label, np.unique(features(text))] += 1
                n[label] += 1
        for k in range(SLICES if n.any() else 0):
            part = both[:, k * width:(k + 1) * width]
            at = np.flatnonzero(part.any(axis=0)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array([k], pa.int32()), pa.array([at.tobytes()], pa.binary()), pa.array([part[:, at].tobytes()], pa.binary()),
                pa.array([int(n[0]) if k == 0 else 0]), pa.array([int(n[1]) if k == 0 else 0])], names=names)

    def add(batches):
        sums, n = {}, np.zeros(2, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                own = sums.setdefault(row["slice"], np.zeros((2, width), np.int32))
                at = np.frombuffer(row["at"], np.int32)
                own[:, at] += np.frombuffer(row["counts"], np.int32).reshape(2, -1)
                n += (row["n0"], row["n1"])
        if sums:
            m = len(sums)
            yield pa.RecordBatch.from_arrays([
                pa.array(list(sums), pa.int32()), pa.array([b""] * m, pa.binary()),
                pa.array([x.tobytes() for x in sums.values()], pa.binary()),
                pa.array([int(n[0])] + [0] * (m - 1)), pa.array([int(n[1])] + [0] * (m - 1))], names=names)

    names = ["slice", "at", "counts", "n0", "n1"]
    schema = "slice int, at binary, counts binary, n0 long, n1 long"
    summed = sample.repartition(partitions(sample.sparkSession)).mapInArrow(count, schema)
    summed = summed.repartitionById(SLICES, F.col("slice")).mapInArrow(add, schema)
    both, n = np.zeros((2, SLICES, width), np.int32), np.zeros(2, np.int64)
    for row in summed.toLocalIterator():
        both[:, row["slice"]] += np.frombuffer(row["counts"], np.int32).reshape(2, -1)
        n += (row["n0"], row["n1"])
    return both.reshape(2, -1), n


def _log_ratios(both: np.ndarray, n: np.ndarray, keep: int, least: int = 3) -> np.ndarray:
    """Smoothed log-count ratios of the ``keep`` features that differ most from chance, 0 elsewhere."""
    seen = both.sum(axis=0)
    share = seen / n.sum()
    expected = n[1] * share
    distance = np.abs(both[1] - expected) / np.sqrt(np.maximum(expected * (1 - share), 1e-9))
    distance[seen < least] = 0
    kept = np.argsort(-distance, kind="stable")[:keep]
    kept = kept[distance[kept] > 0]
    ratios = np.zeros(both.shape[1], np.float32)
    ratios[kept] = np.log((both[1, kept] + 1) / (n[1] + 2)) - np.log((both[0, kept] + 1) / (n[0] + 2))
    return ratios


def _kept_features(sample: DataFrame, ratios: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    shared = sample.sparkSession.sparkContext.broadcast(ratios)  # 2 ** BITS numbers

    def pick(batch: pa.RecordBatch):
        out = []
        for text in texts(batch.column("text")):
            f = features(text)
            out.append(np.unique(f[shared.value[f] != 0]).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), batch.column("label")], names=["at", "label"])

    rows = map_arrow(sample.repartition(partitions(sample.sparkSession)), pick, "at binary, label int").collect()
    # the order in which rows arrive must not matter to the fit
    rows = sorted((bytes(r["at"]), r["label"]) for r in rows)
    return [np.frombuffer(at, np.int32) for at, _ in rows], np.array([label for _, label in rows], float)


def _fit(found: list[np.ndarray], label: np.ndarray, ratios: np.ndarray, steps: int = 300, rate: float = 0.1,
         decay: float = 1e-6) -> Classifier:
    """Logistic regression by adaptive gradient steps over the sample."""
    kept = np.flatnonzero(ratios)
    column = np.zeros(len(ratios), np.int32)
    column[kept] = np.arange(len(kept))
    row = np.repeat(np.arange(len(found), dtype=np.int32), [len(f) for f in found])
    flat = np.concatenate(found) if found else np.zeros(0, np.int32)
    value = ratios[flat].astype(float)
    norm = np.sqrt(np.bincount(row, value ** 2, len(found)))
    value /= norm[row]
    flat = column[flat]
    w = np.zeros(len(kept) + 1)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(np.bincount(row, value * w[flat], len(found)) + w[-1])))
        error = (p - label) / len(label)
        g = np.append(np.bincount(flat, value * error[row], len(kept)) + decay * w[:-1], error.sum())
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        w -= rate * (mean / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.99 ** t)) + 1e-9)
    weight = np.zeros(len(ratios), np.float32)
    weight[kept] = w[:-1] * ratios[kept]
    return Classifier(ratios, weight, float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, max_rows: int = 12_000, keep: int = 10_000,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Classifier:
    """A classifier from the labels of the ids for which ``usable`` (over ``labels``) holds."""
    sample = sample_of(docs, labels, F.lit(True) if usable is None else usable, max_rows, id_col, text_col, label_col)
    both, n = _document_counts(sample)
    if not n.all():
        nothing = np.zeros(1 << BITS, np.float32)
        share = (n[1] + 1) / (n.sum() + 2)
        return Classifier(nothing, nothing, float(np.log(share / (1 - share))))
    ratios = _log_ratios(both, n, keep)
    return _fit(*_kept_features(sample, ratios), ratios)


def score(docs: DataFrame, classifier: Classifier, text_col: str = "text") -> DataFrame:
    """(row, score): every row of ``docs`` with the probability that it is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)  # 2 * 2 ** BITS numbers
    scored = F.pandas_udf(lambda s: pd.Series([shared.value.score(t) for t in s], dtype=float), "double")
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       scored(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("score"))


def held_out(id_: Column) -> Column:
    """Ids whose labels are never learnt from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 1, F.lit(False))
