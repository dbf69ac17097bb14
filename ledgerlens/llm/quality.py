"""Quality classifier: regularised quadratic discriminant analysis.

Method.  Each text is summed up by bounded document statistics, transformed to
be closer to normal (logs, logits).  Labelled training rows give, per class,
count, sum and outer-product sum (added up in Spark, so all of them count, in
any number).  Each class covariance is shrunk towards the pooled one and that
towards its diagonal; its Cholesky factor is computed once and cached in the
model.  A document's score is the logistic function of the difference of the two
log-densities (Mahalanobis distance and log-determinant) and log-priors, less the
offset at which the training rows are best told apart (the classes are not
normal, so the plain difference would reject too many short clean texts).

Id, language, source and the labels themselves are never inputs of a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import shield, slices, small_side, stored, text_buffer, word_spans

STEP_BYTES = 1 << 20
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+").findall

_CLASSES = np.zeros((7, 256), bool)
_CLASSES[0, 65:91] = True  # upper case
_CLASSES[1, 97:123] = True  # lower case
_CLASSES[2, 48:58] = True  # digits
_CLASSES[3, [0x2E, 0x2C]] = True  # full stops and commas
_CLASSES[4, [i for i in range(33, 127) if not chr(i).isalnum() and chr(i) not in ".,"]] = True  # other signs
_CLASSES[5, 128:] = True  # bytes of other scripts and accents
_CLASSES[6, 0x0A] = True  # line ends

STATISTICS = ("log_words", "log_word_bytes", "upper", "digits", "stops", "signs", "other_bytes", "line_ends", "distinct_words",
              "top_word", "repeated_next", "distinct_triples", "caps_words", "signed_words")


def _logit(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Log-odds of a share, with half a count on both sides."""
    return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))


def statistics_of(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(texts, statistics) of concatenated texts; a text without words has the
    statistics of zero counts."""
    n = len(off) - 1
    starts, ends, first = word_spans(buf, off)
    words = np.diff(first).astype(float)
    sums = np.zeros((7, n))
    filled = np.flatnonzero(np.diff(off))
    for k in range(7):
        if len(filled):
            sums[k, filled] = np.add.reduceat(_CLASSES[k][buf], off[filled], dtype=np.int64)
    upper, lower, digits, stops, signs, other, lines = sums
    some = np.flatnonzero(np.diff(first))
    size, caps, signed = np.zeros(n), np.zeros(n), np.zeros(n)
    if len(some):
        at = first[some]
        size[some] = np.add.reduceat(ends - starts, at)
        up = np.concatenate([[0], np.cumsum(_CLASSES[0][buf])])
        low = np.concatenate([[0], np.cumsum(_CLASSES[1][buf])])
        caps[some] = np.add.reduceat((up[ends] - up[starts] >= 2) & (low[ends] == low[starts]), at, dtype=np.int64)
        signed[some] = np.add.reduceat(_CLASSES[4][buf[ends - 1]], at, dtype=np.int64)
    distinct, top, same, triples = (np.zeros(n) for _ in range(4))
    raw = buf.tobytes()
    for i in some:
        w = _WORDS(raw[off[i]:off[i + 1]])
        seen: dict[bytes, int] = {}
        for x in w:
            seen[x] = seen.get(x, 0) + 1
        distinct[i], top[i] = len(seen), max(seen.values())
        same[i] = sum(map(bytes.__eq__, w, w[1:]))
        triples[i] = len(set(zip(w, w[1:], w[2:]))) if len(w) > 2 else 0
    n3 = np.maximum(words - 2, 0)
    bytes_ = size
    return np.column_stack([
        np.log1p(words), np.log1p(size / np.maximum(words, 1)), _logit(upper, upper + lower), _logit(digits, bytes_), _logit(stops, bytes_),
        _logit(signs, bytes_), _logit(other, bytes_), np.log1p(lines) - np.log1p(words), _logit(distinct, words), _logit(top, words),
        _logit(same, words), _logit(triples, n3), _logit(caps, words), _logit(signed, words)])


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (xxhash64 of the text) and x (the statistics) of each row."""

    def run(batches):
        for rows in batches:
            whole, off = text_buffer(rows.column(2).fill_null(""))
            x = [statistics_of(whole[off[a]:off[b]], off[a:b + 1] - off[a]) for a, b in slices(off, STEP_BYTES)]
            x = np.concatenate(x) if x else np.zeros((0, len(STATISTICS)))
            lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, len(STATISTICS), dtype=np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), lists], names=["doc_id", "key", "x"])

    return docs.select(F.col(id_col).cast("long"), F.xxhash64(text_col), F.col(text_col)).mapInArrow(run, "doc_id long, key long, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and constants (log-prior less half the
    log-determinant) of the classes 0 and 1.  ``means`` None: too few labels,
    every score is ``prior``."""

    means: np.ndarray | None
    factors: np.ndarray | None
    constants: np.ndarray | None
    prior: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        density = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants, strict=True)]
        return density[1] - density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(np.clip(-self.log_odds(x), -500, 500)))


def _moments(labelled: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Per class: rows, sum, and sum of outer products; partial sums per task."""
    d = len(STATISTICS)

    def run(batches):
        total = {0: [0, np.zeros(d), np.zeros((d, d))], 1: [0, np.zeros(d), np.zeros((d, d))]}
        for rows in batches:
            y = np.array(rows.column(0))
            x = np.array(rows.column(1).flatten()).reshape(-1, d)
            for c, t in total.items():
                part = x[y == c]
                t[0] += len(part)
                t[1] += part.sum(axis=0)
                t[2] += part.T @ part
        for c, (n, s, o) in total.items():
            if n:
                values = np.concatenate([s, o.ravel()])
                yield pa.RecordBatch.from_arrays([pa.array([c] * len(values)), pa.array(np.arange(len(values))), pa.array([n] * len(values)), pa.array(values)],
                                                 names=["c", "i", "n", "v"])

    sums = labelled.select(F.col("y").cast("long"), "x").mapInArrow(run, "c long, i long, n long, v double")
    out: dict[int, tuple] = {}
    rows = sums.groupBy("c", "i").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()  # 2 * (d + d * d) numbers
    for c in {r.c for r in rows}:
        v = np.array([r.v for r in sorted((r for r in rows if r.c == c), key=lambda r: r.i)])
        out[c] = (next(r.n for r in rows if r.c == c), v[:d], v[d:].reshape(d, d))
    return out


def _offset(model: Discriminant, labelled: DataFrame) -> float:
    """The log-odds that part the labelled rows with the fewest errors; the
    middle of the widest range of them.  Counted in quarters from -250 to 250."""

    def run(batches):
        for rows in batches:
            odds = model.log_odds(np.array(rows.column(1).flatten()).reshape(-1, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.clip(np.floor(odds * 4), -1000, 1000).astype(np.int64))], names=["c", "bin"])

    bins = labelled.select(F.col("y").cast("long"), "x").mapInArrow(run, "c long, bin long")
    count = np.zeros((2, 2001), np.int64)
    for r in bins.groupBy("c", "bin").agg(F.count(F.lit(1)).alias("n")).collect():  # 2 * 2001 numbers at most
        count[r.c, r.bin + 1000] = r.n
    wrong = np.cumsum(count[1]) - np.cumsum(count[0])  # up to a constant, if bins up to i are rejected
    best = np.flatnonzero(wrong == wrong.min())
    runs = np.split(best, np.flatnonzero(np.diff(best) > 1) + 1)
    widest = max(runs, key=len)
    return ((widest[0] + widest[-1]) / 2 + 1 - 1000) / 4


def fit(labelled: DataFrame, shrink: float = 0.1, diagonal: float = 0.0) -> Discriminant:
    """The discriminant of (y 0/1, x) rows: class covariance = (1 - shrink) own +
    shrink pooled, then (1 - diagonal) of that + diagonal of its own diagonal."""
    m = _moments(labelled)
    n = {c: m[c][0] if c in m else 0 for c in (0, 1)}
    if min(n.values()) < 2:
        return Discriminant(None, None, None, (n[1] + 1) / (n[0] + n[1] + 2) if sum(n.values()) else 0.5)
    means = np.array([m[c][1] / n[c] for c in (0, 1)])
    own = [m[c][2] / n[c] - np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = (n[0] * own[0] + n[1] * own[1]) / (n[0] + n[1])
    floor = np.diag(np.maximum(np.diag(pooled), 1e-6)) * 1e-3
    factors, constants = [], []
    for c in (0, 1):
        cov = (1 - shrink) * own[c] + shrink * pooled
        cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + floor
        chol = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(chol))
        constants.append(np.log(n[c] / (n[0] + n[1])) - np.log(np.diag(chol)).sum())
    model = Discriminant(means, np.array(factors), np.array(constants), n[1] / (n[0] + n[1]))
    constants[1] -= _offset(model, labelled)
    return Discriminant(model.means, model.factors, np.array(constants), model.prior)


def is_held_out(doc_id: Column) -> Column:
    """Rows that never teach: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """One row per input row: doc_id, key (xxhash64 of the text), held_out, score
    (0 to 1, higher: label 1 likelier), predicted (1 if score >= 0.5).

    Learns from labelled rows that are not held out; null labels and ids teach
    nothing, a document labelled twice counts twice.  With fewer than two rows of
    a class all scores are the share of label 1 (0.5 without labels).  Null and
    empty texts are scored by their (zero) statistics.
    """
    x = stored(with_statistics(docs, id_col, text_col), "statistics")
    y = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("y"))
    model = fit(stored(x.where(~is_held_out(F.col("doc_id"))).join(y, "doc_id").select("y", "x"), "labelled"))

    def run(batches):
        for rows in batches:
            score = model.score(np.array(rows.column(2).flatten()).reshape(-1, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(score)], names=["doc_id", "key", "score"])

    out = x.select("doc_id", "key", "x").mapInArrow(run, "doc_id long, key long, score double")
    return out.select("doc_id", "key", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, unchanged."""
    # the verdict depends on the text alone, so rows that agree in id and text share it
    inner, (i, t), restore = shield(docs, id_col, text_col)
    y = labels.withColumnRenamed(id_col, i)
    bad = scored(inner, y, i, t).where("predicted = 0").select(F.col("doc_id").alias("bad_id"), F.col("key").alias("bad_key")).distinct()
    bad = stored(bad, "rejected")
    same = F.col(i).cast("long").eqNullSafe(F.col("bad_id")) & (F.xxhash64(t) == F.col("bad_key"))
    return inner.join(small_side(bad, bad.count()), same, "left_anti").select(*restore)
