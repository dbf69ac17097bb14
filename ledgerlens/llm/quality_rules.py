"""Quality rules whose thresholds carry a guarantee.

Method.  Nine counts sum up each whole text; eight shares of them (in whole
thousandths) are the rules: a document with a share at or over a rule's cut-off
is rejected.  The cut-offs come from labelled documents, separately per stratum
(the language), in two parts that share no document:

* The *proposing* third (by md5 of the id) gives each rule the cut-off with the
  largest gain, bad documents rejected less ``cost`` times good ones, halfway to
  the next smaller share seen.  Rules with a gain are ordered by it, so that the
  first one, two, ... rules of a stratum form a nested path.
* The *holdout*, the other two thirds, tests every step of every path: the null
  hypothesis "this step falsely rejects more than ``risk`` of the stratum's good
  documents" is dropped if the exact binomial probability of so few false
  rejections is at most ``delta`` / number of steps tested (Bonferroni over all
  strata and steps; the number depends on the proposing part alone).  The longest
  step that passes is used.

So with probability 1 - ``delta`` no stratum loses more than ``risk`` of its good
documents (among those that pass the base rules) to the chosen cut-offs.  A
stratum with too few labels to prove that gets no cut-offs.  Counts run where the
text is scanned; the labelled shares become histograms of at most 1,001 bins a
rule and label, so nothing grows with the corpus but sums.
"""

from __future__ import annotations

from math import exp, lgamma, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import lookup, slices, stored, text_buffer, word_spans

STEP_BYTES = 1 << 20
#: Words of a window that counts as repeated.
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits", "n_marks")

# Characters counted as symbols (by the contract) and as other marks.
SYMBOLS = "#*$%&|<>"
MARKS = "!?\"'()[]{}=+_/\\^~`@;:-"

#: Rule -> share in thousandths, as Spark SQL; ``div`` rounds down.
RULES = {
    "symbols": "1000 * n_symbols div greatest(word_chars, 1)",
    "dup_lines": "1000 * n_dup_lines div greatest(n_lines, 1)",
    "repeats": "1000 * n_repeat_words div greatest(n_words, 1)",
    "upper": "1000 * n_upper div greatest(word_chars, 1)",
    "digits": "1000 * n_digits div greatest(word_chars, 1)",
    "marks": "1000 * n_marks div greatest(word_chars, 1)",
    "long_words": "1000 - 1000 * n_words div greatest(word_chars, 1)",
    "short_words": "1000 * n_words div greatest(word_chars, 1)",
}


def _signs(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL, _MARK = _signs(SYMBOLS), _signs(MARKS)
_UPPER, _DIGIT = _signs("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _signs("0123456789")


def _codes(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers 0, 1, ... of equal values, and how many there are."""
    codes, distinct = pd.factorize(values)
    return codes.astype(np.int64), len(distinct)


def repeated_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text, the words inside a window of WINDOW words that occurs at least
    twice in that text.  Words are numbered by their bytes and windows by their
    words' numbers, so equality is exact."""
    n_texts, n = len(first) - 1, len(starts)
    if n < WINDOW:
        return np.zeros(n_texts, np.int64)
    width = ends - starts
    inside = np.repeat(starts - (np.cumsum(width) - width), width) + np.arange(width.sum())
    words = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.concatenate([[0], np.cumsum(width)])), pa.py_buffer(buf[inside])])
    word = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(n_texts), np.diff(first))
    run, many, size = word, int(word.max()) + 1, 1
    while size < WINDOW:  # numbers of windows of size + 1 words from those of size words and the next word
        run, _ = _codes(run[:-1] * many + word[size:])
        size += 1
    within = text[:-(WINDOW - 1)] == text[WINDOW - 1:]
    run, text_of = run[within], text[:-(WINDOW - 1)][within]
    run, n_runs = _codes(run * n_texts + text_of)
    twice = np.bincount(run, minlength=n_runs)[run] > 1
    at = np.flatnonzero(within)[twice]
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + WINDOW, -1)
    return np.bincount(text[np.cumsum(step[:-1]) > 0], minlength=n_texts)


def counts_of(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(texts, COUNTS) of concatenated UTF-8 texts."""
    n = len(off) - 1
    starts, ends, first = word_spans(buf, off)
    filled, some = np.flatnonzero(np.diff(off)), np.flatnonzero(np.diff(first))
    out = np.zeros((n, len(COUNTS)), np.int64)
    out[:, 0] = np.diff(first)
    if len(some):
        chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
        out[some, 1] = np.add.reduceat(chars[ends] - chars[starts], first[some])
    for column, sign in ((2, _SYMBOL), (6, _UPPER), (7, _DIGIT), (8, _MARK)):
        if len(filled):
            out[filled, column] = np.add.reduceat(sign[buf], off[filled], dtype=np.int64)
    raw = buf.tobytes()
    for i in some:
        lines = [x for x in raw[off[i]:off[i + 1]].split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
        out[i, 3], out[i, 4] = len(lines), len(lines) - len(set(lines))
    out[:, 5] = repeated_words(buf, starts, ends, first)
    return out


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """doc_id, stratum and COUNTS of each row; a null text counts as empty."""

    def run(batches):
        for rows in batches:
            whole, off = text_buffer(rows.column(2).fill_null(""))
            got = [counts_of(whole[off[a]:off[b]], off[a:b + 1] - off[a]) for a, b in slices(off, STEP_BYTES)]
            got = np.concatenate(got) if got else np.zeros((0, len(COUNTS)), np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *map(pa.array, got.T)], names=["doc_id", "stratum", *COUNTS])

    return docs.select(F.col(id_col).cast("long"), F.col(stratum_col).cast("string"), F.col(text_col)).mapInArrow(
        run, "doc_id long, stratum string, " + ", ".join(f"{c} long" for c in COUNTS))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of X binomial (n, p), summed exactly from k down; 1 if k is over
    the mean, where no test of interest passes."""
    if n <= 0 or k >= n * p:
        return 1.0
    term = exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1) + k * log(p) + (n - k) * log(1 - p))
    total = 0.0
    while term > total * 1e-17:
        total += term
        if not k:
            break
        term *= k * (1 - p) / ((n - k + 1) * p)
        k -= 1
    return total


def proposals(shares: DataFrame, cost: int = 10) -> DataFrame:
    """stratum, rule (its index in RULES), cutoff, step (1: largest gain) from
    proposing rows (stratum, y 0/1, v: array of shares); only rules with a gain."""
    seen = shares.select("stratum", "y", F.posexplode("v").alias("rule", "share"))
    seen = seen.groupBy("stratum", "rule", "share").agg(F.sum(1 - F.col("y")).alias("bad"), F.sum("y").alias("good"))
    down = Window.partitionBy("stratum", "rule").orderBy(F.desc("share"))  # at most 1,001 rows each
    gains = seen.select("stratum", "rule", "share", F.lead("share").over(down).alias("below"),
                        (F.sum("bad").over(down) - cost * F.sum("good").over(down)).alias("gain")).where("gain > 0")
    best = gains.groupBy("stratum", "rule").agg(F.max(F.struct("gain", "share", "below")).alias("b"))
    by_gain = Window.partitionBy("stratum").orderBy(F.desc("b.gain"), "rule")  # at most one row a rule
    return best.select("stratum", "rule", F.expr("(coalesce(b.below, b.share) + b.share + 1) div 2").alias("cutoff"),
                       F.row_number().over(by_gain).alias("step"))


def _first_step(cutoffs: str = "cutoffs") -> str:
    """The first step of a path that rejects a row with shares ``v``, or null."""
    return f"array_min(transform(filter({cutoffs}, x -> v[x.rule] >= x.cutoff), x -> x.step))"


def certified(paths: DataFrame, n_steps: int, holdout: DataFrame, risk: float, delta: float) -> DataFrame:
    """stratum, steps (the longest proved step, over 0), n_good, n_false, p_value
    from paths (stratum, cutoffs) and holdout rows (stratum, v) of good documents."""

    @F.pandas_udf("double")
    def tail(k: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([binomial_tail(int(a), int(b), risk) for a, b in zip(k, n, strict=True)], dtype=float)

    joined = lookup(holdout, paths.withColumnRenamed("stratum", "of"), "stratum", "of", paths.count(), ["v"])
    hits = joined.where("cutoffs is not null").groupBy("stratum", F.expr(_first_step()).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    per = hits.groupBy("stratum").agg(F.sum("n").alias("n_good"), F.collect_list(F.struct("at", "n")).alias("hits"))  # one entry a step
    steps = per.join(paths.withColumnRenamed("stratum", "of"), F.col("stratum").eqNullSafe(F.col("of"))).select(
        "stratum", "n_good", "hits", F.explode("cutoffs.step").alias("steps"))
    steps = steps.withColumn("n_false", F.expr("aggregate(filter(hits, x -> x.at <= steps), 0L, (s, x) -> s + x.n)"))
    tested = steps.withColumn("p_value", tail("n_false", "n_good")).where(F.col("p_value") <= delta / max(n_steps, 1))
    return tested.groupBy("stratum").agg(F.max(F.struct("steps", "n_good", "n_false", "p_value")).alias("t")).select("stratum", "t.*")


def fitted_rules(shares: DataFrame, risk: float = 0.05, delta: float = 0.05, cost: int = 10) -> DataFrame:
    """stratum, cutoffs (array of rule, cutoff, step), n_good, n_false, p_value of
    every stratum with proved rules, from labelled rows (doc_id, stratum, y, v)."""
    part = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("long") % 3
    proposed = stored(proposals(shares.where(part == 0), cost), "proposals")
    paths = proposed.groupBy("stratum").agg(F.sort_array(F.collect_list(F.struct("step", "rule", "cutoff"))).alias("cutoffs"))  # one entry a rule
    proved = certified(paths, proposed.count(), shares.where((part != 0) & (F.col("y") == 1)), risk, delta)
    return (proved.withColumnRenamed("stratum", "of").join(paths, F.col("of").eqNullSafe(F.col("stratum")))
            .select("stratum", F.expr("filter(cutoffs, x -> x.step <= steps)").alias("cutoffs"), "n_good", "n_false", "p_value"))


def judged(docs: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05, cost: int = 10, id_col: str = "doc_id",
           text_col: str = "text", stratum_col: str = "lang", label_col: str = "quality") -> DataFrame:
    """One row per input row: doc_id, stratum, COUNTS, base_failed, kept, rule (the
    name of the first chosen rule that rejects it, null if none does).

    base_failed: under 10 words, or over 20 % of the words repeated; such rows
    neither teach nor test.  Null and empty texts have zero counts and so fail.
    Null ids, null labels and labels other than 0 and 1 teach nothing; a document
    labelled twice counts twice, and rows repeated whole count each time (the
    guarantee then speaks of rows).  A null stratum is a stratum of its own.
    Without proved rules, as in empty tables, ``kept`` is ``not base_failed``.
    """
    counted = stored(text_counts(docs, id_col, text_col, stratum_col), "text-counts").select(
        "*", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words").alias("base_failed"),
        F.array(*[F.expr(rule) for rule in RULES.values()]).alias("v"))
    y = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("long").alias("y"))
    shares = stored(counted.where("not base_failed").join(y, "doc_id").select("doc_id", "stratum", "y", "v"), "shares")
    rules = stored(fitted_rules(shares, risk, delta, cost).select(F.col("stratum").alias("of"), "cutoffs"), "rules")
    out = lookup(counted, rules, "stratum", "of", rules.count(), ["doc_id", "v"])
    names = F.array(*map(F.lit, RULES))
    hit = F.expr("get(filter(cutoffs, x -> v[x.rule] >= x.cutoff), 0).rule")
    return out.select("doc_id", "stratum", *COUNTS, "base_failed", (~F.col("base_failed") & hit.isNull()).alias("kept"),
                      F.when(~F.col("base_failed") & hit.isNotNull(), F.get(names, hit)).alias("rule"))
