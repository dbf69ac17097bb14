"""Spelling variants: words one edit apart, grouped under the far more frequent form.

Method.  The vocabulary is dealt into blocks in which all words share a prefix
and a suffix, cut from the ends by halves: one edit leaves the first or the second half of
the rest unchanged, so a pair of near words meets in the block of that half, and
an oversized block is halved again, until at most one letter of the rest is free
(such blocks are bounded by the alphabet).  Inside a block the rest of each word
is matched against the sorted list: the banded edit matrix (three cells a row)
keeps its rows for as many letters as the next entry shares with the one before
(adjacent LCP), and once a row exceeds one edit, all entries that share that
prefix are skipped.  A pair is reported in one block only.

Counting runs where the text is scanned; only distinct (word, count) rows are
shuffled, so neither hot words nor long documents load one task.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import slices, stored, text_buffer

STEP_BYTES = 1 << 22
#: Entries above which a block is halved again.
BLOCK_WORDS = 64
#: Runs of more bytes are hashed one by one.
LONG_RUN = 64

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), 0xC3]] = True  # 0xC3 leads U+00C0 to U+00FF
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def runs_of(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start byte, end byte and text number of every maximal run of letters."""
    letter = _LETTER[buf]
    letter[1:] |= buf[:-1] == 0xC3
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    cut = off[(off > 0) & (off < len(buf))]
    first[cut] = letter[cut]
    last[cut - 1] = letter[cut - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(off, starts, "right") - 1


def crc32_of(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, state: np.ndarray) -> np.ndarray:
    """crc32 of each run, continued from ``state``, byte by byte for all runs at
    once (long runs one by one)."""
    out = state.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    width = ends - starts
    order = np.argsort(-width, kind="stable")
    short = order[np.searchsorted(-width[order], -LONG_RUN):]
    for j in range(int(width[short[0]]) if len(short) else 0):
        short = short[:np.searchsorted(-width[short], -j)]  # longer than j
        out[short] = _CRC[(out[short] ^ buf[starts[short] + j]) & np.uint32(255)] ^ (out[short] >> np.uint32(8))
    out ^= np.uint32(0xFFFFFFFF)
    for i in order[:len(order) - np.count_nonzero(width <= LONG_RUN)]:
        out[i] = zlib.crc32(buf[starts[i]:ends[i]].tobytes(), int(state[i]))
    return out


def words_of(buf: np.ndarray, off: np.ndarray, prefixes: list[bytes], min_chars: int, one_in: int) -> pa.Array:
    """The words of concatenated texts, repeats included: lower-cased (A-Z) runs
    of at least ``min_chars`` code points, after the deletion of one code point from
    each run whose crc32 after its text's prefix is divisible by ``one_in``."""
    empty = pa.array([], pa.large_string())
    if not len(buf):
        return empty
    buf = _LOWER[buf]
    starts, ends, text = runs_of(buf, off)
    chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    keep = chars[ends] - chars[starts] >= min_chars
    starts, ends, text = starts[keep], ends[keep], text[keep]
    if not len(starts):
        return empty
    crc = crc32_of(buf, starts, ends, np.array([zlib.crc32(p) for p in prefixes], np.uint32)[text])
    cut = crc % one_in == 0
    damaged = []
    for a, b, h in zip(starts[cut], ends[cut], crc[cut], strict=True):
        w = buf[a:b].tobytes().decode()
        at = int(h) % len(w)
        if len(w) > min_chars:
            damaged.append(w[:at] + w[at + 1:])
    starts, width = starts[~cut], (ends - starts)[~cut]
    inside = np.repeat(starts - (np.cumsum(width) - width), width) + np.arange(width.sum())
    whole = pa.Array.from_buffers(pa.large_string(), len(width), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(width)])), pa.py_buffer(buf[inside])])
    return pa.concat_arrays([whole, pa.array(damaged, pa.large_string())])


def vocabulary(docs: DataFrame, min_chars: int = 6, min_count: int = 5, one_in: int = 199, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the words of all whole texts with at least ``min_count``
    occurrences.  A null text has none; a null id is hashed as empty text."""

    def run(batches):
        for rows in batches:
            ids = [b"%d:" % i if i is not None else b":" for i in rows.column(0).to_pylist()]
            whole, off = text_buffer(rows.column(1).fill_null(""))
            for a, b in slices(off, STEP_BYTES):
                counted = pc.value_counts(words_of(whole[off[a]:off[b]], off[a:b + 1] - off[a], ids[a:b], min_chars, one_in))
                yield pa.RecordBatch.from_arrays([counted.field(0).cast(pa.string()), counted.field(1).cast(pa.int64())], names=["word", "n"])

    found = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def one_edit_scan(queries: list[str], entries: list[str]) -> Iterator[tuple[str, str]]:
    """(query, entry) for all entries exactly one edit from a query; ``entries``
    sorted, without repeats."""
    lcp = [0] + [len(commonprefix(p)) for p in zip(entries, entries[1:], strict=False)]
    n = len(entries)
    for q in queries:
        m = len(q)
        rows = [(2, 0, 1 if m else 2)]  # rows[d]: edits from an entry's first d letters to q's first d - 1, d and d + 1
        j = 0
        while j < n:
            e = entries[j]
            del rows[lcp[j] + 1:]
            d = len(rows) - 1
            x, y, z = rows[d]
            while d < len(e):
                c = e[d]
                left = min(x + (c != q[d - 1]) if d else 2, y + 1) if d <= m else 2
                mid = min(y + (c != q[d]), z + 1, left + 1) if d < m else 2
                right = min(z + (c != q[d + 1]), mid + 1) if d + 1 < m else 2
                d += 1
                if left > 1 and mid > 1 and right > 1:
                    # skip every entry with these d letters; rows stay those of the letters before
                    j = j + 1 if j + 1 == n or lcp[j + 1] < d else bisect_left(entries, e[:d] + "\U0010ffff", j + 1)
                    break
                x, y, z = left, mid, right
                rows.append((x, y, z))
            else:
                if -1 <= m - d <= 1 and (x, y, z)[m - d + 1] == 1:
                    yield q, e
                j += 1


def _pairs(block: list[tuple]) -> Iterator[tuple[str, str, int]]:
    """(word, near word, its n) of one block of rows (key, word, n, m, a, z, path),
    without the pairs that an earlier half's block reports."""
    if len(block) < 2:
        return
    _, _, _, m, a, z, path = block[0]
    second, i, j = [], 0, 0
    for half in path:  # the first halves that pairs of this block must differ in
        cut = (m - i - j) // 2
        if half == "p":
            i += cut
        else:
            second.append((i, i + cut))
            j += m - i - j - cut
    rest = {r[1][a:len(r[1]) - z]: r[1:3] for r in block}
    entries = sorted(rest)
    for q, e in one_edit_scan([x for x in entries if len(x) == m - a - z], entries):
        (word, n), (other, other_n) = rest[q], rest[e]
        if any(word[i:j] == other[i:j] for i, j in second):
            continue
        yield word, other, other_n
        if len(e) > len(q):
            yield other, word, n


def _halved(members):
    """Members of the blocks of both halves of the free letters."""
    r = "(m - a - z)"
    return members.select("word", "n", "m", F.explode(F.array(
        F.expr(f"struct(a + {r} div 2 AS a, z AS z, concat(path, 'p') AS path)"),
        F.expr(f"struct(a AS a, z + {r} - {r} div 2 AS z, concat(path, 's') AS path)"))).alias("b")).select(
        F.expr("concat_ws(' ', m, b.path, left(word, cast(b.a as int)), right(word, cast(b.z as int)))").alias("key"), "word", "n", "m", "b.a", "b.z", "b.path")


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, near, near_n: every ordered pair of (word, n) rows exactly one edit
    apart, once."""
    # m: the shorter word's length; a word is the shorter (or equal) one of a pair, or the longer
    level = words.select("word", "n", F.explode(F.expr("array(1L * length(word), length(word) - 1L)")).alias("m"),
                         F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("z"), F.lit("").alias("path")).where("m > 0")
    ready = None
    while True:  # about log2 of the longest word's letters
        level = stored(_halved(level), "blocks")
        sizes = level.groupBy("key", "m", "a", "z").agg(F.count(F.lit(1)).alias("words"), F.count_if(F.length("word") == F.col("m")).alias("short"))
        sizes = stored(sizes.where("words > 1 and short > 0").select("key", (F.expr("m - a - z < 2") | (F.col("words") <= block_words)).alias("done")), "block-sizes")
        sized = level.join(sizes, "key")
        done = sized.where("done").drop("done")
        ready = done if ready is None else ready.union(done)
        if sizes.where("not done").isEmpty():
            break
        level = sized.where("not done").drop("done")

    def run(batches):
        block, key = [], None
        for rows in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                if row[0] != key:
                    out += _pairs(block)
                    block, key = [], row[0]
                block.append(row)
            yield _batch(out)
        yield _batch(list(_pairs(block)))

    return ready.repartition("key").sortWithinPartitions("key").mapInArrow(run, "word string, near string, near_n long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    word, near, n = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(n, pa.int64())], names=["word", "near", "near_n"])


def _roots(links: DataFrame) -> DataFrame:
    """word, root from word, form: forms followed to the last.  Counts grow along
    forms, so there are no circles; each round doubles the steps taken."""
    links = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = links.select(F.col("word").alias("at"), F.col("root").alias("next"))
        if links.join(on, F.col("root") == F.col("at"), "left_semi").isEmpty():
            return links
        links = stored(links.join(on, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def variants(docs: DataFrame, min_chars: int = 6, min_count: int = 5, ratio: int = 5, one_in: int = 199,
             id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased,
    one code point deleted from one run in ``one_in``, of at least ``min_chars`` code
    points and ``min_count`` occurrences.  form: the most frequent near word (ties:
    the smallest in code-point order) if it occurs at least ``ratio`` times as
    often, else null.  root: the last of the forms followed from the word, itself
    without a form.  Null texts have no words, a null id is hashed as empty text,
    repeated rows count each time, an empty table has no words.
    """
    words = stored(vocabulary(docs, min_chars, min_count, one_in, id_col, text_col), "vocabulary")
    near = near_words(words, block_words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    formed = words.join(near, "word", "left").withColumn("has", F.coalesce(-F.col("best.less") >= ratio * F.col("n"), F.lit(False)))
    formed = stored(formed.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("has"), F.col("best.near")).alias("form"),
                                  F.when(F.col("has"), -F.col("best.less")).alias("form_n")), "forms")
    rooted = formed.join(_roots(formed.where("form is not null")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
