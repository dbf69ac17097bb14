"""Exact removal of repeated word windows.

Method.  Two rounds.  In the first, words get 64-bit hashes, every window of
``window`` consecutive words a Rabin-Karp hash of its word hashes.  Map tasks cut
their rows into batches and deal each batch's window hashes out by their leading
bits into buckets, as arrays (4 bytes a hash).  Spark shuffles the arrays by bucket,
explodes them there and counts each hash over all batches by a window aggregate,
whose sort spills; a bucket's hashes never meet in one Python group.  The positions
whose hash stands in several batches go back as bitmaps, one a batch and bucket, to
be added to those that the batch found in several of its own documents.  These are
only candidates: equal windows are always among them, and chance may add a few.

The second round goes over the candidates alone and takes a 128-bit BLAKE2b digest
of each one's words, which stands for the words themselves.  It deals in the same
way; Spark takes the smallest document of each digest, and the positions of larger
ones go back.  Per batch these merge into maximal removal intervals, and only the
intervals are joined back to the texts.

In both rounds a window seen in a smaller doc_id of its batch is settled at once
and only the smallest document's windows travel, so a passage that a third of all
documents share reaches its bucket once per batch.

The input must give the same rows in the same order whenever a task is run, as tables
do (each round runs its map side twice, and lost tasks again); otherwise write it out
first.  (The second round sorts its rows.)
"""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.common import mix64, slices, stored, text_buffer, word_spans

#: Bytes of text that one numpy step takes; a longer text is hashed in such pieces.
STEP_BYTES = 2 << 20
#: Windows that one bucket holds on average: small enough to deal buckets evenly over
#: tasks.  Nothing holds a bucket in memory, so a larger one is only a larger sort.
BUCKET_WINDOWS = 1 << 19
#: doc_id of null ids inside the blocks: after every other one.
NO_ID = np.iinfo(np.int64).max
#: Windows that a map task gathers per bucket before it deals them out, so that
#: arrays stay long where buckets are many; the most it gathers; and the most
#: leading bits.
BLOCK_WINDOWS, MOST_GATHERED, MOST_BITS = 64, 1 << 23, 18
#: Bytes of the second round's digest of a window.
DIGEST_BYTES = 16
#: Positions that one bitmap of Spark's covers.
BITMAP = 1 << 15

_BASE, _WORD_BASE = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+").findall


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Word and window hashes with cached tables of powers."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(_INVERSE, n)

    def words(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of each word's bytes, by differences of prefix hashes."""
        out = np.empty(len(starts), np.uint64)
        a = 0
        while a < len(starts):
            b = max(a + 1, int(np.searchsorted(ends, starts[a] + STEP_BYTES, "right")))
            lo, hi = starts[a], ends[b - 1]
            self._grow(hi - lo + 1)
            prefix = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(_BYTE[buf[lo:hi]] * self.up[:hi - lo], out=prefix[1:])
            s, e = starts[a:b] - lo, ends[a:b] - lo
            out[a:b] = mix64((prefix[e] - prefix[s]) * self.down[s] + (e - s).astype(np.uint64))
            a = b
        return out

    @staticmethod
    def windows(words: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Rabin-Karp hashes of all windows inside texts, and each text's first
        window index (one entry more than texts)."""
        n = np.maximum(np.diff(first) - window + 1, 0)
        at = np.concatenate([[0], np.cumsum(n)])
        if not at[-1]:
            return np.zeros(0, np.uint64), at
        roll = np.zeros(len(words) - window + 1, np.uint64)
        for j in range(window):
            roll = roll * _WORD_BASE + words[j:len(words) - window + 1 + j]
        inside = np.repeat(first[:-1] - at[:-1], n) + np.arange(at[-1])
        return mix64(roll[inside]), at


def _digests(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Digests, as two 64-bit numbers, of the windows that begin at words ``at``:
    of their words joined by one space, which no word holds."""
    words = [buf[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    line = b" ".join(words)
    last = np.cumsum(ends - starts + 1) - 1
    begin = last - (ends - starts)
    raw = b"".join([blake2b(line[a:b], digest_size=DIGEST_BYTES).digest()
                    for a, b in zip(begin[at].tolist(), last[at + window - 1].tolist(), strict=True)])
    return np.frombuffer(raw, np.uint64).reshape(-1, 2)


def _chosen(starts: pa.ListArray, ends: pa.ListArray, first: np.ndarray, total: int) -> np.ndarray:
    """Indexes of the windows inside the runs ``[starts, ends)`` of each text."""
    base = np.repeat(first, np.array(starts.value_lengths()))
    edge = np.zeros(total + 1, np.int32)
    np.add.at(edge, base + np.array(starts.flatten()), 1)
    np.add.at(edge, base + np.array(ends.flatten()), -1)
    return np.flatnonzero(np.cumsum(edge[:-1]))


def _groups(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal hashes side by side, and where a new one begins
    (hashes of one column, or of two)."""
    order = np.argsort(hashes, kind="stable") if hashes.ndim == 1 else np.lexsort((hashes[:, 1], hashes[:, 0]))
    ranked = hashes[order]
    new = ranked[1:] != ranked[:-1]
    return order, np.concatenate([[True], new if hashes.ndim == 1 else new.any(axis=1)])


def _pack(values: np.ndarray) -> bytes:
    """Non-decreasing integers as one-byte steps; longer steps apart, in 4 bytes
    or, if one needs it, 8."""
    step = np.diff(values, prepend=0)
    big = step >= 255
    apart = step[big].astype(np.uint64)
    wide = bool(len(apart)) and int(apart.max()) >= 1 << 32
    return np.uint32(len(values)).tobytes() + bytes([wide]) + np.where(big, 255, step).astype(np.uint8).tobytes() + (
        apart if wide else apart.astype(np.uint32)).tobytes()


def _unpack(blob: bytes, at: int = 0) -> np.ndarray:
    n, wide = int(np.frombuffer(blob, np.uint32, 1, at)[0]), blob[at + 4]
    step = np.frombuffer(blob, np.uint8, n, at + 5).astype(np.int64)
    big = step == 255
    if big.any():
        step[big] = np.frombuffer(blob, np.uint64 if wide else np.uint32, int(big.sum()), at + 5 + n).astype(np.int64)
    return np.cumsum(step)


def _spread(ids: np.ndarray) -> bytes:
    """Sorted document ids: the first and packed steps, or plain if far apart."""
    if int(ids[-1]) - int(ids[0]) < 1 << 62:
        return b"s" + ids[:1].tobytes() + _pack(ids - ids[0])
    return b"p" + ids.tobytes()


def _gather(blob: bytes) -> np.ndarray:
    if blob[:1] == b"p":
        return np.frombuffer(blob, np.int64, offset=1)
    return _unpack(blob, 9) + np.frombuffer(blob, np.int64, 1, 1)[0]


#: What a batch keeps for itself: document ids, windows of each (summed up), text hashes,
#: flags of the windows that it settled and of those it dealt out, the buckets of these
#: and, in the second round, the places of its windows.
HOME = ["ids", "windows", "keys", "settled", "out", "dealt", "place"]
HOME_TYPE = f"batch long, {', '.join(f'{c} binary' for c in HOME)}"
#: Arrays of a bucket's row: the low half of a window hash; the halves of a digest and the document.
COUNTED, SURE = ["h"], ["h", "g", "d"]


def _block_type(sure: bool) -> str:
    return "bucket int, batch long, " + ("h array<bigint>, g array<bigint>, d array<bigint>" if sure else "h array<int>")


def _blocks(window: int, bits: int, home: bool):
    """Map side: the arrays, or the ``home`` rows, of a partition's batches, of all
    windows or, in the second round, of the runs of candidates in columns 3 and 4.
    Home rows go straight to their batch, so they are made in a pass of their own."""

    def run(batches):
        from pyspark import TaskContext

        hasher, serial = Hasher(), TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        for rows in batches:
            ids, keys = np.array(rows.column(0).fill_null(int(NO_ID))), np.array(rows.column(1))
            whole, off = text_buffer(rows.column(2).fill_null(""))
            for a, b in slices(off, STEP_BYTES):
                buf = whole[off[a]:off[b]]
                starts, ends, first = word_spans(buf, off[a:b + 1] - off[a])
                if rows.num_columns == 3:
                    hashes, at = hasher.windows(hasher.words(buf, starts, ends), first, window)
                    chosen, place = np.diff(at), np.zeros(0, np.int64)
                else:
                    at = np.concatenate([[0], np.cumsum(np.maximum(np.diff(first) - window + 1, 0))])
                    place = _chosen(rows.column(3)[a:b], rows.column(4)[a:b], at[:-1], int(at[-1]))
                    chosen = np.diff(np.searchsorted(place, at))
                    place -= np.repeat(at[:-1], chosen)
                    hashes = _digests(buf, starts, ends, np.repeat(first[:-1], chosen) + place, window)
                if len(hashes):
                    held.append((ids[a:b], keys[a:b], np.diff(at), chosen, place, hashes))
                if sum(len(x[-1]) for x in held) >= min(BLOCK_WINDOWS << bits, MOST_GATHERED):
                    serial += 1
                    yield from _deal(serial, held, bits, home)
                    held = []
        if held:
            yield from _deal(serial + 1, held, bits, home)

    return run


def _deal(serial: int, held: list[tuple], bits: int, home: bool):
    """One batch: its texts in order of id with what it settles itself (``home``),
    or an array of window hashes for every bucket.  Held are id, key, windows and chosen
    windows of each text, and of each chosen one its place in the text (second
    round) and hash."""
    ids, keys, n, chosen, place, hashes = (np.concatenate(x) for x in zip(*held, strict=True))
    sure = hashes.ndim == 2
    order = np.argsort(ids, kind="stable")
    begin = np.cumsum(chosen) - chosen
    ids, keys, n, chosen, begin = ids[order], keys[order], n[order], chosen[order], begin[order]
    at, to = np.cumsum(n), np.cumsum(chosen)
    moved = np.repeat(begin - (to - chosen), chosen) + np.arange(len(hashes))
    hashes = hashes[moved]
    texts = np.repeat(np.arange(len(ids)), chosen)
    by_hash, new = _groups(hashes)
    edges, group, doc = np.flatnonzero(new), np.cumsum(new) - 1, ids[texts[by_hash]]
    later = np.empty(len(hashes), bool)
    later[by_hash] = doc > doc[edges][group]
    found = later
    if not sure:  # the smallest document's too: the second round needs it
        found = np.empty(len(hashes), bool)
        found[by_hash] = (np.maximum.reduceat(doc, edges) > doc[edges])[group]
    rest = np.flatnonzero(~later)
    bucket = ((hashes[:, 0] if sure else hashes)[rest] >> np.uint64(64 - bits)).astype(_bucket_type(bits))
    if home:
        kept = [_spread(ids), _pack(at), keys.tobytes(), np.packbits(found).tobytes(), np.packbits(~later).tobytes(),
                bucket.tobytes(), _pack(place[moved] + np.repeat(at - n, chosen)) if sure else None]
        yield pa.RecordBatch.from_arrays([pa.array([serial], pa.int64()), *[pa.array([x], pa.binary()) for x in kept]], names=["batch", *HOME])
        return
    order = np.argsort(bucket, kind="stable")
    dealt, bucket_of = rest[order], bucket[order]
    if sure:
        arrays = [hashes[dealt, 0].view(np.int64), hashes[dealt, 1].view(np.int64), ids[texts[dealt]]]
    else:
        arrays = [hashes[dealt].astype(np.uint32).view(np.int32)]
    begin = np.flatnonzero(np.concatenate([[True], bucket_of[1:] != bucket_of[:-1]])) if len(dealt) else np.zeros(0, np.int64)
    ends = np.append(begin, len(dealt))
    for i in range(0, len(begin), 512):
        cut = ends[i:i + 513]
        off = pa.array(cut - cut[0], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket_of[cut[:-1]].astype(np.int32)), pa.array(np.full(len(cut) - 1, serial, np.int64)),
             *[pa.ListArray.from_arrays(off, pa.array(x[cut[0]:cut[-1]])) for x in arrays]],
            names=["bucket", "batch", *(SURE if sure else COUNTED)])


def _bucket_type(bits: int) -> type:
    return np.uint8 if bits <= 8 else np.uint16 if bits <= 16 else np.uint32


def _counted(blocks: DataFrame, sure: bool, bits: int) -> DataFrame:
    """batch, bucket, part, hits: for each batch and bucket a bitmap of the positions
    in its array (BITMAP positions a part) whose hash stands in another batch as well
    or, if ``sure``, in a smaller document.

    One shuffle, by bucket, which deals the buckets out in turn; the aggregate over
    equal hashes, and the bitmaps, keep to its partitions."""
    names = SURE if sure else COUNTED
    parts = min(1 << bits, int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = blocks.repartitionById(parts, F.col("bucket"))
    each = dealt.select("bucket", "batch", F.posexplode(F.arrays_zip(*names)).alias("spot", "x"))
    each = each.select("bucket", "batch", "spot", *[F.col(f"x.{c}").alias(c) for c in names])
    same = Window.partitionBy(*[c for c in names if c != "d"], "bucket")
    if sure:
        again = each.withColumn("least", F.min("d").over(same)).where("d > least")
    else:
        again = each.withColumn("lo", F.min("batch").over(same)).withColumn("hi", F.max("batch").over(same)).where("lo < hi")
    part, at = F.floor(F.col("spot") / BITMAP).alias("part"), F.pmod(F.col("spot"), F.lit(BITMAP)).cast("long").alias("at")
    told = again.select("batch", "bucket", part, at).groupBy("batch", "bucket", "part").agg(
        F.bitmap_construct_agg("at").alias("hits"), F.max("at").alias("last"))
    return told.select("batch", "bucket", "part", F.substring("hits", F.lit(1), (F.floor(F.col("last") / 8) + 1).cast("int")).alias("hits"))


def _flagged(home, rows: pd.DataFrame, total: int, bits: int) -> np.ndarray:
    """The batch's windows that it settled itself or whose bitmaps came back."""
    flag = np.unpackbits(np.frombuffer(home.settled, np.uint8), count=total).astype(bool)
    rest = np.flatnonzero(np.unpackbits(np.frombuffer(home.out, np.uint8), count=total))
    bucket = np.frombuffer(home.dealt, _bucket_type(bits))
    order = np.argsort(bucket, kind="stable")
    begin = np.searchsorted(bucket[order], rows.bucket.to_numpy())
    for at, part, bits_of in zip(begin.tolist(), rows.part.astype(int).tolist(), rows.hits, strict=True):
        hit = np.flatnonzero(np.unpackbits(np.frombuffer(bits_of, np.uint8), bitorder="little"))
        flag[rest[order[at + part * BITMAP + hit]]] = True
    return np.flatnonzero(flag)


def _intervals(window: int, bits: int):
    """One batch: flagged windows to maximal word intervals of each text (for a
    ``window`` of 1 the runs of flagged windows)."""

    def run(homes: pd.DataFrame, hits: pd.DataFrame) -> pd.DataFrame:
        home = homes.iloc[0]
        ids, at = _gather(home.ids), np.concatenate([[0], _unpack(home.windows)])
        keys = np.frombuffer(home["keys"], np.int64, len(ids))
        place = None if home.place is None else _unpack(home.place)
        flagged = _flagged(home, hits, int(at[-1]) if place is None else len(place), bits)
        if not len(flagged):
            return pd.DataFrame([], columns=["doc_id", "key", "starts", "ends"], dtype=object)
        if place is not None:  # of the second round
            flagged = place[flagged]
        text = np.searchsorted(at, flagged, "right") - 1
        new = np.flatnonzero(np.concatenate([[True], (np.diff(flagged) > window) | (np.diff(text) != 0)]))
        last = np.concatenate([new[1:], [len(flagged)]]) - 1
        owner = text[new]
        starts, ends = flagged[new] - at[owner], flagged[last] - at[owner] + window
        cut = np.flatnonzero(np.concatenate([[True], np.diff(owner) != 0]))
        who = owner[cut]
        return pd.DataFrame({"doc_id": [None if i == NO_ID else int(i) for i in ids[who]], "key": keys[who],
                             "starts": np.split(starts.astype(np.int32), cut[1:]), "ends": np.split(ends.astype(np.int32), cut[1:])}
                            ).astype({"doc_id": "Int64"})

    return run


def removal_intervals(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Maximal word intervals ``[starts[i], ends[i])`` to remove, per document
    that has any: doc_id, key (xxhash64 of the text), starts, ends.

    A word goes if some window covering it also starts in a document with a
    smaller id.  Null ids count as larger than all others and as one id; rows of
    one id never remove each other's words; null and empty texts, and texts
    shorter than a window, have no windows.  Repeated rows of the same id and
    text have one entry.
    """
    slim = _slim(docs, id_col, text_col)
    n_bytes = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(MOST_BITS, max(6, int(n_bytes // 6 // BUCKET_WINDOWS).bit_length()))
    maybe = stored(_round(slim, window, bits, sure=False), "candidates")
    # the texts are dealt out as in remove_repeated_windows, which takes the same exchange again
    both = _with_intervals(slim, maybe, "inner").select("d.doc_id", "d.key", "d.text", "f.starts", "f.ends")
    return _round(both.sortWithinPartitions("doc_id", "key"), window, bits, sure=True)


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))


def _with_intervals(slim: DataFrame, found: DataFrame, how: str) -> DataFrame:
    return slim.alias("d").join(found.alias("f").hint("shuffle_hash"),
                                F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.key") == F.col("f.key")), how)


def _round(rows: DataFrame, window: int, bits: int, sure: bool) -> DataFrame:
    """doc_id, key, starts, ends: the runs of candidate windows or, if ``sure``,
    the intervals of words to remove."""
    homes = rows.mapInArrow(_blocks(window, bits, True), HOME_TYPE)
    back = _counted(rows.mapInArrow(_blocks(window, bits, False), _block_type(sure)), sure, bits)
    found = homes.groupBy("batch").cogroup(back.groupBy("batch")).applyInPandas(
        _intervals(window if sure else 1, bits), "doc_id long, key long, starts array<int>, ends array<int>")
    if sure:
        return found.groupBy("doc_id", "key").agg(F.first("starts").alias("starts"), F.first("ends").alias("ends"))
    # repeated rows can have other candidates in each batch, which count together
    runs = found.groupBy("doc_id", "key").agg(F.collect_set(F.struct("starts", "ends")).alias("r"))
    return runs.select("doc_id", "key", F.flatten("r.starts").alias("starts"), F.flatten("r.ends").alias("ends"))


def remove_repeated_windows(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, removed (array of
    start/end word intervals, end exclusive) and kept_text (kept words joined by
    one space; empty for null texts).  Rules as in ``removal_intervals``; other
    columns of ``docs`` are not read, so their names cannot clash.
    """
    found = removal_intervals(docs, window, id_col, text_col)

    @F.pandas_udf("n_words long, n_removed long, kept_text string")
    def cut(text: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        rows = []
        for t, s, e in zip(text, starts, ends, strict=True):
            words = _WORDS(t.encode("utf-8", "surrogatepass")) if t is not None else []
            n = len(words)
            if s is not None:
                kept, at = [], 0
                for a, b in zip(s, e, strict=True):
                    kept += words[at:a]
                    at = b
                words = kept + words[at:]
            rows.append((n, n - len(words), b" ".join(words).decode("utf-8", "replace")))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_text"])

    both = _with_intervals(_slim(docs, id_col, text_col), found, "left")
    out = both.select(F.col("d.doc_id").alias("doc_id"), F.arrays_zip(F.col("f.starts").alias("start"), F.col("f.ends").alias("end")).alias("removed"),
                      cut(F.col("d.text"), F.col("f.starts"), F.col("f.ends")).alias("c"))
    return out.select("doc_id", "c.n_words", "c.n_removed", F.coalesce("removed", F.array().cast("array<struct<start:int,end:int>>")).alias("removed"), "c.kept_text")
