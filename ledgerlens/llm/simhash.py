"""SimHash near-duplicates with bit-sliced comparison.

Method.  Every document gets a 64-bit SimHash of its word shingles.  Equal
fingerprints form a class; only classes are compared.  Of two fingerprints at
most r bits apart one of r + 1 disjoint bit pieces is equal, so candidates share
a piece (or the part of it that makes blocks of a useful size).  A block whose
members are too many is divided again by the same rule over its remaining bits,
and what is still too large is compared tile by tile; nothing is capped.

Inside a block the fingerprints are stored vertically: plane b holds bit b of
all members, packed.  Against a plane many queries' distances advance at once in
carry-save counters (bitwise adders with a sticky overflow); once every distance
of a group of rows is over the radius the remaining planes are skipped.  A block
returns a spanning star per connected set, never all its pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import shield, slices, small_side, stored, text_buffer, word_spans
from ledgerlens.llm.components import connected_components

#: Mean members of a first-level block, and the most that one task compares at once.
BLOCK_MEAN, BLOCK_MOST = 512, 4096
#: Bytes of text that one numpy step takes.
STEP_BYTES = 1 << 20


# -- fingerprints ---------------------------------------------------------
def _fingerprints(buf: np.ndarray, off: np.ndarray, shingle: int) -> np.ndarray:
    """SimHash of each of the concatenated texts."""
    import xxhash

    upper = (buf >= 65) & (buf <= 90)
    low = np.where(upper, buf + 32, buf).astype(np.uint8)
    starts, ends, first = word_spans(low, off)
    out = np.zeros(len(off) - 1, np.uint64)
    if not len(starts):
        return out
    # one space between words: keep each word and the white byte before it
    keep = np.zeros(len(low) + 1, np.int32)
    np.add.at(keep, starts, 1)
    np.add.at(keep, ends, -1)
    keep = np.cumsum(keep[:-1]) > 0
    lead = np.ones(len(starts), bool)
    lead[first[:-1][first[:-1] < len(starts)]] = False
    keep[starts[lead] - 1] = True
    low[starts[lead] - 1] = 32
    place = np.cumsum(keep) - 1
    s, e = place[starts], place[ends - 1] + 1
    text = low[keep].tobytes()
    n_words = np.diff(first)
    n = np.where(n_words >= shingle, n_words - shingle + 1, n_words > 0)
    at = np.concatenate([[0], np.cumsum(n)])
    begin = np.repeat(first[:-1] - at[:-1], n) + np.arange(at[-1])
    last = begin + np.repeat(np.minimum(n_words, shingle), n) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[i:j], 42) for i, j in zip(s[begin].tolist(), e[last].tolist(), strict=True)), np.uint64, int(at[-1]))
    some = np.flatnonzero(n)
    ones = np.zeros((len(some), 64), np.int64)
    for a, b in slices(at[np.concatenate([some, [len(n)]])], 1 << 17):  # a longer text is a step of its own
        lo, hi = at[some[a]], at[some[b - 1] + 1]
        for c in range(lo, hi, 1 << 18):
            part = hashes[c:min(hi, c + (1 << 18))]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            cuts = np.clip(at[some[a:b]] - c, 0, len(part))
            live = np.flatnonzero(np.diff(np.append(cuts, len(part))))
            ones[a + live] += np.add.reduceat(bits, cuts[live], axis=0, dtype=np.int64)
    out[some] = np.ascontiguousarray(np.packbits(2 * ones > n[some][:, None], axis=1, bitorder="little")).view(np.uint64).ravel()
    return out


def with_fingerprint(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key (xxhash64 of the text) and fp (the fingerprint's bits as a
    long) of each row; texts without words, and null, have fingerprint 0."""

    def run(batches):
        for rows in batches:
            whole, off = text_buffer(rows.column(2).fill_null(""))
            fp = [_fingerprints(whole[off[a]:off[b]], off[a:b + 1] - off[a], shingle) for a, b in slices(off, STEP_BYTES)]
            fp = np.concatenate(fp) if fp else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(fp.view(np.int64))], names=["doc_id", "key", "fp"])

    return docs.select(F.col(id_col).cast("long"), F.xxhash64(text_col), F.col(text_col)).mapInArrow(run, "doc_id long, key long, fp long")


# -- bit-sliced comparison ------------------------------------------------
def _planes(fps: np.ndarray) -> np.ndarray:
    """(64, words) packed bit planes; lane j of a plane is member j's bit."""
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    pad = -bits.shape[1] % 64
    return np.ascontiguousarray(np.packbits(np.pad(bits, ((0, 0), (0, pad))), axis=1, bitorder="little")).view(np.uint64)


def near_pairs(queries: np.ndarray, planes: np.ndarray, members: int, radius: int, after: np.ndarray | None):
    """Yield (query rows, member columns) of all pairs at most ``radius`` bits
    apart.  ``after``: only members of a larger index than the query's."""
    width, depth = planes.shape[1], radius.bit_length()
    spare = (1 << depth) - 1 - radius  # counters start here and overflow beyond the radius
    for a in range(0, len(queries), 256):
        q = queries[a:a + 256]
        lanes = np.arange(width * 64)
        shut = np.broadcast_to(lanes >= members, (len(q), width * 64))
        if after is not None:
            shut = shut | (lanes[None, :] <= after[a:a + 256][:, None])
        over = np.ascontiguousarray(np.packbits(shut, axis=1, bitorder="little")).view(np.uint64)
        rows, cols = np.arange(len(q)), np.arange(width)
        digits = [np.full(over.shape, ~np.uint64(0) if spare >> k & 1 else np.uint64(0)) for k in range(depth)]
        for b in range(64):
            ones = (np.uint64(0) - ((q[rows] >> np.uint64(b)) & np.uint64(1)))[:, None]
            carry = planes[b][None, cols] ^ ones
            for k in range(depth):
                digits[k], carry = digits[k] ^ carry, digits[k] & carry
            over |= carry
            if b % 8 == 7 and b < 63:
                open_ = over != ~np.uint64(0)
                r, c = np.flatnonzero(open_.any(1)), np.flatnonzero(open_.any(0))
                if not len(r):
                    rows = rows[:0]
                    break
                if len(r) * len(c) * 2 < over.size:
                    over, rows, cols = over[np.ix_(r, c)], rows[r], cols[c]
                    digits = [d[np.ix_(r, c)] for d in digits]
        if not len(rows):
            continue
        i, j = np.nonzero(np.unpackbits(np.ascontiguousarray(~over).view(np.uint8), axis=1, bitorder="little"))
        yield a + rows[i], cols[j // 64] * 64 + j % 64


def _star(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges (member, least member) of the links within ``left``, or
    between ``left`` and ``right``."""
    fps = left if right is None else np.concatenate([left, right])
    shift = 0 if right is None else len(left)
    root = np.arange(len(fps))
    other = left if right is None else right
    for i, j in near_pairs(left, _planes(other), len(other), radius, np.arange(len(left)) if right is None else None):
        j = j + shift
        while len(i):
            ri, rj = root[i], root[j]
            i, j, ri, rj = (x[ri != rj] for x in (i, j, ri, rj))
            if not len(i):
                break
            np.minimum.at(root, np.maximum(ri, rj), np.minimum(ri, rj))
            while (root[root] != root).any():
                root = root[root]
    tied = np.flatnonzero(root != np.arange(len(fps)))
    return fps[tied], fps[root[tied]]


def _compare(radius: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        fps = pdf.fp.to_numpy(np.int64).view(np.uint64)
        if len(key) < 5 or key[-1] == key[-2]:
            a, b = _star(fps, None, radius)
        else:
            own = pdf.tile.to_numpy() == key[-2]
            a, b = _star(fps[own], fps[~own], radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return run


def _pieces(bits: list[int], n: int) -> list[list[int]]:
    return [p.tolist() for p in np.array_split(np.array(bits, int), n) if len(p)]


def _take(fp, bits: list[int]):
    """A run of neighbouring bits of a fingerprint column, as a number."""
    return F.shiftrightunsigned(fp, bits[0]).bitwiseAND(F.lit((1 << len(bits)) - 1))


def _links(classes: DataFrame, n: int, radius: int, mean: int, most: int) -> DataFrame:
    """Spanning edges (a, b) of all links between distinct fingerprints."""
    fp = F.col("fp")
    wanted = max(1, min(64 // (radius + 1), int(n // mean).bit_length()))
    pieces = _pieces(list(range(64)), radius + 1)
    level1 = F.array(*[F.struct(F.lit(k).alias("piece"), _take(fp, p[:wanted]).alias("v")) for k, p in enumerate(pieces)])
    blocks = classes.select("fp", F.explode(level1).alias("k")).select("fp", "k.piece", "k.v")
    sizes = blocks.groupBy("piece", "v").agg(F.count(F.lit(1)).alias("n"))
    large = stored(sizes.where(F.col("n") > most), "large")
    edges = blocks.join(large, ["piece", "v"], "left_anti").groupBy("piece", "v").applyInPandas(_compare(radius), "a long, b long")
    if not large.head(1):
        return edges
    # too large: the whole piece must agree, and one of radius+1 pieces of the other bits
    def second(k):
        runs = _runs([b for b in range(64) if b not in pieces[k]], radius + 1)
        return [F.struct(F.lit(k).alias("piece"), _take(fp, pieces[k]).alias("v"), F.lit(i).alias("part"),
                         _joined(fp, r).alias("w")) for i, r in enumerate(runs)]

    at = F.when(F.lit(False), F.array(*second(0)))
    for k in range(len(pieces)):
        at = at.when(F.col("piece") == k, F.array(*second(k)))
    finer = blocks.join(large.select("piece", "v"), ["piece", "v"]).select("fp", F.explode(at).alias("k")).select("fp", "k.*")
    keys = ["piece", "v", "part", "w"]
    finer = stored(finer, "finer")
    counts = finer.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / most).cast("int")
    sized = finer.join(counts, keys).withColumn("tiles", tiles).withColumn(
        "tile", F.when(F.col("tiles") > 1, F.pmod(F.xxhash64("fp"), F.col("tiles"))).otherwise(F.lit(0)).cast("int"))
    dealt = sized.select(*keys, "fp", "tile", F.explode(F.expr("sequence(0, tiles - 1)")).alias("with"))
    dealt = dealt.select(*keys, "fp", "tile", F.least("tile", "with").alias("i"), F.greatest("tile", "with").alias("j"))
    return edges.union(dealt.groupBy(*keys, "i", "j").applyInPandas(_compare(radius), "a long, b long"))


def _runs(bits: list[int], n: int) -> list[list[list[int]]]:
    """``bits`` cut in ``n`` pieces, each as its runs of neighbouring bits."""
    out = []
    for piece in _pieces(bits, n):
        cut = [i for i in range(1, len(piece)) if piece[i] != piece[i - 1] + 1]
        out.append([piece[a:b] for a, b in zip([0, *cut], [*cut, len(piece)], strict=True)])
    return out


def _joined(fp, runs: list[list[int]]):
    value, width = None, 0
    for r in runs:
        part = F.shiftleft(_take(fp, r), width)
        value = part if value is None else value.bitwiseOR(part)
        width += len(r)
    return value


# -- operator -------------------------------------------------------------
def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text",
                    block_mean: int = BLOCK_MEAN, block_most: int = BLOCK_MOST) -> DataFrame:
    """One row per input row: doc_id, key (xxhash64 of the text), fp (long),
    component_id, root (one fingerprint of the component, its name).

    Fingerprints at most ``radius`` bits apart are linked; component_id is the
    smallest doc_id of the connected documents, itself included.  Rows with a
    null id take part, but null is never the smallest unless all are.  Repeated
    rows and ids stay as they are.  Texts without words and null texts have
    fingerprint 0 and are linked like any other.  Other columns are not read.
    """
    slim = stored(with_fingerprint(docs, shingle, id_col, text_col), "fingerprints")
    classes = stored(slim.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    n = classes.count()
    links = _links(classes.select("fp"), n, radius, block_mean, block_most)
    roots = connected_components(links)
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id", "root")
    return slim.join(named, "fp").select("doc_id", "key", "fp", "component_id", "root")


def keep_one_each(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each group: the one of the
    smallest (doc_id, text key), null ids last; of rows repeated whole, one.
    All columns pass through."""
    inner, (i, t), restore = shield(docs, id_col, text_col)
    found = stored(near_duplicates(inner, shingle, radius, i, t), "grouped")
    one = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")).alias("k")
    chosen = found.groupBy("root").agg(one).select("k.doc_id", "k.key")
    rows = found.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n"))
    same = F.col("r.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("r.key") == F.col("c.key"))
    losers = stored(rows.alias("r").join(chosen.alias("c"), same, "left_anti").select(F.col("doc_id").alias("row_id"), F.col("key").alias("row_key")), "losers")
    again = stored(rows.where("n > 1").select(F.col("doc_id").alias("row_id"), F.col("key").alias("row_key")), "repeated")
    this = F.col(i).cast("long").eqNullSafe(F.col("row_id")) & (F.xxhash64(t) == F.col("row_key"))
    kept = inner.join(small_side(losers, losers.count()), this, "left_anti")
    n_again = again.count()
    if n_again:
        once = kept.join(small_side(again, n_again), this, "left_anti")
        several = kept.join(small_side(again, n_again), this, "left_semi").withColumn("row_key", F.xxhash64(t))
        kept = once.union(several.dropDuplicates([i, "row_key"]).drop("row_key"))
    return kept.select(*restore)
