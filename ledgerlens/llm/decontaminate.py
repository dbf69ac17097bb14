"""Benchmark decontamination by size-partitioned MinHash containment.

Method.  An item of q distinct five-word shingles leaks into a document that
contains at least ``containment`` of them.  Items are partitioned by size (powers
of two of q).  A partition's items are indexed by bottom-k MinHash sketches, with k
from the partition's largest size: as a leaking document may lack at most
q - ceil(containment * q) shingles, at least k minus that many of the sketch must
be in it.  Unlike a sketch of the (much longer) document, this bound holds at every
document size, so no leak is missed.  It also holds for any k shingles of the
item, so those that fewer items share (in powers of two) come first, by hash among
themselves: a phrase that all items share leads to no candidates.  Documents with
fewer shingles than an item needs are no candidates for it.

A document's shingle hashes, without its text, probe the sketch index where the
row is scanned; hits are counted per document and item.  Texts are read again
only of documents with a candidate, which are verified by exact containment of the
shingles themselves.  A text of fewer words than a shingle has one shingle, its
whole sequence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import WORD, shield, small_side, stored

#: Sketch entries beyond those that a leak may lack; more of them, fewer false candidates.
SPARE_HASHES = 2


def words(text: Column) -> Column:
    """Lower-case words; null: none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _runs(words_col: str, n: int, one, whole: Column, kind: str) -> Column:
    w = F.col(words_col)
    runs = F.transform(F.sequence(F.lit(0), F.size(w) - n), one)
    return F.when(F.size(w) >= n, runs).when(F.size(w) > 0, F.array(whole)).otherwise(F.array().cast(f"array<{kind}>"))


def shingle_hashes(words_col: str, n: int) -> Column:
    """Hash of every run of ``n`` words of an array column; of all words, if fewer."""
    w = F.col(words_col)
    return _runs(words_col, n, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(n)]), F.xxhash64(F.concat_ws(" ", w)), "bigint")


def shingles(words_col: str, n: int) -> Column:
    """The distinct runs of ``n`` words, space-joined; all words, if fewer."""
    w = F.col(words_col)
    return F.array_distinct(_runs(words_col, n, lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]), F.concat_ws(" ", w), "string"))


def item_sketches(items: DataFrame, containment: float, n: int, id_col: str, text_col: str) -> DataFrame:
    """item_no, item_id, item (its distinct shingles), q, least (shingles that a
    leak has), size_class, sketch (hashes) and hits (sketch hashes that a leak has).
    Writes the items."""
    base = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w"))
    base = base.select("item_id", shingles("w", n).alias("item"), F.array_distinct(shingle_hashes("w", n)).alias("hashes"))
    base = base.where(F.size("item") > 0).withColumn("q", F.size("item"))
    base = base.withColumn("least", F.ceil(F.col("q") * containment - 1e-9).cast("int"))
    base = base.withColumn("size_class", F.floor(F.log2("q") + 1e-9).cast("int"))
    base = stored(base.withColumn("item_no", F.monotonically_increasing_id()), "items")
    # how many items share a shingle, in powers of two
    each = base.select("item_no", F.explode("hashes").alias("h"))
    common = each.groupBy("h").agg(F.floor(F.log2(F.count(F.lit(1)))).cast("int").alias("shared"))
    order = each.join(common, "h").groupBy("item_no").agg(F.sort_array(F.collect_list(F.struct("shared", "h"))).alias("order"))   # an item's shingles
    largest = F.pow(F.lit(2.0), F.col("size_class") + 1) - 1
    k = (largest - F.ceil(largest * containment) + SPARE_HASHES + 1).cast("int")
    sketched = base.join(order, "item_no").withColumn("sketch", F.slice("order.h", F.lit(1), F.greatest(k, F.lit(1))))
    hits = F.greatest(F.lit(1), F.size("sketch") - (F.col("q") - F.col("least")))
    return sketched.withColumn("hits", hits).drop("hashes", "order")


def leaks(docs: DataFrame, items: DataFrame, containment: float = 0.8, n: int = 5, id_col: str = "doc_id", text_col: str = "text",
          item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per leak: doc_id, key (xxhash64 of the document's text), item_id,
    n_shared, n_item (distinct shingles), containment.

    Case does not matter.  An item of fewer than ``n`` words leaks into documents of
    exactly its words; a longer document has no shingle as short.  Texts without a
    word, null ones among them, have no shingles and never match.  Repeated
    documents (id and text) have one row per item, repeated items of one id count
    by their best row.  Other columns are not read.
    """
    index = stored(item_sketches(items, containment, n, item_id_col, item_text_col), "sketched")
    probes = index.select("item_no", "least", "hits", F.explode("sketch").alias("h")).groupBy("h").agg(
        F.min("least").alias("least"), F.collect_list(F.struct("item_no", "hits")).alias("at"))
    probes = stored(probes, "sketches")
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    hashed = base.withColumn("w", words(F.col("text"))).withColumn("hs", F.array_distinct(shingle_hashes("w", n))).select("doc_id", "key", "hs")
    # outer: for a plain explode Catalyst adds a non-empty filter and pushes the
    # whole shingle expression, words and all, into it
    probed = hashed.select("doc_id", "key", F.size("hs").alias("most"), F.explode_outer("hs").alias("h"))
    found = probed.join(small_side(probes, probes.count()), "h").where(F.col("most") >= F.col("least"))
    hit = found.select("doc_id", "key", F.explode("at").alias("at")).groupBy("doc_id", "key", "at.item_no").agg(
        F.count(F.lit(1)).alias("n_hits"), F.max("at.hits").alias("hits"))
    pairs = stored(hit.where("n_hits >= hits").select(F.col("doc_id").alias("hit_id"), F.col("key").alias("hit_key"), "item_no"), "candidates")
    wanted = stored(pairs.select("hit_id", "hit_key").distinct(), "candidate-docs")
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & F.col("key").eqNullSafe(F.col("hit_key"))
    texts = base.join(small_side(wanted, wanted.count()), same, "left_semi").groupBy("doc_id", "key").agg(F.first("text").alias("text"))
    texts = stored(texts.withColumn("w", words(F.col("text"))).select("doc_id", "key", shingles("w", n).alias("doc")), "candidate-shingles")
    known = index.select("item_no", "item_id", "item", "q", "least")
    both = pairs.join(texts, same).join(small_side(known, known.count(), 20_000), "item_no")
    exact = both.withColumn("n_shared", F.size(F.array_intersect("item", "doc"))).where(F.col("n_shared") >= F.col("least"))
    out = exact.groupBy("doc_id", "key", "item_id").agg(F.max(F.struct((F.col("n_shared") / F.col("q")).alias("c"), "n_shared", "q")).alias("m"))
    return out.select("doc_id", "key", "item_id", F.col("m.n_shared").cast("long").alias("n_shared"),
                      F.col("m.q").cast("long").alias("n_item"), F.col("m.c").alias("containment"))


def decontaminated(docs: DataFrame, items: DataFrame, containment: float = 0.8, n: int = 5, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a leak; all columns pass through."""
    inner, (i, t), restore = shield(docs, id_col, text_col)
    bad = leaks(inner, items, containment, n, i, t).select(F.col("doc_id").alias("bad_id"), F.col("key").alias("bad_key")).distinct()
    bad = stored(bad, "leaking")
    same = F.col(i).eqNullSafe(F.col("bad_id")) & (F.xxhash64(t) == F.col("bad_key"))
    return inner.join(small_side(bad, bad.count()), same, "left_anti").select(*restore)
