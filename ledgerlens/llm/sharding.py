"""Sharding by extendible hashing.

Method.  A document's bucket is named by the leading bits of its hash.  The
directory starts as one bucket; only a bucket over the byte limit splits, on its
next bit.  Since byte sums alone decide, a round adds the bytes up once by a
prefix a few bits longer than the corpus should need and rolls them up to all
shorter prefixes; a bucket is the shortest prefix that fits.  The directory has
one entry a bucket, under prefixes as long as the shortest bucket's.  Buckets still too large at that depth, and only
they, go through a further round with more bits.  Rows whose whole hash agrees
(rows repeated whole) cannot be split by bits; where they are over the limit
together they fill numbered overflow pages.  A single document over the limit is
a shard of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.common import shield, small_side, stored

#: Bits of the hash; those a round looks at beyond log2(bytes / limit); and those a further round adds.
HASH_BITS, SPARE_BITS, MORE_BITS = 60, 4, 12
_OWN = ("shard", "shard_bytes", "doc_bytes")


def document_hash(doc_id: Column, text: Column) -> Column:
    """60 leading bits of the MD5 of id and text, as a long."""
    key = F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(h: Column, bits: int) -> Column:
    return F.shiftright(h, HASH_BITS - bits)


def _rolled(sums: DataFrame, width: int, low: int, high: int) -> DataFrame:
    """bits, prefix, bytes, docs of the prefixes of ``low`` to ``high`` bits, from sums
    per prefix (p) of ``width`` bits."""
    each = sums.select("p", "bytes", "docs", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("bits"))
    each = each.withColumn("prefix", F.expr(f"shiftright(p, {width} - bits)"))
    return each.groupBy("bits", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))


def _round(sized: DataFrame, done: int, depth: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """Buckets (bits, prefix, bytes) of rows whose first ``done`` bits are known not
    to fit (0: nothing is known), and the prefixes (p) that do not fit at ``depth``
    bits either.  Prefixes are rolled up in two steps, the lower bits from the sums
    of the middle ones, so few rows meet every level."""
    sums = stored(sized.groupBy(_prefix(F.col("h"), depth).alias("p")).agg(
        F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("docs")), "sums")
    least, middle = (done + 1 if done else 0), max(done + 1, depth - SPARE_BITS - 2)
    nodes = stored(_rolled(sums, depth, middle, depth), "nodes")
    if middle > least:
        at = nodes.where(F.col("bits") == middle).select(F.col("prefix").alias("p"), "bytes", "docs")
        nodes = stored(nodes.unionByName(_rolled(at, middle, least, middle - 1)), "nodes")
    fits = (F.col("bytes") <= limit) | (F.col("docs") == 1)
    # a bucket is a fitting prefix whose parent does not fit (the shortest ones have none)
    parents = nodes.where(~fits).select((F.col("bits") + 1).alias("bits"), F.col("prefix").alias("parent"))
    fitting = nodes.where(fits).withColumn("parent", F.shiftright("prefix", 1))
    below = fitting.join(parents, ["bits", "parent"], "left_semi").select("bits", "prefix", "bytes")
    first = fitting.where(F.col("bits") == least).select("bits", "prefix", "bytes")
    buckets = stored(first.unionByName(below), "buckets")
    over = nodes.where(~fits & (F.col("bits") == depth)).select(F.col("prefix").alias("p"))
    return buckets, over


def _directory(buckets: DataFrame, k: int) -> tuple[DataFrame, int]:
    """p{k}: a prefix as short as the shortest bucket's; d{k}: the buckets under it;
    and the bits of p{k}.  One entry a bucket in all."""
    bits = buckets.agg(F.min("bits")).first()[0] or 0
    rows = buckets.groupBy(F.expr(f"shiftright(prefix, bits - {bits})").alias(f"p{k}")).agg(
        F.collect_list(F.struct("bits", "prefix", "bytes")).alias(f"d{k}"))     # at most 2^(depth - bits) buckets
    return stored(rows, "directory"), bits


def assign_shards(docs: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with shard (the bucket's leading bits; ``root`` for none;
    ``<bits>+n`` on overflow page n), shard_bytes (UTF-8 bytes of its texts) and
    doc_bytes.

    A shard has at most ``limit`` bytes unless it is one document.  Null texts
    have no bytes and still get a shard.  Columns of ``docs`` with one of the
    three names are replaced, all others pass through; an empty table gives none.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in _OWN])
    inner, (i, t), restore = shield(docs, id_col, text_col)
    rows = inner.withColumn("doc_bytes", F.coalesce(F.octet_length(t), F.lit(0)).cast("long")).withColumn(
        "h", document_hash(F.col(i), F.col(t)))
    sized = stored(rows.select("h", F.col("doc_bytes").alias("bytes")), "sized")
    total = int(sized.agg(F.sum("bytes")).first()[0] or 0)
    done, depth = 0, min(HASH_BITS, (total // max(1, limit)).bit_length() + SPARE_BITS)
    placed = rows
    buckets: list[Column] = []
    while True:
        entries, over = _round(sized, done, depth, limit)
        k = len(buckets)
        named, bits = _directory(entries, k)
        placed = placed.withColumn(f"q{k}", _prefix(F.col("h"), bits)).join(
            small_side(named, named.count()), F.col(f"q{k}") == F.col(f"p{k}"), "left").withColumn(
            f"b{k}", F.expr(f"get(filter(d{k}, b -> shiftright(h, cast({HASH_BITS} - b.bits as int)) = b.prefix), 0)"))
        buckets.append(F.col(f"b{k}"))
        over = stored(over, "over")
        if not over.head(1):
            lone = None
            break
        sized = stored(sized.withColumn("p", _prefix(F.col("h"), depth)).join(over, "p", "left_semi").drop("p"), "open")
        if depth == HASH_BITS:
            lone = over
            break
        done, depth = depth, min(HASH_BITS, depth + MORE_BITS)
    b = F.coalesce(*buckets)
    bits = F.lpad(F.bin(b["prefix"]), HASH_BITS, "0")
    shard = F.when(b["bits"] == 0, F.lit("root")).otherwise(F.substring(bits, F.lit(HASH_BITS + 1) - b["bits"], b["bits"]))
    keep = [*restore, "doc_bytes", "shard", "shard_bytes"]
    out = placed.withColumn("shard", shard).withColumn("shard_bytes", b["bytes"])
    if lone is None:
        return out.select(*keep)
    return out.where(b.isNotNull()).select(*keep).union(_pages(rows, lone, limit).select(*keep))


def _pages(rows: DataFrame, lone: DataFrame, limit: int) -> DataFrame:
    """Overflow pages of rows whose equal hashes exceed the limit together.  The
    rows are written out with their partition, so that numbering them (a rank
    inside each partition plus the counts of earlier ones) is stable and no task
    holds more than a partition of a hash."""
    same = stored(rows.join(lone, F.col("h") == F.col("p"), "left_semi").withColumn("part", F.spark_partition_id())
                  .withColumn("row", F.monotonically_increasing_id()), "overflow")
    parts = same.groupBy("h", "part").agg(F.count(F.lit(1)).alias("n"), F.max("doc_bytes").alias("most"))
    before = Window.partitionBy("h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("h")
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn(
        "each", F.greatest(F.lit(1), F.floor(F.lit(limit) / F.max("most").over(whole)))).select("h", "part", "before", "each")
    rank = F.row_number().over(Window.partitionBy("h", "part").orderBy("row"))
    page = F.floor((F.col("before") + rank - 1) / F.col("each"))
    paged = same.join(parts, ["h", "part"]).withColumn(
        "shard", F.concat(F.lpad(F.bin("h"), HASH_BITS, "0"), F.lit("+"), page.cast("string")))
    sums = paged.groupBy("shard").agg(F.sum("doc_bytes").alias("shard_bytes"))
    return paged.join(sums, "shard")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard under ``path``."""
    sharded.repartition("shard").write.partitionBy("shard").parquet(path)
