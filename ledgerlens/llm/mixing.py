"""Mixing sources to target weights.

Method.  Sizes are added up per source (partial sums before the shuffle).  All
sizes together are shared out by weight; no source gets more than ``most`` times
its own size, and the excess is shared again by weight until none is above.
target / size is a source's repetition rate.  Every document is taken
floor(rate) times, and once more if a hash of it falls below the fraction; rows
with the same id and text are numbered, and the number is part of the hash, so
that each has a draw of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.common import WORD, lookup, shield, small_side, stored
from ledgerlens.operators.ordering import with_row_number


def text_size(text: Column) -> Column:
    """Number of words (long); null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, number: Column, seed: int) -> Column:
    """A number in [0, 1) from the id, the text and the row's number among rows that
    share both, the same on every run: 52 bits of an MD5."""
    key = F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), _digest(text),
                      F.when(number > 0, number.cast("string")))      # concat_ws leaves out nulls
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def numbered(docs: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """``docs`` with a column ``name``: the row's number, from 0, among the rows with
    its id and text, in the order of their other columns (nulls first; columns
    with maps do not count).  Rows alike in all of them are interchangeable.

    Only ids and digests are counted over all rows; rows that share both are
    numbered in range-sliced order, with a tie-breaker that splits groups of any size.
    """
    i, h = F.col(id_col), _digest(F.col(text_col))
    shared = docs.groupBy(i.alias("i__"), h.alias("h__")).agg(F.count(F.lit(1)).alias("n__")).where("n__ > 1").drop("n__")
    shared = stored(shared.withColumn("shared__", F.lit(True)), "shared")
    if shared.isEmpty():
        return docs.withColumn(name, F.lit(0).cast("long"))
    rows = docs.withColumn("h0__", h)
    same = F.col(id_col).eqNullSafe(F.col("i__")) & (F.col("h0__") == F.col("h__"))
    few = small_side(shared, shared.count())
    alone = rows.join(few.select("i__", "h__"), same, "left_anti").drop("h0__").withColumn(name, F.lit(0).cast("long"))
    again = stored(rows.join(few.select("i__", "h__"), same, "left_semi").withColumn("tie__", F.monotonically_increasing_id()), "repeated")
    others = [c for c, t in docs.dtypes if c not in (id_col, text_col) and "map<" not in t and "variant" not in t]
    ranked = stored(with_row_number(again, [id_col, "h0__", *others, "tie__"], "rn__"), "ranked")
    first = ranked.groupBy(F.col(id_col).alias("i__"), F.col("h0__").alias("h__")).agg(F.min("rn__").alias("first__"))
    first = stored(first.withColumn("key__", F.xxhash64("i__", "h__")), "firsts")
    hit = lookup(ranked.withColumn("key0__", F.xxhash64(id_col, "h0__")), first.select("key__", "i__", "h__", "first__"), "key0__", "key__", first.count(), ["rn__"])
    hit = hit.where(F.col(id_col).eqNullSafe(F.col("i__")) & (F.col("h0__") == F.col("h__")))
    return alone.unionByName(hit.select(*docs.columns, (F.col("rn__") - F.col("first__")).alias(name)))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """source, source_size, weight, target, rate of each source.

    ``sizes``: (source, size), one row per document.  Sources by code point,
    null last, get the weights in turn.  A source without any size has target 0
    and rate 0.  The table has a row per source and is small; only scalars reach
    the driver, once per round of resharing.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    per = stored(per.withColumn("weight", weight), "sources")
    cap = F.col("source_size") * most
    total = per.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        # what the uncapped sources share, given the sources that this level caps
        capped = cap <= F.col("weight") * F.lit(level)
        taken, share = per.agg(F.sum(F.when(capped, cap).otherwise(0)), F.sum(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        new = (total - taken) / share if share else level
        if new == level:
            break
        level = new
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(float(level)))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return per.withColumn("target", target).withColumn("rate", rate)


def mixed(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = 3, seed: int = 6, id_col: str = "doc_id",
          text_col: str = "text", source_col: str = "source", out: str = "mix") -> DataFrame:
    """``docs`` with a struct ``out`` (size, source_size, target, rate, copies);
    a column of that name is replaced, all others pass through.

    Rows with the same id and text have draws of their own.  Null texts have size 0; in a source without
    words nothing is taken.  An empty table gives none.
    """
    inner, (i, t, s), restore = shield(docs, id_col, text_col, source_col)
    inner = numbered(inner, i, t, "number__")
    size, u = text_size(F.col(t)), draw(F.col(i), F.col(t), F.col("number__"), seed)
    rates = stored(source_targets(inner.select(F.col(s).alias("source"), size.alias("size")), weights, most), "rates")
    both = lookup(inner, rates.select("source", "source_size", "target", "rate"), s, "source", rates.count(), [i, t])
    copies = (F.floor("rate") + (u < F.col("rate") - F.floor("rate")).cast("int")).cast("int")
    told = F.struct(size.alias("size"), "source_size", "target", "rate", copies.alias("copies")).alias(out)
    return both.select(*[c for c, name in zip(restore, docs.columns, strict=True) if name != out], told)


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: int = 3, seed: int = 6, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: each row of ``docs`` as many times as the mix takes it,
    with the columns of ``docs``."""
    inner, (i, t, s), restore = shield(docs, id_col, text_col, source_col)
    taken = mixed(inner, weights, most, seed, i, t, s).where("mix.copies > 0")
    return taken.withColumn("copy", F.explode(F.array_repeat(F.lit(True), F.col("mix.copies")))).select(*restore)
