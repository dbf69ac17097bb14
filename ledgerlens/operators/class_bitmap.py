"""Class lookup by a bitmap: two bits an id instead of a row an id.

A page covers 256 neighbouring ids in eight longs, so a table of dense ids shrinks
from some 50 bytes an id (a broadcast row) to half a byte, and the lookup of large
edge lists becomes a broadcast join of pages and a shift: no edge is shuffled.
The page table is written and its size in memory is checked before it may be
broadcast; beyond the limit, and for classes a bitmap can not hold, callers keep
the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import stored

#: Bytes of a page in a broadcast hash table: key, eight longs, row and map overhead.
PAGE_BYTES = 144
#: Largest page table that may be broadcast, in bytes.
BITMAP_BYTES = 256 << 20

_WORDS = 8
_ODD_BITS = 0x5555555555555555


def class_bitmap(classes: DataFrame, id_col: str = "txId", class_col: str = "class", limit: int = BITMAP_BYTES) -> DataFrame | None:
    """_page, w0 to w7 of (id, class 1 to 3), or None where the join must serve:
    pages of more than ``limit`` bytes (sparse ids), other or null classes, or an id
    with two rows (a join repeats its edges).  Rows without an id are left out, as
    a join never meets them.  Runs two jobs when called."""
    i, code = F.col(id_col).cast("long"), F.col(class_col).cast("long")
    rows = classes.where(i.isNotNull()).select(i.alias("i"), code.alias("code"))
    bits = F.expr("shiftleft(code, cast(2 * (i & 31) as int))")
    pages = rows.groupBy(F.expr("shiftright(i, 8)").alias("_page")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.coalesce(F.col("code").between(1, 3), F.lit(False))).alias("fine"),
        *[F.bit_or(F.when(F.expr("shiftright(i, 5) & 7") == w, bits).otherwise(F.lit(0).cast("long"))).alias(f"w{w}") for w in range(_WORDS)])
    pages = stored(pages, "class-bitmap")
    held = sum((F.bit_count((F.col(f"w{w}").bitwiseOR(F.shiftrightunsigned(f"w{w}", 1))).bitwiseAND(F.lit(_ODD_BITS))) for w in range(_WORDS)), F.lit(0))
    n, rows_, fine, ids = pages.agg(F.count(F.lit(1)), F.sum("rows"), F.sum("fine"), F.sum(held)).first()
    if n * PAGE_BYTES > limit or rows_ != fine or rows_ != ids:
        return None
    return pages.drop("rows", "fine")


def classes_of(df: DataFrame, id_col: str, bitmap: DataFrame, name: str) -> DataFrame:
    """``df`` with the class (int, null for ids without one) of ``id_col`` as ``name``."""
    i = F.col(id_col).cast("long")
    hit = df.withColumn("_at", F.shiftright(i, 8)).join(F.broadcast(bitmap), F.col("_at") == F.col("_page"), "left")   # size checked
    word = F.lit(None).cast("long")
    for w in range(_WORDS):
        word = F.when(F.shiftright(i, 5).bitwiseAND(F.lit(7)) == w, F.col(f"w{w}")).otherwise(word)
    code = F.expr(f"shiftrightunsigned(_word, cast(2 * (cast(`{id_col}` as bigint) & 31) as int))").bitwiseAND(F.lit(3)).cast("int")
    return hit.withColumn("_word", word).select(*df.columns, F.when(code > 0, code).alias(name))
