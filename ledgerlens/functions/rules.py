"""Column expressions: label rules, safe arithmetic, histogram bins, hashing.

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.sources.schemas import ILLICIT, LICIT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def class_label(c) -> Column:
    """1 -> illicit, 2 -> licit, anything else (3, other codes, null) -> unknown."""
    c = _c(c)
    return (F.when(c == ILLICIT, F.lit("illicit"))
            .when(c == LICIT, F.lit("licit"))
            .otherwise(F.lit("unknown")))


def safe_div(num, den) -> Column:
    """num / den as double, 0 when den is 0 or null (ANSI mode safe)."""
    num, den = _c(num), _c(den)
    return F.when(den != 0, num.cast("double") / den).otherwise(F.lit(0.0))


def ratio(num, den, digits: int) -> Column:
    """Rounded num / den; null when den is 0 (never raises under ANSI)."""
    return F.round(F.try_divide(_c(num).cast("double"), _c(den)), digits)


# Limits and labels of the case grades.
EASY_AT, HARD_AT = 1.0, 0.0
CASE_LABELS = ("EASY", "HARD", "AVERAGE")


def case_type(rounded_ratio) -> Column:
    """Case grade on the *rounded* illicit-neighbour ratio."""
    r = _c(rounded_ratio)
    easy, hard, average = CASE_LABELS
    return F.when(r == EASY_AT, F.lit(easy)).when(r == HARD_AT, F.lit(hard)).otherwise(F.lit(average))


# Fixed values of the cluster interpretation rule (order matters).
HUB_OUT_DEGREE = 50


def cluster_type(avg_out, avg_in) -> Column:
    out, inn = _c(avg_out), _c(avg_in)
    return (F.when(out > HUB_OUT_DEGREE, F.lit("High Activity Hub"))
            .when(inn > out, F.lit("Receiver Wallet"))
            .when(out > inn, F.lit("Sender Wallet"))
            .otherwise(F.lit("Low Activity")))


# Feature families, found in the name in this order, and the rest.
FEATURE_FAMILIES, OTHER_FAMILY = ("Local", "Aggregate"), "Augmented"


def feature_group(name) -> Column:
    """Feature family from its name: Local, Aggregate, else Augmented."""
    n = _c(name)
    return F.coalesce(*[F.when(n.contains(f), F.lit(f)) for f in FEATURE_FAMILIES], F.lit(OTHER_FAMILY))


def bin_index(x, lo, width, bins: int) -> Column:
    """Equal-width bin 0..bins-1; the maximum falls into the last bin."""
    x, lo, width = _c(x), _c(lo), _c(width)
    raw = F.when(width > 0, F.floor((x - lo) / width)).otherwise(F.lit(0))
    return F.least(F.lit(bins - 1), raw).cast("int")


def hash_bucket(key, buckets: int = 100) -> Column:
    """Deterministic bucket of a key from the first 32 bits of its md5.

    Independent of partitioning, so samples and folds are reproducible.
    """
    h = F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets)).cast("int")
