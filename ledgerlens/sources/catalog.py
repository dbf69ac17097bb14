"""Loading, view registration and the table inventory.

Schemas are explicit: no inference pass over the files, and a missing column is
an error rather than a silently different table.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ledgerlens.session import stored


def strict_cast(col: Column, data_type, name: str) -> Column:
    """Cast that raises on a malformed value, whatever the ANSI setting; null and
    empty cells stay null.  All CSV paths follow this one rule (FAILFAST)."""
    cast = col.try_cast(data_type)
    bad = F.raise_error(F.concat(F.lit(f"malformed value in column {name}: "), col.cast("string")))
    return F.when(col.isNull() | (F.trim(col.cast("string")) == ""), F.lit(None).cast(data_type)).when(
        cast.isNotNull(), cast).otherwise(bad.cast(data_type)).alias(name)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet", header_names: Mapping[str, str] | None = None) -> DataFrame:
    """Read one table.

    ``fmt='csv'`` reads a header CSV with the given schema (without a schema:
    header names, all columns strings, for the caller to cast).  ``header_names``
    maps a schema field name to a file header that differs from it (e.g.
    ``{"time_step": "Time step"}``).  For Parquet, columns are cast to the schema and
    selected by name, so extra columns are pruned at the scan.
    """
    if fmt == "csv":
        if schema is None:
            # header names only, every column a string: no inference pass
            return spark.read.option("header", True).csv(path)
        if header_names:
            # read by header name as strings, then rename and cast
            raw = (spark.read.option("header", True).option("enforceSchema", False)
                   .csv(path))
            return raw.select(*[strict_cast(F.col(f"`{header_names.get(f.name, f.name)}`"), f.dataType, f.name)
                                for f in schema.fields])
        return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    df = spark.read.format(fmt).load(path)
    if schema is None:
        return df
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


@dataclass(frozen=True)
class Quarantined:
    """``rows``: what could be read; ``rejected``: file, record (the line as it
    stands) of what could not; ``per_file``: file, rows_read, rows_quarantined."""

    rows: DataFrame
    rejected: DataFrame
    per_file: DataFrame


_RECORD, _FILE = "_quarantined_record", "_quarantined_file"


def read_quarantined(spark: SparkSession, path: str, schema: T.StructType) -> Quarantined:
    """Read a header CSV and set malformed rows aside instead of failing: cells that
    do not parse as their type, and rows with too many or too few cells.  Empty cells are null.

    Opt-in; ``read_table`` fails on such rows.  The files are parsed once, when
    called, into the shared scratch folder, so all three results agree, whichever
    columns are read later, and rows in = rows read + rows quarantined.
    """
    full = T.StructType([*schema.fields, T.StructField(_RECORD, T.StringType())])
    raw = (spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", _RECORD).csv(path))
    parsed = stored(raw.select("*", F.col("_metadata.file_path").alias(_FILE)), "parsed")
    good = F.col(_RECORD).isNull()
    per_file = parsed.groupBy(F.col(_FILE).alias("file")).agg(F.count_if(good).alias("rows_read"), F.count_if(~good).alias("rows_quarantined"))
    return Quarantined(parsed.where(good).drop(_RECORD, _FILE),
                       parsed.where(~good).select(F.col(_FILE).alias("file"), F.col(_RECORD).alias("record")), per_file)


def read_optional(spark: SparkSession, path: str, schema: T.StructType | None = None,
                  fmt: str = "parquet") -> DataFrame | None:
    """Like ``read_table`` but returns None when the path does not exist.

    Only a path-not-found analysis error means "absent"; every other error
    propagates.
    """
    try:
        df = read_table(spark, path, schema, fmt)
        df.schema  # noqa: B018  (resolve now so absence is detected here)
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


def assert_unique(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Opt-in check that ``key`` is unique (a duplicated class row would
    multiply every edge joined to it).  Runs one aggregation; returns df."""
    keys = [key] if isinstance(key, str) else list(key)
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).limit(5)
    rows = dup.collect()       # at most 5 rows reach the driver
    if rows:
        raise ValueError(f"duplicate keys {keys}: {[tuple(r) for r in rows]}")
    return df


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        if df is not None:
            df.createOrReplaceTempView(name)


def cache_tables(tables: Mapping[str, DataFrame], names) -> dict[str, DataFrame]:
    """Persist the named tables (memory, spilling to disk); returns the dict."""
    out = dict(tables)
    for n in names:
        out[n] = out[n].persist()
    return out


def table_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, n_cols, n_rows) for every table, one pass per table, one result."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"))
               .select(F.lit(name).alias("table"), F.lit(len(df.columns)).alias("n_cols"), "n_rows")
             for name, df in tables.items() if df is not None]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
