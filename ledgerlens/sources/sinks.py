"""Result sinks: distributed writers, never a driver-side pandas copy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_result(df: DataFrame, path: str, fmt: str = "csv", single_file: bool = False) -> None:
    """Write a result table with a header (CSV) or as Parquet, overwriting.

    ``single_file`` coalesces to one task and is meant for small report tables
    only; large outputs stay one file per partition.
    """
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_predictions(scored: DataFrame, path: str, id_col: str = "txId",
                      fmt: str = "parquet", keep: Sequence[str] = ()) -> None:
    """Write (``keep``..., id, label, prediction) of a scored table, overwriting."""
    cols = scored.select(*keep, id_col, "label", scored["prediction"].cast("int").alias("prediction"))
    write_result(cols, path, fmt=fmt)
