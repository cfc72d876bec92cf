"""Exports (K8 CSV, K9 JSON with manifest).

Distributed writes instead of one process building the whole file: each
table is written by its tasks; record counts come from ``observe`` during the
same pass (no second scan) and go into a one-row manifest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import DecimalType, TimestampNTZType, TimestampType


def _time_text(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, with six decimals where there is a fraction of a second."""
    whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))


def export_frame(df: DataFrame) -> DataFrame:
    """Timestamps as text, decimals as floating point."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            cols.append(_time_text(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _write_counted(df: DataFrame, writer) -> int:
    obs = Observation()
    writer(export_frame(df).observe(obs, F.count(F.lit(1)).alias("n")))
    return int(obs.get["n"])


def export_csv(summary: DataFrame, path: str) -> int:
    """K8: the transactions summary as CSV with a header row (none without rows,
    as the files of an empty table are empty); returns rows.

    The plan runs once. Only an export without rows, whose header is then not
    wanted, is written again, from nothing.
    """
    n = _write_counted(summary, lambda d: d.write.mode("overwrite").option("header", True).csv(path))
    if not n:
        nothing = summary.sparkSession.createDataFrame([], export_frame(summary).schema)
        nothing.write.mode("overwrite").option("header", False).csv(path)
    return n


def export_json(summary: DataFrame, products: DataFrame, path: str) -> DataFrame:
    """K9: both tables as JSON lines plus a manifest row
    ``(export_timestamp, transactions_summary, product_performance, total_records)``."""
    spark = summary.sparkSession
    n_t = _write_counted(summary, lambda d: d.write.mode("overwrite").json(f"{path}/transactions_summary"))
    n_p = _write_counted(products, lambda d: d.write.mode("overwrite").json(f"{path}/product_performance"))
    manifest = spark.createDataFrame(
        [(n_t, n_p)], "transactions_summary bigint, product_performance bigint"
    ).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("export_timestamp"),
        "transactions_summary", "product_performance",
        (F.col("transactions_summary") + F.col("product_performance")).alias("total_records"))
    manifest.write.mode("overwrite").json(f"{path}/manifest")
    return manifest


def export_last_day(summary: DataFrame, products: DataFrame, as_of, path: str, fmt: str = "json",
                    until=None):
    """The export request: the last 24 hours of both tables (Q10 newest
    windows first, Q11 highest revenue first). CSV holds the summary rows only,
    as the reference's CSV export does; JSON holds both plus the manifest.
    Returns the row count (CSV) or the manifest DataFrame (JSON)."""
    from tillstream.functions.timebounds import trailing
    from tillstream.operators import rollups
    rng = trailing(as_of, "24h", until)
    t = rollups.export_transactions(summary, rng)
    if fmt == "csv":
        return export_csv(t, path)
    return export_json(t, rollups.export_products(products, rng), path)
