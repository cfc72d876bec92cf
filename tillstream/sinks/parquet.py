"""Parquet table sinks (K1, K2, K10, K11 storage; K7 for re-loads).

One layout for every writer and reader: ``<table>/<date>=…/batch_id=…``. A
micro-batch of a stream owns its ``batch_id`` partitions and overwrites them
(a replayed batch replaces itself, so no commit log is needed next to the
data); batch writes, merges and compactions own ``batch_id = -1``. Files are
sorted by key, so trailing ranges prune directories and row groups. Rows that
break the contract go to ``<table>_rejects`` with their reason.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.schemas import TableContract
from tillstream.sinks.contracts import REJECT_REASON, conform, with_partition_date
from tillstream.sources.tables import BATCH_ID, TIME_COLUMN, stored_rows

#: ``batch_id`` of rows that no stream wrote.
BASE = -1


def _date_col(contract: TableContract) -> str:
    return TIME_COLUMN[contract.name][1]


def prepare(df: DataFrame, contract: TableContract, stamp: bool = True) -> tuple[DataFrame, DataFrame]:
    good, bad = conform(df, contract, stamp=stamp)
    return with_partition_date(good, contract), bad


def clustered(df: DataFrame, contract: TableContract, partitions: int | None = None) -> DataFrame:
    """Range-partition on (date, key) before a partitioned write.

    Each task then holds a contiguous slice of days and writes one file per
    day it covers (instead of every task writing a file for every day), and a
    day holding a large share of the rows is split across tasks by key.
    """
    date_col = _date_col(contract)
    # Without an explicit count AQE coalesces the range shuffle to its
    # advisory partition size: few files for a small table, files of about
    # that size for a large one.
    ranged = (df.repartitionByRange(partitions, date_col, *contract.key) if partitions
              else df.repartitionByRange(date_col, *contract.key))
    return ranged.sortWithinPartitions(date_col, *contract.key)


def write_sizing(spark):
    """Settings for partitioned table writes, where each task pays a fixed
    cost per day file: AQE's parallelism-first coalescing may go down to
    small partitions so a small table still gets one writer per core. At scale
    the coalescing target is bound by the advisory size and this has no effect.
    """
    from tillstream.session import temporary_conf
    return temporary_conf(spark, {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB"})


def write_table(df: DataFrame, path: str, contract: TableContract, mode: str = "append",
                stamp: bool = True, max_records_per_file: int = 5_000_000) -> DataFrame:
    """Batch write of contract rows; returns the reject set (lazy)."""
    good, bad = prepare(df, contract, stamp)
    with write_sizing(df.sparkSession):
        (clustered(good, contract).withColumn(BATCH_ID, F.lit(BASE).cast("bigint"))
             .write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
             .partitionBy(_date_col(contract), BATCH_ID).parquet(path))
    return bad


def overwrite_partitions(df: DataFrame, path: str, *partitions: str) -> None:
    """Replace exactly the partitions present in ``df`` (dynamic overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partitions).parquet(path))


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _file_system(spark, path)
    return files.exists(place)


class IdempotentBatchWriter:
    """``foreachBatch`` target writing batch ``n`` to partitions
    ``<date>/batch_id=n`` with dynamic overwrite, and its contract rejects to
    ``<path>_rejects`` (which exists once there are any). Writing the same batch
    twice leaves the table as it was.

    ``insert_only``: rows whose key an earlier batch stored are left out (raw
    messages delivered twice, however late and whatever their time); the keys
    stored are indexed in ``<path>_keys``. ``also``: called with each batch's rows
    as stored and its id (rollups, latency), after they are written.
    """

    def __init__(self, path: str, contract: TableContract, insert_only: bool = False, also: tuple = ()):
        self.path, self.contract, self.insert_only, self.also = path, contract, insert_only, also

    def keys(self, spark: SparkSession):
        from tillstream.sinks.key_index import KeyIndex
        [key] = self.contract.key
        return KeyIndex(spark, f"{self.path}_keys", key)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = prepare(batch, self.contract)
            if self.insert_only:
                from tillstream.operators.keyed import one_per_key
                keys = self.keys(batch.sparkSession)
                good = keys.absent(one_per_key(good, self.contract.key, (TIME_COLUMN[self.contract.name][0],)), batch_id).persist()
            tagged = good.withColumn(BATCH_ID, F.lit(batch_id).cast("bigint"))
            # By day, rebalanced by size: one file a day (or a few), not one for each state partition.
            by_day = tagged.hint("rebalance", _date_col(self.contract)).sortWithinPartitions(
                _date_col(self.contract), *self.contract.key)
            overwrite_partitions(by_day, self.path, _date_col(self.contract), BATCH_ID)
            if self.insert_only:  # after the rows: a batch cut short here is replayed and finds its keys absent
                keys.add(good, batch_id)
                good.unpersist()
            if self.also:
                date_col = _date_col(self.contract)
                stored = batch.sparkSession.read.schema(tagged.schema).parquet(self.path).where(F.col(BATCH_ID) == batch_id)
                for follow in self.also:
                    follow(stored.drop(date_col, BATCH_ID), batch_id)
            if not bad.isEmpty():
                rejects = bad.withColumn(BATCH_ID, F.lit(batch_id).cast("bigint"))
                row_cols = [c for c in self.contract.names if c in bad.columns and c != "created_at"]
                overwrite_partitions(
                    rejects.select(BATCH_ID, REJECT_REASON, F.to_json(F.struct(*row_cols)).alias("row")),
                    self.path + "_rejects", BATCH_ID)
        finally:
            batch.unpersist()


def stream_to_table(df: DataFrame, path: str, checkpoint: str, contract: TableContract,
                    trigger: dict | None = None, query_name: str | None = None,
                    insert_only: bool = False, progress=None, also: tuple = ()) -> StreamingQuery:
    """Append a stream to a stored table, its rejects to the
    reject table, and (``progress``, a ``streaming.progress.ProgressLog``) its
    progress reports to the progress table. ``also``: see ``IdempotentBatchWriter``."""
    from tillstream.session import configure_streaming
    configure_streaming(df.sparkSession)
    writer = IdempotentBatchWriter(path, contract, insert_only, also)

    def write(batch: DataFrame, batch_id: int) -> None:
        writer(batch, batch_id)
        if progress is not None:
            progress.save()

    out = df.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        out = out.queryName(query_name)
    query = out.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
    if progress is not None:
        progress.follow(query)
    return query


def _replace_days(spark: SparkSession, merged: DataFrame, path: str, contract: TableContract,
                  staging: str, old: list) -> None:
    """Put ``merged`` (whole days) in place of the partitions ``old`` of those days.

    The new rows are staged first (a table is not overwritten while it is
    read), then replace the days' base partitions, then the days' stream
    partitions go. If that is cut short, a repeated run finds rows of a key
    twice and keeps the base one.
    """
    date_col = _date_col(contract)
    with write_sizing(spark):
        clustered(merged, contract).write.mode("overwrite").partitionBy(date_col).parquet(f"{staging}/merged")
    overwrite_partitions(spark.read.parquet(f"{staging}/merged").withColumn(BATCH_ID, F.lit(BASE).cast("bigint"))
                         .sortWithinPartitions(date_col, *contract.key), path, date_col, BATCH_ID)
    for day, batch_id in old:
        place, files = _file_system(spark, f"{path}/{date_col}={day}/{BATCH_ID}={batch_id}")
        files.delete(place, True)


def _days_of(spark: SparkSession, path: str, contract: TableContract, days: list) -> tuple[DataFrame, list]:
    """Stored rows of ``days`` (one a key, the base row first) and their stream partitions."""
    date_col, key = _date_col(contract), list(contract.key)
    rows = stored_rows(spark, path, contract.name).where(F.col(date_col).isin(days))
    old = [(r[0], r[1]) for r in rows.where(F.col(BATCH_ID) != BASE).select(date_col, BATCH_ID).distinct().collect()]
    rest = [c for c in rows.columns if c not in (*key, BATCH_ID)]
    one = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), BATCH_ID).alias("row")).select(*key, "row.*")
    return one, old


def merge_into_table(batch: DataFrame, path: str, contract: TableContract, staging: str) -> DataFrame:
    """K7: keyed upsert of ``batch`` into a stored table (the batch wins on a
    key conflict), rewriting only the days that the batch has rows in. Returns
    the batch's contract rejects.

    The batch is computed once, into ``staging/batch``; its distinct days (at
    most one value a day) select the partitions that are read and replaced.
    """
    from tillstream.operators.keyed import one_per_key, upsert

    spark = batch.sparkSession
    date_col = _date_col(contract)
    good, bad = prepare(batch, contract)
    with write_sizing(spark):
        clustered(good, contract).write.mode("overwrite").parquet(f"{staging}/batch")
    staged = spark.read.schema(good.schema).parquet(f"{staging}/batch")
    days = [r[0] for r in staged.select(date_col).distinct().collect()]
    if not days:
        return bad
    merged, old = one_per_key(staged, contract.key), []
    if exists(spark, path):
        stored, old = _days_of(spark, path, contract, days)
        merged = upsert(stored.select(*staged.columns), staged, contract.key)
    _replace_days(spark, merged, path, contract, staging, old)
    return bad


def compact(spark: SparkSession, path: str, contract: TableContract, days: list[dt.date], staging: str) -> None:
    """Merge the small files that a stream's triggers left on closed ``days`` into
    the days' base partitions (files of about the advisory size, sorted by key)."""
    rows, old = _days_of(spark, path, contract, days)
    if old:
        _replace_days(spark, rows.select(*contract.names, _date_col(contract)), path, contract, staging, old)
