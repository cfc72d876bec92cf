"""Index of the keys a table holds (K11: a key stays unique whatever day it comes on).

``<path>/bucket=…/batch_id=…`` holds only keys, hash-bucketed, sorted within a
file, with a Parquet bloom filter on the key. A micro-batch reads the buckets of
its own keys; these are pushed to the scans in lists that the Parquet reader can
take, and it skips every row group whose bloom filter holds none of them: a probe
costs what may match, not what is stored, and no day plays a part. Only a batch
of more keys than all lists hold (about 6,000) reads its buckets whole; such
backlogs are rare, and triggers bound them.

A replayed micro-batch leaves its own entries out and writes them again. Keys
that stand there twice do no harm (the probe is an anti-join), so merging a
bucket's small files needs no coordination.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillstream.session import temporary_conf

BUCKETS = 32
#: Keys pushed to one scan (the reader nests them, so a list must stay short), and scans a probe is made of.
PUSHED_KEYS, SCANS = 200, 32
#: Distinct keys a bloom filter is sized for (about 1 % false positives).
KEYS_PER_FILE = 1_000_000
BASE = -1


class KeyIndex:
    """Keys (one column, text) stored below ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def read(self) -> DataFrame | None:
        """All entries, or None before the first write."""
        from tillstream.sinks.parquet import exists
        if not exists(self.spark, self.path):
            return None
        return self.spark.read.schema(f"`{self.key}` string, bucket int, batch_id bigint").parquet(self.path)

    def probe(self, keys: DataFrame) -> DataFrame | None:
        """Entries that may equal one of ``keys`` (distinct): those of its buckets, less what the bloom filters rule out."""
        stored = self.read()
        if stored is None:
            return None
        few = keys.select(self.key, self.bucket()).limit(SCANS * PUSHED_KEYS + 1).collect()  # bounded, short texts
        lists: dict[int, list[list[str]]] = {}
        for value, bucket in few:
            own = lists.setdefault(bucket, [[]])
            if len(own[-1]) == PUSHED_KEYS:
                own.append([])
            own[-1].append(value)
        if len(few) > SCANS * PUSHED_KEYS or sum(map(len, lists.values())) > SCANS:
            buckets = [r[0] for r in keys.select(self.bucket()).distinct().collect()]  # at most ``buckets`` rows
            return stored.where(F.col("bucket").isin(buckets))
        found = stored.limit(0)
        for bucket, own in sorted(lists.items()):
            for values in own:
                found = found.unionByName(stored.where((F.col("bucket") == bucket) & F.col(self.key).isin(values)))
        return found

    def absent(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """``rows`` (one a key) whose key no other batch has stored."""
        keys = rows.select(self.key).persist()
        try:
            # Lists up to this length reach the Parquet reader value by value, hence its bloom filters.
            with temporary_conf(self.spark, {"spark.sql.parquet.pushdown.inFilterThreshold": str(PUSHED_KEYS)}):
                stored = self.probe(keys)
                if stored is None:
                    return rows
                known = (stored.where(F.col("batch_id") != batch_id).join(keys, self.key, "left_semi")
                         .select(self.key).distinct().persist())
                known.count()  # read now: the setting holds while the scan is planned and run
        finally:
            keys.unpersist()
        return rows.join(known, self.key, "left_anti")

    def _write(self, rows: DataFrame) -> None:
        (rows.repartition("bucket").sortWithinPartitions("bucket", self.key).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .option(f"parquet.bloom.filter.enabled#{self.key}", "true")
         .option(f"parquet.bloom.filter.expected.ndv#{self.key}", str(KEYS_PER_FILE))
         .option("parquet.bloom.filter.adaptive.enabled", "true")
         .partitionBy("bucket", "batch_id").parquet(self.path))

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Store the keys of ``rows`` as those of ``batch_id`` (replacing what it stored before)."""
        self._write(rows.select(self.key, self.bucket().alias("bucket"), F.lit(batch_id).cast("bigint").alias("batch_id")))

    def compact(self, before: int, staging: str) -> None:
        """Merge the entries of batches older than ``before`` into one set of files a bucket."""
        from tillstream.sinks.parquet import _file_system
        stored = self.read()
        old = [] if stored is None else [tuple(r) for r in stored.where(
            (F.col("batch_id") < before) & (F.col("batch_id") != BASE)).select("bucket", "batch_id").distinct().collect()]
        if not old:
            return
        touched = sorted({b for b, _ in old})
        keep = stored.where(F.col("bucket").isin(touched) & (F.col("batch_id") < before))
        keep.select(self.key, "bucket").distinct().write.mode("overwrite").parquet(staging)
        self._write(self.spark.read.parquet(staging).withColumn("batch_id", F.lit(BASE).cast("bigint")))
        for bucket, batch_id in old:
            place, files = _file_system(self.spark, f"{self.path}/bucket={bucket}/batch_id={batch_id}")
            files.delete(place, True)
