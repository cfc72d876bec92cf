"""Streaming message sources.

The Kafka reader is what a deployment uses; the text-file reader yields the
same ``value`` column, so everything downstream is identical and can be run
where no broker exists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Topic names of the three message streams.
TOPICS = {
    "transactions": "retail-transactions",
    "inventory": "inventory-updates",
    "customer_events": "customer-events",
}


def kafka_stream(spark: SparkSession, bootstrap_servers: str, kind: str = "transactions",
                 starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None,
                 **options: str) -> DataFrame:
    """``key, value, topic, partition, offset, timestamp`` rows of one topic.

    ``max_offsets_per_trigger`` bounds a micro-batch, so catching up after a
    stop proceeds in batches of known size instead of one batch holding the
    whole backlog. Needs the spark-sql-kafka package on the cluster's classpath.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", TOPICS[kind])
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", "true"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load()


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """One message per line of the text files appearing below ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def date_in_order(spark: SparkSession, path: str) -> None:
    """Date the text files of one write a second apart, in the order of their names.

    ``text_stream`` takes files by their modification time, which says in what order
    the write's tasks ended. Only their order counts: the latest keeps about its date.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted((s.getPath() for s in files.listStatus(place) if s.getPath().getName().startswith("part-")),
                   key=lambda p: p.getName())
    latest = max((files.getFileStatus(p).getModificationTime() for p in parts), default=0)
    for k, part in enumerate(parts):
        files.setTimes(part, latest - 1000 * (len(parts) - k), -1)
    dates = [files.getFileStatus(p).getModificationTime() for p in parts]
    if dates != sorted(set(dates)):
        raise RuntimeError(f"the files of {path} could not be dated in order")


def kafka_batch(spark: SparkSession, bootstrap_servers: str, kind: str = "transactions",
                starting_offsets: str = "earliest", ending_offsets: str = "latest") -> DataFrame:
    """Bounded read of a topic (re-loads, back-fills)."""
    return (spark.read.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", TOPICS[kind])
            .option("startingOffsets", starting_offsets)
            .option("endingOffsets", ending_offsets)
            .load())
