"""Decode once (T9, S2): one stream parses the topic, the others read its table.

Each message is parsed once, into a VARIANT that is stored as it is, with the
model's fields next to it as typed columns. Fields the model does not know
survive in the VARIANT. The aggregating streams read this table as their
source: columns only, no JSON, and no second read of the topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tillstream.functions.timebounds import parse_event_time
from tillstream.schemas import MESSAGE_SCHEMAS, REQUIRED
from tillstream.sources.decode import observe_quality, validity

MESSAGE = "message"


def decoded_messages(raw: DataFrame, kind: str = "transactions", value_col: str = "value") -> DataFrame:
    """``message`` (VARIANT; NULL where the text is no JSON), the model's fields, ``event_time`` and ``is_valid``."""
    parsed = raw.select(F.try_parse_json(F.col(value_col).cast("string")).alias(MESSAGE))
    fields = [F.try_variant_get(MESSAGE, f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in MESSAGE_SCHEMAS[kind]]
    return (parsed.select(MESSAGE, *fields).withColumn("event_time", parse_event_time("timestamp"))
            .withColumn("is_valid", validity(REQUIRED[kind])))


def decode_stream(raw: DataFrame, kind: str = "transactions") -> DataFrame:
    """The decoding stream; total and valid messages are observed in the same pass."""
    return observe_quality(decoded_messages(raw, kind))


def decoded_schema(kind: str = "transactions") -> T.StructType:
    """Typed columns of the decoded table (the VARIANT is read where it is asked for)."""
    fields = [T.StructField(f.name, f.dataType) for f in MESSAGE_SCHEMAS[kind]]
    return T.StructType([*fields, T.StructField("event_time", T.TimestampType()), T.StructField("is_valid", T.BooleanType())])


def decoded_source(spark: SparkSession, path: str, kind: str = "transactions",
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """The decoded table as a stream, with the columns that ``transactions_from_messages`` gives."""
    reader = spark.readStream.schema(decoded_schema(kind))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path).where(F.col("event_time").isNotNull())


def message_field(decoded: DataFrame, path: str, dtype: str) -> DataFrame:
    """A field of the stored messages by its JSON path, known to the model or not, where it is present."""
    return (decoded.select("event_time", F.try_variant_get(MESSAGE, path, dtype).alias("field"))
            .where(F.col("field").isNotNull()))
