"""JDBC sink (K3) and insert-if-absent over JDBC (K6).

Errors are not swallowed: a failed write fails the micro-batch, and the
stream retries it from its checkpoint. A JDBC table has no partition
overwrite, so a replay-safe batch write appends only the keys the table does
not hold yet: all tasks write the batch into a staging table, and one statement
inserts from there what is absent. The database compares the keys (no stored key
is read back), and the statement is one transaction, so of two writers the
table's own key decides.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tillstream.operators.keyed import one_per_key


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, **extra: str) -> dict[str, str]:
    opts = {"url": url, "dbtable": table, **extra}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    return opts


def jdbc_append(df: DataFrame, options: dict[str, str], batch_size: int = 10_000,
                max_connections: int = 32) -> None:
    """K3: append rows with batched inserts. Each writing task holds one
    connection; ``max_connections`` caps them (Spark coalesces to that many
    partitions) so a large cluster does not open thousands at once."""
    (df.write.format("jdbc").options(**options)
       .option("batchsize", str(batch_size))
       .option("numPartitions", str(max_connections))
       .mode("append").save())


def jdbc_read(spark: SparkSession, options: dict[str, str], partition_column: str | None = None,
              lower: str | None = None, upper: str | None = None, partitions: int = 8) -> DataFrame:
    """Read a table, split into ``partitions`` range queries on a numeric,
    date or timestamp column when one is given."""
    reader = spark.read.format("jdbc").options(**options)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower).option("upperBound", upper)
                  .option("numPartitions", str(partitions)))
    return reader.load()


def _execute(spark: SparkSession, options: dict[str, str], *statements: str) -> None:
    """Run statements one after the other over one connection of the driver."""
    jvm = spark._jvm
    if "driver" in options:
        jvm.java.lang.Class.forName(options["driver"])
    properties = jvm.java.util.Properties()
    for name in ("user", "password"):
        if name in options:
            properties.setProperty(name, options[name])
    connection = jvm.java.sql.DriverManager.getConnection(options["url"], properties)
    try:
        statement = connection.createStatement()
        for sql in statements:
            statement.executeUpdate(sql)
        statement.close()
    finally:
        connection.close()


def jdbc_insert_if_absent(batch: DataFrame, options: dict[str, str], key: Sequence[str]) -> None:
    """Append the batch rows (one a key) whose key is not in the table yet.

    The staging table takes its column types from the table, so keys compare as they do there.
    """
    spark, table = batch.sparkSession, options["dbtable"]
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    quoted = lambda names: ", ".join(f'"{c}"' for c in names)
    same = " AND ".join(f't."{c}" = s."{c}"' for c in key)
    _execute(spark, options, f"CREATE TABLE {staging} AS SELECT {quoted(batch.columns)} FROM {table} WITH NO DATA")
    try:
        jdbc_append(one_per_key(batch, key), {**options, "dbtable": staging})
        _execute(spark, options, f"INSERT INTO {table} ({quoted(batch.columns)}) SELECT {quoted(batch.columns)} FROM {staging} s "
                                 f"WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE {same})")
    finally:
        _execute(spark, options, f"DROP TABLE {staging}")


class JdbcBatchWriter:
    """``foreachBatch`` target: replay-safe insert-if-absent into a JDBC table."""

    def __init__(self, options: dict[str, str], key: Sequence[str]):
        self.options, self.key = options, list(key)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        jdbc_insert_if_absent(batch, self.options, self.key)
