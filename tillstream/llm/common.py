"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: ASCII white space, as the contracts define it: space and \t \n \v \f \r.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"

#: Prefix of the columns that operators add while they work; input columns must not use it.
RESERVED = "__ts_"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A table of the data folder, with only the named columns read."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage: what was computed is not computed again when several
    consumers read it or an executor is lost, and the planner sees real file
    sizes (small tables are broadcast only when they are measured small).
    """
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._ts_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables made by ``written`` that no frame still in use reads.

    For what a function has itself superseded; what its result reads must stay.
    """
    for df in tables:
        remove(df.sparkSession, df._ts_path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once (a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words (maximal runs without ASCII white space) of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def per_process(key: Any, make: Callable[[], Any]) -> Any:
    """One object per Python worker, kept from task to task (task code itself is
    unpickled anew for every task, so its globals do not last)."""
    store = sys.modules.setdefault("__ts_per_process__", types.ModuleType("__ts_per_process__")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)
