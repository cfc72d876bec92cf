"""Keyed table merges (K6 insert-if-absent, K7 upsert).

Both are joins on the table key: the incoming rows are reduced to one a key
(partial aggregation map-side, one shuffle by key), then anti-joined with the
stored rows; the join reuses that hash partitioning for the incoming side.
Callers restrict ``existing`` to the partitions the batch touches
(``sources.tables``), so the stored side read grows with the batch, not with
the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def one_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row a key: the least in ``order``, then in the remaining columns (in
    table order), so that reruns pick the same row whatever order rows come in."""
    key = list(key)
    rest = [*order, *[c for c in df.columns if c not in key and c not in order]]
    if not rest:
        return df.dropDuplicates(key)
    return df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("__row")).select(*key, "__row.*").select(*df.columns)


def insert_if_absent(existing: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING``: the rows of ``new`` whose key is
    not stored yet (to append), one a key."""
    key = list(key)
    return one_per_key(new, key).join(existing.select(*key), key, "left_anti")


def table_after_insert(existing: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Table state after ``insert_if_absent``: stored rows win on conflict."""
    return existing.unionByName(insert_if_absent(existing, new, key).select(*existing.columns))


def upsert(existing: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keyed upsert: table state where the batch's row wins on conflict."""
    return replace_rows(existing, one_per_key(batch, key), key)


def replace_rows(existing: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """``upsert`` of a batch that has one row a key."""
    key = list(key)
    kept = existing.join(batch.select(*key), key, "left_anti")
    return kept.unionByName(batch.select(*existing.columns))
