"""K5: bring a DataFrame to a stored-table contract.

Casts every column to its declared type (under ANSI mode an out-of-range
decimal raises instead of being stored wrongly), fills declared defaults,
stamps ``created_at``, and splits off rows that break NOT NULL or VARCHAR(n)
into a reject set with the reason, instead of failing or silently dropping.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.schemas import TableContract

REJECT_REASON = "reject_reason"


def _value(df: DataFrame, col) -> Column:
    if col.name in df.columns:
        c = F.col(col.name).cast(col.dtype)
    else:
        c = F.lit(None).cast(col.dtype)
    if col.default is not None:
        c = F.coalesce(c, F.expr(col.default).cast(col.dtype))
    return c.alias(col.name)


def conform(df: DataFrame, contract: TableContract, stamp: bool = True,
            check_unique: bool = True) -> tuple[DataFrame, DataFrame]:
    """Return ``(rows that satisfy the contract, rejected rows + reason)``.

    With ``stamp=False`` the ``created_at`` column is left out (deterministic
    output for comparisons). For contracts with ``check_unique`` the rows of a
    duplicated table key also go to the reject set (of a table or one micro-batch).
    """
    cols = [c for c in contract.columns if stamp or c.name != "created_at"]
    shaped = df.select(*[_value(df, c) for c in cols])
    reasons = []
    for c in cols:
        if not c.nullable:
            reasons.append(F.when(F.col(c.name).isNull(), F.lit(f"{c.name} is null")))
        if c.max_length is not None:
            reasons.append(F.when(F.length(F.col(c.name)) > c.max_length,
                                  F.lit(f"{c.name} longer than {c.max_length}")))
    if not reasons:
        good, bad = shaped, shaped.limit(0).withColumn(REJECT_REASON, F.lit(None).cast("string"))
    else:
        reason = reduce(lambda a, b: F.coalesce(a, b), reasons)
        tagged = shaped.withColumn(REJECT_REASON, reason)
        good = tagged.where(F.col(REJECT_REASON).isNull()).drop(REJECT_REASON)
        bad = tagged.where(F.col(REJECT_REASON).isNotNull())
    if contract.check_unique and check_unique and contract.key:
        good, dups = split_key_violations(good, contract.key)
        bad = bad.unionByName(dups)
    return good, bad


def with_partition_date(df: DataFrame, contract: TableContract) -> DataFrame:
    """Add the date partition column (``window_date`` etc.) from the time column."""
    from tillstream.sources.tables import TIME_COLUMN
    ts_col, date_col = TIME_COLUMN[contract.name]
    return df.withColumn(date_col, F.trunc(F.col(ts_col), "month") if contract.partition_unit == "month"
                         else F.to_date(F.col(ts_col)))


def split_key_violations(df: DataFrame, key: list[str] | tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key occurs once, and the rows of keys that occur more than
    once (all copies, with a reason) - instead of storing a duplicate key.

    The rows of single keys come out of one aggregate per key (count and the
    row, combined map-side); the duplicates' rows are matched back only where
    the caller reads them.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(*rest)).alias("__row"))
    good = counted.where("__n = 1").select(*key, "__row.*").select(*df.columns)
    dup = df.groupBy(*key).count().where(F.col("count") > 1).select(*key)
    bad = df.join(dup, key, "left_semi").withColumn(REJECT_REASON, F.lit("duplicate key"))
    return good, bad.select(*df.columns, REJECT_REASON)
