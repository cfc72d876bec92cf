"""Spark-vs-DuckDB comparison used by the tests and ``tools/check_oracle.py``.

Columns are sorted by name, schemas compared as Arrow types, and rows compared
as an order-insensitive multiset of exact values.
"""

from __future__ import annotations

import collections

import duckdb
import pyarrow as pa

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm_type(t: pa.DataType) -> str:
    if pa.types.is_timestamp(t):
        return f"timestamp[{t.tz or ''}]"
    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    return str(t)


def _rows(tbl: pa.Table) -> collections.Counter:
    names = sorted(tbl.column_names)
    cols = [tbl.column(n).to_pylist() for n in names]
    return collections.Counter(zip(*cols)) if cols else collections.Counter()


def compare(spark, name: str, sf_dir: str, queries, oracle, con=None) -> dict:
    sdf = queries[name](spark, sf_dir)
    st = sdf.toArrow()
    con = con or duck(sf_dir)
    dt_ = con.sql(oracle[name]).arrow()
    if hasattr(dt_, "read_all"):
        dt_ = dt_.read_all()
    s_schema = {f.name: _norm_type(f.type) for f in st.schema}
    d_schema = {f.name: _norm_type(f.type) for f in dt_.schema}
    s_rows, d_rows = _rows(st), _rows(dt_)
    out = {
        "name": name,
        "rows_spark": st.num_rows,
        "rows_oracle": dt_.num_rows,
        "schema_match": s_schema == d_schema,
        "values_match": s_rows == d_rows,
    }
    if not out["schema_match"]:
        out["schema_spark"], out["schema_oracle"] = s_schema, d_schema
    if not out["values_match"]:
        out["only_spark"] = list((s_rows - d_rows).elements())[:3]
        out["only_oracle"] = list((d_rows - s_rows).elements())[:3]
    out["ok"] = out["schema_match"] and out["values_match"] and st.num_rows == dt_.num_rows
    return out
