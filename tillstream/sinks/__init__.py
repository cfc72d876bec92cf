"""Sinks: table contracts, Parquet/JDBC writers, exports, long-form metrics."""
