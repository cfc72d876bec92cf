"""Driver contract: named queries over the test tables and their DuckDB oracles."""

from tillstream.contract.queries import QUERIES, entry  # noqa: F401
from tillstream.contract.oracle import ORACLE  # noqa: F401
