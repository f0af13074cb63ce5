"""Driver queries over the given tables and their SQL oracles."""

from .queries import ORACLE_SQL, QUERIES, flagship  # noqa: F401
