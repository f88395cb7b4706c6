"""Every operator as a query over the supplied tables, with its SQL counterpart."""

from rollcall.catalog.oracle import ORACLE_SQL
from rollcall.catalog.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
