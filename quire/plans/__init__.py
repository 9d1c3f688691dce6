"""Registered queries (``queries.QUERIES``) and their DuckDB twins (``oracle.ORACLE``)."""
