"""Every operator and job by name, each with an SQL query that must give the same rows."""

from tripstats.registry import analyses, files, groups, rows

_PARTS = (files, rows, groups, analyses)

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
SQL = {name: sql for part in _PARTS for name, sql in part.SQL.items()}
