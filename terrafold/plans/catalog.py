"""All registered map queries and the SQL that gives the same rows."""

from __future__ import annotations

from . import features, graph, scalar, tiles, view, whole

QUERIES = {**scalar.QUERIES, **features.QUERIES, **tiles.QUERIES, **graph.QUERIES, **view.QUERIES, **whole.QUERIES}
ORACLE_SQL = {**scalar.ORACLE, **features.ORACLE, **tiles.ORACLE, **graph.ORACLE, **view.ORACLE, **whole.ORACLE}
