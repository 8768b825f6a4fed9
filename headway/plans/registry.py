"""Name -> query and name -> DuckDB SQL, gathered from the modules of queries."""

from __future__ import annotations

from headway.plans import queries_core, queries_joins, queries_more, queries_ops, queries_report

QUERIES: dict = {}
ORACLES: dict = {}
for _module in (queries_core, queries_joins, queries_more, queries_report, queries_ops):
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
