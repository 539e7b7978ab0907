"""SQL that answers every query on the same inputs, written statement by statement for DuckDB.

A text may use any derived table or named part in FROM/JOIN; the parts it needs are put in front as CTEs and the result
columns are shaped like the query's.
"""

from __future__ import annotations

import re

from ledgerloom.catalog import QUERIES
from ledgerloom.sources.fixture_sql import FIXTURE_SQL
from oracle import day_end_sql, month_sql, process_sql, start_sql, voucher_sql

_SOURCE = re.compile(r"\b(?:FROM|JOIN)\s+([a-z_0-9]+)\b")
_PARTS = {**FIXTURE_SQL, **start_sql.PARTS, **day_end_sql.PARTS, **voucher_sql.PARTS, **month_sql.PARTS, **process_sql.PARTS}
_TEXTS = {**start_sql.TEXTS, **day_end_sql.TEXTS, **voucher_sql.TEXTS, **month_sql.TEXTS, **process_sql.TEXTS}


def _needed(sql: str, found: dict[str, str]) -> None:
    for name in _SOURCE.findall(sql):
        if name in _PARTS and name not in found:
            _needed(_PARTS[name], found)
            found[name] = _PARTS[name]


def _shaped(name: str, kind: str) -> str:
    if kind == "m":
        return f"CAST(CAST({name} AS DECIMAL(18,2)) AS DOUBLE) AS {name}"
    if kind == "d":
        return f"CAST(CAST({name} AS DATE) AS VARCHAR) AS {name}"
    return f"CAST({name} AS {'VARCHAR' if kind == 's' else 'BIGINT'}) AS {name}"


def oracle_texts() -> dict[str, str]:
    texts = {}
    for key, body in _TEXTS.items():
        parts: dict[str, str] = {}
        _needed(body, parts)
        parts["answer"] = body
        ctes = ",\n".join(f"{name} AS MATERIALIZED ({sql.strip()})" for name, sql in parts.items())
        columns = ", ".join(_shaped(name, kind) for name, kind in QUERIES[key].shape)
        texts[key] = f"WITH {ctes}\nSELECT {columns} FROM answer"
    return texts
