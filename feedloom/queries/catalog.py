"""All registered queries and their SQL twins."""

from __future__ import annotations

from feedloom.queries import records, runs, scans, secrets

QUERIES = {**records.QUERIES, **scans.QUERIES, **secrets.QUERIES, **runs.QUERIES}
ORACLE = {**records.ORACLE, **scans.ORACLE, **secrets.ORACLE, **runs.ORACLE}
