"""Registered queries and the DuckDB SQL they are compared with."""

from __future__ import annotations

from . import barcode_queries, call_queries, evidence_queries, interval_queries, molecule_queries, output_queries, pileup_queries, source_queries, strand_queries, tracker_queries

QUERIES: dict = {}
SQL: dict[str, str] = {}
for _module in (interval_queries, molecule_queries, call_queries, evidence_queries, source_queries, strand_queries, tracker_queries, pileup_queries, barcode_queries, output_queries):
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL
