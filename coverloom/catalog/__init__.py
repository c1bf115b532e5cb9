"""Registered queries over the star-schema test tables, each with its oracle."""

from __future__ import annotations

from coverloom.catalog import basic_queries, exposure_queries, portfolio_queries, receipt_queries, source_queries  # noqa: F401
from coverloom.catalog.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracles():
    return dict(ORACLES)
