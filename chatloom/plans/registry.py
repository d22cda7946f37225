"""Imports every query module so the catalog is complete, then exposes it."""

from __future__ import annotations

from chatloom.plans import catalog
from chatloom.plans import queries_files, queries_load, queries_stream, queries_train  # noqa: F401  (registers)

flagship = catalog.flagship


def queries():
    return dict(catalog.QUERIES)


def oracle_sql():
    return dict(catalog.ORACLES)
