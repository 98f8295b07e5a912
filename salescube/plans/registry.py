"""Aggregates the query catalogs into the driver's two maps."""

from __future__ import annotations


def _load():
    # Importing registers the queries of each catalog module.
    from salescube.plans import catalog  # noqa: F401
    from salescube.plans import catalog_incremental, catalog_io, catalog_jobs, catalog_sparse  # noqa: F401
    return catalog.REGISTRY


def all_queries():
    return {k: fn for k, (fn, _) in _load().items()}


def all_oracles():
    return {k: sql for k, (_, sql) in _load().items() if sql}
