"""Collects the registered queries of every catalog module."""

from __future__ import annotations


def _load():
    from skein.plans import catalog  # noqa: F401
    from skein.plans import catalog_models  # noqa: F401
    from skein.plans import catalog_flows  # noqa: F401
    return catalog


def all_queries():
    return dict(_load().QUERIES)


def all_oracles():
    return dict(_load().ORACLE)
