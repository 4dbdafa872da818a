"""Operators for training-data pipelines; nothing else in the library imports this package."""

from __future__ import annotations


def all_queries():
    """Named queries of this package: callables of (spark, sf_dir)."""
    from .queries import QUERIES

    return dict(QUERIES)


def all_checks():
    """SQL of those queries that SQL can express."""
    from .queries import CHECKS

    return dict(CHECKS)
