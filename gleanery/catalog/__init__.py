"""Named queries and their checks."""

from .registry import CHECKS, QUERIES


def _load() -> None:
    from . import commit_queries, job_queries, response_queries, scan_queries, state_queries  # noqa: F401


def all_queries():
    _load()
    return dict(QUERIES)


def all_checks():
    _load()
    return dict(CHECKS)
