"""Wiring of jobs to the supplied tables."""

from importlib import import_module

AREAS = ["web", "email", "status", "paths", "partners", "commerce"]


def load():
    """Import all query modules and return (queries, oracle statements)."""
    for area in AREAS:
        import_module(f"{__name__}.{area}")
    from .registry import ORACLE, QUERIES

    return QUERIES, ORACLE
