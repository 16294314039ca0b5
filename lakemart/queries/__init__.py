"""Registered queries over the shared test tables, with their SQL twins."""

from importlib import import_module

MODULES = ["versions", "documents", "joining", "summaries", "scalars", "loading", "arrivals", "checks", "admissions", "mart_reports", "mart_handover", "increments"]


def load_all() -> None:
    for name in MODULES:
        import_module(f"lakemart.queries.{name}")
