"""Fixture views, end-to-end plans and the catalogue of queries."""

from importlib import import_module

MODULES = ["queries_data", "queries_score", "queries_monitor", "queries_model"]


def load_queries() -> None:
    """Import the modules that register queries."""
    for name in MODULES:
        import_module(f"scorelake.plans.{name}")
