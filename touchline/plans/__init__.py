"""Registered queries bound to the test tables, with their DuckDB oracles."""

from touchline.plans.registry import ORACLES, QUERIES


def load_all() -> None:
    """Import every query module so its queries register."""
    from touchline.plans import (eval_queries, event_queries, feature_queries, fixture_queries, grid_queries,  # noqa: F401
                                 library_queries, ml_queries, profile_queries, scalar_queries, tree_queries)


__all__ = ["ORACLES", "QUERIES", "load_all"]
