"""Queries over the driver tables."""

from importlib import import_module

GROUPS = ["q_sources", "q_checks", "q_joins", "q_matching", "q_aggregates", "q_order", "q_scalars", "q_pages", "q_products", "q_images", "q_streams"]


def load() -> None:
    """Import every query group, which registers its queries."""
    for group in GROUPS:
        import_module(f"{__name__}.{group}")
