"""Registered queries and their SQL twins."""

from __future__ import annotations

from importlib import import_module

from flowsift.queries.registry import REGISTRY, Query

for _family in ("sources", "labels", "audit", "clean", "classes", "temporal", "distribution", "sampling", "features", "training", "trees", "evaluation", "runlog"):
    import_module(f"flowsift.queries.{_family}")

__all__ = ["REGISTRY", "Query"]
