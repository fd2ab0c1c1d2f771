"""Registered queries over the driver tables, each with its SQL twin where SQL can express it."""

from importlib import import_module

from .registry import ORACLES, QUERIES

MODULES = ("q_layers", "q_profile", "q_prepare", "q_text", "q_joins", "q_mood", "q_recommend", "q_models", "q_sources", "q_lifecycle", "q_commits")
for _name in MODULES:
    import_module(f"{__name__}.{_name}")

__all__ = ["ORACLES", "QUERIES"]
