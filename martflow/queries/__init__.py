"""Registered queries: each operator and dataset on the test tables.

A query is a function of a session and a table folder. Its SQL counterpart, for
comparison in another engine, stands next to it.
"""

from __future__ import annotations

from importlib import import_module

from .base import ORACLES, QUERIES

for _name in (
    "cleaning",
    "joining",
    "history",
    "loading",
    "crawl",
    "customers",
    "dimensions",
    "facts",
    "streams",
):
    import_module(f".{_name}", __name__)

__all__ = ["ORACLES", "QUERIES"]
