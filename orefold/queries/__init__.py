"""Registered queries and, where SQL can state the result, the SQL to check them against."""

from __future__ import annotations

from orefold.queries import analyses, dimensions, layered, learning, merges, quality, saved, scalars, storage

MODULES = (saved, analyses, scalars, merges, dimensions, quality, storage, layered, learning)


def all_queries() -> dict:
    out: dict = {}
    for module in MODULES:
        repeated = out.keys() & module.QUERIES.keys()
        if repeated:
            raise ValueError(f"query names used twice: {sorted(repeated)}")
        out.update(module.QUERIES)
    return out


def all_oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    for module in MODULES:
        out.update(module.ORACLE)
    return out
