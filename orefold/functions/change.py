"""Change predicates between a stored row and an incoming row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def changed(columns: Sequence[str], old: str = "t", new: str = "s", null_safe: bool = True,
            joint: str = ".") -> Column:
    """True when any of ``columns`` differs between the structs ``old`` and ``new`` (or columns named so, with another ``joint``).

    ``null_safe=False`` keeps the plain ``!=`` reading: a NULL on either side is never a change.
    """
    def differs(name: str) -> Column:
        a, b = F.col(f"{old}{joint}{name}"), F.col(f"{new}{joint}{name}")
        return ~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False))

    return reduce(or_, [differs(c) for c in columns], F.lit(False))
