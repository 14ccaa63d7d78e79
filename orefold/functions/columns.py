"""Column expressions shared by the layer plans. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK = "***MASKED***"
SEPARATOR = "|"


def snake_case(name: str) -> str:
    """``SalesOrderDetailID`` becomes ``sales_order_detail_id``."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name).lower()


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def row_hash(columns: Iterable[str | Column]) -> Column:
    """MD5 of the columns' text joined by ``|``; NULL counts as empty text."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def digit_id(columns: Iterable[str | Column], hex_digits: int = 15) -> Column:
    """A repeatable non-negative integer made from the columns' values alone (no shuffle)."""
    return F.conv(F.substring(row_hash(columns), 1, hex_digits), 16, 10).cast("bigint")


def content_digest(columns: Iterable[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes that together stand for the columns' values.

    The hash function passes over NULLs, so which columns are NULL is hashed along: a value that
    moves from one column to another changes the digest. Both sides of a comparison need equal types.
    """
    names = list(columns)
    nulls = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in names])
    return F.xxhash64(*names, nulls), F.xxhash64(nulls, *reversed(names))


def fill_text(value: str | Column, default: str = "N/A", trim: bool = False, case: str | None = None) -> Column:
    """Text with a default for NULL, optionally trimmed and put in ``upper`` or ``lower`` case."""
    out = F.coalesce(_col(value).cast("string"), F.lit(default))
    if trim:
        out = F.trim(out)
    return {"upper": F.upper, "lower": F.lower, None: lambda c: c}[case](out)


def blank_to_null(value: str | Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(F.coalesce(_col(value), F.lit(""))), F.lit(""))


def date_key(value: str | Column) -> Column:
    """``yyyymmdd`` as an integer; NULL for a NULL date."""
    day = _col(value)
    return (10000 * F.year(day) + 100 * F.month(day) + F.dayofmonth(day)).cast("int")


def safe_measure(value: str | Column, data_type: str) -> Column:
    """The value in ``data_type``; 0 where it is NULL or does not fit."""
    return F.coalesce(_col(value).try_cast(data_type), F.lit(0).cast(data_type)).cast(data_type)


def mask_text(value: str | Column, visible: bool) -> Column:
    """The value itself for privileged readers, a fixed mask (also for NULL) for the others."""
    return _col(value) if visible else F.lit(MASK)
