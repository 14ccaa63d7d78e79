"""Views in the session catalog over stored tables, with personal columns masked when they are read.

A view is SQL text over parquet folders, so every session of the application sees it and each reading evaluates it anew.
Whether a reader sees the columns of a view plainly is looked up at that time: ``current_user()`` must be a member of
the group in a stored table of members. (A catalog that outlives the application needs a metastore; the views
are then created in it by the same text.)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from orefold.functions.columns import MASK
from orefold.plans import dims
from orefold.sinks.lake import Lake

MEMBERS = "group_members"


def set_members(lake: Lake, members: Sequence[tuple[str, str]]) -> None:
    """Stores who belongs to which group, as (group, user)."""
    lake.replace("gold", MEMBERS, lake.spark.createDataFrame(list(members), "group_name string, user_name string").coalesce(1))


def _files(lake: Lake, layer: str, table: str) -> str:
    """The newest version's folders as SQL."""
    found = lake.snapshot(layer, table)
    if found is None:
        raise LookupError(f"no table {layer}.{table} below {lake.root}")
    columns = ", ".join(f"`{f.name}`" for f in found.schema.fields)
    base = lake.table_path(layer, table)
    return " UNION ALL ".join(f"SELECT {columns} FROM parquet.`{base}/{f}`" for f in found.open_folders)


def masked_view_sql(lake: Lake, table: str, masked: Sequence[str], group: str = "admins") -> str:
    """A SELECT of a gold table's current rows; only members of ``group`` see the masked columns as they are."""
    held = lake.snapshot("gold", table)
    shown = ", ".join(f"CASE WHEN m.n > 0 THEN t.`{f.name}` ELSE '{MASK}' END AS `{f.name}`" if f.name in masked else f"t.`{f.name}`"
                      for f in held.schema.fields)
    member = (f"SELECT count(*) AS n FROM ({_files(lake, 'gold', MEMBERS)}) "
              f"WHERE group_name = '{group}' AND user_name = current_user()")
    return f"SELECT {shown} FROM ({_files(lake, 'gold', table)}) t CROSS JOIN ({member}) m"  # one row of m


def create_masked_view(lake: Lake, view: str, table: str = "dim_customer", masked: Sequence[str] = tuple(dims.MASKED_COLUMNS),
                       group: str = "admins") -> None:
    """Creates or replaces ``view``; it shows the table's version of this moment, and members as they are when it is read
    from that version of the member table."""
    lake.spark.sql(f"CREATE OR REPLACE VIEW {view} AS {masked_view_sql(lake, table, masked, group)}")


def read_view(lake: Lake, view: str) -> DataFrame:
    """The view as another session of the application reads it."""
    return lake.spark.newSession().table(view)
