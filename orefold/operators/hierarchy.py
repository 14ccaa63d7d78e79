"""Three-level parent chains flattened to one row per node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATH_SEPARATOR = " > "


def flatten_hierarchy(nodes: DataFrame, key: str, parent: str, label: str) -> DataFrame:
    """Parent, grandparent, level, path and leaf flag for every node.

    Level 1 has no parent, level 2 has a parent without parent, the rest is level 3. The path is
    NULL when a referenced ancestor is missing. A leaf is a node that no other node calls its parent.

    Ancestors are looked up among inner nodes only (those some node refers to), which is usually a
    small part of the table; one distinct over the parent column finds them and gives the leaf flag.
    """
    n = nodes.select(
        F.col(key).alias("node_id"), F.col(parent).alias("parent_id"), F.col(label).alias("node_name")
    )
    referenced = n.filter(F.col("parent_id").isNotNull()).select(F.col("parent_id").alias("node_id")).distinct()
    inner = n.join(referenced, "node_id", "left_semi")
    up1 = inner.select(
        F.col("node_id").alias("parent_id"),
        F.col("node_name").alias("parent_name"),
        F.col("parent_id").alias("grandparent_id"),
    )
    up2 = inner.select(
        F.col("node_id").alias("grandparent_id"), F.col("node_name").alias("grandparent_name")
    )
    # The parent chain is resolved among inner nodes first, so the big side is joined only once.
    chain = up1.join(up2, "grandparent_id", "left")
    flat = n.join(chain, "parent_id", "left").join(
        referenced.withColumn("_has_child", F.lit(True)), "node_id", "left"
    )
    root, child = F.col("parent_id").isNull(), F.col("grandparent_id").isNull()
    join_names = [F.col("parent_name"), F.lit(PATH_SEPARATOR), F.col("node_name")]
    return flat.select(
        F.col("node_id"),
        F.col("node_name"),
        F.col("parent_id"),
        F.col("parent_name"),
        F.col("grandparent_id"),
        F.col("grandparent_name"),
        F.when(root, 1).when(child, 2).otherwise(3).alias("node_level"),
        F.when(root, F.col("node_name"))
        .when(child, F.concat(*join_names))
        .otherwise(F.concat(F.col("grandparent_name"), F.lit(PATH_SEPARATOR), *join_names))
        .alias("node_path"),
        F.col("_has_child").isNull().alias("is_leaf"),
    )
