"""Merkle manifest of a table of documents, with an inclusion proof for each row, by a butterfly exchange.

Rows are leaves; the leaves of one language, in order, form a tree of fixed fanout, and the trees' roots
form another tree over the languages. Leaves are dealt into aligned blocks of ``fanout ** block_levels``,
each of which hashes its own subtree. Then blocks exchange roots round by round: in round r the aligned
groups are of the ``fanout`` blocks whose numbers differ in digit r only. Each member receives the roots of all
subtrees of its group and hashes their parent itself, redundantly, and notes its siblings. After the
last round each block holds the root and its whole upper proof, so nothing is sent down again. A subtree
at the right edge may have fewer blocks than its neighbours; its blocks then speak for the missing ones too.
Groups never hold more than ``fanout`` rows, whatever the size of the table or of one language.

Odd rows: null columns hash as ``-``; null languages form a tree of their own, the first one; a null doc_id sorts
first; equal doc_ids are ordered by their digests, and repeated rows each have a leaf. An empty table gives
an empty result. Other columns than the five hashed ones are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orefold.llm.common import check_columns, materialise, only, partitions, ship

#: The hashed columns, in order (fixed value).
HASHED = ["doc_id", "source", "lang", "n_chars", "text"]
PROOF = "array<struct<before:string,after:string>>"
#: Bits of a row's number within its partition in ``monotonically_increasing_id``.
_WITHIN = 33


def _part(value: Column) -> Column:
    shown = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown))


def leaf(**replaced: Column) -> Column:
    """Digest of a row; keyword arguments stand for columns to hash in another form."""
    return F.sha2(F.concat(*[_part(replaced.get(c, F.col(f"`{c}`"))) for c in HASHED]), 256)


def parent(before: Column, node: Column, after: Column) -> Column:
    return F.sha2(F.concat(before, node, after), 256)


def fold(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, start, lambda node, step: parent(step["before"], node, step["after"]))


def siblings(proof: Column) -> Column:
    """All digests of a proof in one text: level by level, left to right."""
    return F.array_join(F.transform(proof, lambda step: F.concat(step["before"], step["after"])), "")


def height(total: Column, fanout: int) -> Column:
    """Levels above ``total`` nodes, until one remains."""
    levels = F.sequence(F.lit(0), F.lit(62))
    return F.size(F.filter(levels, lambda h: F.pow(F.lit(float(fanout)), h) < total))


def _placed(rows: DataFrame, order: list[Column], group: str | None, purpose: str) -> DataFrame:
    """Adds each row's ``place`` in the order, counted within ``group`` if given (which leads the order).

    Rows are sorted by ranges into a written table together with their number in the partition, so the
    numbers stay the same whatever is run again; the offsets come from one short row per partition and group.
    """
    spread = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    stored = materialise(spread.withColumn("__at", F.monotonically_increasing_id()), purpose)
    stored = stored.withColumn("__partition", F.shiftright("__at", _WITHIN))
    keys = ["__partition", *([group] if group else [])]
    # bounded: at most one row per partition for each group
    runs = stored.groupBy(*keys).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__many"))
    window = (Window.partitionBy(group) if group else Window.partitionBy()).orderBy("__partition")
    runs = runs.select(
        *[F.col(k).alias(f"{k}_") for k in keys], "__first",
        F.coalesce(F.sum("__many").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    same = [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys]
    return stored.join(runs, same).withColumn("place", F.col("__at") - F.col("__first") + F.col("__before")).drop(
        "__at", "__first", "__before", *keys[:1], *[f"{k}_" for k in keys])


def exchange(nodes: DataFrame, most: int, fanout: int) -> DataFrame:
    """Butterfly rounds over ``tree, at, total, node``: replaces node by its tree's root and adds ``path``.

    A tree has ``total`` nodes, numbered ``at`` from 0; ``most`` is the largest total.
    """
    out = nodes.withColumn("path", F.array().cast(PROOF))
    span = 1  # nodes below one subtree at this level
    while span < most:
        subtree, residue = F.expr(f"at div {span}"), F.col("at") % span
        members = F.least(F.lit(span), F.col("total") - F.col("__subtree") * span)
        sent = out.withColumns({"__subtree": subtree, "__residue": residue}).withColumn(
            "__for", F.explode(F.sequence(F.col("__residue"), F.lit(span - 1).cast("bigint"), members)))
        group = Window.partitionBy("tree", F.expr(f"__subtree div {fanout}"), "__for")
        met = sent.withColumn("__met", F.array_sort(F.collect_list(F.struct("__subtree", "node")).over(group)))
        own = met.where(F.col("__for") == F.col("__residue"))

        def joined(test) -> Column:
            return F.array_join(F.transform(F.filter("__met", test), lambda s: s["node"]), "")

        before = joined(lambda s: s["__subtree"] < F.col("__subtree"))
        after = joined(lambda s: s["__subtree"] > F.col("__subtree"))
        more = F.col("total") > span
        own = own.withColumn("__step", F.struct(before.alias("before"), after.alias("after")))
        out = own.select(
            "tree", "at", "total",
            F.when(more, parent(F.col("__step.before"), F.col("node"), F.col("__step.after"))).otherwise(F.col("node")).alias("node"),
            F.when(more, F.concat("path", F.array("__step"))).otherwise(F.col("path")).alias("path"))
        span *= fanout
    return out


def _sha(text: bytes) -> bytes:
    return hashlib.sha256(text).hexdigest().encode()


def _levels(leaves: list[bytes], depth: int, fanout: int) -> list[list[bytes]]:
    """A block's nodes, level by level from its leaves; ``depth`` levels above them."""
    out = [leaves]
    for _ in range(depth):
        below = out[-1]
        out.append([_sha(b"".join(below[k:k + fanout])) for k in range(0, len(below), fanout)])
    return out


def manifest(docs: DataFrame, fanout: int = 8, block_levels: int = 4, **variants: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof for each row, and one more digest per variant.

    A variant is a column that stands for ``text``; its digest is the leaf of the row with that text, under
    the variant's name. ``proof`` lists per level the digests left and right of the row's node.
    """
    check_columns(docs, HASHED)
    if fanout < 2 or block_levels < 0:
        raise ValueError("fanout must be at least 2 and block_levels at least 0")
    spark, width = docs.sparkSession, fanout ** block_levels
    names = list(variants)
    hashed = only(docs, *HASHED).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.unhex(leaf()).alias("leaf"),
        *[F.unhex(leaf(text=v)).alias(f"leaf_{k}") for k, v in enumerate(variants.values())])
    # Texts are read and hashed once. The number tells repeated rows apart, so that ranges can split them.
    stored = materialise(hashed.withColumn("copy", F.monotonically_increasing_id()), "merkle-leaves")
    sizes = materialise(stored.groupBy("lang").agg(F.count(F.lit(1)).alias("total")), "merkle-sizes")
    langs, most = sizes.agg(F.count(F.lit(1)), F.max("total")).first()
    ordered = [F.col("lang").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("copy")]
    rows = _placed(stored, ordered, "lang", "merkle-order")
    trees = _placed(sizes, [F.col("lang").asc_nulls_first()], None, "merkle-langs").select(
        F.col("lang").alias("__lang"), F.col("place").alias("tree"), "total")
    rows = rows.join(trees, F.col("lang").eqNullSafe(F.col("__lang"))).select(
        "doc_id", "leaf", *[f"leaf_{k}" for k in range(len(names))], "tree", "total",
        (F.col("place") % width).alias("place"), F.expr(f"place div {width}").alias("block"),
        F.least(height(F.col("total"), fanout), F.lit(block_levels)).alias("depth"))
    ship(spark)

    def root_of(block: pa.Table) -> pa.Table:
        block = block.sort_by("place")
        leaves = [d.hex().encode() for d in block["leaf"].to_pylist()]
        node = _levels(leaves, block["depth"][0].as_py(), fanout)[-1][0].decode()
        return pa.table({"tree": block["tree"][:1], "at": block["block"][:1], "total": block["total"][:1], "node": pa.array([node])})

    blocks = rows.select("tree", "block", "place", "leaf", "depth", "total").groupBy("tree", "block").applyInArrow(
        root_of, "tree bigint, at bigint, total bigint, node string")
    blocks = blocks.withColumn("total", F.ceil(F.col("total") / width).cast("bigint"))
    upper = materialise(exchange(blocks, -(-(most or 0) // width), fanout), "merkle-blocks")
    roots = upper.where("at = 0").select(
        F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("at"), F.lit(langs).cast("bigint").alias("total"), "node")
    roots = exchange(roots, langs, fanout).select(F.col("at").alias("tree"), F.col("node").alias("root"), F.col("path").alias("last"))
    upper = upper.join(roots, "tree").select(
        "tree", F.col("at").alias("block"), F.col("node").alias("subroot"), "root", F.concat("path", "last").alias("path"))

    def with_proofs(block: pa.Table, above: pa.Table) -> pa.Table:
        block = block.sort_by("place")
        leaves = [d.hex().encode() for d in block["leaf"].to_pylist()]
        levels = _levels(leaves, block["depth"][0].as_py(), fanout)[:-1]
        path = above["path"][0].as_py()
        first, last = [], []
        for place in range(len(leaves)):
            for level in levels:
                start = place - place % fanout
                first.append(b"".join(level[start:place]))
                last.append(b"".join(level[place + 1:start + fanout]))
                place //= fanout
            for step in path:
                first.append(step["before"].encode())
                last.append(step["after"].encode())
        steps = len(levels) + len(path)
        proof = pa.ListArray.from_arrays(
            pa.array(range(0, steps * len(leaves) + 1, steps) if steps else [0] * (len(leaves) + 1), pa.int32()),
            pa.StructArray.from_arrays([pa.array(x, pa.binary()).cast(pa.string()) for x in (first, last)], ["before", "after"]))
        many = len(leaves)
        texts = {name: pa.array([d and d.hex() for d in block[f"leaf_{k}"].to_pylist()], pa.string()) for k, name in enumerate(names)}
        return pa.table({
            "doc_id": block["doc_id"], "leaf": pa.array(leaves, pa.binary()).cast(pa.string()), **texts,
            "subroot": pa.array([above["subroot"][0].as_py()] * many), "root": pa.array([above["root"][0].as_py()] * many), "proof": proof})

    kinds = "".join(f"`{name}` string, " for name in names)
    return rows.groupBy("tree", "block").cogroup(upper.groupBy("tree", "block")).applyInArrow(
        with_proofs, f"doc_id bigint, leaf string, {kinds}subroot string, root string, proof {PROOF}")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered(one_in: int = 3) -> Column:
    """The text as a check of the manifest changes it: A-Z in lower case where ``one_in`` divides the crc32 of doc_id."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % one_in == 0
    text = F.col("text").cast("string")
    return F.when(F.coalesce(chosen, F.lit(False)), lower_ascii(text)).otherwise(text)


def check_tampering(docs: DataFrame, one_in: int = 3, **options) -> DataFrame:
    """The manifest of ``docs``, verified against a copy in which some texts were changed."""
    found = manifest(docs, found_leaf=tampered(one_in), **options)
    return found.withColumn("folded_root", fold(F.col("found_leaf"), F.col("proof"))).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
