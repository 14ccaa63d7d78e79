"""SimHash fingerprints, and near-duplicate links found over the anchors of a covering code.

Fingerprints of 64 bits link at ``distance`` or fewer differing bits (4 here). One of the two 32-bit
halves of such a pair differs in at most 2 bits. For halves, the anchors are the words of a perfect
Hamming code of length 31 with one free bit: every half is within covering radius 1 of an anchor. A half
is copied to all anchors within radius 2, the covering radius and half the threshold: the point midway
between two linked halves is within 1 of both and within 1 of its own anchor, so they meet there. (With
the whole threshold on one side and none on the other they would meet too, over ten times as many copies.)
A half has at most 17 such anchors of 2**27.

Copies of a text, and texts with equal fingerprints, are one point. Points at an anchor are compared in
blocks; of the links there only a spanning forest is kept, which loses no component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm.common import arrow_map, check_columns, materialise, own_columns, partitions, schema, whole_text
from orefold.llm.components import components

ALIKE = schema(doc_id=T.LongType(), point=T.LongType())
_BITS = 31


def words(text: str) -> list[bytes]:
    """UTF-8 words of a text, A-Z in lower case; bytes.lower and bytes.split know ASCII only."""
    return text.encode("utf-8", "replace").lower().split()


def fingerprint(text: str, width: int) -> int:
    """Bit set: it is set in over half of the hashes of all ``width``-word shingles."""
    import xxhash

    found = words(text)
    if not found:
        return 0
    digest = xxhash.xxh64_intdigest
    many = max(1, len(found) - width + 1)
    hashes = np.fromiter((digest(b" ".join(found[k: k + width]), 42) for k in range(many)), np.uint64, many)
    total = np.zeros(64, np.int64)
    for at in range(0, many, 1 << 16):
        part = hashes[at: at + (1 << 16)].astype("<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > many, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 4, keyed: bool = False) -> DataFrame:
    """(doc_id, point) of documents (doc_id, text): the 64 bits as a signed number. Null text: no words, 0.
    ``keyed`` adds text_key, a digest that equal texts share."""
    check_columns(docs, ["doc_id", "text"])

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(points.view(np.int64)), *batch.columns[2:]], names=[*ALIKE.names, *batch.schema.names[2:]])

    rows = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text"))
    if not keyed:
        return arrow_map(rows, convert, ALIKE)
    rows = rows.withColumn("text_key", F.sha2("text", 256))
    return arrow_map(rows, convert, "doc_id bigint, point bigint, text_key string")


# -- anchors ----------------------------------------------------------------------------------------


def _syndromes(halves: np.ndarray) -> np.ndarray:
    """XOR of the positions (1..31) of the set bits among the low 31; 0 for a code word."""
    out = np.zeros(len(halves), np.uint32)
    for bit in range(_BITS):
        out ^= ((halves >> np.uint32(bit)) & np.uint32(1)) * np.uint32(bit + 1)
    return out


def anchors(halves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the half, anchor) for all anchors within 2 of each 32-bit half."""
    s = _syndromes(halves)
    index = np.arange(len(halves))
    one = np.uint32(1)

    def flip(value: np.ndarray, position: np.ndarray) -> np.ndarray:
        return np.where(position > 0, value ^ (one << (np.maximum(position, 1) - 1).astype(np.uint32)), value)

    home = flip(halves, s)  # at distance 0 or 1
    free = one << np.uint32(31)
    rows, found = [index, index], [home, home ^ free]  # the free bit adds 1
    off = np.flatnonzero(s)
    for bit in range(1, _BITS + 1):  # pairs of positions whose XOR is the syndrome: distance 2
        other = s[off] ^ np.uint32(bit)
        take = other > bit
        rows.append(off[take])
        found.append(flip(flip(halves[off[take]], np.full(take.sum(), bit, np.uint32)), other[take]))
    return np.concatenate(rows), np.concatenate(found)


# -- links of equal distance ------------------------------------------------------------------------


def _at_anchors(points: DataFrame) -> DataFrame:
    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, 20_000):
                point = whole.column(0).slice(first, 20_000).to_numpy(zero_copy_only=False).view(np.uint64)
                for half in (0, 1):
                    part = ((point >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                    index, anchor = anchors(part)
                    key = anchor.astype(np.int64) | (half << 32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(point[index].view(np.int64))], names=["anchor", "point"])

    return arrow_map(points, copy, "anchor bigint, point bigint")


def _near(left: np.ndarray, right: np.ndarray, distance: int) -> np.ndarray:
    return np.bitwise_count(left[:, None] ^ right[None, :]) <= distance


def spanning_links(points: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the link graph: each point reached joins the block of its component.

    Reached points leave the rest, so a point is compared with what is left only once.
    """
    left, out = points.astype(np.uint64), []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            fresh = []
            for at in range(0, len(front), 256):
                block = front[at: at + 256]
                found = np.zeros(len(left), bool)
                for start in range(0, len(left), 1 << 14):
                    near = _near(block, left[start: start + (1 << 14)], distance)
                    hit = near.any(axis=0)
                    found[start: start + (1 << 14)] = hit
                    out.extend(zip(block[near.argmax(axis=0)[hit]].tolist(),
                                   left[start: start + (1 << 14)][hit].tolist()))
                fresh.append(left[found])
                left = left[~found]
                if not len(left):
                    break
            front = np.concatenate(fresh)
    return out


def whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of batches sorted by the first, cut so that no value of it is spread over two."""
    held: list[np.ndarray] = []
    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        now = [np.concatenate(x) for x in zip(held, now)] if held else now
        if not len(now[0]):
            continue
        cut = int(np.searchsorted(now[0], now[0][-1]))  # the last one may go on in the next batch
        if cut:
            yield [x[:cut] for x in now]
        held = [x[cut:] for x in now]
    if held and len(held[0]):
        yield held


def links(points: DataFrame, distance: int = 4) -> DataFrame:
    """Links (a, b) between distinct points that join exactly the points within ``distance`` of each other
    into components; at most 4 bits, as the anchors cover no more."""
    if distance > 4:
        raise ValueError("the anchors cover distances up to 4")
    placed = _at_anchors(points).repartition(partitions(points.sparkSession), "anchor").sortWithinPartitions("anchor", "point")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settle(keys: np.ndarray, points_: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(starts, len(keys)))
            found: list[tuple[int, int]] = []
            values = points_.view(np.uint64)
            two = starts[sizes == 2]
            a, b = values[two], values[two + 1]
            near = np.bitwise_count(a ^ b) <= distance
            found.extend(zip(a[near].tolist(), b[near].tolist()))
            for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                found.extend(spanning_links(values[start: start + size], distance))
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], names=["a", "b"])

        for keys, values in whole_keys(batches):
            yield settle(keys, values)

    found = arrow_map(placed, compare, "a bigint, b bigint")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _rooted(marked: DataFrame, distance: int) -> DataFrame:
    """(point, first, root) of all distinct points: the smallest doc_id, and a point that names the component."""
    points = materialise(marked.groupBy("point").agg(F.min("doc_id").alias("first")), "points")
    joined = components(links(points.select("point"), distance))
    return points.join(joined.withColumnRenamed("node", "point"), "point", "left").select(
        "point", "first", F.coalesce("root", "point").alias("root"))


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) of documents (doc_id, text).

    component_id is the smallest doc_id that links reach, the document itself included. Null text has no
    words and fingerprint zero, linked like any other; a null doc_id is never the smallest unless its
    component has no other; repeated rows are answered as often as they occur; no rows give no rows.
    """
    marked = materialise(fingerprints(docs, width), "fingerprints")
    named = _rooted(marked, distance)
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    # Only points with links need the smallest of others; the rest stand alone.
    result = marked.join(named.join(smallest, "root").select("point", "component_id"), "point")
    return result.select("doc_id", F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint"), "component_id")


# -- one document of each group ----------------------------------------------------------------------


@own_columns
def keep_one(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` with one document of each component of ``near_duplicates``: the one with the smallest doc_id.

    A row with a null doc_id stays only if its group has no other; of repeated rows one stays.
    """
    names = docs.columns
    marked = materialise(fingerprints(docs, width, keyed=True), "fingerprints")
    groups = materialise(marked.join(_rooted(marked, distance).select("point", "root"), "point").select(
        "doc_id", "text_key", "root"), "groups")
    # A row is known by doc_id and text. Texts of one doc_id may be in unlike groups, so groups go by their root.
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    known = groups.groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    best = groups.groupBy("root").agg(F.min(row).alias("best"))
    marked = known.join(best, "root").select(
        F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key"), "n", row.eqNullSafe(F.col("best")).alias("stays"))
    marked = materialise(marked.where("not stays or n > 1"), "marked")
    own = F.col("doc_id").cast("bigint").eqNullSafe(F.col("__doc")) & (F.col("__own") == F.col("__key"))
    rows = docs.withColumn("__own", F.sha2(whole_text(), 256)).join(marked.where("not stays").select("__doc", "__key"), own, "left_anti")
    repeated = marked.where("stays").select("__doc", "__key")
    if not repeated.isEmpty():
        one = rows.join(repeated, own, "left_semi").dropDuplicates(["doc_id", "__own"])
        rows = rows.join(repeated, own, "left_anti").unionByName(one)
    return rows.select(*[F.col(f"`{c}`") for c in names])
