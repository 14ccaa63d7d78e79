"""Brings repeated windows together: routes by content, so that equal windows meet in one shard.

Of each window (a run of ``width`` units of a text: words, or bytes) the gram with the smallest hash is its
anchor. Equal windows have equal anchors at equal places, and neighbouring windows mostly share one, so a
text becomes a list of stretches: runs of windows with one anchor. A stretch can only repeat if its anchor
gram does; those whose gram stands in one place only are dropped from the search (no repeat is lost), and
what is left is cut from the texts and handed to shards by anchor, equal contents as one row.

Copies of a text take part once, through the copy with the smallest doc_id.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.llm.common import arrow_map, discard, materialise, partitions, whole_text

#: Bits of a place that hold the number of windows of a stretch, less one.
COUNT_BITS = 10
_MIX = np.uint64(0x9E3779B97F4A7C15)
_LAST = (1 << 63) - 1


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring runs from theirs."""
    return (left * np.uint64(0xD6E8FEB86659FD93)) ^ (right + _MIX)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours: of a block's end and the next block's start."""
    many = len(x) - width + 1
    padded = np.concatenate([x, np.full(-len(x) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).reshape(-1)
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:many], ahead[width - 1: width - 1 + many])


def stretches(grams: np.ndarray, starts: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Stretches of texts laid end to end: text number, anchor hash, first window in the text, windows.

    ``grams`` has a hash for each unit place (those that reach over an end are ignored); ``starts`` the
    first place of each text, and the end. A stretch has at most ``width - gram + 1`` windows.
    """
    empty = np.zeros(0, np.int64)
    span = width - gram + 1
    total = int(starts[-1])
    if total < width:
        return empty, empty, empty, empty
    place = np.arange(total - gram + 1, dtype=np.uint64)
    low = np.uint64((1 << 30) - 1)
    if total > int(low):
        raise ValueError("a batch of texts is too long")
    least = _sliding_least((mix(grams[: len(place)]) & ~low) | place, span)
    anchor = (least & low).astype(np.int64)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    first = np.flatnonzero(text[: len(anchor)] == text[width - 1: width - 1 + len(anchor)])
    if not len(first):
        return empty, empty, empty, empty
    anchor, owner = anchor[first], text[first]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]))
    many = np.diff(np.append(new, len(first)))
    owner = owner[new]
    return owner, grams[anchor[new]].view(np.int64), first[new] - starts[owner], many


def batches_of(batch: pa.RecordBatch, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of few bytes, but at least a row; column ``text`` counts."""
    sizes = np.array([len(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()], np.int64)
    at = 0
    while at < len(sizes):
        many = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), most_bytes, side="right")))
        yield batch.slice(at, many)
        at += many


def _keyed(docs: DataFrame) -> DataFrame:
    digest = F.sha2(whole_text(), 256)
    return docs.select(F.col("doc_id").cast("bigint"), digest.alias("text_sha"),
                       F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").alias("key"), whole_text().alias("text"))


def survey(docs: DataFrame, width: int, gram: int, hashes: Callable, about: Callable, columns: str, purpose: str) -> DataFrame:
    """One stored row per document: row (its number, in order of storage), doc_id, key (of its text), text_sha, the operator's own ``columns`` from
    ``about(texts)``, and its stretches as arrays ``anchors`` and ``places``.

    ``hashes(texts, gram)`` gives gram hashes of the texts laid end to end, and the texts' starts.
    """
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        for whole in batches:
            for batch in batches_of(whole):
                texts = [t.encode("utf-8", "replace") for t in batch.column(3).to_pylist()]
                grams, starts = hashes(texts, gram)
                owner, anchor, first, many = stretches(grams, starts, width, gram)
                ends = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)), pa.int32())
                place = (first << COUNT_BITS) | (many - 1)
                lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int64())) for x in (anchor, place)]
                names, values = about(texts)
                number = pa.array(np.arange(row, row + len(texts)))
                row += len(texts)
                yield pa.RecordBatch.from_arrays([number, *batch.columns[:3], *values, *lists],
                                                 names=["row", "doc_id", "text_sha", "key", *names, "anchors", "places"])

    result = f"row bigint, doc_id bigint, text_sha string, key bigint, {columns}, anchors array<bigint>, places array<bigint>"
    return materialise(arrow_map(_keyed(docs), look, result), purpose)


def candidates(found: DataFrame, within: bool, purpose: str) -> DataFrame:
    """Stored (doc, key, stretches) of the texts with a stretch whose anchor gram repeats.

    ``within``: a repeat in the same text counts. Whether an anchor repeats is added up before the shuffle
    (its least and greatest text or place differ). The answer is a stored table with one row for each anchor,
    so both sides of the join are plain shuffles and Spark can split the rows of a hot anchor. Each text
    counts once, as its document with the smallest doc_id (null is last).
    """
    rows = found.select(F.explode(F.arrays_zip("anchors", "places")).alias("x"), "row")
    rows = rows.select(F.col("x.anchors").alias("anchor"), "row", F.col("x.places").alias("place"))
    # Row numbers are small and near each other, so these shuffles carry little but the anchors.
    spot = F.struct("row", "place") if within else F.col("row")
    repeated = materialise(rows.groupBy("anchor").agg(F.min(spot).alias("low"), F.max(spot).alias("high"))
                           .where("low <> high").select("anchor"), f"{purpose}-anchors")
    first = found.groupBy("text_sha").agg(F.min(F.struct(doc_or_last().alias("doc"), "row", "key")).alias("x")).select("x.*")
    lists = rows.join(repeated, "anchor").groupBy("row").agg(F.collect_list(F.struct("anchor", "place")).alias("stretches"))
    chosen = materialise(lists.join(first, "row").drop("row"), purpose)
    discard(repeated)
    return chosen


def with_texts(docs: DataFrame, lists: DataFrame, name: str) -> DataFrame:
    """(doc, key, text, ``name``) of the texts in ``lists`` (doc, key, ``name``), each once.

    Texts are shuffled when they are needed, not stored beside the documents.
    """
    texts = _keyed(docs).select(doc_or_last().alias("doc"), "key", "text")
    # Repeated rows have one doc and key; one of them stands for all.
    return texts.join(lists, ["doc", "key"]).groupBy("doc", "key").agg(
        F.any_value("text").alias("text"), F.any_value(name).alias(name))


def contents(docs: DataFrame, chosen: DataFrame, width: int, cut: Callable, purpose: str) -> DataFrame:
    """Stored (anchor, digest, content, doc, key, place) of every stretch of ``chosen``.

    ``cut(text, [(first, units)])`` gives the bytes of these runs of units.
    """
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = (1 << COUNT_BITS) - 1
        for whole in batches:
            for batch in batches_of(whole, 1 << 20):
                ids, keys, texts, lists = (c.to_pylist() for c in batch.columns)
                rows = []
                for doc, key, text, marks in zip(ids, keys, texts, lists):
                    runs = [(m["place"] >> COUNT_BITS, (m["place"] & mask) + width) for m in marks]
                    for m, content in zip(marks, cut(text.encode("utf-8", "replace"), runs)):
                        rows.append((m["anchor"], hashlib.md5(content).digest(), content, doc, key, m["place"]))
                kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)],
                    names=["anchor", "digest", "content", "doc", "key", "place"])

    result = "anchor bigint, digest binary, content binary, doc bigint, key bigint, place bigint"
    return materialise(arrow_map(with_texts(docs, chosen, "stretches"), take, result), purpose)


def distinct_contents(rows: DataFrame) -> DataFrame:
    """Equal contents as one row (anchor, digest, content, least doc, how many), added up before the shuffle,
    and dealt out by anchor."""
    once = rows.groupBy("anchor", "digest").agg(
        F.any_value("content").alias("content"), F.min("doc").alias("doc"), F.count(F.lit(1)).alias("many"))
    return once.repartition(partitions(rows.sparkSession), "anchor").sortWithinPartitions("anchor", "digest")


def shards(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[list[dict]]:
    """Rows in anchor order in lists of whole anchors, of about ``most_bytes`` where anchors allow."""
    held: list[dict] = []
    size = 0
    for batch in batches:
        for row in batch.to_pylist():
            if size >= most_bytes and row["anchor"] != held[-1]["anchor"]:
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row["content"])
    if held:
        yield held


def with_partner(anchors: list[int], contents: Sequence, grams: np.ndarray, starts: np.ndarray, width: int, gram: int,
                 freeze: Callable) -> list[int]:
    """Numbers of the contents that can share a window with another one of their anchor.

    Equal windows hold their anchor at one place, so they are equal in half of the units beside it, on the left
    or on the right at least. Contents that share neither half with one of their anchor are left out. ``grams`` and
    ``starts`` are those of the contents laid end to end; ``freeze`` turns a run of units into a key.
    """
    wanted = np.repeat(np.array(anchors, np.int64).view(np.uint64), np.diff(starts))
    found = np.flatnonzero(grams == wanted[: len(grams)])  # an anchor is the first of its kind in its stretch
    owner, first = np.unique(np.searchsorted(starts, found, side="right") - 1, return_index=True)
    half = (width - gram) // 2
    sides: list[tuple] = [()] * len(contents)
    for k, at in zip(owner.tolist(), (found[first] - starts[owner]).tolist()):
        units, end = contents[k], at + gram + half
        sides[k] = ((anchors[k], 0, freeze(units[at - half: at])) if at >= half else None,
                    (anchors[k], 1, freeze(units[at + gram: end])) if end <= len(units) else None)
    seen = Counter(side for pair in sides for side in pair if side)
    return [k for k, pair in enumerate(sides) if any(side and seen[side] > 1 for side in pair)]


def cover(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of half-open ranges, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], end)
        else:
            out.append((start, end))
    return out


def doc_or_last() -> Column:
    """doc_id, with null as the greatest number."""
    return F.coalesce("doc_id", F.lit(_LAST).cast("bigint"))
