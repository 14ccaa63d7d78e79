"""Byte-level repeats by suffix arrays: removes every byte covered by a string of ``width`` bytes that also
starts anywhere else.

Stretches of texts that may repeat come together by content (``windows``). A shard's stretches get a suffix
array by Larsson-Sadakane refinement: suffixes are sorted by their first bytes, then groups of equal ones by
the rank of what follows, with the sorted length doubling, and only groups that are not yet single. Kasai's
method, run over all stretches in step, gives common prefixes of neighbours in the array. A stretch set
too large for one shard is split, and the suffixes of one shard are looked up in the array of another by
binary search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.llm import windows
from orefold.llm.common import arrow_map, check_columns, free_shuffles, materialise

GRAM = 64
#: Bits of a place in a suffix array, and bytes of stretches that one array takes.
_PLACE = 21
SHARD = 2_000_000
#: Bytes that the first sort compares.
FIRST = 5


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that sorts like them; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(15, np.uint8)])
    out = np.empty(len(data) + 7, np.uint64)
    for k in range(8):
        part = np.frombuffer(padded[k: k + 8 * ((len(padded) - k) // 8)].tobytes(), ">u8").astype(np.uint64)
        out[k::8] = part[: len(out[k::8])]
    return out[: len(data)]


def byte_grams(texts: list[bytes], gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``gram`` bytes (a power of two, 8 at least) from every place of the texts laid end to end."""
    starts = np.cumsum([0, *map(len, texts)])
    hashes = words_at(np.frombuffer(b"".join(texts), np.uint8))
    hashes = windows.mix(hashes)
    reach = 8
    while reach < gram:
        if len(hashes) <= reach:
            return np.zeros(0, np.uint64), starts
        hashes = windows.join_hashes(hashes[:-reach], hashes[reach:])
        reach *= 2
    return hashes, starts


def suffix_array(data: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of strings laid end to end, sorted by the first ``depth`` bytes, and all ranks.

    ``ends`` has the end of its string for each byte; at least ``depth`` bytes are compared. A suffix ends with its string, and then sorts before
    longer ones; suffixes equal up to ``depth`` share a rank, the first place of their group, and stand in
    the order of their places.
    """
    n = len(data)
    if n >= 1 << _PLACE:
        raise ValueError("too many bytes for one suffix array")
    low, bits = np.uint64((1 << _PLACE) - 1), np.uint64(_PLACE)
    place = np.arange(n, dtype=np.int32)
    left = ends.astype(np.int32) - place
    size = np.minimum(left, FIRST)
    # Bytes past the end of the string do not count; the size tells them from real zeros. Key and place
    # in one number keep equal suffixes in the order of their places.
    short = (8 * (8 - size)).astype(np.uint64)
    key = ((words_at(data) >> short) << short) | (size.astype(np.uint64) << bits) | place.astype(np.uint64)
    key.sort()
    order = (key & low).astype(np.int32)
    key >>= bits
    new = np.concatenate([[True], key[1:] != key[:-1]])
    head = np.maximum.accumulate(np.where(new, place, 0))
    rank = np.empty(n, np.int32)
    rank[order] = head
    reach = FIRST
    while reach < depth:
        # Places of the array in groups of two or more whose suffix may go on beyond what is sorted.
        open_ = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))
        if not len(open_):
            break
        suffix = order[open_]
        beyond = suffix + np.minimum(reach, left[suffix] - 1)
        following = np.where(left[suffix] > reach, rank[beyond] + 1, 0)
        group = head[open_]
        key = (group.astype(np.uint64) << np.uint64(2 * _PLACE + 1)) | (following.astype(np.uint64) << bits)
        key |= np.arange(len(open_), dtype=np.uint64)
        key.sort()
        suffix = suffix[(key & low).astype(np.int32)]
        key >>= bits
        order[open_] = suffix
        new[open_] = np.concatenate([[True], key[1:] != key[:-1]])
        head[open_] = np.maximum.accumulate(np.where(new[open_], open_, 0))
        rank[suffix] = head[open_]
        reach *= 2
    return order.astype(np.int64), rank


def common_prefixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length, up to ``most``, of what each suffix shares with the one before it in the array, by place.

    Kasai: a suffix shares at most one byte less than the one that starts a byte earlier, which holds as
    the array is sorted by whole strings and equal suffixes by place. All strings advance together,
    comparing eight bytes at a time.
    """
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    words = words_at(np.concatenate([data, np.zeros(8, np.uint8)]))
    out = np.zeros(n, np.int64)
    string = np.arange(len(starts))
    shared = np.zeros(len(starts), np.int64)
    stop = np.append(starts[1:], n)
    for step in range(int((stop - starts).max(initial=0))):
        live = starts[string] + step < stop[string]
        string, shared = string[live], shared[live]
        at = starts[string] + step
        other = before[at]
        shared = np.maximum(shared - 1, 0)
        shared[other < 0] = 0
        limit = np.where(other < 0, 0, np.minimum(np.minimum(ends[at] - at, ends[other] - other), most))
        shared = np.minimum(shared, limit)
        grow = np.flatnonzero(shared < limit)
        while len(grow):
            differ = words[at[grow] + shared[grow]] ^ words[other[grow] + shared[grow]]
            same = np.where(differ == 0, 8, _leading_bytes(differ))
            now = np.minimum(shared[grow] + same, limit[grow])
            shared[grow] = now
            grow = grow[(same == 8) & (now < limit[grow])]
        out[at] = shared
    return out


def _leading_bytes(x: np.ndarray) -> np.ndarray:
    """Zero bytes at the front of numbers that are not zero."""
    out = np.zeros(len(x), np.int64)
    for shift in (32, 16, 8):
        high = (x >> np.uint64(64 - shift)) == 0
        out += np.where(high, shift // 8, 0)
        x = np.where(high, x << np.uint64(shift), x)
    return out


class Shard:
    """Suffix array of some contents."""

    def __init__(self, contents: list[bytes], width: int):
        self.width = width
        self.sizes = np.array([len(c) for c in contents])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(contents), np.uint8)
        self.ends = np.repeat(self.starts + self.sizes, self.sizes)
        self.order, _ = suffix_array(self.data, self.ends, int(self.sizes.max(initial=0)))

    def repeated(self) -> np.ndarray:
        """For each place: whether the ``width`` bytes from it on also start at another place."""
        shared = common_prefixes(self.data, self.starts, self.ends, self.order, self.width)
        in_order = shared[self.order] >= self.width
        out = np.zeros(len(self.data), bool)
        out[self.order[in_order]] = True
        out[self.order[np.flatnonzero(in_order) - 1]] = True
        return out

    def found_in(self, other: Shard) -> np.ndarray:
        """For each place: whether its ``width`` bytes start anywhere in ``other``, by binary search."""
        at = np.flatnonzero(self.ends - np.arange(len(self.data)) >= self.width)
        out = np.zeros(len(self.data), bool)
        mine, theirs = (words_at(np.concatenate([s.data, np.zeros(8, np.uint8)])) for s in (self, other))
        low, high = np.zeros(len(at), np.int64), np.full(len(at), len(other.order))
        while True:
            live = np.flatnonzero(low < high)
            if not len(live):
                break
            middle = (low[live] + high[live]) // 2
            place = other.order[middle]
            sign = self._compare(mine, at[live], theirs, place, other)
            out[at[live[sign == 0]]] = True
            low[live[sign > 0]] = middle[sign > 0] + 1
            high[live[sign < 0]] = middle[sign < 0]
            low[live[sign == 0]] = high[live[sign == 0]]
        return out

    def _compare(self, mine: np.ndarray, at: np.ndarray, theirs: np.ndarray, place: np.ndarray, other: Shard) -> np.ndarray:
        """Sign of own ``width`` bytes against a suffix of ``other``; one that is shorter and equal is less."""
        limit = np.minimum(other.ends[place] - place, self.width)
        sign = np.where(limit < self.width, 1, 0)
        open_ = np.arange(len(at))
        for step in range(0, self.width, 8):
            a, b = mine[at[open_] + step], theirs[np.minimum(place[open_] + step, len(theirs) - 1)]
            differ = a ^ b
            first = np.where(differ == 0, 8, _leading_bytes(np.where(differ == 0, np.uint64(1), differ)))
            inside = (first < 8) & (step + first < limit[open_])
            sign[open_[inside]] = np.where(a[inside] > b[inside], 1, -1)
            open_ = open_[(first == 8) & (step + 8 < limit[open_])]
            if not len(open_):
                break
        return sign


def repeated_windows(contents: list[bytes], width: int, shard: int = SHARD) -> list[np.ndarray]:
    """For each content: which of its ``width``-byte windows start elsewhere in the contents."""
    blocks: list[list[bytes]] = [[]]
    size = 0
    for c in contents:
        if size >= shard:
            blocks.append([])
            size = 0
        blocks[-1].append(c)
        size += len(c)
    built = [Shard(b, width) for b in blocks]
    out = []
    for k, one in enumerate(built):
        marks = one.repeated()
        for j, other in enumerate(built):
            if j != k:
                marks |= one.found_in(other)
        for start, many in zip(one.starts.tolist(), one.sizes.tolist()):
            out.append(marks[start: start + max(0, many - width + 1)])
    return out


def _ranges(marks: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return edges[::2].tolist(), edges[1::2].tolist()


def _about(texts: list[bytes]) -> tuple[list[str], list[pa.Array]]:
    return ["n_bytes"], [pa.array([len(t) for t in texts], pa.int64())]


def remove_repeats(docs: DataFrame, width: int = 400) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of documents (doc_id, text).

    ``spans`` are the removed byte ranges of the UTF-8 text, in order. Texts shorter than ``width`` lose
    nothing; null text is empty; copies, and repeated rows, lose everything else alike. Rows with a null
    doc_id are answered like any other.
    """
    check_columns(docs, ["doc_id", "text"])
    if width < 2 * GRAM or width - GRAM + 1 > 1 << windows.COUNT_BITS:
        raise ValueError(f"width must be within {2 * GRAM}..{(1 << windows.COUNT_BITS) + GRAM - 1}")
    found = windows.survey(docs, width, GRAM, byte_grams, _about, "n_bytes bigint", "byte-survey")
    chosen = windows.candidates(found, True, "byte-candidates")

    def cut(text: bytes, runs: list[tuple[int, int]]) -> list[bytes]:
        return [text[a: a + n] for a, n in runs]

    rows = windows.contents(docs, chosen, width, cut, "byte-stretches")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in windows.shards(batches, SHARD):
            groups: dict[int, int] = {}
            for r in held:
                groups[r["anchor"]] = groups.get(r["anchor"], 0) + 1
            # A content that stands in two places repeats as a whole; one that is alone with its anchor never.
            sought = [r for r in held if groups[r["anchor"]] > 1]
            contents = [r["content"] for r in sought]
            paired = windows.with_partner([r["anchor"] for r in sought], contents, *byte_grams(contents, GRAM), width, GRAM, bytes)
            sought = [sought[k] for k in paired]
            if any(r["many"] < 2 for r in sought):
                needed = {r["anchor"] for r in sought if r["many"] < 2}
                sought = [r for r in sought if r["anchor"] in needed]
                marks = repeated_windows([r["content"] for r in sought], width)
            else:
                sought, marks = [], []
            by_row = {r["digest"] + r["anchor"].to_bytes(8, "little", signed=True): m for r, m in zip(sought, marks)}
            out = []
            for r in held:
                if r["many"] > 1:
                    out.append((r["anchor"], r["digest"], [0], [len(r["content"]) - width + 1]))
                    continue
                m = by_row.get(r["digest"] + r["anchor"].to_bytes(8, "little", signed=True))
                if m is not None and m.any():
                    out.append((r["anchor"], r["digest"], *_ranges(m)))
            kinds = [pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 4, kinds)],
                                             names=["anchor", "digest", "first", "last"])

    marked = materialise(arrow_map(windows.distinct_contents(rows), search,
                                   "anchor bigint, digest binary, first array<int>, last array<int>"), "byte-marks")
    spots = rows.select("anchor", "digest", "doc", "key", "place").join(marked, ["anchor", "digest"])
    lists = spots.groupBy("doc", "key").agg(F.collect_list(F.struct("place", "first", "last")).alias("marks"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_, keys, texts, lists_ = (c.to_pylist() for c in batch.columns)
            removed, spans, digests = [], [], []
            for text, marks in zip(texts, lists_):
                data = text.encode("utf-8", "replace")
                ranges = [(start + f, start + e + width - 1) for m in marks for start in [m["place"] >> windows.COUNT_BITS]
                          for f, e in zip(m["first"], m["last"])]
                gone = windows.cover(ranges)
                kept, at = hashlib.sha256(), 0
                for a, b in gone:
                    kept.update(data[at:a])
                    at = b
                kept.update(data[at:])
                removed.append(sum(b - a for a, b in gone))
                spans.append([{"start": a, "end": b} for a, b in gone])
                digests.append(kept.hexdigest())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs_, pa.int64()), pa.array(keys, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, kind), pa.array(digests, pa.string())], names=["doc", "key", "removed", "spans", "sha"])

    done = arrow_map(windows.with_texts(docs, lists, "marks"), remove,
                     "doc bigint, key bigint, removed bigint, spans array<struct<start:bigint,end:bigint>>, sha string")
    base = found.select("doc_id", windows.doc_or_last().alias("doc"), "key", "text_sha", "n_bytes")
    copies = base.groupBy("text_sha").agg(F.count(F.lit(1)).alias("copies"))
    joined = base.join(copies, "text_sha").join(done, ["doc", "key"], "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= width)
    span = F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_bytes").alias("end"))
    spans = F.when(whole, F.array(span)).otherwise(F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")))
    free_shuffles(docs.sparkSession)
    return joined.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.size(spans).cast("bigint").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("sha", "text_sha")).alias("kept_sha256"), spans.alias("spans"))
