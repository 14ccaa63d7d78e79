"""Ranked lexical search: a document FP-tree, searched per item by branch and bound.

Documents are cut down to the terms that occur in any item. Dealt into shards of about equal numbers
of postings, each shard orders a document's terms by frequency in the corpus, so that documents with the
same frequent terms share a path of a trie. A node keeps, for its subtree, the largest tf of each term and the
smallest length measure m. No document below it can score higher than these together, so an item goes
through the trie depth first, best child first, and leaves out subtrees that cannot beat its k-th
document so far. Few documents below one node are kept as one bucket and scored exactly at once. The best of
all shards are ranked per item; ranks are limited within each task before rows move.

Items are dealt into blocks of bounded size; a shard meets one block at a time. Terms that no item has are sorted
out where texts are read by a bit table of fixed size; the few that slip through are dropped by the exact lookup in
the shard. All counts cover all documents.

Odd rows: a null or empty text has no term and is not ranked, an item without known terms has no rows; null doc_ids sort
last among equal scores; repeated documents are ranked each; repeated items (equal item_id and text) count once,
different texts under one item_id are ranked apart. Empty tables give an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orefold.llm.common import arrow_map, check_columns, lower_words, materialise, only, ship, whole_text

#: Bits of the table that sorts out terms of no item: its size does not depend on the data.
TABLE_BITS = 1 << 21
#: Postings in a shard, items and item terms in a block, documents that are scored at once.
SHARD, BLOCK_ITEMS, BLOCK_TERMS, BUCKET = 500_000, 256, 32_768, 64
#: Numbers in the tf maxima of one shard: with many terms, buckets are larger.
MAXIMA = 16_000_000
#: Terms of which a worker remembers whether the bit table has them.
REMEMBERED = 500_000
VECTORS = "terms string, counts binary, length bigint"
_LAST = np.iinfo(np.int64).max


class _Wanted(dict):
    """Term -> whether it may occur in an item."""

    def __init__(self, bits: bytes):
        super().__init__()
        self.bits = bits

    def __missing__(self, term: bytes) -> bool:
        place = zlib.crc32(term) % TABLE_BITS
        found = bool(self.bits[place >> 3] >> (place & 7) & 1)
        if len(self) < REMEMBERED:
            self[term] = found
        return found


def term_counts(rows: DataFrame, bits: bytes | None = None) -> DataFrame:
    """Replaces ``text`` by the distinct terms of the whole text (blank-separated), their counts (32-bit little-endian)
    and the number of all terms. With ``bits``, terms that the table lacks are left out."""
    kept = [f for f in rows.schema.fields if f.name != "text"]
    names = [f.name for f in kept]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _Wanted(bits) if bits is not None else None
        for batch in batches:
            terms, counts, lengths = [], [], []
            for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                words = lower_words(text)
                found = Counter(words)
                if wanted is not None:
                    found = {t: n for t, n in found.items() if wanted[t]}
                terms.append(b" ".join(found))
                counts.append(np.fromiter(found.values(), "<u4", len(found)).tobytes())
                lengths.append(len(words))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(batch.schema.get_field_index(n)) for n in names],
                 pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counts, pa.binary()), pa.array(lengths, pa.int64())],
                [*names, "terms", "counts", "length"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return arrow_map(rows.withColumn("text", whole_text().cast("binary")), count, f"{kinds}, {VECTORS}")


def bit_table(items: DataFrame) -> bytes:
    """The places of all item terms; at most one short row per 64 bits comes to the driver."""
    place = F.crc32(F.col("term").cast("binary")) % TABLE_BITS
    words = _exploded(items).select(place.alias("p")).selectExpr("p div 64 as word", "shiftleft(1L, cast(p % 64 as int)) as bit")
    table = np.zeros(TABLE_BITS // 64, np.uint64)
    for word, bits in words.groupBy("word").agg(F.bit_or("bit")).collect():
        table[word] = bits & 0xFFFFFFFFFFFFFFFF
    return table.astype("<u8").tobytes()


def _exploded(vectors: DataFrame, *keep: str) -> DataFrame:
    return vectors.where("terms <> ''").select(*keep, F.explode(F.split("terms", " ")).alias("term"))


def _unpacked(vectors: DataFrame) -> DataFrame:
    """One row for each term with its count, in ``term`` and ``repeats``."""
    kept = [f for f in vectors.schema.fields if f.name not in ("terms", "counts")]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, terms in enumerate(batch.column(batch.schema.get_field_index("terms")).to_pylist()):
                counts = np.frombuffer(batch.column(batch.schema.get_field_index("counts"))[k].as_py(), "<u4").astype(np.int64)
                if len(counts):
                    row = batch.slice(k, 1).take(pa.array([0] * len(counts)))
                    yield pa.RecordBatch.from_arrays(
                        [*[row.column(row.schema.get_field_index(f.name)) for f in kept], pa.array(terms.split(" ")), pa.array(counts)],
                        [*[f.name for f in kept], "term", "repeats"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return arrow_map(vectors, unpack, f"{kinds}, term string, repeats bigint")


class Shard:
    """The FP-tree of some documents over the terms of a block of items."""

    def __init__(self, ids: np.ndarray, measures: np.ndarray, starts: np.ndarray, ranks: np.ndarray, counts: np.ndarray,
                 many_terms: int, bucket: int = BUCKET):
        """Postings of document k are ``ranks[starts[k]:starts[k + 1]]`` (ascending: most frequent term first) and counts."""
        keys = [ranks[a:b].astype(">u4").tobytes() for a, b in zip(starts, starts[1:])]
        order = sorted(range(len(ids)), key=keys.__getitem__)  # documents that share a path are neighbours now
        self.ids, self.measures = ids[order], measures[order]
        spans = [slice(starts[k], starts[k + 1]) for k in order]
        self.ranks = np.concatenate([ranks[s] for s in spans]) if spans else ranks
        self.counts = np.concatenate([counts[s] for s in spans]) if spans else counts
        lengths = np.array([len(keys[k]) // 4 for k in order], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        shared = np.zeros(len(order), np.int64)  # length of the path shared with the document before
        for k in range(1, len(order)):
            a, b = self._path(k - 1), self._path(k)
            size = min(len(a), len(b))
            differ = np.flatnonzero(a[:size] != b[:size])
            shared[k] = differ[0] if len(differ) else size
        bucket = max(bucket, -(-2 * len(order) * many_terms // MAXIMA))
        self._grow(shared, many_terms, bucket)

    def _path(self, k: int) -> np.ndarray:
        return self.ranks[self.starts[k]:self.starts[k + 1]]

    def _grow(self, shared: np.ndarray, many_terms: int, bucket: int) -> None:
        """Nodes as document ranges; children have higher numbers than their parent and stand together."""
        self.low, self.high, self.children = [0], [len(shared)], []
        at = 0
        while at < len(self.low):
            low, high = self.low[at], self.high[at]
            self.children.append(None)
            if high - low > bucket:
                inner = shared[low + 1:high]
                cuts = [low, *(np.flatnonzero(inner == inner.min()) + low + 1).tolist(), high]
                first, start = len(self.low), low
                for a, b in zip(cuts, cuts[1:]):  # small branches side by side make one bucket
                    if b - start > bucket and a > start:
                        self._add(start, a)
                        start = a
                self._add(start, high)
                self.children[at] = (first, len(self.low))
            at += 1
        many = len(self.low)
        self.maxima = np.zeros((many, many_terms), np.int64)
        self.least, self.first_id = np.full(many, _LAST), np.full(many, _LAST)
        for node in range(many - 1, -1, -1):
            low, high = self.low[node], self.high[node]
            if self.children[node]:
                own = slice(*self.children[node])
                self.maxima[node] = self.maxima[own].max(0)
                self.least[node], self.first_id[node] = self.least[own].min(), self.first_id[own].min()
            elif high > low:
                span = slice(self.starts[low], self.starts[high])
                np.maximum.at(self.maxima[node], self.ranks[span], self.counts[span])
                self.least[node], self.first_id[node] = self.measures[low:high].min(), self.ids[low:high].min()

    def _add(self, low: int, high: int) -> None:
        self.low.append(low)
        self.high.append(high)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of the ``best`` documents: highest score first, then lowest id."""
        found, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        if not len(self.ids):
            return found, scores
        dense = np.zeros(self.maxima.shape[1], np.int64)
        dense[terms] = weights
        stack = [(_LAST, -1, 0)]
        while stack:
            bound, lowest, node = stack.pop()
            full = len(found) == best
            if full and (bound < scores[-1] or bound == scores[-1] and lowest > self.ids[found[-1]]):
                continue
            if self.children[node] is None:
                low, high = self.low[node], self.high[node]
                of, score = self._scores(low, high, dense)
                if len(of):
                    found, scores = np.concatenate([found, of]), np.concatenate([scores, score])
                    order = np.lexsort((self.ids[found], -scores))[:best]
                    found, scores = found[order], scores[order]
                continue
            first, last = self.children[node]
            most = self.maxima[first:last][:, terms]
            bounds = (weights * (1_000_000_000 * most // (1000 * most + 12 * self.least[first:last, None]))).sum(1)
            ids = self.first_id[first:last]
            for k in np.lexsort((-ids, bounds)):  # the last one pushed is visited first
                if bounds[k] > 0:
                    stack.append((bounds[k], ids[k], first + int(k)))
        return found, scores

    def _scores(self, low: int, high: int, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = self.starts[low]
        weights = dense[self.ranks[start:self.starts[high]]]
        hits = np.flatnonzero(weights)
        of = np.searchsorted(self.starts, hits + start, "right") - 1
        tf = self.counts[hits + start]
        scores = np.zeros(high - low, np.int64)
        np.add.at(scores, of - low, weights[hits] * (1_000_000_000 * tf // (1000 * tf + 12 * self.measures[of])))
        hit = np.flatnonzero(scores > 0)
        return hit + low, scores[hit]


def grow_shard(vectors: pa.Table, ranks: dict[str, int], documents: int, total: int) -> Shard:
    """A shard from stored vectors, cut down to the terms of ``ranks``."""
    get = ranks.get
    found = [[get(t, -1) for t in terms.split(" ")] if terms else [] for terms in vectors["terms"].to_pylist()]
    lengths = np.array([len(f) for f in found], np.int64)
    all_ranks = np.array([r for f in found for r in f], np.int64)
    counts = np.frombuffer(b"".join(vectors["counts"].to_pylist()), "<u4").astype(np.int64)
    of = np.repeat(np.arange(len(found)), lengths)
    order = np.lexsort((all_ranks, of))
    order = order[all_ranks[order] >= 0]
    sizes = np.bincount(of[order], minlength=len(found))
    kept = np.flatnonzero(sizes)
    starts = np.concatenate([[0], np.cumsum(sizes[kept])]).astype(np.int64)
    ids = vectors["doc_id"].fill_null(_LAST).to_numpy()
    measures = np.array([75 + 25 * n * documents // total for n in vectors["length"].to_pylist()], np.int64)
    return Shard(ids[kept], measures[kept], starts, all_ranks[order], counts[order], len(ranks))


def search(docs: DataFrame, items: DataFrame, best: int = 20, shard: int = SHARD) -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` documents of each item with a score above 0."""
    check_columns(docs, ["doc_id", "text"])
    check_columns(items, ["item_id", "text"])
    asked = term_counts(only(items, "item_id", "text").distinct()).withColumn("item", F.monotonically_increasing_id())
    asked = materialise(asked.withColumnRenamed("length", "item_length"), "lexical-items")
    vectors = term_counts(only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint")), bit_table(asked))
    vectors = materialise(vectors.where("length > 0").withColumn("row", F.monotonically_increasing_id()), "lexical-vectors")
    documents, total, postings = vectors.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.coalesce(F.sum(F.expr("octet_length(counts) div 4")), F.lit(0))).first()
    many_items, item_terms = asked.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.expr("octet_length(counts) div 4")), F.lit(0))).first()
    shards = max(1, -(-postings // shard))
    blocks = max(1, -(-many_items // BLOCK_ITEMS), -(-item_terms // BLOCK_TERMS))

    held = _exploded(vectors).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(documents) + 2) / (2 * F.col("df") + 1)))
    repeats = _unpacked(asked.select("item", "item_id", "terms", "counts"))
    weighed = repeats.join(held, "term").groupBy("item", "item_id").agg(
        F.collect_list(F.struct("term", "df", (F.col("repeats") * weight).alias("weight"))).alias("terms"))
    weighed = weighed.select(
        "item", "item_id", "terms", F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"))
    dealt = vectors.select(
        "doc_id", "length", "terms", "counts", F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"))
    ship(docs.sparkSession)

    def best_of(left: pa.Table, right: pa.Table) -> pa.Table:
        asked_terms = right["terms"].to_pylist()
        frequency = {t["term"]: t["df"] for terms in asked_terms for t in terms}
        ranks = {t: k for k, t in enumerate(sorted(frequency, key=lambda t: (-frequency[t], t)))}
        tree = grow_shard(left, ranks, documents, total) if left.num_rows and ranks else None
        rows, found, scores = [], [], []
        for k, terms in enumerate(asked_terms if tree else []):
            places = np.array([ranks[t["term"]] for t in terms], np.int64)
            of, score = tree.search(places, np.array([t["weight"] for t in terms], np.int64), best)
            rows += [k] * len(of)
            found.append(tree.ids[of])
            scores.append(score)
        ids = np.concatenate(found) if found else np.empty(0, np.int64)
        return pa.table({
            "item": right["item"].take(pa.array(rows, pa.int64())), "item_id": right["item_id"].take(pa.array(rows, pa.int64())),
            "doc_id": pa.array(ids, pa.int64(), mask=ids == _LAST),
            "score": pa.array(np.concatenate(scores) if scores else np.empty(0, np.int64), pa.int64())})

    kind = items.schema["item_id"].dataType.simpleString()
    tops = dealt.groupBy("shard", "block").cogroup(weighed.groupBy("shard", "block")).applyInArrow(
        best_of, f"item bigint, item_id {kind}, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return tops.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select("item_id", "rank", "doc_id", "score")
