"""Best-fit packing of documents into sequences of bounded length, in bulk-synchronous supersteps.

Pieces are put in order by length (longest first) and, within a length, by rank. A superstep takes the
longest length that still has pieces, sweeps the open gaps upward to the successor (the smallest gap that
holds it) and matches pieces and gaps by rank, so that no gap is given twice: the k-th piece goes to the
k-th gap of that size. The matched gaps shrink and come back as gaps of the smaller size for the next
sweep; when no gap is large enough, new sequences open. Sweeps repeat until every piece has a place.

Pieces of one length are interchangeable, and so are runs of gaps of one size. The sweeps therefore run
over lengths and runs (at most ``limit`` lengths; every sweep adds at most one run) and need only the
count of pieces of each length, which Spark adds up. The rows themselves stay in place: their ranks come
from counts by (length, bucket), and each row looks up the sweep that its rank belongs to. A length that
a third of all rows share is spread over all buckets.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm import tokens
from orefold.llm.common import arrow_map, check_columns, materialise, only, partitions, schema, whole_text

PIECES = schema(doc_id=T.LongType(), piece=T.IntegerType(), start=T.LongType(), length=T.LongType(),
                ids_crc32=T.LongType())


def token_pieces(docs: DataFrame, tokenizer: str, limit: int = 4096, end_id: int = 1) -> DataFrame:
    """Documents (doc_id, text) as pieces of at most ``limit`` ids.

    A document's ids are those of its whole text and ``end_id``; null text counts as empty. Only longer
    documents are cut. Repeated rows are documents of their own; a null doc_id stays null.
    """
    check_columns(docs, ["doc_id", "text"])
    arrow = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                       ("length", pa.int64()), ("ids_crc32", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokens.load(tokenizer, spaced=False)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = words.encode(text) + end
                for number, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at: at + 4 * limit]
                    rows.append((doc_id, number, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 5, arrow)], schema=arrow)

    texts = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text"))
    return arrow_map(texts, cut, PIECES)


def sweeps(counts: dict[int, int], limit: int) -> np.ndarray:
    """All matches as rows (length, first rank, first sequence, offset), ordered by length and rank."""
    sizes: list[int] = []  # of open gaps, ascending
    runs: dict[int, list[tuple[int, int]]] = {}  # gap size -> runs of sequences (first, how many)
    opened, out = 0, []

    def put(size: int, first: int, many: int) -> None:
        if size and many:
            if size not in runs:
                runs[size] = []
                insort(sizes, size)
            runs[size].append((first, many))

    for length in sorted(counts, reverse=True):
        if not 1 <= length <= limit:
            raise ValueError(f"length {length} is not within 1..{limit}")
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                new = -(-left // (limit // length))
                put(limit, opened, new)
                opened += new
                continue
            size = sizes[at]
            first, many = runs[size].pop()
            if not runs[size]:
                del runs[size], sizes[at]
            matched = min(many, left)
            out.append((length, rank, first, limit - size))
            put(size, first + matched, many - matched)
            put(size - length, first, matched)
            rank, left = rank + matched, left - matched
    table = np.array(out, np.int64).reshape(-1, 4)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def pack(pieces: DataFrame, order: list[str], limit: int = 4096) -> DataFrame:
    """Adds sequence_id and offset to a stored table of pieces.

    ``length`` is 1..``limit`` (null raises); ``order`` names columns that tell pieces apart. Rows equal in all
    of them take places of their own. An empty table gives an empty result. ``pieces`` is read three
    times, so pass a written table.
    """
    check_columns(pieces, ["length", *order])
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``limit`` rows
    if None in counts:
        raise ValueError("a piece has no length")
    table = sweeps(counts, limit)
    buckets = max(partitions(spark), sum(counts.values()) // 200_000)
    rows = pieces.withColumn("__bucket", F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(buckets)))
    within = Window.partitionBy("length", "__bucket")
    ranked = rows.withColumn("__rank", F.row_number().over(within.orderBy(*order)) - 1)
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("length", "__bucket").count().select(
        "length", "__bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    ranked = ranked.join(offsets, ["length", "__bucket"]).select(
        *[F.col(c) for c in pieces.columns], (F.col("__rank") + F.col("__before")).alias("__rank"))
    sent = spark.sparkContext.broadcast(table)  # one row for each sweep, however many pieces there are

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sent.value
        keys = (found[:, 0] << 44) | found[:, 1]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                            for c in ("length", "__rank"))
            at = np.searchsorted(keys, (length.astype(np.int64) << 44) | rank, side="right") - 1
            names = [n for n in batch.schema.names if n != "__rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(n)) for n in names]
                + [pa.array(found[at, 2] + rank - found[at, 1]), pa.array(found[at, 3])],
                names=[*names, "sequence_id", "offset"])

    kept = pieces.schema.fields + schema(sequence_id=T.LongType(), offset=T.LongType()).fields
    return arrow_map(ranked, place, T.StructType(kept))


def pack_documents(docs: DataFrame, tokenizer: str, limit: int = 4096, end_id: int = 1) -> DataFrame:
    """Tokenises, cuts and packs; one row per piece."""
    pieces = materialise(token_pieces(only(docs, "doc_id", "text"), tokenizer, limit, end_id), "pieces")
    return pack(pieces, ["doc_id", "piece", "ids_crc32"], limit)
