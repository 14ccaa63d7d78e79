"""Token-id files: canonical length-limited Huffman codes from global counts.

Texts are tokenised once, into plain files of ids by ranges of doc_id; the counts of all of them give the code, and
each plain file becomes a coded one. A file holds one key range of documents in ascending order:

    magic, header (JSON: counts, block size, longest code), code lengths of all ids (zlib),
    document ids and token counts, bit offsets of the blocks, code words (big-endian, 32-bit)

Every ``BLOCK`` ids start a block whose bit offset is stored, so blocks decode on their own: the reader
advances all blocks of a file together, one table look-up for each id of a block.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm import tokens
from orefold.llm.common import arrow_map, check_columns, free_shuffles, partitions, schema, whole_text
from orefold.session import work_dir

MAGIC = b"OREHUFF1"
BLOCK = 1024
LONGEST = 18
#: Ids encoded at once, to bound memory; each such slice starts a new block.
SLICE = BLOCK << 9
#: Ids after which a task starts a new file, which bounds memory and the size of a file; files of one task at most.
FILE = 1 << 24
FILES = 1 << 20
RESULT = schema(file=T.LongType(), doc_id=T.LongType(), start=T.LongType(), n_tokens=T.LongType(),
                ids_crc32=T.LongType())


# -- codes ------------------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Lengths of the best prefix code with none over ``longest`` (package-merge); 0 for unused ids."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids do not fit codes of {longest} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64)
    leaf, packages = [], np.zeros(0)
    for _ in range(longest):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        leaf.append(order < len(weights))
        merged = merged[order]
        pairs = len(merged) // 2
        packages = merged[: 2 * pairs].reshape(-1, 2).sum(axis=1)
    need, depth = 2 * len(used) - 2, np.zeros(len(used), np.int64)
    for is_leaf in reversed(leaf):
        leaves = int(is_leaf[:need].sum())
        depth[:leaves] += 1
        need = 2 * (need - leaves)
    out[used] = depth
    return out


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of each id, and the ids in code order: by length, then id."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    step = np.int64(1) << (32 - lengths[order].astype(np.int64))
    first = np.concatenate([[0], np.cumsum(step)[:-1]])
    codes = np.zeros(len(lengths), np.int64)
    codes[order] = first >> (32 - lengths[order].astype(np.int64))
    return codes, order


def encode(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Code words of ``ids`` and the bit offset of every block."""
    parts, marks, bits = [], [], 0
    for at in range(0, len(ids), SLICE):
        part = ids[at: at + SLICE]
        size = lengths[part].astype(np.int64)
        if not size.all():
            raise ValueError("an id has no code")
        end = np.cumsum(size)
        start = end - size
        marks.append(start[::BLOCK] + bits)
        word, shift = start >> 5, start & 31
        value = codes[part].astype(np.uint64) << (64 - size - shift).astype(np.uint64)
        many = int(end[-1] + 31 >> 5)
        # Bits of different codes do not overlap, so sums of whole numbers below 2**32 put them together.
        words = np.bincount(word, weights=(value >> np.uint64(32)).astype(np.float64), minlength=many + 1)
        words += np.bincount(word + 1, weights=(value & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=many + 1)[: many + 1]
        parts.append(words[:many].astype(">u4").tobytes())
        bits += 32 * many
    return b"".join(parts), np.concatenate(marks) if marks else np.zeros(0, np.int64)


def decode(payload: bytes, marks: np.ndarray, n: int, lengths: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """The ids again; all blocks advance together."""
    _, order = canonical(lengths)
    size = lengths[order].astype(np.int64)
    table = np.repeat(order.astype(np.uint32), np.int64(1) << (longest - size))
    width = np.repeat(size.astype(np.uint8), np.int64(1) << (longest - size))
    pad = (1 << longest) - len(table)
    table, width = np.pad(table, (0, pad)), np.pad(width, (0, pad))
    words = np.concatenate([np.frombuffer(payload, ">u4").astype(np.uint64), np.zeros(2, np.uint64)])
    out = np.zeros((len(marks), BLOCK), np.uint32)
    most, mask = len(words) - 2, np.uint64((1 << longest) - 1)
    for first in range(0, len(marks), 4096):
        at = marks[first: first + 4096].astype(np.int64)
        for step in range(BLOCK):
            word = np.minimum(at >> 5, most)
            both = (words[word] << np.uint64(32)) | words[word + 1]
            peek = (both >> (64 - longest - (at & 31)).astype(np.uint64)) & mask
            out[first: first + 4096, step] = table[peek]
            at += width[peek]
    return out.reshape(-1)[:n]


# -- files ------------------------------------------------------------------------------------------


def pack_file(doc_ids: list[int | None], sizes: list[int], ids: np.ndarray, lengths: np.ndarray) -> bytes:
    codes, _ = canonical(lengths)
    payload, marks = encode(ids, lengths, codes)
    packed = zlib.compress(lengths.tobytes())
    head = json.dumps({"docs": len(doc_ids), "tokens": len(ids), "block": BLOCK, "longest": LONGEST,
                       "nulls": [k for k, d in enumerate(doc_ids) if d is None], "lengths": len(packed)}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, packed,
                     np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array(sizes, "<i8").tobytes(),
                     marks.astype("<i8").tobytes(), payload])


def pack_plain(doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    """Ids before the counts of all of them are known, each place of their bytes compressed apart; for ``unpack_plain``."""
    places = ids.view(np.uint8).reshape(-1, ids.itemsize).T.tobytes()
    head = json.dumps({"docs": len(doc_ids), "kind": ids.dtype.str,
                       "nulls": [k for k, d in enumerate(doc_ids) if d is None]}).encode()
    return b"".join([struct.pack("<I", len(head)), head, np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                     np.array(sizes, "<i8").tobytes(), pa.compress(places, "zstd", asbytes=True)])


def unpack_plain(content: bytes) -> tuple[list[int | None], list[int], np.ndarray]:
    at = 4 + struct.unpack_from("<I", content)[0]
    head = json.loads(content[4: at])
    many = head["docs"]
    docs = np.frombuffer(content, "<i8", many, at).tolist()
    for k in head["nulls"]:
        docs[k] = None
    sizes = np.frombuffer(content, "<i8", many, at + 8 * many).tolist()
    kind, total = np.dtype(head["kind"]), sum(sizes)
    places = pa.decompress(memoryview(content)[at + 16 * many:], kind.itemsize * total, "zstd", asbytes=True)
    return docs, sizes, np.frombuffer(places, np.uint8).reshape(kind.itemsize, total).T.copy().view(kind).reshape(-1)


def unpack_file(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their token counts, and all token ids."""
    if content[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token file")
    at = len(MAGIC) + 4
    (size,) = struct.unpack("<I", content[len(MAGIC): at])
    head = json.loads(content[at: at + size])
    at += size
    lengths = np.frombuffer(zlib.decompress(content[at: at + head["lengths"]]), np.uint8)
    at += head["lengths"]

    def longs(n: int) -> np.ndarray:
        nonlocal at
        at += 8 * n
        return np.frombuffer(content[at - 8 * n: at], "<i8")

    docs, sizes, marks = longs(head["docs"]).tolist(), longs(head["docs"]), longs(-(-head["tokens"] // BLOCK))
    for k in head["nulls"]:
        docs[k] = None
    return docs, sizes, decode(content[at:], marks, head["tokens"], lengths, head["longest"])


def _put(store, path: str, content: bytes) -> None:
    """Writes a file under a name of its own first, so that a repeated task replaces it whole."""
    folder, name = os.path.split(path)
    store.create_dir(folder, recursive=True)
    new = os.path.join(folder, f".{name}-{uuid.uuid4().hex}")
    with store.open_output_stream(new) as stream:
        stream.write(content)
    store.move(new, path)


def tokenise(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Puts the ids of all documents into plain files in ascending doc_id order (null first; ties by text, digest first).

    Returns how often each id occurs, and (file, tokens). The digest lets a doc_id of many rows, or null, reach over
    several tasks. A task starts a new file after FILE ids. One row for each id and task, and for each file, is shuffled.
    """
    many = partitions(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        words, task = tokens.load(tokenizer, spaced=True), TaskContext.get().partitionId()
        store, path = fs.FileSystem.from_uri(folder)
        kind = "<u2" if words.library.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else "<u4"
        total, files = np.zeros(end_id + 1, np.int64), []
        doc_ids, sizes, parts, held = [], [], [], 0

        def flush() -> None:
            nonlocal total, doc_ids, sizes, parts, held
            ids = np.concatenate(parts)
            n = np.bincount(ids, minlength=len(total))
            n[: len(total)] += total
            number = task * FILES + len(files)
            if len(files) == FILES:
                raise ValueError("a task has too many files; raise the number of shuffle partitions")
            _put(store, os.path.join(path, f"{number:012d}.plain"), pack_plain(doc_ids, sizes, ids))
            files.append((number, held))
            total, doc_ids, sizes, parts, held = n, [], [], [], 0

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(words.encode(text) + end, "<u4").astype(kind)
                parts.append(part)
                doc_ids.append(doc_id)
                sizes.append(len(part))
                held += len(part)
                if held >= FILE:
                    flush()
        if parts:
            flush()
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([
            pa.array([*[f for f, _ in files], *[None] * len(used)], pa.int64()),
            pa.array([*[None] * len(files), *used.tolist()], pa.int64()),
            pa.array([*[n for _, n in files], *total[used].tolist()], pa.int64())], names=["file", "id", "n"])

    texts = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = texts.repartitionByRange(many, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    rows = arrow_map(ordered.select("doc_id", "text"), write, "file bigint, id bigint, n bigint")
    # At most one row for each id of the vocabulary and for each file reaches the driver.
    found = rows.groupBy("file", "id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max([r["id"] for r in found if r["file"] is None], default=0) + 1, np.int64)
    for r in found:
        if r["file"] is None:
            counts[r["id"]] = r["n"]
    return counts, sorted((r["file"], r["n"]) for r in found if r["file"] is not None)


def write_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0) -> list[tuple[int, int]]:
    """Writes all documents in ascending doc_id order (null first; ties by text, digest first); returns (file, tokens).

    Texts are tokenised once, in order, into plain files that a second pass codes one by one.
    """
    check_columns(docs, ["doc_id", "text"])
    spark = docs.sparkSession
    plain = work_dir(spark, "token-ids")
    counts, files = tokenise(docs, plain, tokenizer, end_id)
    free_shuffles(spark)
    if not files:
        return files
    sent = spark.sparkContext.broadcast(code_lengths(counts))  # one byte for each id of the vocabulary

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            done = 0
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                name = os.path.basename(name).removesuffix(".plain") + ".ids"
                _put(store, os.path.join(path, name), pack_file(*unpack_plain(content), sent.value))
                done += 1
            yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["n"])

    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.plain").load(plain).select("path", "content")
    coded = arrow_map(stored, code, "n bigint").agg(F.sum("n")).first()[0]
    if coded != len(files):
        raise ValueError(f"{coded} of {len(files)} files were coded")
    return files


def read_files(spark, folder: str, files: list[tuple[int, int]]) -> DataFrame:
    """One row per document with the place of its first id among all ids, decoded from the files."""
    if not files:
        return spark.createDataFrame([], RESULT)
    first, total = {}, 0
    for number, many in files:
        first[number], total = total, total + many

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                number = int(os.path.basename(path).split(".")[0])
                docs, sizes, ids = unpack_file(content)
                ends = np.cumsum(sizes)
                held = memoryview(ids.astype("<u4")).cast("B")
                crc = [zlib.crc32(held[4 * (e - s): 4 * e]) for e, s in zip(ends.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * len(docs), pa.int64()), pa.array(docs, pa.int64()),
                     pa.array(ends - sizes + first[number]), pa.array(sizes), pa.array(crc, pa.int64())],
                    names=RESULT.names)

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.ids").load(folder)
    return arrow_map(found.select("path", "content"), read, RESULT)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Writes ``docs`` below ``folder`` (a new shared one by default) and reads the files back.

    Null text counts as empty, a null doc_id comes first, repeated rows are written as often as they
    occur, an empty table writes no file and gives no row.
    """
    spark = docs.sparkSession
    folder = folder or work_dir(spark, "token-files")
    return read_files(spark, folder, write_files(docs, folder, tokenizer, end_id))
