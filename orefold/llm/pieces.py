"""SentencePiece encoding with offsets, and decoding.

A text is normalised by longest-prefix look-up in the model's compiled character map; each byte of the
result keeps the source byte it came from. The library segments, and the pieces, which cover the
normalised text without gaps, are projected through those marks to byte spans of the original text.

With an empty map the marks need no look-up: each piece is as wide as its bytes, a blank's mark counts one,
and the sum must be the text's length; texts with unknown pieces or marks of their own take the general way.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm.common import arrow_map, check_columns, only, schema, whole_text

MARK = "▁".encode()  # stands for a blank
RESULT = schema(doc_id=T.LongType(), ids=T.ArrayType(T.IntegerType()), begins=T.ArrayType(T.IntegerType()),
                ends=T.ArrayType(T.IntegerType()), decoded=T.StringType())
_LOADED: dict[str, "Encoder"] = {}


def _fields(blob: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = blob[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(blob):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, blob[at: at + size]
            at += size


class CharacterMap:
    """The compiled map: a double-array trie over source bytes whose leaves point at replacements.

    Layout (fixed by the format): 32-bit size of the trie, the trie's 32-bit units, then the
    replacements, each ended by a zero byte.
    """

    def __init__(self, blob: bytes):
        self.units: list[int] = []
        self.texts = b""
        if blob:
            (size,) = struct.unpack_from("<I", blob)
            self.units = list(struct.unpack_from(f"<{size // 4}I", blob, 4))
            self.texts = blob[4 + size:]

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key that starts at ``at``, and its replacement."""
        units, best = self.units, None
        if not units:
            return None
        node = self._child(units[0])
        for end in range(at, len(source)):
            byte = source[end]
            node ^= byte
            if not byte or node >= len(units) or units[node] & 0x800000FF != byte:
                break
            unit = units[node]
            node ^= self._child(unit)
            if unit >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                best = end + 1 - at, self.texts[start: self.texts.index(0, start)]
        return best

    @staticmethod
    def _child(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


class Normaliser:
    """Source text -> normalised bytes and, for each of them and the end, the source byte it came from."""

    def __init__(self, spec: bytes):
        found = {k: v for k, v in _fields(spec)}
        self.map = CharacterMap(found.get(2, b""))
        self.prefix = bool(found.get(3, 1))
        self.tidy = bool(found.get(4, 1))
        self.escape = bool(found.get(5, 1))

    def __call__(self, text: str) -> tuple[bytes, list[int]]:
        source = text.encode("utf-8", "replace")
        parts: list[tuple[int, int, bytes]] = []  # source start, source end, replacement
        at = 0
        while at < len(source):
            found = self.map.longest(source, at)
            if found is None:
                lead = source[at]
                size = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                found = size, source[at: at + size]
            parts.append((at, at + found[0], found[1]))
            at += found[0]
        if self.tidy:
            while parts and parts[0][2] == b" ":
                parts.pop(0)
        blank = MARK if self.escape else b" "
        out, marks = bytearray(), []
        if not parts:
            return b"", [0]
        if self.prefix:
            out += blank
            marks += [parts[0][0]] * len(blank)
        after_blank, end = self.tidy, parts[0][0]
        for start, stop, new in parts:
            while after_blank and new[:1] == b" ":
                new = new[1:]
            if new:
                put = new.replace(b" ", blank)
                out += put
                # What stays as it is keeps its own bytes; a replacement stands for the whole of its source.
                marks += range(start, stop) if put == source[start:stop] else [start] * len(put)
                after_blank = self.tidy and new[-1:] == b" "
            end = stop
        if self.tidy:
            while out.endswith(blank) and out:
                end = marks[-len(blank)]
                del out[-len(blank):], marks[-len(blank):]
        return bytes(out), [*marks, end]


class Encoder:
    """The library's model, with byte spans for its pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as stream:
            spec = next((v for k, v in _fields(stream.read()) if k == 3), b"")
        self.normalise = Normaliser(spec)
        names = [self.library.id_to_piece(k) for k in range(self.library.get_piece_size())]
        self.sizes = [1 if self.library.is_byte(k) else 0 if self.library.is_unknown(k) else len(n.encode())
                      for k, n in enumerate(names)]
        #: Whether normalising only puts a mark before the text and for each blank.
        self.plain = (not self.normalise.map.units and self.normalise.prefix and self.normalise.escape
                      and not self.normalise.tidy)
        marks = np.array([n.count("▁") for n in names])
        self.widths = (np.array(self.sizes) - marks * (len(MARK) - 1)).astype("<i4")

    def spans(self, text: str, ids: list[int]) -> list[tuple[int, int]]:
        """Source byte span of each piece; a blank put before the text has an empty one."""
        normal, marks = self.normalise(text)
        out, at = [], 0
        for k, piece in enumerate(ids):
            size = self.sizes[piece]
            if not size:  # unknown: what the library shows of it
                size = len(self.library.encode(text, return_type="proto").pieces[k].piece.encode())
            out.append((marks[at], marks[at + size]))
            at += size
        if at != len(normal):
            raise ValueError("the pieces do not cover the normalised text")
        return out

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, str]:
        """Ids, where each piece begins and ends in the text's bytes, and the ids decoded."""
        ids = self.library.encode(text)
        decoded = self.library.decode(ids)
        numbers = np.array(ids, "<i4")
        if self.plain and ids and "▁" not in text:
            width = self.widths[numbers]
            width[0] -= 1  # no blank stands before the text
            ends = np.cumsum(width, dtype="<i4")
            if ends[-1] == len(text.encode("utf-8", "replace")):  # else there are unknown pieces
                return numbers, ends - width, ends, decoded
        spans = np.array(self.spans(text, ids), "<i4").reshape(-1, 2)
        return numbers, spans[:, 0], spans[:, 1], decoded


def encode_documents(docs: DataFrame, model: str) -> DataFrame:
    """Documents (doc_id, text) as ids, byte spans [begin, end) in the UTF-8 text, and decoded text.

    Null text counts as empty and has no ids. Each row is a document of its own; nothing is shuffled.
    """
    check_columns(docs, ["doc_id", "text"])

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model not in _LOADED:
            _LOADED[model] = Encoder(model)
        encoder = _LOADED[model]
        for whole in batches:
            for first in range(0, whole.num_rows, 1000):
                batch = whole.slice(first, 1000)
                *lists, decoded = zip(*map(encoder.encode, batch.column(1).to_pylist()))
                sizes = pa.array(np.cumsum([0, *map(len, lists[0])]), pa.int32())
                columns = [pa.ListArray.from_arrays(sizes, pa.array(np.concatenate(part), pa.int32())) for part in lists]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *columns, pa.array(decoded, pa.string())], names=RESULT.names)

    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), whole_text().alias("text"))
    return arrow_map(rows, convert, RESULT)
