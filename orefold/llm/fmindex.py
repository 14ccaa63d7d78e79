"""Word-level repeats by compressed FM-indexes: removes the words of windows that also start in a document
with a smaller doc_id.

Stretches of texts that may repeat come together by content (``windows``). A shard keeps its stretches as a
Burrows-Wheeler transform in a wavelet matrix (packed bits and block counts). The stretches of the shard's
documents stream against it: backward search extends all windows to the left together and gives, for each,
how far it matches and the interval of its occurrences, whose smallest doc_id decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orefold.llm import windows
from orefold.llm.common import arrow_map, check_columns, discard, materialise, own_columns, whole_text

GRAM = 5
_PLACE = 21
#: Words in one index.
SHARD = 1 << 20
#: Word hashes remembered in each Python worker.
REMEMBERED = 400_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        found = xxhash.xxh64_intdigest(word)
        if len(self) < REMEMBERED:
            self[word] = found
        return found


_HASHES = _Hashes()


def word_grams(texts: list[bytes], gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``gram`` words from every place of the texts laid end to end, and the texts' starts."""
    sizes, parts = [0], []
    for text in texts:
        words = text.split()
        sizes.append(len(words))
        parts.append(np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words)))
    hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    out = hashes[: max(0, len(hashes) - gram + 1)]
    for k in range(1, gram):
        out = windows.join_hashes(out, hashes[k: k + len(out)])
    return out, np.cumsum(sizes)


class WaveletMatrix:
    """Symbols by bits, highest first; each level keeps zeros before ones. Answers ranks for many at once."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.n = bits, len(symbols)
        self.words, self.before, self.zeros = [], [], []
        for level in range(bits - 1, -1, -1):
            ones = (symbols >> level) & 1 == 1
            packed = np.packbits(np.concatenate([ones, np.zeros(64 + -len(ones) % 64, bool)]), bitorder="little").view("<u8")
            counts = np.bitwise_count(packed).astype(np.int32)
            self.words.append(packed)
            self.before.append(np.cumsum(counts, dtype=np.int32) - counts)
            self.zeros.append(int(len(ones) - ones.sum()))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def place(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the boundary ``at`` falls in the last level for ``symbol``; minus that of 0 it is the rank."""
        at = at.astype(np.int64)
        for level, (words, before, zeros) in enumerate(zip(self.words, self.before, self.zeros)):
            block = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[block] + np.bitwise_count(words[block] & mask)
            bit = (symbol >> (self.bits - 1 - level)) & 1 == 1
            at = np.where(bit, zeros + ones, at - ones)
        return at


class FMIndex:
    """Index of word sequences; finds patterns of up to ``width`` words."""

    def __init__(self, sequences: list[list[bytes]], docs: np.ndarray, width: int):
        self.width = width
        self.symbols: dict[bytes, int] = {}
        text, owner = [], []
        for k, words in enumerate(sequences):
            text.extend(self.symbols.setdefault(w, len(self.symbols) + 1) for w in words)
            text.append(0)  # ends a sequence; no pattern has it
            owner.append(len(words) + 1)
        text = np.array(text, np.int64)
        order = self._order(text, width)
        self.docs = np.repeat(np.asarray(docs, np.int64), owner)[order]
        self.count = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(self.symbols) + 1))])
        bits = max(1, len(self.symbols).bit_length())
        self.matrix = WaveletMatrix(text[order - 1], bits)  # the word before each suffix; the first has an end there
        every = np.arange(len(self.symbols) + 1)
        self.base = self.count[:-1] - self.matrix.place(every, np.zeros(len(every), np.int64))

    @staticmethod
    def _order(text: np.ndarray, depth: int) -> np.ndarray:
        """Suffixes sorted by their first ``depth`` words; searches for longer patterns would need more."""
        n = len(text)
        if n >= 1 << _PLACE:
            raise ValueError("too many words for one index")
        low, bits = np.uint64((1 << _PLACE) - 1), np.uint64(_PLACE)
        place = np.arange(n, dtype=np.int64)
        following = np.append(text[1:], 0)
        key = (text.astype(np.uint64) << np.uint64(2 * _PLACE)) | (following.astype(np.uint64) << bits) | place.astype(np.uint64)
        key.sort()
        order, key = (key & low).astype(np.int64), key >> bits
        new = np.concatenate([[True], key[1:] != key[:-1]])
        head = np.maximum.accumulate(np.where(new, place, 0))
        rank = np.empty(n, np.int64)
        rank[order] = head
        reach = 2
        while reach < depth:
            open_ = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))
            if not len(open_):
                break
            suffix = order[open_]
            beyond = suffix + reach
            rest = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
            key = (head[open_].astype(np.uint64) << np.uint64(2 * _PLACE + 1)) | (rest.astype(np.uint64) << bits)
            key |= np.arange(len(open_), dtype=np.uint64)
            key.sort()
            suffix = suffix[(key & low).astype(np.int64)]
            key >>= bits
            order[open_] = suffix
            new[open_] = np.concatenate([[True], key[1:] != key[:-1]])
            head[open_] = np.maximum.accumulate(np.where(new[open_], open_, 0))
            rank[suffix] = head[open_]
            reach *= 2
        return order

    def matches(self, sequences: list[list[bytes]], least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the windows of ``width`` words of all sequences, one after the other: how many words, from
        the end, were matched, and the interval of occurrences of these.

        A window whose interval is down to fewer than ``least`` + 1 occurrences is not extended any more:
        with ``least`` 1 for sequences of this index, which always occur once.
        """
        known = self.symbols.get
        text = np.array([known(w, -1) for words in sequences for w in words], np.int64)
        starts = np.cumsum([0, *map(len, sequences)])
        first = np.concatenate([np.arange(a, b - self.width + 1) for a, b in zip(starts[:-1], starts[1:])] or [np.zeros(0, np.int64)])
        low, high = np.zeros(len(first), np.int64), np.full(len(first), len(self.docs))
        matched = np.zeros(len(first), np.int64)
        live = np.arange(len(first))
        for back in range(self.width - 1, -1, -1):
            symbol = text[first[live] + back]
            unknown = symbol < 0
            if unknown.any():
                high[live[unknown]] = low[live[unknown]]
                live, symbol = live[~unknown], symbol[~unknown]
            if back == self.width - 1:
                new_low, new_high = self.count[symbol], self.count[symbol + 1]
            else:
                at = self.matrix.place(np.concatenate([symbol, symbol]), np.concatenate([low[live], high[live]]))
                at += np.concatenate([self.base[symbol], self.base[symbol]])
                new_low, new_high = at[: len(live)], at[len(live):]
            low[live], high[live] = new_low, new_high
            matched[live[new_high > new_low]] += 1
            live = live[new_high - new_low > least]
            if not len(live):
                break
        return matched, low, high

    def least_docs(self, sequences: list[list[bytes]], own: bool) -> np.ndarray:
        """Smallest doc among the occurrences of each window; the greatest number where there is none.

        ``own``: the sequences are those of this index. There a window that occurs once is found by
        nobody else, whatever the rest of it, and gets the greatest number too.
        """
        matched, low, high = self.matches(sequences, 1 if own else 0)
        out = np.full(len(low), np.iinfo(np.int64).max)
        hit = np.flatnonzero(matched == self.width)
        if len(hit):
            pairs, back = np.unique(np.stack([low[hit], high[hit]], 1), axis=0, return_inverse=True)
            # Intervals of different windows do not overlap, so this reads every suffix once at most.
            padded = np.append(self.docs, np.iinfo(np.int64).max)
            out[hit] = np.minimum.reduceat(padded, pairs.ravel())[::2][back.reshape(-1)]
        return out


def least_docs(sequences: list[list[bytes]], docs: list[int], width: int, shard: int = SHARD) -> list[np.ndarray]:
    """For each sequence and window: the smallest doc among all sequences that have the window, or the
    greatest number if only this one does. Sequences beyond ``shard`` words are split over several indexes, and
    all stream against each."""
    blocks: list[list[int]] = [[]]
    size = 0
    for k, words in enumerate(sequences):
        if size + len(words) + 1 > shard and blocks[-1]:
            blocks.append([])
            size = 0
        blocks[-1].append(k)
        size += len(words) + 1
    out = [np.full(max(0, len(w) - width + 1), np.iinfo(np.int64).max) for w in sequences]
    for block in blocks:
        index = FMIndex([sequences[k] for k in block], np.array([docs[k] for k in block], np.int64), width)
        for other in blocks:
            found = index.least_docs([sequences[k] for k in other], other is block)
            at = 0
            for k in other:
                many = len(out[k])
                np.minimum(out[k], found[at: at + many], out=out[k])
                at += many
    return out


def _about(texts: list[bytes]) -> tuple[list[str], list[pa.Array]]:
    words = [t.split() for t in texts]
    return ["n_words", "words_sha"], [pa.array(map(len, words), pa.int64()),
                                      pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string())]


def _cut(text: bytes, runs: list[tuple[int, int]]) -> list[bytes]:
    words = text.split()
    return [b" ".join(words[a: a + n]) for a, n in runs]


def _search(docs: DataFrame, width: int, with_text: bool) -> tuple[DataFrame, DataFrame]:
    """Stored: all documents (doc_id, doc, key, text_sha, n_words, words_sha), and what the first of its copies loses for each text
    that loses something (doc, key, removed, spans, sha, left)."""
    check_columns(docs, ["doc_id", "text"])
    if width < GRAM or width - GRAM + 1 > 1 << windows.COUNT_BITS:
        raise ValueError(f"width must be within {GRAM}..{(1 << windows.COUNT_BITS) + GRAM - 1}")
    found = windows.survey(docs, width, GRAM, word_grams, _about, "n_words bigint, words_sha string", "word-survey")
    chosen = windows.candidates(found, False, "word-candidates")
    # The stretches' anchors are most of the survey, and not needed from here on.
    base = materialise(found.select("doc_id", windows.doc_or_last().alias("doc"), "key", "text_sha", "n_words", "words_sha"), "word-base")
    discard(found)
    rows = windows.contents(docs, chosen, width, _cut, "word-stretches")
    discard(chosen)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in windows.shards(batches, 6 * SHARD):
            groups: dict[int, int] = {}
            for r in held:
                groups[r["anchor"]] = groups.get(r["anchor"], 0) + 1
            sought = [r for r in held if groups[r["anchor"]] > 1]
            contents = [r["content"].split(b" ") for r in sought]
            grams = word_grams([r["content"] for r in sought], GRAM)
            paired = windows.with_partner([r["anchor"] for r in sought], contents, *grams, width, GRAM, tuple)
            sought = [sought[k] for k in paired]
            least = least_docs([contents[k] for k in paired], [r["doc"] for r in sought], width)
            marks = {(r["anchor"], r["digest"]): m for r, m in zip(sought, least)}
            out = []
            for r in held:
                m = marks.get((r["anchor"], r["digest"]))
                if m is None:
                    m = np.full(r["content"].count(b" ") + 2 - width, np.iinfo(np.int64).max)
                if r["many"] > 1:
                    m = np.minimum(m, r["doc"])
                elif not (m < r["doc"]).any():
                    continue
                out.append((r["anchor"], r["digest"], m.tolist()))
            kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 3, kinds)],
                                             names=["anchor", "digest", "least"])

    marked = materialise(arrow_map(windows.distinct_contents(rows), search,
                                   "anchor bigint, digest binary, least array<bigint>"), "word-marks")
    spots = rows.select("anchor", "digest", "doc", "key", "place").join(marked, ["anchor", "digest"])
    # Only texts that lose words, and which of their windows go, travel on.
    spots = spots.select("doc", "key", "place", F.transform("least", lambda least: least < F.col("doc")).alias("gone"))
    lists = materialise(spots.where(F.exists("gone", lambda gone: gone)).groupBy("doc", "key").agg(
        F.collect_list(F.struct("place", "gone")).alias("marks")), "word-cuts")
    discard(rows, marked)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_, keys, texts, lists_ = (c.to_pylist() for c in batch.columns)
            removed, spans, digests, left = [], [], [], []
            for text, marks in zip(texts, lists_):
                words = text.encode("utf-8", "replace").split()
                gone = windows.cover([(start + k, start + k + width) for m in marks
                                      for start in [m["place"] >> windows.COUNT_BITS]
                                      for k, lost in enumerate(m["gone"]) if lost])
                kept, at = [], 0
                for a, b in gone:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                removed.append(len(words) - len(kept))
                spans.append([{"start": a, "end": b} for a, b in gone])
                joined_words = b" ".join(kept)
                digests.append(hashlib.sha256(joined_words).hexdigest())
                left.append(joined_words.decode() if with_text else None)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs_, pa.int64()), pa.array(keys, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, kind), pa.array(digests, pa.string()), pa.array(left, pa.string())],
                names=["doc", "key", "removed", "spans", "sha", "left"])

    # Stored, so that the shuffled texts are freed before those of the result, or a caller, are shuffled.
    done = materialise(arrow_map(windows.with_texts(docs, lists, "marks"), remove,
                                 "doc bigint, key bigint, removed bigint, spans array<struct<start:bigint,end:bigint>>, sha string, left string"),
                       "word-removed")
    discard(lists)
    return base, done


def _result(base: DataFrame, done: DataFrame, width: int, with_text: bool) -> DataFrame:
    copies = base.groupBy("text_sha").agg(F.min("doc").alias("first"))
    joined = base.join(copies, "text_sha").join(done, ["doc", "key"], "left")
    whole = (F.col("doc") > F.col("first")) & (F.col("n_words") >= width)
    span = F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_words").alias("end"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    text = [F.when(whole, F.lit("")).otherwise(F.col("left")).alias("kept_text")] if with_text else []
    return joined.select(
        "doc_id", "n_words", F.when(whole, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("sha", "words_sha")).alias("kept_sha256"),
        F.when(whole, F.array(span)).otherwise(F.coalesce("spans", empty)).alias("spans"), "text_sha", *text)


def remove_repeats(docs: DataFrame, width: int = 13, with_text: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, spans, text_sha) of documents (doc_id, text).

    ``spans`` are the removed ranges of words, in order. Words are runs without ASCII white space. Null text
    has none; texts of fewer than ``width`` words lose nothing. Of copies the one with the smallest doc_id
    counts; rows of one doc_id do not remove from each other. A null doc_id is greater than all others.
    ``with_text`` adds ``kept_text``: the words left, joined by blanks, or null where none was removed.
    """
    return _result(*_search(docs, width, with_text), width, with_text)


@own_columns
def rewrite(docs: DataFrame, width: int = 13) -> DataFrame:
    """``docs`` with the repeats cut out of ``text``, and ``n_chars``, if there is one, counted again. Texts without
    repeats stay as they are; rows stay, even those with no words left."""
    names = docs.columns
    base, done = _search(docs, width, True)
    found = materialise(_result(base, done, width, True).where("kept_text is not null").groupBy(
        F.col("doc_id").alias("__doc"), F.col("text_sha").alias("__sha")).agg(F.any_value("kept_text").alias("__kept")), "word-kept")
    discard(base, done)
    marked = docs.withColumn("__sha_", F.sha2(whole_text(), 256))
    joined = marked.join(found, F.col("doc_id").cast("bigint").eqNullSafe(F.col("__doc")) & (F.col("__sha_") == F.col("__sha")), "left")
    new = {"text": F.coalesce("__kept", "text")}
    if "n_chars" in names:
        new["n_chars"] = F.when(F.col("__kept").isNull(), F.col("n_chars")).otherwise(F.length("__kept").cast("bigint"))
    return joined.withColumns(new).select(*[F.col(f"`{c}`") for c in names])
