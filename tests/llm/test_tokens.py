import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orefold.llm import huffman, packing, pieces, tokens

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = st.text(alphabet=st.sampled_from("abzÀßé  \n\t\r\x1c '.!*|<>09İǅ日🙂́"), max_size=40)


@given(TEXTS)
@settings(max_examples=300, deadline=None)
def test_remembered_words_give_the_library_ids(text):
    for path, spaced in ((WORD, False), (BYTE, True)):
        words = tokens.load(path, spaced)
        assert words.encode(text) == words.whole(text)


def test_packing_is_gapless_and_close_to_the_bound(odd):
    rows = packing.pack_documents(odd, WORD, limit=64).collect()
    library = tokens.load(WORD, False)
    total = sum(len(library.whole(r.text or "")) // 4 + 1 for r in odd.collect())
    assert sum(r.length for r in rows) == total
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by_sequence) <= -(-total // 64) + 1


@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), min_size=1))
@settings(max_examples=60, deadline=None)
def test_sweeps_need_no_more_than_best_fit_decreasing(counts):
    gaps, want = [], 0
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [g for g in gaps if g >= length]
            if fits:
                gaps.remove(min(fits))
                gaps.append(min(fits) - length)
            else:
                gaps.append(50 - length)
                want += 1
    table = packing.sweeps(counts, 50)
    used = set()
    for k, (length, rank, first, _) in enumerate(table.tolist()):
        following = table[k + 1] if k + 1 < len(table) and table[k + 1][0] == length else None
        many = (following[1] if following is not None else counts[length]) - rank
        used.update(range(first, first + many))
    assert len(used) <= want + 1


def test_packing_of_nothing(docs):
    assert packing.pack_documents(docs(), WORD).count() == 0


@pytest.mark.parametrize("kinds", [1, 2, 3, 700])
def test_huffman_round_trip(kinds):
    rng = np.random.default_rng(kinds)
    ids = np.minimum(rng.geometric(0.02, 5000) - 1, kinds - 1).astype(np.uint32)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=kinds), 10)
    assert lengths.max() <= 10 and sum(2.0 ** -int(v) for v in lengths if v) <= 1
    content = huffman.pack_file([1, None, 3], [10, 0, 4990], ids, lengths)
    docs_, sizes, back = huffman.unpack_file(content)
    assert docs_ == [1, None, 3] and sizes.tolist() == [10, 0, 4990] and (back == ids).all()


def test_token_files(odd, docs):
    library = tokens.load(BYTE, True)
    rows = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    want, at = [], 0
    for r in rows:
        ids = library.whole(r.text or "") + b"\0\0\0\0"
        want.append((r.doc_id, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    got = [tuple(r)[1:] for r in huffman.round_trip(odd, BYTE).orderBy("start").collect()]
    assert got == want
    assert huffman.round_trip(docs(), BYTE).count() == 0


def test_token_files_of_bounded_size(docs, monkeypatch, tmp_path):
    """Files end after a number of ids; documents of one id, or of none, may lie in several tasks."""
    texts = docs(*[(k // 9 if k % 5 else None, f"word {k} " * (k % 7)) for k in range(120)])
    whole = sorted((tuple(r)[1:] for r in huffman.round_trip(texts, BYTE).collect()), key=str)
    monkeypatch.setattr(huffman, "FILE", 30)
    found = huffman.round_trip(texts, BYTE, folder=f"file:{tmp_path}/ids").collect()
    assert sorted((tuple(r)[1:] for r in found), key=str) == whole and len({r.file for r in found}) > 20
    ids = np.array([5, 0, 70_000, 9], np.uint32)
    doc_ids, sizes, back = huffman.unpack_plain(huffman.pack_plain([None, 3, 2], [3, 0, 1], ids))
    assert doc_ids == [None, 3, 2] and sizes == [3, 0, 1] and (back == ids).all()


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_pieces_and_spans(text):
    if MODEL not in pieces._LOADED:
        pieces._LOADED[MODEL] = pieces.Encoder(MODEL)
    encoder = pieces._LOADED[MODEL]
    ids, begins, ends, decoded = encoder.encode(text)
    assert ids.tolist() == encoder.library.encode(text)
    assert decoded == encoder.library.decode(ids.tolist())
    assert list(zip(begins.tolist(), ends.tolist())) == encoder.spans(text, ids.tolist())
    assert not len(ends) or ends[-1] == len(text.encode()) and (begins[1:] == ends[:-1]).all()


def test_longest_prefix_of_a_compiled_map():
    """A trie of two keys built by hand: 'a' -> 'x' and 'ab' -> ''."""
    units = [0] * 1024

    def leaf(at, byte, child, value):
        units[at] = byte | (1 << 8) | ((at ^ child) << 10)
        units[child] = 0x80000000 | value

    root = 256
    units[0] = root << 10
    a = root ^ ord("a")
    leaf(a, ord("a"), 512, 0)
    leaf(512 ^ ord("b"), ord("b"), 768, 2)
    import struct
    blob = struct.pack("<I", 4096) + struct.pack("<1024I", *units) + b"x\0\0"
    table = pieces.CharacterMap(blob)
    assert table.longest(b"ac", 0) == (1, b"x")
    assert table.longest(b"abc", 0) == (2, b"")
    assert table.longest(b"cab", 0) is None and table.longest(b"cab", 1) == (2, b"")


def test_pieces_of_odd_rows(odd):
    rows = pieces.encode_documents(odd, MODEL).collect()
    assert len(rows) == 10
    assert sorted(len(r.ids) for r in rows)[:3] == [0, 0, 0]
    random.seed(1)
