import hashlib
import random
import re
from collections import Counter

import numpy as np
import xxhash
import pytest

from orefold.llm import common, fmindex, simhash, suffixes


def word_brute(rows, width):
    last = 1 << 63
    first, out = {}, []
    split = [(last if d is None else d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, w in split:
        for k in range(len(w) - width + 1):
            window = tuple(w[k: k + width])
            first[window] = min(first.get(window, last), d)
    for (d, w), (doc, _) in zip(split, rows):
        gone = {j for k in range(len(w) - width + 1) if first[tuple(w[k: k + width])] < d for j in range(k, k + width)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def byte_brute(rows, width):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[k: k + width] for t in texts for k in range(len(t) - width + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - width + 1):
            if count[t[k: k + width]] > 1:
                gone[k: k + width] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    random.seed(seed)
    base = [" ".join(random.choice("abcdefgh") * random.randint(1, 3) for _ in range(random.randint(0, 90))) for _ in range(6)]
    rows = []
    for k in range(40):
        text = random.choice(base)
        if random.random() < 0.6:
            words = text.split(" ")
            words[random.randrange(len(words))] = f"new{k}"
            text = " ".join(words[random.randrange(3):]) + random.choice(["", "\n", " end"])
        rows.append((random.choice([None, k, k, k]), text))
    return rows + [(7, None), (7, ""), (8, "ü" * 700), (9, "ab" * 500)]


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_match_brute_force(docs, seed):
    rows = corpus(seed)
    found = fmindex.remove_repeats(docs(*rows)).drop("spans", "text_sha")
    assert sorted(map(tuple, found.collect()), key=str) == word_brute(rows, 13)
    found = suffixes.remove_repeats(docs(*rows), 128).drop("spans")
    assert sorted(map(tuple, found.collect()), key=str) == byte_brute(rows, 128)


def test_the_result_shuffles_no_text_that_was_searched(odd, docs):
    # The searched texts' shuffle has ended with a stored table, so its files are gone when the result is made.
    for found in (fmindex.remove_repeats(odd), fmindex.rewrite(odd)):
        assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_go_when_nothing_reads_them_any_more(odd, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "work_dir", lambda spark, purpose: f"{tmp_path}/{purpose}")
    fmindex.rewrite(odd)
    assert [p.name for p in tmp_path.iterdir()] == ["word-kept"]
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = fmindex.remove_repeats(odd).drop("spans", "text_sha")
    assert sorted(p.name for p in tmp_path.iterdir()) == ["word-base", "word-kept", "word-removed"]
    assert sorted(map(tuple, found.collect()), key=str) == word_brute(rows, 13)


def test_texts_that_lose_nothing_are_not_read_again(docs, tmp_path, monkeypatch, spark):
    monkeypatch.setattr(common, "work_dir", lambda spark, purpose: f"{tmp_path}/{purpose}")
    words = " ".join(f"word{k}" for k in range(30))
    fmindex.remove_repeats(docs((1, words), (2, words + " more"), (3, "head " + words)))
    assert sorted(r.doc for r in spark.read.parquet(f"{tmp_path}/word-removed").collect()) == [2, 3]


def test_odd_rows_and_nothing(odd, docs):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = fmindex.remove_repeats(odd).drop("spans", "text_sha")
    assert sorted(map(tuple, found.collect()), key=str) == word_brute(rows, 13)
    assert fmindex.remove_repeats(docs()).count() == 0
    assert suffixes.remove_repeats(docs()).count() == 0
    again = fmindex.rewrite(odd)
    assert again.columns == odd.columns and again.count() == odd.count()


def test_repeated_bytes_at_the_real_width(odd, docs):
    """Shared strings of just under and over 400 bytes, within one text and between texts, periodic and odd texts."""
    random.seed(11)
    fill = lambda n: "".join(random.choices("abcdefgh é", k=n))
    shared = [fill(n) for n in (330, 380, 399, 400, 401, 460, 700, 1500)]
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(500, "xyz" * 500), (501, "xyz" * 200), (502, None), (503, fill(300))]
    for k in range(30):
        parts = random.choices(shared, k=random.randint(1, 4))
        rows.append((600 + k, "".join(p[random.randint(0, 40):] + fill(random.randint(0, 90)) for p in parts)))
    found = suffixes.remove_repeats(docs(*rows)).drop("spans")
    assert sorted(map(tuple, found.collect()), key=str) == byte_brute(rows, 400)


@pytest.mark.parametrize("shard", [40, 1 << 20])
def test_indexes_split_over_shards(shard):
    random.seed(shard)
    rows = [[random.choice([b"a", b"b", b"c"]) for _ in range(random.randint(1, 30))] for _ in range(25)]
    ids = [random.randrange(9) for _ in rows]
    first = {}
    for d, w in zip(ids, rows):
        for k in range(len(w) - 4):
            first[tuple(w[k: k + 5])] = min(first.get(tuple(w[k: k + 5]), 99), d)
    for w, d, least in zip(rows, ids, fmindex.least_docs(rows, ids, 5, shard)):
        assert [x < d for x in least] == [first[tuple(w[k: k + 5])] < d for k in range(max(0, len(w) - 4))]


@pytest.mark.parametrize("shard", [150, 1 << 20])
def test_suffix_arrays_split_over_shards(shard):
    random.seed(shard)
    rows = [bytes(random.choice(b"\0ab") for _ in range(random.randint(1, 120))) for _ in range(12)]
    rows += [r[:50] + b"x" + r[51:] for r in rows]
    count = Counter(r[k: k + 16] for r in rows for k in range(len(r) - 15))
    for r, marks in zip(rows, suffixes.repeated_windows(rows, 16, shard)):
        assert marks.tolist() == [count[r[k: k + 16]] > 1 for k in range(max(0, len(r) - 15))]


def test_anchors_bring_links_together(spark):
    rng = np.random.default_rng(5)
    points = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    near = points.copy()
    for k in range(len(near)):
        for bit in rng.choice(64, k % 5, replace=False):
            near[k] ^= np.uint64(1) << np.uint64(bit)
    every = np.unique(np.concatenate([points, near])).view(np.int64).tolist()
    rows = simhash.links(spark.createDataFrame([(p,) for p in every], "point bigint")).collect()
    root = {p: p for p in every}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for r in rows:
        root[find(r.a)] = find(r.b)
    assert all(find(a) == find(b) for a, b in zip(points.view(np.int64).tolist(), near.view(np.int64).tolist()))
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in rows)


def test_simhash_groups(odd, docs):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == 10
    by_id = {r.doc_id: r for r in rows}
    assert by_id[4].fingerprint == "0" * 16 and by_id[4].component_id == 3
    assert by_id[5].component_id == 1
    assert simhash.near_duplicates(docs()).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 5 not in ids and 4 not in ids and ids.count(3) == 1


def plain_fingerprint(text, width=4):
    """A loop over shingles and bits, as the contract says it."""
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(found[k: k + width]).encode(), 42) for k in range(max(1, len(found) - width + 1))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def near_brute(texts, distance=4):
    """Component of each text, by all pairs of fingerprints."""
    points = [plain_fingerprint(t) for t in texts]
    root = list(range(len(texts)))

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(points):
        for j in range(i):
            if (a ^ points[j]).bit_count() <= distance:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def family_texts(rng):
    """Templates whose variants differ in 0 to 12 of 240 words, short texts, and texts without words."""
    out = []
    for family in range(8):
        base = [f"W{family}_{k}" for k in range(240)]
        for edits in [0, 0, 1, 1, 2, 3, 5, 8, 12]:
            one = list(base)
            for at in rng.sample(range(240), edits):
                one[at] = f"new{rng.random()}É"
            out.append(" ".join(one))
    out += ["a", "A", "a b", "A\tB", "a b c d e", "É", "", None, " \n"]
    rng.shuffle(out)
    return out


def test_fingerprints_and_groups_equal_brute_force(docs):
    texts = family_texts(random.Random(7))
    found = {r.doc_id: r for r in simhash.near_duplicates(docs(*enumerate(texts))).collect()}
    want = near_brute(texts)
    assert [found[k].component_id for k in range(len(texts))] == want and len(set(want)) < len(texts)
    assert [found[k].fingerprint for k in range(len(texts))] == [f"{plain_fingerprint(t):016x}" for t in texts]


def test_one_document_of_each_group_stays(docs):
    texts = family_texts(random.Random(8))
    kept = sorted(r.doc_id for r in simhash.keep_one(docs(*enumerate(texts))).collect())
    assert kept == sorted(set(near_brute(texts)))


def test_unrelated_rows_without_or_under_one_id_stay(docs):
    one, two, three, four = (" ".join(f"{name}{k}" for k in range(30)) for name in "abcd")
    rows = [(None, one), (None, two), (None, two), (3, one), (4, three), (4, three), (4, four), (5, four), (6, four.upper()), (None, None)]
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_one(docs(*rows)).collect()), key=str)
    assert kept == sorted([(None, two), (3, one), (4, three), (4, four), (None, None)], key=str)
