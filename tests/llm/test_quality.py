import gzip
import hashlib
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import types as T

from orefold.llm import cotraining, imatch, rules, warc

LABELS = "doc_id bigint, quality int, toxic int"


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[k: k + 5]) for k in range(len(w) - 4)]
    count = Counter(grams)
    covered = {j for k, g in enumerate(grams) if count[g] > 1 for j in range(k, k + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def labelled(docs, spark, n=400):
    random.seed(4)
    rows, labels = [], []
    for k in range(n):
        bad = k % 4 == 0
        words = ["".join(random.choices("abcdefgh", k=random.randint(2, 7))) for _ in range(random.randint(15, 60))]
        rows.append((k, " ".join(w + ("***" if bad else "") for w in words)))
        labels.append((k, int(not bad), 0))
    return docs(*rows), spark.createDataFrame(labels + [(1, None, None), (9999, 0, 0)], LABELS)


def test_statistics(odd):
    want = sorted(((r.doc_id, *brute(r.text or "")) for r in odd.collect()), key=str)
    assert sorted(map(tuple, rules.statistics(odd).select("doc_id", *rules.BASE).collect()), key=str) == want


def test_rules_find_the_bad(docs, spark):
    texts, labels = labelled(docs, spark)
    rows = rules.judge(texts, labels).collect()
    assert len(rows) == 400 and all(r.kept == (r.doc_id % 4 != 0) for r in rows)
    kept = rules.keep_good(texts, labels)
    assert kept.columns == texts.columns and kept.count() == 300


def test_rules_without_labels(odd, spark):
    none = spark.createDataFrame([], LABELS)
    rows = rules.judge(odd, none).collect()
    assert len(rows) == 10 and all(r.kept == (not r.base_failed) for r in rows)


def test_classifier(docs, spark):
    texts, labels = labelled(docs, spark)
    found = cotraining.classify(texts, labels)
    rows = found.collect()
    assert sum(r.kept == (r.doc_id % 4 != 0) for r in rows) > 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert cotraining.classify(texts.limit(0), labels).count() == 0


def test_all_unlabelled_rows_are_exchanged(docs, spark):
    """Sums by Spark over features equal loops over rows, and the labels given in turns follow from both views."""
    texts, _ = labelled(docs, spark, 90)
    odd_rows = docs((None, "null id ### one"), (None, None), (3, ""), (3, ""), (4, "CAPITALS $$$$$$ " + "long " * 3000))
    table = cotraining.arrow_map(cotraining._plain(texts.union(odd_rows)), cotraining._features, cotraining._FEATURES)
    pool, views = cotraining._pool(table), cotraining._views(table.toArrow().combine_chunks())
    rng = np.random.default_rng(1)
    models = [[rng.normal(0, 0.3, dims + 1) for dims, _ in cotraining.VIEWS] for _ in range(3)]
    middle = cotraining.BINS // 2
    turns = [cotraining.Turn(models[0], [(middle - 200, middle + 150), (middle - 150, middle + 200)]),
             cotraining.Turn(models[1], [(middle - 90, middle + 90)] * 2)]

    def odds(k, row, model):
        at = slice(views[k].starts[row], views[k].starts[row + 1])
        return sum(v * model[i] for i, v in zip(views[k].ids[at], views[k].values[at])) + model[-1]

    def bin_of(z):
        return int(min(max(z, -40), 40) * cotraining.BINS / 80 + middle)

    n = len(views[0].starts) - 1
    assert n == 95
    want, free = [[-1] * n, [-1] * n], []
    for row in range(n):
        for turn in turns:
            said = [0 if bin_of(odds(k, row, turn.models[k])) <= turn.cuts[k][0] else
                    1 if bin_of(odds(k, row, turn.models[k])) >= turn.cuts[k][1] else -1 for k in (0, 1)]
            if max(said) >= 0 and not (min(said) >= 0 and said[0] != said[1]):
                for k in (0, 1):
                    want[1 - k][row] = said[k]
                break
        else:
            free.append(row)
    labels, left = cotraining.given(views, turns)
    assert [x.tolist() for x in labels] == want and np.flatnonzero(left).tolist() == free and 0 < len(free) < n
    counts = pool(cotraining.histograms, turns, models[2]).reshape(2, -1)
    for k in (0, 1):
        assert counts[k].sum() == len(free)
        assert dict(Counter(bin_of(odds(k, r, models[2][k])) for r in free)) == {b: counts[k][b] for b in np.flatnonzero(counts[k])}
    assert {x for column in want for x in column} == {-1, 0, 1}
    sums, start = pool(cotraining.pulls, turns, models[2]), 0
    for k, (dims, _) in enumerate(cotraining.VIEWS):
        for label in (0, 1):
            brute_ = np.zeros((dims + 1, 3))
            for row in (r for r in range(n) if want[k][r] == label):
                at = slice(views[k].starts[row], views[k].starts[row + 1])
                chance = 1 / (1 + np.exp(-odds(k, row, models[2][k])))
                bend = max(chance * (1 - chance), 0.05) * (1 + views[k].values[at].sum())
                for i, v in [*zip(views[k].ids[at], views[k].values[at]), (dims, 1.0)]:
                    brute_[i] += 1, v * (chance - label), v * bend
            found = sums[start: start + dims + 1] / [1, cotraining.UNITS, cotraining.UNITS]
            assert np.allclose(found, brute_, atol=1e-4)
            start += dims + 1


def test_features_cover_all_marks_and_capitals():
    assert cotraining.word_features("$$$a") != cotraining.word_features("$$$#a")
    assert len(cotraining.word_features("$$$$##")) == 4
    assert cotraining.metadata(None, None, 1, "ZZZZ zzzz") != cotraining.metadata(None, None, 1, "zzzz zzzz")


def test_imatch(odd, docs):
    rows = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    want = []
    for k, r in enumerate(rows):
        text, following = r.text or "", rows[(k + 1) % len(rows)].text or ""
        cut = len(text) // 4
        new = text[: len(text) - cut] + following[:cut]
        want.append((r.doc_id, len(text), hashlib.sha256(new.encode()).hexdigest()))
    found = imatch.fingerprint_documents(odd).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in found), key=str) == sorted(want, key=str)
    assert len({r.fingerprint for r in found if r.doc_id in (1, 5) and r.n_chars > 100}) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert imatch.fingerprint_documents(docs()).count() == 0
    assert imatch.fingerprint_documents(docs((1, "one two"))).count() == 1


def test_gzip_members():
    parts = [bytes([k]) * (k * 700) for k in range(40)] + [random.randbytes(300_000)]
    content = b"".join(gzip.compress(p) for p in parts)
    assert list(warc._members(content)) == list(warc._members(content, 1000)) == parts
    assert list(warc._members(b"")) == []


PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("html", T.StringType()), T.StructField("block", T.StringType())])


def test_warc_round_trip(spark, tmp_path):
    page = "<html><head><title>A &amp; B</title></head><body><p>one  <b>two</b><br>three<!-- no --><script>x</script></body>"
    pages = spark.createDataFrame([(1, "http://a/", page, "b"), (2, None, None, None), (None, "http://c/", "", None),
                                   (1, "http://a/", page, "b")], PAGES)
    responses = warc.responses(pages)
    folder = str(tmp_path / "w")
    assert warc.write(responses, folder) == 4
    back = warc.read(spark, folder)
    key = lambda r: (str(r.page_id), r.record_id)
    assert sorted(responses.collect(), key=key) == sorted(back.collect(), key=key)
    rows = warc.derive(back).collect()
    assert len(rows) == 8
    ids = {r.record_id: r for r in back.collect()}
    for r in rows:
        source = ids[r.refers_to]
        assert r.block_digest == r.payload_digest == warc.digest(bytes(r.block)) and r.content_length == len(r.block)
        assert r.extra_headers == {"WARC-Source-Payload-Digest": source.payload_digest} and r.target_uri == source.target_uri
        if r.record_type == "metadata":
            assert f"sourceRecordId: {source.record_id}" in bytes(r.block).decode()
    assert {bytes(r.block) for r in rows if r.record_type == "conversion" and r.page_id == 1} == {b"one two\nthree"}
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0
