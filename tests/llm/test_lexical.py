import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import types as T

from orefold.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("terms", T.StringType())])


def counted(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def brute(docs, items, best=20):
    held = [(doc_id, counted(text)) for doc_id, text in docs]
    held = [(d, c) for d, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in set(items):
        asked = counted(text)
        weights = {t: k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t, k in asked.items() if df[t]}
        scored = []
        for doc_id, c in held:
            m = 75 + 25 * sum(c.values()) * n // total
            score = sum(w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, w in weights.items() if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:best])]
    return sorted(out, key=str)


def result(found):
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def some_texts(draw, many, words):
    out = []
    for k in range(many):
        if k % 7 == 6 and out:
            out.append(draw.choice(out))  # copies
        else:
            out.append(draw.choice(["", "É", "x,"]) + " ".join(words[min(int(draw.expovariate(.04)), len(words) - 1)] for _ in range(draw.randrange(90))))
    return out


@pytest.mark.parametrize("shard,bucket,block", [(700, 4, 5), (10**6, 64, 256), (3000, 1, 256)])
def test_search_equals_brute_force(spark, docs, monkeypatch, shard, bucket, block):
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", block)
    monkeypatch.setattr(lexical.Shard.__init__, "__defaults__", (bucket,))
    draw = random.Random(shard)
    words = [f"{a}{b}" for a in ("the", "Of", "ñu", "9", "È") for b in range(60)]
    texts = some_texts(draw, 400, words)
    table = [(k if k % 50 else None, t) for k, t in enumerate(texts)] + [(7, texts[7]), (1000, None), (1001, "the0 " * 9000)]
    items = [(k, t) for k, t in enumerate(some_texts(draw, 17, words))] + [(3, None), (4, "nowhere"), (5, texts[3]), (5, texts[3]), (None, texts[9])]
    asked = spark.createDataFrame([(*i, "clash") for i in items], ITEMS)
    assert result(lexical.search(docs(*table), asked, shard=shard)) == brute(table, items)


def test_odd_and_empty_tables(spark, docs, odd):
    table = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "word3 word4 tail"), (2, None), (3, "ünd UND"), (4, "a b c")]
    asked = spark.createDataFrame([(*i, None) for i in items], ITEMS)
    assert result(lexical.search(odd, asked)) == brute(table, items)
    assert result(lexical.search(odd.limit(0), asked)) == []
    assert result(lexical.search(odd, asked.limit(0))) == []


def test_whole_subtrees_are_left_out(monkeypatch):
    """Documents in a subtree that cannot reach the best ones are not scored."""
    import numpy as np
    ranks = np.array([[0, 1] if k < 500 else [0, 2] for k in range(1000)]).ravel()
    counts = np.array([[1, 9] if k < 500 else [5, 1] for k in range(1000)]).ravel()
    tree = lexical.Shard(np.arange(1000), np.full(1000, 100), np.arange(0, 2001, 2), ranks, counts, 3)
    seen = []
    plain = lexical.Shard._scores
    monkeypatch.setattr(lexical.Shard, "_scores", lambda self, a, b, d: seen.append(b - a) or plain(self, a, b, d))
    found, scores = tree.search(np.array([1]), np.array([10]), 20)
    assert tree.ids[found].tolist() == list(range(20)) and sum(seen) <= 64
