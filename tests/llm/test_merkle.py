import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm import merkle

KIND = T.StructType([T.StructField(n, k) for n, k in (
    ("doc_id", T.LongType()), ("source", T.StringType()), ("lang", T.StringType()), ("n_chars", T.LongType()),
    ("text", T.StringType()), ("place", T.StringType()), ("tree", T.StringType()))])


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row, text):
    parts = [row[0], row[1], row[2], row[3], text]
    return sha("".join("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))


def climb(nodes, fanout):
    """Root and, for each node, its siblings level by level as (before, after)."""
    paths, groups = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        above, merged = [], []
        for start in range(0, len(nodes), fanout):
            run = nodes[start:start + fanout]
            for k, members in enumerate(groups[start:start + fanout]):
                for m in members:
                    paths[m].append((run[:k], run[k + 1:]))
            above.append(sha("".join(run)))
            merged.append([m for members in groups[start:start + fanout] for m in members])
        nodes, groups = above, merged
    return nodes[0], paths


def brute(rows, fanout):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        own = sorted(([r[0], brute_leaf(r, r[4]), r] for r in rows if r[2] == lang), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append((own, *climb([x[1] for x in own], fanout)))
    root, upper = climb([t[1] for t in trees], fanout)
    out = []
    for (own, subroot, paths), above in zip(trees, upper):
        for (doc_id, leaf, row), path in zip(own, paths):
            text = row[4]
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
                text = text.translate(lower)
            node = brute_leaf(row, text)
            for before, after in path + above:
                node = sha("".join([*before, node, *after]))
            proof = sha("".join("".join(b + a) for b, a in path + above))
            out.append((doc_id, leaf, subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def result(found):
    found = found.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256), "folded_root", "verified")
    return sorted((tuple(r) for r in found.collect()), key=str)


@pytest.mark.parametrize("sizes,fanout,levels", [
    ({"en": 150, None: 9, "": 1, "de": 8, "é": 65, "z": 2, "y": 3, "x": 1, "w": 1, "v": 1}, 8, 1),
    ({"en": 43, "de": 27, "fr": 1}, 3, 0), ({"en": 70, "fr": 64}, 4, 1), ({"en": 20}, 8, 4), ({None: 1}, 8, 1)])
def test_manifest_equals_brute_force(spark, sizes, fanout, levels):
    draw = random.Random(7)
    rows = []
    for lang, many in sizes.items():
        for _ in range(many):
            text = draw.choice([None, "", "Abc É", "abc", "x" * 5000 + "Y", f"T{draw.random()}"])
            rows.append((draw.choice([None, *range(60)]) if many > 5 else draw.randrange(10**12), draw.choice([None, "s"]), lang,
                         draw.choice([None, 3]), text, "p", "t"))
    rows += rows[:3]  # repeated rows
    docs = spark.createDataFrame(rows, KIND).repartition(3)
    assert result(merkle.check_tampering(docs, fanout=fanout, block_levels=levels)) == brute(rows, fanout)


def test_an_empty_table_has_no_rows(spark):
    assert merkle.check_tampering(spark.createDataFrame([], KIND)).collect() == []


def test_the_shared_odd_rows(odd):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in odd.collect()]
    assert result(merkle.check_tampering(odd, block_levels=1)) == brute(rows, 8)
