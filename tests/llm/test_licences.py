import random
import re

import pytest

from orefold.llm import licences
from orefold.llm.licences import BASE_PHRASES, FREEDOM, NOTICES, evaluate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_places(text, phrases):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), sorted((k, p) for k in range(len(words)) for p in phrases if words[k:k + len(p.split())] == p.split())


def value(text):
    found = evaluate(re.findall(r"[^\s()]+|[()]", text.lower()))
    return found and (found[1], found[2])


def by_python(tree):
    """Text, value and labels of a random expression tree."""
    if isinstance(tree, str):
        return tree, FREEDOM[licences.label_of(tree)], {licences.label_of(tree)}
    name, left, right = tree
    if name == "with":
        return f"{left} WITH some-exception", (1 + FREEDOM[licences.label_of(left)]) / 2, {licences.label_of(left)}
    (a, x, p), (b, y, q) = by_python(left), by_python(right)
    return f"({a}) {name.upper()} ({b})", (max if name == "or" else min)(x, y), p | q


def test_random_expressions_evaluate_as_their_trees():
    draw = random.Random(1)

    def tree(depth):
        if depth == 0 or draw.random() < .2:
            return draw.choice(["mit", "apache-2.0", "gpl-2.0-only", "mpl-2.0", "weird-1", "cc-by-nc-4.0", "lgpl-2.1+"])
        if draw.random() < .2:
            return "with", tree(0), None
        return draw.choice(["or", "and"]), tree(depth - 1), tree(depth - 1)

    for _ in range(500):
        text, number, labels = by_python(tree(5))
        assert value(text) == (sorted(labels), pytest.approx(number))


@pytest.mark.parametrize("text,expected", [
    ("MIT OR GPL-2.0 AND Apache-2.0", (["apache", "gpl", "mit"], FREEDOM["mit"])),
    ("MIT AND GPL-2.0 OR Apache-2.0", (["apache", "gpl", "mit"], FREEDOM["apache"])),
    ("GPL-2.0 WITH Classpath-exception-2.0 AND MIT", (["gpl", "mit"], (1 + FREEDOM["gpl"]) / 2)),
    ("(MIT OR GPL-2.0", (["gpl", "mit"], FREEDOM["mit"])), ("MIT AND", (["mit"], FREEDOM["mit"])),
    ("MIT AND (", (["mit"], FREEDOM["mit"])), ("MIT licensed code", (["mit"], FREEDOM["mit"])), (") MIT", None), ("OR MIT", None),
    ("", None), ("MIT ) OR GPL-2.0", (["mit"], FREEDOM["mit"])), ("(MIT) (GPL-2.0)", (["mit"], FREEDOM["mit"])),
    ("MIT OR (GPL-2.0 AND", (["gpl", "mit"], FREEDOM["mit"])), ("((MIT))", (["mit"], FREEDOM["mit"])),
    ("(MIT OR BSD-2-Clause) WITH x", (["bsd", "mit"], FREEDOM["mit"])), ("CC-BY-NC-SA-4.0", (["cc-by-nc-sa"], FREEDOM["cc-by-nc-sa"]))])
def test_precedence_and_malformed_expressions(text, expected):
    assert value(text) == expected


def test_places_equal_brute_force():
    draw = random.Random(3)
    pieces = [w for p in {**BASE_PHRASES, **NOTICES} for w in (p, p.split()[0], p.split()[-1], p.upper())] + ["x", "É", "ümit", "9"]
    scanner = licences.Scanner()
    for _ in range(400):
        text = "".join(draw.choice(pieces) + draw.choice([" ", ", ", "\n", "-", "_", "'"]) for _ in range(draw.randrange(30)))
        count, base = brute_places(text, BASE_PHRASES)
        found = scanner.scan(text.encode())
        assert (found["n_words"], found["base_places"]) == (count, [k for k, _ in base])
        everything = brute_places(text, {**BASE_PHRASES, **NOTICES})[1]
        inner = [(k, len(p.split()), NOTICES[p]) for k, p in everything if p in NOTICES]
        kept = [a for a in inner if not any(b != a and b[0] <= a[0] and a[0] + a[1] <= b[0] + b[1] for b in inner)]
        assert [tuple(p.values()) for p in found["places"]] == kept
        assert set(BASE_PHRASES[p] for _, p in base) <= set(found["labels"]) and 0 <= found["score"] <= 1


def test_rows(docs):
    found = {r.doc_id: r for r in licences.scan(docs(
        (1, None), (2, ""), (3, "# SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */\nx y"),
        (4, "Licensed under the MIT License or, at your option, the Apache License, Version 2.0."),
        (5, "Licensed under CC BY-NC 4.0. É GNU General Public License"), (6, "a " * 200_000 + "mit-license MIT_LICENSE"), (None, "MIT license"),
        (7, "general public mit license license"))).collect()}
    assert len(found) == 8
    assert found[1][1:] == found[2][1:] == (0, [], [], [], [], [], 0.0)
    assert found[3].labels == ["apache", "gpl", "mit"] and found[3].score == pytest.approx((1 + FREEDOM["gpl"]) / 2)
    assert found[4].labels == ["apache", "mit"] and found[4].score == FREEDOM["mit"] and found[4].base_places == [3, 10]
    assert found[5].labels == ["cc-by-nc", "gpl"] and found[5].score == FREEDOM["cc-by-nc"]
    assert found[6].base_places == [200_000, 200_002] and found[None].base_places == [0] and found[7].base_places == [2]


def test_empty_tables_and_repeated_rows(docs, odd):
    assert licences.scan(docs()).collect() == []
    assert len(licences.scan(odd).collect()) == odd.count()
