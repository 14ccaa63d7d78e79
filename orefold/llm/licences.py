"""Licence scan of whole texts: which licences a text names, where, and how free they leave its use.

Two Aho-Corasick automata run over each text: one over its words for notice phrases, one over the raw text for
identifier tags, which an expression follows to the end of the line. Expressions (``(MIT OR Apache-2.0) AND
GPL-2.0-only WITH Classpath-exception-2.0``) are evaluated by a shunting-yard parser: WITH binds closest, then
AND, then OR. Notices in prose that stand close together with a single "or" or "and" between them are
read as an expression too. An expression's value is its freedom from 0 to 1: AND takes the stricter side, OR
the freer one (the user may choose), and an exception halves what a licence withholds.

A text's score is the least value among its expressions, since all of them hold, and 0 without any.

Malformed expressions count as far as they go: parsing ends at a word that cannot follow, an operator
without a right side is dropped, open brackets are closed at the end. Odd rows: a null text is empty and has no
findings, words or labels; repeated rows each have a row; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from orefold.llm.common import arrow_map, check_columns, lower_words, only, whole_text

# Phrases of the base labels, then further notices, tags, identifiers and values.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache license": "apache",
    "general public license": "gpl",
    "gnu general public license": "gpl",
    "gnu gpl": "gpl",
    "lesser general public license": "lgpl",
    "gnu lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "affero general public license": "agpl",
    "gnu affero general public license": "agpl",
    "bsd license": "bsd",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "isc license": "isc",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "cc0": "cc0",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "creative commons attribution noderivatives": "cc-by-nd",
    "released into the public domain": "public-domain",
}
TAGS = ["spdx-license-identifier:", "license-expression:", "spdx-licence-identifier:"]
#: Beginnings of identifiers; the longest one that fits counts.
IDENTIFIERS = {
    "mit": "mit", "apache": "apache", "gpl": "gpl", "lgpl": "lgpl", "agpl": "agpl", "bsd": "bsd", "0bsd": "bsd", "isc": "isc",
    "mpl": "mpl", "epl": "epl", "bsl": "bsl", "cc0": "cc0", "cc-by": "cc-by", "cc-by-sa": "cc-by-sa", "cc-by-nc": "cc-by-nc",
    "cc-by-nd": "cc-by-nd", "cc-by-nc-sa": "cc-by-nc-sa", "cc-by-nc-nd": "cc-by-nc-nd", "unlicense": "public-domain",
}
FREEDOM = {
    "public-domain": 1.0, "cc0": 1.0, "mit": 0.95, "isc": 0.95, "bsd": 0.95, "bsl": 0.95, "apache": 0.9, "cc-by": 0.85,
    "mpl": 0.6, "epl": 0.6, "lgpl": 0.5, "cc-by-sa": 0.45, "gpl": 0.4, "agpl": 0.3, "other": 0.25, "cc-by-nd": 0.15,
    "cc-by-nc": 0.1, "cc-by-nc-sa": 0.1, "cc-by-nc-nd": 0.05,
}
BINDING = {"or": 1, "and": 2, "with": 3}
#: Most words between two notices that an "or" or "and" joins.
BETWEEN = 8
_TOKEN = re.compile(r"[ \t]*([a-z0-9][a-z0-9.+:-]*|[()])")
RESULT = ("n_words bigint, base_places array<bigint>, base_phrases array<string>, places array<struct<start:bigint,words:bigint,label:string>>, "
          "expressions array<struct<text:string,labels:array<string>,value:double>>, labels array<string>, score double")


def label_of(identifier: str) -> str:
    """Family of a licence identifier in small letters; ``other`` when it is not known."""
    parts = re.split(r"-", identifier.rstrip("+"))
    for size in range(len(parts), 0, -1):
        found = IDENTIFIERS.get("-".join(parts[:size]))
        if found:
            return found
    return "other"


def evaluate(tokens: list[str]) -> tuple[str, list[str], float] | None:
    """Text, labels and value of a licence expression in small letters, by a shunting-yard over two stacks."""
    values: list[tuple[str, frozenset, float]] = []
    waiting: list[tuple[str, int]] = []  # operators and brackets, each with the number of values at that point

    def apply() -> None:
        name, _ = waiting.pop()
        right, left = values.pop(), values.pop()
        if name == "with":
            values.append((f"{left[0]} with {right[0]}", left[1], (1 + left[2]) / 2))
        else:
            pick = max if name == "or" else min
            values.append((f"({left[0]} {name} {right[0]})", left[1] | right[1], pick(left[2], right[2])))

    wanted = True  # an identifier or an opening bracket comes next
    for token in tokens:
        excepted = bool(waiting) and waiting[-1][0] == "with" and wanted
        if token in BINDING:
            if wanted:
                break
            if token == "with" and " " in values[-1][0]:
                break  # an exception belongs to one licence
            while waiting and waiting[-1][0] != "(" and BINDING[waiting[-1][0]] >= BINDING[token]:
                apply()
            waiting.append((token, len(values)))
            wanted = True
        elif token == "(":
            if not wanted or excepted:
                break
            waiting.append((token, len(values)))
        elif token == ")":
            if wanted or not any(name == "(" for name, _ in waiting):
                break
            while waiting[-1][0] != "(":
                apply()
            waiting.pop()
        else:
            if not wanted:
                break
            label = label_of(token)
            values.append((token, frozenset() if excepted else frozenset([label]), FREEDOM[label]))
            wanted = False
    while waiting:
        if waiting[-1][0] == "(" or len(values) <= waiting[-1][1]:
            waiting.pop()  # never closed, or without a right side
        else:
            apply()
    if not values:
        return None
    text, labels, value = values[0]
    return text, sorted(labels), value


class Scanner:
    """Both automata; one for each worker."""

    def __init__(self):
        self.phrases, self.tags = ahocorasick.Automaton(), ahocorasick.Automaton()
        for phrase in {**BASE_PHRASES, **NOTICES}:
            self.phrases.add_word(f" {phrase} ", phrase)
        for tag in TAGS:
            self.tags.add_word(tag, tag)
        self.phrases.make_automaton()
        self.tags.make_automaton()

    def notices(self, words: list[bytes]) -> list[tuple[int, str]]:
        """(first word, phrase) of every place where a phrase's words stand consecutively."""
        text = b" ".join([b"", *words, b""]).decode("latin-1")  # one character for each byte
        found, word, at = [], 0, 0
        for end, phrase in self.phrases.iter(text):
            start = end - len(phrase) - 1
            word, at = word + (text.count(" ", at, start) if start >= at else -text.count(" ", start, at)), start
            found.append((word, phrase))
        return sorted(found)

    def tagged(self, text: bytes) -> list[list[str]]:
        """Tokens of the expressions that follow tags, up to what cannot be part of one."""
        lowered = text.lower().decode("latin-1")
        out = []
        for end, _ in self.tags.iter(lowered):
            tokens, at = [], end + 1
            while (match := _TOKEN.match(lowered, at)) is not None:
                tokens.append(match.group(1))
                at = match.end()
            out.append(tokens)
        return out

    def scan(self, text: bytes) -> dict:
        words = lower_words(text)
        found = self.notices(words)
        base = [start for start, phrase in found if phrase in BASE_PHRASES]
        places = longest((start, len(phrase.split()), NOTICES[phrase]) for start, phrase in found if phrase in NOTICES)
        expressions = [evaluate(tokens) for tokens in [*self.tagged(text), *in_prose(words, places)]]
        expressions = [e for e in expressions if e is not None]
        labels = {BASE_PHRASES[phrase] for _, phrase in found if phrase in BASE_PHRASES}
        labels |= {label for _, names, _ in expressions for label in names}
        return {
            "n_words": len(words), "base_places": base, "base_phrases": [phrase for _, phrase in found if phrase in BASE_PHRASES],
            "places": [dict(zip(("start", "words", "label"), p)) for p in places],
            "expressions": [dict(zip(("text", "labels", "value"), e)) for e in expressions],
            "labels": sorted(labels), "score": min((e[2] for e in expressions), default=0.0)}


def longest(found) -> list[tuple[int, int, str]]:
    """Places without those that lie within another one."""
    out: list[tuple[int, int, str]] = []
    for place in sorted(found, key=lambda p: (p[0], -p[1])):
        if not out or place[0] + place[1] > out[-1][0] + out[-1][1]:
            out.append(place)
    return out


def in_prose(words: list[bytes], places: list[tuple[int, int, str]]) -> Iterator[list[str]]:
    """Notices as expressions; neighbours are joined when the few words between them hold one "or" or "and"."""
    tokens: list[str] = []
    last = 0
    for start, size, label in places:
        if tokens:
            joined = [w.decode() for w in words[last:start] if w in (b"or", b"and")] if start - last <= BETWEEN else []
            if len(joined) == 1:
                tokens.append(joined[0])
            else:
                yield tokens
                tokens = []
        tokens.append(label)
        last = max(last, start + size)
    if tokens:
        yield tokens


_SCANNER: list[Scanner] = []


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and, from the whole text: number of words, starts of the base phrases and the phrases, places of notices (word numbers),
    expressions with labels and value, all labels (sorted), score."""
    check_columns(docs, ["doc_id", "text"])
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _SCANNER:
            _SCANNER.append(Scanner())
        for batch in batches:
            found = [_SCANNER[0].scan(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            rest = pa.RecordBatch.from_pylist(found, FIELDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("doc_id")), *rest.columns], ["doc_id", *FIELDS.names])

    texts = only(docs, "doc_id", "text").withColumn("text", whole_text().cast("binary"))
    return arrow_map(texts, run, f"doc_id {kind}, {RESULT}")


FIELDS = pa.schema([
    ("n_words", pa.int64()), ("base_places", pa.list_(pa.int64())), ("base_phrases", pa.list_(pa.string())),
    ("places", pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("label", pa.string())]))),
    ("expressions", pa.list_(pa.struct([("text", pa.string()), ("labels", pa.list_(pa.string())), ("value", pa.float64())]))),
    ("labels", pa.list_(pa.string())), ("score", pa.float64())])
