"""I-Match fingerprints with randomised lexicon subsets, in DataFrame functions only.

The lexicon holds the terms whose share of documents lies in a band: neither frequent ones, which tell
nothing, nor rare ones, which one edit removes. A share of at least ``low`` bounds the lexicon by the mean
number of terms in a document over ``low``, whatever the number of documents. Random cells divide it, and
CELLS of them are the subsets; the number of all cells follows a document's number of terms, so that a
subset meets one or two of its terms, and a fingerprint carries two neighbouring levels, so that texts of
somewhat different length still compare. A subset's part is the hash of the document's sorted terms in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orefold.llm.common import SPACE, check_columns, materialise, partitions, whole_text

CELLS = 16
LEAST_LEVEL = 4
WIDTH = 6
EMPTY = "-" * WIDTH
KINDS = ("own", "changed")


def terms(text: Column) -> Column:
    """Distinct lower-case words."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), SPACE)), "")


def _code(term: Column) -> Column:
    return F.xxhash64(term)


def _cells(level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), level)


def lexicon(docs: DataFrame, low: float, high: float) -> tuple[DataFrame, bool]:
    """Terms of the band (column ``term``), and whether they are few enough to be sent to all tasks."""
    found = docs.select(F.explode(terms(whole_text())).alias("term")).groupBy("term").count()
    many = docs.count()
    band = materialise(found.where(F.col("count").between(max(1.0, low * many), max(1.0, high * many))).select("term"), "lexicon")
    size = band.agg(F.coalesce(F.sum(F.octet_length("term") + 40), F.lit(0))).first()[0]
    return band, size <= 64 << 20


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) with ``id``, ``next_id`` and ``next_text`` of the row that follows by doc_id.

    Nulls come first, ties are ordered by text, and the first row follows the last. Rows are dealt out
    by ranges of doc_id; the first row of each range is copied to the end of the range before it.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)).cast("bigint"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")).withColumn("key", key)
    many = partitions(docs.sparkSession)
    cuts = rows.agg(F.percentile_approx("key", [k / many for k in range(1, many)] or [0.5], 10_000)).first()[0] or []
    edges = sorted(set(cuts))
    edge = F.array(*[F.lit(v).cast("bigint") for v in edges]).cast("array<bigint>")
    rows = rows.withColumn("range", F.size(F.filter(edge, lambda v: v <= F.col("key"))).cast("bigint"))
    firsts = sorted(tuple(r) for r in rows.groupBy("range").agg(F.min("key")).collect())  # a row for each range
    if not firsts:
        return rows.select("doc_id", "text", F.lit(0).cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("next_id"),
                           F.col("text").alias("next_text"))
    before = {key: firsts[k - 1][0] for k, (_, key) in enumerate(firsts)}
    moved = F.create_map(*[F.lit(v).cast("bigint") for pair in before.items() for v in pair])
    heads = rows.where(F.col("key").isin(list(before))).groupBy("key", "range").agg(F.min("text").alias("text"))
    heads = heads.select(F.lit(None).cast("bigint").alias("doc_id"), "text", "key", moved[F.col("key")].alias("range"),
                         F.lit(1).alias("head"), (F.shiftleft(F.col("range"), 40) + 1).alias("head_id"))
    placed = rows.select("*", F.lit(0).alias("head"), F.lit(None).cast("bigint").alias("head_id")).unionByName(heads)
    order = Window.partitionBy("range").orderBy("head", "key", "text")
    placed = placed.select(
        "doc_id", "text", "head", (F.shiftleft(F.col("range"), 40) + F.row_number().over(order)).alias("id"),
        F.lead("text").over(order).alias("next_text"), F.lead("head_id").over(order).alias("head_id"))
    return placed.where("head = 0").select("doc_id", "text", "id", F.coalesce("head_id", F.col("id") + 1).alias("next_id"), "next_text")


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last quarter of code points replaced by the first as many of ``following``."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(following, F.lit(1), quarter))


def _level(words: Column) -> Column:
    return F.greatest(F.lit(LEAST_LEVEL), F.floor(F.log2(F.greatest(F.size(words), F.lit(1)) * 0.5)).cast("int"))


def in_subsets(words: Column, level: Column) -> Column:
    """Those terms that fall into the subsets of ``level``; the finer subsets of the next level are parts of these."""
    return F.filter(words, lambda t: F.pmod(_code(t), _cells(level)) < CELLS)


def _short(code: Column) -> Column:
    return F.lpad(F.lower(F.hex(F.pmod(code, F.lit(1 << 24)))), WIDTH, "0")


def _print(level: Column, whole: Column, codes: Column) -> Column:
    """(level, parts): the parts of ``level`` and then of the next, joined; level 0 and ``whole`` without codes."""
    ready = F.sort_array(codes)

    def parts(more: int) -> Column:
        def part(cell: Column) -> Column:
            own = F.filter(ready, lambda c: F.pmod(c, _cells(level + more)) == cell)
            return F.when(F.size(own) > 0, _short(F.xxhash64(own))).otherwise(EMPTY)

        return F.concat_ws("", F.transform(F.sequence(F.lit(0), F.lit(CELLS - 1)), part))

    held = F.size(codes) > 0
    return F.struct(F.when(held, level).otherwise(0).alias("level"),
                    F.when(held, F.concat(parts(0), parts(1))).otherwise(whole).alias("parts"))


def prints(rows: DataFrame, band: DataFrame, small: bool) -> DataFrame:
    """(id, own, changed), the fingerprints of both texts, for rows (id, and struct columns ``own`` and ``changed``
    of level, whole and terms).

    Only terms in a subset leave their row, and only those of the band go on to be grouped. A row without one
    gets level 0 and a single part from all its terms.
    """
    def tagged(k: int) -> Column:
        return F.transform(f"{KINDS[k]}.terms", lambda t: F.struct(F.lit(k).alias("kind"), t.alias("term")))

    spread = rows.select("id", F.explode(F.concat(*map(tagged, range(len(KINDS))))).alias("x")).select("id", "x.kind", "x.term")
    held = spread.join(F.broadcast(band) if small else band, "term", "left_semi")
    codes = held.select("id", "kind", _code(F.col("term")).alias("code")).groupBy("id").agg(*[
        F.collect_list(F.when(F.col("kind") == k, F.col("code"))).alias(f"{kind}_codes") for k, kind in enumerate(KINDS)])
    narrow = rows.select("id", *[
        F.struct(f"{kind}.level", f"{kind}.whole").alias(kind) for kind in KINDS])
    joined = narrow.join(codes, "id", "left")
    none = F.array().cast("array<bigint>")
    return joined.select("id", *[
        _print(F.col(f"{kind}.level"), F.col(f"{kind}.whole"), F.coalesce(f"{kind}_codes", none)).alias(kind) for kind in KINDS])


def as_text(print_: Column) -> Column:
    return F.concat(F.lpad(F.lower(F.hex(print_["level"])), 2, "0"), F.lit(":"), print_["parts"])


def likeness(one: Column, other: Column) -> Column:
    """Share of equal parts among those that either fingerprint fills, on the levels that both have."""
    def share(x: Column, start: int, y: Column, other_start: int, many: int) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.lit(many - 1)), lambda k: F.struct(
            F.substring(x, k * WIDTH + start * WIDTH + 1, F.lit(WIDTH)).alias("x"),
            F.substring(y, k * WIDTH + other_start * WIDTH + 1, F.lit(WIDTH)).alias("y")))
        filled = F.size(F.filter(pairs, lambda p: (p["x"] != EMPTY) | (p["y"] != EMPTY)))
        equal = F.size(F.filter(pairs, lambda p: (p["x"] == p["y"]) & (p["x"] != EMPTY)))
        return F.when(filled > 0, equal / filled).otherwise(F.lit(0.0))

    a, b, level_a, level_b = one["parts"], other["parts"], one["level"], other["level"]
    return (F.when((level_a == 0) & (level_b == 0), (a == b).cast("double"))
            .when(level_a == level_b, share(a, 0, b, 0, CELLS))
            .when((level_a > 0) & (level_b == level_a + 1), share(a, CELLS, b, 0, CELLS))
            .when((level_b > 0) & (level_a == level_b + 1), share(a, 0, b, CELLS, CELLS)).otherwise(F.lit(0.0)))


def fingerprint_documents(docs: DataFrame, low: float = 0.001, high: float = 0.05) -> DataFrame:
    """Fingerprints of documents (doc_id, text) and of their edited texts, and how alike they are.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Null
    text counts as empty. Repeated rows are rows of their own; a single row follows itself.
    """
    check_columns(docs, ["doc_id", "text"])
    band, small = lexicon(docs, low, high)
    rows = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.select("doc_id", "id", "next_id", F.length("text").cast("bigint").alias("n_chars"),
                       F.sha2("edited", 256).alias("edited_sha256"), terms(F.col("text")).alias("own"),
                       terms(F.col("edited")).alias("changed"))
    chosen = materialise(rows.select("doc_id", "id", "next_id", "n_chars", "edited_sha256", *[
        F.struct(_level(F.col(kind)).alias("level"), _short(F.xxhash64(F.sort_array(kind))).alias("whole"),
                 in_subsets(F.col(kind), _level(F.col(kind))).alias("terms")).alias(kind) for kind in KINDS]), "terms")
    found = materialise(prints(chosen, band, small), "prints")
    following = found.select(F.col("id").alias("next_id"), F.col("own").alias("following"))
    joined = chosen.drop(*KINDS).join(found, "id").join(following, "next_id")
    return joined.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"))
