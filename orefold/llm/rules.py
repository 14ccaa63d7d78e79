"""Quality rules: text statistics and a learned decision list, in DataFrame functions only.

Sequential covering: a rule is a conjunction of thresholds. It grows by the condition with the highest
FOIL gain on two thirds of the labelled rows and is cut back to the prefix that does best on the rest;
rows that it covers leave, and the next rule is sought. Every step is one grouped count over the labelled
statistics, at most one row for each feature, bin and fold, so nothing grows with the data but the scan.
The list becomes one conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orefold.llm.common import check_columns, materialise, own_columns, SPACE, whole_text

#: White space that separates words, and the symbols counted (fixed values).
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Quantiles of each class whose values become thresholds.
QUANTILES = [k / 16 for k in range(1, 16)]


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def statistics(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``keep`` (as ``__keep_<name>``), and the text statistics of documents (doc_id, text), from whole texts.

    n_words, word_chars (code points in words), n_symbols, n_lines (lines with a word), n_dup_lines (equal
    to an earlier one), n_repeat_words (words in windows of five that occur twice or more, compared by
    64-bit hashes within the text), n_upper (A-Z). Null text has no words; each row is answered by itself.
    """
    check_columns(docs, ["doc_id", "text"])
    text = whole_text()
    kept = [f"__keep_{c}" for c in keep]
    base = docs.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, kept)], F.col("doc_id").cast("bigint"), F.array_remove(F.split(text, SPACE), "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: F.length(_without(line, BLANKS)) > 0).alias("lines"),
        F.length(_without(text, BLANKS)).alias("word_chars"),
        (F.length(text) - F.length(_without(text, SYMBOLS))).alias("n_symbols"),
        (F.length(text) - F.length(_without(text, UPPER))).alias("n_upper"))
    n = F.size("words")
    hashed = base.select(
        *[F.col(f"`{k}`") for k in kept], "doc_id", "word_chars", "n_symbols", "n_upper", n.alias("n_words"), F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                                        lambda k: F.xxhash64(F.slice("words", k, WINDOW))))
        .otherwise(F.array().cast("array<bigint>")).alias("windows"))
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = hashed.withColumn("ordered", F.when(repeats, F.sort_array(
        F.transform("windows", lambda h, k: F.struct(h.alias("h"), k.alias("k")))))).drop("windows")
    same = lambda s, k: F.coalesce(F.get("ordered", k)["h"] == s["h"], F.lit(False))
    places = ordered.withColumn("places", F.sort_array(F.transform(
        F.filter("ordered", lambda s, k: same(s, k - 1) | same(s, k + 1)), lambda s: s["k"]))).drop("ordered")
    covered = F.aggregate(
        F.transform("places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("places", k + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda total, x: total + x)
    counts = places.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)))
    return counts.select(*[F.col(f"`{k}`") for k in kept], "doc_id", *[F.col(c).cast("bigint") for c in [*BASE, "n_lines", "n_upper"]])


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def features() -> dict[str, Column]:
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"),
        "chars_per_word": F.col("word_chars") / per_word,
        "symbols_per_word": F.col("n_symbols") / per_word,
        "upper_share": F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)),
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / per_word,
        "words_per_line": F.col("n_words") / F.greatest(F.col("n_lines"), F.lit(1)),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value, edge = features()[self.feature], F.lit(self.threshold)
        return value >= edge if self.at_least else value < edge

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def rule_number(rules: list[Rule]) -> Column:
    """Number, from 1, of the first rule that a row meets; 0 for none."""
    out = F.lit(0)
    for k in range(len(rules), 0, -1):
        out = F.when(rules[k - 1].column(), F.lit(k)).otherwise(out)
    return out


def _precision(good: float, bad: float) -> float:
    return bad / (good + bad) if good + bad else 0.0


def learn(labelled: DataFrame, most_rules: int = 8, most_conditions: int = 4, precision: float = 0.9,
          support: int = 4) -> list[Rule]:
    """Rules that find rejected rows among statistics with a boolean column ``rejected``.

    A rule is kept if it reaches ``precision`` on both folds together and covers ``support`` rejected
    rows. Rows with a null label take no part; with one class only there are no rules.
    """
    rows = labelled.where("rejected is not null").select(
        "rejected", F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("fold"), *[c.alias(n) for n, c in features().items()])
    names = list(features())
    cuts = rows.groupBy("rejected").agg(*[F.percentile_approx(n, QUANTILES, 1000).alias(n) for n in names]).collect()
    if len(cuts) < 2:
        return []
    edges = {n: sorted({float(v) for r in cuts for v in (r[n] or [])}) for n in names}

    def bin_of(name: str) -> Column:
        edge = F.array(*[F.lit(v) for v in edges[name]]).cast("array<double>")
        return F.size(F.filter(edge, lambda v: v <= F.col(name)))

    binned = materialise(rows.select("rejected", "fold", *[bin_of(n).alias(n) for n in names]), "labelled")
    left, rules = F.lit(True), []

    def holds(c: Condition) -> Column:
        k = edges[c.feature].index(c.threshold) + 1
        return F.col(c.feature) >= k if c.at_least else F.col(c.feature) < k

    for _ in range(most_rules):
        where, chosen, scores = left, [], []
        for _ in range(most_conditions):
            long = F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("bin")) for n in names])).alias("x")
            found = binned.where(where).select("rejected", (F.col("fold") < 2).alias("grow"), long).groupBy(
                "x.f", "x.bin", "grow").agg(F.count_if("rejected").alias("bad"), F.count_if(~F.col("rejected")).alias("good"))
            counts: dict[tuple[str, bool], dict[int, tuple[int, int]]] = {}
            for r in found.collect():  # at most features x bins x 2 rows
                counts.setdefault((r[0], r[2]), {})[r[1]] = (r[3], r[4])
            if not counts:
                break
            best = None
            total = [sum(v[k] for v in counts.get((names[0], True), {}).values()) for k in (0, 1)]
            if not total[0]:
                break
            for name in names:
                for k, threshold in enumerate(edges[name], 1):
                    for at_least in (True, False):
                        bad, good = (sum(v[i] for b, v in counts.get((name, True), {}).items() if (b >= k) == at_least)
                                     for i in (0, 1))
                        if bad:
                            gain = bad * (math.log2(_precision(good, bad)) - math.log2(_precision(total[1], total[0])))
                            if gain > 1e-9 and (best is None or gain > best[0]):
                                best = gain, Condition(name, at_least, threshold), k
            if best is None:
                break
            _, condition, k = best
            bad, good, bad_held, good_held = (
                sum(v[i] for b, v in counts.get((condition.feature, grow), {}).items() if (b >= k) == condition.at_least)
                for grow in (True, False) for i in (0, 1))
            chosen.append(condition)
            scores.append((bad_held, good_held, bad + bad_held, good + good_held))
            where = where & holds(condition)
            if not good:
                break
        if not chosen:
            break
        # The shortest prefix that is best on the rows kept back.
        value = [(b - g) / (b + g) if b + g else -1.0 for b, g, _, _ in scores]
        keep = value.index(max(value)) + 1
        bad, good = scores[keep - 1][2:]
        if bad < support or _precision(good, bad) < precision:
            break
        rules.append(Rule(tuple(chosen[:keep])))
        covered = F.lit(True)
        for c in chosen[:keep]:
            covered = covered & holds(c)
        left = left & ~covered
    return rules


def labelled_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of labelled documents; of repeated labels the worst counts."""
    check_columns(labels, ["doc_id", "quality"])
    marks = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").alias("quality"))
    return stats.join(marks, "doc_id").withColumn("rejected", F.col("quality") == 0)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, base_failed, the number of the first rule met (0: none) and kept, for every row of
    ``docs`` (doc_id, text); rules are learned from all labelled rows. Columns: see ``statistics``."""
    stats = materialise(statistics(docs), "statistics")
    rules = learn(labelled_rows(stats, labels))
    return stats.withColumn("base_failed", base_failed()).withColumn("rule", rule_number(rules)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0))


@own_columns
def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``judge`` rejects, with all their columns. The statistics of the rows are
    taken twice, to learn and to judge, rather than stored with the texts."""
    learned = learn(labelled_rows(materialise(statistics(docs), "statistics"), labels))
    names = docs.columns
    # The row number keeps the condition above the statistics: pushed below, it would repeat them inside
    # their own loops.
    stats = statistics(docs, tuple(names)).withColumn("__row", F.monotonically_increasing_id())
    stats = stats.where((F.col("__row") >= 0) & ~base_failed() & (rule_number(learned) == 0))
    return stats.select(*[F.col(f"`__keep_{c}`").alias(c) for c in names])
