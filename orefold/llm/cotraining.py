"""Quality classifier by co-training.

Two logistic models see different things: one the words of a text, the other its metadata and layout
(source, language, lengths, shares of kinds of characters). In each round either labels, of all unlabelled
documents, the share of which it is most certain for the other to learn from. Both are calibrated on labelled
rows that neither learned from, and the calibrated log-odds are weighed together on them. All documents are
then scored where they are, without a shuffle.

Labelled rows are learned from on the driver, at most LABELLED of them (those with the smallest hash of
doc_id). Unlabelled rows stay on Spark, without a bound: their features are written once, exact histograms of
both views' log-odds give the cutoffs of a round, and all rows beyond these enter the other view's fit by the
gradient and the curvature of their mean loss, summed up for each feature. No label is stored: a row's follow
from the models and cutoffs of the rounds so far. Sums are of integers, so that a repeated task changes nothing.
"""

from __future__ import annotations

import math
import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orefold.llm.common import arrow_map, check_columns, discard, free_shuffles, materialise, own_columns, whole_text
from orefold.llm.common import field as column

#: Most labelled rows that the models are fitted on.
LABELLED = 8_000
#: What the rows that a view was given labels for weigh together, beside 1 for the labelled rows, whatever their number.
GIVEN = 0.25
#: Bins of a histogram of log-odds, which are cut at REACH, and units of a sum.
BINS, REACH, UNITS = 8_192, 40.0, 1 << 20
WORD_DIMS, META_DIMS = 1 << 17, 1 << 10
#: Words remembered in each Python worker.
REMEMBERED = 300_000
_PARTS = re.compile(r"[^\W\d_]+|\d|[^\w\s]+|_+")
#: Bytes of blanks, stops, marks, digits and capitals.
_KINDS = [list(k.encode()) for k in (" ", ".,", "#*$%&|<>!", string.digits, string.ascii_uppercase)]
_STEPS = np.array([0, 1, 2, 3, 5, 8, 12, 20, 30, 50, 80, 120, 200, 300, 500, 800, 1300, 2100, 3400, 5500, 1e4, 2e4, 1e5])


def _hash(name: str, dims: int) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % dims


def word_features(word: str) -> list[int]:
    """A word's letters in lower case, its marks in threes, and whether it is written in capitals."""
    out = []
    for p in _PARTS.findall(word):
        if p[0].isalpha():
            out.append(_hash(p.lower(), WORD_DIMS))
        else:
            out += [_hash("m" + p[k: k + 3], WORD_DIMS) for k in range(max(1, len(p) - 2))]
    if len(word) > 1 and word.isupper():
        out.append(_hash("#capitals", WORD_DIMS))
    return out


class WordParts(dict):
    def __missing__(self, word: str) -> list[int]:
        found = word_features(word)
        if len(self) < REMEMBERED:
            self[word] = found
        return found


def content(text: str, parts: WordParts) -> tuple[np.ndarray, np.ndarray, int]:
    """Feature numbers, how often each occurs, and the number of words. A value is a count over the root of that number,
    so that the values of a text have about the same size whatever its length."""
    words = text.split()
    ids = [k for w in words for k in parts[w]]
    found, counts = np.unique(np.array(ids, np.int32), return_counts=True)
    return found.astype("<i4"), counts.astype("<i4"), len(words)


def metadata(source: str | None, lang: str | None, n_chars: int | None, text: str) -> list[int]:
    """Feature numbers of the metadata and the layout; each has the value 1."""
    size = len(text) or 1
    lines = text.split("\n")
    held = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    blanks, stops, marks, digits, capitals = (int(held[k].sum()) for k in _KINDS)
    blanks += len(lines)
    numbers = {
        "n_chars": n_chars if n_chars is not None else len(text), "lines": len(lines), "line_chars": size / len(lines),
        "word_chars": 20 * size / blanks, "marks": 1000 * marks / size,
        "stops": 2000 * stops / size, "digits": 1000 * digits / size, "capitals": 1000 * capitals / size,
        "repeats": 100 * (1 - len(set(lines)) / len(lines))}
    names = [f"source={source}", f"lang={lang}"]
    names += [f"{k}:{int(np.searchsorted(_STEPS, v, side='right'))}" for k, v in numbers.items()]
    return sorted({_hash(n, META_DIMS) for n in names})


@dataclass
class Rows:
    """Sparse rows, one after the other."""

    starts: np.ndarray
    ids: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        starts = np.cumsum([0, *[len(r[0]) for r in rows]])
        join = lambda k, kind: np.concatenate([np.asarray(r[k], kind) for r in rows] or [np.zeros(0, kind)])
        return cls(starts, join(0, np.int64), join(1, np.float64))

    def take(self, index: np.ndarray) -> Rows:
        sizes = np.diff(self.starts)[index]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(starts[-1]) + np.repeat(self.starts[index] - starts[:-1], sizes)
        return Rows(starts, self.ids[at], self.values[at])

    def dot(self, weights: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(self.values * weights[self.ids])])
        return total[self.starts[1:]] - total[self.starts[:-1]]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Pull:
    """How the rows with given labels draw on a model: the gradient of their mean loss at the weights ``at``, an upper
    bound of its curvature there, and the number of rows of each feature. The intercept has the last place."""

    at: np.ndarray
    rows: np.ndarray
    gradient: np.ndarray
    curvature: np.ndarray


def fit(rows: Rows, labels: np.ndarray, dims: int, least_rows: int, pull: Pull | None = None, penalty: float = 1e-4,
        steps: int = 250) -> np.ndarray:
    """Weights, and the intercept in last place, of a logistic model; classes weigh alike.

    Features of fewer than ``least_rows`` rows are left out.
    """
    weights = np.zeros(dims)
    n = len(labels)
    of_row = np.repeat(np.arange(n), np.diff(rows.starts))
    if pull is None:
        pull = Pull(*np.zeros((4, dims + 1)))
    seen = np.bincount(rows.ids, minlength=dims) + pull.rows[:-1] >= least_rows
    at, drawn, bent = (x[:-1][seen] for x in (pull.at, GIVEN * pull.gradient, GIVEN * pull.curvature))
    at_b, drawn_b, bent_b = pull.at[-1], GIVEN * pull.gradient[-1], GIVEN * pull.curvature[-1]
    held = seen[rows.ids]
    number = np.cumsum(seen) - 1
    ids, values, of_row = number[rows.ids[held]], rows.values[held], of_row[held]
    many = int(seen.sum())
    w, bias, share = at.copy(), at_b, labels.mean()
    importance = np.where(labels > 0, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9)) / n
    pace, pace_b = np.full(many, 1e-8), 1e-8
    for _ in range(steps):
        z = np.bincount(of_row, weights=values * w[ids], minlength=n) + bias
        error = (_sigmoid(z) - labels) * importance
        step = np.bincount(ids, weights=values * error[of_row], minlength=many) + penalty * w + drawn + bent * (w - at)
        pace += step * step
        w -= 0.5 * step / np.sqrt(pace)
        step_b = error.sum() + drawn_b + bent_b * (bias - at_b)
        pace_b += step_b * step_b
        bias -= 0.5 * step_b / math.sqrt(pace_b)
    weights[np.flatnonzero(seen)] = w
    return np.append(weights, bias)


def calibrate(z: np.ndarray, labels: np.ndarray) -> tuple[float, ...]:
    """Slopes (not negative) of the columns of ``z`` and an intercept that turn them into log-odds, by damped
    Newton steps with smoothed targets."""
    z = z.reshape(len(labels), -1)
    good = labels.sum()
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (len(labels) - good + 2))
    scale = np.where(z.std(axis=0) > 0, z.std(axis=0), 1.0)
    x = np.column_stack([z / scale, np.ones(len(z))])

    def loss(w: np.ndarray) -> float:
        m = x @ w
        return float((np.logaddexp(0, m) - target * m).sum() + 0.01 * (w * w).sum())

    w = np.append(np.ones(z.shape[1]), 0.0)
    for _ in range(100):
        p = _sigmoid(x @ w)
        gradient = x.T @ (p - target) + 0.02 * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.02 * np.eye(len(w))
        step, size = np.linalg.solve(curve, gradient), 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):  # a full step can overshoot
            size /= 2
        w = w - size * step
        if abs(size * step).max() < 1e-9:
            break
    return (*np.maximum(w[:-1] / scale, 0.0).tolist(), float(w[-1]))


class NoModel(ValueError):
    """The labels do not tell good documents from bad ones."""


@dataclass
class Model:
    """Weights of both views and the calibrations; the score is the chance that a document is good."""

    content: np.ndarray
    metadata: np.ndarray
    scale: tuple[tuple[float, ...], ...] = ((1, 0), (1, 0), (1, 1, 0))
    #: Labels given in all rounds up to each.
    rounds: list[int] = field(default_factory=list)

    def combine(self, z_content, z_metadata):
        """Chances by content, by metadata, and by both."""
        (a, b), (c, d), (e, f, g) = self.scale
        x, y = a * z_content + b, c * z_metadata + d
        return _sigmoid(x), _sigmoid(y), _sigmoid(e * x + f * y + g)


#: Number of features, and least rows of a feature, of the views.
VIEWS = ((WORD_DIMS, 4), (META_DIMS, 2))


@dataclass
class Turn:
    """The models of a round, and for each the last bin that it calls bad and the first that it calls good."""

    models: list[np.ndarray]
    cuts: list[tuple[int, int]]


def _odds(rows: Rows, model: np.ndarray) -> np.ndarray:
    return rows.dot(model[:-1]) + model[-1]


def _bins(z: np.ndarray) -> np.ndarray:
    return np.minimum((np.clip(z, -REACH, REACH) + REACH) * (BINS / (2 * REACH)), BINS - 1).astype(np.int64)


def given(views: list[Rows], turns: list[Turn]) -> tuple[list[np.ndarray], np.ndarray]:
    """The labels that each view was given in ``turns`` (-1: none), and the rows that neither was given one for.

    What one view is certain of, the other learns; where they disagree, neither does.
    """
    labels = [np.full(len(rows.starts) - 1, -1) for rows in views]
    left = np.ones(len(labels[0]), bool)
    for turn in turns:
        said = []
        for rows, model, (low, high) in zip(views, turn.models, turn.cuts):
            at = _bins(_odds(rows, model))
            said.append(np.where(left & (at <= low), 0, np.where(left & (at >= high), 1, -1)))
        agreed = (said[0] < 0) | (said[1] < 0) | (said[0] == said[1])
        for k in (0, 1):
            labels[1 - k] = np.where(agreed & (said[k] >= 0), said[k], labels[1 - k])
        left &= ~(agreed & ((said[0] >= 0) | (said[1] >= 0)))
    return labels, left


def histograms(views: list[Rows], turns: list[Turn], models: list[np.ndarray]) -> np.ndarray:
    """Counts of rows without a given label by the bins of both views, one view after the other."""
    left = given(views, turns)[1]
    return np.concatenate([np.bincount(_bins(_odds(rows, m))[left], minlength=BINS) for rows, m in zip(views, models)])


def pulls(views: list[Rows], turns: list[Turn], models: list[np.ndarray]) -> np.ndarray:
    """Columns rows, gradient, curvature (in units) of the features, and intercept, of bad and of good given rows
    of both views, one after the other. The curvature bounds that of any change of weights (values are positive)."""
    out = []
    for rows, model, labels in zip(views, models, given(views, turns)[0]):
        for label in (0, 1):
            own = rows.take(np.flatnonzero(labels == label))
            chance = _sigmoid(_odds(own, model))
            sizes = np.diff(own.starts)
            total = np.add.reduceat(np.append(own.values, 0.0), own.starts[:-1]) * (sizes > 0) if len(sizes) else np.zeros(0)
            error, bend = chance - label, np.maximum(chance * (1 - chance), 0.05) * (1 + total)
            sums = [np.bincount(own.ids, weights=None if x is None else np.repeat(x, sizes) * own.values, minlength=len(model) - 1)
                    for x in (None, error, bend)]
            out.append(np.column_stack([np.append(sums[0], len(sizes)), np.append(sums[1], error.sum()) * UNITS,
                                        np.append(sums[2], bend.sum()) * UNITS]))
    return np.concatenate(out)


def _cuts(counts: np.ndarray, many_bad: int, many_good: int) -> tuple[int, int]:
    """The last bin of the lowest rows and the first of the highest; only bins below and above even odds."""
    low = int(np.searchsorted(np.cumsum(counts), many_bad))
    high = BINS - 1 - int(np.searchsorted(np.cumsum(counts[::-1]), many_good))
    return min(low, BINS // 2 - 1), max(high, BINS // 2)


def co_train(views: list[Rows], labels: np.ndarray, pool, rounds: int = 3, share: float = 0.08, steps: int = 2) -> Model:
    """``views`` are content and metadata of labelled rows, good (1) or bad (0); every fifth calibrates. ``pool`` sums
    the results of a function (``histograms`` or ``pulls``) over all unlabelled rows, for given turns and models.

    After each round both models take ``steps`` steps towards the rows that they were given labels for.
    """
    held, learn = np.arange(len(labels))[::5], np.flatnonzero(np.arange(len(labels)) % 5 > 0)
    if len(set(labels[learn])) < 2 or len(set(labels[held])) < 2:
        raise NoModel("both good and bad labelled documents are needed")
    truth = labels[learn].astype(np.float64)
    own = [rows.take(learn) for rows in views]
    models = [fit(rows, truth, dims, least) for rows, (dims, least) in zip(own, VIEWS)]
    turns: list[Turn] = []
    added = []
    for _ in range(rounds):
        counts = pool(histograms, turns, models).reshape(2, BINS)
        many = int(share * counts[0].sum())
        if not counts[0].sum():
            break
        bad = max(1, int(many * (1 - truth.mean())))
        turns.append(Turn(models, [_cuts(c, bad, max(1, many - bad)) for c in counts]))
        for _ in range(steps):
            sums, parts, start = pool(pulls, turns, models), [], 0
            for dims, _ in VIEWS:
                parts.append(sums[start: start + 2 * (dims + 1)].reshape(2, dims + 1, 3))
                start += 2 * (dims + 1)
            models = [_towards(rows, truth, view, part, model) for rows, view, part, model in zip(own, VIEWS, parts, models)]
        added.append(int(sum(part[:, -1, 0].sum() for part in parts)))
    test = [rows.take(held) for rows in views]
    z = [_odds(rows, model) for rows, model in zip(test, models)]
    truth = labels[held].astype(np.float64)
    one, two = calibrate(z[0], truth), calibrate(z[1], truth)
    both = calibrate(np.column_stack([one[0] * z[0] + one[1], two[0] * z[1] + two[1]]), truth)
    return Model(models[0].astype(np.float32), models[1].astype(np.float32), (one, two, both), added)


def _towards(rows: Rows, truth: np.ndarray, view: tuple[int, int], part: np.ndarray, model: np.ndarray) -> np.ndarray:
    """The model fitted anew with the pull of the given rows, whose classes weigh alike."""
    many = part[:, -1, 0]
    if not many.any():
        return model
    weight = np.where(many > 0, 1 / (np.count_nonzero(many) * np.maximum(many, 1)), 0.0) / UNITS
    gradient, curvature = (weight[:, None] * part[:, :, k] for k in (1, 2))
    return fit(rows, truth, *view, Pull(model, part[:, :, 0].sum(axis=0), gradient.sum(axis=0), curvature.sum(axis=0)), steps=80)


# -- with Spark -------------------------------------------------------------------------------------

_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _plain(docs: DataFrame) -> DataFrame:
    check_columns(docs, _COLUMNS)
    return docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text"), F.col("lang").cast("string"),
                       F.col("source").cast("string"), F.col("n_chars").cast("bigint"))


#: ``ids`` holds the lower 16 bits of ascending feature numbers of 17 bits, of which the first ``low`` have no bit above.
_FEATURES = "doc_id bigint, ids binary, low bigint, counts binary, words bigint, meta binary"


STORED = ("ids", "low", "counts", "words", "meta")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = WordParts()
    for batch in batches:
        doc_ids, texts, langs, sources, sizes = (batch.column(k).to_pylist() for k in range(5))
        found = [content(t, parts) for t in texts]
        meta = [np.array(metadata(*r), "<i4").tobytes() for r in zip(sources, langs, sizes, texts)]
        yield pa.RecordBatch.from_arrays([
            pa.array(doc_ids, pa.int64()), pa.array([f[0].astype("<u2").tobytes() for f in found], pa.binary()),
            pa.array([int(np.searchsorted(f[0], 1 << 16)) for f in found], pa.int64()),
            pa.array([f[1].tobytes() for f in found], pa.binary()), pa.array([f[2] for f in found], pa.int64()),
            pa.array(meta, pa.binary())], names=["doc_id", "ids", "low", "counts", "words", "meta"])


def _numbers(column_: pa.Array, kind: str = "<i4") -> tuple[np.ndarray, np.ndarray]:
    """Starts and numbers of a column of binary numbers."""
    sizes = np.array(pc.binary_length(column_), np.int64) // np.dtype(kind).itemsize
    return np.concatenate([[0], np.cumsum(sizes)]), np.frombuffer(b"".join(column_.to_pylist()), kind).astype(np.int64)


def _views(rows: pa.RecordBatch | pa.Table) -> list[Rows]:
    """Content and metadata of rows with the columns of features."""
    ids, low, counts, words, meta = (rows.column(rows.schema.get_field_index(n)) for n in STORED)
    starts, found = _numbers(ids, "<u2")
    sizes = np.diff(starts)
    found += np.where(np.arange(len(found)) >= np.repeat(starts[:-1] + np.array(low, np.int64), sizes), 1 << 16, 0)
    root = np.sqrt(np.maximum(np.array(words, np.float64), 1))
    starts_m, found_m = _numbers(meta)
    return [Rows(starts, found, _numbers(counts)[1] / np.repeat(root, sizes)), Rows(starts_m, found_m, np.ones(len(found_m)))]


def _pool(rows: DataFrame):
    """Sums of ``histograms`` or ``pulls`` over the features ``rows``: each task adds up its own, Spark those of tasks."""
    context = rows.sparkSession.sparkContext

    def total(function, turns: list[Turn], models: list[np.ndarray]) -> np.ndarray:
        sent = context.broadcast((turns, models))

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = None
            for batch in batches:
                found = function(_views(batch), *sent.value)
                sums = found.astype(np.float64) if sums is None else sums + found
            if sums is not None:
                sums = np.rint(sums.reshape(len(sums), -1)).astype(np.int64)
                at = np.flatnonzero(sums.any(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(np.ascontiguousarray(c)) for c in sums[at].T]], names=names)

        wide = 1 if function is histograms else 3
        names = ["at", *[f"sum_{k}" for k in range(wide)]]
        parts = arrow_map(rows, add, ", ".join(f"{n} bigint" for n in names))
        found = parts.groupBy("at").agg(*[F.sum(n).alias(n) for n in names[1:]]).toArrow()  # a row for each place at most
        out = np.zeros((2 * BINS if wide == 1 else sum(2 * (dims + 1) for dims, _ in VIEWS), wide))
        for k, n in enumerate(names[1:]):
            out[found["at"].to_numpy(), k] = found[n].to_numpy()
        sent.unpersist()
        del parts, found
        free_shuffles(rows.sparkSession)
        return out

    return total


def train(docs: DataFrame, labels: DataFrame, rounds: int = 3) -> Model:
    """Learns from labels (doc_id, quality, toxic): good is quality 1 and not toxic; of repeated labels the
    worst counts, and a null label is none."""
    check_columns(labels, ["doc_id", "quality", "toxic"])
    marks = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.min((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("good"))
    # Features meet the labels, not texts, and in the same way whatever the number of labels.
    rows = materialise(arrow_map(_plain(docs), _features, _FEATURES).join(marks.hint("merge"), "doc_id", "left"), "features")
    try:
        return _fit(rows, rounds)
    finally:
        discard(rows)  # the model is all that is left of them


def _fit(rows: DataFrame, rounds: int) -> Model:
    free_shuffles(rows.sparkSession)
    # Which rows to learn from is decided on narrow rows; at most LABELLED digests follow, a small side.
    digest = F.xxhash64("doc_id", *STORED)
    known = rows.where("good is not null").withColumn("digest", digest)
    chosen = known.select("digest", "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "digest").limit(LABELLED)
    sample = known.join(F.broadcast(chosen.distinct()), ["digest", "doc_id"], "left_semi").dropDuplicates(["digest"]).toArrow()
    sample = sample.sort_by([("doc_id", "ascending"), ("digest", "ascending")]).combine_chunks()
    good = np.array(sample["good"], np.int64)
    return co_train(_views(sample), good, _pool(rows.where("good is null").select(*STORED)), rounds)


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs`` with content_score, metadata_score, score and kept; columns of these names are replaced."""
    new = ["content_score", "metadata_score", "score", "kept"]
    rows = docs.drop(*new)
    check_columns(rows, _COLUMNS)
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_ = sent.value
        weights = model_.content

        class Weights(dict):
            def __missing__(self, word: str) -> float:
                value = float(sum(weights[k] for k in word_features(word)))
                if len(self) < REMEMBERED:
                    self[word] = value
                return value

        known = Weights()
        for batch in batches:
            at = [batch.schema.get_field_index(c) for c in ("text", "source", "lang", "n_chars")]
            texts, sources, langs, sizes = (batch.column(k).to_pylist() for k in at)
            z_c, z_m = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for k, text in enumerate(texts):
                text = text or ""
                words = text.split()
                z_c[k] = sum(map(known.__getitem__, words)) / math.sqrt(len(words) or 1) + weights[-1]
                z_m[k] = model_.metadata[metadata(sources[k], langs[k], sizes[k], text)].sum() + model_.metadata[-1]
            one, two, both = model_.combine(z_c, z_m)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(one), pa.array(two), pa.array(both), pa.array(both >= threshold)],
                names=[*batch.schema.names, *new])

    kinds = [T.DoubleType(), T.DoubleType(), T.DoubleType(), T.BooleanType()]
    return arrow_map(rows, judge, T.StructType([*rows.schema.fields, *[column(n, k) for n, k in zip(new, kinds)]]))


SCORES = {"content_score": "double", "metadata_score": "double", "score": "double", "kept": "boolean"}


def classify(docs: DataFrame, labels: DataFrame, rounds: int = 3, threshold: float = 0.5) -> DataFrame:
    """Learns from the labelled documents and scores all. Null text is empty; repeated rows are scored as
    often as they occur; an empty table gives an empty result. Without labels of both classes nothing can be
    learned: all scores are null and all rows are kept."""
    if not docs.isEmpty():
        try:
            return score(docs, train(docs, labels, rounds), threshold)
        except NoModel:
            pass
    return docs.drop(*SCORES).withColumns({n: F.lit(n == "kept" or None).cast(k) for n, k in SCORES.items()})


@own_columns
def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, with their own columns, whatever these are called."""
    return classify(docs, labels, **options).where("kept").select(*docs.columns)
