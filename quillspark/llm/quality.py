"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades: 0 for low quality, 1 for good but toxic text, 2 for good clean text. With x the hashed features of
a text (its distinct words, and coarse classes of its length, repetition and character mix), shared
weights w and ordered thresholds t, P(grade <= j) = 1 / (1 + exp(w x - t_j)). The expected grade is the sum
of the tail probabilities P(grade > j); a text is kept if the tail of the best grade reaches the model's
threshold: KEEP, or less where KEEP would lose clean rows of a validation fold.

The model is fitted on the driver on at most MAX_LABELLED labelled rows, those with the least hash of
doc_id, each document once: a bounded sample at any size. Every FOLDS-th of them is held out of a first fit, which sets the
threshold; the second fit takes them all. Features that no grade favours are screened out by a chi-square
test, and an L1 penalty leaves few weights, so long texts gather no noise. Scoring reads every whole text
once, without a shuffle.

Null texts count as empty. Labels that are null are ignored; several labels of one document count as its
worst. With no labels, or only one grade among them, every text gets the observed shares of the grades
(all of the best grade if there are none) and is kept accordingly. Repeated rows and null ids are scored
row by row; other columns are not touched; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.worker_tables import claim
from quillspark.session import ship_package

GRADES = 3
MAX_LABELLED = 6000
#: The threshold goes down from KEEP in STEP until this share of the clean rows held out is kept.
KEEP, STEP, CLEAN_KEPT, FOLDS = 0.6, 0.02, 0.995, 5
#: Documents with a feature, at least, and its chi-square over the grades.
LEAST_SUPPORT, LEAST_CHI2 = 3, 15.0
#: The L1 penalty, divided by the number of labelled rows: it weighs as much as a fixed number of rows at any size.
PENALTY = 1.0
ROUNDS = 300
#: Features that the first fit leaves a weight are fitted again under this share of the penalty.
RELAXED = 0.1
DIMENSIONS = 1 << 22
#: Letters at the beginning of a word that are a feature of their own.
BEGINNING = 4
PUNCTUATION = ".,;:!?\"'()[]{}<>|#$%&*+-=/\\_"
TABLE_ENTRIES = 300_000


def bucket(token: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(token) % DIMENSIONS


def word_buckets(word: str) -> tuple[int, ...]:
    """The features of a word: itself and its beginning."""
    word = word.strip(PUNCTUATION)
    return bucket(word), bucket(f"\0begin={word[:BEGINNING]}")


def _classes() -> dict[str, np.ndarray]:
    """Byte classes whose shares are features."""
    sets = {
        "upper": bytes(range(65, 91)),
        "lower": bytes(range(97, 123)),
        "digit": b"0123456789",
        "space": b" \t\r",
        "line": b"\n",
        "stop": b".,;:",
        "loud": b"!?",
        "bar": b"|",
        "symbol": b"#$%&*+=~^@_/\\<>{}[]",
        "high": bytes(range(128, 256)),
    }
    return {k: np.frombuffer(v, np.uint8) for k, v in sets.items()}


CLASSES = _classes()


def shape_tokens(text: str, words: int, distinct: int) -> list[str]:
    """Coarse classes of what the words do not tell, as tokens of the same feature space."""
    data = np.frombuffer(text.encode(), np.uint8)
    counts = np.bincount(data, minlength=256)
    out = [f"\0words={int(np.log2(words + 1))}", f"\0repeat={int(np.log2(words + 1)) // 2},{int(8 * distinct / max(words, 1))}", f"\0length={min(12, len(data) // max(words, 1))}"]
    for name, members in CLASSES.items():
        share = counts[members].sum() / max(len(data), 1)
        out.append(f"\0{name}={int(np.log2(1 + 1000 * share) * 1.5)}")
    return out


class _Buckets(dict):
    def __missing__(self, word: str) -> tuple[int, ...]:
        self[word] = found = word_buckets(word)
        return found


def features(text: str | None, buckets: dict[str, tuple[int, ...]]) -> list[int]:
    """The distinct feature numbers of a text."""
    text = text or ""
    words = text.lower().split()
    own = set(words)
    if len(buckets) > TABLE_ENTRIES:
        buckets.clear()
    return sorted({*chain.from_iterable(map(buckets.__getitem__, own)), *map(bucket, shape_tokens(text, len(words), len(own)))})


@dataclass(frozen=True)
class Model:
    """Weights of the features that matter, and the ordered thresholds."""

    weights: dict[int, float]
    thresholds: tuple[float, ...]
    keep: float = KEEP

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > j) for each j."""
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(np.array(self.thresholds)[None, :] - score[:, None]))


def fit(where: np.ndarray, sizes: np.ndarray, grades: np.ndarray) -> Model:
    """The penalised maximum-likelihood fit, by accelerated proximal gradient steps.

    where has the features of all rows, one row after another; sizes has their numbers.
    """
    n = len(sizes)
    if not n or len(set(grades.tolist())) < 2:
        shares = [np.mean(grades > j) if n else 1.0 for j in range(GRADES - 1)]
        return Model({}, tuple(float(np.log((1 - s + 1e-9) / (s + 1e-9))) for s in shares))
    row = np.repeat(np.arange(n, dtype=np.int32), sizes)
    names, where = np.unique(where, return_inverse=True)
    observed = np.stack([np.bincount(where, weights=grades[row] == g, minlength=len(names)) for g in range(GRADES)])
    support, share = observed.sum(axis=0), np.array([np.mean(grades == g) for g in range(GRADES)])[:, None]
    expected = np.maximum(support * share, 1e-12)
    chi2 = np.where(share > 0, (observed - expected) ** 2 / expected / np.maximum(1 - support / n, 1e-9), 0).sum(axis=0)
    good = (support >= LEAST_SUPPORT) & (chi2 >= LEAST_CHI2)
    keep = good[where]
    row, where, names = row[keep], (np.cumsum(good) - 1)[where[keep]], names[good]

    def times(w: np.ndarray) -> np.ndarray:
        return np.bincount(row, weights=w[where], minlength=n)

    def back(g: np.ndarray) -> np.ndarray:
        return np.bincount(where, weights=g[row], minlength=len(names))

    # thresholds are t_0 and the logarithms of the gaps to the next ones
    def thresholds(b: np.ndarray) -> np.ndarray:
        return np.cumsum([b[0], *np.exp(b[1:])])

    # X'X is at most the diagonal of its row sums, as all features are 0 or 1: rare features may take long steps
    step = 1 / (0.5 * back(times(np.ones(len(names)))) / n + 1e-9)
    step_b = 0.5
    indicator = np.eye(GRADES)[grades]
    w, b = np.zeros(len(names)), np.array([np.log(0.1), *[0.0] * (GRADES - 2)])
    full = PENALTY / n
    for penalty in (full, full * RELAXED):
        allowed = np.ones(len(names), bool) if penalty == full else w != 0
        ahead_w, ahead_b, pace = w, b, 1.0
        for _ in range(ROUNDS):
            t = thresholds(ahead_b)
            below = 1 / (1 + np.exp(np.clip(times(ahead_w)[:, None] - t[None, :], -30, 30)))
            bounds = np.concatenate([np.zeros((n, 1)), below, np.ones((n, 1))], axis=1)
            p = np.maximum((np.diff(bounds, axis=1) * indicator).sum(axis=1), 1e-12)
            slope = np.concatenate([np.zeros((n, 1)), below * (1 - below), np.zeros((n, 1))], axis=1)
            upper, lower = (slope[:, 1:] * indicator).sum(axis=1) / p, (slope[:, :-1] * indicator).sum(axis=1) / p
            grad_w = np.where(allowed, back(upper - lower) / n, 0)
            by_threshold = np.array([(-slope[:, j + 1] * (indicator[:, j] - indicator[:, j + 1]) / p).mean() for j in range(GRADES - 1)])
            grad_b = np.array([by_threshold.sum(), *[np.exp(ahead_b[k]) * by_threshold[k:].sum() for k in range(1, GRADES - 1)]])
            new_w = ahead_w - step * grad_w
            new_w = np.sign(new_w) * np.maximum(np.abs(new_w) - step * penalty, 0)
            new_b = ahead_b - step_b * grad_b
            faster = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
            ahead_w, ahead_b = new_w + (pace - 1) / faster * (new_w - w), new_b + (pace - 1) / faster * (new_b - b)
            w, b, pace = new_w, new_b, faster
    used = np.flatnonzero(w)
    return Model({int(names[k]): float(w[k]) for k in used}, tuple(float(x) for x in thresholds(b)))


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Model:
    """Fit on the labelled documents, at most limit of them."""
    ship_package(docs.sparkSession)
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    chosen = (
        labels.where("doc_id is not null and quality is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.min(grade).alias("grade"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = _Buckets()
        claim("quality", buckets)
        for batch in batches:
            rows = [features(t.as_py(), buckets) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int32()))], names=["doc_id", "grade", "features"])

    # the chosen labels are bounded by the limit, and so is what comes back: a repeated doc_id counts once
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    table = texts.mapInArrow(run, "doc_id long, grade int, features array<int>").toArrow().sort_by("doc_id")
    listed = table["features"].combine_chunks()
    where, sizes, grades = listed.flatten().to_numpy(), np.diff(listed.offsets.to_numpy()), table["grade"].to_numpy().astype(np.int64)
    return replace(fit(where, sizes, grades), keep=threshold(where, sizes, grades))


def threshold(where: np.ndarray, sizes: np.ndarray, grades: np.ndarray) -> float:
    """What keeps CLEAN_KEPT of the clean rows that a fit without them did not see, at most KEEP."""
    held = np.arange(len(sizes)) % FOLDS == 0
    inside = np.repeat(~held, sizes)
    model = fit(where[inside], sizes[~held], grades[~held])
    ends = np.cumsum(sizes)
    clean = [k for k in np.flatnonzero(held & (grades == GRADES - 1)).tolist()]
    if not clean:
        return KEEP
    score = np.array([sum(model.weights.get(f, 0.0) for f in where[ends[k] - sizes[k] : ends[k]].tolist()) for k in clean])
    best = np.sort(model.tails(score)[:, -1])
    least = best[int((1 - CLEAN_KEPT) * len(best))]
    steps = max(0, int(np.ceil((KEEP - least) / STEP - 1e-9)))
    return max(round(KEEP - STEP * steps, 6), STEP)


class _Weights(dict):
    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> tuple[int, ...]:
        self[word] = found = tuple(k for k in word_buckets(word) if k in self.model.weights)
        return found


_TABLES: dict[int, _Weights] = {}


def _table(model: Model) -> _Weights:
    name = hash((tuple(model.weights.items()), model.thresholds))
    if name not in _TABLES:
        _TABLES.clear()
        _TABLES[name] = _Weights(model)
    claim("quality", _TABLES[name], _TABLES)
    return _TABLES[name]


def scores(texts: list[str | None], model: Model) -> np.ndarray:
    """w x of each text."""
    table, weights = _table(model), model.weights
    out = []
    for text in texts:
        text = text or ""
        words = text.lower().split()
        own = set(words)
        if len(table) > TABLE_ENTRIES:
            table.clear()
        found = {*chain.from_iterable(map(table.__getitem__, own)), *map(bucket, shape_tokens(text, len(words), len(own)))}
        out.append(sum(weights.get(k, 0.0) for k in sorted(found)))
    return np.array(out)


def grade(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, expected_grade, p_best, keep) of each row."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tails = model.tails(scores(batch.column(1).to_pylist(), model))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]), pa.array(tails[:, -1] >= model.keep)],
                names=["doc_id", "expected_grade", "p_best", "keep"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, expected_grade double, p_best double, keep boolean")


def select(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs that are kept, all columns."""
    ship_package(docs.sparkSession)
    column = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tails = model.tails(scores(batch.column(column).to_pylist(), model))
            yield batch.filter(pa.array(tails[:, -1] >= model.keep))

    return docs.mapInArrow(run, docs.schema)
