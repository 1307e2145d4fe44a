"""Language identification by sparse multinomial logistic regression.

Texts become TF-IDF vectors of character n-grams (1 to 3 characters, hashed), the model is
trained with follow-the-regularised-leader and an elastic-net penalty, and one temperature,
fitted on rows the training did not see, calibrates its probabilities.

Document frequencies are counted over every learning row, in tasks; the training itself uses
at most ``per_language`` rows of each language (a bounded sample drawn by hash, the same on
every run) and gets only their sparse vectors from the executors.  The ``most_languages``
commonest languages are learned (ties by name): the model has a column of weights for each.

Defined results: a text that is null or has no letter is ``und`` with score 1; rows without a
language teach nothing; with no rows to learn from, every text is ``und``.  Repeated rows
count as often as they occur in document frequencies and once in the sample.  Columns other than those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.llm.common import per_text, with_results

BITS = 15
SIZE = 1 << BITS
UNDETERMINED = "und"
PER_LANGUAGE = 600
MOST_LANGUAGES = 200


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # SIZE + 1 rows; the last is the bias
    temperature: float


def _letters() -> np.ndarray:
    """For each code point of the basic plane, itself if it is a letter and a space if not."""
    return np.array([i if chr(i).isalpha() else 32 for i in range(0x10000)], dtype=np.uint32)


class Vectors:
    """Counts of hashed character n-grams of a text; anything but letters is a single space."""

    def __init__(self) -> None:
        self.letters = _letters()

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        if not text:
            return None
        raw = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
        c = np.where(raw < 0x10000, self.letters[np.minimum(raw, 0xFFFF)], raw)
        if raw.max() >= 0x10000:
            c = np.array([x if chr(x).isalpha() else 32 for x in c.tolist()], dtype=np.uint32)
        blank = c == 32
        if blank.all():
            return None
        c = c[~(blank & np.concatenate(([False], blank[:-1])))]
        c = np.concatenate((c[:0] if c[0] == 32 else [32], c, c[:0] if c[-1] == 32 else [32]))
        c = c.astype(np.uint32)
        one = c * np.uint32(0x9E3779B1)
        two = (one[:-1] ^ (c[1:] + np.uint32(0x7F4A7C15))) * np.uint32(0x85EBCA6B)
        three = (two[:-1] ^ (c[2:] + np.uint32(0x165667B1))) * np.uint32(0xC2B2AE35)
        hashed = np.concatenate((one, two, three)) >> np.uint32(32 - BITS)
        counts = np.bincount(hashed, minlength=SIZE)
        at = np.flatnonzero(counts)
        return at, counts[at]


def weigh(found: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, counts = found
    x = np.log1p(counts) * idf[at]
    return at, x / max(np.sqrt(x @ x), 1e-12)


def document_frequencies(docs: DataFrame, text: str) -> tuple[int, np.ndarray]:
    """Number of texts with letters, and of those in which each n-gram occurs."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors, seen, total = Vectors(), np.zeros(SIZE, dtype=np.int64), 0
        for batch in batches:
            for found in map(vectors, batch["text"].tolist()):
                if found is not None:
                    seen[found[0]] += 1
                    total += 1
        at = np.flatnonzero(seen)
        if total:
            yield pd.DataFrame({"gram": np.append(at, -1), "n": np.append(seen[at], total)})

    parts = docs.select(F.col(text).alias("text")).mapInPandas(count, "gram long, n long")
    sums = {r["gram"]: r["n"] for r in parts.groupBy("gram").agg(F.sum("n").alias("n")).collect()}
    total = sums.pop(-1, 0)
    frequencies = np.zeros(SIZE)
    frequencies[list(sums)] = list(sums.values())
    return total, frequencies


def learning_rows(
    docs: DataFrame, text: str, label: str, key: str, per_language: int, most_languages: int
) -> list:
    """Sparse counts and language of at most ``per_language`` rows of each learned language."""
    rows = docs.select(
        F.col(text).alias("text"),
        F.col(label).cast("string").alias("label"),
        F.xxhash64(F.col(key).cast("string"), F.col(text)).alias("draw"),
    ).where("label is not null")
    common = rows.groupBy("label").count().orderBy(F.col("count").desc(), "label").limit(most_languages)
    sizes = {r["label"]: r["count"] for r in common.collect()}
    if not sizes:
        return []
    # the share below which a row's hash must lie; the exact number is cut below
    share = F.create_map(
        *[F.lit(v) for k, n in sizes.items() for v in (k, min(1.0, 1.3 * per_language / n))]
    )
    drawn = rows.where(F.abs(F.col("draw") / F.lit(2.0**63)) <= share[F.col("label")])
    # equal rows are drawn together: one of them, before anything leaves a task
    drawn = drawn.groupBy("label", "draw").agg(F.min("text").alias("text"))

    def vectorise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors = Vectors()
        for batch in batches:
            found = [vectors(t) for t in batch["text"].tolist()]
            kept = [i for i, f in enumerate(found) if f is not None]
            if not kept:  # an empty column has no type that Arrow could turn into lists
                continue
            yield pd.DataFrame(
                {
                    "label": [batch["label"].iloc[i] for i in kept],
                    "draw": [batch["draw"].iloc[i] for i in kept],
                    "grams": [found[i][0].astype(np.int32) for i in kept],
                    "counts": [found[i][1].astype(np.int32) for i in kept],
                }
            )

    schema = "label string, draw long, grams array<int>, counts array<int>"
    got = drawn.mapInPandas(vectorise, schema).toPandas().sort_values(["label", "draw"])
    got = got.groupby("label", sort=True).head(per_language).sort_values("draw", kind="stable")
    return [(r.label, np.asarray(r.grams), np.asarray(r.counts)) for r in got.itertuples()]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train_ftrl(
    rows: list[tuple[int, np.ndarray, np.ndarray]],
    classes: int,
    *,
    size: int = SIZE,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.02,
    epochs: int = 4,
) -> np.ndarray:
    """Per-coordinate FTRL-proximal on rows (class, positions, values); returns the weights.

    ``l1`` leaves weights at exactly zero until the gradients gathered for them exceed it.
    """
    z, n = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))

    def current(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n[at])) / alpha + l2)

    for _ in range(epochs):
        for label, at, x in rows:
            at, x = np.append(at, size), np.append(x, 1.0)  # the bias
            w = current(at)
            error = softmax(x @ w)
            error[label] -= 1
            g = np.outer(x, error)
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return current(np.arange(size + 1))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, step = np.log(0.05), np.log(20), (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - step * (high - low), low + step * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(
    docs: DataFrame,
    *,
    text: str = "text",
    label: str = "lang",
    key: str = "doc_id",
    per_language: int = PER_LANGUAGE,
    most_languages: int = MOST_LANGUAGES,
) -> LanguageModel:
    """Learn from the rows of ``docs`` whose ``label`` is not null."""
    labelled = docs.where(F.col(label).isNotNull())
    total, frequencies = document_frequencies(labelled, text)
    idf = np.log((1 + total) / (1 + frequencies)) + 1
    sample = learning_rows(labelled, text, label, key, per_language, most_languages)
    languages = tuple(sorted({name for name, _, _ in sample}))
    number = {name: i for i, name in enumerate(languages)}
    rows = [(number[name], *weigh((at, counts), idf)) for name, at, counts in sample]
    held = rows[::4] if len(rows) >= 40 else []  # for the temperature only
    taught = [r for i, r in enumerate(rows) if i % 4] if held else rows
    weights = train_ftrl(taught, len(languages)) if languages else np.zeros((SIZE + 1, 0))
    logits = np.array([x @ weights[at] + weights[SIZE] for _, at, x in held])
    temperature = fit_temperature(logits, np.array([label for label, _, _ in held], dtype=int))
    return LanguageModel(languages, idf, weights.astype(np.float32), temperature)


def predicted(text: Column, model: LanguageModel) -> Column:
    """Struct (lang_pred, score): the likeliest language and its calibrated probability."""

    def make():
        vectors = Vectors()

        def one(value):
            found = vectors(value) if model.languages else None
            if found is None:
                return UNDETERMINED, 1.0
            at, x = weigh(found, model.idf)
            p = softmax((x @ model.weights[at] + model.weights[SIZE]) / model.temperature)
            best = int(p.argmax())
            return model.languages[best], float(p[best])

        return one

    return per_text(make, "lang_pred string, score double")(text)


def identify(
    docs: DataFrame, model: LanguageModel, *, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Columns ``keep`` (all by default) with lang_pred and score for every row."""
    keep = list(docs.columns) if keep is None else keep
    return with_results(docs, predicted(F.col(text), model), keep, ["lang_pred", "score"])
