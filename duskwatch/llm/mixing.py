"""Mixing by soft membership: document rates whose expected domain totals match targets.

A classifier learned from a labelled table (multinomial logistic regression on words and marks,
FTRL with an elastic net) predicts each document's posterior over domains, corrected for the
labelled table's own domain shares and rounded to three decimals.  Rates are then fitted by
projected gradient on the squared difference between expected domain totals
``sum(rate * tokens * posterior)`` and the targets, over rates >= 0, from rate 1, in the metric
that weighs a document by its tokens (equal posteriors get equal rates).  Steps along the gradient
at a step's start need thousands of passes when a rare domain has to go, so one long step is taken
along the gradient at its *end*: ``rate = max(0, 1 - posterior . pulls)``, pulls being the
differences that these very rates leave, over ``hold`` times the domain's second moment.  The
end is found by Newton on the pulls, a number for each domain; every trial is one distributed sum
over the table of distinct posteriors, and the pulls are all that the driver holds.  As ``hold``
goes to zero the totals are those of the exact nonnegative least squares.

Training uses at most ``per_domain`` labelled documents of each domain (a bounded sample drawn
by hash); everything else covers all rows.

Defined results: a null or empty text has no tokens and the posterior its lack of words gives;
labels that are null or name no document teach nothing; without any, posteriors are uniform;
no documents, no rows.  A key repeated with one domain in the labelled table counts once; of
documents that repeat a labelled key the least text is learned from.
Columns other than those named are kept where asked for and otherwise ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.llm.common import per_text, with_results
from duskwatch.llm.language_id import softmax, train_ftrl
from duskwatch.sources.staging import stage

PER_DOMAIN = 1200
HOLD = 0.1  # weight of keeping rates at one, against each domain's own mass
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def features(text: str | None) -> tuple[set[str], int]:
    """Words of a text and marks at their ends, and the number of words with repeats."""
    found = (text or "").lower().split()
    out = set()
    for word in set(found):
        core = word.strip(MARKS)
        out.add(core)
        if len(core) < len(word):
            out.add("mark " + word[-1])
            out.add("marks " + word[-2:] if len(word) - len(core) > 1 else "mark")
    if text and text.isupper():
        out.add("all upper")
    return out, len(found)


@dataclass(frozen=True)
class DomainModel:
    domains: tuple[str, ...]
    vocabulary: Mapping[str, int]
    weights: np.ndarray
    shift: np.ndarray  # logarithm of true shares over those of the sample

    def posterior(self, found: set[str]) -> np.ndarray:
        if not self.vocabulary:
            return np.full(len(self.domains), 1 / len(self.domains))
        at = [i for i in map(self.vocabulary.get, found) if i is not None]
        return softmax(self.weights[at].sum(0) + self.weights[-1] + self.shift)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    domains: tuple[str, ...],
    *,
    key: str = "doc_id",
    text: str = "text",
    domain: str = "domain",
    per_domain: int = PER_DOMAIN,
) -> DomainModel:
    """Learn from ``labels`` (key, domain) joined to the texts of ``docs``."""
    rows = labels.select(F.col(key).alias("key"), F.col(domain).alias("domain"))
    rows = rows.where(F.col("key").isNotNull() & F.col("domain").isin(*domains)).distinct()
    rows = stage(rows.withColumn("draw", F.xxhash64(F.col("key").cast("string"))), "labels")
    sizes = {r["domain"]: r["count"] for r in rows.groupBy("domain").count().collect()}
    if not sizes:
        return DomainModel(domains, {}, np.zeros((1, len(domains))), np.zeros(len(domains)))
    share = F.create_map(
        *[F.lit(v) for k, n in sizes.items() for v in (k, min(1.0, 1.3 * per_domain / n))]
    )
    drawn = rows.where(F.abs(F.col("draw") / F.lit(2.0**63)) <= share[F.col("domain")])
    # keys are distinct, so about 1.3 * per_domain rows of each domain; the limit proves the bound
    drawn = drawn.orderBy("draw", "domain").limit(2 * per_domain * len(domains))
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    # one text a key before anything leaves a task, however often documents repeat it
    joined = texts.join(F.broadcast(drawn), "key").groupBy("key", "domain", "draw").agg(F.min("text").alias("text"))

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            yield pd.DataFrame(
                {
                    "domain": batch["domain"],
                    "draw": batch["draw"],
                    "words": [sorted(features(t)[0]) for t in batch["text"].tolist()],
                }
            )

    got = joined.mapInPandas(words, "domain string, draw long, words array<string>").toPandas()
    got = got.sort_values(["domain", "draw"]).groupby("domain").head(per_domain)
    got = got.sort_values("draw", kind="stable")
    often = Counter(w for found in got["words"] for w in found)
    vocabulary = {w: i for i, w in enumerate(sorted(w for w, n in often.items() if n >= 4))}
    number = {name: i for i, name in enumerate(domains)}
    examples = []
    for name, found in zip(got["domain"], got["words"]):
        at = np.array([vocabulary[w] for w in found if w in vocabulary], dtype=np.int64)
        examples.append((number[name], at, np.ones(len(at))))
    weights = train_ftrl(
        examples, len(domains), size=len(vocabulary), alpha=0.1, l1=1.0, l2=0.1, epochs=5
    )
    drawn_sizes = got["domain"].value_counts()
    shift = np.array(
        [np.log(sizes[d] / drawn_sizes[d]) if drawn_sizes.get(d) else -20.0 for d in domains]
    )
    return DomainModel(domains, vocabulary, weights.astype(np.float32), shift - shift.max())


def classified(text: Column, model: DomainModel) -> Column:
    """Struct (p0, p1, ..., n_words): posteriors in the order of the model's domains."""
    names = [f"p{i}" for i in range(len(model.domains))]

    def make():
        def one(value):
            found, count = features(value)
            return (*np.round(model.posterior(found), 3).tolist(), count)

        return one

    return per_text(make, ", ".join(f"{n} double" for n in names) + ", n_words long")(text)


@dataclass(frozen=True)
class Rates:
    """Fitted rates: one less the pull of each domain, never below zero."""

    pulls: tuple[float, ...]
    targets: tuple[float, ...]  # of each domain, as a share of all tokens
    reached: tuple[float, ...]
    steps: int

    @property
    def errors(self) -> tuple[float, ...]:
        """Difference from the target of each domain, as a share of all tokens."""
        return tuple(abs(r - t) for r, t in zip(self.reached, self.targets))

    def column(self, names: list[str]) -> Column:
        """Rate of a row from its posterior columns."""
        return _rate(names, self.pulls)


def _rate(names: list[str], pulls: tuple[float, ...] | np.ndarray) -> Column:
    pull = sum((F.col(n) * F.lit(float(p)) for n, p in zip(names, pulls)), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.lit(1.0) - pull)


def fit_rates(
    rows: DataFrame,
    names: list[str],
    weights: list[float],
    *,
    tokens: str = "n_words",
    keep_all: bool = False,
    hold: float = HOLD,
    steps: int = 200,
) -> Rates:
    """Rates for ``rows`` with posterior columns ``names`` and target ``weights``.

    The targets are ``weights`` (made to add to one) times the number of tokens of all rows.
    With ``keep_all`` they are times the least number at which no domain with a positive weight
    has to give up tokens, so that documents are repeated and not thinned out.

    ``hold`` says how much a domain's distance from its target may weigh against moving rates
    away from one: near zero the totals are those of the nonnegative least squares, at 0.1 a
    domain that is wholly unwanted keeps about a tenth of what only it would pull away.  ``steps`` bounds
    the search for the step's end, which takes some ten and is an error beyond.
    """
    groups = stage(
        rows.groupBy(*names).agg(F.sum(F.col(tokens).cast("double")).alias("mass")), "posteriors"
    )
    k = range(len(names))

    def sums(rate: Column) -> list[Column]:
        """Objective, totals and second moments of the documents that are not at zero."""
        held = F.col("mass") * rate
        free = F.when(rate > 0, F.col("mass")).otherwise(F.lit(0.0))
        return [
            F.sum(held * rate).alias("square"),
            *[F.sum(held * F.col(n)).alias(f"s{i}") for i, n in enumerate(names)],
            *[F.sum(free * F.col(names[i]) * F.col(names[j])).alias(f"m{i}_{j}") for i in k for j in k],
        ]

    def at(pulls: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        got = groups.agg(*sums(_rate(names, pulls))).first()
        moments = np.array([[got[f"m{i}_{j}"] for j in k] for i in k]) / total
        return got["square"] / total, np.array([got[f"s{i}"] for i in k]) / total, moments

    total = groups.agg(F.sum("mass")).first()[0] or 0.0
    share = np.array(weights, dtype=float) / sum(weights)
    if not total:
        return Rates((0.0,) * len(names), tuple(share.tolist()), (0.0,) * len(names), 0)
    pulls = np.zeros(len(names))
    square, reached, moments = at(pulls)
    budget = max([f / w for f, w in zip(reached, share) if w > 0]) if keep_all else 1.0
    target = share * budget
    ridge = hold * np.maximum(moments.diagonal(), 1e-12)

    def objective(square: float, pulls: np.ndarray) -> float:
        return square / 2 + target @ pulls + ridge @ pulls**2 / 2

    taken = 0
    while True:
        slope = target - reached + ridge * pulls
        if np.abs(slope).max() <= 1e-9:
            break
        move = -np.linalg.solve(moments + np.diag(ridge), slope)
        size, value = 1.0, objective(square, pulls)
        while True:
            taken += 1
            if taken > steps:
                raise ArithmeticError(f"rates not fitted in {steps} steps")
            tried = pulls + size * move
            square, reached, moments = at(tried)
            if objective(square, tried) <= value + 1e-4 * size * (slope @ move) + 1e-13 or size < 1e-9:
                break
            size /= 2
        if size < 1e-9:  # no further within rounding
            break
        pulls = tried
    return Rates(tuple(pulls.tolist()), tuple(target.tolist()), tuple(reached.tolist()), taken)


def mix(
    docs: DataFrame,
    model: DomainModel,
    weights: Mapping[str, float],
    *,
    text: str = "text",
    keep: list[str] | None = None,
    keep_all: bool = False,
    hold: float = HOLD,
) -> DataFrame:
    """Columns ``keep`` with a posterior column p_<domain> each, n_words and rate.

    Then, alike in all rows, for each domain the share of tokens wanted (target_<domain>) and
    expected under the rates (reached_<domain>).
    """
    keep = list(docs.columns) if keep is None else keep
    names = [f"p{i}" for i in range(len(model.domains))]
    found = with_results(docs, classified(F.col(text), model), [*keep], [*names, "n_words"])
    inner = [f"kept_{i}" for i in range(len(keep))]
    held = stage(found.toDF(*inner, *names, "n_words"), "mixed")
    rates = fit_rates(held, names, [weights[d] for d in model.domains], keep_all=keep_all, hold=hold)
    found = [F.lit(v) for pair in zip(rates.targets, rates.reached) for v in pair]
    out = held.select(*inner, *names, "n_words", rates.column(names), *found)
    told = [f"{what}_{d}" for d in model.domains for what in ("target", "reached")]
    return out.toDF(*keep, *[f"p_{d}" for d in model.domains], "n_words", "rate", *told)


def copies(rate: Column, *identity: Column) -> Column:
    """Whole number of copies for a rate.

    Above one the fraction decides by a hash, so that totals are met on average; below one the
    rate is rounded, so that a document is dropped only if its rate is under a half.
    """
    draw = F.pmod(F.xxhash64(*identity), F.lit(1 << 20)) / F.lit(float(1 << 20))
    above = F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")
    return F.when(rate >= 1, above).otherwise((rate >= 0.5).cast("long"))
