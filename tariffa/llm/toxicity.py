"""A toxicity classifier with a counterfactual penalty.

Logistic regression on the presence of words and of word beginnings.  Beside the likelihood of the labels it minimises the squared change of a
text's logit when an identity term is swapped for others of its group, or for none: a group that is often the
target of abuse must not become a mark of abuse.  An L1 term keeps the words few, so that words which only travel with abusive ones get no weight.

The fit uses a bounded sample of labelled rows (``rows``, by hash; copies once) and the ``features`` words whose frequency differs most
between the labels, counted over that sample; every identity term in the sample is a feature as well.  Scoring reads whole texts.

A null text counts as empty, and an empty text gets the score of a text without any feature.  Rows with null label are not learned
from; of several labels for one identifier the highest counts.  Without labelled rows every score is 0.  Repeated rows get equal scores, an
empty table gives an empty result and further columns are ignored.  A sample without any identity term leaves the penalty nothing to do:
``Model.swaps`` is 0 then, and a warning says so.
"""

from __future__ import annotations

import logging
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffa.sources.sinks import stored

# Groups of terms that name people alike; a parameter, in any language.
IDENTITY_GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("female", "male"),
    ("girls", "boys"),
    ("black", "white", "asian", "latino", "hispanic", "african", "european"),
    ("muslim", "jewish", "christian", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "jews", "christians", "hindus", "buddhists", "atheists", "catholics"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("immigrant", "citizen", "refugee", "foreigner"),
    ("immigrants", "citizens", "refugees", "foreigners"),
    ("disabled", "blind", "deaf", "autistic"),
    ("old", "young"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)
LOG = logging.getLogger(__name__)
TERM = re.compile(r"[^\W\d_]+")
STEMS = (4,)


def words(text: str | None) -> set[str]:
    return set(TERM.findall(text.lower())) if text else set()


def with_stems(found: set[str]) -> set[str]:
    """Words and their beginnings (``begin*``): an inflected form has the mark of its stem."""
    return found.union(*[{w[:n] + "*" for w in found if len(w) >= n} for n in STEMS])


def terms(text: str | None) -> set[str]:
    return with_stems(words(text))


def counterfactuals(found: set[str], groups: Sequence[Sequence[str]]) -> list[set[str]]:
    """Texts (as sets of words) in which one identity term gives way to each of the others, or to none."""
    out = []
    for group in groups:
        for term in sorted(found.intersection(group)):
            out += [found - {term}, *[(found - {term}) | {other} for other in group if other != term]]
    return out


class Model:
    def __init__(self, weights: dict[str, float], bias: float, swaps: int = 0):
        self.weights, self.bias = weights, bias
        self.swaps = swaps  # that the penalty was taken over

    def logit(self, found: set[str]) -> float:
        # a fixed order: sums of doubles depend on it
        return self.bias + sum(self.weights[w] for w in sorted(found & self.weights.keys()))


def fit(
    rows: list[tuple[int, list[int]]],
    swaps: list[tuple[list[int], list[int]]],
    features: int,
    l1: float = 2e-4,
    swap_penalty: float = 1.0,
    steps: int = 800,
) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient on rows (label, features) and swaps (features that go, features that come).

    Minimises log-loss (both labels weigh a half, however rare one is) + swap_penalty * mean squared logit change of a
    swap + l1 * |weights|.
    """
    label = np.array([y for y, _ in rows], float)
    toxic = label.mean()
    weight = np.where(label > 0, 0.5 / toxic, 0.5 / (1 - toxic)) / len(rows) if 0 < toxic < 1 else np.full(len(rows), 1 / len(rows))
    row = np.repeat(np.arange(len(rows)), [len(x) for _, x in rows])
    column = np.array([i for _, x in rows for i in x], np.int64)
    changes = [(k, i, sign) for k, pair in enumerate(swaps) for sign, side in ((-1.0, pair[0]), (1.0, pair[1])) for i in side]
    swap, place, sign = (np.array([c[j] for c in changes], kind) for j, kind in enumerate((np.int64, np.int64, float)))
    # curvature of each weight: how many rows it meets, times how many others it meets there
    crowd = (np.bincount(row, minlength=len(rows)) + 1.0) * weight
    curve = np.append(np.bincount(column, crowd[row], features), crowd.sum()) / 4
    if swaps:
        busy = np.bincount(swap, minlength=len(swaps))
        curve[:-1] += 2 * swap_penalty * np.bincount(place, busy[swap], features) / len(swaps)
    rate = 1 / np.maximum(curve, 1e-12)
    w = v = np.zeros(features + 1)
    momentum = 1.0
    for _ in range(steps):
        logit = np.bincount(row, v[column], len(rows)) + v[-1]
        residual = (1 / (1 + np.exp(-np.clip(logit, -500, 500))) - label) * weight
        gradient = np.append(np.bincount(column, residual[row], features), residual.sum())
        if swaps:
            shift = np.bincount(swap, sign * v[place], len(swaps))
            gradient[:-1] += 2 * swap_penalty / len(swaps) * np.bincount(place, sign * shift[swap], features)
        following = v - rate * gradient
        following[:-1] = np.sign(following[:-1]) * np.maximum(np.abs(following[:-1]) - rate[:-1] * l1, 0)
        grown = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        w, v, momentum = following, following + (momentum - 1) / grown * (following - w), grown
    return w[:-1], float(w[-1])


def labelled_sample(docs: DataFrame, labels: DataFrame, learn_from: Column, id: str, text: str, label: str, rows: int) -> DataFrame:
    """About ``rows`` labelled texts (label, text), chosen by hash of the identifier; equal texts once."""
    known = labels.filter(learn_from & F.col(label).isNotNull() & F.col(id).isNotNull())
    marks = known.groupBy(F.col(id).alias("_id")).agg(F.max(label).alias("label"))
    share = min(1.0, rows / max(1, marks.count()))
    draw = F.pmod(F.xxhash64("_id"), F.lit(1 << 40)) / float(1 << 40)
    # at most about ``rows`` pairs of numbers: a proven size
    chosen = F.broadcast(marks.filter(draw < share))
    texts = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.join(chosen, "_id").groupBy(F.xxhash64("text").alias("content")).agg(
        F.max("label").alias("label"), F.first("text").alias("text")
    )


def learn(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = 20_000,
    features: int = 2048,
    groups: Sequence[Sequence[str]] = IDENTITY_GROUPS,
    **settings: float,
) -> Model | None:
    """A model from the labelled rows for which ``learn_from`` (over the labels' columns) holds."""
    sample = stored(labelled_sample(docs, labels, learn_from, id, text, label, rows), "labelled")
    identity = {t for group in groups for t in group}

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            seen = [Counter(), Counter()]
            for mark, content in zip(frame["label"], frame["text"], strict=True):
                seen[int(mark > 0)].update(terms(content))
            either = sorted(seen[0].keys() | seen[1].keys())
            yield pd.DataFrame({"word": either, "clean": [seen[0][w] for w in either], "toxic": [seen[1][w] for w in either]})

    totals = {bool(r["marked"]): r["count"] for r in sample.groupBy((F.col("label") > 0).alias("marked")).count().collect()}
    if len(totals) < 2:
        return Model({}, 40.0 if totals.get(True) else -40.0) if totals else None
    counted = sample.select("label", "text").mapInPandas(count, "word string, clean long, toxic long")
    clean, toxic = F.sum("clean"), F.sum("toxic")
    pooled = (clean + toxic) / float(sum(totals.values()))
    spread = F.sqrt(pooled * (1 - pooled) * (1 / totals[False] + 1 / totals[True])) + 1e-9
    contrast = (toxic / totals[True] - clean / totals[False]) / spread
    told = counted.groupBy("word").agg(contrast.alias("contrast"), (clean + toxic).alias("rows")).filter("rows >= 3")
    best = told.orderBy(F.desc(F.abs("contrast")), "word").limit(features).select("word").collect()
    chosen = sorted({r["word"] for r in best} | with_stems(identity))
    place = {w: i for i, w in enumerate(chosen)}

    def design(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found, gone, come = [], [], []
            for content in frame["text"]:
                plain = words(content)
                own = {place[w] for w in with_stems(plain) & place.keys()}
                others = [{place[w] for w in with_stems(other) & place.keys()} for other in counterfactuals(plain, groups)]
                found.append(sorted(own))
                # what a swap changes is a few features, however long the text
                gone.append([sorted(own - other) for other in others])
                come.append([sorted(other - own) for other in others])
            yield pd.DataFrame(
                {"content": frame["content"], "label": (frame["label"] > 0).astype(int), "words": found, "gone": gone, "come": come}
            )

    table = sample.mapInPandas(design, "content long, label int, words array<int>, gone array<array<int>>, come array<array<int>>")
    rows_, swaps = [], []
    for r in sorted(table.collect(), key=lambda r: r["content"]):
        rows_.append((r["label"], r["words"]))
        swaps += zip(r["gone"], r["come"], strict=True)
    if not swaps:
        LOG.warning("no labelled text holds an identity term: the counterfactual penalty has nothing to act on")
    weights, bias = fit(rows_, swaps, len(chosen), **settings)
    return Model({w: float(x) for w, x in zip(chosen, weights, strict=True) if x}, bias, len(swaps))


def score(model: Model | None, text: str = "text") -> Column:
    """The probability that a text column is toxic."""
    if model is None:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            logits = np.array([model.logit(terms(t)) for t in batch], float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(logits, -500, 500))), index=batch.index)

    return run(F.col(text))


def verdict(score_column: str) -> Column:
    return (F.col(score_column) >= 0.5).cast("int")
