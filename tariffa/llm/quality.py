"""A quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``WORDS`` words; only the bag has a label.  Every passage is described by the shares of its kinds of
bytes and of pairs of them and by how its words repeat, and encoded by a layer of tanh units, h.  Gated attention gives it the weight
a ~ exp(w . (tanh(V h) * sigmoid(U h))), weights sum to one over the document, and the weighted sum of its passages' encodings
is what the last layer scores.  All layers are learned together from the labels of documents, so the passages that tell good from bad
documents get their weight without any label of their own.

The fit uses a bounded sample of labelled rows (``rows``, by hash; copies once) and of each sampled document at most ``bag`` passages, evenly
spaced over all of it.  Scoring encodes every passage of every text; a very long text is taken in chunks whose weighted sums are
merged, so memory is bounded beside the text itself.

A null text counts as empty; a text without words is one passage without features.  Rows with null label are not learned from; of several labels for
one identifier the highest counts.  Without labelled rows every score is 0, with one kind of label it is that label's.  Repeated rows get
equal scores, ties in the sample are settled by hash, an empty table gives an empty result and further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffa.llm.toxicity import labelled_sample

WORDS = 64
CHUNK = 4096  # passages of one text that are encoded at a time
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# coarse kinds: blank, line end, digit, upper, lower, punctuation, lead byte and following byte of other characters, control
COARSE = 9
FINE = COARSE - 1 + len(PUNCTUATION)


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """The coarse and the fine kind of every byte; punctuation has a fine kind for each mark."""
    coarse = np.full(256, 8, np.int64)
    coarse[[32, 9]] = 0
    coarse[[10, 13]] = 1
    coarse[48:58], coarse[65:91], coarse[97:123] = 2, 3, 4
    coarse[192:], coarse[128:192] = 6, 7
    fine = np.where(coarse > 5, coarse - 1, coarse)
    for k, mark in enumerate(PUNCTUATION):
        coarse[ord(mark)], fine[ord(mark)] = 5, COARSE - 1 + k
    return coarse, fine


_COARSE, _FINE = _kinds()
BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
FEATURES = FINE + COARSE**2 + 4


def passage_starts(content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where every word starts and where every passage starts; the first passage begins with the text."""
    blank = BLANK[content]
    starts = np.flatnonzero(~blank & np.r_[True, blank[:-1]])
    firsts = starts[::WORDS].copy()
    firsts[:1] = 0
    return starts, firsts


def features(text: str | None) -> Iterator[np.ndarray]:
    """Features of all passages of a text, up to ``CHUNK`` passages at a time."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    content = np.frombuffer(raw, np.uint8)
    starts, firsts = passage_starts(content) if raw else (np.zeros(0, int), np.zeros(0, int))
    if not len(starts):
        yield np.zeros((1, FEATURES), np.float32)
        return
    ends = np.r_[firsts[1:], len(raw)]
    for k in range(0, len(firsts), CHUNK):
        first, last = firsts[k : k + CHUNK], ends[k : k + CHUNK]
        part = content[first[0] : last[-1]]
        size, many = last - first, len(first)
        owner = np.repeat(np.arange(many), size)
        fine, coarse = _FINE[part], _COARSE[part]
        single = np.bincount(owner * FINE + fine, minlength=many * FINE).reshape(many, FINE)
        pair = coarse[:-1] * COARSE + coarse[1:]
        double = np.bincount(owner[1:] * COARSE**2 + pair, minlength=many * COARSE**2).reshape(many, COARSE**2)
        words = part.tobytes().split()
        own = [words[i : i + WORDS] for i in range(0, len(words), WORDS)]
        # how the words of a passage repeat: next to each other, at all, and how long they are
        told = [(sum(map(bytes.__eq__, w, w[1:])) / len(w), len(set(w)) / len(w), len(w) / WORDS) for w in own]
        length = np.log1p(size / np.array([len(w) for w in own]))
        share = size[:, None].astype(np.float32)
        yield np.concatenate(
            [np.sqrt(single / share), np.sqrt(double / share), np.array(told), length[:, None]], axis=1, dtype=np.float32
        )


@dataclass
class Network:
    """Parameters by name: scale of the features, encoder (W, b), attention (V, U, w), last layer (c, d)."""

    weights: dict[str, np.ndarray]

    def encode(self, x: np.ndarray) -> np.ndarray:
        p = self.weights
        return np.tanh((x - p["mean"]) / p["scale"] @ p["W"].T + p["b"])

    def attention(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unnormalised logits of the passages' weights, and the two gates."""
        p = self.weights
        t, s = np.tanh(h @ p["V"].T), sigmoid(h @ p["U"].T)
        return (t * s) @ p["w"], t, s

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        """Probabilities, one a text, over all passages."""
        out = np.zeros(len(texts))
        for i, text in enumerate(texts):
            top, mass, whole = -np.inf, 0.0, 0.0
            for x in features(text):
                h = self.encode(x.astype(np.float64))
                e, _, _ = self.attention(h)
                high = max(top, e.max())
                a = np.exp(e - high)
                rest = np.exp(top - high)
                top, mass, whole = high, mass * rest + a.sum(), whole * rest + a @ h
            out[i] = whole @ self.weights["c"] / mass + self.weights["d"]
        return np.round(sigmoid(out), 9)

    def passage_weights(self, text: str | None) -> np.ndarray:
        e = np.concatenate([self.attention(self.encode(x.astype(np.float64)))[0] for x in features(text)])
        a = np.exp(e - e.max())
        return a / a.sum()


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def gradient(net: Network, x: np.ndarray, starts: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted log-loss of bags (passages ``x``, bag k from ``starts[k]``) and its gradient by every learned parameter."""
    p = net.weights
    owner = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(x)]))
    scaled = (x - p["mean"]) / p["scale"]
    h = np.tanh(scaled @ p["W"].T + p["b"])
    e, t, s = net.attention(h)
    a = np.exp(e - np.maximum.reduceat(e, starts)[owner])
    a /= np.add.reduceat(a, starts)[owner]
    z = np.add.reduceat(a[:, None] * h, starts)
    logit = z @ p["c"] + p["d"]
    loss = float((weight * (np.logaddexp(0, logit) - label * logit)).sum())
    d_logit = weight * (sigmoid(logit) - label)
    d_z = d_logit[owner, None] * p["c"]
    d_a = (d_z * h).sum(axis=1)
    d_e = a * (d_a - np.add.reduceat(a * d_a, starts)[owner])
    d_g = d_e[:, None] * p["w"]
    d_t, d_s = d_g * s * (1 - t**2), d_g * t * s * (1 - s)
    d_u = (a[:, None] * d_z + d_t @ p["V"] + d_s @ p["U"]) * (1 - h**2)
    return loss, {
        "W": d_u.T @ scaled, "b": d_u.sum(axis=0), "V": d_t.T @ h, "U": d_s.T @ h, "w": (t * s).T @ d_e,
        "c": z.T @ d_logit, "d": d_logit.sum(),
    }


def start(width: int, hidden: int, gates: int, seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shapes = {"W": (hidden, width), "V": (gates, hidden), "U": (gates, hidden), "w": (gates,), "c": (hidden,)}
    drawn = {k: rng.normal(0, 1 / np.sqrt(shape[-1]), shape) for k, shape in shapes.items()}
    return drawn | {"b": np.zeros(hidden), "d": np.zeros(())}


def fit(
    bags: list[np.ndarray], labels: np.ndarray, hidden: int = 24, gates: int = 12, epochs: int = 40, batch: int = 128,
    rate: float = 3e-3, decay: float = 1e-4, seed: int = 42,
) -> Network:
    """Adam on mini-batches of bags; both labels weigh the same, however rare one is."""
    every = np.concatenate(bags).astype(np.float64)
    learned = start(every.shape[1], hidden, gates, seed)
    net = Network(learned | {"mean": every.mean(axis=0), "scale": every.std(axis=0) + 0.05})
    sizes = np.array([len(b) for b in bags])
    firsts = np.cumsum(sizes) - sizes
    share = labels.mean()
    weight = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))
    rng = np.random.default_rng(seed)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in learned.items()}
    step, rounds = 0, epochs * -(-len(bags) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for k in range(0, len(order), batch):
            chosen = order[k : k + batch]
            own = sizes[chosen]
            starts = np.cumsum(own) - own
            rows = np.repeat(firsts[chosen] - starts, own) + np.arange(own.sum())
            _, slope = gradient(net, every[rows], starts, labels[chosen], weight[chosen] / len(chosen))
            step += 1
            pace = rate * (1 - (step - 1) / rounds)
            for name, g in slope.items():
                g = g + decay * net.weights[name]
                one, two = moment[name] = 0.9 * moment[name][0] + 0.1 * g, 0.999 * moment[name][1] + 0.001 * g**2
                net.weights[name] = net.weights[name] - pace * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.999**step)) + 1e-8)
    return net


def learn(
    docs: DataFrame,
    labels: DataFrame,
    learn_from: Column,
    id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = 4000,
    bag: int = 32,
    **settings: float,
) -> Network | float:
    """A network from the labelled rows for which ``learn_from`` (over the labels' columns) holds, or one score for all."""
    sample = labelled_sample(docs, labels, learn_from, id, text, label, rows)

    def design(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for content, mark, text_ in zip(frame["content"], frame["label"], frame["text"], strict=True):
                x = np.concatenate(list(features(text_)))
                chosen = x[np.unique(np.linspace(0, len(x) - 1, min(bag, len(x))).round().astype(int))]
                out.append((content, int(mark > 0), chosen.astype("<f4").tobytes()))
            yield pd.DataFrame(out, columns=["content", "label", "passages"])

    # ``rows`` bags of at most ``bag`` passages: a proven size
    found = sample.mapInPandas(design, "content long, label int, passages binary").toPandas().sort_values("content")
    marks = found["label"].to_numpy(float)
    if len(set(marks)) < 2:
        return float(marks[0]) if len(marks) else 0.0
    return fit([np.frombuffer(b, "<f4").reshape(-1, FEATURES) for b in found["passages"]], marks, **settings)


def score(model: Network | float, text: str = "text") -> Column:
    """The probability that a document has label 1."""
    if isinstance(model, float):
        return F.lit(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(model.scores(batch.tolist()), index=batch.index)

    return run(F.col(text))


def attention(model: Network, text: str = "text") -> Column:
    """The weight of every passage of ``WORDS`` words, in order."""

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([model.passage_weights(t) for t in batch], index=batch.index)

    return run(F.col(text))
