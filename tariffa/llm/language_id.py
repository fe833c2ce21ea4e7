"""Language identification by cross-parsing.

For each language the suffix automaton of a piece of labelled text recognises every substring of it.  A document is parsed
greedily: the longest match from the current position is a phrase, then the next one starts.  A phrase costs
log2(length of the training text) bits, the price of pointing into it, so phrase counts are comparable between languages
trained on texts of different length; the language with the fewest bits wins, ties go to the smaller name.

The fit uses a bounded sample: ``passages`` passages of ``passage`` characters a language, from distinct texts chosen by hash, and an
alphabet of the ``letters`` most frequent letters in it.  Everything else that is not a letter of the alphabet is a space (ASCII)
or an unknown letter, which is a phrase of its own.  Whole texts are parsed, in windows of ``WINDOW`` symbols that advance together;
a phrase ends at a window's edge.

A text that is null, empty or has no letter is ``und`` with score 0, as is every text if nothing could be learned.  Rows with null label
are never learned from, a null identifier counts as empty text for the fold, repeated rows get equal answers, an empty table
gives an empty result and further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tariffa.llm.common import collectable

WINDOW = 1024
PAD, SPACE, UNKNOWN, FIRST = 0, 1, 2, 3
UNDECIDED = "und"
MOST_LANGUAGES = 200


def sample_text(
    labelled: DataFrame, text: str, label: str, passages: int = 160, passage: int = 256, surplus: int = 4
) -> dict[str, list[str]]:
    """A bounded number of passages per label: rows by hash, a passage of each from a place given by the hash."""
    # distinct texts are counted, as copies are drawn together and give one passage
    distinct = labelled.select(F.col(label).alias("label"), F.xxhash64(text).alias("hash")).distinct()
    counts = collectable(distinct.groupBy("label").count(), MOST_LANGUAGES, "languages")
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["label"], surplus * passages / r["count"])])
    mixed = F.xxhash64(text)
    draw = F.pmod(mixed, F.lit(1 << 40)) / float(1 << 40)
    start = F.pmod(F.xxhash64(mixed), F.greatest(F.lit(1), F.length(text) - passage)).cast("int") + 1
    picked = (
        labelled.filter(draw < share[F.col(label)])
        .select(F.col(label).alias("label"), draw.alias("draw"), F.substring(F.col(text), start, F.lit(passage)).alias("passage"))
        # one of each group of copies
        .dropDuplicates(["label", "draw", "passage"])
    )
    frame = picked.toPandas().sort_values(["label", "draw", "passage"])
    return {str(k): list(v["passage"][:passages]) for k, v in frame.groupby("label")}


class Alphabet:
    """Characters to symbols: a table over all code points."""

    def __init__(self, texts: list[str], letters: int):
        seen = Counter(c for t in texts for c in t.lower() if c.isalpha())
        chosen = sorted(c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:letters])
        self.size = FIRST + len(chosen)
        self.codes = np.array([ord(c) for c in chosen], np.int64)

    def table(self) -> np.ndarray:
        out = np.full(0x110000, UNKNOWN, np.uint8)
        out[:128] = SPACE
        out[self.codes] = np.arange(FIRST, self.size)
        return out


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """Symbols of a text, runs of spaces as one."""
    out = table[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != SPACE) | (out[:-1] != SPACE)
    return out[keep]


def suffix_automaton(sequence: list[int], width: int) -> np.ndarray:
    """Transitions state x symbol of the automaton of all substrings; 0, the root, stands for none."""
    after, link, length = [[0] * width], [-1], [0]
    last = 0
    for symbol in sequence:
        here = len(after)
        after.append([0] * width)
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state != -1 and not after[state][symbol]:
            after[state][symbol] = here
            state = link[state]
        if state != -1:
            old = after[state][symbol]
            if length[state] + 1 == length[old]:
                link[here] = old
            else:
                twin = len(after)
                after.append(after[old][:])
                length.append(length[state] + 1)
                link.append(link[old])
                while state != -1 and after[state][symbol] == old:
                    after[state][symbol] = twin
                    state = link[state]
                link[old] = link[here] = twin
        last = here
    return np.array(after, np.int64)


def parser(automaton: np.ndarray) -> np.ndarray:
    """Next state * 4 + phrases ended, so that a step of the parse is one look-up.

    Where no transition exists the phrase ends and a new one starts with the symbol; a symbol the root does not know is a phrase.
    """
    root = automaton[0]
    missing = automaton == 0
    state = np.where(missing, root[None, :], automaton)
    ended = np.where(missing, 1 + (root == 0)[None, :], 0)
    ended[0] = missing[0]
    return state * 4 + ended


class Model:
    """Training passages of each language; the automata are built where they are used."""

    def __init__(self, passages: dict[str, list[str]], letters: int = 96):
        self.names = sorted(passages)
        self.alphabet = Alphabet([t for name in self.names for t in passages[name]], letters)
        table = self.alphabet.table()
        # an unknown symbol between passages: no match crosses it
        self.sequences = [
            np.concatenate([np.r_[symbols(t, table), UNKNOWN].astype(np.uint8) for t in passages[name]]) for name in self.names
        ]

    def build(self) -> None:
        self.table = self.alphabet.table()
        steps, self.roots, base = [], [], 0
        for sequence in self.sequences:
            automaton = suffix_automaton(sequence.tolist(), self.alphabet.size)
            automaton[:, [PAD, UNKNOWN]] = 0
            steps.append(parser(automaton) + 4 * base)
            self.roots.append(base)
            base += len(automaton)
        self.steps = np.concatenate(steps).astype(np.int32).ravel()
        self.bits = np.array([np.log2(len(s) + 1) for s in self.sequences])

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrase counts, text x language."""
        parts = [symbols(t, self.table) for t in texts]
        sizes = np.array([len(p) for p in parts])
        windows = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(parts)), windows)
        chunks = [p[i : i + WINDOW] for p in parts for i in range(0, len(p), WINDOW)]
        spans = np.array([len(c) for c in chunks], np.int64)
        order = np.argsort(-spans, kind="stable")
        grid = np.full((WINDOW, len(chunks)), PAD, np.uint8)
        for column, which in enumerate(order):
            grid[: spans[which], column] = chunks[which]
        # windows still running at each step: they are sorted by length
        running = len(chunks) - np.searchsorted(np.sort(spans), np.arange(WINDOW), side="right")
        roots = np.array(self.roots, np.int32)[:, None]
        state = np.repeat(roots, len(chunks), axis=1)
        count = np.zeros(state.shape, np.int32)
        width = np.int32(self.alphabet.size)
        for step in range(int(spans.max()) if len(spans) else 0):
            alive = running[step]
            found = self.steps[state[:, :alive] * width + grid[step, :alive]]
            count[:, :alive] += found & 3
            state[:, :alive] = found >> 2
        count += state != roots
        return np.stack([np.bincount(owner[order], row, len(texts)) for row in count], axis=1)

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The best language's index, and its share of the likelihood 2^-bits over all languages."""
        bits = self.phrases(texts) * self.bits
        best = bits.argmin(axis=1)
        gap = np.minimum(bits - bits.min(axis=1, keepdims=True), 1000.0)
        return best, 1 / np.exp2(-gap).sum(axis=1)


def learn(labelled: DataFrame, text: str = "text", label: str = "lang", letters: int = 96, **sample) -> Model | None:
    rows = labelled.filter(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}"))
    passages = sample_text(rows, text, label, **sample)
    return Model(passages, letters) if passages else None


def predicted(model: Model | None, text: str = "text", most: int = 4_000_000) -> Column:
    """A struct of lang_pred and score for a text column."""
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    none = F.struct(F.lit(UNDECIDED).alias("lang_pred"), F.lit(0.0).alias("score"))
    if model is None:
        return none

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model.build()
        names = np.array(model.names, object)
        for batch in batches:
            out = pd.DataFrame({"lang_pred": UNDECIDED, "score": 0.0}, index=batch.index)
            asked = batch[batch.notna()]
            for _, piece in asked.groupby((asked.str.len().cumsum() // most).to_numpy(), sort=False):
                best, share = model.predict(list(piece))
                out.loc[piece.index, "lang_pred"] = names[best]
                out.loc[piece.index, "score"] = share
            yield out

    found = run(F.when(letters, F.col(text)))
    return F.when(letters, found).otherwise(none)
