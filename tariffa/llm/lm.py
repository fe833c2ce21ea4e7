"""A language model by deleted interpolation.

The probability of a word after another mixes three maximum-likelihood estimates: of the pair, of the word, and a uniform one over
the vocabulary and one unknown word.  The mixture weights depend on how frequent the context is: contexts are
put into buckets by the binary logarithm of their relative frequency, and each bucket's weights are learned by
expectation-maximisation on counts of a held-out part, with estimates from the retained part.  The estimates that score
are those of both parts.  Pairs of all contexts are counted; a context that was never learned from has no pair estimate, and
the weights of the other two are those of held-out words whose context the retained part does not have.
With ``contexts``, contexts rarer than one word in so many are treated as never learned from.

Texts are read once and kept as pieces of about ``piece_tokens`` tokens: the hashes (XXH64) of a piece's distinct words, and its tokens as
numbers of these.  Each piece asks for the counts of its distinct words and pairs, every one once, as sorted hashes cut into ranges.  One task
has a range of hashes of all pieces, adds their counts and answers each piece in the order it asked.  Hashes are spread evenly and the number of ranges
follows the number of tokens, so about ``range_keys`` meet in a task however frequent a word is.  With its
answers a piece has all that its tokens' scores need: no table of counts is joined to tokens or sent to all tasks.

A null text counts as empty; an empty text has one token, its end.  Without training documents every score is that of unknown
words (log10 of 1).  A text longer than a piece is cut into several, the word before each cut going along.
Null identifiers are kept, repeated rows are scored each, an empty table gives an empty result and further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tariffa.llm.common import collectable, pieces, words_of
from tariffa.sources.sinks import stored

OTHER, RETAINED, HELD = 0, 1, 2  # parts of the corpus
START, END = (xxh64_intdigest(b) for b in (b" ", b""))  # no word is empty or holds a space
ROTATED = 23
MOST_BUCKETS = 64
STEPS = 4  # of the logarithm, in the table that the weights are learned from
WORDS, PAIRS = 0, 1  # what is asked for

PIECE = "start long, offset long, part int, lead long, tokens long, rows array<long>, ids array<string>, words binary, stream binary"
ASKED = "range long, start long, offset long, part int, keys binary, counts binary"
ANSWERED = "range long, start long, offset long, part int, known long, retained binary, held binary"
SCORED = "row long, id string, n long, known long, base_lp double, lp double"


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on as compressed bytes: all lowest bytes, all second ones and so on."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    plain = pa.decompress(data[8:], decompressed_size=8 * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(8, size).T).view("<u8").reshape(-1)


def event_of(token: np.ndarray, context: np.ndarray) -> np.ndarray:
    """One hash for a token in its context."""
    return token ^ (context << np.uint64(ROTATED) | context >> np.uint64(64 - ROTATED))


class Piece:
    """Tokens in a row, as numbers of the piece's distinct words.

    Number 0 ends a text; as the token before another it is the start of one, so ``before`` needs no second number.  ``lead``
    is the token before the first.
    """

    def __init__(self, lead: int, words: np.ndarray, stream: np.ndarray):
        self.words, self.stream = words, stream
        before = np.empty_like(stream)
        before[:1], before[1:] = lead, stream[:-1]
        pairs, self.pair_of, self.pair_counts = np.unique(before * len(words) + stream, return_inverse=True, return_counts=True)
        self.context, self.token = pairs // len(words), pairs % len(words)
        # the first token belongs to the first text even where that began in an earlier piece
        self.text_of = np.cumsum(np.r_[False, stream[:-1] == 0])
        self.word_counts = np.bincount(stream, minlength=len(words))
        heads = words.copy()
        heads[0] = START
        self.events = event_of(words[self.token], heads[self.context])

    @classmethod
    def of(cls, row) -> Piece:
        return cls(int(row["lead"]), np.frombuffer(row["words"], "<u8"), unpack(row["stream"]).astype(np.int64))

    def asked(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """What the piece asks for: kind, keys and the piece's own counts of them."""
        return [(WORDS, self.words, self.word_counts), (PAIRS, self.events, self.pair_counts)]


class Open:
    """A piece that texts are added to."""

    def __init__(self, part: int, lead: bytes | None = None):
        self.part, self.numbers = part, {b"": 0}
        self.lead = 0 if lead is None else self.numbers.setdefault(lead, 1)
        self.stream: list[int] = []
        self.rows: list[int] = []
        self.ids: list[str | None] = []
        self.start: tuple[int, int] | None = None

    def add(self, row: int, id: str | None, words: list[bytes], done: int) -> None:
        self.start = self.start or (row, done)
        numbers = self.numbers
        self.stream += [numbers.setdefault(w, len(numbers)) for w in words]
        self.rows.append(row)
        self.ids.append(id)

    def closed(self) -> dict:
        hashes = np.fromiter(map(xxh64_intdigest, self.numbers), np.uint64, len(self.numbers))
        return {
            "start": self.start[0], "offset": self.start[1], "part": self.part, "lead": self.lead, "tokens": len(self.stream),
            "rows": self.rows, "ids": self.ids, "words": hashes.astype("<u8").tobytes(), "stream": pack(np.array(self.stream)),
        }


def in_pieces(frames: Iterator[pd.DataFrame], most: int) -> Iterator[dict]:
    """Texts (columns row, id, text, part) as rows of the piece table; a piece has texts of one part."""
    pending: dict[int, Open] = {}
    for frame in pieces(frames, "text"):
        for row, id, text, part in zip(frame["row"], frame["id"], frame["text"], frame["part"], strict=True):
            words = words_of(text)
            words.append(b"")
            done = 0
            while done < len(words):
                piece = pending.setdefault(part, Open(part))
                here = words[done : done + most - len(piece.stream)]
                piece.add(row, id, here, done)
                done += len(here)
                if len(piece.stream) >= most:
                    yield piece.closed()
                    pending[part] = Open(part, words[done - 1] if done < len(words) else None)
    for piece in pending.values():
        if piece.stream:
            yield piece.closed()


@dataclass
class Counts:
    pieces: DataFrame
    answers: DataFrame
    ranges: int
    tasks: int
    retained: int
    total: int
    vocabulary: int
    contexts: int | None

    def has_pairs(self, head_total: np.ndarray) -> np.ndarray:
        """Which contexts have pair estimates; the first is the start of a text."""
        enough = np.ones(len(head_total), bool) if self.contexts is None else head_total * self.contexts >= max(self.total, 1)
        enough[0] = True
        return enough & (head_total > 0)


def count(
    docs: DataFrame,
    part: Column,
    id: str = "doc_id",
    text: str = "text",
    contexts: int | None = None,
    piece_tokens: int = 1_000_000,
    range_keys: int = 2_000_000,
) -> Counts:
    """Pieces, and for every piece the counts of its words and pairs over all pieces of the parts learned from."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for piece in in_pieces(frames, piece_tokens):
            yield pd.DataFrame([piece])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id).cast("string").alias("id"), F.col(text).alias("text"),
        F.coalesce(part.cast("int"), F.lit(OTHER)).alias("part"),
    )
    table = stored(rows.mapInPandas(cut, PIECE), "pieces")
    sizes = {r["part"]: r["n"] for r in table.groupBy("part").agg(F.sum("tokens").alias("n")).collect()}
    ranges = max(1, -(-sum(sizes.values()) // range_keys))

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, row in frame.iterrows():
                out = []
                for kind, keys, counts in Piece.of(row).asked():
                    order = np.argsort(keys, kind="stable")
                    keys, counts = keys[order], counts[order]
                    within = ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
                    found, begins = np.unique(within, return_index=True)
                    for number, begin, end in zip(found, begins, [*begins[1:], len(keys)], strict=True):
                        gaps = np.diff(keys[begin:end], prepend=np.uint64(0))
                        out.append((kind * ranges + number, row["start"], row["offset"], row["part"], pack(gaps), pack(counts[begin:end])))
                yield pd.DataFrame(out, columns=["range", "start", "offset", "part", "keys", "counts"])

    def answer(asked: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(unpack(k), dtype=np.uint64) for k in asked["keys"]]
        ends = np.cumsum([len(k) for k in keys])[:-1]
        counts = np.concatenate([unpack(c) for c in asked["counts"]]).astype(float)
        parts = np.repeat(asked["part"].to_numpy(), [len(k) for k in keys])
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        sums = [np.bincount(place, counts * (parts == p)).astype(np.int64) for p in (RETAINED, HELD)]
        out = asked[["range", "start", "offset", "part"]].copy()
        # of the range, on its first row
        out["known"] = [int(np.count_nonzero(sums[0] + sums[1]))] + [0] * (len(asked) - 1)
        for name, total in zip(("retained", "held"), sums, strict=True):
            out[name] = [pack(a) for a in np.split(total[place], ends)]
        return out

    tasks = max(ranges, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    asked = table.mapInPandas(ask, ASKED).repartition(tasks, "range")
    answers = stored(asked.groupBy("range").applyInPandas(answer, ANSWERED), "answers")
    vocabulary = answers.filter(F.col("range") < ranges).agg(F.sum("known")).first()[0] or 0
    retained, held = (sizes.get(p, 0) for p in (RETAINED, HELD))
    return Counts(table, answers, ranges, tasks, retained, retained + held, vocabulary, contexts)


def bucket(share: np.ndarray) -> np.ndarray:
    """Of a context's relative frequency: 0 for more than a half, 1 for more than a quarter and so on."""
    return np.floor(-np.log2(np.maximum(share, 1e-300))).astype(int)


def expectation_maximisation(count: np.ndarray, estimates: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Weights of a mixture: ``estimates`` holds a row of probabilities for each of ``count`` equal observations."""
    weights = np.full(estimates.shape[1], 1 / estimates.shape[1])
    if count.sum() <= 0:
        return weights
    for _ in range(rounds):
        share = estimates * weights
        share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
        weights = count @ share / count.sum()
    # the uniform estimate keeps a little, so nothing is impossible
    weights[-1] = max(weights[-1], 1e-6)
    return weights / weights.sum()


@dataclass
class Weights:
    pair: np.ndarray  # by bucket: pair, word, uniform
    lone: np.ndarray  # word, uniform


@dataclass
class Facts:
    """A piece's answers: retained and total counts of its words, and of its pairs."""

    word_retained: np.ndarray
    word_total: np.ndarray
    pair_retained: np.ndarray
    pair_total: np.ndarray


def facts_of(piece: Piece, answers: pd.DataFrame, ranges: int) -> Facts:
    answers = answers.sort_values("range")
    out = []
    for kind, keys, _ in piece.asked():
        own = answers[(answers["range"] // ranges) == kind]
        order = np.argsort(keys, kind="stable")
        counts = [np.empty(len(keys), np.int64) for _ in range(2)]
        for values, name in zip(counts, ("retained", "held"), strict=True):
            values[order] = np.concatenate([unpack(a) for a in own[name]]).astype(np.int64)
        out += [counts[0], counts[0] + counts[1]]
    return Facts(*out)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.divide(part, whole, out=np.zeros(len(part)), where=whole > 0)


def _steps(estimate: np.ndarray) -> pd.Series:
    """Logarithm in steps; missing for zero."""
    return pd.Series(np.round(np.log2(np.where(estimate > 0, estimate, np.nan)) * STEPS)).astype("Int64")


def _each_piece(counts: Counts, held_only: bool):
    tables = [counts.pieces, counts.answers]
    if held_only:
        tables = [t.filter(F.col("part") == HELD) for t in tables]
    # as many tasks as the tokens ask for, however many the session's setting has
    near, far = (t.repartition(counts.tasks, "start", "offset").groupBy("start", "offset") for t in tables)
    return near.cogroup(far)


def learn_weights(counts: Counts) -> Weights:
    """Mixture weights of each bucket, from the held-out counts of all pairs."""
    bare = _bare(counts)
    retained = max(bare.retained, 1)

    def seen_in(row: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        piece = Piece.of(row.iloc[0])
        facts = facts_of(piece, answers, bare.ranges)
        heads = np.where(bare.has_pairs(facts.word_total), facts.word_retained, 0)[piece.context]
        buckets = pd.Series(np.minimum(bucket(heads / retained), MOST_BUCKETS - 1)).astype("Int64").mask(heads == 0)
        found = pd.DataFrame({
            "bucket": buckets,
            "pair": _steps(_share(facts.pair_retained, heads)),
            "word": _steps(facts.word_retained[piece.token] / retained),
            "held": piece.pair_counts,
        })
        return found.groupby(["bucket", "pair", "word"], dropna=False, as_index=False)["held"].sum()

    found = _each_piece(counts, True).applyInPandas(seen_in, "bucket int, pair int, word int, held long")
    table = found.groupBy("bucket", "pair", "word").agg(F.sum("held").alias("held"))
    # bounded by buckets x steps x steps of the logarithms
    seen = pd.DataFrame([r.asDict() for r in collectable(table, 2_000_000, "weights")], columns=["bucket", "pair", "word", "held"])
    seen = seen.sort_values(["bucket", "pair", "word"], ignore_index=True)
    estimate = {c: np.where(seen[c].isna(), 0.0, np.exp2(seen[c].astype(float) / STEPS)) for c in ("pair", "word")}
    uniform = np.full(len(seen), 1 / (counts.vocabulary + 1))
    held = seen["held"].to_numpy(float)
    lone = seen["bucket"].isna().to_numpy()
    by_bucket = {}
    for b in sorted(set(seen["bucket"].dropna().astype(int))):
        rows = (seen["bucket"] == b).to_numpy()
        by_bucket[b] = expectation_maximisation(
            held[rows], np.stack([estimate["pair"][rows], estimate["word"][rows], uniform[rows]], axis=1)
        )
    alone = expectation_maximisation(held[lone], np.stack([estimate["word"][lone], uniform[lone]], axis=1))
    # a context is looked up in the bucket it has over both parts, or the nearest that was learned
    by_bucket = by_bucket or {0: np.full(3, 1 / 3)}
    nearest = [min(by_bucket, key=lambda b, own=own: (abs(b - own), b)) for own in range(MOST_BUCKETS)]
    return Weights(np.array([by_bucket[b] for b in nearest]), alone)


def _bare(counts: Counts) -> Counts:
    """Without its tables, to travel to tasks."""
    return Counts(None, None, counts.ranges, counts.tasks, counts.retained, counts.total, counts.vocabulary, counts.contexts)


def pair_scores(piece: Piece, facts: Facts, counts: Counts, weights: Weights) -> np.ndarray:
    """log10 of the probability of each of the piece's pairs: the token, given its context."""
    heads = facts.word_total[piece.context]
    word = facts.word_total[piece.token] / max(counts.total, 1)
    uniform = 1.0 / (counts.vocabulary + 1)
    own = weights.pair[np.clip(bucket(heads / max(counts.total, 1)), 0, MOST_BUCKETS - 1)]
    paired = own[:, 0] * _share(facts.pair_total, heads) + own[:, 1] * word + own[:, 2] * uniform
    lone = weights.lone[0] * word + weights.lone[1] * uniform
    return np.log10(np.where(counts.has_pairs(facts.word_total)[piece.context], paired, lone))


def score(
    docs: DataFrame, part: Column, id: str = "doc_id", text: str = "text", contexts: int | None = None, base: float = 0.1, **sizes: int
) -> DataFrame:
    """Columns id, n_tokens, n_known, train_tokens, base_score and score (log10), one row per document.

    ``part`` gives each document's part: RETAINED and HELD are learned from, OTHER is scored only.  ``sizes`` are those of ``count``.
    """
    counts = count(docs, part, id, text, contexts, **sizes)
    weights = learn_weights(counts)
    bare = _bare(counts)

    def run(row: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = row.iloc[0]
        piece = Piece.of(row)
        facts = facts_of(piece, answers, bare.ranges)
        seen = facts.word_total[piece.stream]
        base_lp = np.log10((seen + base) / (bare.total + base * (bare.vocabulary + 1)))
        lp = pair_scores(piece, facts, bare, weights)[piece.pair_of]
        of, size = piece.text_of, len(row["rows"])
        return pd.DataFrame({
            "row": row["rows"], "id": row["ids"], "n": np.bincount(of, minlength=size),
            "known": np.bincount(of, seen > 0, size).astype(np.int64),
            "base_lp": np.bincount(of, base_lp, size), "lp": np.bincount(of, lp, size),
        })

    scored = _each_piece(counts, False).applyInPandas(run, SCORED)
    # a text that was cut has a row in each of its pieces
    summed = scored.groupBy("row").agg(
        F.max("id").alias("id"), F.sum("n").alias("n_tokens"),
        F.sum("known").alias("n_known"), F.sum("base_lp").alias("base_score"), F.sum("lp").alias("score"),
    )
    return summed.select(
        F.col("id").cast(docs.schema[id].dataType).alias(id), "n_tokens", "n_known",
        F.lit(counts.total).cast("long").alias("train_tokens"), "base_score", "score",
    )
