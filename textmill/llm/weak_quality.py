"""A quality classifier from weak labels.

Heuristic labellers vote clean, junk or toxic on each document or abstain; several look at the same symptom in different
ways. Expectation-maximisation over the counts of all vote patterns estimates how often each labeller gives each vote
for each class, and so the posterior class of every pattern. A linear softmax scorer on hashed word beginnings and
word shapes is then trained on posteriors and scores every document, also those on which the labellers are silent.

Two labellers know insults from a list. Two more look for word beginnings typical of toxic text, learnt from at most
``LABELLED`` rows of a table of labelled documents, if one is given.

Patterns are counted over all documents; the driver sees their table, whose size depends on the labellers alone. The
scorer is fitted on the driver on at most ``SAMPLE`` documents, those with the smallest hashes. Scoring reads the texts
in place with the broadcast weights (some 800 kB); nothing else is shuffled.

Edge cases: a null or blank text is junk with certainty; repeated rows are scored one by one, alike; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm import arrow_text as at
from textmill.llm.common import pick
from textmill.storage import stage_table

CLEAN, JUNK, TOXIC = 1, 2, 3  # votes; 0 abstains
CLASSES = ("clean", "junk", "toxic")
SAMPLE = 6_000
LABELLED = 20_000
LEARNT = 2_000  # word beginnings at most
BEGINNING = 5  # bytes
BUCKET_BITS = 15
EM_ROUNDS = 60
EPOCHS = 150

# Function words of the languages expected, and common insults.
FUNCTION_WORDS = (
    "the of and to in is that it for on with as was be by at this are from or an not "
    "der die und das ist nicht ein eine zu den mit von sich auf für im "
    "le la les des est une que dans pour qui sur pas par au avec "
    "el los las una por con para del se su como más"
).split()
INSULTS = "idiot stupid moron loser trash scum pathetic worthless disgusting clown imbecile dumbass jerk".split()

_LABELLERS = (
    "length", "capitals", "shouting", "symbols", "marked", "runs", "variety", "function", "insult", "insults",
    "learnt", "learnt twice",
)
_SHAPES = 16
_DAMPING = 0.4
N_FEATURES = _SHAPES + (1 << BUCKET_BITS)


def _hashes(words: Iterable[str]) -> np.ndarray:
    return np.sort(np.concatenate([at.words(pa.array([w]), at.NOT_BLANK).hashes for w in words]))


_FUNCTION, _INSULT = _hashes(FUNCTION_WORDS), _hashes(INSULTS)
_PUNCTUATION = at.NOT_BLANK & ~at.LETTER_OR_DIGIT
_PUNCTUATION[65:91] = False


_TOXIC_LABELLERS = 4
_PRIOR = (0.8, 0.12, 0.08)
BELIEF_DOCS = 100  # what a belief weighs against the documents, at any number of these
# By class, how likely each vote is believed to be: abstain, clean, junk, toxic.
_BELIEF = {
    "quality": np.array([[0.15, 0.82, 0.02, 0.01], [0.2, 0.44, 0.35, 0.01], [0.15, 0.82, 0.02, 0.01]]),
    "toxic": np.array([[0.97, 0.01, 0.01, 0.01], [0.96, 0.01, 0.01, 0.02], [0.4, 0.01, 0.01, 0.58]]),
}


class Features:
    """Counts of each row of a column, and the feature numbers of its words."""

    def __init__(self, column: pa.Array, learnt: np.ndarray) -> None:
        raw, offsets = at.utf8(column)
        words = at.words(column, at.NOT_BLANK)  # split at blanks, for shapes
        bare = at.words(column, at.LETTER_OR_DIGIT)
        self.n, self.bare_n = words.counts(), bare.counts()
        self.first, self.bare_first = words.first, bare.first
        self.beginnings = beginnings(bare)
        mark = lambda table: np.concatenate([[0], np.cumsum(table[raw])])
        upper, letter = np.zeros(256, bool), np.zeros(256, bool)
        upper[65:91] = letter[65:91] = letter[97:123] = True
        symbol, shout = np.zeros(256, bool), np.zeros(256, bool)
        symbol[[ord(c) for c in "#*$%&|<>"]] = True
        shout[ord("!")] = True
        sums = {"upper": mark(upper), "letter": mark(letter), "symbol": mark(symbol), "shout": mark(shout)}
        by_row = lambda name: np.diff(sums[name][offsets])
        by_word = lambda name: sums[name][words.ends] - sums[name][words.starts]
        self.upper, self.letters, self.symbols, self.shouts = map(by_row, ("upper", "letter", "symbol", "shout"))
        same = np.zeros(len(words.hashes), bool)
        same[1:] = words.hashes[1:] == words.hashes[:-1]
        same[words.first[:-1][words.first[:-1] < len(same)]] = False
        self.repeats = self._total(same, words.first)
        self.function = self._total(np.isin(bare.hashes, _FUNCTION), bare.first)
        self.insults = self._total(np.isin(bare.hashes, _INSULT), bare.first)
        self.learnt = self._total(np.isin(self.beginnings, learnt), bare.first)
        self.distinct = np.array(
            [len(np.unique(words.hashes[a:b])) for a, b in zip(words.first[:-1], words.first[1:])], np.int64
        )
        length = words.ends - words.starts
        caps = (by_word("upper") > 1) & (by_word("upper") == by_word("letter"))
        marked = by_word("symbol") > 0
        self.marked = self._total(marked, words.first)
        shapes = (caps, marked, same, length > 12, length < 3, by_word("shout") > 0)
        self.shapes = np.stack([self._total(s, words.first) for s in shapes], axis=1)

    @staticmethod
    def _total(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags)])[first])

    def votes(self) -> np.ndarray:
        """One column per labeller."""
        n = np.maximum(self.n, 1)

        def vote(value: np.ndarray, junk: np.ndarray, clean: np.ndarray) -> np.ndarray:
            return np.where(junk(value), JUNK, np.where(clean(value), CLEAN, 0))

        return np.stack(
            [
                vote(self.n, lambda v: v < 30, lambda v: v >= 80),
                vote(self.upper / np.maximum(self.letters, 1), lambda v: v > 0.5, lambda v: v < 0.15),
                vote(self.shouts / n, lambda v: v > 0.2, lambda v: v < 0.02),
                vote(self.symbols / n, lambda v: v > 0.2, lambda v: v < 0.02),
                vote(self.marked / n, lambda v: v > 0.15, lambda v: v < 0.02),
                vote(self.repeats / n, lambda v: v > 0.2, lambda v: v < 0.05),
                vote(self.distinct / n**0.9, lambda v: v < 0.3, lambda v: v > 0.6),
                vote(self.function / np.maximum(self.bare_n, 1), lambda v: v < 0.03, lambda v: v > 0.08),
                np.where(self.insults > 0, TOXIC, 0),
                np.where(self.insults > 1, TOXIC, 0),
                np.where(self.learnt > 0, TOXIC, 0),
                np.where(self.learnt > 1, TOXIC, 0),
            ],
            axis=1,
        )

    def buckets(self) -> np.ndarray:
        """Feature number of each word, by its beginning."""
        return (self.beginnings >> np.uint64(64 - BUCKET_BITS)).astype(np.int64) + _SHAPES

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Class scores of each row: weights of its words and shapes by their counts, damped by its length."""
        sums = np.concatenate([np.zeros((1, weights.shape[1])), np.cumsum(weights[self.buckets()], axis=0, dtype=float)])
        total = np.diff(sums[self.bare_first], axis=0) + self.shapes @ weights[: self.shapes.shape[1]]
        return total / np.maximum(self.n, 1)[:, None] ** _DAMPING + weights[_SHAPES - 1]


def beginnings(words: at.Words) -> np.ndarray:
    return at.span_hashes(words.data, words.starts, np.minimum(words.starts + BEGINNING, words.ends))


def _pack(votes: np.ndarray) -> np.ndarray:
    return votes @ (4 ** np.arange(votes.shape[1]))


def unpack(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 4 ** np.arange(len(_LABELLERS)) % 4


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(posterior of each pattern, probability of each vote by labeller and class) by expectation-maximisation.

    Labellers are taken to be better than chance: ``_BELIEF``, what a vote is believed to mean, is where it starts and
    counts as much as ``BELIEF_DOCS`` documents of each class, so with more documents the estimates follow these.
    """
    votes = unpack(patterns)
    one = votes[:, :, None] == np.arange(4)
    kinds = [_BELIEF["toxic" if k >= votes.shape[1] - _TOXIC_LABELLERS else "quality"] for k in range(votes.shape[1])]
    belief = np.stack(kinds)
    accuracy, prior = belief, np.array(_PRIOR)
    for _ in range(rounds):
        log = np.log(prior / prior.sum()) + np.einsum("plv,lcv->pc", one, np.log(accuracy))
        posterior = np.exp(log - log.max(1, keepdims=True))
        posterior /= posterior.sum(1, keepdims=True)
        weight = posterior * counts[:, None]
        prior = weight.sum(0) + 1
        accuracy = np.einsum("pc,plv->lcv", weight, one) + belief * BELIEF_DOCS
        accuracy /= accuracy.sum(2, keepdims=True)
    return posterior, accuracy


def fit_scorer(
    row: np.ndarray, feature: np.ndarray, value: np.ndarray, target: np.ndarray, epochs: int = EPOCHS
) -> np.ndarray:
    """Softmax weights (feature, class) for soft targets, by full-batch Adagrad on (row, feature, value) entries."""
    weights = np.zeros((N_FEATURES, target.shape[1]))
    squares = np.full_like(weights, 1e-8)
    n = max(len(target), 1)
    for _ in range(epochs):
        score = np.stack([np.bincount(row, value * weights[feature, c], n) for c in range(target.shape[1])], axis=1)
        score = np.exp(score - score.max(1, keepdims=True))
        error = (score / score.sum(1, keepdims=True) - target) / n
        grad = np.stack(
            [np.bincount(feature, value * error[row, c], N_FEATURES) for c in range(target.shape[1])], axis=1
        )
        grad += 1e-6 * weights
        squares += grad**2
        weights -= 1.0 * grad / np.sqrt(squares)
    return weights


def _vote_batches(batches: Iterable[pa.RecordBatch], learnt: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in at.slices(batches, "text"):
        pattern = _pack(Features(batch.column("text"), learnt.value).votes())
        yield pa.RecordBatch.from_arrays([batch.column("place"), pa.array(pattern, pa.int64())], names=["place", "pattern"])


def _entry_batches(batches: Iterable[pa.RecordBatch], learnt: Broadcast) -> Iterator[pa.RecordBatch]:
    """The pattern, features and values of each row of the sample."""
    for batch in at.slices(batches, "text"):
        f = Features(batch.column("text"), learnt.value)
        pattern, buckets = _pack(f.votes()), f.buckets()
        features, values = [], []
        for i in range(batch.num_rows):
            names, counts = np.unique(buckets[f.bare_first[i] : f.bare_first[i + 1]], return_counts=True)
            shapes = np.arange(f.shapes.shape[1])
            features.append(np.concatenate([names, shapes, [_SHAPES - 1]]).astype(np.int32))
            scaled = np.concatenate([counts, f.shapes[i]]) / max(f.n[i], 1) ** _DAMPING
            values.append(np.concatenate([scaled, [1.0]]).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(pattern, pa.int64()),
                pa.array(features, pa.list_(pa.int32())),
                pa.array(values, pa.list_(pa.float32())),
            ],
            names=["pattern", "features", "values"],
        )


def _score_batches(batches: Iterable[pa.RecordBatch], weights: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in at.slices(batches, "text"):
        f = Features(batch.column("text"), np.zeros(0, np.uint64))
        score = f.scores(weights.value)
        score = np.exp(score - score.max(1, keepdims=True))
        p = score / score.sum(1, keepdims=True)
        p[f.n == 0] = [0.0, 1.0, 0.0]
        labels = pa.array(CLASSES).take(pa.array(p.argmax(1)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *(pa.array(p[:, c]) for c in range(len(CLASSES))), labels],
            names=["id", *(f"p_{c}" for c in CLASSES), "label"],
        )


def _beginning_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct word beginnings of each row with the row's flag."""
    for batch in at.slices(batches, "text"):
        words = at.words(batch.column("text"), at.LETTER_OR_DIGIT)
        hashes, flags = beginnings(words), batch.column("flag").to_pylist()
        parts = [np.unique(hashes[a:b]) for a, b in zip(words.first[:-1], words.first[1:])]
        flagged = np.repeat(np.array(flags, np.int32), [len(p) for p in parts])
        every = np.concatenate([np.zeros(0, np.uint64), *parts])
        yield pa.RecordBatch.from_arrays([pa.array(every.view(np.int64)), pa.array(flagged)], names=["h", "flag"])


def learn_beginnings(texts: DataFrame, flags: DataFrame, labelled: int = LABELLED) -> np.ndarray:
    """Word beginnings of five flagged documents or more, nine in ten of whose documents are flagged.

    ``flags`` has the columns id and flag (0 or 1); its ``labelled`` rows with the smallest hashes are used.
    """
    some = flags.filter("id is not null and flag is not null").dropDuplicates(["id"])
    some = some.orderBy(F.xxhash64("id"), "id").limit(labelled)
    rows = texts.join(F.broadcast(some), "id").select("text", F.col("flag").cast("int").alias("flag"))
    found = rows.mapInArrow(_beginning_batches, "h long, flag int")
    counted = found.groupBy("h").agg(F.sum("flag").alias("flagged"), F.count(F.lit(1)).alias("n"))
    typical = counted.filter("flagged >= 5 and flagged * 10 >= n * 9")
    kept = typical.orderBy(F.desc("flagged"), "h").limit(LEARNT).collect()
    return np.sort(np.array([r["h"] for r in kept], np.int64).view(np.uint64))


def fit(texts: DataFrame, flags: DataFrame | None = None, sample: int = SAMPLE) -> np.ndarray:
    """Weights of the scorer for ``texts`` (columns id, text)."""
    learnt = np.zeros(0, np.uint64) if flags is None else learn_beginnings(texts, flags)
    learnt = texts.sparkSession.sparkContext.broadcast(learnt)
    texts = texts.withColumn("place", F.xxhash64("id", "text"))
    voted = stage_table(texts.mapInArrow(lambda b: _vote_batches(b, learnt), "place long, pattern long"), "votes")
    counted = voted.groupBy("pattern").count().collect()  # one row per pattern of votes
    if not counted:
        return np.zeros((N_FEATURES, len(CLASSES)))
    patterns, counts = (np.array([r[k] for r in counted]) for k in ("pattern", "count"))
    posterior, _ = fit_labellers(patterns, counts)
    bound = voted.select("place").orderBy("place").limit(sample).agg(F.max("place")).first()[0]
    drawn = texts.filter(F.col("place") <= bound).limit(sample).select("text")
    schema = "pattern long, features array<int>, values array<float>"
    entries = drawn.mapInArrow(lambda b: _entry_batches(b, learnt), schema).toPandas()
    row = np.repeat(np.arange(len(entries)), entries["features"].map(len))
    of_pattern = dict(zip(patterns.tolist(), posterior))
    target = np.stack([of_pattern[p] for p in entries["pattern"]])
    return fit_scorer(row, np.concatenate(entries["features"]), np.concatenate(entries["values"]), target)


def classify(
    docs: DataFrame,
    flags: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    flag_id_col: str = "doc_id",
    flag_col: str = "toxic",
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per row of ``docs``: id, probability of each class, label. ``flags`` labels some ids as toxic or not."""
    texts = pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    flags = None if flags is None else pick(flags, id=flag_id_col, flag=flag_col)
    weights = docs.sparkSession.sparkContext.broadcast(fit(texts, flags, sample).astype(np.float32))
    schema = "id long, " + ", ".join(f"p_{c} double" for c in CLASSES) + ", label string"
    return texts.mapInArrow(lambda batches: _score_batches(batches, weights), schema)
