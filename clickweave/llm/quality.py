"""Quality classifier: hashed word and character n-gram vectors, averaged per document, softmax output.

The features of a word are its own hash and those of the character n-grams of ``<word>``, all in one table of
``buckets`` vectors; a word equal to the one before it adds one more feature, whatever the word. A document
is the mean of its features' vectors; a linear layer and a softmax give the two classes. Vectors and layer
are learned together by plain stochastic gradient descent, one document at a time, in numpy, as public
papers on supervised subword embeddings describe.

Training takes a bounded sample: the first ``train_rows`` labelled rows in the order of a hash of doc_id, of their
documents one row per (doc_id, label, text) and again the first ``train_rows`` in that order, and of those as many
as have ``train_features`` different (document, feature) pairs in all. It runs in one task, which reads only that
sample, and its order is fixed, so a retry learns the same model.

Scoring reads every whole text. The output is linear in the mean before the softmax, so a feature counts with
one number and a word with the sum of its features' numbers. A Python worker keeps one scorer with a bounded cache
of words over all its tasks of one model, until another operator needs the memory; the n-grams of all words of a
batch that it has not seen are hashed at once in numpy, by the same code in training and scoring.

A null or empty text has no features and gets the score of the bias alone. Labels without a quality, a doc_id
or a document are left out; without any label every score is 0.5. Repeated rows are scored, or learned from,
one by one. Only the text is ever an input.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from clickweave.llm.common import give_back, kept, texts

_CACHE = 250_000  # words kept by a worker


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18
    dimensions: int = 8
    shortest: int = 2
    longest: int = 4
    epochs: int = 8
    least_steps: int = 6000  # small samples are gone through more often
    rate: float = 0.5
    train_rows: int = 6000
    train_features: int = 20_000_000


# Odd multipliers of the code points in the hash of an n-gram.
_TIMES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D, 0xFD7046C5, 0xB55A4F09], np.uint32)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the sum reaches the low ones."""
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    h = (h ^ (h >> np.uint32(12))) * np.uint32(0x297A2D39)
    return h ^ (h >> np.uint32(15))


def features_of(words: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """All features of all words at once: feature numbers, and for each the place of its word in the list."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    marked = "".join([f"<{word}>" for word in words])
    points = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(lengths)
    word_of = np.repeat(np.arange(len(words)), lengths)
    left = ends[word_of] - np.arange(len(points))  # code points from here to the word's end
    powers = np.cumprod(np.full(lengths.max(), _TIMES[0], np.uint32), dtype=np.uint32)
    whole = np.add.reduceat((points + np.uint32(1)) * powers[left - 1], ends - lengths, dtype=np.uint32)
    features, owners = [_mixed(whole).astype(np.int64) % s.buckets], [np.arange(len(words))]
    for n in range(s.shortest, s.longest + 1):
        at = np.flatnonzero(left >= n)
        h = np.full(len(at), n, np.uint32)
        for i in range(n):
            h += (points[at + i] + np.uint32(1)) * _TIMES[i % len(_TIMES)]
        features.append(_mixed(h).astype(np.int64) % s.buckets)
        owners.append(word_of[at])
    return np.concatenate(features), np.concatenate(owners)


def repeat_feature(s: Settings) -> int:
    return xxhash.xxh32_intdigest("", 2) % s.buckets


def _batches(texts: Iterable[str], size: int = 1 << 18) -> Iterator[list[list[str]]]:
    """Words of consecutive texts, about ``size`` characters at a time; a longer text is a batch of its own."""
    held, room = [], size
    for text in texts:
        held.append(text.split())
        room -= len(text)
        if room <= 0:
            yield held
            held, room = [], size
    if held:
        yield held


class _Vocabulary:
    """Numbers words in the order in which they are first met and tells ``learn`` all new ones of a batch at once."""

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {}

    def reset(self) -> None:
        self.numbers.clear()

    def learn(self, words: list[str]) -> None:
        raise NotImplementedError

    def ids(self, batch: list[list[str]]) -> Iterator[np.ndarray]:
        """The numbers of each text's words."""
        if len(self.numbers) > _CACHE:
            self.reset()
        met = set().union(*batch)
        fresh = list(met.difference(self.numbers))
        self.learn(fresh)
        self.numbers.update(zip(fresh, range(len(self.numbers), len(self.numbers) + len(fresh))))
        for words in batch:
            yield np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))


class Bags(_Vocabulary):
    """Features of documents with their shares."""

    def __init__(self, s: Settings):
        super().__init__()
        self.s, self.lists = s, []

    def reset(self) -> None:
        super().reset()
        self.lists.clear()

    def learn(self, words: list[str]) -> None:
        features, owners = features_of(words, self.s)
        features = features[np.argsort(owners, kind="stable")].astype(np.int32)
        self.lists.extend(np.split(features, np.cumsum(np.bincount(owners, minlength=len(words)))[:-1]) if words else [])

    def __call__(self, texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in _batches(texts):
            for ids in self.ids(batch):
                same = int((ids[1:] == ids[:-1]).sum())
                every = np.concatenate([*(self.lists[i] for i in ids), np.full(same, repeat_feature(self.s), np.int32)]) if len(ids) else ids
                features, counts = np.unique(every, return_counts=True)
                yield features, (counts / max(1, len(every))).astype(np.float32)


@dataclass
class Model:
    vectors: np.ndarray  # buckets x dimensions
    layer: np.ndarray  # 2 x dimensions
    bias: np.ndarray  # 2

    def packed(self) -> tuple[bytes, bytes, bytes]:
        return self.vectors.tobytes(), self.layer.tobytes(), self.bias.tobytes()

    @classmethod
    def unpacked(cls, s: Settings, vectors: bytes, layer: bytes, bias: bytes) -> Model:
        shape = (s.buckets, s.dimensions)
        return cls(np.frombuffer(vectors, "f4").reshape(shape), np.frombuffer(layer, "f4").reshape(2, -1), np.frombuffer(bias, "f4"))

    def mean(self, features: np.ndarray, shares: np.ndarray) -> np.ndarray:
        return shares @ self.vectors[features] if len(features) else np.zeros(self.layer.shape[1], np.float32)

    def probabilities(self, mean: np.ndarray) -> np.ndarray:
        raw = self.layer @ mean + self.bias
        e = np.exp(raw - raw.max())
        return e / e.sum()


def trained(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[int], s: Settings) -> Model:
    """Stochastic gradient descent with a rate that falls to zero."""
    draw = np.random.default_rng(7)
    start = draw.uniform(-1 / s.dimensions, 1 / s.dimensions, (s.buckets, s.dimensions)).astype(np.float32)
    model = Model(start, np.zeros((2, s.dimensions), np.float32), np.zeros(2, np.float32))
    epochs = max(s.epochs, -(-s.least_steps // max(1, len(bags))))
    steps, step = max(1, epochs * len(bags)), 0
    for _ in range(epochs if bags else 0):
        for i in draw.permutation(len(bags)):
            features, shares = bags[i]
            rate = np.float32(s.rate * (1 - step / steps))
            step += 1
            mean = model.mean(features, shares)
            wrong = model.probabilities(mean)
            wrong[labels[i]] -= 1
            back = wrong @ model.layer
            model.layer -= rate * np.outer(wrong, mean)
            model.bias -= rate * wrong
            if len(features):
                # the mean's gradient goes to every vector by its share; scaled up, since shares are small
                model.vectors[features] -= rate * (shares / shares.max())[:, None] * back[None, :]
    return model


def sample(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """At most ``train_rows`` rows to learn from: place, doc_id, label, text."""
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)
    )
    first = known.select("*", F.xxhash64("doc_id").alias("place")).orderBy("place", "doc_id", "label").limit(s.train_rows)
    # There are at most train_rows labels, so a copy of them may go to every task.
    said = texts(docs, doc_id, text).join(F.broadcast(first), "doc_id").select("place", "doc_id", "label", "text")
    # However many rows share a sampled doc_id, no more than train_rows of them are learned from.
    return said.distinct().orderBy("place", "doc_id", "label", "text").limit(s.train_rows)


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Learn from the rows of ``labels``; the caller has left out those that must not be learned from."""

    def learned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make, bags, marks, room = Bags(s), [], [], s.train_features
        for batch in batches:
            for mark, bag in zip(batch["label"], make(batch["text"])):
                if room > 0:
                    bags.append(bag)
                    marks.append(int(mark))
                    room -= len(bag[0])
        make.reset()
        if bags:
            yield pd.DataFrame([trained(bags, marks, s).packed()], columns=["vectors", "layer", "bias"])
        bags.clear()
        give_back()

    one = sample(docs, labels, s, doc_id, text, label).repartition(1).sortWithinPartitions("place", "doc_id", "label", "text")
    model = one.mapInPandas(learned, "vectors binary, layer binary, bias binary").toArrow().to_pylist()
    if not model:
        return trained([], [], s)
    return Model.unpacked(s, **model[0])


class Scorer(_Vocabulary):
    """Scores whole texts with the numbers of their words."""

    def __init__(self, model: Model, s: Settings):
        super().__init__()
        self.s, self.values = s, (model.vectors @ (model.layer[1] - model.layer[0])).astype(np.float64)
        self.bias = float(model.bias[1] - model.bias[0])
        self.repeat = self.values[repeat_feature(s)]
        self.sums = self.counts = np.empty(0)

    def reset(self) -> None:
        super().reset()
        self.sums = self.counts = np.empty(0)

    def learn(self, words: list[str]) -> None:
        features, owners = features_of(words, self.s)
        self.sums = np.concatenate([self.sums, np.bincount(owners, self.values[features], len(words))])
        self.counts = np.concatenate([self.counts, np.bincount(owners, minlength=len(words))])

    def __call__(self, texts: Iterable[str]) -> Iterator[float]:
        for batch in _batches(texts):
            for ids in self.ids(batch):
                same = int((ids[1:] == ids[:-1]).sum())
                count = self.counts[ids].sum() + same
                raw = self.bias + ((self.sums[ids].sum() + same * self.repeat) / count if count else 0.0)
                yield float(1 / (1 + np.exp(-np.clip(raw, -60, 60))))


def scored(df: DataFrame, model: Model, s: Settings = Settings(), text: str = "text", score: str = "score") -> DataFrame:
    """``df`` with one more column, the probability of label 1; the model's size is bounded by the settings."""
    spark = df.sparkSession
    packed = model.packed()
    name = f"scorer {s} {xxhash.xxh3_128_hexdigest(b''.join(packed))}"
    shared = spark.sparkContext.broadcast(packed)
    names = df.columns
    rows = df.select(F.struct(*names).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text")) if names != ["doc_id", "text"] else df

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = kept(name, lambda: Scorer(Model.unpacked(s, *shared.value), s))
        for batch in batches:
            yield pd.Series(list(scorer(batch)), index=batch.index, dtype=float)

    scores.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    score_of = F.pandas_udf(scores, "double")
    if rows is df:
        return df.withColumn(score, score_of("text"))
    return rows.select("row.*", score_of("text").alias(score))


def is_held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    name = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(name.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, s: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = train(docs, labels.where(~is_held_out()), s)
    return scored(texts(docs), model, s).select(
        "doc_id", is_held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, s: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, with their columns, that score at least ``threshold``."""
    model = train(docs, labels.where(~is_held_out()), s)
    names = docs.columns
    whole = docs.select(F.struct(*names).alias("whole"), F.col("text").alias("text"))
    return scored(whole, model, s, score="score").where(F.col("score") >= threshold).select("whole.*")
