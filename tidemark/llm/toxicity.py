"""Toxicity by weak supervision: many weak voters, a label model, and a linear classifier.

Voters are lexicon entries (words and word beginnings that a bounded sample of labelled texts
suggests) and patterns (shouting, masked words, insults in the second person, repeated marks). A
voter fires on a text or abstains. The label model takes the true label as hidden and estimates by
expectation maximisation how often each voter fires on toxic and on other texts. Voters that
repeat each other (a word and its beginning) are found by their correlation among toxic texts, and
share one vote. A logistic model of word features is then trained on the posterior labels, and
scores every text; it also weighs words that no voter knew.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_remainder, slices, staged, whole
from tidemark.llm.linear import Sparse, fit_logistic, sigmoid

_WORD = re.compile(r"[^\W\d_]+")

#: Beginnings of words that count as features.
BEGINNINGS = (4, 5)

PATTERNS = {
    "shouting": re.compile(r"\b[A-Z]{4,}(?:\W+[A-Z]{4,}){5,}"),
    "masked word": re.compile(r"\b[a-z]{1,3}[*@#$]{2,}[a-z]{0,4}\b", re.IGNORECASE),
    "second person": re.compile(r"\byou(?:'re| are)(?: an?| such an?| all)? (?:idiot|moron|loser|stupid|pathetic)", re.IGNORECASE),
    "repeated marks": re.compile(r"[!?]{4,}"),
    "threat": re.compile(r"\b(?:hate|kill|shut up|get lost|go to hell)\b", re.IGNORECASE),
}


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(word: str) -> list[str]:
    """A word and its beginnings."""
    return [word, *[f"{word[:k]}~" for k in BEGINNINGS if len(word) >= k]]


def text_features(text: str) -> Counter:
    """How many distinct words of the text have each feature."""
    return Counter(f for w in words_of(text) for f in features_of(w))


@dataclass
class LabelModel:
    """How often each voter fires on toxic and on other texts, and how much of a vote it has.

    That a voter abstains tells something too, as much as its rates differ. The known label of a
    text is one more voter, of a given accuracy.
    """

    prior: float
    fires: np.ndarray  # (2, voters): on other texts, on toxic texts
    share: np.ndarray
    accuracy: float = 0.97

    @classmethod
    def fit(cls, votes: np.ndarray, known: np.ndarray, rounds: int = 45) -> LabelModel:
        """``votes`` (texts, voters) of 0 and 1; ``known``: 1, 0, or -1 where there is no label."""
        prior = float(np.clip(known[known >= 0].mean(), 0.001, 0.999))
        model = cls(prior, np.zeros((2, votes.shape[1])), np.ones(votes.shape[1]))
        posterior = np.where(known < 0, prior, np.where(known == 1, model.accuracy, 1 - model.accuracy))
        for turn in range(rounds):
            # the first round reads the texts with a label alone
            used = known >= 0 if turn == 0 else np.ones(len(known), bool)
            for label, weight in ((0, (1 - posterior) * used), (1, posterior * used)):
                model.fires[label] = (weight @ votes + 0.05) / (weight.sum() + 0.1)
            model.fires = np.clip(model.fires, 1e-5, 1 - 1e-5)
            if turn in (rounds // 3, 2 * rounds // 3):
                model.share = model._shares(votes, posterior)
            model.prior = float(np.clip(posterior[used].mean(), 1e-4, 1 - 1e-4))
            posterior = model.posterior(votes, known)
        return model

    @staticmethod
    def _shares(votes: np.ndarray, posterior: np.ndarray) -> np.ndarray:
        """One over the number of voters that say the same: sums of correlations among toxic texts."""
        weight = posterior / max(posterior.sum(), 1e-9)
        centred = votes - weight @ votes
        covariance = (centred * weight[:, None]).T @ centred
        spread = np.sqrt(np.maximum(np.diag(covariance), 1e-12))
        correlation = covariance / spread[:, None] / spread[None, :]
        correlation[correlation < 0.2] = 0
        np.fill_diagonal(correlation, 1)
        return 1 / correlation.sum(axis=1)

    def posterior(self, votes: np.ndarray, known: np.ndarray | None = None) -> np.ndarray:
        fired = np.log(self.fires[1] / self.fires[0]) * self.share
        silent = np.log((1 - self.fires[1]) / (1 - self.fires[0])) * self.share
        odds = math.log(self.prior / (1 - self.prior)) + votes @ (fired - silent) + silent.sum()
        if known is not None:
            told = math.log(self.accuracy / (1 - self.accuracy))
            odds = odds + np.where(known < 0, 0.0, np.where(known == 1, told, -told))
        return sigmoid(odds)


@dataclass
class Classifier:
    """Score of a text: a logistic function of the summed weights of its distinct words."""

    bias: float
    weights: dict[str, float]

    def word(self, word: str) -> float:
        return sum(self.weights.get(f, 0.0) for f in features_of(word))

    def score(self, text: str) -> float:
        return float(sigmoid(self.bias + sum(map(self.word, sorted(words_of(text))))))


def _sample(docs: DataFrame, labels: DataFrame, id_col, text_col, label_id_col, label_col, held_out, rows):
    """At most ``rows`` labelled texts that are not held out, chosen by a hash of their id."""
    known = labels.select(F.col(label_id_col).alias("doc_id"), F.col(label_col).alias("label"))
    known = known.filter(F.col("label").isNotNull() & (id_remainder(F.col("doc_id"), held_out[0]) != held_out[1]))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col(id_col).alias("doc_id"), whole(F.col(text_col)).alias("text"))
    return texts.join(F.broadcast(known), "doc_id")


def _features_frame(texts: DataFrame) -> DataFrame:
    """(doc_id, label, patterns, features, times) of each text: patterns that fire, and its word features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            own = batch.column("text").to_pylist()
            fired = [[k for k, p in enumerate(PATTERNS.values()) if p.search(t)] for t in own]
            counted = [text_features(t) for t in own]
            columns = [
                batch.column("doc_id"),
                batch.column("label").cast(pa.int32()),
                pa.array(fired, pa.list_(pa.int32())),
                pa.array([list(c) for c in counted], pa.list_(pa.string())),
                pa.array([list(c.values()) for c in counted], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "patterns", "features", "times"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, label int, patterns array<int>, features array<string>, times array<int>"
    return texts.mapInArrow(run, schema)


def _telling_features(sample: DataFrame, n_toxic: int, n_other: int, columns: int) -> list[tuple[str, float, int]]:
    """(feature, z, toxic texts that have it), strongest first: features whose share differs between the labels."""
    n = n_toxic + n_other
    counted = sample.select("label", F.explode("features").alias("f")).groupBy("f")
    counted = counted.agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n")).filter("n >= 3")
    p = F.col("n") / n
    z = (F.col("toxic") / n_toxic - (F.col("n") - F.col("toxic")) / n_other) / F.sqrt(p * (1 - p) * (1 / n_toxic + 1 / n_other))
    found = counted.filter(F.col("n") < n).withColumn("z", z).filter(F.abs("z") >= 4)
    rows = found.orderBy(F.abs("z").desc(), "f").limit(columns).collect()
    return [(r["f"], r["z"], r["toxic"]) for r in rows]


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id",
    label_col: str = "toxic", held_out: tuple[int, int] = (5, 0), sample_rows: int = 8000, voters: int = 400, columns: int = 4000,
) -> Classifier:
    """The classifier learned from at most ``sample_rows`` labelled rows outside the held-out fold.

    At most ``voters`` lexicon voters and ``columns`` word features are used. Without labels of
    both kinds the classifier gives every text the share of toxic labels, 0 if there are none.
    """
    chosen = _sample(docs, labels, id_col, text_col, label_id_col, label_col, held_out, sample_rows)
    sample = staged(_features_frame(chosen), "toxicity-sample")
    n, n_toxic = sample.agg(F.count(F.lit(1)), F.sum("label")).first()
    n_toxic = n_toxic or 0
    if not 0 < n_toxic < n:
        return Classifier(math.log((n_toxic + 0.01) / (n - n_toxic + 1)), {})
    telling = _telling_features(sample, n_toxic, n - n_toxic, columns)
    place = {f: i for i, (f, _, _) in enumerate(telling)}
    sent = sample.sparkSession.sparkContext.broadcast(place)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = sent.value
        for batch in batches:
            rows = zip(batch.column("features").to_pylist(), batch.column("times").to_pylist())
            held = [[(place[f], k) for f, k in zip(*row) if f in place] for row in rows]
            columns = [pa.array([[x[i] for x in h] for h in held], pa.list_(pa.int32())) for i in range(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), batch.column("patterns"), *columns],
                ["doc_id", "label", "patterns", "places", "times"],
            )

    kind = sample.schema["doc_id"].dataType.simpleString()
    small = sample.mapInArrow(pick, f"doc_id {kind}, label int, patterns array<int>, places array<int>, times array<int>")
    rows = small.toPandas().sort_values("doc_id", kind="stable")
    label = rows["label"].to_numpy(int).clip(0, 1)
    lexicon = [i for i, (_, z, toxic) in enumerate(telling) if z > 0 and toxic >= 3][:voters]
    voter_of = {i: v for v, i in enumerate(lexicon)}
    votes = np.zeros((len(label), len(lexicon) + len(PATTERNS) + 1))
    for i, (places, fired) in enumerate(zip(rows["places"], rows["patterns"])):
        votes[i, [voter_of[p] for p in places if p in voter_of]] = 1
        votes[i, len(lexicon) + np.asarray(fired, int)] = 1
    votes[:, -1] = votes[:, : len(lexicon)].sum(axis=1) == 0  # no entry of the lexicon
    posterior = LabelModel.fit(votes, label).posterior(votes, label)
    x = Sparse([dict(zip(p, map(float, t))) for p, t in zip(rows["places"], rows["times"])], len(place))
    weights, bias = _fit_words(x, posterior)
    return Classifier(bias, {f: float(weights[i]) for f, i in place.items() if weights[i]})


def _fit_words(x: Sparse, posterior: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of word features; small ones are left out, so that long texts do not add up many.

    The bias puts a score of 0.5 where the posterior labels are told apart best.
    """
    weights, _ = fit_logistic(x, posterior, penalty=0.3, rounds=600)
    weights[np.abs(weights) < 0.1] = 0
    margin = x @ weights
    order = np.argsort(-margin, kind="stable")
    sure = np.cumsum(posterior[order] >= 0.5)
    f1 = 2 * sure / (np.arange(1, len(order) + 1) + max(1, sure[-1]))
    f1[:-1][margin[order][:-1] == margin[order][1:]] = 0  # equal margins are on one side
    best = int(np.argmax(f1))
    below = margin[order][best + 1] if best + 1 < len(order) else margin[order][best] - 1
    return weights, -float(margin[order][best] + below) / 2


def score_texts(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text", held_out: tuple[int, int] = (5, 0)) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row from its whole text alone.

    Null and empty texts score the classifier's bias. Repeated rows score alike; a null id is not
    held out. Other columns are not read; an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, held = sent.value, {}
        for batch in slices(batches, "text"):
            scores = []
            for text in batch.column("text").to_pylist():
                total = model.bias
                for word in sorted(words_of(text)):
                    own = held.get(word)
                    if own is None:
                        if len(held) >= 400_000:
                            held.clear()
                        own = held[word] = model.word(word)
                    total += own
                scores.append(float(sigmoid(total)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])

    remainder = F.coalesce(id_remainder(F.col(id_col), held_out[0]) == held_out[1], F.lit(False))
    texts = docs.select(F.col(id_col).alias("doc_id"), remainder.alias("held_out"), whole(F.col(text_col)).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = texts.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
