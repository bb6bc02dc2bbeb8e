"""Quality by co-training: one classifier reads the text's content, the other the page's metadata.

Both learn from the same labelled rows. In each round every view labels the unlabelled rows of
which it is most sure and hands them to the other view, in the proportion of the known labels.
Afterwards each view is calibrated on labelled rows that neither has seen, a logistic model weighs
the two calibrated views, and all documents are scored.

Content: shares of symbols, capitals, digits, marks, function words, repeated and different words,
word lengths. Metadata: source, language, the stated size, and the layout of lines.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_remainder, slices, staged, whole
from tidemark.llm.linear import fit_logistic, sigmoid
from tidemark.llm.rules import STOP_WORDS, SYMBOLS

_STOP = frozenset(STOP_WORDS)
_SYMBOL_CODES = str.maketrans("", "", SYMBOLS)
CONTENT = ("words", "symbols", "capitals", "digits", "marks", "stop_words", "distinct", "adjacent", "top_word", "word_length", "long_words")
LAYOUT = ("lines", "line_length", "short_lines", "repeated_lines", "longest_line")


def content_numbers(text: str) -> list[float]:
    """Numbers of the content view; all 0 for a text without words."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(CONTENT)
    size = sum(map(len, words))
    counted = Counter(words)
    upper = sum(map(str.isupper, words))
    return [
        math.log1p(n),
        (len(text) - len(text.translate(_SYMBOL_CODES))) / n,
        upper / n,
        sum(w[0].isdigit() for w in words) / n,
        (text.count("!") + text.count("?") + text.count("...")) / n,
        sum(c for w, c in counted.items() if w.lower() in _STOP) / n,
        len(counted) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        max(counted.values()) / n,
        size / n,
        sum(len(w) > 20 for w in words) / n,
    ]


def layout_numbers(text: str) -> list[float]:
    lines = [x for x in text.split("\n") if x.strip()]
    n = len(lines)
    if not n:
        return [0.0] * len(LAYOUT)
    lengths = list(map(len, lines))
    return [math.log1p(n), math.log1p(sum(lengths) / n), sum(x < 30 for x in lengths) / n, 1 - len(set(lines)) / n, math.log1p(max(lengths))]


@dataclass
class View:
    """A logistic model over bins of numbers and over categories."""

    edges: list[np.ndarray] = field(default_factory=list)
    categories: list[dict[str, int]] = field(default_factory=list)
    weights: np.ndarray | None = None
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    @classmethod
    def over(cls, numbers: np.ndarray, names: list[list[str]], bins: int = 10, most: int = 200) -> View:
        """Bins at quantiles of the rows; the most common values of each category, others being one."""
        edges = [np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0) for x in numbers.T]
        common = [{v: i for i, (v, _) in enumerate(sorted(Counter(x).most_common(most)))} for x in names]
        return cls(edges, common)

    def matrix(self, numbers: np.ndarray, names: list[list[str]]) -> np.ndarray:
        parts = []
        for x, edges in zip(numbers.T, self.edges):
            parts.append(np.eye(len(edges) + 1)[np.searchsorted(edges, x, side="right")])
        for x, known in zip(names, self.categories):
            parts.append(np.eye(len(known) + 1)[[known.get(v, len(known)) for v in x]])
        return np.hstack(parts) if parts else np.zeros((len(numbers), 0))

    def fit(self, x: np.ndarray, target: np.ndarray) -> None:
        self.weights, self.bias = fit_logistic(x, target, penalty=1.0, rounds=250)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias

    def calibrate(self, x: np.ndarray, target: np.ndarray) -> None:
        """A slope and a shift of the margin, for labels this view has not learned from."""
        slope, self.shift = fit_logistic(self.margin(x)[:, None], target, penalty=0.1, rounds=400)
        self.slope = float(max(slope[0], 0.0))

    def calibrated(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.margin(x) + self.shift


@dataclass
class Model:
    content: View
    page: View
    mix: np.ndarray
    bias: float

    def score(self, content: np.ndarray, page: np.ndarray, names: list[list[str]]) -> np.ndarray:
        both = [self.content.calibrated(self.content.matrix(content, [])), self.page.calibrated(self.page.matrix(page, names))]
        return sigmoid(np.column_stack(both) @ self.mix + self.bias)


def exchange(views: tuple[View, View], x: tuple[np.ndarray, np.ndarray], label: np.ndarray, rounds: int, share: float) -> int:
    """Trains both views; rows with label -1 get pseudo-labels, each from the other view. Returns how many.

    In each round a view labels at most ``share`` of the rows that have no label yet, the surest
    first, positive and negative in the proportion of the known labels, none below a probability
    of 0.9.
    """
    known = label >= 0
    rate = label[known].mean()
    told = [np.where(known, label, -1).astype(float) for _ in views]
    for view, own, rows in zip(views, told, x):
        view.fit(rows[known], own[known])
    for _ in range(rounds):
        new = []
        for view, rows in zip(views, x):
            p = sigmoid(view.margin(rows))
            given = []
            for value, part, sure in ((1.0, rate, p), (0.0, 1 - rate, 1 - p)):
                free = np.flatnonzero(~known & (sure >= 0.9))
                take = math.ceil(share * part * (~known).sum())
                given.append((value, free[np.argsort(-sure[free], kind="stable")[:take]]))
            new.append(given)
        for own, given in zip(told, reversed(new)):
            for value, rows in given:
                rows = rows[own[rows] < 0]
                own[rows] = value
        for view, own, rows in zip(views, told, x):
            view.fit(rows[own >= 0], own[own >= 0])
    return int(sum((own[~known] >= 0).sum() for own in told))


def _names(batch, columns) -> list[list[str]]:
    return [["" if v is None else str(v) for v in batch.column(c).to_pylist()] for c in columns]


def _inputs(docs: DataFrame, id_col: str, text_col: str, names: list[str], size_col: str | None) -> DataFrame:
    own = [F.col(c).cast("string").alias(f"name_{i}") for i, c in enumerate(names)]
    stated = F.col(size_col).cast("double") if size_col else F.lit(0.0)
    return docs.select(F.col(id_col).alias("doc_id"), whole(F.col(text_col)).alias("text"), *own, stated.alias("stated"))


def _page_numbers(texts: list[str], stated: list[float | None]) -> np.ndarray:
    return np.array([[math.log1p(max(s or 0.0, 0.0)), *layout_numbers(t)] for t, s in zip(texts, stated)]).reshape(len(texts), -1)


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", names: tuple[str, ...] = ("source", "lang"),
    size_col: str | None = "n_chars", label_id_col: str = "doc_id", label_col: str = "quality", held_out: tuple[int, int] = (5, 0),
    labelled_rows: int = 6000, pool_rows: int = 12_000, rounds: int = 4, share: float = 0.05,
) -> Model | float:
    """Learns from at most ``labelled_rows`` labelled and ``pool_rows`` other rows, chosen by a hash of the id.

    Rows of the held-out fold are in neither. Without labels of both kinds the result is the share
    of the label 1, 1 if there are no labels: every document scores that.
    """
    known = labels.select(F.col(label_id_col).alias("doc_id"), F.col(label_col).alias("label")).filter("label is not null")
    known = known.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    inputs = _inputs(docs, id_col, text_col, list(names), size_col)
    fold = F.coalesce(id_remainder(F.col("doc_id"), held_out[0]) != held_out[1], F.lit(False))
    order = F.xxhash64("doc_id")
    ids = docs.select(F.col(id_col).alias("doc_id")).filter(fold).distinct()
    first = ids.join(known, "doc_id").orderBy(order, "doc_id").limit(labelled_rows)
    others = ids.join(known, "doc_id", "left_anti").orderBy(order, "doc_id").limit(pool_rows)
    chosen = staged(first.unionByName(others, allowMissingColumns=True), "quality-sample")
    n_names = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            content = [content_numbers(t) for t in texts]
            page = _page_numbers(texts, batch.column("stated").to_pylist()).tolist()
            own = list(map(list, zip(*_names(batch, [f"name_{i}" for i in range(n_names)])))) or [[] for _ in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(content, pa.list_(pa.float64())),
                 pa.array(page, pa.list_(pa.float64())), pa.array(own, pa.list_(pa.string()))],
                ["doc_id", "label", "content", "page", "names"],
            )

    kind = inputs.schema["doc_id"].dataType.simpleString()
    numbers = inputs.join(F.broadcast(chosen), "doc_id").mapInArrow(
        run, f"doc_id {kind}, label int, content array<double>, page array<double>, names array<string>"
    )
    rows = numbers.toPandas().sort_values(["doc_id"], kind="stable").drop_duplicates("doc_id")
    return _learn(rows, n_names, rounds, share)


def _learn(rows: pd.DataFrame, n_names: int, rounds: int, share: float) -> Model | float:
    label = rows["label"].fillna(-1).to_numpy(int).clip(-1, 1)
    if len(set(label[label >= 0])) < 2:
        return float(label[label >= 0].mean()) if (label >= 0).any() else 1.0
    content = np.array(rows["content"].tolist())
    page = np.array(rows["page"].tolist())
    names = [[r[i] for r in rows["names"]] for i in range(n_names)]
    views = (View.over(content, []), View.over(page, names))
    x = (views[0].matrix(content, []), views[1].matrix(page, names))
    # every fourth labelled row of a kind calibrates and is not learned from
    aside = np.zeros(len(label), bool)
    for value in (0, 1):
        aside[np.flatnonzero(label == value)[3::4]] = True
    seen = ~aside
    exchange(views, (x[0][seen], x[1][seen]), label[seen], rounds, share)
    if len(set(label[aside])) < 2:
        aside = label >= 0
    for view, own in zip(views, x):
        view.calibrate(own[aside], label[aside])
    both = np.column_stack([v.calibrated(own)[aside] for v, own in zip(views, x)])
    mix, bias = fit_logistic(both, label[aside], penalty=0.1, rounds=600)
    return Model(*views, np.maximum(mix, 0.0), bias)


def score_texts(
    docs: DataFrame, model: Model | float, id_col: str = "doc_id", text_col: str = "text", names: tuple[str, ...] = ("source", "lang"),
    size_col: str | None = "n_chars", held_out: tuple[int, int] = (5, 0),
) -> DataFrame:
    """(doc_id, held_out, score, kept) of every row: the probability of the label 1, and whether it is 0.5 or more.

    Null texts count as empty, null names are a name of their own, a null size is 0, a null id is
    not held out. Repeated rows score alike. Texts are read whole; other columns are not read; an
    empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    fields = [f"name_{i}" for i in range(len(names))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            if isinstance(sent.value, float):
                scores = np.full(len(texts), sent.value)
            else:
                content = np.array([content_numbers(t) for t in texts]).reshape(len(texts), -1)
                page = _page_numbers(texts, batch.column("stated").to_pylist())
                scores = sent.value.score(content, page, _names(batch, fields))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])

    inputs = _inputs(docs, id_col, text_col, list(names), size_col)
    inputs = inputs.withColumn("held_out", F.coalesce(id_remainder(F.col("doc_id"), held_out[0]) == held_out[1], F.lit(False)))
    kind = inputs.schema["doc_id"].dataType.simpleString()
    scored = inputs.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("kept", F.col("score") >= 0.5)
