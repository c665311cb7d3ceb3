"""Quality classifier: a factorisation machine on hashed words, structure statistics and metadata."""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import by_value, texts

by_value(sys.modules[__name__])

WORDS = 1 << 14     #: hash buckets of words
RANK = 8            #: length of the factors of pairwise interactions
TRAIN_ROWS = 12_000  #: at most so many labelled rows are learnt from, those with the smallest hash of their id
FOLDS = 5           #: rows whose crc32(doc_id) is divisible by this are held out
THRESHOLD = 0.3
PART = 256          #: documents whose features are held at once

NAMES = ["length", "words", "word_length", "upper", "digits", "symbols", "spaces", "lines", "line_length", "line_repeats",
         "word_repeats", "top_word", "sentences", "bare_words", "marked_words", "shouted_words", "longest_word", "letters",
         "pipes", "n_chars"]
SENTENCE = re.compile(r"[.!?](?:\s|$)")
MARKED = re.compile(r"[^\s\w.,;:!?'\"()-]+(?:\s|$)|!!+(?:\s|$)")


class Model(NamedTuple):
    """Bias, weights and factors over the word buckets followed by the statistics; mean and scale of the statistics."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray


def statistics(text: str, n_chars: float | None) -> list[float]:
    """Structure of a text, and its length as the table states it (the text's own where that is null)."""
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    n, w, k = max(1, len(text)), max(1, len(words)), max(1, len(lines))
    data = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    counts = Counter(words)
    ascii_letters = data[65:91].sum() + data[97:123].sum()
    symbols = data[33:48].sum() + data[58:65].sum() + data[91:97].sum() + data[123:127].sum()
    return [np.log1p(len(text)), np.log1p(len(words)), sum(map(len, words)) / w, data[65:91].sum() / max(1, ascii_letters),
            data[48:58].sum() / n, symbols / n, data[32] / n, np.log1p(len(lines)), np.log1p(n / k),
            1 - len(set(lines)) / k, 1 - len(counts) / w, max(counts.values(), default=0) / w,
            len(SENTENCE.findall(text)) / w, sum(map(str.isalpha, words)) / w, len(MARKED.findall(text)) / w,
            sum(map(str.isupper, words)) / w, np.log1p(max(map(len, words), default=0)),
            (ascii_letters + data[128:].sum() / 2) / n, data[124] / n,
            np.log1p(len(text) if n_chars is None or n_chars != n_chars or n_chars < 0 else n_chars)]


def features(text: str, n_chars: float | None) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Word buckets, their values (log counts, of length one together) and the statistics. Takes the whole text."""
    counts: Counter[int] = Counter()
    for w, k in Counter(text.lower().split()).items():
        counts[zlib.crc32(w.encode("utf-8", "replace")) % WORDS] += k
    at = np.fromiter(counts.keys(), np.int32, len(counts))
    values = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
    norm = float(np.sqrt((values ** 2).sum()))
    return at, values / norm if norm else values, statistics(text, n_chars)


def _sums(model_weights, factors, at, values, starts, stats):
    """Linear part and factor sums of rows in CSR form, by the sum-of-squares identity: O(features * rank)."""
    rows = len(starts)
    dense = slice(WORDS, None)
    picked = factors[at] * values[:, None]
    sums = np.zeros((rows, factors.shape[1]))
    squares = np.zeros(rows)
    linear = stats @ model_weights[dense]
    if len(at):
        ends = np.append(starts[1:], len(at))
        some = ends > starts
        sums[some] = np.add.reduceat(picked, starts[some], axis=0)
        squares[some] = np.add.reduceat((picked ** 2).sum(1), starts[some])
        linear[some] += np.add.reduceat(model_weights[at] * values, starts[some])
    sums += stats @ factors[dense]
    squares += (stats ** 2) @ (factors[dense] ** 2).sum(1)
    return linear, sums, squares


def scores(model: Model, rows: list[tuple[np.ndarray, np.ndarray, list[float]]]) -> np.ndarray:
    """Probability of label 1 of featured rows."""
    if not rows:
        return np.zeros(0)
    starts = np.concatenate(([0], np.cumsum([len(r[0]) for r in rows])[:-1])).astype(np.int64)
    stats = np.clip((np.array([r[2] for r in rows]) - model.mean) / model.scale, -5, 5)
    linear, sums, squares = _sums(model.weights, model.factors, np.concatenate([r[0] for r in rows]),
                                  np.concatenate([r[1] for r in rows]), starts, stats)
    odds = model.bias + linear + 0.5 * ((sums ** 2).sum(1) - squares)
    return 1 / (1 + np.exp(-np.clip(odds, -35, 35)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, list[float]]], labels: np.ndarray, epochs: int = 8, batch: int = 64,
        rate: float = 0.05, ridge: float = 1e-4, seed: int = 7) -> Model:
    """Logistic loss by Adagrad over small batches. No rows, or one class only, give a constant score."""
    rng = np.random.default_rng(seed)
    size = WORDS + len(NAMES)
    weights, factors = np.zeros(size), rng.normal(0, 0.02, (size, RANK))
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    bias = float(np.log(share / (1 - share)))
    if not len(labels) or labels.min() == labels.max():
        return Model(bias, weights, np.zeros_like(factors), np.zeros(len(NAMES)), np.ones(len(NAMES)))
    table = np.array([r[2] for r in rows])
    mean, scale = table.mean(0), np.maximum(table.std(0), 1e-6)
    table = np.clip((table - mean) / scale, -5, 5)
    grown_w, grown_v, grown_b = np.full(size, 1e-6), np.full(factors.shape, 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), batch):
            part = order[k:k + batch]
            at, values = np.concatenate([rows[i][0] for i in part]), np.concatenate([rows[i][1] for i in part])
            lengths = np.array([len(rows[i][0]) for i in part])
            starts, stats = np.concatenate(([0], np.cumsum(lengths)[:-1])), table[part]
            linear, sums, squares = _sums(weights, factors, at, values, starts, stats)
            odds = np.clip(bias + linear + 0.5 * ((sums ** 2).sum(1) - squares), -35, 35)
            error = (1 / (1 + np.exp(-odds)) - labels[part]) / len(part)
            of = np.repeat(np.arange(len(part)), lengths)
            used, place = np.unique(at, return_inverse=True)
            pull = error[of] * values
            grad_w = np.bincount(place, pull, len(used))
            # d/dv of half the sum of squares: x * (sum - v x)
            each = pull[:, None] * sums[of] - (pull * values)[:, None] * factors[at]
            grad_v = np.stack([np.bincount(place, each[:, f], len(used)) for f in range(RANK)], 1)
            dense_w, dense = stats.T @ error, slice(WORDS, None)
            dense_v = stats.T @ (error[:, None] * sums) - ((stats ** 2).T @ error)[:, None] * factors[dense]
            for where, gw, gv in ((used, grad_w, grad_v), (np.arange(WORDS, size), dense_w, dense_v)):
                gw, gv = gw + ridge * weights[where], gv + ridge * factors[where]
                grown_w[where] += gw ** 2
                grown_v[where] += gv ** 2
                weights[where] -= rate * gw / np.sqrt(grown_w[where])
                factors[where] -= rate * gv / np.sqrt(grown_v[where])
            grown_b += error.sum() ** 2
            bias -= rate * error.sum() / np.sqrt(grown_b)
    return Model(bias, weights, factors, mean, scale)


def _rows(docs: DataFrame) -> DataFrame:
    stated = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), stated.alias("n_chars"))


def held_out(col: Column) -> Column:
    """Whether a row is never learnt from: its id's crc32 is divisible by the number of folds. A null id counts as 0."""
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % FOLDS, F.lit(0)) == 0


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``rows`` labels of documents that are not held out. That bounds what the driver holds.

    Rows with a null id or quality are passed over. Of repeated labels of an id each counts, with one document: of
    documents that repeat an id, the one whose text has the smallest hash, and of those the smallest n_chars.
    """
    wanted = (labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
              .filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))))
    wanted = wanted.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows)

    def run(batches):
        for b in batches:
            found = [features(t, c) for t, c in zip(b.column("text").to_pylist(), b.column("n_chars").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("quality"), pa.array([f[0].tobytes() for f in found], pa.binary()),
                 pa.array([f[1].astype(np.float32).tobytes() for f in found], pa.binary()),
                 pa.array([f[2] for f in found], pa.list_(pa.float64()))], ["quality", "at", "value", "stats"])

    # at most `rows` ids are sent; each task keeps one document of each, so that a repeated id moves few texts and gives one
    ids = F.broadcast(wanted.select("doc_id").distinct())
    order = F.struct(F.xxhash64("text"), "text", "n_chars")
    one = _rows(docs).join(ids, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(order).alias("row"))
    learnt = one.join(F.broadcast(wanted), "doc_id").select("quality", "row.text", "row.n_chars")
    got = learnt.mapInArrow(run, "quality int, at binary, value binary, stats array<double>").toPandas()
    got = got.sort_values(["quality", "at", "value"], ignore_index=True)  # the same model on every run
    return fit([(np.frombuffer(a, np.int32), np.frombuffer(v, np.float32), list(s))
                for a, v, s in zip(got["at"], got["value"], got["stats"])], got["quality"].to_numpy(float))


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, in one pass without a shuffle.

    A null text counts as the empty one, which has a score like any other; a null n_chars takes the text's length;
    a null doc_id stays null and counts as held out. Repeated rows each give a row; other columns are left out. An
    empty table gives an empty result. Labels, lang, source and doc_id are not read by the score.
    """
    rows = _rows(docs)

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, PART):
                b = batch.slice(k, PART)
                found = [features(t, c) for t, c in zip(b.column("text").to_pylist(), b.column("n_chars").to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(scores(model, found))],
                                                 ["doc_id", "score"])

    scored = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``train`` on the labelled part and ``classify`` every document."""
    return classify(docs, train(docs, labels, rows), threshold)


def keep_good(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns. One pass; rows are tested in place."""
    model = train(docs, labels, rows)

    @F.pandas_udf("double")
    def score(text: pd.Series, n_chars: pd.Series) -> pd.Series:
        parts = [scores(model, [features(t, c) for t, c in zip(text[k:k + PART], n_chars[k:k + PART])])
                 for k in range(0, len(text), PART)]
        return pd.Series(np.concatenate(parts) if parts else [], dtype=float)

    stated = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.filter(score(F.coalesce("text", F.lit("")), stated) >= threshold)
