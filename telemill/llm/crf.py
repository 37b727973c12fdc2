"""Document quality from a linear-chain conditional random field that labels every line good or bad."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import BLANK, joined, map_slices, mix, word_hashes

#: Bounds of the fit: labelled documents that are looked at, and characters of one that is.
SAMPLE_DOCS, SAMPLE_CHARS = 2000, 50_000

#: Passes over the sample, step and weight decay of the fit.
EPOCHS, RATE, DECAY = 120, 0.1, 1e-3

_LOWER, _UPPER, _DIGIT, _STOP, _MARK, _BAR, _HIGH = range(7)
_CLASSES = np.full(256, 7, np.int8)
_CLASSES[97:123], _CLASSES[65:91], _CLASSES[48:58], _CLASSES[128:] = _LOWER, _UPPER, _DIGIT, _HIGH
_CLASSES[list(b".,;:?'\"()-")] = _STOP
_CLASSES[list(b"!#$%&*+/<=>@[\\]^_`{}~")] = _MARK
_CLASSES[124] = _BAR
_CLASSES[BLANK] = 8

OWN = 16


def line_features(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines that are not blank, their lengths in bytes, and the n + 1 places where texts start.

    Each line has its own features and those of the lines before and after it in its text (0 at its ends).
    """
    n = len(data)
    inner = np.unique(np.concatenate([places, np.flatnonzero(data == 10) + 1]))
    starts, ends = inner[:-1], inner[1:]
    if not n:
        return np.zeros((0, 3 * OWN)), np.zeros(0, np.int64), np.zeros(len(places), np.int64)
    words, counts = word_hashes(data, inner)
    some = counts > 0
    texts = (np.searchsorted(places, starts, "right") - 1)[some]

    byte_line = np.repeat(np.arange(len(starts)), ends - starts)
    classes = np.bincount(byte_line * 9 + _CLASSES[data], minlength=9 * len(starts)).reshape(-1, 9)[some]
    lower, upper, digit, stop, mark, bar, high, _, blank = classes.T
    size = np.maximum((ends - starts)[some] - blank, 1).astype(float)
    letters = np.maximum(lower + upper + high, 1)
    line = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((words, line))
    new = np.ones(len(words), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (line[order][1:] != line[order][:-1])
    distinct = np.bincount(line[order][new], minlength=len(counts))[some]
    count = counts[some]
    content = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(mix(words), out=content[1:])
    stops = np.cumsum(counts)
    digest = (content[stops] - content[stops - counts])[some]
    repeated = np.zeros(len(count))
    by = np.lexsort((digest, texts))
    same = (digest[by][1:] == digest[by][:-1]) & (texts[by][1:] == texts[by][:-1])
    repeated[by[1:][same]] = repeated[by[:-1][same]] = 1
    last = np.maximum(ends[some] - 1 - (data[ends[some] - 1] == 10), starts[some])
    own = np.stack(
        [
            np.log1p(size) / 8,
            np.log1p(count) / 6,
            np.minimum(size / count, 40) / 10,
            letters / size,
            digit / size,
            upper / letters,
            stop / size,
            mark / size,
            bar / size,
            np.minimum(mark / count, 2),
            np.minimum(bar / count, 2),
            np.minimum(stop / count, 2),
            distinct / count,
            repeated,
            np.isin(data[last], list(b".!?")).astype(float),
            (upper > 0.8 * letters).astype(float),
        ],
        axis=1,
    )
    around = np.zeros((len(own), 2 * OWN))
    follows = texts[1:] == texts[:-1]
    around[1:, :OWN][follows] = own[:-1][follows]
    around[:-1, OWN:][follows] = own[1:][follows]
    lengths = (ends - starts)[some]
    return np.concatenate([own, around], axis=1), lengths, np.searchsorted(texts, np.arange(len(places)))


class Chain:
    """Weights of the lines' features, of the labels of neighbours and of the first label; label 1 is good."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, prior: float):
        self.mean, self.scale, self.prior = mean, scale, prior
        self.weights, self.bias = np.zeros(len(mean)), 0.0
        self.move, self.first = np.zeros((2, 2)), np.zeros(2)

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return self.standard(features) @ self.weights + self.bias

    def standard(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.scale, -6, 6)

    def marginals(self, emissions: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every line the log-odds to be good, given the lines before it, those after it, and both as a probability.

        Forward and backward over all texts at once, line by line; texts are ordered by their number of lines. A message
        is the difference of the logarithms for good and bad.
        """
        counts = np.diff(places)
        order = np.argsort(-counts, kind="stable")
        begin, counts = places[:-1][order], counts[order]
        forward, backward = np.zeros((2, len(emissions)))
        longest = int(counts.max(initial=0))
        live = [int(np.searchsorted(-counts, -t)) for t in range(longest)]  # texts with more than t lines
        (bb, bg), (gb, gg) = self.move
        for t in range(longest):
            at = begin[: live[t]] + t
            if t:
                before = forward[at - 1]
                step = np.logaddexp(bg, before + gg) - np.logaddexp(bb, before + gb)
            else:
                step = self.first[1] - self.first[0]
            forward[at] = step + emissions[at]
        for t in range(longest - 2, -1, -1):
            at = begin[: live[t + 1]] + t
            after = emissions[at + 1] + backward[at + 1]
            backward[at] = np.logaddexp(gb, gg + after) - np.logaddexp(bb, bg + after)
        return forward, backward, 1 / (1 + np.exp(-np.clip(forward + backward, -500, 500)))

    def pairs(self, emissions: np.ndarray, forward: np.ndarray, backward: np.ndarray, inner: np.ndarray) -> np.ndarray:
        """Expected pairs of labels of neighbours, over the lines `inner` that have one before them."""
        at = np.flatnonzero(inner)
        before, after = forward[at - 1], emissions[at] + backward[at]
        logs = np.stack([np.zeros(len(at)), after, before, before + after]) + self.move.reshape(4, 1)
        p = np.exp(logs - logs.max(axis=0))
        return (p / p.sum(axis=0)).sum(axis=1)

    def scores(self, features: np.ndarray, lengths: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Length-weighted mean of the lines' marginals in each text; the prior for texts without lines."""
        *_, good = self.marginals(self.emissions(features), places)
        sums = np.concatenate([[0.0], np.cumsum(good * lengths)])
        sizes = np.concatenate([[0], np.cumsum(lengths)])
        size = sizes[places[1:]] - sizes[places[:-1]]
        mean = (sums[places[1:]] - sums[places[:-1]]) / np.maximum(size, 1)
        return np.where(size > 0, np.clip(mean, 0, 1), self.prior)


def fit(features: np.ndarray, places: np.ndarray, labels: np.ndarray) -> Chain:
    """The chain that makes the texts' labels, given to each of their lines, likeliest; Adam over the whole sample."""
    counts = np.diff(places)
    prior = float(labels.mean()) if len(labels) else 0.5
    if not len(features):
        return Chain(np.zeros(3 * OWN), np.ones(3 * OWN), prior)
    chain = Chain(features.mean(axis=0), np.maximum(features.std(axis=0), 1e-3), prior)
    x, y = chain.standard(features), np.repeat(labels, counts)
    heads = places[:-1][counts > 0]
    inner = np.ones(len(x), bool)
    inner[heads] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:-1][inner[1:]], y[1:][inner[1:]]), 1)
    begins = np.bincount(y[heads], minlength=2)
    theta = np.zeros(x.shape[1] + 7)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, EPOCHS + 1):
        chain.weights, chain.bias = theta[:-7], theta[-7]
        chain.move, chain.first = theta[-6:-2].reshape(2, 2), theta[-2:]
        emissions = x @ chain.weights + chain.bias
        forward, backward, good = chain.marginals(emissions, places)
        missing = y - good
        first = good[heads].sum()
        gradient = np.concatenate(
            [
                x.T @ missing,
                [missing.sum()],
                seen.ravel() - chain.pairs(emissions, forward, backward, inner),
                begins - [len(heads) - first, first],
            ]
        ) / len(x) - DECAY * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta = theta + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return chain


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCS) -> Chain:
    """Fit to at most `sample` of `labels` (`doc_id`, `quality` 0 or 1), those whose ids hash lowest.

    Repeated labels of a document are averaged; null ones teach nothing, nor do null texts and those of more than
    SAMPLE_CHARS characters. One task holds the sample's features; the driver gets the weights. Without any labelled
    text the prior, one half, is all that is learned.
    """
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
    marked = marked.agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.where(F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS)).select("doc_id", "text")
    # rows that repeat an id count once, so that the bound holds
    texts = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id")
    texts = texts.agg(F.min("text").alias("text"), F.min("label").alias("label"))

    def train(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("doc_id")
        features, _, places = line_features(*joined(pa.array(group["text"], pa.string())))
        c = fit(features, places, group["label"].to_numpy())
        flat = [c.mean, c.scale, c.weights, c.move.ravel(), c.first, [c.bias, c.prior]]
        return pd.DataFrame({"weights": [np.concatenate(flat)]})

    made = texts.withColumn("fit", F.lit(0)).groupBy("fit").applyInPandas(train, "weights array<double>").collect()
    if not made:
        return Chain(np.zeros(3 * OWN), np.ones(3 * OWN), 0.5)
    mean, scale, weights, move, first, rest = np.split(np.array(made[0]["weights"]), np.cumsum([3 * OWN] * 3 + [4, 2]))
    chain = Chain(mean, scale, float(rest[1]))
    chain.weights, chain.move, chain.first, chain.bias = weights, move.reshape(2, 2), first, float(rest[0])
    return chain


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """`docs` with a `score` from 0 to 1 for `text`, higher for better; only the text is looked at.

    Null, empty and blank texts have the sample's share of good documents. Rows are independent; other columns pass
    through, but for an earlier `score`, which is replaced. An empty frame gives an empty frame.
    """
    docs = docs.drop("score")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "score double"])

    def run(piece: pa.RecordBatch) -> dict:
        made = chain.scores(*line_features(*joined(piece.column("text"))))
        return dict(zip(piece.schema.names, piece.columns)) | {"score": made}

    return map_slices(docs, "text", schema, run)
