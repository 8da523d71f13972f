"""Quality scores: random-indexing word vectors, pooled per text, and a two-layer network.

Words are runs of letters, of digits or of marks, hashed to ``WORDS`` rows. Each row has a
sparse random index vector; a row's word vector is the sum of the index vectors of the words
around all its occurrences in the whole corpus, so one pass that adds whole numbers makes
them, and partial sums have a fixed size. A text is its words' vectors pooled. The network
is trained with numpy on a bounded sample of labelled texts; a temperature, fitted on texts
that it was not trained on, makes its outputs probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.frames import annotated, tidy
from tickloom.llm.text import SLICE_BYTES, Words, mix, raw_texts, slices

WORDS = 1 << 14
SIZE = 32
#: Words to either side that count as around a word.
REACH = 2
#: The network is trained on at most about so many labelled texts, taken by a hash of their ids.
FIT_ROWS = 20_000
HIDDEN = 48
EPOCHS = 40
#: A score from here on predicts label 1.
THRESHOLD = 0.3
_U64 = np.uint64
_PARTS = 16  # of the matrix of word vectors, for adding them up
_CHUNK = 1 << 13  # words of a text whose vectors are gathered at once

_codes = np.arange(256)
_KIND = np.full(256, 3, np.uint8)
_KIND[(_codes <= 0x20) | (_codes == 0x7F)] = 0
_KIND[((_codes | 0x20) >= 0x61) & ((_codes | 0x20) <= 0x7A) & (_codes < 0x80) | (_codes >= 0x80)] = 1
_KIND[(_codes >= 0x30) & (_codes <= 0x39)] = 2


def tokens(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of all words, and where each text's begin."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    kind = _KIND[data]
    edges = np.concatenate([[0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(data)]])
    worded = kind[edges[:-1]] > 0
    starts, ends = edges[:-1][worded], edges[1:][worded]
    offsets = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
    first = np.searchsorted(starts, offsets)
    hashes = Words(data, starts, ends, first).hashes()
    return (hashes >> _U64(64 - 14)).astype(np.int64), first


def _draws() -> list[tuple[np.ndarray, int]]:
    """The places of each row's ones and minus ones, with their signs."""
    rows = np.arange(WORDS, dtype=_U64)
    return [
        ((mix(rows * _U64(4) + _U64(draw + 1)) % _U64(SIZE)).astype(np.int64), 1 if draw % 2 == 0 else -1)
        for draw in range(4)
    ]


def index_vectors() -> np.ndarray:
    """For each row a vector of zeros but for two ones and two minus ones, at random places."""
    out = np.zeros((WORDS, SIZE), np.int64)
    for place, sign in _draws():
        out[np.arange(WORDS), place] += sign
    return out


def _contexts(rows: np.ndarray, first: np.ndarray, draws: list[tuple[np.ndarray, int]]) -> np.ndarray:
    """Per row the sum of the index vectors of the words around its occurrences.

    An index vector has four entries, so all that is needed is to count, for each of them, how often
    a row meets its place.
    """
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = np.zeros(WORDS * SIZE, np.int64)
    for step in range(1, REACH + 1):
        near = np.flatnonzero(owner[: len(rows) - step] == owner[step:])
        one, other = rows[near], rows[near + step]
        for place, sign in draws:
            for word, around in ((one, other), (other, one)):
                out += sign * np.bincount(word * SIZE + place[around], minlength=WORDS * SIZE)
    return out.reshape(WORDS, SIZE)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The word vectors of the whole corpus, of unit length around their mean."""
    draws = _draws()
    height = WORDS // _PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((WORDS, SIZE), np.int64)
        for batch in batches:
            texts = raw_texts(batch.column(0))
            for low, high in slices(texts, 4 * SLICE_BYTES):
                total += _contexts(*tokens(texts[low:high]), draws)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(_PARTS), pa.int32()),
                pa.array([total[p * height: (p + 1) * height].tobytes() for p in range(_PARTS)], pa.binary()),
            ],
            names=["part", "sums"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                totals[part] = totals.get(part, 0) + np.frombuffer(sums, np.int64)
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())],
                names=["part", "sums"],
            )

    schema = "part int, sums binary"
    sums = docs.select(F.col("text").cast("string")).mapInArrow(tidy(count), schema)
    # Added in two steps, each over a stream: no task holds more than one matrix.
    spread = sums.withColumn("salt", F.spark_partition_id() % 32).repartition("part", "salt").select("part", "sums")
    rows = spread.mapInArrow(add, schema).repartition("part").mapInArrow(add, schema).collect()
    out = np.zeros((WORDS, SIZE))
    for row in rows:
        out[row.part * height: (row.part + 1) * height] += np.frombuffer(row.sums, np.int64).reshape(height, SIZE)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    out = np.divide(out, norm, out=np.zeros_like(out), where=norm > 0)
    used = norm[:, 0] > 0
    if used.any():
        out[used] -= out[used].mean(axis=0)
    # A word's own index vector tells it from others that stand among the same words.
    return (out + index_vectors() / 4).astype(np.float32)


def pooled(texts: Sequence[bytes], vectors: np.ndarray) -> np.ndarray:
    """Features of texts: the mean of their words' vectors, of different words' vectors, of squares,
    of products of neighbours, and sizes. A text without words has zeros."""
    rows, first = tokens(texts)
    out = np.zeros((len(texts), 4 * SIZE + 2), np.float32)
    for text in np.flatnonzero(np.diff(first)).tolist():
        own = rows[first[text]: first[text + 1]]
        sums = np.zeros((3, SIZE))
        for low in range(0, len(own), _CHUNK):
            # One word more than the chunk, for the product with the next neighbour.
            found = vectors[own[low: low + _CHUNK + 1]]
            part = found[:_CHUNK]
            sums[0] += part.sum(axis=0)
            sums[1] += np.einsum("ij,ij->j", part, part)
            sums[2] += np.einsum("ij,ij->j", found[:-1], found[1:])
        kinds = np.unique(own)
        out[text, : 3 * SIZE] = (sums / len(own)).ravel()
        out[text, 3 * SIZE: 4 * SIZE] = vectors[kinds].sum(axis=0) / len(kinds)
        out[text, -2:] = np.log1p([len(own), len(kinds)])
    return out


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        hidden = np.tanh((features - self.mean) / self.scale @ self.first + self.first_bias)
        return hidden @ self.second + self.second_bias

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -50, 50)))


def _loss(logits: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - labels * logits))


def train(features: np.ndarray, labels: np.ndarray, seed: int = 0) -> Network:
    """Adam on the logistic loss over four fifths of the rows; the temperature from the rest."""
    random = np.random.default_rng(seed)
    order = random.permutation(len(labels))
    held, kept = order[: len(order) // 5], order[len(order) // 5:]
    mean, scale = features[kept].mean(axis=0), features[kept].std(axis=0) + 1e-6
    net = Network(
        mean, scale, random.normal(0, 1 / np.sqrt(features.shape[1]), (features.shape[1], HIDDEN)),
        np.zeros(HIDDEN), random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), 0.0, 1.0,
    )
    values = [net.first, net.first_bias, net.second, np.zeros(1)]
    moments = [[np.zeros_like(v), np.zeros_like(v)] for v in values]
    x, y, step = (features - mean) / scale, labels.astype(float), 0
    for epoch in range(EPOCHS):
        rate = 0.003 * (1 - epoch / EPOCHS)
        for rows in np.array_split(random.permutation(kept), max(1, len(kept) // 128)):
            if not len(rows):
                continue
            step += 1
            hidden = np.tanh(x[rows] @ values[0] + values[1])
            logits = hidden @ values[2] + values[3][0]
            error = (1 / (1 + np.exp(-np.clip(logits, -50, 50))) - y[rows]) / len(rows)
            back = np.outer(error, values[2]) * (1 - hidden * hidden)
            slopes = [
                x[rows].T @ back + 1e-4 * values[0], back.sum(axis=0), hidden.T @ error + 1e-4 * values[2],
                np.array([error.sum()]),
            ]
            for value, slope, moment in zip(values, slopes, moments, strict=True):
                moment[0] = 0.9 * moment[0] + 0.1 * slope
                moment[1] = 0.999 * moment[1] + 0.001 * slope * slope
                value -= rate * (moment[0] / (1 - 0.9**step)) / (np.sqrt(moment[1] / (1 - 0.999**step)) + 1e-8)
    net.first, net.first_bias, net.second, net.second_bias = values[0], values[1], values[2], float(values[3][0])
    if len(held):
        logits = net.logits(features[held])
        choices = np.exp(np.linspace(np.log(0.25), np.log(8), 81))
        net.temperature = float(min(choices, key=lambda t: _loss(logits / t, y[held])))
    return net


def held_out() -> Column:
    """Rows whose labels take no part in learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def _featured(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    def compute(texts: Sequence[bytes]) -> list[pa.Array]:
        return [pa.array([row.tobytes() for row in pooled(texts, vectors)], pa.binary())]

    return annotated(docs, "features binary", compute)


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, fit_rows: int = FIT_ROWS) -> Network | None:
    """A network from the texts of docs and labels (doc_id, quality), None without both labels.

    Labels that are neither 0 nor 1 and held-out rows take no part. Texts with several
    labels are learned with each.
    """
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out()).select(
        F.col("doc_id").cast("long").alias("label_id"), F.col("quality").cast("int")
    )
    total, steps = known.count(), 1 << 30
    if not total:
        return None
    sample = known.where(
        F.pmod(F.xxhash64("label_id", F.lit("quality")), F.lit(steps)) < min(steps, fit_rows * steps // total)
    )
    # The sample's size is bound by fit_rows, so it may go to every task.
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))
    rows = _featured(texts, vectors).select("row.doc_id", "row.quality", "features").collect()
    rows.sort(key=lambda r: (r.doc_id, r.quality, bytes(r.features)))
    marks = np.array([r.quality for r in rows])
    if len(set(marks.tolist())) < 2:
        return None
    return train(np.array([np.frombuffer(r.features, np.float32) for r in rows], float), marks)


def scored(docs: DataFrame, network: Network | None, vectors: np.ndarray) -> DataFrame:
    """Each row of docs as ``row`` with score, the probability of label 1, and predicted.

    Null and empty texts are scored as texts without words; without a network every score is 0.5.
    """

    def compute(texts: Sequence[bytes]) -> list[pa.Array]:
        found = pooled(texts, vectors).astype(float)
        score = network.probabilities(found) if network else np.full(len(texts), 0.5)
        return [pa.array(score, pa.float64()), pa.array((score >= THRESHOLD).astype(np.int32), pa.int32())]

    return annotated(docs, "score double, predicted int", compute)
