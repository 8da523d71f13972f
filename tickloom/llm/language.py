"""Language identification by the nearest centroid of TF-IDF n-gram vectors.

A text is the vector of its byte pairs and triples, hashed to ``DIMENSIONS``, with
logarithmic counts, inverse document frequencies and unit length; case, digits and marks
do not count. Each language has several centroids, found by spherical k-means. As some
labels are wrong, a centroid finally belongs to the language most common among all training
texts nearest to it. The language of the centroid with the largest cosine is predicted. A
text that is much farther from its centroid than nearly all training texts of about its length
are from theirs is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.frames import annotated, tidy
from tickloom.llm.text import raw_texts, slices

DIMENSIONS = 4096
#: The model is fitted on at most about so many training texts of a language, taken by a
#: hash of their ids; document frequencies and the languages of centroids come from all training texts.
FIT_ROWS = 1000
CENTROIDS = 4
#: Texts whose dense vectors a task holds at once, 16 KB each.
AT_ONCE = 256
ROUNDS = 12
#: A text is rejected below this share of a low quantile of the cosines of training texts of its length.
REJECT_SHARE = 0.5
QUANTILE = 0.005
#: A class of lengths with fewer training texts borrows from the classes next to it.
THIN = 30
UNKNOWN = "und"

#: What counts as a letter, in the fit and in predictions: the Unicode categories L.
_LETTER = regex.compile(r"\p{L}")
_LENGTHS = 24
_CHUNK = 1 << 20
#: ASCII but a-z becomes white space.
_SPACES = bytes(c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def _ngrams(text: str) -> np.ndarray:
    """Counts of the hashed byte pairs and triples of a text's lower-cased words."""
    spaced = b" " + b" ".join(text.lower().encode().translate(_SPACES).split()) + b" "
    out = np.zeros(DIMENSIONS, np.int64)
    for low in range(0, max(len(spaced) - 1, 1), _CHUNK):
        # Pairs and triples that begin in the chunk.
        data = np.frombuffer(spaced[low: low + _CHUNK + 2], np.uint8).astype(np.uint32)
        pairs = data[:-1] * np.uint32(256) + data[1:]
        triples = pairs[:-1] * np.uint32(256) + data[2:] + np.uint32(1 << 24)
        grams = np.concatenate([pairs[:_CHUNK], triples]) * np.uint32(2654435761)
        out += np.bincount(grams >> np.uint32(32 - 12), minlength=DIMENSIONS)
    return out


def counted(texts: Sequence[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for row, text in zip(out, texts, strict=True):
        row[:] = _ngrams(text.decode("utf-8", "replace"))
    return out


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors; that of no n-grams is zero."""
    out = np.log1p(counts, dtype=np.float32)
    out *= idf
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norm, out=out, where=norm > 0)


def _length(counts: np.ndarray) -> np.ndarray:
    """Which class of lengths a text is in: powers of two of its n-grams."""
    return np.minimum(np.log2(np.maximum(counts.sum(axis=1, dtype=float), 1)).astype(int), _LENGTHS - 1)


def clustered(points: np.ndarray, count: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of unit vectors by spherical k-means, from starting points far from each other."""
    chosen = [points[0]]
    nearest = points @ points[0]
    for _ in range(1, min(count, len(points))):
        far = int(np.argmin(nearest))
        chosen.append(points[far])
        nearest = np.maximum(nearest, points @ points[far])
    centroids = np.array(chosen)
    for _ in range(rounds):
        own = np.argmax(points @ centroids.T, axis=1)
        for c in range(len(centroids)):
            mean = points[own == c].sum(axis=0)
            norm = np.linalg.norm(mean)
            if norm > 0:
                centroids[c] = mean / norm
    return centroids


def left_out(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Cosines of unit vectors to the nearest centroid, each without its own part in it."""
    cosines = points @ centroids.T
    own = np.argmax(cosines, axis=1)
    sums = np.array([points[own == c].sum(axis=0) for c in range(len(centroids))])
    dots = (points * sums[own]).sum(axis=1)
    rest = np.sqrt(np.maximum((sums * sums).sum(axis=1)[own] - 2 * dots + 1, 0))
    alone = np.bincount(own, minlength=len(centroids))[own] == 1
    cosines[np.arange(len(points)), own] = np.where(alone, 0, (dots - 1) / np.where(alone | (rest == 0), 1, rest))
    return cosines.max(axis=1)


def floors_of(score: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Per class of lengths the cosine below which a text is rejected, from those of training texts."""
    floors = np.zeros(_LENGTHS)
    for own in range(_LENGTHS):
        # As many classes on both sides as make enough texts, or all.
        near = next(n for s in range(_LENGTHS) if (n := abs(length - own) <= s).sum() >= THIN or s == _LENGTHS - 1)
        floors[own] = REJECT_SHARE * np.quantile(score[near], QUANTILE)
    return floors


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    floors: np.ndarray  # per centroid and class of lengths, the cosine below which a text is rejected

    def predict(self, texts: Sequence[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (the cosine, 0 to 1) and whether rejected."""
        counts = counted(texts)
        known = np.array([bool(_LETTER.search(t.decode("utf-8", "replace"))) for t in texts])
        if not len(self.languages):
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosines = vectors(counts, self.idf) @ self.centroids.T
        best = np.argmax(cosines, axis=1)
        score = cosines[np.arange(len(texts)), best].astype(float)
        rejected = ~known | (score < self.floors[best, _length(counts)])
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
        return names, np.where(known, np.clip(score, 0.0, 1.0), 0.0), rejected


def _frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each n-gram occurs, and the number of texts; sums of whole partitions."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in batches:
            texts = raw_texts(batch.column(0))
            for low, high in slices(texts, most=AT_ONCE):
                total[:-1] += (counted(texts[low:high]) > 0).sum(axis=0)
            total[-1] += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMENSIONS + 1)), pa.array(total)], names=["gram", "n"])

    sums = rows.select(F.col("text").cast("string")).mapInArrow(tidy(work), "gram long, n long")
    out = np.zeros(DIMENSIONS + 1, np.int64)
    for row in sums.groupBy("gram").agg(F.sum("n").alias("n")).collect():
        out[row.gram] = row.n
    return out[:-1], int(out[-1])


def fit(training: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """A model of the languages in ``lang`` from the rows (doc_id, text, lang) of ``training``.

    Rows with a null text or lang, and texts without a letter, take no part.
    """
    rows = training.select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("string"), "lang").where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    seen, texts = _frequencies(rows)
    idf = np.log((1 + texts) / (1 + seen)).astype(np.float32) + np.float32(1)
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    # Of each language an equal share of its ids by hash: about fit_rows of them.
    steps = 1 << 20
    share = F.lit(0)
    for lang, count in sizes.items():
        share = F.when(F.col("lang") == lang, min(steps, fit_rows * steps // count)).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64("id", F.lit("language")), F.lit(steps)) < share)

    def of_language(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["id", "text"])
        counts = counted([t.encode() for t in frame["text"]])
        points = vectors(counts, idf)
        centroids = clustered(points, CENTROIDS)
        floors = floors_of(left_out(points, centroids), _length(counts))
        return pd.DataFrame({
            "lang": key[0], "centroid": [c.astype(np.float32).tobytes() for c in centroids],
            "floors": [floors.astype(np.float64).tobytes()] * len(centroids),
        })

    fitted = sample.groupBy("lang").applyInPandas(of_language, "lang string, centroid binary, floors binary").collect()
    fitted = sorted((r.lang, bytes(r.centroid), bytes(r.floors)) for r in fitted)
    model = Model(
        [f[0] for f in fitted],
        np.array([np.frombuffer(f[1], np.float32) for f in fitted]).reshape(-1, DIMENSIONS),
        idf,
        np.array([np.frombuffer(f[2]) for f in fitted]).reshape(-1, _LENGTHS),
    )
    if model.languages:
        model.languages = _owners(rows, model)
    return model


def _owners(rows: DataFrame, model: Model) -> list[str]:
    """Each centroid's language: the most common one of the texts nearest to it, ties to the smaller name."""

    def compute(texts: Sequence[bytes]) -> list[pa.Array]:
        return [pa.array(np.argmax(vectors(counted(texts), model.idf) @ model.centroids.T, axis=1), pa.int64())]

    votes = annotated(rows.select("lang", "text"), "centroid long", compute, AT_ONCE)
    votes = votes.groupBy("centroid", F.col("row.lang").alias("lang")).agg(F.count("*").alias("n")).collect()
    most: dict[int, tuple] = {}
    for vote in sorted(votes, key=lambda r: (-r.n, r.lang)):
        most.setdefault(vote.centroid, vote.lang)
    return [most.get(c, name) for c, name in enumerate(model.languages)]


def held_out() -> Column:
    """Rows that take no part in learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """Each row of docs as ``row`` with lang_pred, score and rejected.

    ``lang_pred`` is ``und`` and the text rejected where it is null, empty or without a
    letter, or where there was nothing to learn from. ``score`` is the cosine to the nearest
    centroid.
    """

    def compute(texts: Sequence[bytes]) -> list[pa.Array]:
        names, scores, rejected = model.predict(texts)
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected)]

    return annotated(docs, "lang_pred string, score double, rejected boolean", compute, AT_ONCE)


def learned(docs: DataFrame) -> Model:
    return fit(docs.where(~held_out()))
