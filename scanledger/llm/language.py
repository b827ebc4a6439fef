"""Language of a text by the nearest of several centroids per language.

A text becomes the vector of its character n-grams (one to three letters, with
word ends), hashed to a fixed number of places and weighted by TF-IDF. Training
texts of a language are clustered, so that it is known by several centroids and
may hold different kinds of text. The nearest centroid by cosine names the
language; a text too far from it, by the training texts' own distances, is
marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanledger.llm.common import stored

PLACES = 4096
CENTROIDS = 4
#: Training texts of a language that are clustered: those with the smallest hash of their id.
FIT_ROWS = 600
#: Share of a language's texts that lie further out than its limit, among texts that made no centroid.
OUTLIERS = 0.005
ROUNDS = 12
HELD_OUT_FOLDS = 5
UNKNOWN = "und"
_CHUNK = 1 << 20
_ROWS_AT_ONCE = 256
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_PREDICTED = pa.schema(
    [
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
        ("score", pa.float64()), ("rejected", pa.bool_()),
    ]
)


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray  # a row each, of length 1
    limits: np.ndarray  # least cosine that is not rejected


def held_out(doc_id: Column) -> Column:
    """Documents that are kept from learning; those without an id are too."""
    fold = F.crc32(doc_id.cast("string")) % HELD_OUT_FOLDS
    return F.coalesce(fold == 0, F.lit(True))


_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """A table of all code points, made once in a worker."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Hashed counts of the n-grams; None if there is no letter.

    Letters are lower-cased; what stands between two words counts as one mark,
    which also stands before the first and after the last word.
    """
    counts, last, letters = np.zeros(PLACES, np.int64), np.zeros(1, np.uint64), _is_letter()
    lowered = (text or "").lower()
    for at in range(0, len(lowered) + 1, _CHUNK):
        end = at + _CHUNK > len(lowered)
        part = lowered[at : at + _CHUNK] + " " * end
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        marked = np.where(letters[points], points, 0).astype(np.uint64)
        before = np.concatenate([last[-1:], marked[:-1]])
        run = np.concatenate([last, marked[(marked > 0) | (before > 0)]])
        _count(run, len(last), counts)
        last = run[-2:]
    return counts if counts.any() else None


def _count(run: np.ndarray, known: int, counts: np.ndarray) -> None:
    """Add the n-grams that end behind the first ``known`` symbols."""
    for size in (1, 2, 3):
        first = max(known - size + 1, 0)
        n = len(run) - size + 1 - first
        if n <= 0:
            continue
        grams = [run[first + k : first + k + n] for k in range(size)]
        inner = grams[0] > 0 if size == 1 else grams[1] > 0 if size == 3 else (grams[0] > 0) | (grams[1] > 0)
        mixed = np.full(n, size, np.uint64)
        for k, gram in enumerate(grams):
            mixed = (mixed ^ gram) * _MULTIPLIERS[k]
            mixed ^= mixed >> np.uint64(29)
        places = (mixed * _MULTIPLIERS[0] >> np.uint64(40)) % np.uint64(PLACES)
        counts += np.bincount(places[inner].astype(np.int64), minlength=PLACES)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length 1; the square root keeps frequent n-grams from ruling."""
    rows = np.sqrt(counts, dtype=np.float32) * idf.astype(np.float32)
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _document_counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of the task each place occurs, and the number of texts at place -1."""
    seen, texts = np.zeros(PLACES, np.int64), 0
    for part in parts:
        for text in part.column("text").to_pylist():
            counts = ngram_counts(text)
            if counts is not None:
                seen += counts > 0
                texts += 1
    yield pa.RecordBatch.from_pydict(
        {"place": pa.array([-1, *range(PLACES)], pa.int32()), "texts": pa.array([texts, *seen.tolist()])}
    )


def inverse_frequencies(training: DataFrame) -> np.ndarray:
    """IDF of every place over all training texts; their number is fixed."""
    counts = training.select("text").mapInArrow(_document_counts, "place int, texts long")
    summed = counts.groupBy("place").agg(F.sum("texts").alias("texts"))
    found = {r.place: r.texts for r in summed.collect()}
    texts = np.array([found.get(p, 0) for p in range(PLACES)])
    return np.log((1 + found.get(-1, 0)) / (1 + texts)) + 1


def _cluster(rows: np.ndarray) -> np.ndarray:
    """Spherical k-means from seeds that lie far apart; fewer centroids for few texts."""
    seeds = [rows.mean(axis=0)]
    nearest = rows @ seeds[0]
    for _ in range(min(CENTROIDS, len(rows)) - 1):
        seeds.append(rows[int(nearest.argmin())])
        nearest = np.maximum(nearest, rows @ seeds[-1])
    centroids = np.array(seeds)
    for _ in range(ROUNDS):
        chosen = (rows @ centroids.T).argmax(axis=1)
        centroids = np.array([rows[chosen == k].mean(axis=0) for k in np.unique(chosen)])
        centroids /= np.linalg.norm(centroids, axis=1, keepdims=True)
    return centroids


def _unseen_cosines(rows: np.ndarray) -> np.ndarray:
    """The cosine of each text to the nearest centroid of texts without it: those of the other half."""
    halves = rows[::2], rows[1::2]
    if not len(halves[1]):
        return np.zeros(1)
    return np.concatenate(
        [(own @ _cluster(other).T).max(axis=1) for own, other in (halves, halves[::-1])]
    )


def _fit_language(idf: np.ndarray):
    def fit(texts: pd.DataFrame) -> pd.DataFrame:
        texts = texts.sort_values(["doc_id", "text"])
        counts = [c for c in map(ngram_counts, texts["text"]) if c is not None]
        if not counts:
            return pd.DataFrame({"lang": [], "centroid": [], "least": []})
        rows = weighted(np.array(counts), idf)
        centroids = _cluster(rows)
        least = float(np.quantile(_unseen_cosines(rows), OUTLIERS))
        return pd.DataFrame(
            {"lang": texts["lang"].iloc[0], "centroid": [c.tolist() for c in centroids], "least": least}
        )

    return fit


def fit_languages(docs: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Learn from ``text`` and non-null ``lang`` of the documents not held out.

    The IDF is counted over all of them; ``rows`` of each language are clustered.
    """
    training = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    idf = inverse_frequencies(training)
    counts = stored(training.groupBy("lang").agg(F.count("*").alias("texts")), "counts")
    # hashes that are small enough to be among the first of their language, with ample room, so
    # that a language of any size sends no more than twice ``rows`` to its rank
    place = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))
    early = training.select("doc_id", "lang").join(counts, "lang").filter(place * F.col("texts") < 2 * rows)
    order = Window.partitionBy("lang").orderBy(place, "doc_id")
    ranked = early.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= rows)
    # stored, so that its true size decides whether the texts must be shuffled to it
    chosen = stored(ranked.select("doc_id", "lang").distinct(), "chosen")
    texts = training.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"])
    fitted = texts.groupBy("lang").applyInPandas(
        _fit_language(idf), "lang string, centroid array<float>, least double"
    )
    found = sorted(fitted.collect(), key=lambda r: (r.lang, r.centroid))
    centroids = np.array([r.centroid for r in found], np.float32).reshape(-1, PLACES)
    return Model(idf, [r.lang for r in found], centroids, np.array([r.least for r in found]))


def _predict(shared):
    def predict(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for part in parts:
            for at in range(0, part.num_rows, _ROWS_AT_ONCE):
                rows = part.slice(at, _ROWS_AT_ONCE)
                named = [UNKNOWN] * rows.num_rows
                score, rejected = np.zeros(rows.num_rows), np.ones(rows.num_rows, bool)
                counts = [ngram_counts(t) for t in rows.column("text").to_pylist()]
                known = [k for k, c in enumerate(counts) if c is not None]
                if known and model.languages:
                    near = weighted(np.array([counts[k] for k in known]), model.idf) @ model.centroids.T
                    best = near.argmax(axis=1)
                    score[known] = np.clip(near.max(axis=1), 0, 1)
                    rejected[known] = near.max(axis=1) < model.limits[best]
                    for k, b in zip(known, best.tolist(), strict=True):
                        named[k] = model.languages[b]
                columns = [rows.column("doc_id"), rows.column("held_out"), named, score, rejected]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _PREDICTED, strict=True)],
                    schema=_PREDICTED,
                )

    return predict


def predict_languages(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every row, from the text alone.

    ``score`` is the cosine to the nearest centroid, 0 to 1; of equally near ones
    the first by language, then by its numbers, counts. A null text or one
    without a letter is ``und`` with score 0 and rejected, as is every text if
    nothing was learned. Repeated rows stay; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(
        _predict(shared), "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
    )
