"""Language of texts by sparse multinomial logistic regression on TF-IDF character n-grams.

A text's features are its lower-cased n-grams of one to three code points, hashed to `dimensions` places and
weighted by log(1 + count) and inverse document frequency, to length 1. Document frequencies are counted over
all texts that may be learnt from. Weights come from follow-the-regularised-leader steps with an elastic-net
penalty, which leaves most places at exactly zero; a temperature fitted to rows that the steps haven't seen
then makes the highest probability an honest one.

Null texts and texts without a letter are `und` with score 0, as is everything if there is no row to learn
from. Rows without a language aren't learnt from. Texts are read whole; long ones are counted in pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atrium.llm.common import slices, tidy

UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
#: The fit takes at most so many rows of a language, and so many in all, the first by a hash of the id; every fifth of
#: them only sets the temperature.
ROWS_PER_LANGUAGE, SAMPLE_ROWS, CALIBRATE = 1_500, 12_000, 5
#: Code points are hashed so many at a time.
PIECE = 1 << 20


@dataclass(frozen=True)
class Settings:
    dimensions: int = 1 << 16
    lengths: tuple[int, ...] = (1, 2, 3)
    epochs: int = 3
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02


def counts(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places of the text's n-grams, ascending, and how often each occurs."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    total = np.zeros(settings.dimensions, np.int64)
    for at in range(0, len(points), PIECE):
        for q in settings.lengths:
            # A piece holds the n-grams that begin in it, which may end in the next.
            part = points[at : at + PIECE + q - 1]
            if len(part) < q:
                continue
            h = np.full(len(part) - q + 1, q, np.uint64)
            for i in range(q):
                h = (h ^ part[i : len(part) - q + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            total += np.bincount((h % np.uint64(settings.dimensions)).astype(np.int64), minlength=settings.dimensions)
    places = np.flatnonzero(total)
    return places, total[places]


def features(text: str, idf: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    places, n = counts(text, settings)
    x = np.log1p(n) * idf[places]
    return places, x / np.sqrt((x * x).sum())


def document_frequencies(texts: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """Inverse document frequency of each place, counted over all texts."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        held, rows = np.zeros(settings.dimensions, np.int64), 0
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                if text:
                    held[counts(text, settings)[0]] += 1
                    rows += 1
        places = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[places, -1], pa.int32()), pa.array(np.r_[held[places], rows], pa.int64())], names=["place", "n"])

    found = {r.place: r.n for r in texts.select("text").mapInArrow(each, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()}
    df = np.zeros(settings.dimensions)
    every = found.pop(-1, 0)
    df[list(found)] = list(found.values())
    return np.log((1 + every) / (1 + df)) + 1


def softmax(raw: np.ndarray) -> np.ndarray:
    e = np.exp(raw - raw.max())
    return e / e.sum()


class Regression:
    """Weights of the languages and their follow-the-regularised-leader steps; the last place is the intercept."""

    def __init__(self, settings: Settings, languages: int):
        self.settings = settings
        self.z, self.n = (np.zeros((settings.dimensions + 1, languages)) for _ in range(2))

    def weights(self, at: np.ndarray) -> np.ndarray:
        s, z = self.settings, self.z[at]
        l1 = np.where(at == s.dimensions, 0.0, s.l1)[:, None]
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2))

    def step(self, places: np.ndarray, x: np.ndarray, language: int) -> None:
        at, x = np.r_[places, self.settings.dimensions], np.r_[x, 1.0]
        w = self.weights(at)
        error = softmax(x @ w)
        error[language] -= 1
        g = x[:, None] * error
        more = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(self.n[at])) / self.settings.alpha * w
        self.n[at] = more


def temperature(raw: np.ndarray, languages: np.ndarray) -> float:
    """The divisor of the raw scores at which the languages are likeliest, from 1/50 to 50; 1 without rows.

    As in Platt's correction, the rows' own languages count a little less than whole, by one in their number and 2:
    rows without an error would ask for scores without bound.
    """
    if not len(raw):
        return 1.0
    less = 1 / (len(raw) + 2)

    def loss(log_t: float) -> float:
        r = raw / np.exp(log_t)
        r = r - r.max(axis=1, keepdims=True)
        own = (1 - less) * r[np.arange(len(r)), languages] + less * r.mean(axis=1)
        return float((np.log(np.exp(r).sum(axis=1)) - own).sum())

    low, high = -np.log(50), np.log(50)
    for _ in range(60):  # the loss is convex in 1/t, so has one valley in log t
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def learnable(documents: DataFrame, usable) -> DataFrame:
    return documents.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())


def sample(documents: DataFrame) -> DataFrame:
    """(text, lang) of a bounded part of the rows, the first of each language by a hash of the id."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    ids = documents.where("doc_id IS NOT NULL").select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).distinct()
    chosen = ids.withColumn("place", place).where(F.col("place") <= ROWS_PER_LANGUAGE).orderBy("place", "lang").limit(SAMPLE_ROWS).select("doc_id", "lang")
    return documents.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"]).select("text", "lang")


FITTED = "languages array<string>, places array<int>, weights array<double>, temperature double"


def fit(labelled: DataFrame, idf: np.ndarray, settings: Settings = Settings()) -> dict:
    """Fit on (text, lang) rows without nulls, which must be a bounded sample; rows are taken in a fixed order, in one task."""

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        rows = []
        for batch in slices(batches):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                if LETTER.search(text):
                    places, x = features(text, idf, settings)
                    rows.append((places.astype(np.int32), x.astype(np.float32), lang))
        kept = [r for i, r in enumerate(rows) if i % CALIBRATE or len(rows) < 2 * CALIBRATE]
        languages = sorted({r[2] for r in kept})
        index = {lang: i for i, lang in enumerate(languages)}
        if not languages:
            return
        model = Regression(settings, len(languages))
        for epoch in range(settings.epochs):
            for i in np.random.default_rng(epoch).permutation(len(kept)):
                places, x, lang = kept[i]
                model.step(places, x, index[lang])
        w = model.weights(np.arange(settings.dimensions + 1))
        rest = [r for i, r in enumerate(rows) if not i % CALIBRATE and r[2] in index and len(rows) >= 2 * CALIBRATE]
        raw = np.array([x @ w[places] + w[-1] for places, x, _ in rest]).reshape(len(rest), len(languages))
        used = np.flatnonzero((w != 0).any(axis=1))
        yield pa.RecordBatch.from_pylist([{"languages": languages, "places": used.tolist(), "weights": w[used].ravel().tolist(), "temperature": temperature(raw, np.array([index[r[2]] for r in rest], int))}], schema=pa.schema([("languages", pa.list_(pa.string())), ("places", pa.list_(pa.int32())), ("weights", pa.list_(pa.float64())), ("temperature", pa.float64())]))

    got = labelled.select("text", "lang", F.xxhash64("text").alias("h")).repartition(1).sortWithinPartitions("h", "text", "lang").mapInArrow(train, FITTED).collect()
    return got[0].asDict() if got else {"languages": [], "places": [], "weights": [], "temperature": 1.0}


def predict(documents: DataFrame, model: dict, idf: np.ndarray, settings: Settings = Settings(), names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """documents with the language and its probability for each whole text, in columns that replace any of these names.

    All other columns are kept and repeated rows are judged each.
    """
    taken = {n.lower() for n in names}
    columns = [c for c in documents.columns if c.lower() not in taken]
    out = T.StructType([*documents.select(*columns).schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        languages = model["languages"]
        w = np.zeros((settings.dimensions + 1, len(languages)))
        w[model["places"]] = np.array(model["weights"]).reshape(len(model["places"]), len(languages))
        for batch in slices(batches):
            said, scores = [], []
            for value in batch.column("text").to_pylist():
                if languages and value and LETTER.search(value):
                    places, x = features(value, idf, settings)
                    p = softmax((x @ w[places] + w[-1]) / model["temperature"])
                    said.append(languages[int(p.argmax())])
                    scores.append(float(p.max()))
                else:
                    said.append(UNKNOWN)
                    scores.append(0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(said, pa.string()), pa.array(scores, pa.float64())], names=[*columns, *names])

    return documents.select(*columns).mapInArrow(apply, out)
