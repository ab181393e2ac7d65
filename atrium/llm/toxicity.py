"""Toxicity by a factorization machine over hashed terms.

A text's terms are its distinct words in lower case, without punctuation at their ends, and the words'
beginnings of four to six letters; each is hashed to one of `dimensions` places. The machine scores
w0 + sum w_i + sum over pairs <v_i, v_j>, so that it learns what two terms mean together, such as an
insult beside the name of a group, which no sum of single weights expresses. It is fitted by
follow-the-regularized-leader steps, whose penalty leaves uninformative terms at exactly zero: very long
texts gather no noise from them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atrium.llm.common import slices, tidy

#: At most so many labelled rows are learnt from, the first by a hash of the id.
SAMPLE_ROWS = 20_000
PREFIXES = (4, 5, 6)
PUNCTUATION = ".,;:!?\"'()[]{}<>|*#$%&-_"


def logistic(x: float) -> float:
    return 1 / (1 + math.exp(-max(-35.0, min(35.0, x))))


@dataclass(frozen=True)
class Settings:
    dimensions: int = 1 << 18
    factors: int = 4
    epochs: int = 4
    alpha: float = 0.3
    #: Of 10,000 rows; it grows with their number to this power.
    l1: float = 13.0
    l1_power: float = 0.25
    #: Steps of toxic rows, which are few, weigh so much.
    positive: float = 5.0
    l2: float = 0.05
    factor_l2: float = 0.02
    factor_rate: float = 0.05


class Terms(dict):
    """Places of a word's terms, of those in `used` if it is given, for at most `keep` words at a time."""

    def __init__(self, dimensions: int, used: set[int] | None = None, keep: int = 150_000):
        super().__init__()
        self.mask, self.used, self.keep = dimensions - 1, used, keep

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= self.keep:
            self.clear()
        bare = word.strip(PUNCTUATION)
        terms = {bare, *("^" + bare[:n] for n in PREFIXES if len(bare) >= n)} if bare else ()
        found = {xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) & self.mask for t in terms}
        self[word] = places = tuple(found if self.used is None else found & self.used)
        return places

    def of(self, text: str | None) -> np.ndarray:
        """Distinct places of a whole text, ascending."""
        found: set[int] = set()
        for places in filter(None, map(self.__getitem__, set((text or "").lower().split()))):
            found.update(places)
        return np.fromiter(sorted(found), np.int64, len(found))


class Machine:
    """Weights of a factorization machine and its steps."""

    def __init__(self, settings: Settings, rows: int):
        self.settings, n, k = settings, settings.dimensions, settings.factors
        self.l1 = settings.l1 * (rows / 10_000) ** settings.l1_power
        self.w0, self.n0 = 0.0, 0.0
        self.z, self.n = np.zeros(n), np.zeros(n)
        self.v = np.random.default_rng(7).normal(0, 0.01, (n, k))
        self.nv = np.zeros(n)

    def weights(self, at: np.ndarray) -> np.ndarray:
        s, z = self.settings, self.z[at]
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((1.0 + np.sqrt(self.n[at])) / s.alpha + s.l2))

    def step(self, at: np.ndarray, label: int) -> None:
        s, w = self.settings, self.weights(at)
        active = at[w != 0]  # terms at zero weight have no factors either
        v = self.v[active]
        total = v.sum(axis=0)
        raw = self.w0 + w.sum() + 0.5 * float((total**2).sum() - (v**2).sum())
        g = (logistic(raw) - label) * (s.positive if label else 1.0)
        self.n0 += g * g
        self.w0 -= g * s.alpha / (1.0 + math.sqrt(self.n0))
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / s.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g
        if len(active) > 1:
            gv = g * (total - v) + s.factor_l2 * v
            self.nv[active] += (gv**2).sum(axis=1)
            self.v[active] = v - gv * (s.factor_rate / (1e-6 + np.sqrt(1.0 + self.nv[active])))[:, None]

    def fitted(self) -> dict:
        """What scoring needs: the terms with a weight, their weights and factors."""
        every = np.arange(self.settings.dimensions)
        w = self.weights(every)
        used = np.flatnonzero(w)
        return {"w0": self.w0, "places": used.tolist(), "weights": w[used].tolist(), "factors": self.v[used].ravel().tolist()}


FITTED = "w0 double, places array<long>, weights array<double>, factors array<double>"


def fit(labelled: DataFrame, settings: Settings = Settings()) -> dict:
    """Fit on (text, label) rows, which must be a bounded sample; rows are taken in a fixed order.

    Rows with a null label are left out; null texts are empty. Without rows the machine scores 0.5.
    One task fits; it holds the sample's term places, not the texts.
    """

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        terms, rows = Terms(settings.dimensions), []
        for batch in slices(batches):
            rows += [(terms.of(t).astype(np.int32), y) for t, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist())]
        machine = Machine(settings, len(rows))
        for epoch in range(settings.epochs):
            for i in np.random.default_rng(epoch).permutation(len(rows)):
                machine.step(*rows[i])
        yield pa.RecordBatch.from_pylist([machine.fitted()])

    rows = labelled.where("label IS NOT NULL").select("text", F.col("label").cast("int").alias("label"), F.xxhash64("text").alias("h"))
    got = rows.repartition(1).sortWithinPartitions("h", "text", "label").mapInArrow(train, FITTED).collect()
    return got[0].asDict() if got else {"w0": 0.0, "places": [], "weights": [], "factors": []}


def score(documents: DataFrame, model: dict, settings: Settings = Settings(), name: str = "score") -> DataFrame:
    """documents with the column `name` (0 to 1) for each whole text; null and empty texts score as no terms do.

    A column `name` of the input is replaced; all other columns are kept, repeated rows are scored each, and
    an empty table gives an empty result. The model is at most `dimensions` terms, whatever the corpus.
    """
    columns = [c for c in documents.columns if c.lower() != name.lower()]
    schema = documents.select(*columns).schema.add(name, "double")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        terms = Terms(settings.dimensions, set(model["places"]))
        w = np.zeros(settings.dimensions)
        v = np.zeros((settings.dimensions, settings.factors))
        w[model["places"]] = model["weights"]
        v[model["places"]] = np.array(model["factors"]).reshape(len(model["places"]), settings.factors)
        for batch in slices(batches):
            scores = []
            for text in batch.column("text").to_pylist():
                at = terms.of(text)
                f = v[at]
                raw = model["w0"] + w[at].sum() + 0.5 * float((f.sum(axis=0) ** 2).sum() - (f**2).sum())
                scores.append(logistic(raw))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*columns, name])

    return documents.select(*columns).mapInArrow(apply, schema)
