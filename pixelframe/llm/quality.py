"""Quality scores from compression: zstandard dictionaries of good and of bad text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import crc_mod, release

#: A text is compressed in windows of so many bytes, so that a dictionary matters as much late in a long text.
WINDOW = 2048
LEVEL = 3


def _windows(raw: bytes) -> list[bytes]:
    return [raw[i:i + WINDOW] for i in range(0, len(raw), WINDOW)]


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; of too few samples, their bytes as they are."""
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


@dataclass
class Model:
    """Two dictionaries and the calibration; a few hundred kilobytes, whatever the corpus."""

    good: bytes = b""
    bad: bytes = b""
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    centre: np.ndarray = field(default_factory=lambda: np.zeros(1))
    scale: np.ndarray = field(default_factory=lambda: np.ones(1))
    prior: float = 0.5

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        out = []
        for raw in (self.good, self.bad, b""):
            d = zstandard.ZstdCompressionDict(raw) if raw else None
            out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False))
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((terms(x) - self.centre) / self.scale, -8, 8)
        p = 1 / (1 + np.exp(-np.clip(z @ self.weights[1:] + self.weights[0], -30, 30)))
        return np.where(x[:, 0] > 0, p, self.prior)


def sizes(text: str | None, compressors: list[zstandard.ZstdCompressor]) -> tuple[float, float, float, float]:
    """Bytes of the whole text, and of its windows compressed with the good, the bad and no dictionary."""
    raw = (text or "").encode()
    ws = _windows(raw)
    good, bad, none = (float(sum(len(c.compress(w)) for w in ws)) for c in compressors)
    return float(len(raw)), good, bad, none


def terms(x: np.ndarray) -> np.ndarray:
    """The normalised difference of the compressed sizes, the sizes themselves, and their products."""
    n, good, bad, none = (np.maximum(x[:, i], 1.0) for i in range(4))
    base = np.stack([(bad - good) / np.maximum(good, bad), good / n, bad / n, none / n, np.log(n)], 1)
    return np.concatenate([base, base[:, :4] ** 2, base[:, :1] * base[:, 1:4]], 1)


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray,
              ridge: float = 0.3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton steps; ``weight`` restores the classes' shares in the whole table."""
    t = terms(x)
    centre, scale = t.mean(0), np.maximum(t.std(0), 1e-6)
    a = np.concatenate([np.ones((len(t), 1)), np.clip((t - centre) / scale, -8, 8)], 1)
    w = np.zeros(a.shape[1])
    pen = np.full(len(w), ridge)
    pen[0] = 1e-6
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + np.diag(pen)
        step = np.linalg.solve(h, a.T @ (weight * (y - p)) - pen * w)
        w += step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w, centre, scale


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = 2500, dictionary_bytes: int = 1 << 16,
        folds: int = 5, held_out: int = 0) -> Model:
    """Learn from labelled rows whose ``crc32(doc_id as text) mod folds`` is not ``held_out``.

    The sample is bounded: of each class the ``rows_per_class`` ids with the smallest hash, and of an id one text,
    however often its row repeats (the one with the smallest hash).  Up to eight evenly spaced windows of each text
    make the dictionaries.  For the calibration, the texts of each half of the sample are measured, whole, with
    dictionaries of the other half.  Several labels of an id count as the largest; null labels do not count.  Without rows of both classes the model
    gives the prior: 1 for only good rows, 0 for only bad ones, 0.5 for none.
    """
    spark = docs.sparkSession
    known = (labels.where("quality in (0, 1) and doc_id is not null")
             .where(crc_mod(F.col("doc_id"), folds) != held_out)
             .groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality")))
    total = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if len(total) < 2:
        return Model(prior=float(max(total, default=0.5)))
    ids = []
    for q in (1, 0):
        ids += [(r["doc_id"], q, r["_h"] % 2) for r in known.where(F.col("quality") == q)
                .select("doc_id", F.xxhash64("doc_id", F.lit(4)).alias("_h")).orderBy("_h", "doc_id")
                .limit(rows_per_class).collect()]
    picked = spark.createDataFrame(ids, "doc_id long, quality int, half long")
    text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sample = (text.join(F.broadcast(picked), "doc_id")  # at most two classes of rows_per_class ids
              .groupBy("doc_id", "quality", "half")
              .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
              .select("doc_id", "quality", "half", F.col("t.text").alias("text")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, q, h, t in zip(*(b.column(c).to_pylist() for c in ("doc_id", "quality", "half", "text"))):
                ws = _windows(t.encode())
                ws = [ws[j] for j in sorted({int(k) for k in np.linspace(0, len(ws) - 1, 8)})] if ws else []
                n = len(ws)
                yield pa.RecordBatch.from_arrays([pa.array([i] * n, pa.int64()), pa.array([q] * n, pa.int32()),
                                                  pa.array([h] * n, pa.int64()), pa.array(ws, pa.binary())],
                                                 names=["doc_id", "quality", "half", "w"])

    rows = sorted(sample.mapInArrow(cut, "doc_id long, quality int, half long, w binary").collect())

    def dictionary(q: int, halves: tuple[int, ...]) -> bytes:
        return _dictionary([bytes(r["w"]) for r in rows if r["quality"] == q and r["half"] in halves], dictionary_bytes)

    model = Model(dictionary(1, (0, 1)), dictionary(0, (0, 1)), prior=total[1] / sum(total.values()))
    other = spark.sparkContext.broadcast([Model(dictionary(1, (h,)), dictionary(0, (h,))) for h in (1, 0)])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cs = [m.compressors() for m in other.value]
        for b in batches:
            x = [sizes(t, cs[h]) for t, h in zip(b.column("text").to_pylist(), b.column("half").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("quality"), pa.array(x, pa.list_(pa.float64()))],
                                             names=["doc_id", "quality", "x"])

    got = sorted(r for r in sample.mapInArrow(measure, "doc_id long, quality int, x array<double>").collect() if r["x"][0])
    x, y = np.array([r["x"] for r in got]).reshape(-1, 4), np.array([r["quality"] for r in got], float)
    if len(set(y)) == 2:
        share = {q: total[q] / max(1, sum(y == q)) for q in (0, 1)}
        weight = np.array([share[int(q)] for q in y])
        model.weights, model.centre, model.scale = calibrate(x, y, weight / weight.mean())
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """A column: the probability that a row's whole text is good.  Null or empty text: the model's prior."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        cs = m.compressors()
        for s in batches:
            if len(m.weights) == 1:
                yield pa.array(np.full(len(s), m.prior))
            else:
                yield pa.array(m.score(np.array([sizes(t.as_py(), cs) for t in s]).reshape(-1, 4)))
        release()

    return scores(F.coalesce(F.col(text_col), F.lit("")))


def scored(docs: DataFrame, model: Model, threshold: float = 0.3, folds: int = 5, held_out: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; a row without id is not held out."""
    out = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), score(docs, model).alias("score"))
    return out.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
