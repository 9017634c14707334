"""Language of a text by a small convolutional network over its bytes, trained with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, small_batches, texts

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
UNKNOWN = "und"


def _byte_classes() -> np.ndarray:
    """Letters without case, digits, white space and controls, other ASCII, and every byte above 127."""
    c = np.full(256, 3, np.uint8)
    c[:33] = c[127] = 0
    c[ord("0"):ord("9") + 1] = 1
    for i in range(26):
        c[ord("a") + i] = c[ord("A") + i] = 4 + i
    c[128:] = 30 + np.arange(128)
    return c


CLASSES = _byte_classes()
N_CLASSES = 158


def windows(raw: bytes) -> np.ndarray:
    """All of a text's bytes as rows of classes: WINDOW positions and the next ones that a filter there sees."""
    x = CLASSES[np.frombuffer(raw, np.uint8)]
    n, more = max(1, -(-len(x) // WINDOW)), max(WIDTHS) - 1
    pad = np.zeros(n * WINDOW + more, np.uint8)
    pad[:len(x)] = x
    return np.lib.stride_tricks.sliding_window_view(pad, WINDOW + more)[::WINDOW]


@dataclass
class Network:
    langs: list[str]
    embed: np.ndarray               # classes × EMBED
    filters: list[np.ndarray]       # per width: (width, EMBED, FILTERS)
    bias: np.ndarray                # filters of all widths
    out: np.ndarray                 # filters × languages
    out_bias: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The convolutions as sums of looked-up rows: a byte's, or a byte pair's, part of each filter."""
        t = [[self.embed @ f[o] for o in range(len(f))] for f in self.filters]
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(-1, FILTERS)
        two, three, four = t
        first = np.concatenate([pair(*two), pair(three[0], three[1]), pair(four[0], four[1])], 1) + self.bias
        return (first.astype(np.float32), three[2].astype(np.float32), pair(four[2], four[3]).astype(np.float32))

    def pooled(self, w: np.ndarray, tables: tuple) -> np.ndarray:
        """Maxima of all filters over each window."""
        first, third, second = tables
        w = w.astype(np.int32)
        pairs = w[:, :-1] * N_CLASSES + w[:, 1:]
        r = first[pairs[:, :WINDOW]]
        r[:, :, FILTERS:2 * FILTERS] += third[w[:, 2:WINDOW + 2]]
        r[:, :, 2 * FILTERS:] += second[pairs[:, 2:WINDOW + 2]]
        return np.maximum(r.max(1), 0)

    def logits(self, w: np.ndarray, tables: tuple, rows: int = 64) -> np.ndarray:
        return np.concatenate([self.pooled(w[i:i + rows], tables) @ self.out + self.out_bias
                               for i in range(0, len(w), rows)])


def train(x: np.ndarray, y: np.ndarray, langs: list[str], steps: int = 500, batch: int = 48, rate: float = 0.01,
          seed: int = 3) -> Network:
    """Adam on windows ``x`` (classes) with language numbers ``y``; gradients pass through each maximum."""
    rng = np.random.default_rng(seed)
    k = FILTERS * len(WIDTHS)
    p = {"embed": rng.normal(0, 0.5, (N_CLASSES, EMBED)), "bias": np.zeros(k),
         "out": rng.normal(0, 0.2, (k, len(langs))), "out_bias": np.zeros(len(langs))}
    for w in WIDTHS:
        p[f"f{w}"] = rng.normal(0, (2 / (w * EMBED)) ** 0.5, (w * EMBED, FILTERS))
    p = {n: v.astype(np.float32) for n, v in p.items()}
    m, v = ({n: np.zeros_like(a) for n, a in p.items()} for _ in range(2))
    weight = 1 / np.maximum(np.bincount(y, minlength=len(langs)), 1)
    odds = weight[y] / weight[y].sum()  # every language is drawn as often
    for step in range(1, steps + 1):
        pick = rng.choice(len(x), batch, p=odds)
        c, t = x[pick].astype(np.int64), y[pick]
        e = p["embed"][c]
        pooled, best, cols = [], [], []
        for w in WIDTHS:
            col = np.concatenate([e[:, o:o + WINDOW] for o in range(w)], 2)
            r = col @ p[f"f{w}"]
            at = r.argmax(1)
            pooled.append(np.take_along_axis(r, at[:, None], 1)[:, 0])
            best.append(at)
            cols.append(col)
        h = np.concatenate(pooled, 1) + p["bias"]
        a = np.maximum(h, 0)
        z = a @ p["out"] + p["out_bias"]
        q = np.exp(z - z.max(1, keepdims=True))
        q /= q.sum(1, keepdims=True)
        q[np.arange(batch), t] -= 1
        q /= batch
        g = {"out": a.T @ q, "out_bias": q.sum(0)}
        dh = (q @ p["out"].T) * (h > 0)
        g["bias"] = dh.sum(0)
        g["embed"] = np.zeros_like(p["embed"])
        for i, w in enumerate(WIDTHS):
            d = dh[:, i * FILTERS:(i + 1) * FILTERS]
            seen = np.take_along_axis(cols[i], best[i][:, :, None], 1)  # batch × filters × (w·EMBED)
            g[f"f{w}"] = np.einsum("bfe,bf->ef", seen, d)
            back = d[:, :, None] * p[f"f{w}"].T[None]
            for o in range(w):
                np.add.at(g["embed"], np.take_along_axis(c, best[i] + o, 1), back[:, :, o * EMBED:(o + 1) * EMBED])
        for n in p:
            m[n] = 0.9 * m[n] + 0.1 * g[n]
            v[n] = 0.999 * v[n] + 0.001 * g[n] ** 2
            p[n] = p[n] - rate * (m[n] / (1 - 0.9 ** step)) / (np.sqrt(v[n] / (1 - 0.999 ** step)) + 1e-8)
    return Network(langs, p["embed"], [p[f"f{w}"].reshape(w, EMBED, FILTERS) for w in WIDTHS], p["bias"], p["out"],
                   p["out_bias"])


def _by_lang(values: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def fit(docs: DataFrame, rows_per_lang: int = 1500, windows_per_row: int = 3, steps: int = 500, folds: int = 4,
        held_out: int = 2) -> Network | None:
    """Learn from text and language of rows whose ``crc32(doc_id as text) mod folds`` is not ``held_out``.

    The sample is bounded: of each language at most ``rows_per_lang`` ids, those with the smallest hash, of an
    id in a language one text, however often its row repeats (the one with the smallest hash), and of each
    ``windows_per_row`` evenly spaced windows.  Ids that cannot be among them are dropped by a
    threshold on the hash, from the language's count, so nothing ranks a whole language.  None if no row is labelled.
    """
    seen = docs.where("lang is not null and text is not null and doc_id is not null").where(
        crc_mod(F.col("doc_id"), folds) != held_out).select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "text")
    hashed = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(3)), 2)
    ids = seen.select("doc_id", "lang").distinct().withColumn("_h", hashed)
    counts = {r["lang"]: r["count"] for r in ids.groupBy("lang").count().collect()}  # languages, as many as the model has
    if not counts:
        return None
    # of n ids, all but a vanishing share of draws leave rows_per_lang or more below this; too few are only fewer
    room = rows_per_lang + 6 * rows_per_lang ** 0.5 + 20
    below = _by_lang({lang: int(min(1.0, room / n) * (1 << 62)) for lang, n in counts.items()})
    kept: dict[str, list[tuple[int, int]]] = {}
    for r in ids.where(F.col("_h") <= F.element_at(below, F.col("lang"))).collect():
        kept.setdefault(r["lang"], []).append((r["_h"], r["doc_id"]))
    picked = docs.sparkSession.createDataFrame(
        [(i, lang) for lang, rows in kept.items() for _, i in sorted(rows)[:rows_per_lang]], "doc_id long, lang string")
    sample = (seen.join(F.broadcast(picked), ["doc_id", "lang"]).groupBy("doc_id", "lang")
              .agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
              .select("doc_id", "lang", F.col("t.text").alias("text")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            out = []
            for i, lang, t in zip(*(b.column(c).to_pylist() for c in ("doc_id", "lang", "text"))):
                if any(c.isalpha() for c in t):
                    w = windows(t.encode())
                    for j in sorted({int(x) for x in np.linspace(0, max(0, len(w) - 2), windows_per_row)}):
                        out.append((i, j, lang, w[j].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(
                (pa.int64(), pa.int32(), pa.string(), pa.binary()))], names=["doc_id", "j", "lang", "w"])

    rows = sorted(sample.mapInArrow(cut, "doc_id long, j int, lang string, w binary").collect(), key=lambda r: tuple(r)[:3])
    if not rows:
        return None
    langs = sorted({r["lang"] for r in rows})
    x = np.stack([np.frombuffer(bytes(r["w"]), np.uint8) for r in rows])
    return train(x, np.array([langs.index(r["lang"]) for r in rows]), langs, steps)


def predict(docs: DataFrame, net: Network | None, folds: int = 4, held_out: int = 2) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, from all windows of the whole text.

    ``score`` is the softmax of the mean of the windows' logits, weighted by their bytes.  Null text or no
    letter, or nothing learned: ``und`` with score 0.  A row without id is not held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = shared.value
        tables = n.tables() if n else None
        for b in small_batches(batches):
            pred, score = [], []
            for t in b.column("text").to_pylist():
                if n is None or not any(c.isalpha() for c in t):
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    continue
                raw = t.encode()
                w = windows(raw)
                weight = np.full(len(w), WINDOW, float)
                weight[-1] = len(raw) - WINDOW * (len(w) - 1)
                z = (n.logits(w, tables) * weight[:, None]).sum(0) / weight.sum()
                q = np.exp(z - z.max())
                pred.append(n.langs[int(z.argmax())])
                score.append(float(q.max() / q.sum()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    out = texts(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
                      "lang_pred", "score")
