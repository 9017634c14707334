"""Order MinHash: fingerprints of texts whose likeness follows the edit distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize_table, small_batches, texts

#: Code points of a k-mer, tuples of a fingerprint, k-mers of a tuple.
K, SKETCHES, ORDER = 6, 64, 2
_RNG = np.random.default_rng(9)
_FACTORS = (_RNG.integers(0, 2**32, SKETCHES, np.uint64) | np.uint64(1)).astype(np.uint32)
_SHIFTS = _RNG.integers(0, 2**32, SKETCHES, np.uint64).astype(np.uint32)
#: Positions hashed at once; longer texts go through in parts, keeping the smallest so far.
_PART = 1 << 15
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kmers(codes: np.ndarray, k: int = K) -> np.ndarray:
    """A hash of each k-mer; of a text shorter than k, one of the whole."""
    n = len(codes)
    k = min(k, n)
    if not n:
        return np.zeros(0, np.uint64)
    c = codes.astype(np.uint64) + np.uint64(1)
    h = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        h = h * np.uint64(_BASE) + c[i:n - k + 1 + i]
    return _mix(h + np.uint64(k))


def numbered(h: np.ndarray) -> np.ndarray:
    """Each k-mer's hash with the number of its occurrence in the text: no two are alike."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, int)
    occurrence = np.empty(len(h), np.uint64)
    occurrence[order] = np.arange(len(h)) - np.repeat(new, np.diff(np.append(new, len(h))))
    return (_mix(h + occurrence * _STEP) >> np.uint64(32)).astype(np.uint32)


def sketch(codes: np.ndarray) -> np.ndarray:
    """One 16-bit hash per tuple: the ORDER k-mers with the smallest values, in the order of the text.

    A text without k-mers has its own constant fingerprint.
    """
    h = kmers(codes)
    x = numbered(h)
    best_v = np.full((SKETCHES, ORDER), 2**33, np.int64)
    best_p = np.full((SKETCHES, ORDER), -1, np.int64)
    rows = np.arange(SKETCHES)
    for at in range(0, len(x), _PART):
        y = x[at:at + _PART][None, :] * _FACTORS[:, None] + _SHIFTS[:, None]
        v, p = [best_v], [best_p]
        for j in range(min(ORDER, y.shape[1])):
            i = y.argmin(1)
            v.append(y[rows, i].astype(np.int64)[:, None])
            p.append((at + i)[:, None])
            y[rows, i] = np.uint32(2**32 - 1)
        v, p = np.concatenate(v, 1), np.concatenate(p, 1)
        keep = np.lexsort((p, v))[:, :ORDER]
        best_v, best_p = np.take_along_axis(v, keep, 1), np.take_along_axis(p, keep, 1)
    places = np.sort(np.where(best_v < 2**33, best_p, -1), 1)
    out = np.zeros(SKETCHES, np.uint64)
    for j in range(ORDER):
        part = np.where(places[:, j] >= 0, h[places[:, j]] if len(h) else np.uint64(0), np.uint64(0))
        out = _mix(out * np.uint64(31) + part + np.uint64(j))
    return (out >> np.uint64(48)).astype(np.uint16)


def fingerprint(text: str) -> np.ndarray:
    return sketch(np.frombuffer(text.encode("utf-32-le"), np.uint32))


def _hex(s: np.ndarray) -> str:
    return s.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal tuples."""
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the following text."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


_OUT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_NAMES = [n for n, _ in _OUT]
_OUT_SQL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double")


def _row(doc_id, text: str, own: np.ndarray, following: str, next_sketch: np.ndarray) -> tuple:
    e = edited(text, following)
    s = fingerprint(e)
    return (doc_id, len(text), hashlib.sha256(e.encode()).hexdigest(), _hex(own), _hex(s), likeness(own, s),
            likeness(own, next_sketch))


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    c = zstandard.ZstdCompressor(level=1)
    for b in small_batches(batches, 1024):
        raw = [t.encode() for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([xxhash.xxh64_intdigest(r) - 2**63 for r in raw], pa.int64()),
                                          pa.array([c.compress(r) for r in raw], pa.binary())], names=["doc_id", "h", "z"])


def _text(z: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(z).decode()


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all documents of a partition but the last, whose next one lies in another partition; the
    first and the last one go out as they are (edge 1 and 2)."""
    part = TaskContext.get().partitionId()
    schema = pa.schema([("part", pa.int32()), ("edge", pa.int32()), ("z", pa.binary()), *_OUT])

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    held = None
    for b in small_batches(batches, 64):
        rows = []
        for doc_id, z in zip(b.column("doc_id").to_pylist(), b.column("z").to_pylist()):
            text = _text(z)
            s = fingerprint(text)
            if held is None:
                rows.append((part, 1, z, doc_id, *[None] * 6))
            else:
                rows.append((part, 0, None, *_row(*held[:3], text, s)))
            held = (doc_id, text, s, z)
        if rows:
            yield out(rows)
    if held is not None:
        yield out([(part, 2, held[3], held[0], *[None] * 6)])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in b.to_pylist():
            text, following = _text(r["z"]), _text(r["next_z"])
            row = _row(r["doc_id"], text, fingerprint(text), following, fingerprint(following))
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip(row, _OUT)], names=_NAMES)


def compare_with_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edit, and their likeness; and that with the next text.

    The next document is the next smaller id; after the smallest comes the largest.  Rows that repeat an id
    follow each other by a hash of their text, rows without id come last.  Null text: empty.  One row:
    its own next one.  Empty table: no rows.

    One shuffle deals the (compressed) texts by range of ids.  A partition pairs its own documents; only
    its first and last one meet those of the neighbouring partitions, in a second small step.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("h").desc()]
    dealt = (texts(docs).mapInArrow(_compressed, "doc_id long, h long, z binary")
             .repartitionByRange(n, *order).sortWithinPartitions(*order))
    found = materialize_table(
        dealt.select("doc_id", "z").mapInArrow(_neighbours, f"part int, edge int, z binary, {_OUT_SQL}"), "order-minhash")
    first = found.where("edge = 1").select(F.col("part").alias("_p"), F.col("z").alias("next_z"))
    last = found.where("edge = 2").select("part", "doc_id", "z")
    # one row per partition: the number that the next non-empty partition has, after the last the first
    follow = Window.orderBy("part")
    parts = (found.where("edge = 2").select("part")
             .withColumn("_p", F.coalesce(F.lead("part").over(follow), F.first("part").over(follow))))
    ends = last.join(parts, "part").join(first, "_p").select("doc_id", "z", "next_z")
    return found.where("edge = 0").select(*_NAMES).unionByName(ends.mapInArrow(_edges, _OUT_SQL))
