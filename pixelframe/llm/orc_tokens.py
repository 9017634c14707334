"""Token ids as ORC files: integer run lengths, row-group indexes and Bloom filters on the document id."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .bpe import _Numbers
from .common import UNIT, small_batches, texts

FILE_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"
_ARROW_FILE = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("part_start", pa.int64()),
                         ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])


class UnitEncoder:
    """Ids of a text from the ids of its units; a unit met again costs one lookup.

    The units of a worker process are kept between tasks, at most ``keep`` of them (then it starts anew).
    """

    def __init__(self, tokenizer_json: str, keep: int = 700_000):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_str(tokenizer_json)
        self.tok.encode_special_tokens = True  # a special token's string in a text is ordinary text
        self.keep = keep
        self._reset()

    def _reset(self) -> None:
        self.number = _Numbers()
        self.ids = np.zeros(1 << 20, np.int32)
        self.start = np.zeros(1 << 18, np.int64)  # start[i]: where the ids of unit i begin; start[i + 1]: where they end
        self.known = 0

    def _learn(self, new: list[str], at_once: int = 1000) -> None:
        """Ids of units numbered but not yet known: each is a text of its own, many go through one call."""
        for i in range(0, len(new), at_once):
            units = new[i:i + at_once]
            got = self.tok.encode(units, is_pretokenized=True, add_special_tokens=False)
            lens = np.bincount(np.array(got.word_ids, np.int64), minlength=len(units))
            n, m = self.known, self.known + len(units)
            while m + 1 > len(self.start):
                self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.start[n + 1:m + 1] = self.start[n] + np.cumsum(lens)
            while self.start[m] > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.start[n]:self.start[m]] = got.ids
            self.known = m

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the batch, and how many each text has."""
        if len(self.number) > self.keep:
            self._reset()
        find, number = UNIT.findall, self.number.__getitem__
        seqs = [np.fromiter(map(number, find(t)), np.int32) for t in batch]  # numbers what it meets for the first time
        if len(self.number) > self.known:
            new = list(islice(reversed(self.number), len(self.number) - self.known))
            self._learn(new[::-1])
        which = np.concatenate([*seqs, np.zeros(0, np.int32)])
        lens = self.start[which + 1] - self.start[which]
        at = np.concatenate([[0], np.cumsum(lens)])
        ids = self.ids[np.repeat(self.start[which] - at[:-1], lens) + np.arange(at[-1])]
        ends = np.cumsum([0, *map(len, seqs)])
        return ids, np.diff(at[ends])


_ENCODERS: dict[int, UnitEncoder] = {}


def _encoder(tokenizer_json: str) -> UnitEncoder:
    key = zlib.crc32(tokenizer_json.encode())
    if key not in _ENCODERS:
        _ENCODERS[key] = UnitEncoder(tokenizer_json)
    return _ENCODERS[key]


def encode(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Rows of the files: ``doc_id, part, part_start, n_tokens, ids`` in ascending document order.

    Range partitions by id (the text's hash spreads a repeated id), sorted inside; ``part`` numbers the
    partitions in order and ``part_start`` counts the ids before the document in its part.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:  # a vocabulary: its size does not grow with the data
        vocabulary = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, at = _encoder(vocabulary.value), TaskContext.get().partitionId(), 0
        for b in small_batches(batches):
            ids, n = enc.encode(b.column("text").to_pylist())
            ends = np.cumsum(n + 1)
            out = np.insert(ids, np.cumsum(n), np.int32(end_id)).astype(np.int32)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), pa.array(np.full(b.num_rows, part, np.int32)), pa.array(at + ends - n - 1),
                pa.array(n + 1), pa.ListArray.from_arrays(pa.array(offsets), pa.array(out))], schema=_ARROW_FILE)
            at += int(ends[-1])

    t = texts(docs)
    ordered = (t.withColumn("_h", F.xxhash64("text")).repartitionByRange("doc_id", "_h")
               .sortWithinPartitions("doc_id", "_h").select("doc_id", "text"))
    return ordered.mapInArrow(run, FILE_SCHEMA)


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, stripe_bytes: int = 64 << 20,
          index_rows: int = 1000) -> None:
    """Write the token files.  Integers are run-length encoded per stripe; each ``index_rows`` rows have
    minima, maxima and a Bloom filter of ``doc_id``, so that a reader skips what a filter on it rules out."""
    (encode(docs, tokenizer_path, end_id).write.format("orc").option("compression", "zstd")
     .option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", index_rows)
     .option("orc.create.index", "true").option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", "0.01").save(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows, split by stripe over the tasks; filters on ``doc_id`` reach the stripes' metadata."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small_batches(batches, 1024):
        ids = b.column("ids")
        flat, off = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy()
        crc = [zlib.crc32(flat[i:j].tobytes()) for i, j in zip(off[:-1], off[1:])]
        yield pa.RecordBatch.from_arrays(
            [b.column(c) for c in ("doc_id", "part", "part_start", "n_tokens")] + [pa.array(crc, pa.int64())],
            names=["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])


def digests(files: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of token files.

    ``start`` is the part's base plus the place in the part; the bases are a running sum over one row per
    part file, whose number Spark's partitioning sets.
    """
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    rows = files.mapInArrow(_crc, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long")
    return rows.join(F.broadcast(bases), "part").select(  # one row per part file
        "doc_id", (F.col("_base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")


def write_and_digest(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Encode whole texts, write the files into the shared folder, and describe what they hold.

    Null text: empty, only the end id.  Repeated ids: a row each, ordered by the text's hash.  A null id
    sorts first.  Empty table: no rows.  Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens") + ".orc"
    write(docs, path, tokenizer_path)
    return digests(read(spark, path))
