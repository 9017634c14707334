"""Byte-level BPE over a shuffle of distinct words.

Documents are cut into words: runs that end where a pre-token ends (mostly one pre-token each).  A task
numbers the distinct words of a block of documents and notes the positions of each; the words then meet by
bucket, where each distinct word is encoded once, pre-token by pre-token; the ids go back to the block with
the positions, which puts the documents together again.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UNIT, release, small_batches, texts

#: A word that occurs more often than this in a block meets its like by a salted bucket.
HOT = 20_000

WORDS_SCHEMA = ("bucket int, block long, doc_ids binary, doc_nulls binary, doc_words binary, words binary, "
                "lengths binary, counts binary, gaps binary")
IDS_SCHEMA = ("block long, doc_ids binary, doc_nulls binary, doc_words binary, ids binary, n_ids binary, "
              "counts binary, gaps binary")


def _pack(x: np.ndarray) -> bytes:
    """Integers by byte planes under zstandard: the upper planes of small numbers cost next to nothing."""
    x = np.ascontiguousarray(x, f"<u{8 if x.dtype.itemsize == 8 else 4}")
    planes = x.view(np.uint8).reshape(len(x), x.itemsize).T
    return bytes([x.itemsize]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(b[0], -1).T).reshape(-1).view(f"<u{b[0]}")


class _Numbers(dict):
    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def block_words(docs: DataFrame, buckets: int, block_chars: int) -> DataFrame:
    """Rows per block and bucket: the block's distinct words there, and where each one stands.

    One more row per block lists its documents and how many words each has.
    """
    def rows_of(block: int, doc_ids: list, seqs: list[np.ndarray], number: _Numbers) -> Iterator[tuple]:
        ids = np.array([i or 0 for i in doc_ids], np.int64).view(np.uint64)
        null = np.array([i is None for i in doc_ids], np.uint32)
        yield (zlib.crc32(str(block).encode()) % buckets, block, _pack(ids), _pack(null),
               _pack(np.array([len(s) for s in seqs], np.uint32)), None, None, None, None)
        seq = np.concatenate([*seqs, np.zeros(0, np.int32)])
        if not len(seq):
            return
        places = np.argsort(seq, kind="stable").astype(np.int32)
        counts = np.bincount(seq, minlength=len(number))
        starts = np.cumsum(counts) - counts
        gaps = np.diff(places, prepend=np.int32(0))
        gaps[starts] = places[starts]
        del seq, places
        raw = [w.encode() for w in number]
        where = np.array([zlib.crc32(w) for w in raw], np.int64)
        where = (where + np.where(counts > HOT, zlib.crc32(b"%d" % block), 0)) % buckets
        order = np.argsort(where, kind="stable")
        for bucket, members in groupby(order.tolist(), key=lambda i: where[i]):
            m = sorted(members, key=raw.__getitem__)
            n = counts[m]
            pick = np.repeat(starts[m] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield (int(bucket), block, None, None, None, zstandard.ZstdCompressor(level=3).compress(b"".join(raw[i] for i in m)),
                   _pack(np.array([len(raw[i]) for i in m], np.uint32)), _pack(n.astype(np.uint32)),
                   _pack(gaps[pick].astype(np.uint32)))

    names = [c.split()[0] for c in WORDS_SCHEMA.split(", ")]
    schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), *((n, pa.binary()) for n in names[2:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, part, k = UNIT.findall, TaskContext.get().partitionId(), 0
        doc_ids, seqs, number, chars = [], [], _Numbers(), 0

        def flush():
            for row in rows_of((part << 32) + k, doc_ids, seqs, number):
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for b in small_batches(batches):
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                doc_ids.append(doc_id)
                seqs.append(np.fromiter(map(number.__getitem__, find(text)), np.int32))
                chars += len(text)
                if chars >= block_chars:
                    yield from flush()
                    doc_ids, seqs, number, chars, k = [], [], _Numbers(), 0, k + 1
        if doc_ids:
            yield from flush()
        del doc_ids, seqs, number
        release()

    return texts(docs).mapInArrow(run, WORDS_SCHEMA)


_ENCODINGS: dict[str, object] = {}


def encode_words(rows: DataFrame, ranks_file: bytes, pattern: str) -> DataFrame:
    """Each bucket's distinct words encoded once, in whatever block they stand; the positions ride along."""
    shared = rows.sparkSession.sparkContext.broadcast(ranks_file)  # a vocabulary: it does not grow with the data
    names = [c.split()[0] for c in IDS_SCHEMA.split(", ")]
    schema = pa.schema([("block", pa.int64()), *((n, pa.binary()) for n in names[1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hashlib.md5(shared.value + pattern.encode()).hexdigest()
        if key not in _ENCODINGS:
            import tiktoken
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
            _ENCODINGS[key] = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        encode, bucket, known = _ENCODINGS[key].encode_ordinary, None, {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["bucket"] != bucket:
                    bucket, known = r["bucket"], {}
                ids = n_ids = None
                if r["words"] is not None:
                    ends = np.cumsum(_unpack(r["lengths"]), dtype=np.int64).tolist()
                    raw = zstandard.ZstdDecompressor().decompress(r["words"])
                    got, s = [], 0
                    for e in ends:
                        w, s = raw[s:e], e
                        x = known.get(w)
                        if x is None:
                            known[w] = x = tuple(encode(w.decode()))
                        got.append(x)
                    ids = _pack(np.fromiter((i for x in got for i in x), np.uint32))
                    n_ids = _pack(np.fromiter(map(len, got), np.uint32, len(got)))
                values = [r["block"], r["doc_ids"], r["doc_nulls"], r["doc_words"], ids, n_ids, r["counts"], r["gaps"]]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    return rows.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(run, IDS_SCHEMA)


def reassemble(rows: DataFrame) -> DataFrame:
    """``doc_id, ids`` of every document, put together by position from its block's rows."""
    def block_docs(parts: list[dict]) -> Iterator[pa.RecordBatch]:
        head = next(p for p in parts if p["doc_ids"] is not None)
        doc_ids = pa.array(_unpack(head["doc_ids"]).view(np.int64), mask=_unpack(head["doc_nulls"]).astype(bool))
        words = _unpack(head["doc_words"]).astype(np.int64)
        total = int(words.sum())
        size, first = np.zeros(total, np.int32), np.zeros(total, np.int32)
        tables, at = [], 0
        for p in parts:
            if p["ids"] is None:
                continue
            ids, n_ids = _unpack(p["ids"]).astype(np.int32), _unpack(p["n_ids"]).astype(np.int64)
            counts, gaps = _unpack(p["counts"]).astype(np.int64), _unpack(p["gaps"]).astype(np.int64)
            run = np.cumsum(gaps)
            s = np.cumsum(counts) - counts
            places = run - np.repeat(run[s] - gaps[s], counts)
            size[places] = np.repeat(n_ids, counts)
            first[places] = np.repeat(at + np.cumsum(n_ids) - n_ids, counts)
            tables.append(ids)
            at += len(ids)
        flat = np.concatenate([*tables, np.zeros(0, np.int32)])
        ends = np.cumsum(words)
        for i in range(0, len(words), 256):  # some documents at a time
            j = min(i + 256, len(words))
            a, b = int(ends[i] - words[i]), int(ends[j - 1])
            n = size[a:b].astype(np.int64)
            up = np.concatenate([[0], np.cumsum(n)])
            ids = flat[np.repeat(first[a:b].astype(np.int64) - up[:-1], n) + np.arange(up[-1])]
            offsets = up[np.concatenate([[a], ends[i:j]]) - a].astype(np.int32)
            yield pa.RecordBatch.from_arrays([doc_ids.slice(i, j - i), pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(ids))], names=["doc_id", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist())
        for _, parts in groupby(rows, key=lambda r: r["block"]):
            yield from block_docs(list(parts))
            release()

    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(run, "doc_id long, ids array<int>")


def encode(docs: DataFrame, ranks_path: str, pattern: str, block_chars: int = 32 << 20) -> DataFrame:
    """``doc_id, ids`` for every row of ``docs (doc_id, text)``: the ranks' ids of each match of ``pattern``,
    one of the byte-level patterns that keep letters, digits, other signs and white space apart.

    Null text: empty, no ids.  Repeated rows: a row each.  Rows without id keep their null.  Empty table:
    no rows.  A document is never cut; a block is at least one document.
    """
    with open(ranks_path, "rb") as f:
        ranks_file = f.read()
    buckets = max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return reassemble(encode_words(block_words(docs, buckets, block_chars), ranks_file, pattern))


class ByteTable:
    """The bytes of every token, end to end."""

    def __init__(self, ranks: dict[bytes, int]):
        by_id = [b""] * (max(ranks.values(), default=0) + 1)
        for raw, i in ranks.items():
            by_id[i] = raw
        self.size = np.array([len(x) for x in by_id], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(by_id), np.uint8)

    def join(self, ids: np.ndarray) -> bytes:
        n = self.size[ids]
        up = np.cumsum(n)
        return self.flat[np.repeat(self.start[ids] - (up - n), n) + np.arange(int(n.sum()))].tobytes()


def _documents(b: pa.RecordBatch) -> Iterator[np.ndarray]:
    ids = b.column("ids")
    flat, off = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    return (flat[i:j] for i, j in zip(off[:-1], off[1:]))


def decode(tokens: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, decoded`` (binary): the token-byte table, as large as the vocabulary, joined by id in order."""
    shared = tokens.sparkSession.sparkContext.broadcast(ByteTable(ranks_of(ranks_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            out = [shared.value.join(x) for x in _documents(b)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "decoded"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def digests(tokens: DataFrame, ranks_path: str, keep_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of ``tokens (doc_id, ids)`` and the bytes they decode to;
    ``keep_ids``: and ``ids``."""
    shared = tokens.sparkSession.sparkContext.broadcast(ByteTable(ranks_of(ranks_path)))
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                        ("decoded_sha256", pa.string())] + [("ids", pa.list_(pa.int32()))] * keep_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            rows = [(len(x), hashlib.sha256(x.astype("<u4").tobytes()).hexdigest(),
                     hashlib.sha256(shared.value.join(x)).hexdigest()) for x in _documents(b)]
            columns = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(list(schema)[1:4])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns, *[b.column("ids")] * keep_ids], schema=schema)

    return tokens.select("doc_id", "ids").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    return digests(encode(docs, ranks_path, pattern), ranks_path, keep_ids)
