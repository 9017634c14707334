"""A GeoJSON FeatureCollection read by many tasks: one document, however large, is cut at its objects.

A scan takes the file as pieces that end with ``}`` (Spark's text reader, so byte ranges of one file go to many
tasks) and packs them into blocks.  Whether a block starts inside a string, and how deep, follows from the quotes
and braces of the blocks before it: each block says what it does to either state, and running sums over these
few numbers give every block its start.  Then each block cuts its own objects out; what crosses blocks is joined.

The blocks are written once, to the shared checkpoint folder: a second scan could split the files otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

_BLOCKS = "path string, start long, seq long, quotes int, outside int, inside int, body binary"
_PIECES = "path string, start long, seq long, at int, opens boolean, key string, piece string"
_ORDER = ("path", "start", "seq")
_STRING = re.compile(r'"((?:[^"\\]|\\.)*)"\s*(:?)', re.S)


def _marks(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the quotes that delimit strings, places of the braces, and their steps (+1, -1)."""
    b = np.frombuffer(body, np.uint8)
    quotes = np.flatnonzero(b == ord('"'))
    if len(quotes) and (back := b == ord("\\")).any():
        # a quote is escaped where an odd run of backslashes ends before it
        plain = np.flatnonzero(~back)
        last = np.searchsorted(plain, quotes) - 1
        run = quotes - 1 - np.where(last >= 0, plain[np.maximum(last, 0)], -1)
        quotes = quotes[run % 2 == 0]
    braces = np.flatnonzero((b == ord("{")) | (b == ord("}")))
    return quotes, braces, np.where(b[braces] == ord("{"), 1, -1)


def _block(path: str, start: int, seq: int, body: bytes) -> tuple:
    quotes, braces, step = _marks(body)
    odd = np.searchsorted(quotes, braces) % 2 == 1
    return path, start, seq, len(quotes) % 2, int(step[~odd].sum()), int(step[odd].sum()), body


def text_blocks(spark: SparkSession, path: str, block_bytes: int) -> DataFrame:
    """``path, start, seq, quotes, outside, inside, body``: whole files as blocks of about ``block_bytes``.

    ``quotes`` is the parity of the quotes in the block, ``outside`` and ``inside`` what its braces add to the depth
    if it starts outside or inside a string.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _BLOCKS.split(", ")]
        types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        place, seq, parts, size = None, 0, [], 0

        def flush():
            row = _block(*place, seq, b"".join(parts))
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            rows = zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(),
                       batch.column("value").cast(pa.binary()).to_pylist())
            for p, s, text in rows:
                if parts and ((p, s) != place or size >= block_bytes):
                    yield flush()
                    parts, size = [], 0
                    seq += 1
                if (p, s) != place:
                    place, seq = (p, s), 0
                parts += [text, b"}"]
                size += len(text) + 1
        if parts:
            yield flush()

    scan = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
    return scan.mapInArrow(pack, _BLOCKS)


def _with_starts(blocks: DataFrame) -> DataFrame:
    """Blocks with ``quoted`` (they start inside a string) and ``depth`` (of braces, at their start)."""
    before = Window.partitionBy("path").orderBy("start", "seq").rowsBetween(Window.unboundedPreceding, -1)
    small = blocks.select(*_ORDER, "quotes", "outside", "inside")
    small = small.withColumn("quoted", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    step = F.when(F.col("quoted"), F.col("inside")).otherwise(F.col("outside"))
    small = small.withColumn("depth", F.coalesce(F.sum(step).over(before), F.lit(0)))
    return blocks.select(*_ORDER, "body").join(small.select(*_ORDER, "quoted", "depth"), list(_ORDER))


def _member(gap: bytes, quoted: bool) -> str | None:
    """The member of the document that the object after ``gap`` belongs to; ``None``: that of the object before.

    The tail of a string that an earlier block began is no name to go by, but ends the member before it.
    """
    text, key = gap.decode("utf-8", "replace"), None
    if quoted:
        tail = re.match(r'(?:[^"\\]|\\.)*"\s*(:?)', text, re.S)
        if not tail:
            return None
        key, text = ("" if tail[1] else None), text[tail.end():]
    for m in _STRING.finditer(text):
        key = m[1] if m[2] else key
    return key


def _cut(body: bytes, quoted: bool, depth: int) -> list[tuple[int, bool, str | None, str | None]]:
    """``at, opens, key, piece`` of a block: its objects at depth 2, whole or in part, in order.

    ``at`` 0 goes on with an object of an earlier block.  A last row without a piece tells the member that the
    block ends in.
    """
    quotes, braces, step = _marks(body)
    free = (np.searchsorted(quotes, braces) + quoted) % 2 == 0
    braces, step = braces[free], step[free]
    after = depth + np.cumsum(step)
    opens = braces[(step == 1) & (after == 2)]
    closes = braces[(step == -1) & (after == 1)] + 1
    out, at, gap = [], 0, 0
    if depth >= 2:
        gap = int(closes[0]) if len(closes) else len(body)
        out.append((0, False, None, body[:gap].decode("utf-8", "replace")))
        closes = closes[1:]
    inside = lambda place: bool((np.searchsorted(quotes, place) + quoted) % 2)
    for i, begin in enumerate(opens.tolist()):
        key = _member(body[gap:begin], inside(gap))
        at += 1
        gap = int(closes[i]) if i < len(closes) else len(body)
        out.append((at, True, key, body[begin:gap].decode("utf-8", "replace")))
    if len(opens) == len(closes):
        out.append((at + 1, False, _member(body[gap:], inside(gap)), None))
    return out


def document_objects(spark: SparkSession, path: str, members: tuple[str, ...] = ("features", "crs"),
                     block_bytes: int = 1 << 18) -> DataFrame:
    """``path, key, pos, text``: the objects that the ``members`` of each document hold, as text; ``pos`` counts a
    member's objects from 0.

    A member holds an object or an array of objects.  Braces and quotes inside strings are text.  An empty file
    has no rows; an object that the file does not close comes as far as it goes.  One object is one row.
    """
    kept = scratch_path(spark, "geojson-blocks")
    text_blocks(spark, path, block_bytes).write.parquet(kept)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                got = _cut(r["body"], r["quoted"], r["depth"])
                if got:
                    at, opens, key, piece = zip(*got)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r["path"]] * len(got), pa.string()), pa.array([r["start"]] * len(got), pa.int64()),
                         pa.array([r["seq"]] * len(got), pa.int64()), pa.array(at, pa.int32()), pa.array(opens, pa.bool_()),
                         pa.array(key, pa.string()), pa.array(piece, pa.string())],
                        names=[c.split()[0] for c in _PIECES.split(", ")])

    pieces_at = scratch_path(spark, "geojson-pieces")
    _with_starts(spark.read.parquet(kept)).mapInArrow(cut, _PIECES).write.parquet(pieces_at)
    pieces = spark.read.parquet(pieces_at)
    # a row that names no member goes on with the last one named: first inside its block, then in earlier blocks
    in_block = Window.partitionBy(*_ORDER).orderBy("at")
    local = F.last("key", True).over(in_block)
    before = Window.partitionBy("path").orderBy("start", "seq").rowsBetween(Window.unboundedPreceding, -1)
    ends = pieces.groupBy(*_ORDER).agg(F.max_by("key", F.when(F.col("key").isNotNull(), F.col("at"))).alias("_last"))
    ends = ends.select(*_ORDER, F.last("_last", True).over(before).alias("_before"))
    named = (pieces.withColumn("key", local).join(ends, list(_ORDER))
             .withColumn("key", F.coalesce("key", "_before")).drop("_before")
             .where(F.col("piece").isNotNull() & F.col("key").isin(*members)))
    # numbers: objects of the member opened in earlier blocks, and before this one in its block
    opened = named.groupBy(*_ORDER, "key").agg(F.sum(F.col("opens").cast("long")).alias("_n"))
    earlier = Window.partitionBy("path", "key").orderBy("start", "seq").rowsBetween(Window.unboundedPreceding, -1)
    opened = opened.select(*_ORDER, "key", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    here = Window.partitionBy(*_ORDER, "key").orderBy("at")
    pos = F.col("_base") + F.sum(F.col("opens").cast("long")).over(here) - 1
    placed = named.join(opened, [*_ORDER, "key"]).withColumn("pos", pos)
    # what crosses blocks is put together; an object whole in its block need not be shuffled again
    crosses = Window.partitionBy(*_ORDER)
    placed = placed.withColumn("_edge", ~F.col("opens") | (F.col("at") == F.max("at").over(crosses)))
    whole = placed.where(~F.col("_edge")).select("path", "key", "pos", F.col("piece").alias("text"))
    parts = placed.where("_edge").groupBy("path", "key", "pos").agg(
        F.array_sort(F.collect_list(F.struct("start", "seq", "piece"))).alias("_p"))
    joined = parts.select("path", "key", "pos", F.array_join(F.transform("_p", lambda p: p["piece"]), "").alias("text"))
    return whole.unionByName(joined)
