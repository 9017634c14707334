"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

#: Rows that a Python worker turns into objects at once.
BATCH_ROWS = 256


#: White space as Unicode names it, for a character class.
_WS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
#: Units of a text for the byte-level split: they end only where a piece of that split ends as well, which is
#: before white space, after a white-space run less its last character, and between a run of letters and
#: the punctuation after it.  So a text's ids are those of its units in order.
UNIT = re.compile(rf" ?[{_LETTERS}]++(?=[{_WS}.,!?;:|*%$&#]|\Z)| ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``(doc_id, text)``; a null text is the empty text.  Other columns never travel along."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def materialize_table(df: DataFrame, name: str) -> DataFrame:
    """Write once into the shared folder of ``spark.checkpoint.dir`` and reread: cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table of :func:`materialize_table` that nothing reads any more."""
    files = df.inputFiles()
    if files:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def collect_garbage(spark: SparkSession) -> None:
    """Between the rounds of a loop: let the driver drop the plans of rounds that are over.

    Spark removes the shuffles and broadcasts of a plan once the driver's collector has found it dead, which else
    waits until the heap is full (``spark.cleaner.periodicGC.interval`` is half an hour).
    """
    gc.collect()
    spark._jvm.System.gc()


def release() -> None:
    """Give freed memory back to the system, where the C library can: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows, so that Python objects of one slice stay few."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
    release()


def crc_mod(col: Column, m: int) -> Column:
    """``crc32(id as text) mod m``: the fold that the contracts name."""
    return F.crc32(col.cast("string").cast("binary")) % m


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, label)`` for every vertex of ``edges (a, b)``; label is the smallest id reachable.

    Alternating large-star and small-star steps on the edge list alone: each vertex links its larger
    neighbours to the smallest one it sees, until every edge points from a vertex to the root of its
    component.  Rounds grow with the logarithm of the longest path, and a hub never gathers its
    neighbours: the minimum of a neighbourhood is a partial aggregate, joined back.  Every round is
    written to the shared folder, so a lost executor costs one round.  No edges: no rows.
    """
    edges = materialize_table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                           F.least("a", "b").alias("b")).distinct(), "cc")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize_table(large, "cc")
        # small star: the smaller neighbours of a vertex, and the vertex, link to the smallest of them
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(root, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(root.select("a", F.col("m").alias("b"))).distinct())
        new = materialize_table(small, "cc")
        if new.exceptAll(edges).isEmpty() and edges.exceptAll(new).isEmpty():
            return (new.select(F.col("a").alias("id"), F.col("b").alias("label"))
                    .unionByName(new.select(F.col("b").alias("id"), F.col("b").alias("label"))).distinct())
        edges = new


def complete_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of a stream that is sorted by ``key`` (not null), cut anew so that no key goes on in the next one."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        other = np.flatnonzero(k != k[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            held.append(b.slice(0, cut))
        elif held and held[-1].column(key)[-1].as_py() != k[0]:
            cut = -1  # the held run ends here, the whole batch is the next one
        if cut:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
        held.append(b.slice(max(cut, 0)))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def number_in_groups(df: DataFrame, group: str, order: list[str], out: str) -> DataFrame:
    """Adds ``out``: the place, gapless from 0, of a row among those of its ``group`` (not null) by ``order``
    (ascending, nulls first).

    ``order`` has to tell apart all rows that differ in what a reader sees: rows alike in it are dealt over
    the partitions by their place in the input, so that no number of them lands in one task.  Range partitions
    are sorted, each counts its runs of a group, and a group that goes on from earlier partitions, at
    most one a partition, adds what these hold.  The rows are written once, so the places are fixed.
    """
    salt, part, run, base = (unused(df, n) for n in ("_salt", "_part", "_run", "_base"))
    keys = [F.col(group), *[F.asc_nulls_first(c) for c in order], F.col(salt)]
    ranged = (df.withColumn(salt, F.monotonically_increasing_id()).repartitionByRange(*keys)
              .sortWithinPartitions(*keys).drop(salt))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, last, n = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            g = b.column(group).dictionary_encode()
            codes = g.indices.to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(np.diff(codes, prepend=codes[0] - 1))
            if g.dictionary[codes[0]].as_py() != last:
                n = 0
            at = np.arange(b.num_rows) - np.repeat(heads, np.diff(heads, append=b.num_rows))
            at[:heads[1] if len(heads) > 1 else b.num_rows] += n
            last, n = g.dictionary[codes[-1]].as_py(), int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, here, np.int64)),
                                              pa.array(at.astype(np.int64))], names=[*b.schema.names, part, run])

    schema = T.StructType([*ranged.schema.fields, T.StructField(part, T.LongType()), T.StructField(run, T.LongType())])
    rows = materialize_table(ranged.mapInArrow(count, schema), "numbered")
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = (rows.groupBy(group, part).agg(F.count(F.lit(1)).alias(base))
             .withColumn(base, F.sum(base).over(before)).where(F.col(base) > 0))
    return (rows.join(F.broadcast(bases), [group, part], "left")  # at most one row per partition
            .select(*df.columns, (F.col(run) + F.coalesce(base, F.lit(0))).alias(out)))
