"""SimHash near-duplicates found through tables of distances to reference fingerprints."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, materialize_table, small_batches, texts, unused

#: Bits are cut into BLOCKS blocks; a key holds SHARED of them.  Up to BLOCKS - SHARED differing bits leave
#: SHARED blocks untouched, so any two linked fingerprints agree on the distances of some key.
BLOCKS, SHARED = 6, 2
#: Reference fingerprints: fixed random words.
REFERENCES = np.random.default_rng(64).integers(0, 2**64, 24, np.uint64, endpoint=False)
#: Of these many references the full distances travel with a fingerprint, one byte each.
COORDINATES = 8
#: Rows of one key that a task compares at once; longer runs are cut into pairs of chunks.
RUN_ROWS = 1 << 15


def fingerprint(text: str, shingle: int = 4, seed: int = 42) -> int:
    """Majority of the bits of the XXH64 of every word shingle; 0 if there is no word."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    hashes = [h(b" ".join(words[i:i + shingle]), seed) for i in range(max(1, len(words) - shingle + 1))]
    total = 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[i:i + (1 << 14)], "<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += len(part)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 4, hashed: bool = False) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) of every row; null text: 0.  ``hashed``: with the
    text's hash as ``h``."""
    rows = texts(docs).withColumn("h", F.xxhash64("text")) if hashed else texts(docs)
    names = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(fp.view(np.int64))], names=[*names, "fp"])

    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in [*names, "fp"]))


def _masks(blocks: int) -> list[np.uint64]:
    edges = np.linspace(0, 64, blocks + 1).round().astype(int)
    return [np.uint64(sum(1 << i for i in range(a, b))) for a, b in zip(edges[:-1], edges[1:])]


def distance_keys(fps: np.ndarray, blocks: int, shared: int) -> np.ndarray:
    """Keys (rows × combinations): a hash of a fingerprint's distances to all references inside the blocks.

    Fingerprints that agree on a block have equal distances there.
    """
    from itertools import combinations
    mix = np.random.default_rng(65).integers(0, 2**64, (blocks, len(REFERENCES)), np.uint64, endpoint=False)
    per_block = []
    for b, mask in enumerate(_masks(blocks)):
        d = np.bitwise_count((fps[:, None] ^ REFERENCES) & mask).astype(np.uint64)
        per_block.append((d * mix[b]).sum(1, dtype=np.uint64))
    combos = list(combinations(range(blocks), shared))
    keys = np.stack([sum((per_block[b] for b in c), np.uint64(n * 0x9E3779B97F4A7C15 % 2**64))
                     for n, c in enumerate(combos)], 1)
    return keys ^ (keys >> np.uint64(29))


def pivot_table(fps: DataFrame, blocks: int = BLOCKS, shared: int = SHARED) -> DataFrame:
    """``key, fp, coords``: a row per distinct fingerprint and key, with its distances to the first references."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, 4096):
            fp = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            keys = distance_keys(fp, blocks, shared)
            coords = np.bitwise_count(fp[:, None] ^ REFERENCES[:COORDINATES]).astype(np.uint8).view(np.int64)[:, 0]
            k = keys.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)),
                                              pa.array(np.repeat(fp.view(np.int64), k)),
                                              pa.array(np.repeat(coords, k))], names=["key", "fp", "coords"])

    return fps.mapInArrow(run, "key long, fp long, coords long")


def forest(fp: np.ndarray, coords: np.ndarray, bits: int) -> tuple[list[int], list[int]]:
    """Spanning links of the fingerprints of one run: enough to connect all that are linked, never all pairs.

    Each step compares one fingerprint with those not yet reached: first the largest difference of their
    distances to the references, which is never above the distance itself, then the bits.
    """
    a, b = [], []
    left = np.arange(len(fp))
    while len(left) > 1:
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            i = todo.pop()
            near = np.abs(coords[left] - coords[i]).max(1) <= bits
            near[near] = np.bitwise_count(fp[left[near]] ^ fp[i]) <= bits
            new = left[near]
            if len(new):
                a += [i] * len(new)
                b += new.tolist()
                todo += new.tolist()
                left = left[~near]
    return a, b


def links(fps: DataFrame, bits: int = 4, blocks: int = BLOCKS, shared: int = SHARED,
          run_rows: int = RUN_ROWS) -> DataFrame:
    """``a, b``: links between distinct fingerprints that connect what ``bits`` or fewer differing bits connect.

    Runs of one key above ``run_rows`` are cut into chunks by a hash; each pair of chunks is a run of its
    own, so no task gathers a whole hot key and no pair is missed.
    """
    if blocks - shared < bits:
        raise ValueError("blocks - shared must be at least bits, or links would be missed")
    rows = materialize_table(pivot_table(fps, blocks, shared), "simhash-pivots")
    heavy = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
             .withColumn("_chunks", F.ceil(F.col("_n") / run_rows).cast("int")).drop("_n"))
    c, me = F.col("_chunks"), F.pmod(F.xxhash64("fp"), F.col("_chunks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), c - 1), lambda j: F.least(j, me) * c + F.greatest(j, me))
    runs = (rows.join(heavy, "key").select("key", "fp", "coords", F.explode(pairs).alias("pair"))
            .repartition("key", "pair").sortWithinPartitions("key", "pair", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a, b):
            return pa.RecordBatch.from_arrays([pa.array(np.asarray(a, np.uint64).view(np.int64)),
                                               pa.array(np.asarray(b, np.uint64).view(np.int64))], names=["a", "b"])

        def solve(x: np.ndarray) -> Iterator[pa.RecordBatch]:
            cut = np.flatnonzero((np.diff(x[:, 0]) != 0) | (np.diff(x[:, 1]) != 0)) + 1
            edges = np.concatenate([[0], cut, [len(x)]])
            fp = x[:, 2].view(np.uint64)
            coords = np.ascontiguousarray(x[:, 3]).view(np.uint8).reshape(-1, COORDINATES).astype(np.int16)
            size = np.diff(edges)
            two = edges[:-1][size == 2]
            two = two[np.abs(coords[two] - coords[two + 1]).max(1, initial=0) <= bits]
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= bits]
            yield out(fp[two], fp[two + 1])
            for s, n in zip(edges[:-1][size > 2], size[size > 2]):
                f = fp[s:s + n]
                a, b = forest(f, coords[s:s + n], bits)
                if a:
                    yield out(f[a], f[b])

        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
                          for n in ("key", "pair", "fp", "coords")], 1)
            # the last run of a batch may go on in the next one
            last = np.flatnonzero((x[:, 0] != x[-1, 0]) | (x[:, 1] != x[-1, 1]))
            at = int(last[-1]) + 1 if len(last) else 0
            if at == 0 and held and (held[-1][-1, :2] == x[0, :2]).all():
                held.append(x)
                continue
            if held:
                yield from solve(np.concatenate([*held, x[:at]]))
            elif at:
                yield from solve(x[:at])
            held = [x[at:]]
        if held:
            yield from solve(np.concatenate(held))

    return runs.mapInArrow(run, "a long, b long").distinct()


def _labelled(distinct: DataFrame, bits: int) -> DataFrame:
    """``distinct (fp, ..)`` with the smallest fingerprint of each one's group as ``label``."""
    labels = connected_components(links(distinct.select("fp"), bits))
    return (distinct.join(labels.withColumnRenamed("id", "fp"), "fp", "left")
            .withColumn("label", F.coalesce("label", "fp")))


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs (doc_id, text)``.

    ``component_id`` is the smallest id reachable over fingerprints that differ in at most ``bits`` bits,
    the row's own included.  Equal fingerprints are one vertex, so copies cost nothing.  Null, empty or
    blank text: fingerprint zero, linked like any other.  A row without id belongs to its component
    (null only if no row there has an id) and never names one.  Repeated rows: a row each.
    """
    own = materialize_table(fingerprints(docs, shingle), "simhash-fp")
    low = _labelled(own.groupBy("fp").agg(F.min("doc_id").alias("low")), bits)
    least = low.groupBy("label").agg(F.min("low").alias("component_id"))
    return (own.join(low.join(least, "label").select("fp", "component_id"), "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, shingle: int = 4, bits: int = 4) -> DataFrame:
    """Exactly one row of ``docs`` of each group of near-duplicates, all columns as they were.

    It is the one with the smallest id, a row without id only where no row of the group has one; of rows that
    repeat an id, the one with the smallest text hash.
    """
    own = materialize_table(fingerprints(docs, shingle, hashed=True), "simhash-fp")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("first")
    groups = _labelled(own.groupBy("fp").agg(first), bits)
    h, rank, own_id, own_h = (unused(docs, n) for n in ("_h", "_rank", "_id", "_own"))
    keep = groups.groupBy("label").agg(F.min("first").alias("first")).select(
        F.col("first.doc_id").alias(own_id), F.col("first.h").alias(own_h))
    rows = docs.withColumn(h, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(own_id)) & (F.col(h) == F.col(own_h))
    # rows alike in id and text
    copies = Window.partitionBy(F.col("doc_id").cast("bigint"), h).orderBy(h)
    return (rows.join(keep, same, "left_semi").withColumn(rank, F.row_number().over(copies))
            .where(F.col(rank) == 1).drop(rank, h))
