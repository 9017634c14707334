"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources get integer quotas of equal-token blocks, each source's quota is apportioned again to shards of
bounded size, and each shard takes its blocks from its documents in a seeded order.
"""

from __future__ import annotations

import re
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import materialize_table, unused

#: ASCII white space separates words.
WORD = r"[^\x20\x09-\x0D]+"
_WORD = re.compile(WORD)


def seeded(*parts: Column | str) -> Column:
    """First 32 bits of an md5 over the parts, as a long: the same on every run and layout."""
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *cols).cast("binary")), 1, 8), 16, 10).cast("bigint")


def targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_repeat: int = 3) -> DataFrame:
    """Adds ``weight, target`` to ``(source, source_size)``.

    Sources in code-point order (null last) take the weights in turn and share the sum of all sizes;
    a target stops at ``max_repeat`` times the source's size and the excess is shared again by weight,
    until none is above.  That fixed point is a common level: targets are ``min(cap, weight * level)``.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("rank", F.row_number().over(order)).withColumn("weight", w.cast("bigint"))
    ranked = ranked.withColumn("cap", F.col("source_size") * max_repeat).withColumn(
        "stop", F.col("cap").cast("double") / F.col("weight"))
    before = Window.orderBy("stop", "rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    ranked = (ranked.withColumn("_c", F.coalesce(F.sum("cap").over(before), F.lit(0)))
              .withColumn("_w", F.coalesce(F.sum("weight").over(before), F.lit(0)))
              .withColumn("_level", (F.sum("source_size").over(whole) - F.col("_c")).cast("double")
                          / (F.sum("weight").over(whole) - F.col("_w"))))
    # the first source, by the level at which it fills, that does not fill sets the level of the rest
    level = F.min(F.when(F.col("stop") >= F.col("_level"), F.struct("stop", "rank", "_level"))).over(whole)
    return (ranked.withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * level["_level"]))
            .select("source", "source_size", "rank", "weight", "target"))


def apportion(parties: DataFrame, votes: str, seats: str, order: str, by: list[str]) -> DataFrame:
    """Adds ``quota``: the ``seats`` of each group ``by`` go to the highest quotients ``votes / (2k + 1)``.

    With n parties, the divisors ``total / (seats ± n/2)`` bracket every quota, so only the quotients
    between the brackets are ranked: a few per party, however many seats there are.  Ties go to the
    smaller ``order``.  Parties without votes get nothing.
    """
    g = Window.partitionBy(*by)
    p = (parties.withColumn("_n", F.count(F.lit(1)).over(g)).withColumn("_t", F.sum(votes).over(g).cast("double"))
         .withColumn("_hi", F.col(seats) - F.col("_n") / 2.0).withColumn("_lo", F.col(seats) + F.col("_n") / 2.0))
    share = F.col(votes).cast("double") / F.col("_t")
    p = (p.withColumn("_base", F.when(F.col("_t") > 0, F.greatest(F.lit(0), F.floor(share * F.col("_hi") + 0.5) - 1))
                      .otherwise(0).cast("bigint"))
         .withColumn("_top", F.when((F.col("_t") > 0) & (F.col(votes) > 0), F.floor(share * F.col("_lo") + 0.5) + 1)
                     .otherwise(0).cast("bigint")))
    p = p.withColumn("_left", F.col(seats) - F.sum("_base").over(g))
    rank = Window.partitionBy(*by).orderBy(F.desc("_q"), F.asc(order), F.asc("_k"))
    won = (p.where("_top > _base").withColumn("_k", F.explode(F.sequence("_base", F.col("_top") - 1)))
           .withColumn("_q", F.col(votes).cast("double") / (2 * F.col("_k") + 1))
           .withColumn("_r", F.row_number().over(rank)).where("_r <= _left")
           .groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], F.col(order).alias("_o"))
           .agg(F.count(F.lit(1)).alias("_won")))
    same = F.col(order) == F.col("_o")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return (p.join(won, same, "left").withColumn("quota", F.col("_base") + F.coalesce("_won", F.lit(0)))
            .drop("_n", "_t", "_hi", "_lo", "_base", "_top", "_left", "_won", "_o",
                  *[f"_g{i}" for i in range(len(by))]))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_repeat: int = 3, block_words: int = 32,
        shard_words: int = 1 << 18, seed: str = "mix", carry: tuple[str, ...] = ()) -> DataFrame:
    """What a mix of the sources takes of each row of ``docs (doc_id, source, text)``.

    Returns ``doc_id, source, size, source_size, target, taken`` and the pieces taken: ``passes`` whole
    copies, words ``[cut_from, cut_to)`` and words ``[0, wrap_to)``.  ``taken`` is at most
    ``max_repeat * size``.  Columns named in ``carry`` come along (under names of none of these).

    A source is cut into shards of about ``shard_words`` words by a seeded hash of the id, so a source
    with a third of all rows spreads over many tasks.  A shard's documents in seeded order form one
    stream of words; its quota takes whole passes over the stream, then consecutive blocks from a
    seeded block on, around the end.  Sums, ranks and windows only; the texts are read once.

    Null text or source: size 0, and a source of its own, sorted last.  Repeated rows are rows like any
    other.  No words at all: targets and taken are 0.  Empty table: no rows.
    """
    sizes = materialize_table(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"), *carry), "mix-sizes")
    src = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeat)
    total = Window.partitionBy()
    src = src.withColumn("_seats", F.floor(F.sum("source_size").over(total) / block_words + 0.5)).withColumn("_all", F.lit(0))
    src = apportion(src, "target", "_seats", "rank", ["_all"])
    src = materialize_table(src.select(
        F.col("source").alias("_source"), "source_size", "target", F.col("quota").alias("_quota"),
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("bigint").alias("_shards")), "mix-sources")

    rows = (sizes.join(src, F.col("source").eqNullSafe(F.col("_source")))
            .withColumn("shard", seeded(seed, "shard", F.col("doc_id")) % F.col("_shards"))
            .withColumn("_key", seeded(seed, "order", F.col("doc_id"))))
    shards = rows.groupBy("source", "shard").agg(F.sum("size").alias("_z"), F.first("_quota").alias("_quota"))
    shards = apportion(shards, "_z", "_quota", "shard", ["source"])
    words = F.least(F.col("quota") * block_words, F.col("_z") * max_repeat)
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_z") / block_words))
    shards = (shards.withColumn("passes", F.when(F.col("_z") > 0, F.floor(words / F.col("_z"))).otherwise(0))
              .withColumn("_part", words - F.col("passes") * F.col("_z"))
              .withColumn("_a", (seeded(seed, "start", F.col("source"), F.col("shard")) % blocks) * block_words)
              .select(F.col("source").alias("_s"), F.col("shard").alias("_h"), "_z", "passes", "_part", "_a"))

    before = (Window.partitionBy("source", "shard").orderBy("_key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    out = rows.withColumn("_c", F.coalesce(F.sum("size").over(before), F.lit(0)))
    out = out.join(shards, F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_h")))
    end = F.col("_c") + F.col("size")
    stop = F.col("_a") + F.col("_part")
    cut_from = F.greatest(F.col("_a") - F.col("_c"), F.lit(0))
    cut_to = F.least(end, stop) - F.col("_c")
    wrap_to = F.greatest(F.least(end, stop - F.col("_z")) - F.col("_c"), F.lit(0))
    out = (out.withColumn("cut_from", cut_from).withColumn("cut_to", F.greatest(cut_to, cut_from))
           .withColumn("wrap_to", wrap_to))
    return out.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("passes") * F.col("size") + F.col("cut_to") - F.col("cut_from") + F.col("wrap_to"))
        .cast("bigint").alias("taken"),
        F.col("passes").cast("bigint").alias("passes"), F.col("cut_from").cast("bigint").alias("cut_from"),
        F.col("cut_to").cast("bigint").alias("cut_to"), F.col("wrap_to").cast("bigint").alias("wrap_to"), *carry)


def mixed(docs: DataFrame, **parameters) -> DataFrame:
    """The mix itself: a row with the columns of ``docs`` for each piece taken, ``text`` cut to its words and
    ``n_chars`` counted anew.  Rows of which nothing is taken are gone; whole copies keep their text as it is.

    Rows are numbered, so that repeated rows stay apart, and written with their numbers: whatever is read twice
    afterwards, by however many executors, carries the same ones.
    """
    row, size, span = (unused(docs, n) for n in ("_row", "_size", "_piece"))
    rows = materialize_table(docs.withColumn(row, F.monotonically_increasing_id()), "mix-rows")
    plan = mix(rows, carry=(row,), **parameters).where("taken > 0")
    piece = lambda a, b: F.struct(F.col(a).alias("a") if a else F.lit(0).cast("bigint").alias("a"), F.col(b).alias("b"))
    pieces = F.concat(F.array_repeat(piece(None, "size"), F.col("passes").cast("int")),
                      F.filter(F.array(piece("cut_from", "cut_to"), piece(None, "wrap_to")), lambda p: p["b"] > p["a"]))
    plan = plan.select(row, F.col("size").alias(size), F.explode(pieces).alias(span))

    @arrow_udf("string")
    def cut(text: pa.Array, a: pa.Array, b: pa.Array, size: pa.Array) -> pa.Array:
        def one(t, i, j, n):
            if i == 0 and j == n:
                return t
            found = islice(_WORD.finditer(t), i, j)
            start = last = next(found)
            for last in found:
                pass
            return t[start.start():last.end()]
        return pa.array([one(*(v.as_py() for v in x)) for x in zip(text, a, b, size)], pa.string())

    out = rows.join(plan, row).withColumn("text", cut("text", f"{span}.a", f"{span}.b", size))
    return out.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


#: The same mix in DuckDB SQL, with the default parameters.
ORACLE_SQL = r"""
WITH sizes AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
               FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM s0),
s2 AS (SELECT *, ([5, 2, 1])[((rank - 1) % 3 + 1)::INT]::BIGINT AS weight, source_size * 3 AS cap FROM s1),
s3 AS (SELECT *, cap::DOUBLE / weight AS stop FROM s2),
s4 AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0))::DOUBLE
                 / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level FROM s3
       WINDOW w AS (ORDER BY stop, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lv AS (SELECT level FROM s4 WHERE stop >= level ORDER BY stop, rank LIMIT 1),
s5 AS (SELECT source, source_size, rank, least(cap::DOUBLE, weight * lv.level) AS target FROM s4, lv),
s6 AS (SELECT *, floor(sum(source_size) OVER () / 32 + 0.5)::BIGINT AS seats, count(*) OVER () AS n,
              sum(target) OVER () AS t FROM s5),
s7 AS (SELECT *, CASE WHEN t > 0 THEN greatest(0, floor(target / t * (seats - n / 2.0) + 0.5) - 1) ELSE 0 END::BIGINT AS base,
              CASE WHEN t > 0 AND target > 0 THEN floor(target / t * (seats + n / 2.0) + 0.5) + 1 ELSE 0 END::BIGINT AS top FROM s6),
s8 AS (SELECT *, seats - sum(base) OVER () AS room FROM s7),
k0 AS (SELECT *, unnest(range(base, top)) AS k FROM s8 WHERE top > base),
k1 AS (SELECT *, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, rank, k) AS r FROM k0),
k2 AS (SELECT rank, count(*) AS won FROM k1 WHERE r <= room GROUP BY rank),
src AS (SELECT s8.source, s8.source_size, s8.target, s8.base + coalesce(k2.won, 0) AS quota,
               greatest(1, ceil(s8.source_size / 262144))::BIGINT AS shards FROM s8 LEFT JOIN k2 USING (rank)),
rs AS (SELECT d.doc_id, d.source, d.size, s.source_size, s.target, s.quota,
              ('0x' || substr(md5('mix:shard:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 8))::BIGINT % s.shards AS shard,
              ('0x' || substr(md5('mix:order:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 8))::BIGINT AS okey
       FROM sizes d JOIN src s ON d.source IS NOT DISTINCT FROM s.source),
h0 AS (SELECT source, shard, sum(size)::BIGINT AS z, any_value(quota) AS seats FROM rs GROUP BY source, shard),
h1 AS (SELECT *, count(*) OVER w AS n, (sum(z) OVER w)::DOUBLE AS t FROM h0 WINDOW w AS (PARTITION BY source)),
h2 AS (SELECT *, CASE WHEN t > 0 THEN greatest(0, floor(z::DOUBLE / t * (seats - n / 2.0) + 0.5) - 1) ELSE 0 END::BIGINT AS base,
              CASE WHEN t > 0 AND z > 0 THEN floor(z::DOUBLE / t * (seats + n / 2.0) + 0.5) + 1 ELSE 0 END::BIGINT AS top FROM h1),
h3 AS (SELECT *, seats - sum(base) OVER (PARTITION BY source) AS room FROM h2),
j0 AS (SELECT *, unnest(range(base, top)) AS k FROM h3 WHERE top > base),
j1 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY z::DOUBLE / (2 * k + 1) DESC, shard, k) AS r FROM j0),
j2 AS (SELECT source, shard, count(*) AS won FROM j1 WHERE r <= room GROUP BY source, shard),
h4 AS (SELECT h3.source, h3.shard, z, least((base + coalesce(won, 0)) * 32, z * 3)::BIGINT AS words
       FROM h3 LEFT JOIN j2 ON h3.source IS NOT DISTINCT FROM j2.source AND h3.shard = j2.shard),
sh AS (SELECT *, CASE WHEN z > 0 THEN words // z ELSE 0 END AS passes,
              (('0x' || substr(md5('mix:start:' || coalesce(source, 'null') || ':' || shard), 1, 8))::BIGINT
               % greatest(1, ceil(z / 32))::BIGINT) * 32 AS a FROM h4),
d0 AS (SELECT rs.*, coalesce(sum(size) OVER (PARTITION BY source, shard ORDER BY okey, doc_id, size
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS c FROM rs),
d1 AS (SELECT d0.*, sh.z, sh.passes, sh.a, sh.words - sh.passes * sh.z AS part,
              greatest(sh.a - c, 0) AS cut_from FROM d0 JOIN sh
       ON d0.source IS NOT DISTINCT FROM sh.source AND d0.shard = sh.shard),
d2 AS (SELECT *, greatest(least(c + size, a + part) - c, cut_from) AS cut_to,
              greatest(least(c + size, a + part - z) - c, 0) AS wrap_to FROM d1)
SELECT doc_id, size, source_size, target, (passes * size + cut_to - cut_from + wrap_to)::BIGINT AS taken FROM d2
"""
