"""Shards by a hierarchical weighted hash tree: regions hold racks, racks hold shards.

A row descends from level to level.  At each node every child draws ``-ln(u) / weight``, with ``u`` hashed
from the row's key and the child's path, and the smallest draw wins: a child is drawn in proportion to
its weight, the sum of the shards below it.  A draw depends on nothing but the key, the path and that weight,
so when weights change, rows move only into subtrees that gained and out of subtrees that lost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize_table, number_in_groups, unused

#: Bytes that a row costs beside its text.
ROW_BYTES = 16


@dataclass(frozen=True)
class Tree:
    """``weights[region][rack]`` lists the weights of that rack's shards; 0 drains a shard.

    Shards are numbered in this order.  A tree grows at its end only (:meth:`grown`), so numbers stay.
    """

    weights: tuple[tuple[tuple[float, ...], ...], ...]

    @staticmethod
    def uniform(regions: int = 4, racks: int = 2, shards: int = 5, weight: float = 1.0) -> Tree:
        return Tree((((weight,) * shards,) * racks,) * regions)

    @property
    def n_shards(self) -> int:
        return sum(len(rack) for region in self.weights for rack in region)

    def grown(self, weight: float = 1.0) -> Tree:
        """One more shard, in a region of its own: no other subtree's weight changes, so rows move only into it."""
        return Tree((*self.weights, ((weight,),)))

    def reweighted(self, shard: int, weight: float) -> Tree:
        """The tree in which one shard has another weight, and with it its rack and its region."""
        n, out = 0, []
        for region in self.weights:
            racks = []
            for rack in region:
                racks.append(tuple(weight if n + i == shard else w for i, w in enumerate(rack)))
                n += len(rack)
            out.append(tuple(racks))
        return Tree(tuple(out))

    def levels(self) -> tuple[list, list, list, list]:
        """Weights of the regions, of the racks by region, of the shards by rack, and each rack's first shard."""
        shards = [[list(map(float, rack)) for rack in region] for region in self.weights]
        racks = [[sum(rack) for rack in region] for region in shards]
        firsts, n = [], 0
        for region in shards:
            firsts.append([])
            for rack in region:
                firsts[-1].append(n)
                n += len(rack)
        return [sum(r) for r in racks], racks, shards, firsts


def _literal(x) -> str:
    if isinstance(x, list):
        return f"array({', '.join(map(_literal, x))})"
    return f"{x!r}D" if isinstance(x, float) else f"{x}L"


def draw(key: Column, path: Column, weights: Column) -> Column:
    """The place of the child that wins at a node: ``weights`` of its children, ``path`` of the node as text."""
    def one(w, i):
        h = F.conv(F.substring(F.md5(F.concat_ws(":", key, path, i.cast("string")).cast("binary")), 1, 13), 16, 10)
        u = (h.cast("bigint").cast("double") + 0.5) / F.lit(float(1 << 52))
        return F.struct(F.when(w > 0, -F.log(u) / w).otherwise(F.lit(float("inf"))).alias("d"), i.alias("i"))
    return F.array_min(F.transform(weights, one))["i"]


def descend(df: DataFrame, key: Column, tree: Tree, prefix: str = "") -> DataFrame:
    """Adds ``region, rack, shard`` (names with ``prefix``): the leaf that ``key``, a text, descends to."""
    if not any(w > 0 for region in tree.weights for rack in region for w in rack):
        raise ValueError("no shard has a weight above 0")
    regions, racks, shards, firsts = (F.expr(_literal(x)) for x in tree.levels())
    region, rack, shard = (f"{prefix}{n}" for n in ("region", "rack", "shard"))
    df = df.withColumn(region, draw(key, F.lit("r"), regions))
    df = df.withColumn(rack, draw(key, F.concat(F.lit("k"), F.col(region).cast("string")), F.get(racks, F.col(region))))
    path = F.concat_ws(".", F.lit("s"), F.col(region).cast("string"), F.col(rack).cast("string"))
    leaf = draw(key, path, F.get(F.get(shards, F.col(region)), F.col(rack)))
    return df.withColumn(shard, (F.get(F.get(firsts, F.col(region)), F.col(rack)) + leaf).cast("int"))


def key_of(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.col(id_col).cast("string"), F.lit("null"))


def assign(docs: DataFrame, tree: Tree, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with ``region, rack, shard`` of its ``id_col``; columns of these names are replaced.

    The id alone decides: equal ids share a shard, null ids share one too.  No shuffle, no state.
    """
    key = unused(docs, "_key")
    keyed = docs.drop("region", "rack", "shard").withColumn(key, key_of(id_col))
    return descend(keyed, F.col(key), tree).drop(key)


def place(docs: DataFrame, tree: Tree) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every row of ``docs (doc_id, text)``, and
    ``region, rack``.

    ``size`` is the text's UTF-8 bytes plus 16, ``slot`` the row's place in its shard by
    ``doc_id`` (null first), size and checksum, gapless from 0, ``grown_shard`` the shard under ``tree.grown()``.
    The law is ``key``: the id and the tree decide.  Null text: no bytes.  Repeated rows: a slot each.  Null
    ids: one shard.  Empty table: no rows.  Other columns of ``docs`` are not read.
    """
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         (F.octet_length(raw) + ROW_BYTES).cast("bigint").alias("size"),
                         F.crc32(raw).alias("text_crc32"), key_of().alias("_key"))
    narrow = descend(descend(narrow, F.col("_key"), tree), F.col("_key"), tree.grown(), "grown_").drop("_key")
    out = number_in_groups(materialize_table(narrow, "shards"), "shard", ["doc_id", "size", "text_crc32"], "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard",
                      "region", "rack")


def write(docs: DataFrame, path: str, tree: Tree) -> None:
    """The whole rows as Parquet folders ``region=/rack=/shard=``, which a reader of one subtree prunes to.

    A shard is written by as many tasks as its rows need: rows meet by shard and a hash of the id.
    """
    placed = assign(docs, tree)
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(8))
    placed.repartition("shard", spread).write.partitionBy("region", "rack", "shard").parquet(path)


_U = "(('0x' || substr(md5({k} || ':' || {p} || ':' || i), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0"


def _sql_draw(path: str, weights: str) -> str:
    """A node's draw in DuckDB: the least ``-ln(u) / weight`` among its children."""
    u = _U.format(k="k", p=path)
    return f"list_min(list_transform(range(len({weights})), lambda i: {{'d': -ln({u}) / {weights}[i + 1], 'i': i}})).i"


def oracle_sql(tree: Tree) -> str:
    """The whole of :func:`place` in DuckDB, for trees whose weights are all above 0."""
    def shard_of(name: str, t: Tree, source: str) -> str:
        regions, racks, shards, firsts = (str(x) for x in t.levels())
        return f"""
{name}_r AS (SELECT *, {_sql_draw("'r'", regions)} AS r FROM {source}),
{name}_k AS (SELECT *, {_sql_draw("('k' || r)", f"({racks})[r + 1]")} AS rk FROM {name}_r),
{name}_s AS (SELECT *, {_sql_draw("('s.' || r || '.' || rk)", f"({shards})[r + 1][rk + 1]")} AS sh FROM {name}_k),
{name} AS (SELECT * EXCLUDE (r, rk, sh), (({firsts})[r + 1][rk + 1] + sh)::INTEGER AS {name} FROM {name}_s)"""
    return rf"""
WITH tab AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
               lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
raw AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS k, encode(coalesce(text, '')) AS b FROM documents),
d AS (SELECT doc_id, k, (octet_length(b) + {ROW_BYTES})::BIGINT AS size,
             xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(b), '..'), lambda x: ('0x' || x)::BIGINT)),
                             lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32 FROM raw, tab),
{shard_of("shard", tree, "d").strip()},
{shard_of("grown_shard", tree.grown(), "shard").strip()}
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot FROM grown_shard
"""
