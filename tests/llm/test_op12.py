import math
import zlib
from collections import Counter
from hashlib import md5

import pytest
from check_queries import compare

from llm_fixtures import SF_MID, odd_docs  # noqa: F401
from pixelframe.llm import common, sharding
from pixelframe.llm.sharding import Tree


def slow_shard(key, tree):
    """Descend node by node, in plain Python."""
    def pick(path, weights):
        u = [(int(md5(f"{key}:{path}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52 for i in range(len(weights))]
        return min((-math.log(x) / w if w else math.inf, i) for i, (x, w) in enumerate(zip(u, weights)))[1]
    r = pick("r", [sum(map(sum, region)) for region in tree.weights])
    k = pick(f"k{r}", [sum(rack) for rack in tree.weights[r]])
    s = pick(f"s.{r}.{k}", tree.weights[r][k])
    before = sum(len(rack) for region in tree.weights[:r] for rack in region)
    return before + sum(map(len, tree.weights[r][:k])) + s


def test_sql(spark):
    assert compare(spark, SF_MID, ["op12_hash_tree_shards"], verbose=False)["op12_hash_tree_shards"][0] == "OK"


def test_odd_rows(spark, odd_docs):
    tree = Tree((((1.0, 2.5), (0.0, 1.0)), ((3.0,),)))
    rows = sharding.place(odd_docs, tree).collect()
    docs = odd_docs.select("doc_id", "text").collect()
    key = lambda i: "null" if i is None else str(i)
    want = [(r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode()),
             slow_shard(key(r["doc_id"]), tree), slow_shard(key(r["doc_id"]), tree.grown())) for r in docs]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in rows) == Counter(want)
    for s in set(r["shard"] for r in rows):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    again = sharding.place(odd_docs.repartition(1), tree).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    assert all(r["grown_shard"] in (r["shard"], tree.n_shards) for r in rows)


def test_growth_again_and_again_moves_rows_only_into_the_new_shard(spark):
    ids = spark.range(4000).withColumnRenamed("id", "doc_id")
    tree = Tree.uniform(2, 2, 3)
    for _ in range(3):
        a = {r["doc_id"]: r["shard"] for r in sharding.assign(ids, tree).collect()}
        b = {r["doc_id"]: r["shard"] for r in sharding.assign(ids, tree.grown()).collect()}
        moved = [i for i in a if a[i] != b[i]]
        assert all(b[i] == tree.n_shards for i in moved)
        assert abs(len(moved) - 4000 / (tree.n_shards + 1)) < 80
        tree = tree.grown()


def test_a_change_of_weight_stays_in_the_subtrees_it_changes(spark):
    ids = spark.range(8000).withColumnRenamed("id", "doc_id")
    tree = Tree.uniform(3, 2, 2)
    place = lambda t: {r["doc_id"]: (r["region"], r["rack"], r["shard"]) for r in sharding.assign(ids, t).collect()}
    a, b = place(tree), place(tree.reweighted(5, 3.0))  # region 1, rack 0
    moved = [(a[i], b[i]) for i in a if a[i] != b[i]]
    assert moved
    for old, new in moved:
        assert new[0] == 1  # only the region that gained takes rows from others
        if old[0] == 1:
            assert new[1] == 0  # in it, only the rack that gained
            assert old[1] != 0 or new[2] == 5  # in that, only the shard
    counts = Counter(s for _, _, s in b.values())
    assert abs(counts[5] - 8000 * 3 / 14) < 200 and abs(counts[0] - 8000 / 14) < 120
    drained = place(tree.reweighted(5, 0.0))
    assert all(s != 5 for _, _, s in drained.values())


def test_places_of_rows_alike_are_dealt_over_partitions(spark):
    df = spark.createDataFrame([("g", 1)] * 900 + [("h", None)] * 50 + [(x, 2) for x in "abcde"], "g string, v int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = common.number_in_groups(df.repartition(4), "g", ["v"], "n").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for g, n in (("g", 900), ("h", 50), ("a", 1)):
        assert sorted(r["n"] for r in out if r["g"] == g) == list(range(n))


def test_files(spark, tmp_path):
    docs = spark.range(500).selectExpr("id as doc_id", "concat('text ', id) as text")
    tree = Tree.uniform(2, 2, 2)
    sharding.write(docs, str(tmp_path / "shards"), tree)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter((r["doc_id"], r["text"], r["shard"]) for r in back.collect()) == Counter(
        (i, f"text {i}", slow_shard(str(i), tree)) for i in range(500))
    assert "PartitionFilters: [isnotnull(region" in back.where("region = 1")._jdf.queryExecution().toString()


def test_empty_table_and_no_shard(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.place(none, Tree.uniform()).collect() == []
    with pytest.raises(ValueError):
        sharding.assign(none, Tree(()))
