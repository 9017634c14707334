import re

import pytest
from check_queries import compare

from llm_fixtures import SF_MID, odd_docs  # noqa: F401
from pixelframe.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def levels(sizes):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = dict(zip(names, [5, 2, 1] * len(names)))
    full, total = set(), sum(sizes.values())
    while True:
        rest = [s for s in names if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        t = {s: left * w[s] / max(1, sum(w[x] for x in rest)) for s in rest}
        over = {s for s in rest if t[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return t | {s: 3 * sizes[s] for s in full}
        full |= over


def check(rows):
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["taken"] == r["passes"] * r["size"] + r["cut_to"] - r["cut_from"] + r["wrap_to"]
    want = levels(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 96


def test_sql(spark):
    assert compare(spark, SF_MID, ["op10_mix_sources"], verbose=False)["op10_mix_sources"][0] == "OK"


def test_odd_rows(spark, odd_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    check(rows)
    want = sorted(len(WORD.findall(r["text"] or "")) for r in odd_docs.select("text").collect())
    assert sorted(r["size"] for r in rows) == want
    assert sorted(map(str, mixing.mix(odd_docs.repartition(1)).collect())) == sorted(map(str, rows))


def test_many_shards_and_sources(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "repeat('w ', cast(id % 90 as int)) as text",
                                        "case when id % 3 = 0 then 'hot' else concat('s', id % 41) end as source")
    rows = mixing.mix(docs, shard_words=1000).collect()
    assert len(rows) == 4000
    check(rows)


def test_no_words_and_empty_table(spark, odd_docs):
    none = mixing.mix(odd_docs.where("text is null")).collect()
    assert none and all(r["taken"] == 0 and r["target"] == 0 for r in none)
    assert mixing.mix(odd_docs.limit(0)).count() == 0


def test_texts_are_the_plans_words_whatever_the_parallelism(spark, tmp_path):
    """Splits of a scan follow the cores: numbers given in one scan must not be looked up in another."""
    docs = spark.range(3000).selectExpr(
        "id as doc_id", "concat('d', id, ' ', repeat(concat('w', id, ' '), cast(id % 90 as int)), 'z', id) as text",
        "case when id % 3 = 0 then 'hot' else concat('s', id % 5) end as source", "0L as n_chars")
    docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    settings = {"spark.sql.files.openCostInBytes": "1", "spark.sql.leafNodeDefaultParallelism": "2"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        stored = spark.read.parquet(str(tmp_path / "docs"))
        plan = {r["doc_id"]: r for r in mixing.mix(stored).collect()}
        out = mixing.mixed(stored)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "16")
        got = {}
        for r in out.collect():
            words = r["text"].split()
            assert len({w.lstrip("dwz") for w in words}) == 1 and words[0].lstrip("dwz") == str(r["doc_id"])
            got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(words)
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert got == {i: r["taken"] for i, r in plan.items() if r["taken"]}
