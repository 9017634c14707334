import hashlib
import itertools
import re
import sys
import zlib
from functools import lru_cache

import pytest

from llm_fixtures import SF_SMALL
from pixelframe.llm import conversations as C

sys.setrecursionlimit(20_000)
WS = " \t\n\x0b\x0c\r"
GOOD = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    """``{conv_id: [(role, text, turn)]}`` by the contract's words."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        n = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if n == 0:
            continue
        text = "" if n == 1 else re.sub("[.!?]", "", text) if n == 2 else text
        out[conv] += [(turn, "user" if n == 4 else role, text)] * (2 if n == 3 else 1)
    for v in out.values():
        v.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(WS)
        out.append("blank" if not body else "duplicate" if (role, text) in seen
                   else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def slow_repair(rows):
    """Cheapest, then ASCII-least, by comparing whole audits from every (row, state), without vectors."""
    found, n = faults(rows), len(rows)
    nexts = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, q, inserts=0):
        options = []
        if i == n and q in ("", "a"):
            options.append((0, ""))
        if inserts < 2:
            for c in nexts[q].replace("s", ""):
                cost, audit = best(i, c, inserts + 1)
                options.append((3 + cost, "I" + audit))
        if i < n:
            cost, audit = best(i + 1, q)
            options.append((4 + cost, "D" + audit))
            if found[i] not in ("blank", "duplicate"):
                more = 3 * (found[i] == "truncated")
                if rows[i][1][:1] and rows[i][1][:1] in nexts[q]:
                    cost, audit = best(i + 1, rows[i][1][0])
                    options.append((more + cost, "K" + audit))
                for c in nexts[q].replace("s", ""):
                    cost, audit = best(i + 1, c)
                    options.append((3 + more + cost, "R" + audit))
        return min(options, default=(10 ** 9, ""))

    cost, audit = best(0, "")
    lines, q, i = [], "", 0
    for e in audit:
        if e in "IR":
            q = "a" if q == "u" else "u"
            lines.append(f"{'user' if q == 'u' else 'assistant'}:{'' if e == 'I' else rows[i][2]}")
        elif e == "K":
            q = rows[i][1][0]
            lines.append(f"{rows[i][1]}:{rows[i][2]}")
        i += e != "I"
    assert GOOD.fullmatch("".join(x[0] for x in lines))
    return cost, audit, lines


def expected(rows):
    out = set()
    for conv, rs in damaged(rows).items():
        found, turns = faults(rs), {r[0] for r in rs if r[0] is not None}
        first = "".join(r[1][:1] or "-" for r in rs)
        illegal = sum(first[i:i + 2] not in ("su", "ua", "au") for i in range(len(first) - 1))
        cost, audit, lines = slow_repair(tuple(rs))
        out.add((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, found.count("blank"),
                 found.count("duplicate"), found.count("truncated"), illegal, cost, audit,
                 hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(set(r[0] for r in rows)) == len(rows)
    return set(rows)


SCHEMA = "conv_id long, turn long, role string, text string"


def hashed(i, n):
    return zlib.crc32(f"x{i}".encode()) % n


def mixed_rows(n, convs):
    roles = ["user", "assistant", "system", "tool", None, "", "user", "assistant", "assistant"]
    texts = ["Yes.", "What now?", "cut off", "", " \n", None, "Good! ", "ok", "End.\t", "né ", "…!"]
    rows = []
    for i in range(n):
        turn = None if hashed(i, 31) == 0 else hashed(i + n, 90)
        text = texts[hashed(2 * i, len(texts))]
        rows.append((None if i % 50 == 7 else hashed(i, convs), turn, roles[hashed(3 * i, len(roles))],
                     text if hashed(i, 3) else f"{text} {i}."))
    return rows


def test_query_rows(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert got(C.repair(df)) == expected(rows)


@pytest.mark.parametrize("chunk_rows", [1, 3, 4096])
def test_odd_rows_in_chunks_of_any_size(spark, chunk_rows):
    rows = mixed_rows(400, 9)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA + ", pos string, chunk int, conversation int")
    assert got(C.repair(df.repartition(3), chunk_rows)) == expected(rows)


def test_a_hot_conversation_over_many_partitions(spark):
    """Long runs of deletions carry a vector unchanged through whole chunks: the passes go on until it arrives."""
    rows = [(1, i, "user" if i % 2 else "assistant", f"t{i}." if i < 40 or i > 900 else "again.") for i in range(1000)]
    rows += [(2, 5, "user", "same.")] * 300 + [(c, 0, "user", "Hi.") for c in range(3, 60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(C.repair(df, 16)) == expected(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repaired_turns(spark):
    rows = mixed_rows(200, 5)
    df = spark.createDataFrame(rows, SCHEMA)
    out = {}
    for r in C.Conversations(C.damage(df), 7).turns().orderBy("conversation", "pos", "step").collect():
        out.setdefault(r["conversation"], []).append(f"{r['role']}:{r['text']}")
    want = {str(" " if c is None else c): slow_repair(tuple(rs))[2] for c, rs in damaged(rows).items()}
    assert out == {k: v for k, v in want.items() if v}


def test_cheapest_among_all_edit_sequences():
    """Every audit of up to three rows with up to three inserts, spelt out."""
    kinds = [("system", "A."), ("user", "B."), ("assistant", "C"), ("user", ""), ("tool", "D.")]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            rs = tuple((i, *r) for i, r in enumerate(rows))
            best = None
            for length in range(n, n + 4):
                for audit in itertools.product("DIKR", repeat=length):
                    if length - audit.count("I") == n and (x := applied(rs, audit)) is not None:
                        best = min(best or (10 ** 9, ""), (x, "".join(audit)))
            codes = [3 * "sua".find(r[1][0]) if r[1][0] in "sua" else 9 for r in rs]
            codes = [c + {"": 0, "truncated": 2}.get(f, 1) for c, f in zip(codes, faults(rs))]
            letters, q, cost = C.forward(C.back(codes, C.END)[1], 0)
            assert (cost + C.END[q], "".join(letters) + "I" * (C.END[q] // 3)) == best == slow_repair(rs)[:2]


def applied(rows, audit):
    """What these edits cost; None where they don't give a legal conversation."""
    found, initials, cost, i = faults(rows), "", 0, 0
    for e in audit:
        role = "a" if initials.endswith("u") else "u"
        if e != "I" and e != "D" and found[i] in ("blank", "duplicate"):
            return None
        initials += {"D": "", "K": rows[i][1][0] if i < len(rows) else "", "I": role, "R": role}[e]
        cost += {"D": 4, "K": 0, "I": 3, "R": 3}[e] + 3 * (e in "KR" and found[i] == "truncated")
        i += e != "I"
    return cost if GOOD.fullmatch(initials) else None


def test_runs_join_when_vectors_differ_by_a_constant():
    codes = [3, 6] * 20
    spec = C.back(codes, C.END)[0]
    for right in [(0, 0, 3, 3), (5, 9, 0, 2), C.END]:
        assert C.rerun(codes, C.END, spec, right) == C.back(codes, right)[0]


def test_empty_table(spark):
    assert C.repair(spark.createDataFrame([], SCHEMA)).collect() == []
