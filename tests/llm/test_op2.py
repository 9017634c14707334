import hashlib
import re

import pytest

import __spark_entry__ as E
from llm_fixtures import SF_SMALL, odd_docs  # noqa: F401
from pixelframe.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(s):
    d = [int(c) for c in s][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def slow_base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


TRICKY = ["a@b.c.@d.e x@y@z.w @a.b a@b a@b. .@-.- é@é.é x.%+-@q.r-s.t..", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.0004 1..2.3.4 9.9.9",
          "4111 1111 1111 1111 4111-1111-1111-1112 12 4111111111111111 0000000000000 1- 2", "+1 (988) 555-2485 +12345678 ++49 30 123456789- "
          "+1()()(( +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "\U0001f600 é a.b@c.de \U0001f600 +33 1 23 45 67 89.", "", "no data", "1" * 5000,
          "a" * 5000 + "@" + "b" * 5000 + ".c", "x" * 20000 + " @" + "1.2.3." * 2000, "a@b.c,a@b.c;a@b.c"]


@pytest.mark.parametrize("text", TRICKY)
def test_base_spans(text):
    assert pii.base_spans(text) == slow_base(text)


def test_base_spans_of_random_strings():
    import random
    rnd = random.Random(2)
    for _ in range(4000):
        t = "".join(rnd.choice("ab@.1290+-( )é ") for _ in range(rnd.randint(0, 40)))
        assert pii.base_spans(t) == slow_base(t), t


def expect(rows):
    out = []
    for doc_id, text in rows:
        b = slow_base(text or "")
        s = ",".join(f"{pii.KINDS[k]}:{i}:{j}" for i, k, j in b)
        out.append((doc_id, *[sum(k == n for _, k, _ in b) for n in range(4)], hashlib.sha256(s.encode()).hexdigest(), s, 0))
    return sorted(out, key=str)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in E.queries()["op2_personal_data"](spark, SF_SMALL).collect()), key=str)
    assert got == expect(rows)


def test_odd_rows(spark, odd_docs):  # noqa: F811
    docs = odd_docs.union(spark.createDataFrame([(i, t, None, None, 0, "x", 1, "y", 2.0) for i, t in enumerate(TRICKY)], odd_docs.schema))
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in pii.report(pii.find(docs)).collect()), key=str) == expect(rows)
    assert pii.report(pii.find(docs.limit(0))).count() == 0


CORPUS = ([f"Please write to email: user{i}@mail{i}.example.com today" for i in range(8)]
          + [f"her phone: +1 (415) 555-26{i}7 is new" for i in range(8)]
          + ["You can write to email: root@localhost today", "old phone: 555-0199-88 is gone", "so call 555-0199-88 at night",
             "room 555-1234-77 the end", "It is at root@localhost too"]
          + [f"the number 55{i}-0000-11 of the book" for i in range(8)] + [None, ""])


def slow_bootstrap(texts, rounds=3, trust=0.5, accept=0.8, support=3):
    """The same scores with dictionaries over all mentions and all words."""
    words, edges = {}, []
    for t in texts:
        for w in re.findall(r"[^\x20\x09-\x0D]+", t or ""):
            words[pii._key(w)] = words.get(pii._key(w), 0) + 1
        for m in pii.mentions(t or ""):
            edges += [(m, (side, m[n])) for side, n in enumerate(("left", "right")) if m[n] is not None]
    total = {p: max(sum(q == p for _, q in edges), words.get(p[1], 0)) for _, p in edges}
    accepted = {}
    for _ in range(rounds):
        hits, values = {}, {}
        for m, p in edges:
            known = {m["kind"]: 1.0} if m["kind"] >= 0 else {
                k: accepted[m["value"], k] for k in range(4) if m["shapes"] >> k & 1 and (m["value"], k) in accepted}
            for k, w in known.items():
                hits[p, k] = hits.get((p, k), 0) + w
                values.setdefault((p, k), set()).add(m["value"])
        trusted = {pk: min(0.999, h / (total[pk[0]] + 1)) for pk, h in hits.items() if len(values[pk]) >= support}
        doubt, seen = {}, set()
        for m, p in edges:
            for k in range(4):
                if m["kind"] < 0 and m["shapes"] >> k & 1 and trusted.get((p, k), 0) >= trust and (m["value"], k, p) not in seen:
                    seen.add((m["value"], k, p))
                    doubt[m["value"], k] = doubt.get((m["value"], k), 1) * (1 - trusted[p, k])
        accepted = {v: 1 - d for v, d in doubt.items() if 1 - d >= accept}
    best = {}
    for (v, k), w in accepted.items():
        best[v] = max(best.get(v, (0, 0)), (w, -k))
    return {v: -k for v, (_, k) in best.items()}


def test_contexts_find_unseen_identifiers(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(CORPUS)], "doc_id long, text string")
    scanned = pii.scan(docs)
    got = {r["value"]: r["found"] for r in pii.bootstrap(docs, scanned).collect()}
    assert got == slow_bootstrap(CORPUS)
    rows = {r["doc_id"]: r for r in pii.report(pii.find(docs)).collect()}
    at = {t: i for i, t in enumerate(CORPUS) if t}
    spans = lambda t: [(s.split(":")[0], t[int(s.split(":")[1]):int(s.split(":")[2])]) for s in rows[at[t]]["spans"].split(",") if s]
    assert spans(CORPUS[16]) == spans(CORPUS[20]) == [("email", "root@localhost")]
    assert spans(CORPUS[17]) == spans(CORPUS[18]) == [("phone", "555-0199-88")]
    assert spans(CORPUS[19]) == spans(CORPUS[21]) == []


def test_redaction_keeps_rows_and_columns(spark, odd_docs):  # noqa: F811
    docs = odd_docs.union(spark.createDataFrame([(1000 + i, t, None, None, 0, "x", 1, "y", 2.0) for i, t in enumerate(CORPUS)], odd_docs.schema))
    got = pii.redact(docs)
    assert got.columns == docs.columns
    rows = {r["doc_id"]: r for r in got.where("doc_id >= 1000").collect()}
    assert got.count() == docs.count()
    assert rows[1000]["text"] == "Please write to email: <EMAIL> today"
    assert rows[1016]["text"] == "You can write to email: <EMAIL> today"
    assert rows[1017]["text"] == "old phone: <PHONE> is gone" and rows[1017]["n_chars"] == len(rows[1017]["text"])
    assert rows[1019]["text"] == CORPUS[19] and rows[1000 + len(CORPUS) - 2]["text"] is None


def test_contexts_of_discovered_identifiers_are_learnt(spark):
    """Only the first context stands beside base numbers; each further one beside what the one before has found."""
    hops, texts = ["phone:", "tel", "fax", "mob", "cell"], [f"her phone: +1 (415) 555-2{i:03} w{i}" for i in range(60)]
    for k, (a, b) in enumerate(zip(hops, hops[1:])):
        for i in range(3):
            texts += [f"old {a} 555-{k}{i}99-88 u{k}{i}"] + [f"the {b} 555-{k}{i}99-88 v{k}{i}{j}" for j in range(20)]
    texts += ["his cell 555-7777-12 last", "room 555-8888-34 next"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["value"]: r["found"] for r in pii.bootstrap(docs, pii.scan(docs)).collect()}
    assert got == slow_bootstrap(texts, rounds=20)
    assert got[pii._key("555-7777-12")] == 3 and pii._key("555-8888-34") not in got
    assert pii._key("555-7777-12") not in slow_bootstrap(texts)
