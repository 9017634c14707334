"""Personal data: base patterns, and identifiers that bootstrapped contexts add to them.

The spans of the base patterns are seeds.  The words around them are patterns; a pattern is trusted by the
share of its occurrences in the whole corpus that stand beside known identifiers of one kind.  Trusted
patterns accept unseen strings of a fitting shape, these support further patterns, and so on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import materialize_table, small_batches, unused

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is entered at its start: what fails there fails further on in it as well
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
#: Strings of which a trusted context may make an identifier: something@something, dotted or coloned
#: addresses, and runs of at least seven digits with separators.
_MAYBE = re.compile(r"[^\s@<>()\[\]\"',;=]{1,64}@[^\s@<>()\[\]\"',;=]{1,255}"
                    r"|(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){2,7}[0-9A-Fa-f]{1,4}|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){2,7}"
                    r"|\(?[0-9](?:[\x20()./-]{0,2}[0-9]){6,18}")
_WORD_BEFORE = re.compile(r"[^\x20\x09-\x0D]+\Z")
_WORD_AFTER = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: How far a context word is read; longer words count by their nearest part.
_NEAR = 64


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, floor = text.find("@"), 0
    while at >= 0:
        s = at
        while s > floor and text[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(text, at + 1) if s < at else None
        floor = m.end() if m else at + 1  # no later match begins before
        if m:
            yield s, m.end()
        at = text.find("@", floor)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of all base matches, by start and then kind; leftmost, non-overlapping
    per kind; what fails its check is dropped without a second try."""
    out = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text) if "." in text else ():
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = _DIGITS.sub("", m[0])
            if 12 <= len(d) <= 19 and _luhn(d):
                out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def _shapes(s: str) -> int:
    """Kinds (as bits) that a string outside the base spans may be."""
    if "@" in s:
        return 1
    n = len(_DIGITS.sub("", s))
    if ":" in s or re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3,7}", s):
        return 2
    return 4 * (12 <= n <= 19) + 8 * (7 <= n <= 15)


def _key(word: str) -> int:
    """The hash that Spark's xxhash64 gives a word."""
    h = xxhash.xxh64_intdigest(word.translate(_LOWER).encode(), 42)
    return h - 2**64 if h >= 2**63 else h


def _contexts(text: str, start: int, end: int) -> tuple[int | None, int | None]:
    """Hashes of the words before and after; a word that touches the span counts by what stands outside it."""
    left = text[max(0, start - _NEAR - 8):start].rstrip("\x20\t\n\x0b\x0c\r")
    right = text[end:end + _NEAR + 8].lstrip("\x20\t\n\x0b\x0c\r")
    a, b = _WORD_BEFORE.search(left[-_NEAR:]), _WORD_AFTER.match(right[:_NEAR])
    return (_key(a[0]) if a else None), (_key(b[0]) if b else None)


def mentions(text: str) -> list[dict]:
    """Base spans (``kind`` 0 to 3) and other strings of a fitting shape (``kind`` -1), with their contexts."""
    out, base = [], base_spans(text)
    for s, k, e in base:
        left, right = _contexts(text, s, e)
        out.append({"start": s, "kind": k, "end": e, "shapes": 0, "value": _key(text[s:e]), "left": left, "right": right})
    if any(c in text for c in "0123456789@"):
        i, reach = 0, [0]
        for s, _, e in base:
            reach.append(max(reach[-1], e))
        for m in _MAYBE.finditer(text):
            while i < len(base) and base[i][0] < m.end():
                i += 1
            s = m[0].rstrip(".-/( ")
            if reach[i] > m.start() or not (shapes := _shapes(s)):
                continue
            left, right = _contexts(text, m.start(), m.start() + len(s))
            out.append({"start": m.start(), "kind": -1, "end": m.start() + len(s), "shapes": shapes, "value": _key(s),
                        "left": left, "right": right})
    return out


_MENTION = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("shapes", pa.int32()),
                      ("value", pa.int64()), ("left", pa.int64()), ("right", pa.int64())])
_MENTION_SQL = "struct<start:int,kind:int,end:int,shapes:int,value:long,left:long,right:long>"


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, h, mentions`` of every row; ``h`` is the text's hash.  One pass over the whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            found = pa.array([mentions(t) for t in b.column("text").to_pylist()], pa.list_(_MENTION))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h"), found], names=["doc_id", "h", "mentions"])

    text = F.coalesce(F.col("text"), F.lit(""))
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))
            .mapInArrow(run, f"doc_id long, h long, mentions array<{_MENTION_SQL}>"))


def context_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: how often each word (by its hash, A-Z as a-z) stands in all the texts."""
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (docs.select(F.explode(F.split(low, r"[\x20\x09-\x0D]+")).alias("w")).where("w <> ''")
            .groupBy(F.xxhash64("w").alias("word")).agg(F.count(F.lit(1)).alias("n")))


def bootstrap(docs: DataFrame, scanned: DataFrame, trust: float = 0.5, accept: float = 0.8,
              support: int = 3) -> DataFrame:
    """``value, kind``: strings that the contexts accept as identifiers.

    Each round scores patterns, then strings, over the pattern-mention graph with joins and sums, until a
    round adds nothing.  A pattern's trust for a kind is the weight of that kind's mentions beside it over its
    occurrences in the corpus (plus one); it needs ``support`` different values.  A string's score joins its
    patterns by noisy-or.
    """
    m = scanned.select(F.explode("mentions").alias("m")).select("m.*")
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("left").alias("word")),
                    F.struct(F.lit(1).alias("side"), F.col("right").alias("word")))
    edges = (m.select("kind", "shapes", "value", F.explode(sides).alias("p"))
             .select("kind", "shapes", "value", "p.side", "p.word").where("word is not null")
             .groupBy("kind", "shapes", "value", "side", "word").agg(F.count(F.lit(1)).alias("n")))
    edges = materialize_table(edges, "pii-edges")
    seeds = edges.where("kind >= 0")
    # only patterns that hold a candidate, and enough values of any kind to be trusted some day, can ever matter
    of_interest = (edges.groupBy("side", "word").agg(F.sum("n").alias("seen"), F.count(F.lit(1)).alias("k"), F.min("kind").alias("c"))
                   .where((F.col("k") >= support) & (F.col("c") < 0)).drop("k", "c"))
    counted = materialize_table(
        of_interest.join(context_counts(docs), "word", "left")
        .select("side", "word", F.greatest("seen", F.coalesce("n", F.lit(0))).alias("total")), "pii-patterns")
    maybe = (edges.where("kind < 0").join(counted.select("side", "word"), ["side", "word"], "left_semi")
             .withColumn("k", F.explode(F.array(*[F.lit(i) for i in range(len(KINDS))])))
             .where(F.expr("shapes & shiftleft(1, k) <> 0")).select("value", "side", "word", "n", F.col("k").alias("kind")))
    maybe = materialize_table(maybe, "pii-candidates")
    base = seeds.select("value", "side", "word", "n", "kind", F.lit(1.0).alias("weight"))
    accepted, last = None, (0, 0)
    while True:
        known = base
        if accepted is not None:
            known = base.unionByName(maybe.join(accepted, ["value", "kind"]).select(*base.columns))
        trusted = (known.groupBy("side", "word", "kind")
                   .agg(F.sum(F.col("n") * F.col("weight")).alias("hits"), F.count_distinct("value").alias("values"))
                   .where(F.col("values") >= support).join(counted, ["side", "word"])
                   .withColumn("trust", F.least(F.lit(0.999), F.col("hits") / (F.col("total") + 1)))
                   .where(F.col("trust") >= trust).select("side", "word", "kind", "trust"))
        accepted = (maybe.join(trusted, ["side", "word", "kind"])
                    .groupBy("value", "kind", "side", "word").agg(F.max("trust").alias("trust"))
                    .groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("weight"))
                    .where(F.col("weight") >= accept))
        accepted = materialize_table(accepted, "pii-accepted")
        # strings and weights only ever grow
        now = tuple(accepted.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.floor(F.col("weight") * 1e6)), F.lit(0))).first())
        if now <= last:
            break
        last = now
    best = F.max_by("kind", F.struct("weight", -F.col("kind")))
    return accepted.groupBy("value").agg(best.alias("found"))


def added_spans(scanned: DataFrame, accepted: DataFrame) -> DataFrame:
    """``doc_id, h, added``: the accepted strings' spans in each row that has some."""
    return (scanned.select("doc_id", "h", F.explode("mentions").alias("m")).where("m.kind < 0")
            .select("doc_id", "h", "m.start", "m.end", "m.value").join(accepted, "value")
            .select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"),
                    F.struct("start", F.col("found").alias("kind"), "end").alias("span"))
            .groupBy("_id", "_h").agg(F.array_sort(F.collect_set("span")).alias("added")))


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, h, base, added`` of every row: arrays of ``(start, kind, end)``, code points, sorted.

    Null text: empty.  Repeated rows are rows like any other.  Empty table: no rows.
    """
    scanned = materialize_table(scan(docs), "pii-scan")
    extra = materialize_table(added_spans(scanned, bootstrap(docs, scanned)), "pii-added")
    spans = F.transform(F.filter("mentions", lambda m: m["kind"] >= 0),
                        lambda m: F.struct(m["start"].alias("start"), m["kind"].alias("kind"), m["end"].alias("end")))
    rows = scanned.select("doc_id", "h", F.array_sort(spans).alias("base"))
    return (rows.join(extra, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")), "left")
            .select("doc_id", "h", "base", F.coalesce("added", F.array_except("base", "base")).alias("added")))


def _joined(spans):
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def report(found: DataFrame) -> DataFrame:
    """Counts of the base spans by kind, their digest, and all spans; ``n_added`` counts the others."""
    def count(i: int):
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("bigint")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"),
                        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
                        F.size("added").cast("bigint").alias("n_added"))


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``, each span of personal data in ``text`` replaced by ``<KIND>`` and
    ``n_chars`` counted anew.  Overlapping spans go together, under the first one's kind.  Null text stays null.
    """
    scanned = materialize_table(scan(docs), "pii-scan")
    # few rows have added spans; as a written table its size is known to the planner
    extra = materialize_table(added_spans(scanned, bootstrap(docs, scanned)), "pii-added")
    own, h, more = (unused(docs, n) for n in ("_id", "_h", "_added"))
    extra = extra.select(F.col("_id").alias(own), F.col("_h").alias(h), F.col("added").alias(more))

    @arrow_udf("string")
    def replaced(texts: pa.Array, added: pa.Array) -> pa.Array:
        def one(text, more):
            if text is None:
                return None
            out, at = [], 0
            spans = sorted(base_spans(text) + [(s["start"], s["kind"], s["end"]) for s in more or ()])
            for s, k, e in spans:
                if s >= at:
                    out.append(text[at:s] + f"<{KINDS[k].upper()}>")
                at = max(at, e)
            return "".join(out) + text[at:]
        return pa.array([one(t.as_py(), a.as_py()) for t, a in zip(texts, added)], pa.string())

    same = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))) == F.col(h)
    out = docs.join(extra, F.col("doc_id").cast("bigint").eqNullSafe(F.col(own)) & same, "left")
    new = out.withColumn("text", replaced("text", more)).withColumn("n_chars", F.char_length("text").cast("bigint"))
    return new.select(*docs.columns)
