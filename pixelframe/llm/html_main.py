"""Main text of web pages: the contiguous run of tokens with the largest sum of scores."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: A comment, a declaration, a whole element that holds no text of the page, or a tag.  Quoted attribute
#: values may hold ">"; an unclosed quote or tag ends at the next ">" or at the end.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"""
    r"""|<(?P<raw>script|style|noscript|template|textarea|select|iframe|svg|math|title)\b(?:[^>"']++|"[^"<]*+"|'[^'<]*+'|["'])*+>"""
    r""".*?(?:</(?P=raw)\s*>|\Z)"""
    r"""|<[a-zA-Z/!?](?:[^>"']++|"[^"<]*+"|'[^'<]*+'|["'])*+(?:>|\Z)""", re.S | re.I)
_NAME = re.compile(r"</?\s*([a-zA-Z][a-zA-Z0-9:-]*)")
_ATTR = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_SPACE = re.compile(r"\s+")

#: Elements that stand in a line of text and do not end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rt rp s "
                   "samp small span strike strong sub sup time tt u var wbr img".split())
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never hold main text.
ASIDE = frozenset("nav footer aside form button menu dialog head header".split())
#: Words in class, id or role that name something beside the article.
BESIDE = re.compile(r"(?:^|[\s_-])(ad|ads|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumb\w*|sidebar|side"
                    r"|widget\w*|footer|header|masthead|comment\w*|disqus|replies|reply|respond|cookie\w*|consent|gdpr"
                    r"|notice\w*|alert|popup|modal|newsletter|subscri\w*|share|sharing|social|related|recommend\w*"
                    r"|pagination|pager|tags|login|search|complementary|contentinfo|navigation)(?=$|[\s_-])", re.I)
#: Words that make even an article something beside the page's own.
OTHER = re.compile(r"(?:^|[\s_-])(ad|ads|advert\w*|sponsor\w*|promo\w*|comment\w*|replies|reply|related|teaser)(?=$|[\s_-])", re.I)
#: Class words that tell what a page has or how it stands, not what the element is.
STATE = re.compile(r"(?:no|not|has|have|with|without)[-_].*|.*[-_](?:open|opened|closed|on|off|enabled|disabled)", re.I)
#: Elements whose articles are not the page's own.
FOREIGN = frozenset("nav footer aside menu".split())
#: Marks with which pages label their main text themselves.
LABEL = re.compile(r"articlebody|(?:^|[\s_-])main(?=$|[\s_-])", re.I)

#: Tokens' kinds: what a word stands in, or what a tag is.
PRIOR = {"word": 1.0, "word in link": -1.0, "word beside": -6.0, "tag block": -0.1, "tag inline": -0.05,
         "tag link": -0.5, "tag beside": -8.0}


def _attributes(rest: str) -> tuple[str, bool]:
    """Class, id, role and itemprop of a tag in one string, and whether the element is hidden."""
    words, hidden = [], False
    for name, value in _ATTR.findall(rest):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("hidden", "aria-hidden"):
            hidden |= name == "hidden" or value == "true"
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "")
        else:
            words += (w for w in value.split() if not STATE.fullmatch(w))
    return " ".join(words), hidden


def tokens(page: str) -> list[tuple[str, str, int, int]]:
    """``(kind, text, words, labelled)`` of a page in order: pieces of text, and tags (text is "\\n" where the
    tag ends a block).  ``labelled``: 2 inside an article, 1 inside another part that the page marks as main."""
    out: list[tuple[str, str, int, int]] = []
    # open elements, and beside, labelled, links and foreign around them
    stack: list[tuple[str, int, int, int, int]] = []
    beside = labelled = links = foreign = 0

    def text(s: str) -> None:
        if s:
            s = entities.unescape(s)
            kind = "word beside" if beside else "word in link" if links and not labelled else "word"
            out.append((kind, s, len(s.split()), labelled))

    at = 0
    for m in _TOKEN.finditer(page):
        text(page[at:m.start()])
        at = m.end()
        s = m[0]
        got = None if m["raw"] or s[:2] in ("<!", "<?") else _NAME.match(s)
        if not got:
            continue
        name, aside = got[1].lower(), False
        if s[1] == "/":
            if any(x[0] == name for x in stack):
                while True:
                    was = beside
                    last, beside, labelled, links, foreign = stack.pop()
                    aside |= was > beside
                    if last == name:
                        break
        else:
            if (name in ("p", "li", "tr", "td", "th", "dt", "dd", "option") and stack and stack[-1][0] == name
                    or name == "body" and stack and stack[-1][0] == "head"):
                _, beside, labelled, links, foreign = stack.pop()  # its end tag may be left out
            words, hidden = _attributes(s[got.end():])
            level = 2 if name == "article" or "articlebody" in words else 1 if name == "main" or LABEL.search(words) else 0
            level = 0 if hidden or foreign or OTHER.search(words) else level
            aside = hidden or not level and name not in ("body", "html") and (
                name in ASIDE and not (name == "header" and labelled) or bool(BESIDE.search(words)))
            if name not in VOID and not s.endswith("/>"):
                stack.append((name, beside, labelled, links, foreign))
                foreign += aside and (name in FOREIGN or bool(OTHER.search(words)))
                # what surrounds a labelled part does not make it something beside, unless it is a teaser there
                beside = 0 if level > labelled else beside + aside
                labelled = max(labelled, level)
                links += name == "a"
        kind = "tag beside" if aside else "tag link" if name == "a" else "tag inline" if name in INLINE else "tag block"
        out.append((kind, "" if name in INLINE else "\n", 0, labelled))
    text(page[at:])
    return out


def learn(pages: DataFrame, rows: int = 5000) -> dict[str, float]:
    """Weights of the kinds from pages that label their own main text.

    The sample is bounded: the ``rows`` labelled pages with the smallest hash of the id.  A kind weighs the
    logarithm of how much likelier it is inside the labelled text than outside, between bounds: words of
    the text are positive, tags negative, and the tags around a block of one word cost less than the word.
    Without labelled pages: PRIOR.
    """
    marked = pages.where("page_id is not null").where(F.lower("html").rlike("<article|<main|articlebody"))
    # ids first: the pages themselves never meet in one task
    ids = marked.select("page_id").orderBy(F.xxhash64("page_id", F.lit(6)), "page_id").limit(rows)
    labelled = marked.join(F.broadcast(ids.distinct()), "page_id").select("html")  # at most ``rows`` ids

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, bool], int] = {}
        for b in batches:
            for page in b.column("html").to_pylist():
                for kind, _, words, level in tokens(page):
                    n = words if kind.startswith("word") else 1
                    seen[kind, level > 0] = seen.get((kind, level > 0), 0) + n
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.bool_()),
                                          pa.array(list(seen.values()), pa.int64())], names=["kind", "inside", "n"])

    got = (labelled.mapInArrow(count, "kind string, inside boolean, n long").groupBy("kind", "inside")
           .agg(F.sum("n").alias("n")).collect())
    n = {(r["kind"], r["inside"]): r["n"] for r in got}
    if not any(k[1] for k in n):
        return dict(PRIOR)
    total = {i: sum(v for k, v in n.items() if k[1] == i) + len(PRIOR) for i in (True, False)}
    out = {}
    for kind, prior in PRIOR.items():
        w = float(np.log((n.get((kind, True), 0) + 1) / total[True]) - np.log((n.get((kind, False), 0) + 1) / total[False]))
        out[kind] = max(0.5, min(w, 3.0)) if kind == "word" else max(-12.0, min(w, prior / 2))
    for kind in ("tag block", "tag inline"):
        out[kind] = max(out[kind], -0.1 * out["word"])
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """``[start, end)`` of the contiguous run with the largest positive sum, in one pass; the first if there are ties."""
    best = total = 0.0
    start, found = 0, (0, 0)
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, found = total, (start, i + 1)
    return found


def extract(page: str | None, weights: dict[str, float]) -> str:
    """Blocks of the best run, without what stands beside the text inside it, joined by line feeds.

    Where a page labels its main text, the run is sought there.  Null or empty page, or no text: empty.
    """
    ts = tokens(page or "")
    level = max((t[3] for t in ts if t[2] and t[0] == "word"), default=0)
    if level:  # what stands beside the text in there is left out, but does not end it
        ts = [("tag block", *t[1:]) if t[0] == "tag beside" else t for t in ts if t[3] >= level and t[0] != "word beside"]
    s, e = best_run([weights[k] * (n if k.startswith("word") else 1) for k, _, n, _ in ts])
    # a line of text is taken whole: white space or a tag does not part it
    while e < len(ts) and ts[e][1] != "\n":
        e += 1
    while s > 0 and ts[s - 1][1] != "\n":
        s -= 1
    run = "".join("\x00" if x == "\n" and k.startswith("tag") else "" if k == "word beside" else x.replace("\x00", " ")
                  for k, x, _, _ in ts[s:e])
    blocks = (_SPACE.sub(" ", b).strip() for b in run.split("\x00"))
    return "\n".join(b for b in blocks if b)


def extract_pages(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages (page_id, url, html)``; other columns are not read.

    Repeated rows are rows like any other; an empty table gives no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            out = [extract(p, shared.value) for p in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string()),
                                              pa.array([len(t) for t in out], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return (pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
