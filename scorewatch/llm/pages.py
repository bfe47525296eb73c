"""Main text of web pages: structure first, then differencing against the nearest URL.

A page is cut into lines, one for each block of text. What stands in menus, footers, adverts,
forms, scripts and the like, told by tag or by class, is left out, and so is all outside the
article where a page marks its article. An element told by class alone that holds most of the page's
text (in an article, most of the article's) is a wrapper and stays, as do html and body.
A page with a marked article is done. In the order of host and URL path, any
other is paired with the nearest page with other lines, before or after it: the one that has more of
its path in common (of equals the one before it). The lines of both are aligned by a longest common
subsequence, and lines that both have are deleted: the template of the site.

Differencing looks at lines outside a marked article, passes by pages that have none, and those that
have all lines in common with the page: copies of an article on one host would delete each other.
The order is found on keys alone, by windows that are cut where a host has very many pages; pages with
a marked article are read for it only on hosts that have others. Lines are written once.

A null html is empty and gives an empty text; a page without url or host is sorted with the
others that have none. Character references are decoded once, white space inside a block
becomes one space. Repeated rows are extracted each for itself; other columns are ignored,
whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorewatch.llm.graph import stage
from scorewatch.operators.ordered import previous_row, running_sums

# A "<" outside quotes ends the try: a page of unclosed tags is read in one go.
_ATTRIBUTES = r"""(?:[^<>"']|"[^"]*"|'[^']*')*"""
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|object|head|select)\b"
    + _ATTRIBUTES
    + r">.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9-]*)(?P<attributes>" + _ATTRIBUTES + r")>"
    r"|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_MARK = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub "
    "sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(("article", "main"))
#: Elements, and words in class, id or role, that hold no text of the article.
BESIDE = frozenset("nav header footer aside form menu button dialog".split())
BESIDE_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie cookies "
    "disqus footer header menu menubar modal nav navbar navigation newsletter notice notices popup promo promoted related search "
    "share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)


#: First words of class names of reader comments. An element with no other names is one, however long.
COMMENTS = frozenset("comment comments commentlist disqus replies reply respond".split())
#: First words of class names that tell something about an element and do not name it.
MODIFIERS = frozenset("has have no not with without is are hide hidden show".split())
#: Elements that some sites wrap around the whole page; cut like those told by class.
WRAPPING = frozenset(("form",))


@dataclass
class Line:
    text: str
    main: bool


@dataclass
class Doubtful:
    """An element told by its class: its lines (`end` exclusive), whether the article holds it, and
    how many elements of its name are open in it."""

    name: str
    main: bool
    start: int
    end: int
    depth: int = 1


def names_beside(attributes: str) -> bool:
    """Whether a class, id or role stands for something other than the article."""
    for m in _MARK.finditer(attributes):
        for whole in (m[1] or m[2] or m[3] or "").lower().split():
            words = re.split(r"[_-]+", whole)
            if whole in BESIDE_WORDS or (words[0] not in MODIFIERS and not BESIDE_WORDS.isdisjoint(words)):
                return True
    return False


def is_comments(attributes: str) -> bool:
    """Whether all names of a class, or an id, stand for reader comments."""
    for m in _MARK.finditer(attributes):
        names = (m[1] or m[2] or m[3] or "").lower().split()
        if names and all(re.split(r"[_-]+", x)[0] in COMMENTS for x in names):
            return True
    return False


def lines_of(html: str) -> list[Line]:
    """Blocks of text in page order, without markup and what stands beside the article.

    Text is the article's inside <main>, or inside <article> on pages without one. An <article> that
    stands in a menu, an aside and the like, or is a reader comment by its class, is no article.
    Comments go whatever their length. Another element told by its class goes only if no more than
    half of the text around it is in it: of the article's where it lies in one, else of the page's.
    So no wrapper of the page goes.
    """
    main_tag = re.search(r"<main\b", html, re.IGNORECASE)
    ends: dict[str, int] = {}

    def closes_later(name: str, at: int) -> bool:
        if name not in ends:
            ends[name] = max((m.start() for m in re.finditer(rf"</{name}\b", html, re.IGNORECASE)), default=-1)
        return ends[name] > at

    out: list[Line] = []
    pieces: list[str] = []
    open_: list[Doubtful] = []
    doubtful: list[Doubtful] = []
    main, skipped, depth, at = 0, "", 0, 0
    held = {False: 0, True: 0}  # characters cut by tag, outside the article and in it

    def close() -> None:
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                out.append(Line(text, main > 0))
            pieces.clear()

    def end(element: Doubtful) -> None:
        close()
        element.end = len(out)
        open_.remove(element)

    for m in _TAG.finditer(html):
        if m.start() > at:
            if skipped:
                held[main > 0] += len(" ".join(html[at : m.start()].split()))
            else:
                pieces.append(html[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            if m["raw"]:
                close()
            continue
        name = name.lower()
        # What is never closed does not hold the article.
        inside = skipped and (name == skipped or closes_later(skipped, m.start()))
        beside = inside or (not m["end"] and is_comments(m["attributes"]))
        if name in MAIN and not beside and (name == "main" or not main_tag):
            close()
            if not m["end"]:
                skipped = ""
                for element in list(open_):
                    end(element)
            main = max(0, main + (-1 if m["end"] else 1))
            continue
        if skipped:
            if name == skipped:
                depth += -1 if m["end"] else 1
                skipped = skipped if depth else ""
            continue
        if name == "br":
            pieces.append(" ")
        elif name not in INLINE:
            close()
        if name in VOID or (not m["end"] and m["attributes"].endswith("/")):
            continue
        for element in [x for x in open_ if x.name == name]:
            element.depth += -1 if m["end"] else 1
            if not element.depth:
                end(element)
        if m["end"] or name in ("html", "body"):
            continue
        if (name in BESIDE and name not in WRAPPING and not (name == "header" and main)) or is_comments(m["attributes"]):
            close()
            skipped, depth = name, 1
        elif name in WRAPPING or (m["attributes"] and names_beside(m["attributes"])):
            close()
            open_.append(Doubtful(name, main > 0, len(out), 0))
            doubtful.append(open_[-1])
    if skipped:
        held[main > 0] += len(" ".join(html[at:].split()))
    else:
        pieces.append(html[at:])
    close()
    for element in open_:
        element.end = len(out)
    if not doubtful:
        return out
    upto = [0]
    for x in out:
        upto.append(upto[-1] + len(x.text))
    in_main = held[True] + sum(len(x.text) for x in out if x.main)
    page = upto[-1] + held[False] + held[True]
    gone: set[int] = set()
    for x in doubtful:
        if 2 * (upto[x.end] - upto[x.start]) <= (in_main if x.main else page):
            gone.update(range(x.start, x.end))
    return [x for i, x in enumerate(out) if i not in gone]


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in `a` of a longest common subsequence with `b`, by bit-parallel rows.

    Row k tells, bit by bit, where the length of the best alignment with a[:k] steps up.
    """
    at: dict[str, int] = {}
    for j, line in enumerate(b):
        at[line] = at.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for line in a:
        rows.append(row)
        hit = row & at.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
    found, j = set(), len(b)
    for i in range(len(a) - 1, -1, -1):
        below = (1 << j) - 1
        now = j - (row & below).bit_count()
        if now > j - (rows[i] & below).bit_count():
            # The last step up that the row with this line has and the one without lacks.
            while j and (row >> (j - 1)) & 1:
                j -= 1
            found.add(i)
            j -= 1
        row = rows[i]
    return found


def shared_path(a: str, b: str) -> int:
    """Leading characters that two paths have in common."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text of a marked article, null without one; the lines outside; their digest."""
    for batch in batches:
        for i in range(0, batch.num_rows, 200):
            part = batch.slice(i, 200)
            articles, outside, digests = [], [], []
            for html in part.column(4):
                lines = lines_of(html.as_py() or "")
                articles.append(" ".join(x.text for x in lines if x.main) if any(x.main for x in lines) else None)
                outside.append([x.text for x in lines if not x.main])
                digests.append(hashlib.blake2b("\n".join(outside[-1]).encode(), digest_size=16).digest())
            made = [pa.array(articles, pa.string()), pa.array(outside, pa.list_(pa.string())), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:4], *made], ["id", "url", "host", "path", "article", "lines", "digest"]
            )


def _differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of pages without the lines of the neighbour that shares more of the path."""
    for batch in batches:
        texts = []
        for path, own, *near in zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True):
            near = [(near[k], near[k + 1]) for k in (0, 2) if near[k + 1] is not None]
            best = max(near, key=lambda p: shared_path(path, p[0]), default=("", []))
            gone = common_lines(own, best[1])
            texts.append(" ".join(x for i, x in enumerate(own) if i not in gone))
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], ["id", "url", "text"])


def _neighbours(parsed: DataFrame, open_: DataFrame) -> DataFrame:
    """(row, before, after) of the open pages: the nearest rows of the host with other lines.

    Pages in a row with equal lines are a run; a page's neighbours are the last one of the run
    before and the first one of the run after.
    """
    hosts = open_.select("host").distinct()
    by, order = ["host"], ["path", "id", "row"]
    rows = parsed.where(F.size("lines") > 0).select("host", "path", "id", "row", "digest").join(hosts, "host", "left_semi")
    seen = previous_row(rows, by, order, ["digest"], "ahead")
    fresh = F.coalesce(F.col("ahead.digest") != F.col("digest"), F.lit(True)).cast("long")
    runs = running_sums(seen.select(*by, *order, fresh.alias("fresh")), by, order, {"run": "fresh"})
    runs = stage(runs.select(*by, *order, "run"), "runs")
    at = F.struct(*order)
    ends = runs.groupBy("host", "run").agg(F.min_by("row", at).alias("first"), F.max_by("row", at).alias("last"))
    around = runs.join(open_.select("row"), "row", "left_semi").select("host", "run", "row")
    around = around.join(ends.select("host", (F.col("run") + 1).alias("run"), F.col("last").alias("before")), ["host", "run"], "left")
    around = around.join(ends.select("host", (F.col("run") - 1).alias("run"), F.col("first").alias("after")), ["host", "run"], "left")
    return around.select("row", "before", "after")


def main_text(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """(id, url, text, n_chars) of every page."""
    url = pages["url"].cast("string")
    host = F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit(""))
    rows = pages.select(
        pages[id_col].alias("id"), url.alias("url"), pages["html"].cast("string").alias("html"), host.alias("host"), path.alias("path")
    )
    id_type = rows.schema["id"].dataType
    kept = [T.StructField("id", id_type), T.StructField("url", T.StringType())]
    texts = [T.StructField(c, T.StringType()) for c in ("host", "path", "article")]
    lines = [T.StructField("lines", T.ArrayType(T.StringType())), T.StructField("digest", T.BinaryType())]
    parsed = rows.select("id", "url", "host", "path", "html").mapInArrow(_parsed, T.StructType(kept + texts + lines))
    parsed = stage(parsed.withColumn("row", F.monotonically_increasing_id()), "pages")

    is_open = F.col("article").isNull() & (F.size("lines") > 0)
    open_ = parsed.where(is_open)
    others = parsed.select("row", "path", "lines")
    near = open_.join(_neighbours(parsed, open_), "row")
    for side in ("before", "after"):
        other = others.select(F.col("row").alias(side), F.col("path").alias(f"{side}_path"), F.col("lines").alias(f"{side}_lines"))
        near = near.join(other, side, "left")
    near = near.select("id", "url", "path", "lines", "before_path", "before_lines", "after_path", "after_lines")
    left = near.mapInArrow(_differenced, T.StructType([*kept, T.StructField("text", T.StringType())]))
    done = parsed.where(~is_open).select("id", "url", F.coalesce("article", F.lit("")).alias("text"))
    return done.union(left).select(F.col("id").alias(id_col), "url", "text", F.length("text").cast("bigint").alias("n_chars"))
