"""Main text of web pages: page structure, and differencing against the page with the nearest address.

A page is read as lines, one for each block of text, each marked as page furniture (menus, headers, footers,
sidebars, notices, adverts, forms, comments), as part of an element that the page itself marks as its
article, or as open. An article that stands in furniture, other than comments and hidden elements, counts if
no other does and it is longer than the open lines.

Every page is differenced: within a host, distinct pages are ordered by path, each page is paired with the
neighbour whose path begins most like its own, and the lines of both are aligned by a longest common
subsequence. What the neighbour has too is deleted, and the page's marks check the outcome, since pages of one
host repeat passages and whole articles, and their menus and adverts may differ from page to page: furniture is
deleted even if it is the page's own, and an article that holds a line of the page's own, or the only ones
there are, stays whole. So differencing deletes shared open lines, and of several articles those (teasers, say)
that the neighbour has line for line.

Order within a host comes from a range-partitioned sort of small key rows, so a host with a third of all
pages is spread over tasks; copies of a page on a host count once there. Neighbours are joined by rank. Lines
travel as hashes of 64 bits, and only deletions are joined back to the pages.

Defined results: a null page is empty and gives an empty text; a null or odd address has the empty host and
path; rows may repeat; an only page of its host keeps all open lines; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from array import array
from collections import Counter
from collections.abc import Hashable, Iterator, Sequence
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import stage

FURNITURE, OPEN, ARTICLE = 0, 1, 2

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
#: elements whose content is not text of the page
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "select", "button", "canvas", "audio", "video"}
#: those of them that hold elements, so an end of one that was opened before them shows that they are not closed
HOLDING = {"noscript", "template", "svg", "math", "object", "select", "button", "canvas", "audio", "video"}
#: those that may hold their like
RECURSIVE = {"template", "svg", "math", "object"}
#: elements that can stand in a head
IN_HEAD = {"html", "head", "base", "basefont", "bgsound", "link", "meta", "title", "script", "style", "noscript", "template"}
#: elements that end a line and may nest
NESTED = {"html", "body", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "ul", "ol", "dl", "table", "thead", "tbody",
          "tfoot", "figure", "blockquote", "details", "fieldset", "dialog", "menu", "search", "address", "hgroup", "center"}
#: elements that end a line only
LINE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "tr", "td", "th", "dt", "dd", "hr", "pre", "figcaption", "summary", "caption", "legend", "option"}
#: elements that are furniture wherever they stand, and those that are only outside an article
ALWAYS, OUTSIDE = {"nav", "aside", "form", "menu", "search", "dialog", "footer"}, {"header"}
#: words of class, id and role that say the same of their element
MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies",
         "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "paywall",
         "signup", "login", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "toolbar", "pagination", "pager",
         "comment", "comments", "commentlist", "disqus", "replies", "respond", "related", "recommended", "share", "sharing", "social", "widget",
         "search", "footer", "contentinfo", "complementary", "copyright", "masthead", "skip"}
MARKS_OUTSIDE = {"header", "topbar"}
COMMENTS = {"comment", "comments", "commentlist", "replies", "respond", "disqus"}
NEGATED = {"no", "has", "with", "without", "not", "is"}


def _marks(attributes: str) -> tuple[set[str], bool]:
    """The words of class, id and role, and whether the element is hidden."""
    words, hidden = set(), False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role"):
            for part in value.split():
                tokens = re.findall(r"[a-z]+", part)
                words.update(t for before, t in zip(["", *tokens], tokens) if before not in NEGATED)
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
        elif name == "itemprop" and value == "articlebody":
            words.add("articlebody")
    return words, hidden


def _parts_of(token: re.Match) -> tuple[str | None, str]:
    """Whether a token closes, and the name in it."""
    close, name = (token[1], token[2]) if token[2] else (token[4], token[5])
    return close, (name or "").lower()


class RawElements:
    """Where the raw elements of a page end, in time proportional to the page.

    Starts and ends of an element that holds others are paired once for the page. What has no end of its own, or has it behind
    the end of an ancestor, ends at its next block; that it has none is remembered, so no start looks through the rest again.
    """

    def __init__(self, page: str):
        self.page = page
        self.missing: set[str] = set()  # names without an end on the rest of the page
        self.own: dict[str, dict[int, int]] = {}  # name, begin of the content: end
        self.blocked: dict[str, int] = {}  # name: up to where an ancestor's end comes first

    def _stop(self, name: str, at: int) -> re.Match | None:
        stop = None if name in self.missing else re.compile(rf"</{name}\b", re.I).search(self.page, at)
        if not stop:
            self.missing.add(name)
        return stop

    def _own_ends(self, name: str) -> dict[int, int]:
        if name not in self.own:
            ends, opened, here = {}, [], 0
            while token := TOKEN.search(self.page, here):
                here = token.end()
                close, inner = _parts_of(token)
                if inner == name:
                    if close and opened:
                        ends[opened.pop()] = here
                    elif not close and not token[0].endswith("/>"):
                        if name not in RECURSIVE:
                            opened.clear()
                        opened.append(here)
                elif inner in RAW and inner not in HOLDING and not close:
                    stop = self._stop(inner, here)
                    here = stop.start() if stop else here
            self.own[name] = ends
        return self.own[name]

    def end(self, at: int, name: str, open_names: Counter[str]) -> int:
        """Where the raw element whose content begins at ``at`` ends; without its own end, at the next block or the end of an ancestor."""
        page = self.page
        if name not in HOLDING:
            stop = self._stop(name, at)
            if name == "script" or stop:
                rest = page.find(">", stop.end()) if stop else -1
                return rest + 1 if rest >= 0 else len(page)
            own = None
        else:
            own = self._own_ends(name).get(at)
            if own is not None and at < self.blocked.get(name, 0) < own:
                own = None
        first, inside, held, depth, here = None, [], Counter(), 1, at
        while token := TOKEN.search(page, here):
            here = token.end()
            close, inner = _parts_of(token)
            block = inner in NESTED or inner in LINE and not (name == "select" and inner in ("option", "hr"))
            if first is None and (block or close and inner == "head"):
                first = token.start()
            if own is None and first is not None:
                break
            if inner == name:
                if not close and name not in RECURSIVE:
                    return token.start() if first is None else first
                depth += -1 if close else not token[0].endswith("/>")
                if not depth:
                    return here
            elif inner in RAW and inner not in HOLDING and not close:
                stop = self._stop(inner, here)
                here = stop.start() if stop else here
            elif inner in NESTED and not close:
                if not token[0].endswith("/>"):
                    inside.append(inner)
                    held[inner] += 1
            elif inner in NESTED and held[inner]:
                while held[inner] and (gone := inside.pop()):
                    held[gone] -= 1
                    if gone == inner:
                        break
            elif close and (open_names[inner] or inner == "head"):
                self.blocked[name] = max(token.start(), self.blocked.get(name, 0))
                break
        return len(page) if first is None else first


def read_page(page: str | None) -> tuple[list[tuple[int, str]], list[int]]:
    """The lines of a page in order, with their kind, and the number of the article that each stands in.

    Articles are told apart by outermost <article> elements; 0 stands for all other places.
    """
    page = page or ""
    lines: list[tuple[int, str]] = []
    articles: list[int] = []
    parts: list[str] = []
    levels: list[int] = []  # of each line of an article: the furniture around that
    stack: list[tuple[str, bool, int, bool]] = []  # open element, whether it is furniture, its rank as an article, whether it is hidden or comments
    at, furniture, lost, in_head = 0, 0, 0, False
    raw, open_names = RawElements(page), Counter()
    ranks: list[tuple[int, int]] = []  # of the enclosing marked elements: 2 article, 1 main; and the furniture around it
    begun = 0  # outermost articles so far

    def end_line() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                level = ranks[-1][1] if ranks and not lost else 0
                lines.append((FURNITURE if furniture > level else ARTICLE + max(ranks)[0] if ranks else OPEN, text))
                levels.append(level)
                articles.append(begun if open_names["article"] else 0)
            parts.clear()

    size = len(page)
    while at < size:
        token = TOKEN.search(page, at)
        begin = token.start() if token else size
        in_head = in_head and not page[at:begin].strip()
        if begin > at and not in_head:
            parts.append(page[at:begin])
        if not token:
            break
        at = token.end()
        close, name, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not name:
            continue
        name = name.lower()
        if name == "head":
            in_head = not close
        elif name == "body" or not close and name not in IN_HEAD:
            in_head = False
        if not close and name in RAW:
            if not attributes.endswith("/"):
                at = raw.end(at, name, open_names)
            parts.append(" ")
        elif name in NESTED:
            end_line()
            if not close:
                words, hidden = _marks(attributes) if attributes else (set(), False)
                plain = name not in ("html", "body", "main", "article")
                bad = hidden or name in ALWAYS or plain and bool(words & MARKS) or bool(words & COMMENTS) and name == "article"
                bad = bad or not ranks and (name in OUTSIDE or plain and bool(words & MARKS_OUTSIDE))
                rank = 2 if name == "article" or "articlebody" in words else 1 if name == "main" or "main" in words and plain and "role" in attributes else 0
                if attributes.endswith("/"):
                    continue
                gone = hidden or bool(words & COMMENTS) and (plain or name == "article")
                stack.append((name, bad, rank, gone))
                begun += name == "article" and not open_names[name]
                open_names[name] += 1
                if rank:
                    ranks.append((rank, furniture))
                furniture += bad
                lost += gone
            else:
                found = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None) if open_names[name] else None
                if found is not None:
                    for other, bad, rank, gone in stack[found:]:
                        open_names[other] -= 1
                        furniture -= bad
                        lost -= gone
                        if rank:
                            ranks.pop()
                    del stack[found:]
        elif name in LINE:
            end_line()
        elif name == "br":
            parts.append(" ")
    end_line()
    marked = [(level, -kind) for (kind, _), level in zip(lines, levels) if kind > OPEN]
    if marked:  # the strongest mark in the least furniture names the article; what lies outside it is furniture
        best = min(marked)
        inside = [(level, -kind) == best for (kind, _), level in zip(lines, levels)]
        if not best[0] or sum(len(t) for (_, t), i in zip(lines, inside) if i) > sum(len(t) for kind, t in lines if kind == OPEN):
            lines = [(ARTICLE if i else FURNITURE, text) for (_, text), i in zip(lines, inside)]
        else:
            lines = [(kind if kind == OPEN else FURNITURE, text) for kind, text in lines]
    return lines, articles


def read_lines(page: str | None) -> list[tuple[int, str]]:
    """The lines of a page in order, with their kind."""
    return read_page(page)[0]


def deleted_lines(kinds: list[int], articles: list[int], shared: set[int]) -> list[int]:
    """Of the lines that are not furniture, those that differencing deletes, given those that the neighbour has too."""
    own = {a for i, (kind, a) in enumerate(zip(kinds, articles)) if kind >= ARTICLE and i not in shared}
    return [i for i, (kind, a) in enumerate(zip(kinds, articles)) if i in shared and (kind == OPEN or kind >= ARTICLE and own and a not in own)]


def main_text(lines: list[tuple[int, str]], neighbour: list[str] | None = None, articles: list[int] | None = None) -> str:
    """The text of a page's lines, given the lines of its neighbour; without ``articles`` all marked lines are of one."""
    shared = shared_lines([t for _, t in lines], neighbour) if neighbour else set()
    deleted = set(deleted_lines([kind for kind, _ in lines], articles or [0] * len(lines), shared))
    return "\n".join(t for i, (kind, t) in enumerate(lines) if kind > FURNITURE and i not in deleted)


def shared_lines(a: Sequence[Hashable], b: Sequence[Hashable]) -> set[int]:
    """Indices of the lines of ``a`` in a longest common subsequence with ``b``, by bit vectors over ``b``."""
    places: dict[Hashable, int] = {}
    for j, line in enumerate(b):
        places[line] = places.get(line, 0) | 1 << j
    full, rows = (1 << len(b)) - 1, []
    row = full  # a 0 at j: the subsequence grows there
    for line in a:
        rows.append(row)
        hits = row & places.get(line, 0)
        row = (row + hits | row - hits) & full
    rows.append(row)
    found, i, j = set(), len(a), len(b)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            found.add(i - 1)
            i, j = i - 1, j - 1
    return found


def host_and_path(url: str | None) -> tuple[str, str]:
    """The host, and the path with its query but without fragment and closing slash."""
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").removeprefix("www."), parts.path.rstrip("/") + ("?" + parts.query if parts.query else "")
    except ValueError:
        return "", ""


def _content(lines: list[tuple[int, str]]) -> bytes:
    return xxhash.xxh3_128_digest("\n".join(t for _, t in lines).encode("utf-8", "surrogatepass"))


def _line_hashes(lines: list[tuple[int, str]]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for _, t in lines]


def _marks_of(lines: list[tuple[int, str]], articles: list[int]) -> bytes:
    """The kinds and articles of a page's lines."""
    return array("i", [x for (kind, _), a in zip(lines, articles) for x in (kind, a)]).tobytes()


def _page_key(content: bytes, marks: bytes) -> bytes:
    return xxhash.xxh3_128_digest(content + marks)


def _keys(pages: DataFrame) -> DataFrame:
    """``host, path, content, marks, lines`` for each page, lines as hashes."""
    columns = "host string, path string, content binary, marks binary, lines array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, page in zip(batch.column(0), batch.column(1)):
                lines, articles = read_page(page.as_py())
                rows.append((*host_and_path(url.as_py()), _content(lines), _marks_of(lines, articles), _line_hashes(lines)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, (
                pa.string(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int64())))], ["host", "path", "content", "marks", "lines"])

    return pages.select("url", "html").mapInArrow(run, columns)


def _ranked(keys: DataFrame) -> DataFrame:
    """Distinct pages with ``pos``, their place in the order of host and path; ``marks`` are all that a page's lines have on the host."""
    distinct = keys.groupBy("host", "content").agg(F.min("path").alias("path"), F.collect_set("marks").alias("marks"), F.first("lines").alias("lines"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * n, pa.int64()), pa.array(range(seen, seen + n), pa.int64())],
                                             [*batch.schema.names, "part", "seq"])
            seen += n

    columns = "host string, content binary, path string, marks array<binary>, lines array<long>, part long, seq long"
    placed = stage(distinct.select("host", "content", "path", "marks", "lines").repartitionByRange("host", "path", "content").sortWithinPartitions(
        "host", "path", "content").mapInArrow(number, columns), "page-order")
    begin, rows = 0, []
    for r in placed.groupBy("part").count().orderBy("part").collect():  # a row for each task
        rows.append((r["part"], begin))
        begin += r["count"]
    offsets = placed.sparkSession.createDataFrame(rows, "part long, begin long")
    return placed.join(F.broadcast(offsets), "part").select("host", "path", "content", "marks", "lines", (F.col("begin") + F.col("seq")).alias("pos"))


def _alike(a, b):
    """Length of the common beginning of two paths."""
    return F.size(F.filter(F.sequence(F.lit(0), F.least(F.length(a), F.length(b))), lambda i: F.substr(a, F.lit(1), i) == F.substr(b, F.lit(1), i)))


def nearest(ranked: DataFrame) -> DataFrame:
    """``pos, neighbour`` (both as places) for distinct pages that have a neighbour."""
    asked = ranked.select("host", "path", F.col("pos").alias("own"), F.explode(F.array(F.col("pos") - 1, F.col("pos") + 1)).alias("pos"))
    other = ranked.select("pos", F.col("host").alias("h"), F.col("path").alias("p"))
    pairs = asked.join(other, "pos").where(F.col("host") == F.col("h"))
    order = F.struct(-_alike(F.col("path"), F.col("p")), "pos")
    return pairs.groupBy("own").agg(F.min_by("pos", order).alias("neighbour")).select(F.col("own").alias("pos"), "neighbour")


def deletions(pages: DataFrame) -> DataFrame:
    """``host, key, deleted``: the numbers of the lines that differencing deletes, of every page that loses any."""
    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, content, marked, lines, others in zip(*(c.to_pylist() for c in batch.columns)):
                shared = shared_lines(lines, others)
                for marks in marked if shared else ():
                    of_line = array("i", marks)
                    if deleted := deleted_lines(of_line[::2], of_line[1::2], shared):
                        rows.append((host, _page_key(content, marks), deleted))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 3, (
                pa.string(), pa.binary(), pa.list_(pa.int32())))], ["host", "key", "deleted"])

    ranked = _ranked(_keys(pages))
    others = ranked.select(F.col("pos").alias("neighbour"), F.col("lines").alias("others"))
    paired = ranked.join(nearest(ranked), "pos").join(others, "neighbour")
    return paired.select("host", "content", "marks", "lines", "others").mapInArrow(difference, "host string, key binary, deleted array<int>")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text`` for each row."""
    given = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    gone = stage(deletions(given), "deleted-lines")
    schema = T.StructType([given.schema["page_id"], T.StructField("url", T.StringType()), T.StructField("host", T.StringType()),
                           T.StructField("key", T.BinaryType()), T.StructField("lines", T.ArrayType(T.StringType()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, keys, kept = [], [], []
            for url, page in zip(batch.column(1), batch.column(2)):
                lines, articles = read_page(page.as_py())
                hosts.append(host_and_path(url.as_py())[0])
                keys.append(_page_key(_content(lines), _marks_of(lines, articles)))
                kept.append([t if kind > FURNITURE else None for kind, t in lines])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hosts, pa.string()), pa.array(keys, pa.binary()),
                                              pa.array(kept, pa.list_(pa.string()))], schema.fieldNames())

    joined = given.mapInArrow(read, schema).join(gone, ["host", "key"], "left")
    left = F.filter("lines", lambda line, i: line.isNotNull() & (F.col("deleted").isNull() | ~F.array_contains("deleted", i)))
    return joined.select("page_id", "url", F.array_join(left, "\n").alias("text"))
