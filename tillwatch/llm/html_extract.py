"""Main text of web pages by markup and by differencing with the nearest page of the host.

A page is cut into lines, one per block of its markup. Lines inside elements that never hold an article
(menus, headers of the page, footers, sidebars, adverts, forms, scripts, comments) go, unless such a form or named block
holds most of the page. What is left is compared with the page whose URL path is nearest on the same host: the longest
common subsequence of both pages' lines is what the template wrote, and shared lines are deleted. Lines inside a marked
article are deleted only if they are nothing but links, for an article may share a line with another.

Pages of a host with the same lines are one class, and so have the same text. One page of each class stands in the order of
paths, which is cut into blocks by position, whatever the size of a host; a block sees the ``REACH`` pages before
and after it. A neighbour that shares most of its lines is a copy, and the next one is looked at instead. What is sorted and
compared are hashes of lines. Every page with a URL is compared, also one whose lines are all kept by their marks.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from tillwatch.llm.common import free_name, ship, struct_of, written

#: Classes in a block of the order of paths, and how many of the next block it sees on either side.
BLOCK, REACH = 1024, 32
#: A neighbour that shares more of a page's lines outside articles than this is a copy of it.
COPY = 0.8
#: A form or named block with more of the page's text than this is no chrome.
MOST = 0.6

# Elements by what they mean for the text.
_RAW = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b[^<>]*>.*?(?:</\1\s*>|\Z)|<title\b[^<>]*>[^<]*|<![^<>]*>|<\?[^<>]*>", re.S | re.I)
_TITLE = re.compile(r"<title\b[^<>]*>.*?</title\s*>", re.S | re.I)
_START = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_STOP = re.compile(r"[\"'>]")
CHROME_TAGS = frozenset("nav footer aside button dialog menu select fieldset noscript template svg math iframe object canvas textarea".split())
CONTENT_TAGS = frozenset("article main".split())
INLINE_TAGS = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Head among them: its end tag may be missing, and all that it holds without being shown goes on its own.
VOID_TAGS = frozenset("area base br col embed head hr img input link meta param source track wbr".split())
#: Closed by the start of another block element, so that an unclosed one does not swallow the page.
_LOOSE = frozenset("p li dt dd tr td th option".split())
CHROME_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|breadcrumbs?|comments?|comment-?list|cookies?|consent|copyright|disqus|footer|masthead|"
    r"menu|modal|nav|navbar|navigation|newsletter|notices?|pagination|pager|popup|promo\w*|related|replies|responses|share|sharing|sidebar|"
    r"site-?header|social|sponsor\w*|subscribe|subscription|toolbar|widget)(?=$|[\s_-])", re.I)
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert".split())
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


@dataclass
class Line:
    text: str
    inside: bool  # in an article or main element
    links: bool  # all of it is link text


def chrome_of(name: str, attributes: str, in_content: bool) -> str:
    """``hard`` for what never holds an article, ``soft`` for what may hold it against its name, else nothing."""
    if name in CHROME_TAGS or (name == "header" and not in_content):
        return "hard"
    if name == "form":
        return "soft"
    if not attributes or name in ("html", "body", "main") or (name == "article" and not in_content):
        return ""
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").strip()
        if key in ("class", "id") and CHROME_NAMES.search(_CAMEL.sub("-", value)):
            return "soft"
        if (key == "role" and value.lower() in CHROME_ROLES) or key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return "hard"
    return ""


def tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """(start, end, whether it closes, name, attributes) of the page's tags, in time linear in the page.

    A quoted value may hold ``>``. A quote that is never closed is an ordinary character.
    """
    last = page.rfind(">")
    closed = {'"': page.rfind('"'), "'": page.rfind("'")}
    at = 0
    while m := _START.search(page, at):
        end = m.end()
        if end > last:
            return
        while stop := _STOP.search(page, end):
            mark = stop[0]
            end = stop.end()
            if mark == ">":
                break
            if end <= closed[mark]:
                end = page.find(mark, end) + 1
        else:
            return
        yield m.start(), end, bool(m[1]), m[2].lower(), page[m.end():end - 1]
        at = end


def lines_of(page: str) -> list[Line]:
    """The page's blocks in order, without those of chrome elements; references decoded, white space single."""
    page = _RAW.sub(" ", _TITLE.sub(" ", page, count=1))
    out: list[tuple[Line, tuple[int, ...]]] = []
    stack: list[tuple[str, str, bool]] = []  # name, chrome, content
    opened: Counter[str] = Counter()
    soft: list[int] = []  # the open named blocks
    blocks = 0
    text: list[str] = []
    linked = plain = hard = content = at = 0

    def end_line() -> None:
        nonlocal linked, plain
        if text:
            line = " ".join(html.unescape("".join(text)).split())
            if line:
                out.append((Line(line, content > 0, linked > 0 and plain == 0), tuple(soft)))
            text.clear()
        linked = plain = 0

    def add(piece: str) -> None:
        nonlocal linked, plain
        if piece and not hard:
            text.append(piece)
            if not piece.isspace():
                if opened["a"]:
                    linked += 1
                else:
                    plain += 1

    def close() -> None:
        nonlocal hard, content
        name, kind, is_content = stack.pop()
        opened[name] -= 1
        hard -= kind == "hard"
        content -= is_content
        if kind == "soft":
            soft.pop()

    for start, end, closes, name, attributes in tags(page):
        add(page[at:start])
        at = end
        if name not in INLINE_TAGS:
            end_line()
        if closes:
            if opened[name]:
                while stack[-1][0] != name:
                    close()
                close()
        elif name not in VOID_TAGS and not attributes.endswith("/"):
            if name not in INLINE_TAGS and stack and stack[-1][0] in _LOOSE and (stack[-1][0] == name or stack[-1][0] == "p"):
                close()
            kind = chrome_of(name, attributes, content > 0)
            stack.append((name, kind, name in CONTENT_TAGS and not kind))
            opened[name] += 1
            hard += kind == "hard"
            content += stack[-1][2]
            if kind == "soft":
                soft.append(blocks)
                blocks += 1
    tail = page[at:]
    cut = re.search(r"<[a-zA-Z/!?][^<>]*\Z", tail)  # a tag that the page breaks off in
    add(tail[:cut.start()] if cut else tail)
    end_line()
    if blocks:
        held: Counter[int] = Counter()
        for line, within in out:
            for block in within:
                held[block] += len(line.text)
        whole = sum(len(line.text) for line, _ in out)
        real = {block for block, size in held.items() if size > MOST * whole}
        out = [(line, within) for line, within in out if real.issuperset(within)]
    found = [line for line, _ in out]
    return [line for line in found if line.inside] if any(line.inside for line in found) else found


def shared_lines(one: Sequence, other: Sequence) -> set[int]:
    """Places in ``one`` that a longest common subsequence with ``other`` uses.

    Equal ends are matched first. In the middle only lines that both have count, and the rest is solved by
    the table of subsequence lengths in time |one| * |other|.
    """
    found: set[int] = set()
    low, n, m = 0, len(one), len(other)
    while low < min(n, m) and one[low] == other[low]:
        found.add(low)
        low += 1
    while n > low and m > low and one[n - 1] == other[m - 1]:
        n, m = n - 1, m - 1
        found.add(n)
    both = set(one[low:n]) & set(other[low:m])
    a = [k for k in range(low, n) if one[k] in both]
    b = [k for k in range(low, m) if other[k] in both]
    if not a or not b:
        return found
    best = [[0] * (len(b) + 1)]
    for x in reversed(a):
        row, below = [0] * (len(b) + 1), best[-1]
        for j in range(len(b) - 1, -1, -1):
            row[j] = below[j + 1] + 1 if one[x] == other[b[j]] else max(below[j], row[j + 1])
        best.append(row)
    i = j = 0
    while i < len(a) and j < len(b):
        if one[a[i]] == other[b[j]]:
            found.add(a[i])
            i, j = i + 1, j + 1
        elif best[len(a) - i - 1][j] >= best[len(a) - i][j + 1]:
            i += 1
        else:
            j += 1
    return found


def shared_with_nearest(page: tuple, others: list[tuple]) -> set[int]:
    """Places of the lines that ``page`` shares with the first of ``others`` that is no copy of it.

    A page is (hashes of its lines, which of them count): of the lines outside articles that are more than links. A
    page without such lines knows a copy by all of its lines.
    """
    own, counts = page
    wanted = [k for k in range(len(own)) if counts[k]] or list(range(len(own)))
    for other, _ in others:
        shared = shared_lines(own, other)
        if sum(k in shared for k in wanted) <= COPY * len(wanted) or not wanted:
            return shared
    return set()


def nearness(path: str, other: str) -> int:
    """How many leading characters two paths share."""
    n = 0
    for a, b in zip(path, other, strict=False):
        if a != b:
            break
        n += 1
    return n


def by_nearness(place: int, paths: Sequence[str], low: int, high: int) -> list[int]:
    """The places from ``low`` to ``high`` but ``place``, nearest path first, of equally near ones the nearer place.

    Paths in order share less and less to either side, so the nearest comes from one of two ends that are merged.
    """
    out, a, b = [], place - 1, place + 1
    near_a = nearness(paths[place], paths[a]) if a >= low else -1
    near_b = nearness(paths[place], paths[b]) if b < high else -1
    while a >= low or b < high:
        if near_a >= near_b:
            out.append(a)
            a -= 1
            near_a = min(near_a, nearness(paths[place], paths[a])) if a >= low else -1
        else:
            out.append(b)
            b += 1
            near_b = min(near_b, nearness(paths[place], paths[b])) if b < high else -1
    return out


def host_of(url: Column) -> Column:
    """The host in lower case, without credentials, port and a leading www; the whole text if there is none."""
    host = F.regexp_extract(F.lower(url), r"^\s*[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]*)", 1)
    return F.when(host != "", host).otherwise(F.coalesce(F.lower(url), F.lit("")))


def path_of(url: Column) -> Column:
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*|#.*$", "")


def line_class(page: list[Line]) -> bytes:
    """128 bits that name the page's lines and their marks."""
    return xxh3_128_digest("\n".join(f"{x.inside:d}{x.links:d}{x.text}" for x in page).encode("utf-8", "surrogatepass"))


def ordered_classes(rows: DataFrame) -> DataFrame:
    """(host, class, path, hashes, counts, place): one page of each class of lines of a host, numbered in order of paths.

    Pages without a URL or without lines have no neighbours and are left out.
    """
    schema = struct_of(("host", T.StringType()), ("path", T.StringType()), ("class", T.BinaryType()),
                       ("hashes", T.ArrayType(T.LongType())), ("counts", T.ArrayType(T.BooleanType())))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for host, path, source in zip(batch["host"], batch["path"], batch["h"], strict=True):
                page = lines_of(source)
                if page:
                    hashes = np.array([xxh3_64_intdigest(x.text.encode("utf-8", "surrogatepass")) for x in page], dtype=np.uint64).view(np.int64)
                    out.append((host, path, line_class(page), hashes, [not x.links and not x.inside for x in page]))
            yield pd.DataFrame(out, columns=schema.names)

    pages = rows.where("u is not null and h is not null").select("host", "path", "h").mapInPandas(run, schema)
    first = F.min(F.struct("path", "hashes", "counts")).alias("row")
    classes = written(pages.groupBy("host", "class").agg(first).select("host", "class", "row.*"), "page-classes")
    placed = classes.repartitionByRange("host", "path", "class").sortWithinPartitions("host", "path", "class")
    placed = written(placed.withColumn("at", F.monotonically_increasing_id()), "page-order")
    part = F.shiftright("at", 33)
    # one row per task of the sort: how many rows stand before it
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, total = {}, 0
    for number in sorted(sizes):
        before[number] = total
        total += sizes[number]
    if not before:
        return placed.withColumnRenamed("at", "place")
    offsets = placed.sparkSession.createDataFrame(list(before.items()), "part long, before long")
    return placed.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn(
        "place", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("at", "part", "before")


def deletions(classes: DataFrame) -> DataFrame:
    """(host, class, gone): the places of the lines that each class of a host shares with its nearest page."""
    schema = struct_of(("host", T.StringType()), ("class", T.BinaryType()), ("gone", T.ArrayType(T.IntegerType())))
    place = F.col("place")
    blocks = F.sequence(F.floor(F.greatest(place - REACH, F.lit(0)) / BLOCK), F.floor((place + REACH) / BLOCK))
    dealt = classes.select("*", F.explode(blocks).alias("block"))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place", ignore_index=True)
        hosts, paths, places = rows["host"].tolist(), rows["path"].tolist(), rows["place"].to_numpy()
        pages = [(h.tolist(), list(c)) for h, c in zip(rows["hashes"], rows["counts"], strict=True)]
        edges = [0, *(k for k in range(1, len(hosts)) if hosts[k] != hosts[k - 1]), len(hosts)]
        out = []
        for start, end in zip(edges, edges[1:], strict=False):
            for k in range(start, end):
                if places[k] // BLOCK == key[0]:
                    low, high = max(start, k - REACH), min(end, k + REACH + 1)
                    gone = shared_with_nearest(pages[k], [pages[n] for n in by_nearness(k, paths, low, high)])
                    if gone:
                        out.append((hosts[k], rows["class"][k], sorted(gone)))
        return pd.DataFrame(out, columns=schema.names)

    return dealt.groupBy("block").applyInPandas(run, schema)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html", name: str = "text") -> DataFrame:
    """(key, url, text) of every row of ``pages``: the main text, blocks in page order joined by one space.

    Null and empty pages have an empty text. A page without a URL, or alone on its host, is extracted by its
    markup alone. Of the neighbours in the order of paths the one whose path shares most characters is the nearest, of equally
    near ones the nearer place, then the earlier one; copies are passed over, up to ``REACH`` pages away on either side.
    Pages of a host with the same lines have the same text, that of the one with the smallest path. Repeated rows each
    have a row, whatever their keys. Other columns are not read.
    """
    name = free_name([key, url], name)
    rows = pages.select(F.col(key).alias("k"), F.col(url).alias("u"), F.col(source).alias("h"))
    rows = rows.withColumn("host", host_of(F.col("u"))).withColumn("path", path_of(F.col("u")))
    kind = pages.schema[key].dataType
    ship(pages.sparkSession)
    gone = written(deletions(ordered_classes(rows)), "page-deletions")
    plain = struct_of((key, kind), (url, T.StringType()), (name, T.StringType()))
    lined = struct_of(("k", kind), ("u", T.StringType()), ("host", T.StringType()), ("class", T.BinaryType()),
                      ("lines", T.ArrayType(T.StringType())), ("loose", T.ArrayType(T.BooleanType())))

    def alone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, u, h in zip(batch["k"].array, batch["u"], batch["h"], strict=True):
                out.append((k, u, " ".join(x.text for x in lines_of(h)) if isinstance(h, str) else ""))
            yield pd.DataFrame(out, columns=plain.names)

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, u, h, host in zip(batch["k"].array, batch["u"], batch["h"], batch["host"], strict=True):
                page = lines_of(h)
                out.append((k, u, host, line_class(page), [x.text for x in page], [x.links or not x.inside for x in page]))
            yield pd.DataFrame(out, columns=lined.names)

    done = rows.where("u is null or h is null").select("k", "u", "h").mapInPandas(alone, plain)
    rest = rows.where("u is not null and h is not null").select("k", "u", "h", "host").mapInPandas(compared, lined)
    kept = F.filter(F.transform("lines", lambda x, n: F.when(
        F.col("gone").isNull() | ~F.array_contains("gone", n) | ~F.get("loose", n), x)), lambda x: x.isNotNull())
    rest = rest.join(gone, ["host", "class"], "left").select(
        F.col("k").alias(key), F.col("u").alias(url), F.array_join(kept, " ").alias(name))
    return done.unionByName(rest)
