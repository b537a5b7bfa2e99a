"""HTML extraction by nearest-URL page differencing.

Every page is paired with the page before and the page after it in the order of (host, URL path, page_id) of all
pages, whatever the partitions: keys are ranged over the cluster, and what lies on two sides of a border is paired
through a table of the borders. The nearer one of the two, by the common start of the paths, is the page's partner. The
text lines of both that lie outside article and main elements, menus and footers included, are aligned by their longest
common subsequence, and shared lines are deleted. What is left, without the elements that the result names (menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments), is the text. Lines inside an
article or main element take no part in the alignment: an article is often there under several paths, and passages of
it on other pages.

Nulls and edge cases: a null or empty html, or one without text, gives an empty text; a page without a host, or
alone on its host, loses no line; a partner with nearly the same text outside articles is a copy, and the other
neighbour is taken, or nothing deleted if that is one too; rows that agree in id, url and html are one page in the
order, and get the same text; equal lines within a page are matched in order of occurrence; broken markup never
fails, and any markup takes time in proportion to its length; pages of any length are read whole. Columns other
than page_id, url and html are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, ship

#: Elements that are no part of a text: the page's head, and those that the result names.
NO_TEXT = frozenset("head title nav menu footer aside dialog form button select textarea script style noscript template iframe".split())
NO_ROLE = frozenset("navigation menu menubar toolbar banner contentinfo complementary search form dialog alertdialog alert".split())
#: A class or id names such a part if all of its words are in these two lists, and one is in the first.
PARTS = frozenset(
    "ad ads advert adverts advertisement advertisements sponsored promo menu menus nav navbar navigation breadcrumb "
    "breadcrumbs header footer sidebar notice notices cookie cookies consent popup newsletter comment comments".split()
)
PLACES = frozenset(
    "site page main top bottom left right side global primary secondary user reader box bar banner list section container "
    "wrapper wrap block area item items link links slot unit 1 2 3".split()
)
RAW = frozenset("script style title textarea iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = frozenset("title meta link base script style noscript template head".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
#: What follows a tag's name: its end, or an attribute's name up to its value.
NEXT = re.compile(r"[\s/]*(?:(?P<close>>)|(?P<name>[^\s/>=][^\s/>=]*|=)(?P<value>\s*=\s*)?)")
BARE = re.compile(r"[^\s>]*")
ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.IGNORECASE) for name in RAW}
WORD = re.compile(r"[a-z0-9]+")
#: Where a line is.
NAMED, PLAIN, ARTICLE = range(3)
#: Pages that share more than this part of their text outside articles are copies.
COPY = 0.8


def _tokens(markup: str) -> Iterator[tuple[str | None, str, dict[str, str]]]:
    """Texts (None, text), start tags (name, "", attributes) and end tags (/name). Each place is read once: a search
    that finds nothing isn't made again."""
    at, n = 0, len(markup)
    closing = {'"': True, "'": True}  # whether such a quote may still follow
    while at < n:
        start = markup.find("<", at)
        if start < 0:
            yield None, markup[at:], {}
            return
        if start > at:
            yield None, markup[at:start], {}
        if markup.startswith("<!--", start):
            end = markup.find("-->", start + 4)
            at = n if end < 0 else end + 3
            continue
        if markup.startswith(("<!", "<?"), start):
            end = markup.find(">", start)
            at = n if end < 0 else end + 1
            continue
        found = NAME.match(markup, start + 1)
        if not found:
            yield None, "<", {}
            at = start + 1
            continue
        name, at, attributes = found[0].lower(), found.end(), {}
        while at < n:
            part = NEXT.match(markup, at)
            if not part:
                at = n  # white space up to the end
                break
            at = part.end()
            if part["close"]:
                break
            value = ""
            if part["value"]:
                quote = markup[at : at + 1]
                if quote in closing and closing[quote]:
                    end = markup.find(quote, at + 1)
                    if end < 0:
                        closing[quote] = False
                    else:
                        value, at = markup[at + 1 : end], end + 1
                if not value and markup[at - 1] != quote:
                    bare = BARE.match(markup, at)
                    value, at = bare[0], bare.end()
            attributes.setdefault(part["name"].lower(), value)
        yield name, "", attributes
        if name in RAW:
            end = ENDS[name].search(markup, at)
            at = n if end is None else end.end()
            yield f"/{name}", "", {}


def _named(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element is one that the text has no part of."""
    if name in NO_TEXT or name == "header" and not in_article:
        return True
    if name in ("html", "body", "main"):
        return False
    if not NO_ROLE.isdisjoint(attributes.get("role", "").lower().split()):
        return True
    for token in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        words = set(WORD.findall(token))
        if in_article:
            words -= {"header"}  # the article's own, with its title
        if words & PARTS and words <= PARTS | PLACES:
            return True
    return False


def lines_of(markup: str) -> list[tuple[str, int]]:
    """The text of each block with where it is: in an element that is named, elsewhere, or in an article."""
    lines: list[tuple[str, int]] = []
    names: list[str] = []
    where: list[int] = []
    blocks: list[int] = []  # places in the stack that hold blocks
    held: dict[str, int] = {}  # how many of each name are open
    texts: tuple[list[str], ...] = ([], [], [])

    def flush() -> None:
        for kind, text in enumerate(texts):
            if text:
                if line := " ".join(html.unescape("".join(text)).split()):
                    lines.append((line, kind))
                text.clear()

    def close(k: int) -> None:
        """Closes the elements from a place in the stack on."""
        for name in names[k:]:
            held[name] -= 1
        del names[k:], where[k:]
        while blocks and blocks[-1] >= k:
            blocks.pop()

    for name, text, attributes in _tokens(markup):
        here = where[-1] if where else PLAIN
        if name is None:
            texts[here].append(text)
            continue
        end = name[0] == "/"
        name = name.lstrip("/")
        if name in BLOCK:
            flush()
        if end:
            if held.get(name):
                k = len(names) - 1
                while names[k] != name:
                    k -= 1
                close(k)
            continue
        if held.get("head") and name not in IN_HEAD:
            flush()
            close(names.index("head"))  # the head ends where the body starts, with or without a tag
        if name in VOID:
            continue
        if name in BLOCK and blocks and names[blocks[-1]] == "p":
            close(blocks[-1])  # a block ends an open paragraph
        here = where[-1] if where else PLAIN
        if here != NAMED:
            if _named(name, attributes, here == ARTICLE):
                here = NAMED
            elif name in ("article", "main"):
                here = ARTICLE
        if name in BLOCK:
            blocks.append(len(names))
        names.append(name)
        where.append(here)
        held[name] = held.get(name, 0) + 1
    flush()
    return lines


def shared(a: list, b: list) -> set[int]:
    """Places in a of the longest common subsequence with b; the k-th of equal lines matches the k-th."""
    def numbered(lines: list) -> list[tuple]:
        seen: dict = {}
        out = []
        for x in lines:
            seen[x] = k = seen.get(x, 0) + 1
            out.append((x, k))
        return out

    place = {x: j for j, x in enumerate(numbered(b))}
    tails: list[int] = []  # the least place in b that ends a common subsequence of each length
    last: list[int] = []  # its place in a
    before: dict[int, int] = {}
    for i, x in enumerate(numbered(a)):
        if (j := place.get(x)) is not None:
            k = bisect_left(tails, j)
            tails[k : k + 1], last[k : k + 1] = [j], [i]
            before[i] = last[k - 1] if k else -1
    out: set[int] = set()
    i = last[-1] if last else -1
    while i >= 0:
        out.add(i)
        i = before[i]
    return out


def deleted(page: tuple[str, list, list], others: list[tuple[str, list, list]]) -> list[int]:
    """Places of the lines that go, of a page and its neighbours, the earlier one first: (path, lines, sizes)."""
    path, lines, sizes = page
    for _, far, far_sizes in sorted(others, key=lambda o: -len(commonprefix((path, o[0])))):
        both = shared(lines, far)
        if sum(sizes[i] for i in both) <= COPY * max(sum(sizes), sum(far_sizes)):
            return sorted(both)
    return []


def _mapped(df: DataFrame, rows: Callable[[list[list]], list[tuple]], schema: str, types: list[pa.DataType]) -> DataFrame:
    """A table from the columns of each batch, converted at once, to rows."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = rows([c.to_pylist() for c in batch.columns])
            columns = zip(*found) if found else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def _outside(columns: list[list]) -> list[tuple]:
    """Hashes and sizes of the lines outside articles. Lines that go anyway have no size."""
    import xxhash

    out = []
    for k1, k2, markup in zip(*columns, strict=True):
        lines = [(x, kind) for x, kind in lines_of(markup or "") if kind != ARTICLE]
        hashes = np.array([xxhash.xxh64_intdigest(x) for x, _ in lines], np.uint64).view(np.int64).tolist()
        out.append((k1, k2, hashes, [len(x) if kind == PLAIN else 0 for x, kind in lines]))
    return out


def _differences(columns: list[list]) -> list[tuple]:
    out = []
    for k1, k2, page, before, after in zip(*columns, strict=True):
        page, *others = [(x["path"], x["lines"], x["sizes"]) for x in (page, before, after) if x is not None]
        if gone := deleted(page, others):
            out.append((k1, k2, gone))
    return out


def _texts(columns: list[list]) -> list[tuple]:
    out = []
    for page_id, url, markup, gone in zip(*columns, strict=True):
        go, at, text = set(gone or ()), 0, []
        for line, kind in lines_of(markup or ""):
            if kind == ARTICLE or kind == PLAIN and at not in go:
                text.append(line)
            at += kind != ARTICLE
        text = " ".join(text)
        out.append((page_id, url, text, len(text)))
    return out


def _address(keyed: DataFrame) -> tuple[Column, Column]:
    host = F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.\-]*://([^/?#]+)", 1)
    path = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]+([^?#]*)", 1)
    return host.alias("host"), path.alias("path")


def neighbours(keyed: DataFrame) -> DataFrame:
    """k1, k2, path, and the keys before and after (k1, k2) of the same host, or null, for every page with a host.

    The keys are ranged; each range is ordered by itself, and its ends meet those of the ranges beside it in a table
    of one row for each range."""
    host, path = _address(keyed)
    keys = keyed.select(host, path, "page_id", "k1", "k2").where("host != ''").distinct()
    order = F.struct("host", "path", "page_id", "k1", "k2")
    ranged = keys.repartitionByRange("host", "path", "page_id", "k1", "k2")
    ranged = cut(ranged.select("k1", "k2", "path", order.alias("at"), F.spark_partition_id().alias("range")))
    ends = ranged.groupBy("range").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    by_range = W.orderBy("range")
    ends = ends.select("range", F.lag("last").over(by_range).alias("earlier"), F.lead("first").over(by_range).alias("later"))
    inside = W.partitionBy("range").orderBy("at")
    both = ranged.join(F.broadcast(ends), "range")  # a row for each range
    before = F.coalesce(F.lag("at").over(inside), F.col("earlier"))
    after = F.coalesce(F.lead("at").over(inside), F.col("later"))

    def key(x: str) -> Column:
        return F.when(F.col(f"{x}.host") == F.col("at.host"), F.struct(f"{x}.k1", f"{x}.k2")).alias(x)

    return both.select("k1", "k2", "path", "at", before.alias("before"), after.alias("after")).select(
        "k1", "k2", "path", key("before"), key("after")
    )


def differences(keyed: DataFrame) -> DataFrame:
    """k1, k2, gone: the places, among the lines outside articles, of those that a page shares with its partner."""
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    lists = _mapped(keyed.select("k1", "k2", "html"), _outside, "k1 long, k2 long, lines array<long>, sizes array<int>", types)
    lists = cut(lists.dropDuplicates(["k1", "k2"]))
    near = cut(neighbours(keyed).where("before is not null or after is not null"))
    own = near.join(lists, ["k1", "k2"]).select("k1", "k2", "before", "after", F.struct("path", "lines", "sizes").alias("page"))
    far = near.select("k1", "k2", "path").join(lists, ["k1", "k2"]).select(F.struct("k1", "k2").alias("k"), F.struct("path", "lines", "sizes").alias("v"))
    met = (
        own.join(far.toDF("before", "b"), "before", "left").join(far.toDF("after", "a"), "after", "left").select("k1", "k2", "page", "b", "a")
    )
    return _mapped(met, _differences, "k1 long, k2 long, gone array<int>", [pa.int64(), pa.int64(), pa.list_(pa.int32())])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page. Hashes of lines go to their neighbours, and the pages are shuffled
    once, by a hash of the row, to meet the places of their shared lines."""
    parts = [F.col("page_id").cast("long"), "url", "html"]
    keyed = pages.select(parts[0].alias("page_id"), "url", "html").withColumns(
        {"k1": F.xxhash64("page_id", "url", "html"), "k2": F.xxhash64(F.lit(1), "html", "url", "page_id")}
    )
    gone = cut(differences(keyed))
    found = keyed.join(gone, ["k1", "k2"], "left").select("page_id", "url", "html", "gone")
    types = [pa.int64(), pa.string(), pa.string(), pa.int64()]
    return _mapped(found, _texts, "page_id long, url string, text string, n_chars long", types)
