"""Main text of web pages.

Markup is read into lines, one for each block of text, in one pass over the whole page. Elements that
hold no main text by their kind or by what they are called (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles, comments) are left out.

Main text is found by nearest-URL page differencing: pages are put in the order of host and URL path, each
is paired with the one before or after it that has more of the path in common, their lines are aligned by a
longest common subsequence, and the lines they share are deleted. A check against the marks follows: where a
page says which part is its article (`article`, `main`), shared lines of that part are put back, as two pages
of a host may have a paragraph in common that belongs to both articles, and lines outside it go.

Copies of one page (one host and path, the same lines, other query strings) are one page in that order, so
none is compared with another; each has the text that the page has.

Pages are sorted by range over all tasks, so a host of any size is spread; neighbours meet by rank. Only hashes of
lines and places move for that: the lines are stored once, in buckets, and the places come to them.

Defined cases: a null page is empty and has an empty text; a null or odd URL is a host of its own kind
(the empty one); a page alone on its host has no neighbour and loses nothing by differencing; a page of
which all lines are shared with a page of another path has an empty text; repeated rows are pages of their own; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
from hashlib import blake2b
from html import unescape
from os.path import commonprefix
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from celltide.llm.frames import as_text, bucketed, load, materialize, shuffles

RAW = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript", "template"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
    "time", "tt", "u", "var", "wbr",
}
ASIDE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "svg", "head", "object", "audio", "video"}
MAIN = {"article", "main"}
CALLED = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|footer|sidebar|cookies?|consent|notices?|banner|adverts?|"
    r"advertisements?|ads?|sponsor|sponsored|promo|popup|modal|newsletter|subscribe|comments?|replies|share|"
    r"sharing|social|related|breadcrumbs?|pagination|disclaimer|alert|toolbar)(?:$|[\s_-])"
)
HEAD = re.compile(r"(?:^|[\s_-])(?:header|masthead)(?:$|[\s_-])")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
REST = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*>")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
BLOCK = 1024  # rows of one task, whose places meet them as one row; a power of two, as no block has rows of two tasks
PARSED = ("uid BIGINT, page_id BIGINT, url STRING, host STRING, path STRING, marked BOOLEAN, lines ARRAY<STRING>, "
          "inside ARRAY<BOOLEAN>, keys ARRAY<BIGINT>")


def _left_out(name, attributes, inside):
    """Whether an element holds no main text."""
    if name in ASIDE or (name == "header" and not inside):
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    called = []
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c).lower()
        if key in ("class", "id", "role"):
            if key == "role" and value in ("navigation", "banner", "contentinfo", "complementary", "search", "alert"):
                return True
            called.append(value)
        elif key == "style" and "display:none" in value.replace(" ", ""):
            return True
    if re.search(r"(?:^|\s)hidden(?:\s|$)", attributes):
        return True
    called = " ".join(called)
    if name == "article" and not inside:
        return False
    return bool(CALLED.search(called)) or (not inside and bool(HEAD.search(called)))


def read_lines(html: str) -> tuple[list[tuple[str, bool]], bool]:
    """(text, whether inside the article) of each block that is not left out; whether there is one."""
    lines, parts = [], []
    inside, marked = 0, False
    out_name, out_depth = "", 0
    at, n = 0, len(html)

    def close():
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            parts.clear()
            if text:
                lines.append((text, inside > 0))

    while at < n:
        tag = html.find("<", at)
        if tag < 0:
            tag = n
        if tag > at and not out_depth:
            parts.append(html[at:tag])
        if tag == n:
            break
        if html.startswith("<!--", tag):
            end = html.find("-->", tag + 4)
            at = n if end < 0 else end + 3
            continue
        closing = html.startswith("</", tag)
        name = NAME.match(html, tag + 1 + closing)
        if not name:
            if html.startswith(("<!", "<?", "</"), tag):
                end = html.find(">", tag)
                at = n if end < 0 else end + 1
            else:
                if not out_depth:
                    parts.append("<")
                at = tag + 1
            continue
        rest = REST.match(html, name.end())
        if rest:
            at = rest.end()
        else:
            end = html.find(">", name.end())
            at = n if end < 0 else end + 1
        attributes = html[name.end() : at - 1]
        name = name.group().lower()
        if not closing and name in RAW:
            end = re.compile(rf"</{name}\b", re.IGNORECASE).search(html, at)
            at = n if not end else end.start()
            if end:
                end = html.find(">", at)
                at = n if end < 0 else end + 1
            continue
        if out_depth and not (name in MAIN and not closing and not inside):
            if name == out_name and not attributes.endswith("/"):
                out_depth += -1 if closing else 1
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in INLINE:
            close()
        if closing:
            if name in MAIN and inside:
                inside -= 1
            continue
        if name in MAIN and not inside:
            out_depth = 0  # an unclosed element before the article does not hide it
        if name not in VOID and not attributes.endswith("/") and _left_out(name, attributes, inside):
            out_name, out_depth = name, 1
        elif name in MAIN:
            inside += 1
            marked = True
    close()
    return lines, marked


def _hash(line):
    digest = blake2b(line.encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _parsed(batches):
    part, seen = TaskContext.get().partitionId(), 0
    for batch in batches:
        out = [[] for _ in range(9)]
        for page, url, html in zip(*(c.to_pylist() for c in batch.columns[:3])):
            lines, marked = read_lines(html)
            try:
                split = urlsplit(url or "")
                host, path = (split.netloc or "").lower(), split.path
            except ValueError:
                host, path = "", url
            row = ((part << 40) + seen, page, url, host, path, marked, [t for t, _ in lines], [i for _, i in lines],
                   [_hash(t) for t, _ in lines])
            for column, value in zip(out, row):
                column.append(value)
            seen += 1
        kinds = [pa.int64(), pa.int64()] + [pa.string()] * 3 + [
            pa.bool_(), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.int64())]
        names = ["uid", "page_id", "url", "host", "path", "marked", "lines", "inside", "keys"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)


def common_lines(a: list, b: list) -> list[int]:
    """Places in a of a longest common subsequence of a and b: rows of bits, then a walk back."""
    match = {}
    for j, x in enumerate(b):
        match[x] = match.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows, v = [], full
    for x in a:
        u = v & match.get(x, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    out, j = [], len(b)
    for i in range(len(a) - 1, -1, -1):
        here = rows[i] & ((1 << j) - 1)
        above = (rows[i - 1] if i else full) & ((1 << j) - 1)
        if here.bit_count() < above.bit_count():
            out.append(i)
            gone = ~here & ((1 << j) - 1)
            j = gone.bit_length() - 1  # the last place of b that the subsequence up to here uses
    return out[::-1]


def _shared(batches):
    """same and the places of the lines that a page shares with its nearest neighbour."""
    for batch in batches:
        sames, places = [], []
        for same, path, keys, p0, k0, p1, k1 in zip(*(c.to_pylist() for c in batch.columns[:7])):
            near = [len(commonprefix([path, p])) if k is not None else -1 for p, k in ((p0 or "", k0), (p1 or "", k1))]
            other = (k0 if near[0] >= near[1] else k1) or []
            sames.append(same)
            places.append(common_lines(keys, other))
        yield pa.record_batch({"same": pa.array(sames, pa.int64()), "places": pa.array(places, pa.list_(pa.int32()))})


def _numbered(batches):
    part, seen = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield batch.append_column("part", pa.array([part] * n, pa.int32())).append_column(
            "nth", pa.array(np.arange(seen, seen + n)))
        seen += n


def read_pages(pages: DataFrame, id_column="page_id", url="url", html="html") -> DataFrame:
    """The lines of each page, whether they are in its article, and `same`, one number for the copies of a page."""
    rows = pages.select(
        F.col(id_column).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"),
        as_text(pages, html).alias("html"))
    parsed = rows.mapInArrow(_parsed, PARSED).withColumn("block", F.expr(f"uid div {BLOCK}"))
    return bucketed(parsed, "block", "parsed").withColumn("same", F.xxhash64("host", F.lit("\n"), "path", F.lit("\n"), "keys"))


def shared_lines(parsed: DataFrame) -> DataFrame:
    """same, places: the places of the lines that each page shares with its nearest neighbour, marked or not."""
    spark = parsed.sparkSession
    first = materialize(parsed.groupBy("same").agg(F.min("uid").alias("uid")), "first")
    ordered = parsed.select("uid", "page_id", "host", "path", "keys").join(first, "uid")
    ordered = ordered.repartitionByRange(shuffles(spark), "host", "path", "page_id", "uid").sortWithinPartitions(
        "host", "path", "page_id", "uid").select("same", "host", "path", "keys")
    ordered = materialize(ordered.mapInArrow(
        _numbered, "same BIGINT, host STRING, path STRING, keys ARRAY<BIGINT>, part INT, nth BIGINT"), "ordered")
    # One row for each part.
    counts = ordered.groupBy("part").agg(F.count("*").alias("n"))
    line = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", F.coalesce(F.sum("n").over(line), F.lit(0)).alias("before"))
    ask = ranked = materialize(ordered.join(before, "part").select(
        "same", "host", "path", "keys", (F.col("before") + F.col("nth")).alias("rank")), "ranked")
    near = ranked.select("rank", "host", "path", "keys")
    for k, shift in ((0, 1), (1, -1)):
        other = near.select(
            (F.col("rank") + shift).alias("rank"), F.col("host").alias("host"), F.col("path").alias(f"p{k}"),
            F.col("keys").alias(f"k{k}"))
        ask = ask.join(other, ["rank", "host"], "left")
    return ask.select("same", "path", "keys", "p0", "k0", "p1", "k1").mapInArrow(
        _shared, "same BIGINT, places ARRAY<INT>")


def with_places(parsed: DataFrame, shared: DataFrame) -> DataFrame:
    """The pages with `places`, those of their lines that are shared.

    The lines stay where they were stored, in buckets of blocks. Only places move: one row for each block, with the
    places of its rows in their order; the rows of a block are numbered without gaps.
    """
    each = parsed.select("uid", "block", "same").join(shared, "same").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("uid", "places"))).alias("each"))
    own = F.get("each", (F.col("uid") % BLOCK).cast("int"))["places"]
    return parsed.join(each.hint("shuffle_hash"), "block").withColumn("places", own).drop("each")


def main_text(pages: DataFrame, id_column="page_id", url="url", html="html") -> DataFrame:
    """page_id, url, text, n_chars of each page."""
    parsed = read_pages(pages, id_column, url, html)
    marked = F.col("marked")

    def kept(_, i):
        article = F.get("inside", i)
        return (article | ~F.array_contains("places", i)) & (article | ~marked)

    text = F.array_join(F.filter("lines", kept), " ").alias("text")
    told = with_places(parsed, shared_lines(parsed)).select("page_id", "url", text)
    return told.withColumn("n_chars", F.length("text").cast("bigint"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(load(spark, sf_dir, "pages"))

