"""Reading HTML with the standard library's parser, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructField, StructType

# Elements whose text is no content; elements without end tag.
SKIPPED = {"script", "style", "noscript", "nav", "footer", "header", "form"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = {"p", "div", "li", "tr", "section", "article", "h1", "h2", "h3", "h4", "h5", "h6", "br", "table", "ul", "ol", "blockquote", "pre", "dd", "dt", "main"}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self, skip: set[str] = SKIPPED) -> str:
        """Text with one line per block, skipped elements left out."""
        out: list[str] = []
        stack: list = [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.tag not in skip:
                if x.tag in BLOCKS:
                    out.append("\n")
                    stack.append("\n")
                stack += list(reversed(x.children))
        lines = (" ".join(line.split()) for line in "".join(out).split("\n"))
        return "\n".join(line for line in lines if line)

    def has(self, kind: str) -> bool:
        """Whether a simple selector (tag, .class, #id) fits."""
        if kind.startswith("."):
            return kind[1:] in (self.attrs.get("class") or "").split()
        if kind.startswith("#"):
            return self.attrs.get("id") == kind[1:]
        return self.tag == kind


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID and self.depth < 2000:
            self.at, self.depth = node, self.depth + 1

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            while self.at is not node:
                self.at, self.depth = self.at.parent, self.depth - 1
            self.at, self.depth = node.parent, self.depth - 1

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | Node | None) -> Node:
    """A tree of any text; broken markup gives what could be read.  A tree stays as it is."""
    if isinstance(html, Node):
        return html
    builder = _Builder()
    try:
        builder.feed(html or "")
        builder.close()
    except (AssertionError, ValueError):
        pass
    return builder.root


def text_of(html: str | None) -> str:
    return parse(html).text() if html else ""


def links_of(html: str | None) -> list[dict]:
    """href and text of links, the first of each address."""
    seen, out = set(), []
    for n in parse(html).walk():
        if n.tag == "a" and (href := n.attrs.get("href", "").strip()) and href not in seen:
            seen.add(href)
            out.append({"href": href, "text": " ".join(n.text().split())})
    return out


def images_of(html: str | None) -> list[str]:
    """Addresses of images, lazy ones too, the first of each."""
    found = [n.attrs.get("data-src") or n.attrs.get("src") or "" for n in parse(html).walk() if n.tag == "img"]
    return list(dict.fromkeys(x.strip() for x in found if x.strip()))


def tables_of(html: str | None, names: dict[str, str] | None = None) -> list[dict]:
    """Rows of tables with a heading row as maps from heading to cell text;
    ``names`` renames headings (lower case).  Cells beyond the headings are dropped."""
    out = []
    for table in parse(html).walk():
        if table.tag != "table":
            continue
        head: list[str] = []
        for row in table.walk():
            if row.tag != "tr":
                continue
            cells = [c for c in row.children if isinstance(c, Node) and c.tag in ("td", "th")]
            texts = [" ".join(c.text().split()) for c in cells]
            if not head:
                head = [(names or {}).get(t.lower(), t.lower()) for t in texts]
            elif any(texts):
                out.append(dict(zip(head, texts)))
    return out


_DATE_META = ("article:published_time", "pubdate", "publishdate", "date", "dc.date", "datepublished")


def detail_of(html: str | None, containers: list[str], least: int = 50) -> dict:
    """title (h1, else title), date (meta) and body: the first container with enough
    text, else the block with the longest own paragraphs, else the description."""
    root = parse(html)
    first = lambda tag: next((" ".join(n.text().split()) for n in root.walk() if n.tag == tag and n.text()), "")
    meta = {(n.attrs.get("property") or n.attrs.get("name") or "").lower(): n.attrs.get("content", "") for n in root.walk() if n.tag == "meta"}
    body = ""
    for kind in containers:
        body = next((t for n in root.walk() if n.has(kind) and len(t := n.text()) >= least), "")
        if body:
            break
    if not body:
        own = lambda n: sum(len(c.text()) for c in n.children if isinstance(c, Node) and c.tag in ("p", "li"))
        best = max((n for n in root.walk() if n.tag not in SKIPPED), key=own, default=None)
        body = best.text() if best is not None and own(best) >= least else ""
    body = body or meta.get("description", "") or meta.get("og:description", "")
    return {"title": first("h1") or first("title"), "date": next((meta[k] for k in _DATE_META if meta.get(k)), ""), "body": body}


_LINK = StructType([StructField("href", StringType()), StructField("text", StringType())])
_DETAIL = StructType([StructField("title", StringType()), StructField("date", StringType()), StructField("body", StringType())])


def html_text(c: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(text_of), StringType())(c)


def html_links(c: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(links_of), ArrayType(_LINK))(c)


def html_images(c: Column) -> Column:
    return F.pandas_udf(lambda s: s.map(images_of), ArrayType(StringType()))(c)


def html_tables(c: Column, names: dict[str, str] | None = None) -> Column:
    return F.pandas_udf(lambda s: s.map(lambda h: tables_of(h, names)), ArrayType(MapType(StringType(), StringType())))(c)


def html_detail(c: Column, containers: list[str], least: int = 50) -> Column:
    return F.pandas_udf(lambda s: pd.DataFrame([detail_of(h, containers, least) for h in s], columns=["title", "date", "body"]), _DETAIL)(c)


_PAGE = StructType([*_DETAIL.fields, StructField("links", ArrayType(_LINK)), StructField("images", ArrayType(StringType()))])


def html_page(c: Column, containers: list[str], least: int = 50) -> Column:
    """Detail, links and images of a page, of one parse."""

    def read(pages: pd.Series) -> pd.DataFrame:
        rows = []
        for page in pages:
            root = parse(page)
            rows.append({**detail_of(root, containers, least), "links": links_of(root), "images": images_of(root)})
        return pd.DataFrame(rows, columns=["title", "date", "body", "links", "images"])

    return F.pandas_udf(read, _PAGE)(c)


def table_records(frame: DataFrame, html: str, names: dict[str, str] | None = None) -> DataFrame:
    """One row per table row of a page, its cells in ``record``."""
    return frame.withColumn("record", F.explode(html_tables(F.col(html), names)))


def same_host(url: Column, other: Column) -> Column:
    host = lambda c: F.lower(F.regexp_extract(c, r"^[a-z]+://([^/?#]+)", 1))
    return (host(url) == host(other)) & (host(url) != "")




def labelled(c: Column, label: str, until: str) -> Column:
    """Text between a label and the next one, as lists of standards print it."""
    return F.trim(F.regexp_extract(c, rf"(?is)\Q{label}\E\s*:?\s*(.*?)\s*(?:\Q{until}\E|$)", 1))
