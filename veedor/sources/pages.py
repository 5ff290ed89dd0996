"""Captured HTML pages: one Arrow UDF turns markup into a struct, all else is SQL.

The parser is a small tree on top of the standard library's, enough for the selectors that catalogue
pages need.
"""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What is read out of a page.
PAGE = (
    "meta struct<canonical:string,og_title:string,og_description:string,og_url:string,meta_description:string,html_lang:string,data_lang:string>, "
    "breadcrumbs array<struct<position:int,name:string,item:string>>, summary map<string,string>, sections map<string,map<string,array<string>>>, "
    "links struct<source_manufacturer_url:string,source_generation_url:string,source_model_url:string>, title string, date_modified string, hrefs array<string>"
)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements that an opening tag of the same kind closes.
_CLOSES = {"dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class Node:
    """An element: its tag, attributes, parent and children, which are elements and texts."""

    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        """All elements below, in document order."""
        todo = [c for c in reversed(self.children) if isinstance(c, Node)]
        while todo:
            node = todo.pop()
            yield node
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]

    def find(self, *tags: str, **attrs) -> Node | None:
        return next(self.all(*tags, **attrs), None)

    def all(self, *tags: str, **attrs):
        return (n for n in self.walk() if n.tag in tags and all(n.attrs.get(k) == v for k, v in attrs.items()))

    def texts(self):
        todo = list(reversed(self.children))
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                yield node
            elif node.tag not in ("script", "style"):
                todo += reversed(node.children)

    def text(self) -> str | None:
        """Stripped texts joined by blanks, white space collapsed; null if empty."""
        return squeeze(" ".join(t.strip() for t in self.texts() if t.strip()))

    def has_class(self, name: str) -> bool:
        return name in (self.attrs.get("class") or "").split()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if self.at.tag in _CLOSES.get(tag, ()):
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def squeeze(text: str | None) -> str | None:
    return re.sub(r"\s+", " ", text.replace("﻿", " ")).strip() or None if text else None


def _breadcrumbs(root: Node) -> tuple[list[dict], str | None]:
    for script in root.all("script", type="application/ld+json"):
        try:
            data = json.loads(squeeze("".join(c for c in script.children if isinstance(c, str))) or "")
        except ValueError:
            continue
        if isinstance(data, dict) and "breadcrumb" in data:
            crumbs = data["breadcrumb"] if isinstance(data["breadcrumb"], dict) else {}
            items = [i for i in crumbs.get("itemListElement") or [] if isinstance(i, dict)]
            as_text = lambda x: x if isinstance(x, str) else None
            place = lambda x: int(x) if str(x).lstrip("-").isdigit() else None
            return [{"position": place(i.get("position")), "name": squeeze(as_text(i.get("name"))), "item": as_text(i.get("item"))} for i in items], as_text(data.get("dateModified"))
    return [], None


def read_page(html: str | None) -> dict:
    """All parts of one page; what is not there is null or empty."""
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    root = builder.root
    content = lambda **k: next((squeeze(m.attrs.get("content")) for m in root.all("meta", **k)), None)
    page = root.find("html") or Node("html", {}, None)
    canonical = next((n for n in root.all("link") if "canonical" in n.attrs.get("rel", "").split()), None)
    crumbs, modified = _breadcrumbs(root)
    summary, sections = {}, {}
    for holder in root.walk():
        if holder.attrs.get("id") == "qs":
            for block in holder.walk():
                if block.has_class("qs"):
                    dt, dd = block.find("dt"), block.find("dd")
                    label, value = squeeze(dt.attrs.get("title")) if dt else None, dd.text() if dd else None
                    if label and value:
                        summary[label] = value
    for section in root.all("section"):
        head = section.find("h2", "h3")
        rows = {}
        for row in section.all("div"):
            if row.has_class("sd") and row.parent.tag == "dl":
                dt = row.find("dt")
                values = [v for v in (dd.text() for dd in row.all("dd")) if v]
                if dt and dt.text() and values:
                    rows[dt.text()] = values
        if head and head.text() and rows:
            sections[head.text()] = rows
    trail = next((n for n in root.walk() if n.attrs.get("id") == "bc"), None)
    hrefs = [a.attrs.get("href") for a in trail.all("a")] if trail else []
    first, second = (hrefs + [None, None])[:2]
    h1 = root.find("h1")
    return {
        "meta": {
            "canonical": canonical.attrs.get("href") if canonical else None, "og_title": content(property="og:title"), "og_description": content(property="og:description"),
            "og_url": content(property="og:url"), "meta_description": content(name="description"), "html_lang": page.attrs.get("lang"), "data_lang": page.attrs.get("data-lang"),
        },
        "breadcrumbs": crumbs, "summary": summary, "sections": sections,
        "links": {"source_manufacturer_url": first, "source_generation_url": second, "source_model_url": second},
        "title": h1.text() if h1 else None, "date_modified": modified, "hrefs": [a.attrs.get("href") for a in root.all("a")],
    }


_PARTS = [part.split(" ", 1)[0] for part in re.split(r", (?=\w+ )", PAGE)]


def _read_pages(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_page(h) for h in html], columns=_PARTS)


def read_html(spark: SparkSession, *paths: str) -> DataFrame:
    """``source, html`` of HTML files; paths may hold globs; bytes that are no UTF-8 are dropped."""
    files = spark.read.format("binaryFile").load(list(paths))
    return files.select(F.col("path").alias("source"), F.replace(F.make_valid_utf8(F.col("content").cast("string")), F.lit("\ufffd"), F.lit("")).alias("html"))


def parse_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``page``, the parts of each page; SQL takes it from there."""
    made = re.sub(r"(^|, )(\w+) ", r"\1\2:", PAGE)
    return pages.withColumn("page", F.pandas_udf(_read_pages, f"struct<{made}>")(F.col(html)))


def _read_apart(html: pd.Series) -> pd.DataFrame:
    def one(text: str | None) -> dict:
        if text is None:
            return {"error": "the page has no HTML"}
        try:
            return {**read_page(text), "error": None}
        except Exception as error:  # one page's failure must not reach the others
            return {"error": repr(error)}

    return pd.DataFrame([one(h) for h in html], columns=[*_PARTS, "error"]).astype(object).where(lambda d: d.notna(), None)


def parse_pages_apart(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``page`` and ``error``: a page that cannot be read has an error and no parts."""
    made = re.sub(r"(^|, )(\w+) ", r"\1\2:", PAGE)
    read = pages.withColumn("_read", F.pandas_udf(_read_apart, f"struct<{made},error:string>")(F.col(html)))
    parts = F.struct(*[F.col(f"_read.{n}").alias(n) for n in _PARTS])
    return read.withColumns({"page": F.when(F.col("_read.error").isNull(), parts), "error": F.col("_read.error")}).drop("_read")
