"""Small per-page HTML reader used inside tasks, and the Arrow functions over it.

Stored pages hold no rendered state: visibility and script-made text do not exist.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

VOID = set("area base br col embed hr img input link meta source track wbr".split())
# These stand on lines of their own, so their text does not touch its neighbours.
BLOCK = set(
    "address article aside blockquote body br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr li main nav ol option p pre section table tbody td tfoot th thead tr ul".split()
)
# An opening tag ends an open one of these, up to the nearest listed container.
ENDED_BY = {
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table", "tbody", "thead"}),
    "tbody": ({"tbody", "thead"}, {"table"}),
    "li": ({"li"}, {"ul", "ol"}),
    "p": ({"p"}, {"td", "div", "li", "article", "body"}),
}

# Whole cells of mere text, comments and unseen bodies, tags (with quoted values, else up
# to the next >), text.
_TOKEN = re.compile(
    r"""<(td)((?:\s+[a-z-]+="[^"<>]*")*)>([^<]*)</td>
    |<!--.*?(?:-->|\Z)|<[!?][^>]*>
    |<(?:script|style|template|noscript)\b[^>]*>.*?(?:</(?:script|style|template|noscript)\s*>|\Z)
    |<(/?)([a-z][a-z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*)>
    |([^<]+|<)""",
    re.I | re.S | re.X,
)
# How a comment, declaration or unseen body ends if the page does not end in it.
_CLOSED = re.compile(r"\A<(?:!--.*-->|\?.*|!(?!--).*|[a-z].*</(?:script|style|template|noscript)\s*>)\Z", re.I | re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")


class Node:
    """``page`` holds the texts of the page in order, ``start`` and ``end`` those below
    this element, ``own`` the texts that are its alone (inside the head) with the place
    in the page's texts where they belong."""

    __slots__ = ("tag", "raw", "parent", "page", "start", "end", "own", "_attrs")

    def __init__(self, tag, raw, parent, page):
        self.tag, self.raw, self.parent, self.page, self._attrs = tag, raw, parent, page, None
        self.start = self.end = len(page)
        self.own: list[tuple[int, str]] = []

    @property
    def attrs(self) -> dict[str, str]:
        if self._attrs is None:
            self._attrs = {}
            for name, *values in _ATTR.findall(self.raw) if self.raw else ():
                self._attrs.setdefault(name.lower(), unescape("".join(values)))
        return self._attrs

    def text(self) -> str:
        if not self.own and self.end - self.start < 2:
            return " ".join(self.page[self.start].split()) if self.end > self.start else ""
        parts, at = [], self.start
        for place, text in self.own:
            parts += [*self.page[at:place], text]
            at = place
        return " ".join("".join(parts + self.page[at : self.end]).split())


def _tokens(html: str) -> list[tuple[str, ...]]:
    """No tag ends behind the last >, so what stands there is not searched for tags."""
    cut = html.rfind(">") + 1
    tokens, tail = _TOKEN.findall(html[:cut]), html[cut:].split("<!--", 1)[0]
    if tail and tokens and not any(tokens[-1]):
        *_, last = _TOKEN.finditer(html[:cut])
        if not _CLOSED.search(last[0]):
            return tokens
    return [*tokens, ("", "", "", "", "", "", tail)] if tail else tokens


def parse(html: str) -> list[Node]:
    """All elements in document order, each with the text below it. Text of the
    head belongs to its own element (a title) only. Linear in the page: an element
    knows its stretch of the page's texts, and ``at`` where open tags stand."""
    nodes: list[Node] = []
    stack: list[Node] = []
    page: list[str] = []
    at: dict[str, list[int]] = {}
    head: Node | None = None

    def nearest(tags) -> int:
        return max((at[t][-1] for t in tags if at.get(t)), default=-1)

    def close(i: int) -> None:
        for node in stack[i:]:
            node.end = len(page)
            at[node.tag].pop()
        del stack[i:]

    for cell, cell_raw, cell_text, end, tag, raw, text in _tokens(html):
        if cell:
            # As its opening tag, its text and its closing tag, one after the other.
            if at.get("td") or at.get("th"):
                ends, within = ENDED_BY["td"]
                i = nearest(ends)
                if i > nearest(within):
                    close(i)
            if head is None:
                page.append(" ")
            node = Node("td", cell_raw, stack[-1] if stack else None, page)
            nodes.append(node)
            if cell_text:
                if "&" in cell_text:
                    cell_text = unescape(cell_text)
                if head is None:
                    page.append(cell_text)
                else:
                    node.own.append((len(page), cell_text))
            node.end = len(page)
            if head is None:
                page.append(" ")
            continue
        if text:
            if "&" in text:
                text = unescape(text)
            if head is None:
                page.append(text)
            elif stack:
                stack[-1].own.append((len(page), text))
            continue
        if not tag:
            continue
        tag = tag.lower()
        if end:
            if at.get(tag):
                close(at[tag][-1])
        else:
            ends, within = ENDED_BY.get(tag, ((), ()))
            i = nearest(ends)
            if i > nearest(within):
                close(i)
        if tag in ("head", "body"):
            head = None
        if tag in BLOCK and head is None:
            page.append(" ")
        if end:
            continue
        node = Node(tag, raw, stack[-1] if stack else None, page)
        nodes.append(node)
        if tag not in VOID and not raw.endswith("/"):
            at.setdefault(tag, []).append(len(stack))
            stack.append(node)
            if tag == "head":
                head = node
    close(0)
    return nodes


_PART = re.compile(r"""([\w-]+)|\#([\w-]+)|\.([\w-]+)|\[([\w-]+)(\*?=)['"]?([^'"\]]*)['"]?\]""")


@lru_cache(maxsize=1024)
def parts_of(selector: str) -> list[list[tuple]]:
    return [_PART.findall(part) for part in selector.split()]


def simple_matches(node: Node, tests: list[tuple]) -> bool:
    for tag, ident, cls, attr, op, value in tests:
        if tag and node.tag != tag.lower():
            return False
        if ident and node.attrs.get("id") != ident:
            return False
        if cls and cls not in (node.attrs.get("class") or "").split():
            return False
        if attr:
            have = node.attrs.get(attr) or ""
            if not (value in have if op == "*=" else have == value):
                return False
    return True


def matches(node: Node, selector: str) -> bool:
    *above, own = parts_of(selector)
    if not simple_matches(node, own):
        return False
    node = node.parent
    while above and node is not None:
        if simple_matches(node, above[-1]):
            above.pop()
        node = node.parent
    return not above


def first_texts(html: str | None, selectors: list[str]) -> list[str | None]:
    """Text of the first element of each selector; None where there is none."""
    if not html:
        return [None] * len(selectors)
    nodes = parse(html)
    return [next((n.text() for n in nodes if matches(n, s)), None) for s in selectors]


def table_rows(html: str | None) -> list[dict]:
    """Every row of a table body: its position, cell texts and cell ids."""
    if not html:
        return []
    nodes = parse(html)
    rows: dict[int, dict] = {}
    order = []
    for n in nodes:
        if n.tag == "tr" and matches(n, "tbody tr"):
            rows[id(n)] = {"row_idx": len(order), "cells": [], "ids": []}
            order.append(rows[id(n)])
        elif n.tag == "td":
            up = n.parent
            while up is not None and id(up) not in rows:
                up = up.parent
            if up is not None:
                rows[id(up)]["cells"].append(n.text())
                rows[id(up)]["ids"].append((n.attrs.get("id") or "") if n.raw else "")
    return order


ROW = T.StructType(
    [
        T.StructField("row_idx", T.IntegerType()),
        T.StructField("cells", T.ArrayType(T.StringType())),
        T.StructField("ids", T.ArrayType(T.StringType())),
    ]
)


@F.arrow_udf(T.ArrayType(ROW))
def _rows_of(html: pa.Array) -> pa.Array:
    """The rows of all pages of a batch in flat columns, with the places where rows and
    pages begin."""
    index, cells, ids, rows_at, pages_at = [], [], [], [0], [0]
    for page in html.to_pylist():
        for row in table_rows(page):
            index.append(row["row_idx"])
            cells += row["cells"]
            ids += row["ids"]
            rows_at.append(len(cells))
        pages_at.append(len(index))
    texts = [pa.ListArray.from_arrays(pa.array(rows_at, pa.int32()), pa.array(column, pa.string())) for column in (cells, ids)]
    rows = pa.StructArray.from_arrays([pa.array(index, pa.int32()), *texts], names=ROW.names)
    return pa.ListArray.from_arrays(pa.array(pages_at, pa.int32()), rows)


# Declared not deterministic, so that the planner never repeats a parse per use of
# its result; the result itself is a function of the page.
rows_of = _rows_of.asNondeterministic()


def texts_of(html: Column, selectors: list[str]) -> Column:
    """Array with the text of the first element of each selector, in one parse."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def read(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: first_texts(page, selectors))

    return read.asNondeterministic()(html)


PARTS = T.StructType([T.StructField("rows", T.ArrayType(ROW)), T.StructField("texts", T.ArrayType(T.StringType()))])


def parts_of_page(html: Column, kind: Column, selectors: dict[str, list[str]]) -> Column:
    """What each kind of page is read for, in one parse: the texts of its selectors, or
    its table rows if it has none."""

    def part(page: str | None, kind: str | None) -> tuple[list, list]:
        if kind in selectors:
            return [], first_texts(page, selectors[kind])
        return table_rows(page), []

    @F.pandas_udf(PARTS)
    def read(pages: pd.Series, kinds: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([part(p, k) for p, k in zip(pages, kinds)], columns=PARTS.names)

    return read.asNondeterministic()(html, kind)
