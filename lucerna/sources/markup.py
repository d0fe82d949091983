"""HTML, KML and script payloads as relations.  Nesting is beyond regular expressions, so pages are parsed in Arrow batches, one at a time."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The namespace of KML, elements without an end, and blanks that texts are cut at.
KML = "{http://www.opengis.net/kml/2.2}"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUT_ROWS = 2000
# Text or a tag as most pages have them: no comments, attributes in double quotes and without character references.  Elements whose content is read as text are left out.
TOKEN = re.compile(r'([^<\0]+)|<([A-Za-z][A-Za-z0-9]*)((?:[\t\n\r\f ]+[A-Za-z][A-Za-z0-9_:-]*="[^"<>&\0]*")*)[\t\n\r\f ]*(/?)>|</([A-Za-z][A-Za-z0-9]*)>')
ATTRIBUTE = re.compile(r'([A-Za-z][A-Za-z0-9_:-]*)="([^"]*)"')
AS_TEXT = frozenset("iframe noembed noframes noscript plaintext script style svg math template textarea title xmp".split())


class _Node:
    __slots__ = ("tag", "attrs", "parent", "kids", "at")

    def __init__(self, tag, attrs, parent, at):
        self.tag, self.attrs, self.parent, self.kids, self.at = tag, attrs, parent, [], at

    def find(self, test: Callable[[_Node], bool]) -> Iterator[_Node]:
        todo = self.kids[::-1]
        while todo:
            x = todo.pop()
            if not isinstance(x, str):
                if test(x):
                    yield x
                todo += x.kids[::-1]

    def text(self) -> str:
        words: list[str] = []
        todo = self.kids[::-1]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                words += x.split()
            else:
                todo += x.kids[::-1]
        return " ".join(words)

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()


class _Tree(HTMLParser):
    """The page as nested elements: an end tag closes the nearest element of its name, one without a beginning is left out."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.root = self.here = _Node("", {}, None, 0)
        self.n = 0
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.n += 1
        node = _Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.here, self.n)
        self.here.kids.append(node)
        if tag not in VOID:
            self.here = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.here = self.here.parent

    def handle_endtag(self, tag):
        at = self.here
        while at.parent is not None and at.tag != tag:
            at = at.parent
        if at.parent is not None:
            self.here = at.parent

    def handle_data(self, data):
        self.here.kids.append(data)


def _plain(page: str) -> _Node | None:
    """The tree that _Tree makes, of a page of plain tokens only; null for any other page."""
    root = here = _Node("", {}, None, 0)
    n = at = 0
    for m in TOKEN.finditer(page):
        if m.start() != at:
            return None
        at = m.end()
        data, tag, attrs, empty, end = m.groups()
        if data:
            here.kids.append(unescape(data) if "&" in data else data)
        elif tag:
            tag = tag.lower()
            if tag in AS_TEXT and not (tag == "title" and not empty and re.compile(r"[^<&\0]*</title>", re.I).match(page, at)):
                return None
            n += 1
            node = _Node(tag, {k.lower(): v for k, v in reversed(ATTRIBUTE.findall(attrs))} if attrs else {}, here, n)
            here.kids.append(node)
            if not empty and tag not in VOID:
                here = node
        else:
            end, up = end.lower(), here
            while up.parent is not None and up.tag != end:
                up = up.parent
            here = up.parent or here
    return root if at == len(page) else None


def _root(page: str) -> _Node:
    return _plain(page) or _Tree(page).root


def _parsed(rows: DataFrame, key: str, body: str, schema: str, each: Callable[[str], Iterator[tuple]]) -> DataFrame:
    """A relation (key, schema) of what `each` yields for each body; null bodies yield nothing."""
    names = [key] + [x.strip().split()[0] for x in schema.split(";")]

    def run(batches):
        out: list[tuple] = []
        for batch in batches:
            for k, page in zip(batch.iloc[:, 0], batch.iloc[:, 1]):
                for found in each(page) if isinstance(page, str) else ():
                    out.append((k, *found))
                    if len(out) >= OUT_ROWS:
                        yield pd.DataFrame(out, columns=names)
                        out = []
        if out:
            yield pd.DataFrame(out, columns=names)

    of_key = rows.schema[key].dataType.simpleString()
    return rows.select(key, body).mapInPandas(run, f"`{key}` {of_key}, " + schema.replace(";", ","))


def nodes(rows: DataFrame, key: str, html: str, tags: tuple[str, ...]) -> DataFrame:
    """(key, node, parent, tag, attrs, text) of the elements with one of the tags, in page order; parent is any element's number, 0 the page."""

    def each(page):
        for x in _root(page).find(lambda x: x.tag in tags):
            yield x.at, x.parent.at, x.tag, x.attrs, x.text()

    return _parsed(rows, key, html, "node int; parent int; tag string; attrs map<string,string>; text string", each)


def table_rows(rows: DataFrame, key: str, html: str) -> DataFrame:
    """(key, tab, line, cells, headers): rows of tables with any text, and the first row of their table."""

    def each(page):
        for i, tab in enumerate(_root(page).find(lambda x: x.tag == "table")):
            lines = [[c.text() for c in tr.find(lambda x: x.tag in ("th", "td"))] for tr in tab.find(lambda x: x.tag == "tr")]
            lines = [x for x in lines if any(x)]
            for j, cells in enumerate(lines):
                yield i, j, cells, lines[0]

    return _parsed(rows, key, html, "tab int; line int; cells array<string>; headers array<string>", each)


def accordions(rows: DataFrame, key: str, html: str) -> DataFrame:
    """(key, item, depth, title, body): accordion entries with their button's text and body's blocks; nested ones have their own rows."""

    def each(page):
        is_item = lambda x: "accordion-item" in x.classes()
        for i, item in enumerate(_root(page).find(is_item)):
            depth, up = 0, item.parent
            while up is not None:
                depth, up = depth + is_item(up), up.parent
            button = next(item.find(lambda x: x.tag == "button" and "accordion-button" in x.classes()), None)
            body = next(item.find(lambda x: "accordion-body" in x.classes()), None)
            blocks = [k if isinstance(k, str) else k.text() for k in body.kids] if body else []
            yield i, depth, button.text() if button else None, [" ".join(b.split()) for b in blocks if b.strip()]

    return _parsed(rows, key, html, "item int; depth int; title string; body array<string>", each)


def accordion_blocks(rows: DataFrame, key: str, html: str) -> DataFrame:
    """(key, item, title, ord, tag, text, strong): the elements directly in an accordion entry's body, with what they say in bold."""

    def each(page):
        for i, item in enumerate(_root(page).find(lambda x: "accordion-item" in x.classes())):
            button = next(item.find(lambda x: x.tag == "button" and "accordion-button" in x.classes()), None)
            body = next(item.find(lambda x: "accordion-body" in x.classes()), None)
            for j, block in enumerate(k for k in (body.kids if body else []) if not isinstance(k, str)):
                yield i, button.text() if button else None, j, block.tag, block.text(), [x.text() for x in block.find(lambda x: x.tag == "strong")]

    return _parsed(rows, key, html, "item int; title string; ord int; tag string; text string; strong array<string>", each)


def _tidy(text: str | None) -> str | None:
    return " ".join((text or "").split()) or None


def placemarks(rows: DataFrame, key: str, kml: str, strict: bool = False) -> DataFrame:
    """(key, folder, name, description, lat, lng) of the placemarks directly in a folder, at any depth of folders.

    Descriptions lose their tags.  Bodies that are no XML yield nothing, or raise if strict.
    """

    def each(body):
        try:
            root = ElementTree.fromstring(body.lstrip())
        except ElementTree.ParseError:
            if strict:
                raise
            return
        for folder in root.iter(f"{KML}Folder"):
            for mark in folder.findall(f"{KML}Placemark"):
                said = mark.findtext(f".//{KML}coordinates", default="").split()
                lat = lng = None
                try:
                    lng, lat = (float(x) for x in said[0].split(",")[:2]) if said else (None, None)
                except ValueError:
                    pass
                about = unescape(re.sub(r"<[^>]+>", " ", mark.findtext(f"{KML}description", default="")))
                yield _tidy(folder.findtext(f"{KML}name")), _tidy(mark.findtext(f"{KML}name")), _tidy(about), lat, lng

    return _parsed(rows, key, kml, "folder string; name string; description string; lat double; lng double", each)


def script_object(c, marker: str) -> Column:
    """The JSON object that follows a marker in a script, as text; null without one.  Braces in strings don't count."""

    @F.pandas_udf("string")
    def cut(pages: pd.Series) -> pd.Series:
        def one(page):
            at = page.find(marker) if isinstance(page, str) else -1
            start = page.find("{", at + len(marker)) if at >= 0 else -1
            if start < 0:
                return None
            try:
                return json.dumps(json.JSONDecoder().raw_decode(page, start)[0], ensure_ascii=False)
            except ValueError:
                return None

        return pages.map(one)

    return cut(c)


def first_text(c) -> Column:
    """First string that isn't empty of a JSON value that is a string or a list; null for anything else."""
    items = F.coalesce(F.from_json(c, "array<string>"), F.when(~F.startswith(F.ltrim(c), F.lit("{")), F.array(F.regexp_replace(c, '^"|"$', ""))))
    return F.get(F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != ""), F.lit(0))
