"""Cleaning scholarly HTML: mathematics to text, noise dropped, title, sections and paragraphs.

The DOM is built by the standard library's parser inside an Arrow UDF; everything after it is
columns again.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmill.functions.plain import clean_text, dropped_heading, kept_paragraph, squeeze

DOCUMENT = "struct<title: string, sections: array<struct<heading: string, kind: string, paragraphs: array<string>>>, removed_counts: map<string, int>>"
# HTML's void elements, and those that end an open paragraph.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
ENDS_PARAGRAPH = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
# The groups of removed nodes in order, by element, class, or a test of attributes.
NOISE = [
    ("citations", (), ("ltx_cite",)),
    ("tables", ("table",), ("ltx_table", "ltx_tabular")),
    ("figures", ("figure", "img"), ("ltx_figure", "ltx_graphics", "ltx_picture")),
    ("captions", ("figcaption",), ("ltx_caption",)),
    ("references", (), ("ltx_bibliography", "ltx_biblist", "ltx_bibitem", "ltx_thebibliography")),
    ("scripts", ("script", "style", "noscript"), ()),
]
EQUATION = ("ltx_equation", "ltx_eqn_table")
SECTION_CLASS = re.compile(r"(?:^|\s)ltx_(?:sub)*section(?:\s|$)")


class Node:
    """An element; its children are nodes and strings in order."""

    __slots__ = ("attributes", "children", "parent", "tag")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None):
        self.tag, self.attributes, self.parent, self.children = tag, attributes, parent, []

    def classes(self) -> list[str]:
        return self.attributes.get("class", "").split()

    def walk(self) -> Iterator[Node]:
        """This node and all below it, in document order."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def strings(self) -> Iterator[str]:
        stack: list = [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                yield item
            else:
                stack += reversed(item.children)

    def ancestors(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    def replace(self, *new) -> None:
        """Put other children in this node's place; the text after it stays."""
        if self.parent is None:
            return
        at = next(k for k, c in enumerate(self.parent.children) if c is self)
        self.parent.children[at : at + 1] = new
        for c in new:
            if isinstance(c, Node):
                c.parent = self.parent
        self.parent = None

    def text(self) -> str:
        return clean_text(" ".join(self.strings()))


class Builder(HTMLParser):
    """Builds the tree, closing what HTML lets an author leave open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {}, None)
        self.at = self.root

    def handle_starttag(self, tag: str, attrs) -> None:
        attributes = {k: v or "" for k, v in attrs}
        if tag == "html":
            self.root.attributes |= attributes
            return
        if tag in ENDS_PARAGRAPH:
            self.close("p")
        if tag in ("li", "tr", "td", "th", "dt", "dd", "option"):
            self.close(tag, within=("ul", "ol", "table", "dl", "select"))
        node = Node(tag, attributes, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.close(tag)

    def close(self, tag: str, within: tuple[str, ...] = ("table", "section", "div")) -> None:
        node = self.at
        while node is not self.root:
            if node.tag == tag:
                self.at = node.parent
                return
            if node.tag in within and tag != node.tag:
                return
            node = node.parent

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID:
            self.close(tag, within=())

    def handle_data(self, data: str) -> None:
        if self.at.children and isinstance(self.at.children[-1], str):
            self.at.children[-1] += data
        else:
            self.at.children.append(data)


def parse(source: str) -> Node:
    builder = Builder()
    builder.feed(source)
    return builder.root


def found(root: Node, test: Callable[[Node], bool]) -> list[Node]:
    return [n for n in root.walk() if test(n)]


def is_math(node: Node) -> bool:
    return node.tag == "math" or "ltx_Math" in node.classes()


def latex(node: Node) -> str:
    """TeX annotation, else alternative text, else the text itself."""
    notes = (squeeze("".join(n.strings())) for n in node.walk() if n is not node and n.tag == "annotation" and n.attributes.get("encoding") == "application/x-tex")
    text = next(filter(None, notes), "") or squeeze(node.attributes.get("alttext")) or squeeze("".join(node.strings()))
    return html.unescape(text)


def write_math(root: Node) -> int:
    """Formulas become ``$...$`` or ``$$...$$``; the number of formulas written."""
    written = 0
    boxes = found(root, lambda n: n.tag == "table" and any(c in EQUATION for c in n.classes()) or n.tag == "div" and EQUATION[0] in n.classes())
    for box in boxes:
        formulas = [t for t in (latex(n) for n in box.walk() if n is not box and is_math(n)) if t]
        written += len(formulas)
        if formulas:
            paragraph = Node("p", {}, None)
            paragraph.children = ["\n\n".join(f"$${t}$$" for t in formulas)]
            box.replace(paragraph)
        else:
            box.replace()
    for node in found(root, is_math):
        if text := latex(node):
            written += 1
            block = squeeze(node.attributes.get("display")).casefold() in ("block", "display") or any(e in squeeze(a.attributes.get("class")) for a in node.ancestors() for e in EQUATION)
            node.children = [f"$${text}$$" if block else f"${text}$"]
    return written


def is_noise(group: str, tags: tuple[str, ...], classes: tuple[str, ...], node: Node) -> bool:
    own, link, name = node.classes(), node.attributes.get("href", ""), node.attributes.get("id", "")
    if group == "citations" and node.tag == "a" and link.startswith("#") and (link.startswith("#bib") or ".T" in link or ".F" in link):
        return True
    if group == "references" and (name == "bib" or name.startswith("bib.")):
        return True
    if group == "tables" and node.tag == "table" and any(e in own for e in EQUATION):
        tags = ()
    return node.tag in tags or any(c in own for c in classes)


def take_out(nodes: list[Node]) -> None:
    """Remove nodes from their parents; each parent's children are gone through once, however many go."""
    gone = {id(n) for n in nodes}
    for parent in {id(n.parent): n.parent for n in nodes if n.parent is not None}.values():
        parent.children = [c for c in parent.children if id(c) not in gone]
    for node in nodes:
        node.parent = None


def remove_noise(root: Node) -> dict[str, int]:
    counts = {"math": write_math(root)}
    for group, tags, classes in NOISE:
        nodes = found(root, lambda n: is_noise(group, tags, classes, n))
        counts[group] = len(nodes)
        take_out(nodes)
    return counts


def title_of(root: Node) -> str:
    for test in (lambda n: "ltx_title" in n.classes(), lambda n: n.tag == "h1", lambda n: n.tag == "title"):
        if text := next(filter(None, (n.text() for n in found(root, test))), ""):
            return text
    return ""


def is_section(node: Node) -> bool:
    classes = squeeze(node.attributes.get("class"))
    return node.tag == "section" or "ltx_abstract" in classes or bool(SECTION_CLASS.search(classes))


def own_paragraphs(node: Node, least: int) -> list[str]:
    """Texts of the paragraphs whose nearest section is this one, as far as they are worth keeping."""
    texts = (p.text() for p in node.walk() if p.tag == "p" and p is not node and next((a for a in p.ancestors() if is_section(a)), None) is node)
    return [t for t in texts if kept_paragraph(t, least)]


def heading_of(node: Node) -> str:
    heads = (n for n in node.walk() if n is not node and (n.tag in ("h1", "h2", "h3", "h4") or "ltx_title" in n.classes()))
    first = next(heads, None)
    return first.text() if first is not None else ""


def sections_of(root: Node) -> list[dict]:
    """Abstracts first, then sections in document order; those of references and the like are left out."""
    out = []
    for node in found(root, lambda n: "ltx_abstract" in n.classes()):
        if paragraphs := own_paragraphs(node, 20):
            out.append({"heading": "Abstract", "kind": "abstract", "paragraphs": paragraphs})
    for node in found(root, lambda n: n.tag == "section" or "ltx_section" in n.classes()):
        heading = heading_of(node)
        if not dropped_heading(heading) and (paragraphs := own_paragraphs(node, 80)):
            out.append({"heading": heading or "Body", "kind": "body", "paragraphs": paragraphs})
    return out


def clean_page(source: str | None) -> dict | None:
    if source is None:
        return None
    root = parse(source)
    counts = remove_noise(root)
    return {"title": title_of(root), "sections": sections_of(root), "removed_counts": counts}


def clean_html(source: Column) -> Column:
    """Document of a page's HTML; null for null."""

    @F.pandas_udf(DOCUMENT)
    def run(pages: pd.Series) -> pd.DataFrame:
        rows = [clean_page(p) or {"title": None, "sections": None, "removed_counts": None} for p in pages]
        return pd.DataFrame(rows, columns=["title", "sections", "removed_counts"])

    return F.when(source.isNotNull(), run(source))
