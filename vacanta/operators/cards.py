"""Card extraction over a stored page table: page -> 0..n job cards.

Spark distributes the pages; each Arrow batch is parsed in the Python worker, a slice of
bounded bytes at a time, with the standard-library HTML parser (``mapInArrow``). Only the structural part
runs in Python — cards, links, their texts; everything derived from the text
(company, city, tags, truncation rules that are plain string functions) is done
afterwards with column expressions on the JVM.

Selectors cover what card rules need: ``tag``, ``.class``, ``tag.class``,
descendant combinations (``div.holder p``) and comma lists, in document order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab as V

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr"}
SKIP_TEXT = {"script", "style", "template"}
# Start tag -> (open elements that it ends, elements beyond which it doesn't look).
PARAGRAPH = frozenset({"p"})
BLOCKS = frozenset({"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4",
                    "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"})
_LIST, _TABLE = frozenset({"ul", "ol", "menu"}), frozenset({"table"})
IMPLIED = {"li": (frozenset({"li"}), _LIST), "p": (PARAGRAPH, BLOCKS - PARAGRAPH), "option": (frozenset({"option"}), frozenset({"select"})),
           "tr": (frozenset({"tr"}), _TABLE), "td": (frozenset({"td", "th"}), _TABLE | {"tr"}), "th": (frozenset({"td", "th"}), _TABLE | {"tr"}),
           "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})), "dd": (frozenset({"dt", "dd"}), frozenset({"dl"}))}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None"):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def walk(self) -> Iterator["Node | str"]:
        """All nodes and texts below this one in document order, with a stack of its own
        (tag soup can nest deeper than Python's calls)."""
        stack = [iter(self.children)]
        while stack:
            for c in stack[-1]:
                yield c
                if not isinstance(c, str) and c.tag not in SKIP_TEXT:
                    stack.append(iter(c.children))
                    break
            else:
                stack.pop()

    def strings(self) -> Iterator[str]:
        return (c for c in self.walk() if isinstance(c, str))

    def text(self, sep: str = "") -> str:
        """Stripped, non-empty text pieces joined by ``sep``."""
        return sep.join(s.strip() for s in self.strings() if s.strip())

    def elements(self) -> Iterator["Node"]:
        return (c for c in self.walk() if not isinstance(c, str))


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {}, None)
        self.cur = self.root

    def close_implied(self, tag):
        """A new item, row, cell, option or paragraph ends an open one of its kind within the same list, table or block."""
        ends, bounds = IMPLIED.get(tag, (PARAGRAPH, BLOCKS) if tag in BLOCKS else (frozenset(), frozenset()))
        node = self.cur
        while node.parent is not None and node.tag not in bounds:
            if node.tag in ends:
                self.cur = node.parent
                return
            node = node.parent

    def handle_starttag(self, tag, attrs):
        self.close_implied(tag)
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur)
        self.cur.children.append(node)
        if tag not in VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur))

    def handle_endtag(self, tag):
        node = self.cur
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:  # unmatched end tags are ignored
            self.cur = node.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def parse(html: str) -> Node:
    b = _TreeBuilder()
    b.feed(html or "")
    b.close()
    return b.root


def _compound(part: str) -> tuple[str | None, list[str]]:
    tag, *classes = part.split(".")
    return (tag or None), classes


def _matches(node: Node, comp) -> bool:
    tag, classes = comp
    return (tag is None or node.tag == tag) and all(c in node.classes() for c in classes)


def select(root: Node, selector: str) -> list[Node]:
    """Elements matching any comma-separated selector, in document order, once each."""
    groups = [[_compound(p) for p in g.split()] for g in selector.split(",") if g.strip()]
    out = []
    for node in root.elements():
        for chain in groups:
            if not _matches(node, chain[-1]):
                continue
            anc, i = node.parent, len(chain) - 2
            while i >= 0 and anc is not None:
                if _matches(anc, chain[i]):
                    i -= 1
                anc = anc.parent
            if i < 0:
                out.append(node)
                break
    return out


@dataclass(frozen=True)
class CardSpec:
    """How cards of one source are read.

    card: card selector; links: selectors tried in order for the link (``"a"`` =
    first anchor with an href); href_contains: the link must contain this text;
    url_contains: the absolute URL must contain this text; company_selector /
    company_link_contains: where the company name is; info_selector /
    snippet_selector: extra fields of the first source shape."""

    card: str
    links: tuple[str, ...] = ("a",)
    href_contains: str | None = None
    url_contains: str | None = None
    company_selector: str | None = None
    company_link_contains: str | None = None
    info_selector: str | None = None
    snippet_selector: str | None = None


CARD_SCHEMA = ("page_id long, card_pos int, job_url string, title string, company string, "
               "info_text string, snippet string, card_text string")


def _link(card: Node, spec: CardSpec) -> Node | None:
    for sel in spec.links:
        for a in select(card, sel):
            href = a.attrs.get("href")
            if a.tag == "a" and href is not None and (spec.href_contains is None or spec.href_contains in href):
                return a
    return None


def absolute(base_url: str | None, href: str) -> str | None:
    """The resolved URL; None for a link that can't be one (its card is dropped, as one without a link)."""
    try:
        return urljoin(base_url or "", href)
    except ValueError:
        return None


def cards_of_page(page_id: int, base_url: str, html: str, spec: CardSpec) -> list[tuple]:
    rows = []
    root = parse(html)
    for pos, card in enumerate(select(root, spec.card)):
        link = _link(card, spec)
        if link is None:
            continue
        url = absolute(base_url, link.attrs.get("href", ""))
        if not url or (spec.url_contains is not None and spec.url_contains not in url):
            continue
        company = None
        if spec.company_selector:
            found = select(card, spec.company_selector)
            company = found[0].text() if found else None
        elif spec.company_link_contains:
            for a in select(card, "a"):
                if spec.company_link_contains in a.attrs.get("href", "") and a.text():
                    company = a.text()
                    break
        info = " | ".join(n.text() for n in select(card, spec.info_selector)) if spec.info_selector else None
        snip = None
        if spec.snippet_selector:
            found = select(card, spec.snippet_selector)
            snip = found[0].text() if found else ""
        rows.append((page_id, pos, url, link.text(), company, info, snip, card.text(" ")))
    return rows


def extract_cards(pages: DataFrame, spec: CardSpec, base_url: str | None = None,
                  id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Raw cards of every page (document order within a page). ``base_url`` resolves
    relative links; by default each page's own URL does."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    made = StructType.fromDDL(CARD_SCHEMA)
    arrow = to_arrow_schema(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, html_col):
                pages = zip(*(part.column(c).to_pylist() for c in (id_col, url_col, html_col)))
                cards = [card for pid, url, html in pages for card in cards_of_page(int(pid), base_url or url, html, spec)]
                yield pa.RecordBatch.from_arrays([pa.array([c[k] for c in cards], f.type) for k, f in enumerate(arrow)], schema=arrow)

    _ship_by_value()
    return pages.select(id_col, url_col, html_col).mapInArrow(run, made)


#: Bytes of pages that a task has as Python strings at a time.
SLICE_BYTES = 1 << 20


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``limit`` bytes in ``column`` (one row at least), none copied."""
    start = size = 0
    for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        if i > start and size + (n or 0) > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n or 0
    if batch.num_rows:
        yield batch.slice(start)


def _ship_by_value() -> None:
    """Pickle this module's code by value into the Python workers, so executors need
    no installed copy of the package (it may only be on the driver's path)."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


# Card rules of the three page sources, as data.
SOURCE_CARD_SPECS = {
    "rekrute_scraper": CardSpec(card="li.post-id", links=("h2 a.titreJob", "a.titreJob"),
                                company_selector="div.holder div.text-holder p",
                                info_selector="div.holder div.info ul li",
                                snippet_selector="div.holder div.info div.text"),
    "emploima_scraper": CardSpec(card=".card-job", href_contains="/offre-emploi-maroc/",
                                 company_link_contains="/recruteur/"),
    "dreamjob_scraper": CardSpec(card="article, .post, .entry", url_contains="/emploi/"),
}


def card_fields(cards: DataFrame, min_title: int = 0, summary_chars: int | None = None,
                snippet_summary: bool = False, metadata=None) -> DataFrame:
    """Column rules applied after extraction: title guard, ``summary`` (snippet, or
    card text cut to ``summary_chars``) and ``raw_metadata`` (a Column or a literal
    such as the search keyword tag; default the joined info items)."""
    out = cards
    if min_title:
        out = out.filter(F.col("title").isNotNull() & (F.length("title") >= min_title))
    summary = F.coalesce(F.col("snippet"), F.lit("")) if snippet_summary else F.col("card_text")
    if summary_chars:
        summary = F.substring(summary, 1, summary_chars)
    if metadata is None:
        meta = F.col("info_text")
    else:
        meta = metadata if not isinstance(metadata, str) else F.lit(metadata)
    return out.withColumn("summary", summary).withColumn("raw_metadata", meta)


def capture_text(source: str) -> tuple[Column, Column]:
    """(tagging text, rule text) of a card at capture time, per source shape: the
    first shape joins title, company, info items and snippet; the others read the
    card text (the third one after the title). Tagging always puts the title first."""
    title = F.coalesce(F.col("title"), F.lit(""))
    if source == "rekrute_scraper":
        combined = F.concat_ws(" ", title, F.coalesce("company", F.lit(V.UNSPECIFIED)),
                               F.coalesce("info_text", F.lit("")), F.coalesce("snippet", F.lit("")))
        return F.concat_ws(" ", title, combined), combined
    text = F.coalesce(F.col("card_text"), F.lit(""))
    rule_text = F.concat_ws(" ", title, text) if source == "dreamjob_scraper" else text
    return F.concat_ws(" ", title, text), rule_text
