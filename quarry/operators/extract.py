"""HTML extraction (survey IDs SRC5-SRC6, EXT1-EXT3).

Two Arrow-batched UDFs wrap a small stdlib ``html.parser`` walker:
listing pages become an ``array<struct>`` that ``posexplode`` turns into
ordered rows, article pages become one text per page.  All clean-up after the
walk (whitespace collapse, defaults, type joins) is JVM-side.  Raw HTML is
dropped right after extraction so it never reaches a shuffle.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quarry.functions.text import clean_text, default_types, strip_ws

# --- fixed values -----------------------------------------------------------
# Listing markup: item, title link, date, categories (class names).
ITEM_CLASS = "wp-block-post"
TITLE_CLASS = "wp-block-post-title"
DATE_CLASS = "wp-block-post-date"
CATEGORY_CLASS = "taxonomy-category"
# Text stored when an article page can't be read.
NO_CONTENT = "[no content]"
# Why a page that wasn't fetched can't be read.
NO_PAGE = "no page"
# Listing pages that are Python objects at a time.
PAGES_AT_ONCE = 32
# Elements without an end tag.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is code, not text.
RAW_TEXT_TAGS = frozenset(("script", "style", "template"))
# Start tags that close an open <p> (HTML5 parsing rules).
P_CLOSERS = frozenset(("address article aside blockquote details dialog div dl fieldset figcaption "
                       "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre "
                       "section table ul").split())
# ---------------------------------------------------------------------------

ITEM_TYPE = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("types", T.ArrayType(T.StringType())),
])


def _classes(attrs) -> set[str]:
    for k, v in attrs:
        if k == "class" and v:
            return set(v.split())
    return set()


class _Tree(HTMLParser):
    """Keeps the open-element stack; subclasses react to elements and text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, set[str]]] = []

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def _pop_to(self, tag) -> bool:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                while len(self.stack) > i:
                    self.closed(len(self.stack) - 1, self.stack.pop())
                return True
        return False

    def handle_endtag(self, tag):
        self._pop_to(tag)

    def closed(self, depth, element):  # pragma: no cover - hook
        pass

    def finish(self):
        self.close()
        while self.stack:
            self.closed(len(self.stack) - 1, self.stack.pop())


class _Listing(_Tree):
    """Collects listing items: first title link, first date, all categories."""

    def __init__(self):
        super().__init__()
        self.items: list[dict] = []
        self.open: list[dict] = []   # items under construction (innermost last)

    def _under(self, cls, tag=None) -> bool:
        """Some ancestor of the current element has ``cls`` (and is a ``tag``).

        Like a scoped CSS select, the element must lie inside the item but the
        ancestor named by the selector may be anywhere above it.
        """
        return any(cls in c and (tag is None or t == tag) for t, c in self.stack[:-1])

    def handle_starttag(self, tag, attrs):
        cls = _classes(attrs)
        depth = len(self.stack)
        if tag not in VOID_TAGS:
            self.stack.append((tag, cls))
        if tag == "li" and ITEM_CLASS in cls:
            self.open.append({"depth": depth, "title": None, "url": None, "date": None,
                              "types": [], "cap": []})
            return
        in_title = tag == "a" and self._under(TITLE_CLASS, "h2")
        in_date = tag == "time" and self._under(DATE_CLASS)
        in_category = tag == "a" and self._under(CATEGORY_CLASS)
        for it in self.open:
            if in_title and it["title"] is None:
                href = dict(attrs).get("href") or ""
                it["title"], it["url"] = [], href.strip()
                it["cap"].append(("title", depth))
            elif in_date and it["date"] is None:
                it["date"] = []
                it["cap"].append(("date", depth))
            if in_category:
                it["types"].append([])
                it["cap"].append(("type", depth))

    def handle_data(self, data):
        if self.stack and self.stack[-1][0] in RAW_TEXT_TAGS:
            return
        for it in self.open:
            for kind, _ in it["cap"]:
                (it["types"][-1] if kind == "type" else it[kind]).append(data)

    def closed(self, depth, element):
        for it in self.open:
            it["cap"] = [(k, d) for k, d in it["cap"] if d != depth]
        if self.open and self.open[-1]["depth"] == depth:
            it = self.open.pop()
            if it["title"] is not None and it["date"] is not None:
                self.items.append({"date": "".join(it["date"]), "title": "".join(it["title"]),
                                   "url": it["url"], "types": ["".join(t) for t in it["types"]]})


class _Article(_Tree):
    """Paragraph texts under a container element (``article p``)."""

    def __init__(self, container: str, compat: bool):
        super().__init__()
        self.container = container
        self.compat = compat
        self.paragraphs: list[list[str]] = []
        self.p_depth: int | None = None

    def handle_starttag(self, tag, attrs):
        if tag in P_CLOSERS and self.p_depth is not None:
            self._pop_to("p")
        if tag in VOID_TAGS:
            return
        self.stack.append((tag, set()))
        if tag == "p" and self.p_depth is None and any(t == self.container for t, _ in self.stack[:-1]):
            self.p_depth = len(self.stack) - 1
            self.paragraphs.append([])

    def handle_data(self, data):
        if self.p_depth is not None and self.stack[-1][0] not in RAW_TEXT_TAGS:
            self.paragraphs[-1].append(data.strip() if self.compat else data)

    def closed(self, depth, element):
        if self.p_depth is not None and depth == self.p_depth:
            self.p_depth = None


def parse_listing(html: str | None) -> list[dict] | None:
    if html is None:
        return None
    p = _Listing()
    p.feed(html)
    p.finish()
    return p.items


def parse_article(html: str | None, container: str = "main", compat: bool = False) -> str | None:
    """Paragraph texts joined by one space (whitespace is collapsed in the JVM)."""
    if html is None:
        return None
    p = _Article(container, compat)
    p.feed(html)
    p.finish()
    texts = ["".join(parts) for parts in p.paragraphs]
    return " ".join(t for t in texts if t.strip())


LISTING_TYPE = T.StructType([T.StructField("items", T.ArrayType(ITEM_TYPE)), T.StructField("error", T.StringType())])
ARTICLE_TYPE = T.StructType([T.StructField("text", T.StringType()), T.StructField("error", T.StringType())])


def _guarded(parse, html: str | None, empty) -> tuple:
    """(result, error): a page that isn't there or can't be parsed gives ``empty`` and says why."""
    if html is None or not html.strip():
        return empty, NO_PAGE
    try:
        return parse(html), None
    except Exception as e:  # noqa: BLE001 - one broken page doesn't end the run
        return empty, f"{type(e).__name__}: {e}"


@F.arrow_udf(LISTING_TYPE)
def _listing_udf(html: pa.Array) -> pa.Array:
    # a few pages at a time are Python objects; the batch stays as Arrow has it
    kind = to_arrow_type(LISTING_TYPE)
    made = [pa.array([dict(zip(("items", "error"), _guarded(parse_listing, h.as_py(), []))) for h in html.slice(at, PAGES_AT_ONCE)], kind)
            for at in range(0, len(html), PAGES_AT_ONCE)]
    return pa.concat_arrays(made) if made else pa.array([], kind)


def _article_udf(container: str, compat: bool):
    @F.pandas_udf(ARTICLE_TYPE)
    def run(html: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_guarded(lambda h: parse_article(h, container, compat), h, None) for h in html],
                            columns=["text", "error"], dtype=object)
    return run


def listing_results(pages: DataFrame, page_col: str = "page", html_col: str = "html") -> DataFrame:
    """EXT1 + EXT3: ``(page, html)`` -> ``(page, items, error)``, a row per page.

    A page that couldn't be read has no items and an ``error``; an empty page
    has neither.  The crawl stops at both, but only the first is a fault.
    """
    found = pages.select(F.col(page_col).alias("page"), _listing_udf(F.col(html_col)).alias("r"))
    return found.select("page", "r.items", "r.error")


def items_of(results: DataFrame) -> DataFrame:
    """FIL1 + STR4: the items of listing results: ``(page, pos, date, title, url, types)``.

    ``pos`` counts extracted items in page order.  Incomplete items (no title
    link or no date tag) are dropped by the walker before positions are taken.
    """
    return results.select("page", F.posexplode("items").alias("pos", "it")).select(
        "page", F.col("pos").cast("int").alias("pos"),
        strip_ws("it.date").alias("date"),
        strip_ws("it.title").alias("title"),
        F.col("it.url").alias("url"),
        default_types(F.transform("it.types", strip_ws)).alias("types"),
    )


def listing_items(pages: DataFrame, page_col: str = "page", html_col: str = "html") -> DataFrame:
    """EXT1: the items of landed listing pages."""
    return items_of(listing_results(pages, page_col, html_col))


def article_results(pages: DataFrame, container: str = "main", compat: bool = False,
                    html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """EXT2 + EXT3: ``html`` -> ``text`` (cleaned), ``content_ok`` and, for a page that couldn't be read, ``error``.

    ``text`` is NULL then; the sentinel is applied by the sinks alone.
    """
    raw = pages.select(*keep, _article_udf(container, compat)(F.col(html_col)).alias("__raw"))
    return raw.select(*keep, clean_text("__raw.text").alias("text"), F.col("__raw.error").isNull().alias("content_ok"),
                      F.col("__raw.error").alias("error"))


def article_text(pages: DataFrame, container: str = "main", compat: bool = False,
                 html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """EXT2: ``html`` -> ``text`` and ``content_ok``."""
    return article_results(pages, container, compat, html_col, keep).drop("error")


def unreadable(results: DataFrame) -> DataFrame:
    """The quarantine: results (of listing or article pages) that couldn't be read, with the reason."""
    return results.filter(F.col("error").isNotNull()).drop("items", "text", "content_ok")


def with_sentinel(text: Column) -> Column:
    """EXT3 at the export boundary: unreadable text -> ``[no content]``."""
    return F.coalesce(text, F.lit(NO_CONTENT))
