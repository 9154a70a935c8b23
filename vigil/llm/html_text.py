"""Main text of web pages by tree scoring.

The page is parsed into a tree; elements that are no article text by their tag,
role or class (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, reader comments) are cut off.  Every paragraph passes points
for its length and its commas, discounted by the share of its text that is links,
to its ancestors: all of them to its parent, half to the next, less above.  The
best container and those of its siblings that score well, or are paragraphs of
text themselves, are kept; where the best container is part of an ``article`` or
``main`` element, all of that element is.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# HTML's void elements, its elements that are part of a line of
# text, those whose start ends an open paragraph, and those that hold no article
# text; roles, and words in a class or id, of parts that hold none.
VOID = frozenset("area base basefont bgsound br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
#: What a head holds; any other element, and text, ends an open one.
HEAD_TAGS = frozenset("base basefont bgsound link meta title style script noscript noframes template head".split())
#: Elements in which a slash closes a start tag, and those inside them that hold HTML again.
FOREIGN = frozenset("svg math".split())
HTML_AGAIN = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
CUT_TAGS = frozenset(
    "head title script style noscript template iframe svg canvas object audio video nav footer aside form button "
    "select textarea option input dialog menu search".split()
)
CUT_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split()
)
CUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted banner nav navbar navigation "
    "menu breadcrumb breadcrumbs pagination pager header masthead footer sidebar comment comments commentlist disqus "
    "reply replies respond cookie cookies consent notice alert popup modal overlay newsletter subscribe signup login "
    "share sharing social related recommended widget toolbar skip".split()
)
#: Elements that are never cut for a word in their class or id.
KEPT_TAGS = frozenset("html body article main h1 p".split())
_WORDS = re.compile("[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class _Tree(HTMLParser):
    """The page as lists by node: parent, tag, cut, link.  ``flow`` holds the page's
    text in order as (node, text); a node's ``None`` is a border between blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.cut, self.link = [-1], ["html"], [False], [False]
        self.by_name: list[int] = []  # cut for a class or id alone
        self.flow: list[tuple[int, str | None]] = []
        self.open = [0]
        self.places: dict[str, list[int]] = {}  # by tag, where its open elements stand in ``open``

    def _border(self):
        self.flow.append((self.open[-1], None))

    def _push(self, node):
        self.places.setdefault(self.tag[node], []).append(len(self.open))
        self.open.append(node)

    def _cut_to(self, k):
        """Close all open elements from the ``k``-th on."""
        for node in reversed(self.open[k:]):
            self.places[self.tag[node]].pop()
        del self.open[k:]

    def _last(self, tags) -> int:
        """The place of the innermost open element with one of ``tags``; 0 if there is none."""
        return max([at[-1] for at in map(self.places.get, tags) if at], default=0)

    def _close(self, tag, among) -> bool:
        """Close the innermost open ``tag``, if no element of ``among`` lies inside out of it."""
        k = self._last((tag,))
        if not k or self._last(among) > k:
            return False
        self._cut_to(k)
        return True

    def handle_starttag(self, tag, attrs):
        if len(self.open) > 1 and (tag == "html" or tag == "body" and self._last(("body",))):
            return
        if tag == "body":
            self._close("head", ("template",))
        elif tag not in HEAD_TAGS:
            self._end_head()
        if tag in ENDS_PARAGRAPH:
            self._close("p", ("table", "td", "th", "button", "caption"))
        elif tag == "li":
            self._close("li", ("ul", "ol", "menu", "dir"))
        elif tag in ("dt", "dd"):
            self._close("dd", ("dl",)) or self._close("dt", ("dl",))
        elif tag in ("td", "th"):
            self._close("td", ("tr", "table")) or self._close("th", ("tr", "table"))
        elif tag == "tr":
            self._close("tr", ("table",))
        if tag not in INLINE:
            self._border()
        up, node = self.open[-1], len(self.parent)
        a = {k: (v or "").lower() for k, v in attrs}
        cut = tag in CUT_TAGS or (tag == "header" and not self._last(("article",)))
        cut = cut or a.get("role") in CUT_ROLES or "hidden" in a or a.get("aria-hidden") == "true"
        cut = cut or bool(_HIDDEN.search(a.get("style", "")))
        if not cut and tag not in KEPT_TAGS:
            words = _WORDS.findall(f"{a.get('class', '')} {a.get('id', '')}")
            if not CUT_WORDS.isdisjoint(words):
                self.by_name.append(node)
        self.parent.append(up)
        self.tag.append(tag)
        self.cut.append(self.cut[up] or cut)
        self.link.append(self.link[up] or tag == "a")
        if tag not in VOID:
            self._push(node)

    def _end_head(self):
        """Close an open head that is the innermost open element."""
        if self.tag[self.open[-1]] == "head" and len(self.open) > 1:
            self._cut_to(len(self.open) - 1)

    def _foreign(self, tag) -> bool:
        """Whether ``tag``, if it starts here, is of SVG or MathML."""
        if tag in FOREIGN:
            return True
        return self._last(FOREIGN) > self._last(HTML_AGAIN)

    def handle_startendtag(self, tag, attrs):
        closed, nodes = tag not in VOID and self._foreign(tag), len(self.parent)
        self.handle_starttag(tag, attrs)  # outside SVG and MathML the slash of <p/> means nothing
        if closed and len(self.parent) > nodes:
            self._cut_to(len(self.open) - 1)
            if tag not in INLINE:
                self._border()

    def handle_endtag(self, tag):
        if tag in VOID:
            if tag == "br":
                self._border()
            return
        if tag not in INLINE:
            self._border()
        stop = () if tag not in INLINE else ("td", "th", "table", "li")
        self._close(tag, stop)
        if tag not in INLINE:
            self._border()

    def handle_data(self, data):
        if data.strip():
            self._end_head()
        self.flow.append((self.open[-1], data))


def main_text(html: str) -> str:
    """The main text of one page; empty for a page without any."""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    parent, tag, cut, link = tree.parent, tree.tag, tree.cut, tree.link
    n = len(parent)

    # a class or id cuts an element off unless the article's heading or body is in it
    holds = [t in ("article", "main", "h1") for t in tag]
    for i in range(n - 1, 0, -1):
        if holds[i] and not cut[i]:
            holds[parent[i]] = True
    for i in tree.by_name:
        cut[i] = cut[i] or not holds[i]
    for i in range(1, n):
        cut[i] = cut[i] or cut[parent[i]]

    # paragraphs: runs of text between borders; their container is the block around them
    block = list(range(n))
    for i in range(1, n):
        if tag[i] in INLINE:
            block[i] = block[parent[i]]
    score, size, linked = [0.0] * n, [0] * n, [0] * n
    run: list[tuple[int, str]] = []

    def paragraph():
        text = " ".join("".join(s for _, s in run).split())
        if text:
            length = len(text)
            in_links = min(length, sum(len(s.strip()) for i, s in run if link[i]))
            at = block[run[0][0]]
            size[at] += length
            linked[at] += in_links
            points = (length >= 25) + text.count(",") + min(length / 100, 3)
            points *= 1 - in_links / length
            up = parent[at] if tag[at] in ("p", "pre", "blockquote", "td", "li", "dd") and parent[at] >= 0 else at
            share = 1
            while up >= 0 and share <= 6:
                score[up] += points / share
                up, share = parent[up], share + 1
        run.clear()

    for i, s in tree.flow:
        if s is None:
            paragraph()
        elif not cut[i]:
            if run and block[run[0][0]] != block[i]:
                paragraph()
            run.append((i, s))
    paragraph()

    for i in range(n - 1, 0, -1):
        size[parent[i]] += size[i]
        linked[parent[i]] += linked[i]
    if not size[0]:
        return ""
    discounted = [s * (1 - l / z) if z else 0.0 for s, z, l in zip(score, size, linked)]
    best = max((i for i in range(n) if tag[i] not in INLINE), key=lambda i: (discounted[i], -i))

    whole, up = None, best
    while up >= 0 and whole is None:
        whole = up if tag[up] == "article" else None
        up = parent[up]
    up = best
    while up >= 0 and whole is None:
        whole = up if tag[up] == "main" else None
        up = parent[up]
    kept = {whole if whole is not None else best}
    if whole is None and best:
        for i in range(1, n):
            if parent[i] == parent[best] and not cut[i] and size[i]:
                density = linked[i] / size[i]
                if discounted[i] >= max(0.2 * discounted[best], 1) and density < 0.5:
                    kept.add(i)
                elif tag[i] in ("p", "h1", "h2", "h3", "blockquote", "pre") and density < 0.25:
                    kept.add(i)
    # lists of links inside what is kept are menus, but an article's own are part of it
    links = [0] * n
    for i in range(n - 1, 0, -1):
        if tag[i] == "a":
            links[block[parent[i]]] += 1
        if tag[i] in ("li", "ul", "ol") and tag[parent[i]] in ("li", "ul", "ol"):
            links[parent[i]] += links[i]
    inside = [False] * n
    for i in range(n):
        menu = whole is None and tag[i] in ("ul", "ol") and links[i] >= 3 and linked[i] > 0.8 * size[i]
        inside[i] = (i in kept or (i > 0 and inside[parent[i]])) and not cut[i] and not menu
    return " ".join("".join(" " if s is None else s if inside[i] else "" for i, s in tree.flow).split())


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per input row: id, url, ``text`` (the main text, empty if there is none) and
    ``n_chars`` (its code points).

    Null and empty pages give an empty text, null ids and urls stay null, repeated
    rows give a row each; pages of any size are read whole; other columns are
    ignored.  No shuffle.
    """
    slim = pages.select(
        F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.col(html_col).cast("string").alias("_html")
    )

    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py() or "") for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [id_col, url_col, "text", "n_chars"],
            )

    schema = T.StructType([
        T.StructField(id_col, slim.schema["_id"].dataType), T.StructField(url_col, slim.schema["_url"].dataType),
        T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()),
    ])
    return slim.mapInArrow(run, schema)
