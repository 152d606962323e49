"""Main text of HTML pages by the ratios of their tag paths.

A page is read to blocks of text: runs between the tags that begin or end a block. Elements that
can't hold an article (scripts, menus, footers, forms ...) and those whose class or id says what
they are (advert, sidebar, comments ...) give no blocks. Every other block has the tag path of its
element from the root, steps named by tag and class. Per path, over the page:

* text ratio: characters that are in no link, a block,
* punctuation ratio: sentence punctuation, a block.

Both are smoothed over the tree of paths: a path at a distance of d steps (up to the common
ancestor and down again) counts DECAY^d, sums before ratios. This takes two passes over the tree.
They are fused as text * (1 + punctuation), paths below ``article`` or ``main`` counting PRIOR
times. Paths of at least SHARE of the largest value are content. The deepest path that holds
COVER of their characters is the article's place: content paths in it are selected, and with them
what stands beside them there, as headings, short items and captions do (but no lists of links).

A page costs time and memory in proportion to its size, whatever its tags: there are no pairs of
paths, and a quote or comment that doesn't end is looked for once.

Defined results: character references are decoded, white space in a block is one space, blocks are
joined by one space in page order; nothing is cut. Null and empty pages, and pages without a block,
have an empty text; a page without tags is one block. A ``form`` or ``header`` with most of a
page's text, or one that holds ``main`` or ``h1``, is no form or header. Repeated rows each get
their row; null ids and urls are kept. Only the html column and ``keep`` columns are read.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tierlake.llm.common import map_texts, type_of

DECAY, PRIOR, SHARE, COVER = 0.4, 4.0, 0.08, 0.8

# Elements of HTML by what they do.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label "
             "mark q ruby rb rt rp s samp small span strike strong sub sup time tt u var wbr".split())
NO_TEXT = set("head script style title textarea xmp iframe noembed noframes noscript template svg "
              "canvas audio video object embed map select option optgroup datalist button input "
              "nav aside footer dialog menu form header fieldset".split())
NO_TEXT_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert "
                    "menu menubar toolbar form status tablist".split())
WHOLE = {"#root", "html", "body"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: What a start tag ends besides an open paragraph: tags of the same kind up to their container.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
            "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
            "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
            "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"})}

# Words in classes and ids that name what is not the article.
OUTSIDE = set("ad ads adbox adsbygoogle adsense adslot adunit advert advertisement advertisements "
              "advertising adverts banner billboard leaderboard promo promos promotion sponsor "
              "sponsored sponsors nav navbar navigation menu menus submenu breadcrumb breadcrumbs "
              "header masthead topbar toolbar footer foot colophon copyright sidebar sidebars aside "
              "rail widget widgets comment comments commentlist commenting disqus discussion reply "
              "replies respond responses cookie cookies consent gdpr notice notices notification "
              "popup modal overlay newsletter subscribe subscription signup login share sharing "
              "social related recommended recommendations teaser teasers pager pagination skip "
              "hidden disclaimer".split())
COMMENTS = set("comment comments commentlist comment-body comment-list comment-item reply replies "
               "user-comment reader-comment reader-comments".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^\s>=]++|\s++|=\s*+(?:\"[^\"]*+\"|'[^']*+'"
                  r"|[^\s>\"'][^\s>]*+)?)*+)>")
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])(class|id|role|style|hidden|aria-hidden)\s*+"
                        r"(?:=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++)))?", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile("[.,;:!?…、。！，；？؟،।]")
_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE) for tag in RAW}


class _Page:
    """The elements and blocks of a page.

    Elements are numbered in page order, 0 is the root. A block is [element, pieces, characters in
    links]; pieces are decoded text.
    """

    def __init__(self, source: str):
        self.tags, self.parents, self.labels, self.marked = ["#root"], [-1], ["#root"], [False]
        self.blocks: list[list] = []
        self._stack, self._open, self._fresh = [0], {}, True
        self._links = self._muted = 0
        self._read(source)

    def _text(self, text: str) -> None:
        if not text:
            return
        if self._fresh:
            at = self._stack[-1]
            while self.tags[at] in INLINE:
                at = self.parents[at]
            self.blocks.append([at, [], 0])
            self._fresh = False
        if "&" in text:
            text = html.unescape(text)
        if self._muted:
            return
        block = self.blocks[-1]
        block[1].append(text)
        if self._links:
            block[2] += len(text)

    def _close_top(self) -> None:
        at = self._stack.pop()
        tag = self.tags[at]
        self._open[tag] -= 1
        self._muted -= self.marked[at] and tag in INLINE
        if tag == "a":
            self._links -= 1
        if tag not in INLINE:
            self._fresh = True

    def _start(self, tag: str, attributes: str) -> None:
        if tag not in INLINE:
            self._fresh = True
            if self._open.get("p"):
                depth = len(self._stack) - 1
                while depth and self.tags[self._stack[depth]] in INLINE:
                    depth -= 1
                if self.tags[self._stack[depth]] == "p":
                    while len(self._stack) > depth:
                        self._close_top()
            if tag in SIBLINGS:
                same, around = SIBLINGS[tag]
                depth = len(self._stack) - 1
                while depth and self.tags[self._stack[depth]] in INLINE:
                    depth -= 1
                while depth and self.tags[self._stack[depth]] in same:
                    while len(self._stack) > depth:
                        self._close_top()
                    depth -= 1
        elif tag == "br":
            self._text(" ")
        if tag in VOID:
            return
        if tag == "a" and self._open.get("a") and self.tags[self._stack[-1]] == "a":
            self._close_top()
        label, marked = (tag, False) if not attributes else self._named(tag, attributes)
        self.tags.append(tag)
        self.parents.append(self._stack[-1])
        self.labels.append(label)
        self.marked.append(marked)
        self._stack.append(len(self.tags) - 1)
        self._open[tag] = self._open.get(tag, 0) + 1
        self._links += tag == "a"
        self._muted += marked and tag in INLINE

    @staticmethod
    def _named(tag: str, attributes: str) -> tuple[str, bool]:
        """The name of a step, and whether attributes mark the element as no part of an article."""
        found = {}
        for m in _ATTRIBUTE.finditer(attributes):
            found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
        names = found.get("class", "").split()
        label = re.sub(r"\d+", "", names[0] if names else found.get("id", ""))
        label = f"{tag}.{label}" if label else tag
        if tag in ("html", "body", "main", "#root"):
            return label, False
        names += found.get("id", "").split()
        if tag == "article":
            return label, any(n.lower() in COMMENTS for n in names)
        style = re.sub(r"\s", "", found.get("style", "")).lower()
        return label, ("hidden" in found or "display:none" in style
                       or found.get("aria-hidden", "").lower() == "true"
                       or found.get("role", "").lower() in NO_TEXT_ROLES
                       or any(w.lower() in OUTSIDE for n in names
                              for w in (n, *_WORD.findall(n))))

    def _end(self, tag: str) -> None:
        if tag not in INLINE:
            self._fresh = True
        if tag == "br":
            self._text(" ")
        elif self._open.get(tag):
            # An end tag of an inline element does not end blocks around it.
            if tag in INLINE and self.tags[self._stack[-1]] not in INLINE:
                return
            while self.tags[self._stack[-1]] != tag:
                if tag in INLINE and self.tags[self._stack[-1]] not in INLINE:
                    return
                self._close_top()
            self._close_top()

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        last = source.rfind(">")
        while at < size:
            start = source.find("<", at)
            if start < 0:
                self._text(source[at:])
                return
            if start > at:
                self._text(source[at:start])
            following = source[start + 1:start + 2]
            if source.startswith("<!--", start):
                if source.startswith((">", "->"), start + 4):
                    at = source.index(">", start) + 1
                else:
                    end = source.find("-->", start + 4)
                    at = size if end < 0 else end + 3
            elif following in ("!", "?") and following:
                end = source.find(">", start)
                at = size if end < 0 else end + 1
            else:
                found = _TAG.match(source, start) if start < last else None
                if found is None:
                    if start > last and (following.isalpha() or following == "/"):
                        return  # a tag that the page ends in
                    if following == "/" and start < last:
                        at = source.index(">", start) + 1  # an end tag without a name
                        continue
                    self._text("<")
                    at = start + 1
                    continue
                at = found.end()
                tag = found[2].lower()
                if found[1]:
                    self._end(tag)
                    continue
                self._start(tag, found[3])
                if tag in RAW:
                    end = _ENDS[tag].search(source, at)
                    at = size if end is None else end.start()


def tree_sums(parents: list[int], values: np.ndarray, decay: float) -> np.ndarray:
    """For each node the sum of all nodes' values (rows) times decay^distance; parents come first."""
    total = np.array(values, dtype=np.float64)
    for i in range(len(parents) - 1, 0, -1):
        total[parents[i]] += decay * total[i]
    for i in range(1, len(parents)):
        # The parent's sum without what it has from this node.
        total[i] += decay * (total[parents[i]] - decay * total[i])
    return total


def _inside(page: _Page) -> list[bool]:
    """Whether an element and all around it may hold an article."""
    size = len(page.tags)
    holds = [t in ("main", "h1") for t in page.tags]
    chars = [0] * size
    for at, pieces, _ in page.blocks:
        chars[at] += sum(map(len, pieces))
    for i in range(size - 1, 0, -1):
        holds[page.parents[i]] |= holds[i]
        chars[page.parents[i]] += chars[i]
    shown = sum(chars[i] for i in range(1, size) if page.parents[i] == 0) or chars[0]
    inside = [True] * size
    for i in range(1, size):
        tag = page.tags[i]
        out = page.marked[i]
        if tag in NO_TEXT:
            out |= tag not in ("form", "header", "fieldset") or 2 * chars[i] < shown
        wrapper = holds[i] and tag not in NO_TEXT - {"form", "header"}
        inside[i] = inside[page.parents[i]] and (not out or (wrapper and tag != "article"))
    return inside


def main_text(source: str | None) -> str:
    """The article's text of a page."""
    page = _Page(source or "")
    inside = _inside(page)
    blocks = []
    for at, pieces, linked in page.blocks:
        text = " ".join("".join(pieces).split())
        if text and inside[at]:
            blocks.append((at, text, linked))
    if not blocks:
        return ""

    # Elements with equal names below equal paths are one path.
    numbers: dict[tuple[int, str], int] = {(-1, "#root"): 0}
    path_of, parents, tags = [0] * len(page.tags), [-1], ["#root"]
    prior = [1.0]
    for i in range(1, len(page.tags)):
        if inside[i]:
            up = path_of[page.parents[i]]
            if page.tags[i] in INLINE:
                path_of[i] = up
                continue
            key = (up, page.labels[i])
            if key not in numbers:
                numbers[key] = len(parents)
                parents.append(up)
                tags.append(page.tags[i])
                prior.append(PRIOR if page.tags[i] in ("article", "main") else prior[up])
            path_of[i] = numbers[key]

    counts, linked_chars = np.zeros((len(parents), 3)), np.zeros(len(parents))
    for at, text, linked in blocks:
        linked_chars[path_of[at]] += min(linked, len(text))
        counts[path_of[at]] += (1, max(0, len(text) - linked), len(_PUNCTUATION.findall(text)))
    smooth = tree_sums(parents, counts, DECAY)
    n = np.maximum(smooth[:, 0], 1e-9)
    value = smooth[:, 1] / n * (1 + smooth[:, 2] / n) * np.array(prior)
    value[counts[:, 0] == 0] = 0.0
    content = value >= SHARE * value.max()

    weight = np.where(content, counts[:, 1] * (1 + counts[:, 2]) * np.array(prior), 0.0)
    below = weight.copy()
    for i in range(len(parents) - 1, 0, -1):
        below[parents[i]] += below[i]
    place = 0
    for i in range(1, len(parents)):
        if parents[i] == place and below[i] >= COVER * below[0] and below[i] > 0:
            place = i
    # A leaf is no place of an article while it has content beside it.
    if place and weight[place] == below[place]:
        place = parents[place]
    inner = np.zeros(len(parents), dtype=bool)
    inner[place] = True
    for i in range(place + 1, len(parents)):
        inner[i] = inner[parents[i]]
    # What stands beside content belongs to it: all but lists of links in an article's place, the
    # headings only where the whole page is the place.
    if tags[place] in WHOLE:
        around = {parents[i] for i in np.flatnonzero(content)}
        beside = np.array([t in HEADINGS and up in around for t, up in zip(tags, parents)])
    else:
        beside = linked_chars <= counts[:, 1]
        # A title may stand before the place, in a wrapper of both.
        if tags[parents[place]] not in WHOLE and tags[place] not in ("article", "main"):
            inner |= np.array([t in ("h1", "h2") and up == parents[place]
                               for t, up in zip(tags, parents)])
    chosen = (content | beside) & inner
    return " ".join(text for at, text, _ in blocks if chosen[path_of[at]])


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"),
            source: str = "html") -> DataFrame:
    """The ``keep`` columns, text and n_chars of every row of pages."""
    def run(part):
        text = pa.array([main_text(s) for s in part.column(source).to_pylist()], pa.string())
        return [*(part.column(c) for c in keep), text,
                pc.cast(pc.utf8_length(text), pa.int64())]

    schema = ", ".join(f"`{c}` {type_of(pages, c)}" for c in keep)
    return map_texts(pages.select(*keep, source), f"{schema}, text string, n_chars bigint", run,
                     text=source)
