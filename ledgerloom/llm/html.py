"""Main text of web pages by tree scoring.

The page becomes a tree. Each block of text passes points for its length and
commas to its ancestors, less the further away; a container's points are
discounted by the share of its text that stands in links. From the best one the way leads up, however far, as long as
what a parent adds is mostly text outside links (beyond ``article`` and ``main`` it does not, and to the whole page only if the
greater part of its text is there): so an article keeps all its sections. That container
and those of its siblings that score well too are kept, with their headings, in page order.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are known by element, role, class or id and take no part. A class or
id is no more than a hint: an element with a name of an article beside it stays
(``content has-sidebar``), and so does one that holds the article (``_spared``). If
nothing is left, the page is read again with less regard to names. A compound of a word that sections of an
article may be named by, as ``related-work``, counts only if its other words are words of layout, as in ``related-posts``.
Lists and tables of links are dropped outside the container, and in it before its first text.

Edge cases: a null or empty page, or one without a scoring block, gives an empty
text. Cut-off pages are read as far as they go: an unfinished tag is dropped, open
elements end with the page. Pages of any length and depth are read whole, without
recursion. Repeated pages give repeated rows; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of the HTML standard by what they do to the tree.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
HIDDEN = frozenset(
    "nav header footer aside form menu dialog button select datalist fieldset search object audio video canvas "
    "applet map frameset head".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar form".split()
)
# An open element of the value's kind ends where one of the key's kind begins.
ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
# Elements that no name cuts.
WHOLE = frozenset("html body article main".split())
# Words of a class or id that name something other than the article.
UNLIKELY = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies disqus footer footnav gdpr header login masthead menu menubar modal nav navbar "
    "navigation newsletter notice notices notification overlay pager pagination paywall popup promo promoted "
    "promotion recommended related replies reply respond share sharing sidebar sidebars signup skip social sponsor "
    "sponsored subscribe subscription toolbar widget widgets".split()
)
LIKELY = frozenset("article body content entry main post story text".split())
# Those that may name a section of an article, in compounds with words that are not of layout.
SOFT = frozenset(
    "comment comments notice notices notification promotion recommended related replies reply respond share sharing social sponsor subscription".split()
)
LAYOUT = UNLIKELY | LIKELY | frozenset(
    "area articles bar block bottom box btn button buttons card cards container count counts entries feed form group head heading icon icons "
    "inner item items label left link links list media meta module news outer page panel posts right row section site "
    "slot stories thread title top topics unit videos wrap wrapper".split()
)

TAG_POINTS = {"article": 25.0, "main": 25.0, "div": 5.0, "section": 5.0, "td": 3.0, "pre": 3.0, "blockquote": 3.0}
NAMED_POINTS = 25.0
SIBLING_SHARE = 0.2
# Greatest share of links in what a parent adds to the best container.
ADDED_LINKS = 0.25
PAGE = ("#page", "html", "body")
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
LINK_LIST = 0.66

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(script|style|noscript|template|textarea|title|svg|math|iframe|noframes|xmp)\b(?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+>.*?(?:</\1\b[^>]*(?:>|\Z)|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)(?:>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|([^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
NAME_PART = re.compile(r"[^_\-]+")


class _Tree:
    """Elements as parallel lists; a child always has a higher number than its parent."""

    def __init__(self) -> None:
        self.parent = [-1]
        self.tag = ["#page"]
        self.out = [False]
        self.named = [0]
        self.points = [0.0]
        self.chars = [0]
        self.linked = [0]
        self.links = [0]

    def add(self, parent: int, tag: str, out: bool, named: int, points: float) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.out.append(out)
        self.named.append(named)
        self.points.append(points)
        self.chars.append(0)
        self.linked.append(0)
        self.links.append(0)
        return len(self.parent) - 1


def _judge(tag: str, attributes: str) -> tuple[bool, int, float]:
    """Whether an element is not part of an article, whether its names say so, and the points its kind has.

    Its names say so by an unlikely word that stands alone (2), as ``comments``, or in a
    compound (1), as ``with-comments``, unless a likely word stands apart from unlikely ones.
    """
    points, out, unlikely, likely = TAG_POINTS.get(tag, 0.0), tag in HIDDEN, 0, False
    if attributes and not out:
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "role":
                out |= value in ROLES
            elif name == "style":
                out |= "display:none" in value.replace(" ", "")
            elif name == "hidden":
                out = True
            elif name == "aria-hidden":
                out |= value == "true"
            else:
                named = False
                for word in value.split():
                    parts = NAME_PART.findall(word)
                    hinted = not LIKELY.isdisjoint(parts)
                    named |= hinted
                    if _unlikely(parts):
                        unlikely = max(unlikely, 1 + (len(parts) == 1))
                    else:
                        likely |= hinted
                points += NAMED_POINTS * (named and tag not in WHOLE)
    return out, 0 if likely else unlikely, points


def _unlikely(parts: list[str]) -> bool:
    """Whether a name, cut at dashes, names something other than the article."""
    found = UNLIKELY.intersection(parts)
    if not found or not found <= SOFT:
        return bool(found)
    return all(p in LAYOUT or p.isdigit() or len(p) == 1 for p in parts)


def _read(page: str, spared: frozenset[int] | None) -> tuple[_Tree, list[tuple[int, str]]]:
    """The tree, and the blocks of text in page order with the element each stands in.

    Elements are cut by name except the spared ones, or not at all if that is None; they
    have the same numbers either way.
    """
    tree, blocks = _Tree(), []
    stack, open_tags = [0], Counter()
    buffer: list[str] = []
    in_link = linked = links = 0
    home = 0  # the block element that the buffered text stands in

    def flush() -> None:
        nonlocal linked, links
        if buffer:
            text = " ".join("".join(buffer).split())
            buffer.clear()
            if text:
                blocks.append((home, text))
                tree.chars[home] += len(text)
                tree.linked[home] += min(linked, len(text))
            tree.links[home] += links
        linked = links = 0

    def pop() -> None:
        nonlocal in_link, home
        node = stack.pop()
        tag = tree.tag[node]
        open_tags[tag] -= 1
        in_link -= tag == "a"
        if tag in BLOCKS:
            home = next((n for n in reversed(stack) if tree.tag[n] in BLOCKS), 0)

    for token in TOKEN.finditer(page):
        text = token[8]
        if text is not None:
            if not tree.out[stack[-1]]:
                text = entities.unescape(text) if "&" in text else text
                buffer.append(text)
                if in_link:
                    linked += len(text.strip())
            continue
        tag = token[3] or token[6]
        if not tag:
            continue
        tag = tag.lower()
        if token[2] or token[5]:
            if open_tags[tag] > 0:
                if tag in BLOCKS or tag in HIDDEN:
                    flush()
                while tree.tag[stack[-1]] != tag:
                    if tree.tag[stack[-1]] in BLOCKS:
                        flush()
                    pop()
                pop()
            continue
        if tag in BLOCKS or tag in HIDDEN:
            flush()
            top = next((i for i in range(len(stack) - 1, 0, -1) if tree.tag[stack[i]] in BLOCKS), 0)
            if tag in BLOCKS and tree.tag[stack[top]] == "p":
                while len(stack) > top:
                    pop()
            while tag in ENDS and (found := _to_end(tree, stack, ENDS[tag])):
                while len(stack) > found:
                    pop()
        if tag in VOID:
            if tag in ("br", "hr", "img"):
                buffer.append(" ")
            continue
        up = stack[-1]
        out, named, points = (True, 0, 0.0) if tree.out[up] else _judge(tag, token[4] or token[7] or "")
        out |= bool(named) and spared is not None and tag not in WHOLE and len(tree.parent) not in spared
        if out and not tree.out[up] and tag not in BLOCKS:
            buffer.append(" ")
        node = tree.add(up, tag, out, named, points)
        stack.append(node)
        open_tags[tag] += 1
        if tag == "a":
            in_link += 1
            links += not out
        if tag in BLOCKS:
            home = node
    flush()
    return tree, blocks


def _to_end(tree: _Tree, stack: list[int], kinds: set[str]) -> int:
    """Place on the stack of the innermost element of these kinds within its list or table, or 0."""
    for i in range(len(stack) - 1, 0, -1):
        tag = tree.tag[stack[i]]
        if tag in kinds:
            return i
        if tag in ("ul", "ol", "dl", "table", "menu", "select", "div", "section", "article", "main", "body"):
            return 0
    return 0


def _spared(tree: _Tree, nothing_left: bool) -> frozenset[int]:
    """Elements with an unlikely name that hold the article, of a tree read without regard to names.

    They hold an ``article`` or ``main`` with text and no unlikely name of its own, or most
    of the page's text outside links; both if the unlikely word stands alone, as a comment
    thread may be longer than the article, and a teaser an ``article``. Where that leaves
    nothing of a page, most of its text is enough.
    """
    text = [c - n for c, n in zip(tree.chars, tree.linked, strict=True)]
    holds = [False] * len(text)
    for node in range(len(text) - 1, 0, -1):
        up = tree.parent[node]
        text[up] += text[node]
        article = tree.tag[node] in ("article", "main") and text[node] > 0 and not tree.named[node]
        holds[up] |= not tree.out[node] and (holds[node] or article)
    spared = set()
    for node, named in enumerate(tree.named):
        if named and not tree.out[node]:
            most = 2 * text[node] > text[0]
            if (most and (holds[node] or nothing_left)) or (named == 1 and (most or holds[node])):
                spared.add(node)
    return frozenset(spared)


def extract(page: str | None) -> str:
    """The article's blocks, parted by an empty line."""
    if not page:
        return ""
    everything = _read(page, None)
    tree = everything[0]
    if any(named and tag not in WHOLE for named, tag in zip(tree.named, tree.tag, strict=True)):
        for nothing_left in (False, True):
            if text := _best(*_read(page, _spared(tree, nothing_left))):
                return text
    return _best(*everything)


def _best(tree: _Tree, blocks: list[tuple[int, str]]) -> str:
    """The blocks of the best container and of its good siblings."""
    if not blocks:
        return ""
    parent, points = tree.parent, tree.points
    reached = [False] * len(parent)
    for node, text in blocks:
        gain = 1.0 + text.count(",") + min(len(text) / 100.0, 3.0)
        if tree.tag[node] in HEADINGS:
            gain = min(gain, 1.0)
        # A paragraph's points go to what holds it; text that stands in a container stays there.
        up = parent[node] if tree.tag[node] not in TAG_POINTS and parent[node] >= 0 else node
        share = 1.0
        for step in (1.0, 2.0, 6.0, 9.0):
            if up < 0:
                break
            points[up] += gain * share / step if step > 1.0 else gain
            reached[up] = True
            up = parent[up]
    chars, linked, links = tree.chars[:], tree.linked[:], tree.links[:]
    for node in range(len(parent) - 1, 0, -1):
        chars[parent[node]] += chars[node]
        linked[parent[node]] += linked[node]
        links[parent[node]] += links[node]

    def score(node: int) -> float:
        return points[node] * (1.0 - linked[node] / chars[node]) if chars[node] else 0.0

    scores = {n: score(n) for n in range(len(parent)) if reached[n] and not tree.out[n]}
    best = _raised(tree, chars, linked, max(scores, key=lambda n: (scores[n], -n)))
    # Siblings of the best container: as good in their way, or plain paragraphs with hardly a link.
    kept = [False] * len(parent)
    kept[best] = True
    limit = max(SIBLING_SHARE * scores.get(best, 0.0), 4.0)
    if parent[best] >= 0:
        beside = [n for n in range(parent[best] + 1, len(parent)) if parent[n] == parent[best] and not tree.out[n] and chars[n]]
        for node in beside:
            loose = tree.tag[node] == "p" and linked[node] <= ADDED_LINKS * chars[node]
            kept[node] |= scores.get(node, 0.0) >= limit or loose
        for node, after in reversed(list(zip(beside, beside[1:], strict=False))):  # headings of what is kept
            kept[node] |= kept[after] and tree.tag[node] in HEADINGS and linked[node] <= ADDED_LINKS * chars[node]
    within = [False] * len(parent)
    within[best] = tree.tag[best] not in PAGE
    for node in range(1, len(parent)):
        within[node] |= within[parent[node]] or tree.tag[node] in ("article", "main")
        kept[node] = kept[node] or kept[parent[node]]
    opening = next((n for n, _ in blocks if kept[n] and tree.linked[n] <= ADDED_LINKS * tree.chars[n] and tree.tag[n] not in HEADINGS), 0)
    dropped, inside = [False] * len(parent), [False] * len(parent)
    for node in range(1, len(parent)):
        up = parent[node]
        inside[node] = inside[up] or tree.tag[node] in ("article", "main")
        menu = links[node] > 1 and linked[node] > LINK_LIST * chars[node] and tree.tag[node] in ("ul", "ol", "dl", "table", "div", "section")
        menu = menu and not inside[node] and not (within[node] and node > opening)
        dropped[node] = dropped[up] or (menu and node != best)
    return "\n\n".join(text for node, text in blocks if kept[node] and not dropped[node])


def _raised(tree: _Tree, chars: list[int], linked: list[int], best: int) -> int:
    """The outermost container that adds hardly a link to what the best one holds."""
    while tree.tag[best] not in ("article", "main") and (up := tree.parent[best]) >= 0:
        added, added_links = chars[up] - chars[best], linked[up] - linked[best]
        if added_links > ADDED_LINKS * added or tree.out[up]:
            break
        if tree.tag[up] in PAGE and added - added_links < chars[best] - linked[best]:
            break
        best = up
    return best


def main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """``page_id, url`` with the article's ``text`` and its length in code points."""

    @F.pandas_udf("string")
    def extracted(pages: pd.Series) -> pd.Series:
        return pages.map(extract, na_action=None)

    found = pages.select("page_id", "url", extracted(F.col(html)).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
