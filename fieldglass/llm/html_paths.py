"""Main text of web pages by tag-path ratios.

A page is read as a stream of tags and text.  Text gathers in blocks (what lies
between block-level tags); each block hangs on the root-to-leaf path of its
block-level elements, with class and id words.  Per path the page gives two
ratios, text outside links per block and punctuation per block.  Both are smoothed
over neighbouring paths in page order, fused by their product, and paths above a
share of the page's mean are content.

What the page says of itself weights these ratios and never replaces them.  An
article mark (article, main, role=main or itemprop articleBody) is confirmed if
paths that are content by ratios alone have half of their text or more in elements
with this mark and path; text in the innermost confirmed mark then counts for more,
text outside of it and in marks not confirmed for less.  Short kinds of text (list
items, cells, captions, quotes) in the container of a content path are content with
it, unless most of the text is links, and a heading goes with the text that follows it.
If the ratios doubt the only article of a page (its only main element, if it has no
article), they decide inside of it alone, unless it is a teaser.  Sections whose
headings say that readers write there are out, and so are elements whose names or class
words say what they are (nav, footer, aside, form, advert, comments ...), but class
words do not put out an element that holds most of the page's text.
"""

from __future__ import annotations

import html as _html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship
from .grams import slices

# Element names as in the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe svg math object select".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br wbr img".split())
_OUT = frozenset("nav footer aside button menu dialog head".split())
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_OWN_KIND = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_HOLDS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_TEXT_KIND = _HEADING | frozenset("p ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption".split())
#: What a ratio counts for in a confirmed article mark, and outside of it or in a mark not confirmed.
_CONFIRMED, _DOUBTED = 2.0, 0.25

#: Class, id and role words of what is not the article.
_OUT_WORD = re.compile(
    r"(?:^|[-_\s])(?:ads?|adv|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumb\w*|foot(?:er)?|side(?:bar)?|aside|widget\w*|cookie\w*|consent|gdpr|notice|popup|modal|newsletter|subscri\w*|share|sharing|social|related|recommend\w*|comments?|respond|reply|replies|disqus|login|signup|search|copyright|masthead|skip)(?:$|[-_\s])",
    re.I,
)
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>=]*(?:=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*)?[^>=]*)*)(?:>|\Z)", re.S)
#: An attribute with its whole name; values are passed over, so nothing inside them is a name.
_ATTRIBUTE = re.compile(r"([^\s\"'/=>][^\s/=>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)))?")
#: What a layout word says of something else: no-sidebar, has-sidebar, content-with-menu.
_NOT_OWN = re.compile(r"(?:^|(?<=[-_\s]))(?:no|not|has|have|with|without|and)[-_][^-_\s]+", re.I)
#: Out words that also name a page's layout.
_LAYOUT = re.compile(r"nav\w*|menu\w*|side(?:bar)?|foot(?:er)?|aside|widget\w*|search|login|masthead|skip|banner", re.I)
_ANCHOR = re.compile(r"<(/?)a(?=[\s/>])", re.I)
#: Headings of what readers write.
_TALK = re.compile(r"(?:(?:the|all|latest|recent|show|view|post|your|reader|readers'?|user)\s+)*(?:\(?\d+\)?\s+)?(?:comments?|responses?|replies|discussion|kommentare?|commentaires?|comentarios?|leave a (?:reply|comment)|join the (?:discussion|conversation)|what do you think\??)(?:\s*[:(]?\s*\d*\s*\)?)", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…、。，！？؟،]")
_WHITE = re.compile(r"\s+")


class Block:
    """A stretch of text, its path, how much of it is links, and what the elements around it say.

    ``path``, ``marks`` and ``words`` are numbers of nodes in the page's trees.
    """

    __slots__ = ("text", "path", "links", "out", "words", "marks", "title", "place")

    def __init__(self, text, path, links, out, words, marks, title, place):
        self.text, self.path, self.links, self.out, self.words, self.marks, self.title, self.place = text, path, links, out, words, marks, title, place


class Chains:
    """A tree of nodes numbered from 0 (nothing): parents come before children, so sums go up in one pass."""

    def __init__(self):
        self.parent, self.what, self._known = [0], [None], {}

    def below(self, parent: int, what, shared: bool = True) -> int:
        """The child ``what`` of a node; the same one each time if ``shared``."""
        key = (parent, what)
        if shared and key in self._known:
            return self._known[key]
        self.parent.append(parent)
        self.what.append(what)
        if shared:
            self._known[key] = len(self.parent) - 1
        return len(self.parent) - 1

    def summed(self, values: dict[int, float]) -> list[float]:
        """By node, what lies at it and below it."""
        out = [0] * len(self.parent)
        for i, v in values.items():
            out[i] += v
        for i in range(len(out) - 1, 0, -1):
            out[self.parent[i]] += out[i]
        return out

    def handed_down(self, start, step) -> list:
        """By node, step(value of the parent, node)."""
        out = [start]
        for i in range(1, len(self.parent)):
            out.append(step(out[self.parent[i]], i))
        return out


class Page:
    """The non-empty blocks of a page in order.

    ``paths`` are root-to-leaf paths of block-level elements (a node is a step),
    ``marks`` the article marks around a block (a node is a path), ``words`` the
    elements around it whose class words say that they are not the article (a node is
    whether the words may name a layout), ``places`` single elements.
    """

    def __init__(self):
        self.blocks: list[Block] = []
        self.paths, self.marks, self.words, self.places = Chains(), Chains(), Chains(), Chains()
        self.articles = self.mains = 0  # outermost elements that mark an article, by kind

    def leaf(self, path: int) -> str:
        return self.paths.what[path].split(".", 1)[0] if path else ""

    def container(self, path: int) -> int:
        """The path without the elements at its end that hold one kind of text."""
        while self.paths.parent[path] and self.leaf(path) in _TEXT_KIND:
            path = self.paths.parent[path]
        return path


class _Open:
    """An open element, with what it and all around it say."""

    __slots__ = ("name", "path", "out", "inside", "words", "marks", "title", "place", "own")

    def __init__(self, around, name, own):
        self.name, self.own = name, own
        self.path, self.out, self.inside, self.words, self.marks, self.title, self.place = around


def blocks(text_of_page: str) -> Page:
    """The page as blocks; the time is in proportion to its length however its elements nest."""
    page, at, n = Page(), 0, len(text_of_page)
    none = (0, False, False, 0, 0, False, 0)
    stack: list[_Open] = []
    opened: dict[str, int] = {}  # open elements by name
    link: list[bool] = []  # of the open anchor, whether something closes it; empty if none is a link
    text: list[str] = []
    linked: list[str] = []  # what of the text lies in links

    def around():
        if not stack:
            return none
        s = stack[-1]
        return s.path, s.out, s.inside, s.words, s.marks, s.title, s.place

    def add(t):
        text.append(t)
        if link:
            linked.append(t)

    def end_block():
        if text:
            t, links = (_WHITE.sub(" ", _html.unescape("".join(x))).strip() for x in (text, linked))
            text.clear()
            linked.clear()
            if t:
                path, out, _, words, marks, title, place = around()
                page.blocks.append(Block(t, path, len(links), out, words, marks, title, place))
        if link and not link[0]:  # an anchor that nothing closes ends with its block
            link.clear()

    def enter(name, own):
        """Put an element on the stack; ``own`` is (step, out, article, words) of itself."""
        path, out, inside, words, marks, title, place = around()
        step, is_out, article, by_word = own
        if name not in _INLINE:
            path = page.paths.below(path, step)
        if article:
            marks = page.marks.below(marks, path)
        if by_word is not None:
            words = page.words.below(words, by_word, shared=False)
        if name not in _INLINE:
            place = page.places.below(place, name, shared=False)
        stack.append(_Open((path, out or is_out, inside or article, words, marks, title or name == "h1", place), name, own))
        opened[name] = opened.get(name, 0) + 1

    def pop_to(i):
        end_block()
        for s in stack[i:]:
            opened[s.name] -= 1
            if s.name == "a":
                link.clear()
        del stack[i:]

    def leave_inline(i):
        """Take one inline element out of the stack; what is open inside of it stays."""
        gone = stack[i]
        if gone.name == "a":
            link.clear()
        _, is_out, article, by_word = gone.own
        if not is_out and not article and by_word is None:  # nothing inside says anything because of it
            opened[gone.name] -= 1
            del stack[i]
            return
        inner = stack[i + 1 :]
        for s in stack[i:]:
            opened[s.name] -= 1
        del stack[i:]
        for s in inner:
            enter(s.name, s.own)

    def nearest(names, stop=()):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].name in names:
                return i
            if stack[i].name in stop:
                break
        return None

    while at < n:
        m = _TOKEN.search(text_of_page, at)
        if not m:
            add(text_of_page[at:])
            break
        if m.start() > at:
            add(text_of_page[at : m.start()])
        at = m.end()
        name = (m.group(2) or "").lower()
        if not name:
            continue
        if m.group(1):
            if opened.get(name):
                i = nearest((name,))
                leave_inline(i) if name in _INLINE else pop_to(i)
            continue
        if name in _RAW:
            if not m.group(3).rstrip().endswith("/"):
                at = _after_raw(text_of_page, name, at)
            continue
        if name in ("br", "hr") or name in _VOID:
            if name == "hr":
                end_block()
            else:
                text.append(" ")
            continue
        if opened.get("head"):  # what belongs in a head was dealt with above
            pop_to(nearest(("head",)))
        if name in _CLOSES_P and opened.get("p"):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name == "p":
                    pop_to(i)
                    break
                if stack[i].name not in _INLINE:
                    break
        elif name in _OWN_KIND and any(opened.get(x) for x in _OWN_KIND[name]):
            i = nearest(_OWN_KIND[name], _HOLDS[name])
            if i is not None:
                pop_to(i)
        if name not in _INLINE:
            end_block()
        said: dict[str, str] = {}
        for k, a, b, c in _ATTRIBUTE.findall(m.group(3)) if m.group(3) else ():
            said.setdefault(k.lower(), a or b or c)
        if name == "a":
            if opened.get("a"):  # an anchor ends one that is still open
                leave_inline(nearest(("a",)))
            if "href" in said:
                follows = _ANCHOR.search(text_of_page, at)
                link[:] = [bool(follows and follows.group(1))]
        words = f"{said.get('class', '')} {said.get('id', '')}".strip()
        role = said.get("role", "").lower()
        article = name in ("article", "main") or role == "main" or said.get("itemprop") == "articleBody"
        inside = around()[2]
        nested = name == "article" and bool(opened.get("article"))
        out = name in _OUT or (name == "header" and not inside) or nested or "hidden" in said or role in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog")
        own = _NOT_OWN.sub("", words) if words and name not in ("article", "main", "body", "html") else ""
        by_word = all(_LAYOUT.fullmatch(x.strip(" \t\r\n\f-_")) for x in _OUT_WORD.findall(own)) if own and _OUT_WORD.search(own) else None
        if name == "form" and by_word is None:
            by_word = True  # some page frameworks lay one form round the whole page
        if article and not (out or around()[1]):
            if name == "article":
                page.articles += 1
            elif not inside:
                page.mains += 1
        enter(name, (name + (f".{'.'.join(sorted(words.split()))}" if words else ""), out, article, by_word))
    end_block()
    return page


def _after_raw(page: str, name: str, at: int) -> int:
    """Where the page goes on after a raw element opened before ``at``.

    One that is never closed takes the rest of the page if it holds code, the text
    up to the next tag if it is a title, and nothing otherwise.
    """
    close = re.compile(rf"</{name}\s*(?:>|\Z)", re.I).search(page, at)
    if close:
        return close.end()
    if name in ("script", "style"):
        return len(page)
    tag = page.find("<", at)
    return (tag if tag >= 0 else len(page)) if name == "title" else at


def path_ratios(found: list[Block], reach: int = 1) -> dict[int, float]:
    """By path in page order, the smoothed ratios of text and punctuation, fused."""
    paths = list(dict.fromkeys(b.path for b in found))
    if not paths:
        return {}
    at = {p: i for i, p in enumerate(paths)}
    size, marks, n = (np.zeros(len(paths)) for _ in range(3))
    for b in found:
        i = at[b.path]
        size[i] += max(0, len(b.text) - b.links)
        marks[i] += len(_PUNCTUATION.findall(b.text))
        n[i] += 1
    weight = np.exp(-0.5 * np.arange(-reach, reach + 1) ** 2 / 0.25)
    smooth = lambda x: np.convolve(x, weight, "full")[reach : reach + len(x)] / np.convolve(np.ones(len(x)), weight, "full")[reach : reach + len(x)]
    return dict(zip(paths, (smooth(size / n) * smooth((marks + 0.1) / n)).tolist()))


def content_paths(found: list[Block], share: float = 0.6, reach: int = 1) -> set[int]:
    """The paths that hold content, by ratios alone."""
    fused = path_ratios(found, reach)
    least = share * sum(fused.values()) / max(1, len(fused))
    return {p for p, x in fused.items() if x >= least}


def confirmed_marks(page: Page, found: list[Block], dense: set[int]) -> set[int]:
    """The article marks, by path, that have half of the text of ``dense`` paths or more."""
    held: dict[int, int] = {}
    total = 0
    for b in found:
        if b.path in dense:
            size = max(0, len(b.text) - b.links)
            total += size
            held[b.marks] = held.get(b.marks, 0) + size
    sums = page.marks.summed(held)
    by_path: dict[int, float] = {}
    for node in range(1, len(sums)):  # a path may mark articles in several chains
        by_path[page.marks.what[node]] = by_path.get(page.marks.what[node], 0) + sums[node]
    return {m for m, n in by_path.items() if 2 * n >= total} if held else set()


def _inmost(page: Page, sure: set[int]) -> set[int]:
    """Those of some paths that none of the others lies below."""
    over: set[int] = set()
    for m in sure:
        p = page.paths.parent[m]
        while p and p not in over:
            over.add(p)
            p = page.paths.parent[p]
    return sure - over


def content(page: Page, found: list[Block], share: float = 0.6) -> list[Block]:
    """The blocks that are content, by path ratios weighted by the article marks they confirm."""
    fused = path_ratios(found)
    if not fused:
        return []
    least = share * sum(fused.values()) / len(fused)
    sure = confirmed_marks(page, found, {p for p, x in fused.items() if x >= least})
    inmost = _inmost(page, sure)
    marks = page.marks
    in_sure = marks.handed_down(False, lambda up, i: up or marks.what[i] in inmost)

    def weight(b):
        if not b.marks:
            return _DOUBTED if sure else 1.0
        inside, last = in_sure[b.marks], marks.what[b.marks]
        if last not in sure and (not inside or page.leaf(last) == "article"):
            return _DOUBTED
        return _CONFIRMED if inside else 1.0

    links, size = {}, {}
    for b in found:
        links[b.path] = links.get(b.path, 0) + b.links
        size[b.path] = size.get(b.path, 0) + len(b.text)
    weights = [weight(b) for b in found]
    heading = [page.leaf(b.path) in _HEADING for b in found]
    linked = {p for p in links if 2 * links[p] > size[p]}
    holds = {p: page.container(p) for p in links}
    good = [b.path not in linked and w * fused[b.path] >= least for b, w in zip(found, weights)]
    beside = {holds[b.path] for b, g in zip(found, good) if g}
    keep = [g or (2 * b.links <= len(b.text) and not h and w >= 1 and holds[b.path] in beside) for b, g, h, w in zip(found, good, heading, weights)]
    follows = False
    for i in range(len(found) - 1, -1, -1):
        if heading[i]:
            keep[i] = (found[i].title and weights[i] >= 1) or (follows and holds[found[i].path] in beside)
        else:
            follows = keep[i]
    return [b for b, k in zip(found, keep) if k]


def sole_article(page: Page, found: list[Block]) -> list[Block] | None:
    """The blocks in the page's one article (its one main element, if it has no article), unless that is a teaser.

    A teaser is mostly links, or its heading is one.
    """
    if page.articles != 1 and (page.articles or page.mains != 1):
        return None
    name = "article" if page.articles else None
    marks = page.marks
    held = marks.handed_down(False, lambda up, i: up or name is None or page.leaf(marks.what[i]) == name)
    own = [b for b in found if held[b.marks]]
    heads = [b for b in own if page.leaf(b.path) in _HEADING]
    teaser = 2 * sum(b.links for b in own) > sum(len(b.text) for b in own) or any(2 * b.links > len(b.text) for b in heads[:1])
    return own if own and not teaser else None


def without_talk(page: Page, found: list[Block]) -> list[Block]:
    """The blocks without sections whose headings say that readers write there.

    Such a heading takes what follows it in the same element, up to a next heading of
    its rank or a higher one there.
    """
    if not any(_TALK.fullmatch(b.text) for b in found):
        return found
    places, out, now, rank = page.places, [], None, 0
    inside: dict[int, bool] = {}

    def within(place):
        way = []
        while place > now and place not in inside:
            way.append(place)
            place = places.parent[place]
        said = inside.get(place, place == now)
        for p in way:
            inside[p] = said
        return said

    for b in found:
        head = page.leaf(b.path)
        if now is not None and (not within(b.place) or (head in _HEADING and int(head[1]) <= rank and places.parent[b.place] == now)):
            now = None
        if now is None and head in _HEADING and head != "h1" and _TALK.fullmatch(b.text):
            now, rank = places.parent[b.place], int(head[1])
            inside = {}
        if now is None:
            out.append(b)
    return out


def live(page: Page) -> list[Block]:
    """The blocks that are not out.

    Class words put an element out unless it holds most of the text of content
    paths (more than half of it if the words may name a layout, else nine tenths)
    and the page marks no article elsewhere only.
    """
    found = [b for b in page.blocks if not b.out]
    if any(b.words for b in found):
        dense = content_paths(found)
        words = page.words
        for layout, share in ((False, 0.9), (True, 0.5)):
            held: dict[int, int] = {}
            marked: dict[int, int] = {}
            total, any_mark = 0, any(b.marks for b in found)
            for b in found:
                size = len(b.text) if b.path in dense else 0
                total += size
                held[b.words] = held.get(b.words, 0) + size
                marked[b.words] = marked.get(b.words, 0) + bool(b.marks)
            held_sum, marked_sum = words.summed(held), words.summed(marked)
            stays = words.handed_down(True, lambda up, i: up and (words.what[i] != layout or (held_sum[i] > share * total and (marked_sum[i] > 0 or not any_mark))))
            found = [b for b in found if stays[b.words]]
    return without_talk(page, found)


def main_text(html: str | None, share: float = 0.6) -> str:
    """The article of a page: its blocks in page order, joined by an empty line."""
    if not html:
        return ""
    page = blocks(html)
    found = live(page)
    sole = sole_article(page, found)
    kept = content(page, found, share)
    if sole is not None:
        own = {id(b) for b in sole}
        if 2 * sum(len(b.text) for b in kept if id(b) in own) < sum(len(b.text) for b in kept) or not kept:
            kept = content(page, sole, share) or sole  # the ratios doubt the page's only article: they decide inside of it alone
    return "\n\n".join(b.text for b in kept)


def extract(pages: DataFrame, key: str = "page_id", html: str = "html", share: float = 0.6) -> DataFrame:
    """(key, url, text, n_chars) for every row of ``pages``, from the whole html.

    A null or empty html, or one without content, gives an empty text.  Null keys
    and urls stay null; repeated rows give repeated results; other columns are not
    looked at; an empty table gives an empty result.
    """
    ship(pages.sparkSession)
    key_type = pages.schema[key].dataType

    def run(batches):
        for whole in batches:
            for i, j in slices(whole.column("_html"), 4 << 20):
                b = whole.slice(i, j - i)
                text = [main_text(h, share) for h in b.column("_html").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], [key, "url", "text", "n_chars"])

    own = pages.select(F.col(key), F.col("url").cast("string").alias("url"), F.col(html).cast("string").alias("_html"))
    return own.mapInArrow(run, f"`{key}` {key_type.simpleString()}, url string, text string, n_chars long")
