"""Main text of web pages by tag-path ratios.

A page is cut into blocks of text, each with the path of block elements from
the root down to it.  For each path the length of its text outside links and
its punctuation are added up and divided by the number of its blocks.  Both
ratios are smoothed over neighbouring blocks, weighted by how much of their
paths agrees, and over the block that leads to a list, a table or a quotation.
They are fused into one score, times the path's weight, which is below one if
an element on it says that it is a menu, header, footer, sidebar, notice,
advert, form or comment, or if a line outside the article states rights.  Paths whose score is not far below the page's usual
one hold content.  The page's text is the blocks of these paths, and headings
right before them.

A word of a class or id, or a form or header element, does not count around an
article or main element or most of the page's text outside links.  Weights only
compare what a page has: one that is marked all over gives its text still.

Time is linear in the length of a page, however deep its elements are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RADIUS = 2  # of the smoothing, in blocks
LEAST = 0.35  # of the page's usual score: what a path needs to hold content
WEIGHTS = (1.0, 0.5, 0.05, 0.01)  # of paths without a mark, with a light one, which dense text makes up for, a weak one and a strong one

# Element names and the words in class, id and role that tell their use.
_LIGHTLY, _WEAKLY, _STRONGLY = 1, 2, 3  # marks
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol option p pre section select summary table tbody td tfoot th thead tr ul template".split()
)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_LEFT_OUT = frozenset("head script style title textarea noscript template iframe nav footer aside form button select option input label fieldset legend dialog menu svg canvas object audio video noembed noframes".split())
_LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar status toolbar".split())
_LEFT_OUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adsbygoogle banner banners sponsor sponsored sponsors promo promos promotion promoted commercial "
    "sidebar sidenav aside rail menu menus submenu nav navbar navigation navi breadcrumb breadcrumbs crumbs topnav masthead header topbar footer foot colophon bottombar "
    "comment comments commentlist commentary disqus respond reply replies discussion reactions "
    "cookie cookies consent gdpr notice notices notification notifications alert alerts warning disclaimer popup modal overlay lightbox interstitial "
    "newsletter subscribe subscription signup register login signin paywall form search searchbox "
    "social share sharing sharebar follow related recommended recommendations recirculation trending popular teaser teasers widget widgets toolbar pagination pager paging "
    "copyright legal skip hidden invisible author authors bio "
    "anzeige anzeigen seitenleiste kopfzeile fusszeile fußzeile navigationsleiste hinweis suche teilen abonnieren verwandt "
    "publicité publicite publicités publicites encart entête entete recherche partage partager abonnement "
    "publicidad anuncio anuncios cabecera lateral navegación navegacion búsqueda busqueda compartir suscripción suscripcion relacionados relacionadas".split()
)
_STRONG = ("comment", "komment", "coment", "advert", "werb", "publici", "anunci", "sponsor", "disqus")  # words that begin so mark whatever an element holds
_WEAK_NAMES = frozenset("form fieldset header".split())
_LINE_WORDS = frozenset("header masthead teaser teasers warning notice alert disclaimer".split())  # that mark no heading, paragraph or part of one
_FRAME_WORDS = frozenset("has have with without no is".split())  # as in has-sidebar: says what an element is next to
_CLOSES = {  # an element of this name ends when one of these starts
    "p": _BLOCKS - {"body", "html", "head", "option"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "option": frozenset(["option"]),
    "tr": frozenset(["tr", "tbody", "tfoot", "thead"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "thead": frozenset(["tbody", "tfoot"]),
    "tbody": frozenset(["tbody", "tfoot"]),
    "head": frozenset(["body"]),
}
_HEAD = frozenset("title meta link script style base noscript template".split())  # what does not end a head
_LISTS = frozenset("ul ol dl table menu select div section article".split())  # what an li, dt or td does not end across
_ITEMS = frozenset("li dt dd td th tr blockquote pre figure figcaption caption".split())  # what a block before them leads to
_RIGHTS = re.compile(r"(?:©|\(c\)\s|copyright\b|all rights reserved)", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?、。！，：；？…¿¡]")

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<loose>/?[a-zA-Z][^>]*)(?:>|\Z)"
    r"|<(?P<other>[!?/][^>]*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORDS = re.compile(r"[A-ZÀ-Þ]?[a-zß-ÿ]+|[A-ZÀ-Þ]+(?![a-zß-ÿ])")


class _Path:
    """A node of the tree of tag paths; elements with equal paths and marks share it."""

    __slots__ = ("below", "depth", "mark", "name", "up")

    def __init__(self, up: _Path | None, name: str, mark: int):
        self.up, self.name, self.mark = up, name, mark
        self.depth = up.depth + 1 if up else 1
        self.below: dict[tuple[str, int], _Path] = {}

    def to(self, name: str, mark: int) -> _Path:
        """The path one element on. A mark holds for all that is below it."""
        mark = max(mark, self.mark)
        if (path := self.below.get((name, mark))) is None:
            path = self.below[name, mark] = _Path(self, name, mark)
        return path

    def kinship(self, other: _Path) -> float:
        """Share of the longer path that both have in common, squared."""
        a, b, longest = self, other, max(self.depth, other.depth)
        while a is not b:
            if a.depth >= b.depth:
                a, b = a.up, b
            else:
                b = b.up
            if a is None:
                return 0.0
        return (a.depth / longest) ** 2


class _Element:
    __slots__ = ("block", "cut", "inside", "mark", "name", "number", "parent", "path", "plain")

    def __init__(self, number: int, name: str, parent: _Element | None, mark: int, cut: bool):
        self.number, self.name, self.parent, self.mark = number, name, parent, mark
        self.block = self if name in _BLOCKS or parent is None else parent.block
        # a marked element inside a line, whose text is not the line's
        self.cut = self.block is not self and (cut or parent.cut)
        self.inside = name in ("article", "main") or parent is not None and parent.inside
        self.plain = 0  # characters of its own text outside links
        self.path: _Path | None = None


class _Block:
    __slots__ = ("element", "linked", "path", "text")

    def __init__(self, element: _Element, text: str, linked: int):
        self.element, self.text, self.linked = element, text, linked
        self.path: _Path | None = None


def _marked(name: str, rest: str, inside: bool) -> int:
    """Whether an element says of itself that it is no content: 0, _LIGHTLY (by a word, in an article or main element, which is inside), _WEAKLY or _STRONGLY."""
    if name in _LEFT_OUT and name not in _WEAK_NAMES:
        return _STRONGLY
    mark = _WEAKLY if name in _LEFT_OUT or name == "header" and not inside else 0
    if not rest or name in ("html", "body"):
        return mark
    no_marks = _LINE_WORDS if name in _HEADINGS or name == "p" or name not in _BLOCKS else frozenset()
    for m in _ATTRIBUTE.finditer(rest):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return _STRONGLY
        if key == "role" and value.lower().strip() in _LEFT_OUT_ROLES:
            if value.lower().strip() != "form":
                return _STRONGLY
            mark = _WEAKLY
        if key in ("class", "id") and name not in ("article", "main") or key in ("class", "id") and "comment" in value.lower():
            for one in unescape(value).split():
                words = [w.lower() for w in _WORDS.findall(one)]
                if not _FRAME_WORDS.intersection(words) and ((told := _LEFT_OUT_WORDS.intersection(words) - no_marks) or any(w.startswith(_STRONG) for w in words)) and not (words[-1:] in (["content"], ["body"]) and words[0] not in _LEFT_OUT_WORDS):
                    if any(w.startswith(_STRONG) for w in words) or told & {"ad", "ads", "adsense", "adsbygoogle"}:
                        return _STRONGLY
                    mark = max(mark, _LIGHTLY if inside else _WEAKLY)
    return mark


def _excused(elements: list[_Element]) -> frozenset[int]:
    """Weakly marked elements, as numbers, whose marks do not count."""
    n = len(elements)
    plain, holds, strong = [0] * n, [False] * n, [False] * n
    for e in elements:  # parents come first
        strong[e.number] = e.mark == _STRONGLY or e.parent is not None and strong[e.parent.number]
    for e in reversed(elements):
        i = e.number
        if not strong[i]:
            plain[i] += e.plain
            holds[i] = holds[i] or not e.mark and e.name in ("article", "main")
            if e.parent is not None:
                plain[e.parent.number] += plain[i]
                holds[e.parent.number] = holds[e.parent.number] or holds[i]
    return frozenset(e.number for e in elements if e.mark in (_LIGHTLY, _WEAKLY) and not strong[e.number] and (holds[e.number] or 2 * plain[e.number] > plain[0]))


def blocks(html: str) -> list[_Block]:
    """The page's blocks of text in page order, with their paths."""
    found, elements = _parsed(html, frozenset())
    excused = _excused(elements)
    if any(e.mark and e.block is not e for e in elements) and (excused or not found):
        # lines get back what was cut from them for a mark that does not count, and a page all in such marks its text
        found, elements = _parsed(html, excused or frozenset(e.number for e in elements))
    root = _Path(None, "html", 0)
    for e in elements:
        mark = 0 if e.number in excused else e.mark
        if e.parent is None:
            e.path = root
        elif e.block is e or mark:
            e.path = e.parent.path.to(e.name, mark)
        else:
            e.path = e.parent.path
    for b in found:
        rights = not b.element.inside and len(b.text) < 200 and _RIGHTS.match(b.text)
        b.path = b.element.path.to("©", _STRONGLY) if rights else b.element.path
    return found


def _parsed(html: str, excused: frozenset[int]) -> tuple[list[_Block], list[_Element]]:
    """The page's blocks and elements; the marks of elements with the numbers in excused cut nothing from a line."""
    root = _Element(0, "html", None, 0, False)
    elements = [root]
    stack, out = [root], []
    open_: dict[str, list[_Element]] = {}  # open elements by name
    texts: list[str] = []
    linked = links = 0
    has_body = False

    def close() -> None:
        nonlocal linked
        if texts:
            text = " ".join("".join(texts).split())
            if text:
                out.append(_Block(stack[-1].block, text, min(linked, len(text))))
            texts.clear()
        linked = 0

    def leave() -> _Element:
        nonlocal links
        gone = stack.pop()
        open_[gone.name].pop()
        links -= gone.name == "a"
        if gone.cut and not stack[-1].cut:
            texts.append(" ")
        return gone

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.match(html, at)
        at = m.end()
        kind = m.lastgroup
        if kind == "text":
            top = stack[-1]
            if not links:
                top.plain += len(m["text"].strip())
            if not top.cut:
                texts.append(unescape(m["text"]) if "&" in m["text"] else m["text"])
                if links:
                    linked += len(texts[-1].strip())
        if kind != "rest":
            continue
        name = m["name"].lower()
        if m["end"]:
            if not open_.get(name):
                if name == "br" or name == "p":
                    texts.append(" ")
                continue
            last = open_[name][-1]
            if name in _BLOCKS:
                close()
            elif last.number < stack[-1].block.number:
                continue  # an inline end tag does not end the blocks inside it
            while leave() is not last:
                pass
            continue
        if name == "br":
            texts.append(" ")
            continue
        if name == "html" or name == "body" and has_body:
            continue
        has_body = has_body or name == "body"
        if name not in _HEAD and open_.get("head"):
            close()
            last = open_["head"][-1]
            while leave() is not last:
                pass
        if name in _BLOCKS:
            close()
            e = stack[-1].block
            while e is not root and e.name in _CLOSES:
                around = e.parent.block
                if name in _CLOSES[e.name]:
                    while leave() is not e:
                        pass
                elif e.name in _LISTS:
                    break
                e = around
        rest = m["rest"]
        if name in _RAW:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = end.end() if end else n
            texts.append(" ")
            continue
        if name in _VOID or rest.endswith("/") and name not in _BLOCKS:
            continue
        mark = _marked(name, rest, stack[-1].inside)
        element = _Element(len(elements), name, stack[-1], mark, mark > 0 and len(elements) not in excused)
        elements.append(element)
        if element.cut and not stack[-1].cut:
            texts.append(" ")
        stack.append(element)
        open_.setdefault(name, []).append(element)
        links += name == "a"
    close()
    return out, elements


def _leads(found: list[_Block]) -> list[_Block | None]:
    """For each block, the last block of text, but headings, right in the element that its list, table or quotation stands in, if it came before that."""
    out: list[_Block | None] = []
    last: dict[int, _Block] = {}  # by the number of the element around a block's own
    stands: dict[int, _Element | None] = {}  # by the number of a list's item
    for b in found:
        e, way = b.element, []
        while e.parent is not None and e.number not in stands and (e.name in _ITEMS or not way and e.name == "p" and e.parent.block.name in _ITEMS):
            way.append(e)
            e = e.parent.block
            if e.name in ("ul", "ol", "dl", "menu", "dir", "table", "tbody", "thead", "tfoot"):
                way.append(e)
                e = e.parent.block if e.parent is not None else e
        home = stands[e.number] if e.number in stands else e if way else None
        for x in way:
            stands[x.number] = home
        out.append(last.get(home.number) if home is not None else None)
        if home is None and b.element.parent is not None and b.element.name not in _HEADINGS and b.linked < 0.9 * len(b.text):
            last[b.element.parent.block.number] = b
    return out


def path_scores(found: list[_Block]) -> dict[_Path, float]:
    """Fused score of each tag path."""
    sums: dict[_Path, list[float]] = {}
    for b in found:
        x = sums.setdefault(b.path, [0, 0, 0])
        x[0] += len(b.text) - b.linked
        x[1] += len(_PUNCTUATION.findall(b.text)) if b.linked < len(b.text) else 0
        x[2] += 1
    ratios = {p: (t / n, q / n) for p, (t, q, n) in sums.items()}
    paths = [b.path for b in found]
    fused: dict[_Path, list[float]] = {}
    kinship: dict[tuple[_Path, _Path], float] = {}
    for i, (path, lead) in enumerate(zip(paths, _leads(found), strict=True)):
        near = []
        for j in range(max(0, i - RADIUS), min(len(paths), i + RADIUS + 1)):
            other = paths[j]
            if (kin := kinship.get((path, other))) is None:
                kin = kinship[path, other] = path.kinship(other)
            near.append((kin * math.exp(-((i - j) ** 2) / 2), other))
        if lead is not None:
            near.append((1.0, lead.path))
        elif found[i].linked >= 0.9 * len(found[i].text) and not found[i].element.inside:
            near = [(1.0, path)]  # links that nothing leads to, as a menu right before the text, have no share in what is around them
        weight = sum(w for w, _ in near)
        text, marks = (sum(w * ratios[p][k] for w, p in near) / weight for k in (0, 1))
        x = fused.setdefault(path, [0, 0])
        x[0] += math.sqrt(text * (1 + marks)) * WEIGHTS[path.mark]
        x[1] += 1
    return {p: s / n for p, (s, n) in fused.items()}


def content_paths(found: list[_Block], scores: dict[_Path, float]) -> set[_Path]:
    """Paths that score at least LEAST of the page's usual score, the mean over its text weighted as the paths are.

    If all text is in links, so that every score is zero: the paths with the least marks.
    """
    mass = [len(b.text) * WEIGHTS[b.path.mark] for b in found]
    usual = sum(m * scores[b.path] for m, b in zip(mass, found, strict=True)) / sum(mass)
    if usual == 0:
        least = min(b.path.mark for b in found)
        return {b.path for b in found if b.path.mark == least}
    return {p for p, s in scores.items() if s >= LEAST * usual}


def main_blocks(html: str) -> list[str]:
    """Texts of the content paths' blocks, and of headings that such a block follows, in page order."""
    found = blocks(html)
    if not found:
        return []
    content = content_paths(found, path_scores(found))
    out: list[str] = []
    follows = None  # the next block that is no heading, if it was chosen
    for b in reversed(found):
        heading = b.element.name in _HEADINGS
        chosen = b.path in content or heading and follows is not None and b.path.mark <= follows.path.mark
        if chosen:
            out.append(b.text)
        if not heading:
            follows = b if chosen else None
    return out[::-1]


def main_text(html: str | None) -> str:
    return "\n\n".join(main_blocks(html)) if html else ""


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row for each row of pages: page_id, url, text, n_chars.

    text is the main text's blocks, white space within a block as one space,
    joined by empty lines; empty for null or empty html and for pages without
    content.  Null ids and urls stay null; repeated rows stay repeated.  An
    empty table gives an empty result.  Other columns are not looked at.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch["html"]]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
