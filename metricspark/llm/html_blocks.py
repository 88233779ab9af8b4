"""HTML pages as leaf blocks of text with what stands around them."""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from dataclasses import dataclass

#: Elements whose start and end part blocks. Fixed values.
BLOCK_TAGS = frozenset(
    """
    address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li main menu nav noframes ol
    optgroup option p pre section select summary table tbody td tfoot th thead tr ul video audio canvas object
    """.split()
)
#: Elements that have no end tag.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
RAW_TAGS = frozenset("script style noscript template textarea title svg math iframe noframes noembed xmp object select".split())
#: What a start tag closes without an end tag, up to the given outer elements.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: A comment, a declaration, a tag with its quoted attributes, or a run of text.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|([^<]+|<)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


#: Words in class, id and role that tell what a box is for. Fixed values.
NAMES = {
    "menu": "nav navigation navbar menu menubar breadcrumb breadcrumbs crumbs tabs toc pagination pager skip sitemap",
    "frame": "header masthead banner topbar logo branding footer foot colophon copyright legal credits bottom",
    "side": "sidebar aside side rail widget widgets related recommended recommendations more popular trending teaser promo",
    "notice": "notice cookie cookies consent gdpr privacy alert warning popup modal overlay dialog newsletter subscribe paywall",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promoted dfp taboola outbrain banner",
    "form": "form search login signin signup register contact input",
    "reader": "comment comments reply replies respond discussion disqus thread reader readers feedback review reviews",
    "share": "share sharing social follow like likes print tools meta tags byline",
    "main": "article content main post entry story body text blog page",
}
_KIND: dict[str, list[str]] = {}
for _kind, _words in NAMES.items():
    for _word in _words.split():
        _KIND.setdefault(_word, []).append(_kind)
#: Elements that are told apart as ancestors; the others are "box".
TAGS = frozenset(
    """article aside nav header footer main section form figure figcaption table ul ol dl blockquote h1 h2 h3 h4 h5 h6 p
    li pre td dialog menu fieldset button label details body div a span""".split()
)
#: Elements that mark what is no article.
BOILER_TAGS = frozenset("nav aside footer form menu dialog button".split())
APART_TAGS = frozenset("nav aside footer form".split())


@dataclass(frozen=True)
class Place:
    """What the ancestors of a block say, summed up from the outermost on, so that an element
    of any depth adds to the sum of its parent: known tags, the nearest telling tag, kinds of
    names, and whether a block is hidden, in an article, or in something apart inside it."""

    tags: frozenset[str] = frozenset()
    own: str = "none"
    kinds: frozenset[str] = frozenset()
    hidden: bool = False
    article: bool = False
    apart: bool = False

    @property
    def boiler(self) -> bool:
        return bool(self.kinds - {"main"} or self.tags & BOILER_TAGS)

    def inside(self, tag: str, names: list[str], hidden: bool) -> Place:
        """The place inside a further element; the same object if it says nothing new."""
        known = tag if tag in TAGS else "box"
        tags = self.tags if known in self.tags or tag in ("html", "body") else self.tags | {known}
        own = self.own if known in ("a", "span", "box", "body") else known
        kinds = self.kinds.union(*(_KIND.get(n, ()) for n in names)) if names else self.kinds
        article = self.article or tag == "article"
        made = Place(tags, own, kinds, self.hidden or hidden, article, self.apart or article and tag in APART_TAGS)
        return self if made == self else made


@dataclass(slots=True)
class Element:
    """An open element; ``block`` is the depth of the nearest block element, itself included."""

    tag: str
    place: Place
    block: int


@dataclass
class Block:
    """Text of one leaf block and what stands around it."""

    text: str
    place: Place
    linked: int
    links: int
    boxes: int = 0


def _marks(attributes: str) -> tuple[list[str], bool]:
    """The words of class, id and role, and whether the element is hidden."""
    names: list[str] = []
    hidden = False
    if attributes:
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), next((v for v in values if v), "")
            if key in ("class", "id", "role"):
                names += (n.lower() for n in _NAME.findall(value))
            elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
                hidden = True
    return names, hidden


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a page in page order; broken markup is read as browsers do, as far
    as blocks go. Character references are decoded, white space inside a block becomes one
    blank. Null and empty pages have none. Time and memory grow with the length of the page,
    however deep its elements lie: the depths of the open elements are kept by tag."""
    found: list[Block] = []
    if not page:
        return found
    stack: list[Element] = []
    depths: dict[str, list[int]] = defaultdict(list)
    parts: list[str] = []
    state = {"linked": 0, "links": 0, "boxes": 0, "inside": 0}

    def close() -> None:
        text = " ".join("".join(parts).split())
        if text:
            found.append(Block(text, stack[-1].place if stack else Place(), state["linked"], state["links"], state["boxes"]))
        parts.clear()
        state["linked"] = state["links"] = state["boxes"] = 0

    def pop_to(depth: int) -> None:
        for element in reversed(stack[depth:]):
            depths[element.tag].pop()
            if element.tag == "a":
                state["inside"] -= 1
        del stack[depth:]

    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.match(page, at)
        at = token.end()
        slash, tag, attributes, text = token.groups()
        if text is not None:
            text = html.unescape(text) if "&" in text else text
            parts.append(text)
            if state["inside"] > 0:
                state["linked"] += len("".join(text.split()))
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            if depths[tag]:
                depth = depths[tag][-1]
                if stack[-1].block >= depth:
                    close()
                pop_to(depth)
            elif tag in BLOCK_TAGS:
                close()
            continue
        if tag in RAW_TAGS and not attributes.rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
            parts.append(" ")
            continue
        if tag in ("br", "wbr", "hr"):
            parts.append("" if tag == "wbr" else " ")
            if tag == "hr":
                close()
            continue
        if tag in VOID_TAGS:
            state["boxes"] += tag == "input"
            continue
        if tag in BLOCK_TAGS:
            close()
            # A paragraph ends where another block begins.
            nearest = stack[-1].block if stack else -1
            if nearest >= 0 and stack[nearest].tag == "p":
                pop_to(nearest)
            if tag in CLOSED_BY:
                ended, outer = CLOSED_BY[tag]
                fence = max((depths[t][-1] for t in outer if depths[t]), default=-1)
                least = min((d[at_fence] for d in (depths[t] for t in ended) if (at_fence := bisect_right(d, fence)) < len(d)), default=None)
                if least is not None:
                    pop_to(least)
        if not attributes.rstrip().endswith("/"):
            parent = stack[-1] if stack else None
            place = (parent.place if parent else Place()).inside(tag, *_marks(attributes))
            depths[tag].append(len(stack))
            stack.append(Element(tag, place, len(stack) if tag in BLOCK_TAGS else parent.block if parent else -1))
            if tag == "a":
                state["inside"] += 1
                state["links"] += 1
    close()
    return found
