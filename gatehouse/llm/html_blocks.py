"""HTML to leaf blocks: the runs of text between block-level tags, with their ancestors."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

# Element names of HTML that matter here.
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
 fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu
 nav noscript ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe xmp noembed noframes template svg math".split())
# a start tag closes an open element of these, unless a container stands between them
CLOSES = {
    "p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "option": ("option",),
    "optgroup": ("option", "optgroup"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"),
    "tbody": ("thead", "tbody", "tr", "td", "th", "p"), "thead": ("tbody", "tr", "td", "th", "p"),
    "tfoot": ("thead", "tbody", "tr", "td", "th", "p"), "body": ("head",),
}
ENDS_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer
 form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul""".split())
SCOPE = frozenset("ul ol dl table select article section div main aside nav footer header form body td th li dd".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*+)(?:((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|([^>]*+)(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
CAMEL = re.compile(r"([a-z])([A-Z])")
SPLIT = re.compile(r"[^a-z]+")


NONE: frozenset[str] = frozenset()


def _with(held: frozenset[str], more) -> frozenset[str]:
    """``held`` and ``more``; the same object where nothing is new."""
    new = [x for x in more if x not in held]
    return held.union(new) if new else held


class Element:
    """An open element with what its ancestors and it add up to, taken over from its parent once.

    ``own``, ``outer``: innermost and outermost tag but html and body; ``inside``: the tags around the
    innermost; ``pairs``: nested tags; ``names``: words of class, id and role; ``hidden``.
    """

    __slots__ = ("tag", "words", "number", "parent", "own", "outer", "depth", "inside", "pairs", "names", "hidden")

    def __init__(self, tag: str, words: tuple[str, ...], hidden: bool, number: int, parent: Element | None, known=None):
        self.tag, self.words, self.number, self.parent = tag, words, number, parent
        up = parent or ROOT
        self.names = _with(up.names, words if known is None else [w for w in words if w in known])
        self.hidden = hidden or up.hidden
        if tag in ("html", "body"):
            self.own, self.outer, self.depth, self.inside, self.pairs = up.own, up.outer, up.depth, up.inside, up.pairs
        else:
            self.own, self.outer, self.depth = tag, up.outer or tag, up.depth + 1
            self.inside = _with(up.inside, (up.own,)) if up.own else up.inside
            self.pairs = _with(up.pairs, (f"{up.own}>{tag}",)) if up.own else up.pairs


class _Root:
    own = outer = ""
    depth, hidden = 0, False
    inside = pairs = names = NONE


ROOT = _Root()


@dataclass
class Block:
    text: str
    leaf: Element | None        # the innermost element
    link_chars: int

    @property
    def path(self) -> tuple[Element, ...]:
        """The elements around the block, outermost first."""
        out, e = [], self.leaf
        while e is not None:
            out.append(e)
            e = e.parent
        return tuple(reversed(out))


def attributes(source: str) -> tuple[tuple[str, ...], bool]:
    words: list[str] = []
    hidden = False
    for name, *value in ATTRIBUTE.findall(source):
        v = unescape("".join(value))
        name = name.lower()
        if name == "hidden":
            hidden = True
        elif name == "aria-hidden":
            hidden = hidden or v.lower() == "true"
        elif name == "style":
            hidden = hidden or "display:none" in v.replace(" ", "").lower()
        else:
            words += [w for w in SPLIT.split(CAMEL.sub(r"\1 \2", v).lower()) if w]
    return tuple(dict.fromkeys(words)), hidden


def blocks(page: str, known=None) -> list[Block]:
    """The page's blocks in order; text is unescaped, white space made single and trimmed.

    ``known``: the only class, id and role words to keep in ``names`` (default: all). Takes time in
    proportion to the page, however deep its elements lie.
    """
    out: list[Block] = []
    stack: list[Element] = []
    open_tags: dict[str, int] = {}
    held: list[str] = []
    links: list[str] = []
    in_link = False
    pos = number = 0

    def flush() -> None:
        text = " ".join("".join(held).split())
        if text:
            out.append(Block(text, stack[-1] if stack else None, len(" ".join("".join(links).split()))))
        held.clear()
        links.clear()

    def say(text: str) -> None:
        held.append(text)
        if in_link:
            links.append(text)

    def leave(at: int) -> None:
        for e in stack[at:]:
            open_tags[e.tag] -= 1
        del stack[at:]

    def close(tags: tuple[str, ...]) -> None:
        """End the open elements of ``tags`` that no container shields."""
        i = len(stack) - 1
        while i >= 0 and any(open_tags.get(t) for t in tags):
            if stack[i].tag in tags:
                flush()
                leave(i)
            elif stack[i].tag in SCOPE:
                return
            i -= 1

    while True:
        m = TOKEN.search(page, pos)
        say(unescape(page[pos:m.start() if m else len(page)]))
        if m is None:
            break
        pos = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            if tag == "a":
                in_link = False
            elif tag in BLOCK:
                flush()
                if open_tags.get(tag):
                    leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag))
            continue
        source = m.group(3) if m.group(3) is not None else m.group(4) or ""
        if tag in RAW:
            if not source.endswith("/"):
                end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, pos)
                pos = end.start() if end else len(page)
            continue
        if tag == "br":
            say(" ")
            continue
        if tag == "a":
            in_link = True
            continue
        if tag not in BLOCK:
            continue
        flush()
        if tag in ENDS_P:
            close(("p",))
        if tag in CLOSES:
            close(CLOSES[tag])
        if tag not in VOID:
            number += 1
            words, hidden = attributes(source) if source else ((), False)
            stack.append(Element(tag, words, hidden, number, stack[-1] if stack else None, known))
            open_tags[tag] = open_tags.get(tag, 0) + 1
        if tag in ("p", "td", "h1", "h2", "h3", "article", "main"):
            in_link = False             # a link left open does not reach into the next block
    flush()
    return out
