"""Text blocks of HTML pages: the leaves of the page in order, each with the path of open tags."""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

# Elements that begin a block of their own, elements without an end tag, elements whose text is not shown.
BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
    section select summary table tbody td textarea tfoot th thead title tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("script style noscript template svg math iframe object canvas".split())
#: An opening tag ends an open element of the same set that lies above the nearest container.
_CLOSES = ({"p"}, {"li"}, {"dd", "dt"}, {"tr"}, {"td", "th"}, {"option"})
_CONTAINERS = frozenset("ul ol dl table tbody thead tfoot tr div section article main body nav aside select".split())

_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[^\W_]+")


@dataclass
class Block:
    text: str
    #: open elements, outermost first, each with its class, id and role words
    path: tuple[str, ...]
    linked: int  # characters inside links


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, str]] = []
        self.blocks: list[Block] = []
        self.texts: list[str] = []
        self.linked = 0
        self.path: tuple[str, ...] | None = None
        self.hidden = self.links = 0
        self.label: tuple[str, ...] | None = None

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.texts)).strip()
        if text:
            self.blocks.append(Block(text, self.path or (), self.linked))
        self.texts, self.linked, self.path = [], 0, None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.texts.append("\n")
            return
        if tag in BLOCK_TAGS:
            self.flush()
            inside = next((s for s in _CLOSES if tag in s), {"p"})
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] in inside:
                    self._close(k)
                    break
                if self.open[k][0] in _CONTAINERS:
                    break
        if tag in VOID_TAGS:
            return
        if tag in HIDDEN_TAGS:
            self.hidden += 1
        self.links += tag == "a"
        words = [w for n, v in attrs if v and n in ("class", "id", "role") for w in _WORD.findall(v.lower())]
        self.open.append((tag, ".".join([tag, *words]) if words else tag))
        self.label = None

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self._close(k)
                return
            if self.open[k][0] in _CONTAINERS and tag not in _CONTAINERS:
                return

    def _close(self, k: int) -> None:
        for name, _ in self.open[k:]:
            self.hidden -= name in HIDDEN_TAGS
            self.links -= name == "a"
        del self.open[k:]
        self.label = None

    def handle_data(self, data: str) -> None:
        if self.hidden:
            return
        if self.path is None and not data.isspace():
            if self.label is None:
                self.label = tuple(label for name, label in self.open if name in BLOCK_TAGS or "." in label)
            self.path = self.label
        if self.links:
            self.linked += len(data)
        self.texts.append(data)


def blocks_of(html: str | None) -> list[Block]:
    """All blocks with text of a page, in page order; none of a null or empty one. Broken markup is read as far as it goes."""
    if not html:
        return []
    cut = html.rfind("<")
    if cut >= 0 and html.find(">", cut) < 0 and re.match(r"[a-zA-Z/!?]", html[cut + 1:cut + 2]):
        html = html[:cut]  # the page ends inside a tag
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.blocks
