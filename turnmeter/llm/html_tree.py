"""A small tolerant reader from HTML to a tree of boxes, in time linear in the page.

Only what text extraction needs: which elements enclose which text. Block
elements (and anything that is not known to be inline) become nodes; inline
elements stay inside the run of text they stand in and are counted there as
tags. Elements that never hold readable text (scripts, styles, form controls,
embedded objects) are skipped with all they contain. Tags that authors leave
out are closed as browsers do: a block ends an open paragraph, an item its
neighbour, a cell its neighbour. Unfinished comments and scripts reach to the
end; a tag without its ``>`` is no text.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var".split())
#: Their content is no markup.
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
HIDDEN = frozenset("noscript template svg canvas object audio video map select button label fieldset datalist output "
                   "progress meter dialog".split())
#: Elements that end an open paragraph.
BLOCK = frozenset("address article aside blockquote center dd details dir div dl dt figcaption figure footer form h1 h2 h3 "
                  "h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table tbody td tfoot "
                  "th thead tr ul".split())
#: Start tags of the page's frame: its one node is there from the beginning.
FRAME = frozenset(["html", "head", "body"])
#: A start tag closes the nearest open element of the first kind, unless one of the second lies between.
_ROWS = frozenset(["tbody", "thead", "tfoot"])
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    **{name: (_ROWS, frozenset(["table"])) for name in _ROWS},
}
#: End tags do not reach through these.
WALLS = frozenset(["table", "td", "th"])

_PARAGRAPH = frozenset(["p"])
_NOT_PARAGRAPH = BLOCK - _PARAGRAPH
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+{_VALUE})?+)*+)>")
_NAMES = re.compile(r"""(?:^|(?<=[\s/"']))(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


@dataclass(slots=True)
class Run:
    """The text between two block borders: its pieces, and how many of its characters and tags belong to links."""
    parent: int
    pieces: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    tags: int = 0
    link_tags: int = 0

    def text(self) -> str:
        return one_line(self.pieces)


@dataclass(slots=True)
class Node:
    """A block element: its name, its class, id and role, its parent, its children (numbers of nodes, or runs)."""
    name: str
    names: str
    parent: int
    children: list[int | Run] = field(default_factory=list)


def one_line(pieces: list[str]) -> str:
    return " ".join("".join(pieces).split())


class Tree:
    """The nodes of a page, parents before children; node 0 is the page."""

    def __init__(self, page: str):
        self.nodes: list[Node] = [Node("body", "", -1)]
        self._open: list[tuple[str, int]] = [("body", 0)]  # open elements, each with the node that holds what follows
        self._depth: dict[str, int] = {}                   # how many of each name are open
        self._hidden = 0                                   # how many of the open ones hide their text
        self._run: Run | None = None
        self._read(page)

    def _read(self, page: str) -> None:
        at, size = 0, len(page)
        while at < size:
            lt = page.find("<", at)
            if lt < 0:
                self._text(page[at:])
                return
            if lt > at:
                self._text(page[at:lt])
            after = page[lt + 1:lt + 3]
            tag = _TAG.match(page, lt)
            if tag:
                at, name = tag.end(), tag[2].lower()
                if tag[1]:
                    self._end(name)
                elif name in RAW:
                    end = _RAW_ENDS[name].search(page, at)
                    if end is None:
                        return
                    at = page.find(">", end.end()) + 1 or size
                else:
                    self._start(name, tag[3])
            elif after[:1] in ("!", "?") or after[:1] == "/" and not _letter(after[1:]):
                comment = page.startswith("<!--", lt)
                end = page.find("-->" if comment else ">", lt + (4 if comment else 1))
                if end < 0:
                    return
                at = end + (3 if comment else 1)
            elif _letter(after.removeprefix("/")[:1]):
                return  # a tag without an end
            else:
                self._text("<")
                at = lt + 1

    def _text(self, raw: str) -> None:
        if self._hidden:
            return
        if self._run is None:
            if raw.isspace():
                return
            self._run = self._new_run()
        text = html.unescape(raw)
        self._run.pieces.append(text)
        if self._depth.get("a"):
            self._run.linked.append(text)

    def _new_run(self) -> Run:
        linked = 1 if self._depth.get("a") else 0
        run = Run(self._open[-1][1], tags=linked, link_tags=linked)
        self.nodes[run.parent].children.append(run)
        return run

    def _push(self, name: str, node: int) -> None:
        self._open.append((name, node))
        self._depth[name] = self._depth.get(name, 0) + 1
        self._hidden += name in HIDDEN

    def _close(self, names, walls) -> None:
        """End the nearest open element named in ``names`` and all inside it, unless a wall stands before it."""
        if not any(map(self._depth.get, names)):
            return
        for i in range(len(self._open) - 1, 0, -1):
            name = self._open[i][0]
            if name in names:
                while len(self._open) > i:
                    name = self._open.pop()[0]
                    self._depth[name] -= 1
                    self._hidden -= name in HIDDEN
                return
            if name in walls:
                return

    def _start(self, name: str, attributes: str) -> None:
        if name in FRAME:
            if name == "body" and self._hidden:
                self._close(HIDDEN, ())
            return
        if name in VOID and name != "hr":
            if name == "br" and self._run is not None and not self._hidden:
                self._run.pieces.append(" ")
                self._run.tags += 1
            return
        if self._hidden or name in HIDDEN:
            if not attributes.endswith("/"):
                self._push(name, self._open[-1][1])
            return
        if name in INLINE:
            if name == "a":
                self._close(("a",), BLOCK)
            if self._run is None:
                self._run = self._new_run()
            self._run.tags += 1
            self._run.link_tags += name == "a"
            self._push(name, self._open[-1][1])
            return
        self._run = None
        if name in BLOCK:
            self._close(_PARAGRAPH, _NOT_PARAGRAPH)
        if name in CLOSES:
            self._close(*CLOSES[name])
        if name == "hr":
            return
        parent, i = self._open[-1][1], len(self.nodes)
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)) if attributes else ""
        self.nodes.append(Node(name, names, parent))
        self.nodes[parent].children.append(i)
        self._push(name, i)

    def _end(self, name: str) -> None:
        if name in FRAME:
            return
        if name in INLINE:
            self._close((name,), BLOCK)
        elif name in HIDDEN:
            self._close((name,), ())
        else:
            hidden = self._hidden
            self._close((name,), WALLS - {name})
            if not hidden or not self._hidden:  # ends of what is hidden are no border of blocks
                self._run = None


def _letter(c: str) -> bool:
    return c.isascii() and c.isalpha()
