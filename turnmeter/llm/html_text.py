"""Main text of web pages by composite text density.

Each node of a page has C characters, T tags, LC characters and LT tags in
links; its link-adjusted density is

    C / T * log_B(C / LC * T / LT),  B = ln(C / (C - LC) * LC + LCp / Cp * C + e)

with Cp and LCp those of the page and 1 in place of each zero (Sun, Song and
Liao, 2011). A node's sum adds up the densities of its children, runs of bare
text among them. The subtree of the largest sum holds the article. The least
density on the way from it to the body is the threshold: other parts are taken
if they, and all around them, reach it. If an ``article`` element encloses the
subtree, it is the article.

Menus, headers, footers, sidebars, notices, adverts, forms and reader comments
are taken out first, by element, or by the words of class, id and role. Words
that also name whole layouts do not take out what holds an ``article`` or
``main``, nor do words that only say what a block has (``has-sidebar``).

Defined cases: a null page counts as empty, and has an empty text; markup alone
gives an empty text; text outside any element is the body's; broken markup is
read as browsers read it; pages of any length and depth are read whole, in
linear time; repeated rows get equal texts. ``main_text`` is a column, so other
columns of the rows, whatever their names, are untouched.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .html_tree import Run, Tree, one_line

#: Elements that are no part of an article. A ``header`` inside an article is.
OUTSIDE = frozenset("nav footer aside form menu search".split())
#: Words of class, id or role that take a block out, whatever it holds.
NEVER = frozenset("nav navbar navigation menu breadcrumb breadcrumbs footer contentinfo comment comments disqus respond "
                  "replies related recommended recommendations advert adverts advertisement advertising".split())
#: Words that take a block out unless an article lies inside it.
LAYOUT = frozenset("header masthead sidebar aside complementary ad ads adbox banner promo sponsor sponsored cookie cookies "
                   "consent gdpr notice notices notification alert popup modal newsletter subscribe share sharing social "
                   "search login signup widget form".split())
#: The word after one of these says what a block has, not what it is.
HAS = frozenset("has have with without no not show hide is".split())

_WORD = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+(?![a-z])")


def _words(names: str) -> set[str]:
    words = []
    for name in names.split():
        previous = ""
        for word in map(str.lower, _WORD.findall(name)):
            if previous not in HAS:
                words.append(word)
            previous = word
    return set(words)


def _kept(tree: Tree) -> list[bool]:
    """Which nodes are not taken out, themselves or around them."""
    nodes = tree.nodes
    words = [_words(n.names) if n.names else () for n in nodes]
    holds = [False] * len(nodes)
    for i in range(len(nodes) - 1, 0, -1):
        frame = nodes[i].name in ("article", "main") and NEVER.isdisjoint(words[i])
        if frame or holds[i]:
            holds[nodes[i].parent] = True
    kept, inside = [True] * len(nodes), [False] * len(nodes)
    for i in range(1, len(nodes)):
        n = nodes[i]
        inside[i] = inside[n.parent] or n.name == "article"
        frame = n.name in ("article", "main")
        out = (n.name == "form" and not holds[i] or n.name != "form" and n.name in OUTSIDE
               or not NEVER.isdisjoint(words[i]) or not frame and not holds[i] and (
                   not inside[i] and n.name == "header" or not LAYOUT.isdisjoint(
                       words[i] - {"header", "form"} if inside[i] and words[i] else words[i])))
        kept[i] = kept[n.parent] and not out
    return kept


def density(chars: int, tags: int, link_chars: int, link_tags: int, page_chars: int, page_link_chars: int) -> float:
    """Link-adjusted characters per tag."""
    if not chars:
        return 0.0
    tags, linked = tags or 1, link_chars or 1
    base = math.log(chars / (chars - link_chars or 1) * linked + (page_link_chars or 1) / page_chars * chars + math.e)
    return chars / tags * math.log(max(1.0, chars / linked * tags / (link_tags or 1))) / math.log(base)


def _measure(tree: Tree, kept: list[bool]) -> tuple[list[float], list[float], dict[int, float], dict[int, str]]:
    """Densities and sums of the nodes, densities and texts of the runs (by identity)."""
    nodes = tree.nodes
    counts = [[0, 0, 0, 0] for _ in nodes]
    texts, of_runs = {}, {}
    for i in range(len(nodes) - 1, -1, -1):
        if not kept[i]:
            continue
        own = counts[i]
        for child in nodes[i].children:
            if isinstance(child, Run):
                texts[id(child)] = text = child.text()
                part = (len(text), child.tags, min(len(text), len(one_line(child.linked))), child.link_tags)
                of_runs[id(child)] = part
            elif kept[child]:
                part = counts[child]
                own[1] += 1
            else:
                continue
            for k in range(4):
                own[k] += part[k]
    page = counts[0][0], counts[0][2]
    densities = [density(*c, *page) for c in counts]
    run_densities = {k: density(*c, *page) for k, c in of_runs.items()}
    sums = [sum(run_densities[id(c)] if isinstance(c, Run) else densities[c] for c in n.children
                if isinstance(c, Run) or kept[c]) if kept[i] else 0.0 for i, n in enumerate(nodes)]
    return densities, sums, run_densities, texts


def _content(tree: Tree, kept: list[bool], densities, sums, run_densities) -> tuple[set[int], set[int]]:
    """Numbers of the nodes that are content as a whole, and identities of the runs that are so on their own."""
    nodes = tree.nodes
    best = list(range(len(nodes)))
    for i in range(len(nodes) - 1, 0, -1):
        up = nodes[i].parent
        if kept[i] and sums[best[i]] >= sums[best[up]] and sums[best[i]] > 0:  # equal: the inner, the earlier
            best[up] = best[i]
    path, article = [best[0]], None
    while path[-1]:
        path.append(nodes[path[-1]].parent)
    for i in path:
        if nodes[i].name == "article":
            article = i
    if article is not None:
        return {article}, set()
    least = min(densities[i] for i in path)
    whole, runs, todo = set(), set(), [0]
    while todo:
        i = todo.pop()
        if i in whole or densities[i] < least:
            continue
        whole.add(best[i])
        if best[i] == i:
            continue
        for child in nodes[i].children:
            if isinstance(child, Run):
                if run_densities[id(child)] >= least:
                    runs.add(id(child))
            elif kept[child]:
                todo.append(child)
    return whole, runs


def extract(page: str | None) -> str:
    """The article of ``page``: one line for each block."""
    tree = Tree(page or "")
    kept = _kept(tree)
    densities, sums, run_densities, texts = _measure(tree, kept)
    whole, runs = _content(tree, kept, densities, sums, run_densities)
    lines, todo = [], [(0, False)]
    while todo:
        item, taken = todo.pop()
        if isinstance(item, Run):
            if (taken or id(item) in runs) and texts[id(item)]:
                lines.append(texts[id(item)])
        elif kept[item]:
            taken = taken or item in whole
            todo.extend((child, taken) for child in reversed(tree.nodes[item].children))
    return "\n".join(lines)


def main_text(html: Column | str) -> Column:
    """The main text of each page in ``html``; empty if there is none."""
    @F.pandas_udf("string")
    def extracted(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            yield pd.Series([extract(page) for page in batch], dtype=object)
    return extracted(html)
