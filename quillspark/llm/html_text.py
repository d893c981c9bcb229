"""Main text of web pages: boosted trees over DOM nodes, decoded from the root down.

A page is read into its tree of block elements; each run of text between two block boundaries is a leaf of
its own. Every node has features: the kind of its tag and of its attribute tokens, the same of its
ancestors, depth, text size, link and tag density of its subtree, punctuation, and its place and size among
its siblings. Boosted trees give the log-odds that a subtree holds article text. The decoding takes the
most likely labelling in which a node that holds article text has only ancestors that do, so a dropped
element never has kept descendants; text leaves that are kept make the result.

The trees are fitted here, on pages that `example_pages` makes from random templates with known answers; in
half of them neither tags nor names tell where the article stands, and elements that hold it may have names
of other parts ("has-sidebar", "comment-policy").

A null or empty page, and one without article text, gives an empty text. Unclosed, unknown and stray tags,
attributes with ">" in quotes and cut-off pages are read as far as they go; a comment or script that never
ends takes the rest of the page, and so does a last tag without its ">". Reading and judging take time
linear in a page's length; nesting beyond 512 levels is read as level 512, and no text of it is lost. Pages are mapped one by one: repeated rows, null ids and urls and other
columns do no harm, and an empty table gives an empty result.
"""

from __future__ import annotations

import html as html_module
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quillspark.llm import boosting
from quillspark.session import ship_package

#: What a "<" may begin: a tag, a comment, or a declaration.
OPEN = re.compile(r"<(?:(/?)([a-zA-Z][a-zA-Z0-9:-]*)|(!--)|[!?/])")
#: The rest of a tag; a quote counts after "=" only.
REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>""")
#: Elements whose content is no markup, and where each ends.
RAW = {x: re.compile(rf"</{x}(?![a-z0-9])[^>]*>?", re.I) for x in ("script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp")}
#: Elements with markup whose text is never shown as text.
HIDDEN = frozenset("select svg template object canvas audio video".split())
#: Elements deeper than this are read as part of the one at this depth, as browsers do.
DEEPEST = 512
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
ATTRIBUTES = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "html body head header footer nav aside main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th "
    "form fieldset blockquote pre figure figcaption address details summary button label dialog center menu option hr noscript".split()
) | HIDDEN
#: A start tag that ends an open element of these, up to the nearest container.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
CONTAINERS = frozenset("html body main article section div ul ol dl table nav aside header footer form blockquote td th li figure".split())

TAG_KINDS = {
    "nav": "nav menu", "header": "header", "footer": "footer address", "aside": "aside dialog", "form": "form fieldset button label option", "article": "article", "main": "main",
    "section": "section", "div": "div center", "p": "p", "heading": "h1 h2 h3 h4 h5 h6", "list": "ul ol dl", "item": "li dt dd", "table": "table tr td th thead tbody tfoot caption",
    "quote": "blockquote pre figure figcaption details summary", "page": "html body", "head": "head",
}
KINDS = list(TAG_KINDS)
KIND_OF = {tag: 1 << k for k, name in enumerate(KINDS) for tag in TAG_KINDS[name].split()}
#: Attribute tokens (whole, or parts between hyphens, underscores and capitals) of each role.
TOKEN_KINDS = {
    "ad": "ad ads adv advert advertisement adsense sponsor sponsored promo promotion banner",
    "menu": "menu nav navbar navigation breadcrumb breadcrumbs topbar toolbar pagination pager tabs",
    "comment": "comment comments commentlist reply replies respond disqus discussion",
    "side": "sidebar side aside widget related recommended recommendations popular trending more links tags share social",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login",
    "edge": "header masthead footer foot head site copyright legal colophon",
    "text": "content article post entry story body main text maincontent article-body post-body page-content prose",
}
ROLES = list(TOKEN_KINDS)
ROLE_OF = {word: 1 << k for k, name in enumerate(ROLES) for word in TOKEN_KINDS[name].split()}
SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
#: Characters of pages that are read before their nodes are judged together.
PORTION = 1_000_000
STOP = str.maketrans("", "", ".,;:!?")


@lru_cache(100_000)
def _roles(attributes: str) -> int:
    """Bits of the roles that names tell: those of names all of whose words tell one, then those of names with other words ("has-sidebar")."""
    flags = 0
    for value in ATTRIBUTES.findall(attributes):
        for name in value.strip("\"'").split():
            found = [ROLE_OF.get(word.lower(), 0) for word in SPLIT.split(name) if word]
            for role in found:
                flags |= role if all(found) else role << len(ROLES)
    return flags


class Forest:
    """The block nodes of many pages, in columns; leaves are runs of text."""

    def __init__(self) -> None:
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.kind: list[int] = []
        self.roles: list[int] = []
        self.tags: list[int] = []
        self.linked: list[int] = []
        self.text: list[str | None] = []
        self.page: list[int] = []
        self.above_kind: list[int] = []
        self.above_roles: list[int] = []

    def _add(self, parent: int, kind: int, roles: int, page: int, text: str | None = None) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.kind.append(kind)
        self.roles.append(roles)
        self.tags.append(0)
        self.linked.append(0)
        self.text.append(text)
        self.page.append(page)
        self.above_kind.append(self.above_kind[parent] | self.kind[parent] if parent >= 0 else 0)
        self.above_roles.append(self.above_roles[parent] | self.roles[parent] if parent >= 0 else 0)
        return len(self.parent) - 1

    def read(self, page: int, source: str) -> None:
        """Add one page, in time linear in its length."""
        root = self._add(-1, KIND_OF["html"], 0, page)
        stack: list[tuple[str, int, bool]] = [("", root, False)]  # (tag, its block node, whether it is hidden)
        open_tags: dict[str, int] = {}
        pieces: list[str] = []
        linked = links = at = 0
        quotes = True  # until a tag doesn't end by the rules of quotes

        def flush() -> None:
            nonlocal linked
            if pieces:
                text = " ".join("".join(pieces).split())
                if text:
                    node = stack[-1][1]
                    leaf = self._add(node, self.kind[node], self.roles[node], page, text)
                    self.linked[leaf] = min(linked, len(text))
                pieces.clear()
            linked = 0

        def take(raw: str) -> None:
            nonlocal linked
            if raw and not stack[-1][2]:
                piece = html_module.unescape(raw) if "&" in raw else raw
                pieces.append(piece)
                if links:
                    linked += len(piece.strip())

        def close(k: int) -> None:
            for tag, _, _ in stack[k:]:
                open_tags[tag] -= 1
            del stack[k:]

        while at < len(source):
            begin = source.find("<", at)
            if begin == len(source) - 1:  # so is a tag of which no more is left
                take(source[at:begin])
                break
            found = OPEN.match(source, begin) if begin >= 0 else None
            if not found:
                take(source[at:] if begin < 0 else source[at : begin + 1])
                at = len(source) if begin < 0 else begin + 1
                continue
            take(source[at:begin])
            closing, tag, comment = found.groups()
            if not tag:
                end = source.find("-->" if comment else ">", found.end())
                at = len(source) if end < 0 else end + (3 if comment else 1)
                continue
            ended = REST.match(source, found.end()) if quotes else None
            if ended:
                at = ended.end()
            else:
                quotes = False
                at = source.find(">", found.end()) + 1
                if not at:  # a tag that the end of the page cuts off is no text
                    break
            tag = tag.lower()
            self.tags[stack[-1][1]] += 1
            if closing:
                if tag == "a" and links:
                    links -= 1
                if tag in BLOCKS:
                    flush()
                    if open_tags.get(tag):
                        k = len(stack) - 1
                        while stack[k][0] != tag:
                            k -= 1
                        close(k)
            elif tag in RAW:
                last = RAW[tag].search(source, at)
                at = last.end() if last else len(source)
            elif tag == "br":
                take(" ")
            elif tag == "a":
                links += 1
            elif tag in BLOCKS:
                flush()
                links = 0
                if tag == "hr":
                    continue
                if stack[-1][0] == "p" or stack[-1][0] in HEADING and tag in HEADING:
                    close(len(stack) - 1)
                elif any(open_tags.get(x) for x in ENDS.get(tag, ())):
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] in ENDS[tag]:
                            close(k)
                            break
                        if stack[k][0] in CONTAINERS:
                            break
                if len(stack) <= DEEPEST:
                    attributes = source[found.end() : at - 1]
                    node = self._add(stack[-1][1], KIND_OF.get(tag, 0), _roles(attributes) if "=" in attributes else 0, page)
                    stack.append((tag, node, stack[-1][2] or tag in HIDDEN))
                    open_tags[tag] = open_tags.get(tag, 0) + 1
        flush()

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(features, parent, depth) of every node."""
        parent, depth = np.array(self.parent), np.array(self.depth)
        n = len(parent)
        leaf = np.array([t is not None for t in self.text])
        size = np.array([len(t) if t is not None else 0 for t in self.text], float)
        stops = np.array([len(t) - len(t.translate(STOP)) if t is not None else 0 for t in self.text], float)
        total = np.stack([size, np.array(self.linked, float), np.array(self.tags, float), stops, leaf.astype(float)], axis=1)
        kind, roles = np.array(self.kind), np.array(self.roles)
        above_kind, above_roles = np.array(self.above_kind), np.array(self.above_roles)
        for at in reversed(_levels(depth)[1:]):
            np.add.at(total, parent[at], total[at])
        real = parent >= 0
        up = np.where(real, parent, 0)
        page = np.array(self.page)
        first = np.searchsorted(page, page)  # a page's root comes first
        siblings = np.bincount(up[real], minlength=n)[up]
        rank = np.zeros(n)
        order = np.lexsort((np.arange(n), up))
        starts = np.searchsorted(up[order], up[order])
        rank[order] = np.arange(n) - starts
        log = np.log1p
        columns = [
            leaf, depth, log(total[:, 0]), total[:, 1] / np.maximum(total[:, 0], 1), total[:, 2] / np.maximum(total[:, 0], 1), total[:, 3] / np.maximum(total[:, 0], 1), log(total[:, 4]),
            total[:, 0] / np.maximum(total[first, 0], 1), total[:, 0] / np.maximum(total[up, 0], 1), log(siblings), rank / np.maximum(siblings, 1), log(total[up, 0] / np.maximum(siblings, 1)), total[up, 1] / np.maximum(total[up, 0], 1),
        ]
        for k in range(len(KINDS)):
            columns += [kind >> k & 1, above_kind >> k & 1]
        for k in range(2 * len(ROLES)):
            columns += [roles >> k & 1, above_roles >> k & 1]
        return np.stack(columns, axis=1).astype(np.float32), parent, depth


def _levels(depth: np.ndarray) -> list[np.ndarray]:
    """The nodes of each depth."""
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.cumsum(np.bincount(depth))[:-1]) if len(depth) else []


def decode(odds: np.ndarray, parent: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The most likely labels of which each kept node has a kept parent: best sums from the leaves up, choices from the root down."""
    levels = _levels(depth)
    drop, keep = -odds.astype(float), odds.astype(float)
    for at in reversed(levels[1:]):
        np.add.at(drop, parent[at], drop[at])
        np.add.at(keep, parent[at], np.maximum(keep[at], drop[at]))
    state = keep > drop
    for at in levels[1:]:
        state[at] &= state[parent[at]]
    return state


def example_pages(count: int, seed: int = 11) -> Iterator[tuple[str, list[str]]]:
    """(page, its article blocks) from random templates."""
    rng = random.Random(seed)
    syllables = ("ta", "ro", "en", "mi", "so", "la", "ver", "qui", "ne", "or")

    def pick(*choices: str) -> str:
        return choices[int(rng.random() * len(choices))]

    def words(low: int, high: int) -> str:
        out = ["".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(rng.randrange(low, high))]
        return " ".join(w + (pick(",", ".", ".") if rng.random() < 0.15 else "") for w in out).capitalize() + pick(".", ".", "")

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{i}">{words(1, 3)}</a></li>' for i in range(n))

    def junk(place: str) -> str:
        short, text = words(2, 9), words(5, 45)
        return {
            "menu": pick("<nav><ul>{l}</ul></nav>", '<div class="menu"><ul>{l}</ul></div>', '<ul id="main-nav">{l}</ul>', '<div class="breadcrumbs">{s}</div>'),
            "header": pick("<header><h1>{s}</h1><p>{s}</p></header>", '<div class="site-header"><h2>{s}</h2></div>', '<header class="masthead">{s}<nav><ul>{l}</ul></nav></header>'),
            "footer": pick("<footer>&copy; {t}</footer>", '<div id="footer"><p>{t}</p><ul>{l}</ul></div>', "<footer><p>{t}</p><p>{s}</p></footer>"),
            "side": pick("<aside><h3>{s}</h3><p>{t}</p></aside>", '<div class="sidebar"><div class="widget"><h4>{s}</h4><ul>{l}</ul></div></div>', '<div class="related"><h3>{s}</h3><ul>{l}</ul></div>', "<aside><ul>{l}</ul></aside>"),
            "notice": pick('<div class="cookie-notice"><p>{t}</p><button>{s}</button></div>', '<div class="notice">{t}</div>', '<div role="alert">{t}</div>', '<div id="newsletter-popup"><h3>{s}</h3><p>{t}</p></div>'),
            "ad": pick('<div class="ad">{t}</div>', '<div class="ad">{s}</div>', '<div id="ad-top" class="banner"><p>{t}</p></div>', '<section class="sponsored"><h3>{s}</h3><p>{t}</p></section>', '<p class="advert">{t}</p>'),
            "form": pick("<form><label>{s}</label><input><button>{s}</button></form>", '<form class="signup"><p>{t}</p><input></form>'),
            "comments": pick('<div id="comments"><h2>{s}</h2><div class="comment"><p>{t}</p></div><div class="comment"><p>{t}</p></div></div>', '<section class="comments"><h3>{s}</h3><ul><li class="comment">{t}</li><li class="comment">{t}</li></ul></section>', '<ol class="commentlist"><li>{t}</li><li><p>{t}</p></li></ol>'),
        }[place].format(s=short, t=text, l=links(rng.randrange(2, 9)))

    def paragraph(blocks: list[str]) -> str:
        kind = rng.random()
        text = words(1, 4) if rng.random() < 0.15 else words(3, 120)
        blocks.append(text)
        if plain == "div":
            return f"<div>{text}</div>"
        if plain == "line":
            blocks[-2:] = [" ".join(blocks[-2:])] if len(blocks) > 1 and lines[0] else blocks[-2:]
            lines[0] = True
            return f"<span>{text}</span><br><br>"
        lines[0] = False
        if kind < 0.1:
            return f"<p><b>{text}<br>"
        if kind < 0.15:
            return f"<p>{text}"
        if kind < 0.2:
            return f"<h{rng.randrange(2, 5)}>{text}</h2>"
        if kind < 0.25:
            blocks[-1:] = items = [words(1, 20) for _ in range(rng.randrange(1, 6))]
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        if kind < 0.3:
            return f"<blockquote><p>{text}</p></blockquote>"
        if kind < 0.36:
            return f"<p>{text[:20]}<a href='/x'>{text[20:40]}</a>{text[40:]}</p>"
        if kind < 0.4:
            return f"<div>{text}</div>"
        if kind < 0.42:
            return f"<noscript>{text}</noscript>"
        return f"<p>{text}</p>"

    def misleading() -> str:
        """A name with a word for what is no article, on an element that holds one: a layout, a subject or a setting."""
        role = pick("sidebar", "footer", "header", "nav", "menu", "ads", "ad", "comments", "comment", "banner", "notice", "widget", "share", "related", "cookie", "form", "breadcrumb")
        return pick(f"has-{role}", f"with-{role}", f"no-{role}", f"{role}-left", f"{role}-policy", f"{role}-open", f"{role}-story", f"page-{role}-layout", f"{role}-{words(1, 2).strip('.,').lower()}")

    def named(*kinds: str) -> str:
        """An attribute that tells nothing or something wrong, or none."""
        if rng.random() < 0.3:
            return f' {pick("class", "class", "id")}="{pick("", "", "wrap ", "page ")}{misleading()}"'
        word = pick("col", "layout", "page", "wrap", "row", "inner", "c1", "left", "center", "container", "x-main2", "box", words(1, 2).strip(".,").lower())
        return pick(*kinds, "", f' class="{word}"', f' id="{word}"', f' class="{word} {word}-{rng.randrange(9)}"')

    def container() -> tuple[str, str]:
        """Where an article stands: half of them say so, the others are any element."""
        told = [("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ('<main><article class="post">', "</article></main>"), ('<div class="content">', "</div>"), ('<div id="main-content"><div class="entry">', "</div></div>"), ('<div class="article-body">', "</div>")]
        if rng.random() < 0.5:
            return told[rng.randrange(len(told))]
        tags = [pick("div", "div", "section", "td", "center", "div") for _ in range(rng.randrange(0, 4))]
        tags = [y for x in tags for y in (("table", "tr", "td") if x == "td" else (x,))]
        return "".join(f"<{t}{named()}>" for t in tags), "".join(f"</{t}>" for t in reversed(tags))

    for _ in range(count):
        blocks: list[str] = []
        inside = ""
        plain = pick("div", "line") if rng.random() < 0.12 else ""
        lines = [False]
        if rng.random() < 0.9:
            blocks.append(words(2, 12))
            inside = f"<h1>{blocks[0]}</h1>"
        for _ in range(rng.randrange(0 if inside else 1, 14)):
            if rng.random() < 0.05:
                inside += junk(pick("ad", "side", "form", "notice"))
                lines[0] = False
            if rng.random() < 0.1 and not plain:
                part = pick("div", "section")
                inside += f"<{part}{named()}>" + "".join(paragraph(blocks) for _ in range(rng.randrange(1, 4))) + f"</{part}>"
            else:
                inside += paragraph(blocks)
        opened, closed = container()
        before = [junk(x) for x in ("header", "menu", "notice", "ad", "side", "form") if rng.random() < (0.7 if x in ("menu", "ad") else 0.35)]
        after = [junk(x) for x in ("ad", "comments", "side", "form", "notice", "footer") if rng.random() < (0.7 if x == "footer" else 0.35)]
        around = [named() for _ in range(rng.randrange(0, 3))] if rng.random() < 0.5 else []
        whole = "".join(f"<div{x}>" for x in around) + "".join(before) + opened + inside + closed + "".join(after) + "</div>" * len(around)
        tail = "</body></html>" if rng.random() < 0.8 else ""
        yield f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title></head><body{named() if rng.random() < 0.5 else ''}>{whole}{tail}", [" ".join(b.split()) for b in blocks]


@lru_cache
def model(pages: int = 700) -> boosting.Trees:
    """The trees, fitted once in a process."""
    forest, answers = Forest(), []
    for k, (source, blocks) in enumerate(example_pages(pages)):
        begin = len(forest.parent)
        forest.read(k, source)
        left: dict[str, int] = {}
        for b in blocks:
            left[b] = left.get(b, 0) + 1
        answers += [left.get(t, 0) > 0 if t is not None else False for t in forest.text[begin:]]
    x, parent, depth = forest.features()
    y = np.array(answers)
    for d in range(int(depth.max()), 0, -1):  # an element that holds article text is labelled so
        at = np.flatnonzero((depth == d) & y)
        y[parent[at]] = True
    return boosting.fit(x, y.astype(float))


def main_texts(sources: list[str | None], trees: boosting.Trees) -> list[str]:
    """The main text of each page: its kept blocks in page order, joined by two line ends."""
    forest = Forest()
    for k, source in enumerate(sources):
        forest.read(k, source or "")
    out: list[list[str]] = [[] for _ in sources]
    if sources:
        x, parent, depth = forest.features()
        state = decode(trees.log_odds(x), parent, depth)
        for node in np.flatnonzero(state & np.array([t is not None for t in forest.text])).tolist():
            out[forest.page[node]].append(forest.text[node])
    return ["\n\n".join(b) for b in out]


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row. No shuffle."""
    ship_package(pages.sparkSession)
    trees = model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            some: list[str] = []
            size = 0
            for source in batch.column(2):
                some.append(source.as_py() or "")
                size += len(some[-1])
                if size >= PORTION:
                    texts += main_texts(some, trees)
                    some, size = [], 0
            texts += main_texts(some, trees)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
