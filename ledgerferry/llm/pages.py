"""HTML extraction: gradient-boosted trees over DOM nodes, decoded along the hierarchy.

A page is read once into block nodes and the texts between block borders. Each block node has
features of its tag and attribute tokens, of its ancestors, of its subtree's density of text,
links and tags, of its depth and its siblings. Boosted trees give each node the odds that it
belongs to the article. On a path from the root, nodes lie first outside, then inside the article,
then in parts cut from it: the likeliest labelling under that order is found for the whole tree, so
no node is kept under an ancestor that was cut.

The trees are trained on generated pages whose nodes are labelled: articles among menus, notices,
adverts, forms, sidebars and comments, in an element that says so, in plain containers, in tables, under
names that mislead, or in the body itself, at most TRAIN_PAGES. Names are taken from a share of the pages,
so that the trees learn to do without; the page itself counts as inside if its text stands in no element.

Defined results: null or empty html gives an empty text; so does a page without a node inside;
rows are independent, so repeated rows repeat; an empty table gives no rows; a tag that the end of the
page cuts short is left out; a button, select, noscript, template, svg or iframe is left out if it is
closed, otherwise only its tag is; further columns are ignored.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerferry.llm.boosting import Boosted, fit
from ledgerferry.llm.common import slices, small_batches, tidy

TRAIN_PAGES, TREES = 1_200, 80
#: What it costs, in log-odds, to cut a part from an article: most of what an article holds belongs to it.
CUT_COST = 3.0
#: Share of the training pages whose attributes are not read, and bound of a node's summed odds of names.
NAMELESS, MOST_ODDS = 0.3, 6.0
#: Elements by how they are read (fixed values of the markup language).
BLOCKS = frozenset(
    "html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section summary table caption tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A new one ends an open one of the same group, within the nearest of the named elements.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "body": ({"head"}, {"html"}),
}
CLOSE_P = BLOCKS - {"html", "head", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"}
CONTROLS = frozenset("input button select label fieldset legend form".split())

#: The text of script, style, title and textarea is no markup, to the end of the page if it must be. The next
#: ones are left out only up to their own close tag, before another of the name opens; without one, what follows
#: is read like all markup, as it is inside math and object.
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|title|textarea)(?=[\s/>])[^>]*+>.*?(?:</\1(?=[\s/>])[^>]*+>|\Z)|<svg(?=[\s/])[^>]*+(?<=/)>"
    r"|<(noscript|template|select|button|svg|iframe)(?=[\s/>])[^>]*+>(?:[^<]++|<(?!/?\2[\s/>]))*+</\2(?=[\s/>])[^>]*+>"
    r"|<(/?)([a-z][a-z0-9:-]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-z][a-z0-9:-]*+)([^>]*+)>|<[!?][^>]*+>|<[a-z/!?][^>]*+\Z",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LABEL = re.compile(r"data-in=(\d)")
#: Marks a training page whose text in no element is inside.
ROOT_IN = "<!--in-->"


class Page:
    """Block nodes in page order (parents first), and the runs of text between block borders."""

    def __init__(self, html: str, labels: bool = False):
        self.tags, self.parents, self.tokens, self.at = ["#root"], [-1], [()], [0]
        self.labels = [int(labels and html.startswith(ROOT_IN))]
        self.runs: list[tuple[int, str, int]] = []  # node, text, characters in links
        self.controls, self.elements = Counter(), Counter()
        stack, names, opened = [0], ["#root"], Counter()
        text: list[str] = []
        linked = links = pos = 0

        def border() -> None:
            nonlocal linked
            if text:
                whole = "".join(text)
                if whole and not whole.isspace():
                    whole = " ".join((unescape(whole) if "&" in whole else whole).split())
                    if whole:
                        self.runs.append((stack[-1], whole, min(linked, len(whole))))
                text.clear()
            linked = 0

        def pop() -> None:
            opened[names.pop()] -= 1
            stack.pop()

        for m in MARKUP.finditer(html):
            start = m.start()
            if start > pos:
                text.append(html[pos:start])
                if links:
                    linked += start - pos
            pos = m.end()
            name = m[4] or m[7]
            if not name:
                if (m[1] or m[2] or "").lower() in ("button", "select", "textarea"):
                    self.controls[stack[-1]] += 1
                continue
            name = name.lower()
            closing = m[3] or m[6]
            if name not in BLOCKS:
                if name == "a":
                    links = 0 if closing else 1
                elif name == "br":
                    text.append(" ")
                if not closing:
                    self.elements[stack[-1]] += 1
                    if name in CONTROLS:
                        self.controls[stack[-1]] += 1
                continue
            border()
            links = 0
            if closing:
                if opened[name]:
                    while names[-1] != name:
                        pop()
                    pop()
                continue
            if opened["p"] and name in CLOSE_P:
                while names[-1] != "p":
                    pop()
                pop()
            if name in IMPLIED:
                ends, within = IMPLIED[name]
                if any(opened[e] for e in ends):
                    depth = len(names) - 1
                    while depth and names[depth] not in within and names[depth] not in ends:
                        depth -= 1
                    while names[depth] in ends:
                        del_to = depth
                        depth -= 1
                        while len(names) > del_to:
                            pop()
            if name in VOID:
                continue
            attributes = m[5] or m[8] or ""
            self.parents.append(stack[-1])
            self.tags.append(name)
            self.at.append(start)
            found = ()
            if "=" in attributes:
                found = tuple({t.lower() for _, v in ATTRIBUTE.findall(attributes) for t in TOKEN.findall(v)})
            self.tokens.append(found)
            if labels:
                label = LABEL.search(attributes)
                self.labels.append(int(label[1]) if label else -1)
            if name in CONTROLS:
                self.controls[len(self.tags) - 1] += 1
            stack.append(len(self.tags) - 1)
            names.append(name)
            opened[name] += 1
        if pos < len(html):
            text.append(html[pos:])
        border()
        self.size = max(1, len(html))


class Scores:
    """Log-odds of tags and attribute tokens, from labelled nodes."""

    def __init__(self, tags: dict[str, float], tokens: dict[str, float]):
        self.tags, self.tokens = tags, tokens

    @classmethod
    def learn(cls, pages: list[Page]) -> Scores:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for page in pages:
            for tag, tokens, label in zip(page.tags, page.tokens, page.labels, strict=True):
                seen[label].update([f"<{tag}", *tokens])
        odds = {k: math.log((seen[1][k] + 0.5) / (seen[0][k] + 0.5)) for k in {*seen[0], *seen[1]} if seen[0][k] + seen[1][k] >= 5}
        return cls({k[1:]: v for k, v in odds.items() if k[0] == "<"}, {k: v for k, v in odds.items() if k[0] != "<"})

    def of(self, tokens: tuple[str, ...]) -> float:
        """What the tokens say together; unknown ones say nothing."""
        return max(-MOST_ODDS, min(MOST_ODDS, sum(self.tokens.get(t, 0.0) for t in tokens)))


def features(pages: list[Page], scores: Scores) -> np.ndarray:
    """A row for each node of all pages."""
    count = [len(p.tags) for p in pages]
    base = np.repeat(np.cumsum([0, *count[:-1]]), count)
    n = int(sum(count))
    up = np.concatenate([np.array(p.parents) for p in pages])
    root = up < 0
    parent = np.where(root, np.arange(n), up + base)
    tag = np.fromiter((scores.tags.get(t, 0.0) for p in pages for t in p.tags), float, n)
    token = np.fromiter((scores.of(t) if t else 0.0 for p in pages for t in p.tokens), float, n)
    kind = np.unique([t for p in pages for t in p.tags], return_inverse=True)[1]
    place = np.concatenate([np.array(p.at) / p.size for p in pages])
    chars, links, marks, tags, controls = (np.zeros(n) for _ in range(5))
    first = 0
    for p, size in zip(pages, count, strict=True):
        for node, text, linked in p.runs:
            chars[first + node] += len(text)
            links[first + node] += linked
            marks[first + node] += text.count(",") + text.count(".")
        for node, k in p.elements.items():
            tags[first + node] += k
        for node, k in p.controls.items():
            controls[first + node] += k
        first += size
    tags += 1
    own = chars.copy()
    # Parents come first, so depth grows along rows of a page; sums go up level by level.
    depth, now = np.zeros(n, int), np.where(root, -1, parent)
    while (some := now >= 0).any():
        depth += some
        now = np.where(some, np.where(root[np.maximum(now, 0)], -1, parent[np.maximum(now, 0)]), -1)
    low, high = np.minimum(token, tag), np.maximum(token, tag)
    by_depth = np.argsort(depth, kind="stable")
    levels = np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1)
    worst, best = np.zeros(n), np.zeros(n)
    for level in levels[1:]:
        worst[level] = np.minimum(worst[parent[level]], low[parent[level]])
        best[level] = np.maximum(best[parent[level]], high[parent[level]])
    for level in reversed(levels[1:]):
        for values in (chars, links, marks, tags, controls):
            values += np.bincount(parent[level], values[level], n)
    children = np.bincount(parent[~root], minlength=n)
    # Siblings of one tag: how many, and their mean text; and the text of those on either side.
    family = np.unique(np.stack([parent, kind], 1), axis=0, return_inverse=True)[1].ravel()
    alike = np.bincount(family)[family]
    mean = np.bincount(family, chars)[family] / alike
    order = np.lexsort((np.arange(n), parent))
    beside = parent[order][1:] == parent[order][:-1]
    before, after, rank = np.zeros(n), np.zeros(n), np.zeros(n)
    before[order[1:]] = np.where(beside, chars[order[:-1]], 0)
    after[order[:-1]] = np.where(beside, chars[order[1:]], 0)
    start = np.concatenate([[0], np.where(beside, 0, np.arange(1, n))]) if n else np.zeros(0)
    rank[order] = np.arange(n) - np.maximum.accumulate(start)
    total = np.repeat([chars[i] for i in np.flatnonzero(root)], count)
    log = np.log1p
    return np.stack(
        [
            tag, token, tag[parent], token[parent], worst, best, depth, log(chars), log(own), links / (chars + 1), marks / (chars + 1), chars / tags, log(tags), log(children),
            controls, chars / (total + 1), log(mean), log(alike), log(before), log(after), rank / (children[parent] + 1), place, mean - chars,
        ],
        1,
    )


OUT, IN, CUT = range(3)


def decode(parents: list[int], odds: list[float]) -> list[bool]:
    """Which nodes lie inside, under the likeliest labelling that runs OUT, IN, CUT down each path."""
    n = len(parents)
    value = [[0.0, odds[i], 0.0] for i in range(n)]  # against all being outside
    for i in range(n - 1, 0, -1):
        out, inside, cut = value[i]
        up = value[parents[i]]
        up[OUT] += max(out, inside)
        up[IN] += max(inside, cut - CUT_COST)
        up[CUT] += cut
    state = [IN if n and value[0][IN] > value[0][OUT] else OUT] + [OUT] * (n - 1)
    for i in range(1, n):
        above, (out, inside, cut) = state[parents[i]], value[i]
        if above == OUT:
            state[i] = IN if inside > out else OUT
        elif above == IN:
            state[i] = IN if inside >= cut - CUT_COST else CUT
        else:
            state[i] = CUT
    return [s == IN for s in state]


class Model:
    def __init__(self, scores: Scores, trees: Boosted):
        self.scores, self.trees = scores, trees

    def extract(self, html: list[str]) -> list[list[str]]:
        """The blocks of each page's article."""
        pages = [Page(h) for h in html]
        odds = self.trees.log_odds(features(pages, self.scores)).tolist()
        out, first = [], 0
        for p in pages:
            inside = decode(p.parents, odds[first : first + len(p.tags)])
            first += len(p.tags)
            out.append([text for node, text, _ in p.runs if inside[node]])
        return out


def train(seed: int = 5, pages: int = TRAIN_PAGES) -> Model:
    rng = random.Random(seed)
    made = [Page(labelled_page(rng), labels=True) for _ in range(pages)]
    for page in made:
        for i, label in enumerate(page.labels):  # nodes without a mark are as their parents
            if label < 0:
                page.labels[i] = page.labels[page.parents[i]]
    scores = Scores.learn(made)
    for page in made:
        if rng.random() < NAMELESS:
            page.tokens = [()] * len(page.tokens)
    return Model(scores, fit(features(made, scores), np.array([y for p in made for y in p.labels], float), trees=TREES, depth=5))


def labelled_page(rng: random.Random) -> str:
    """A made page; data-in marks where the article begins (1) and what is cut from it or outside (0)."""
    pick, chance = rng.choice, rng.random

    def words(low: int, high: int) -> str:
        out = ["".join(pick("bcdfghklmnprstvw") + pick("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
        return " ".join(w + ("," if chance() < 0.06 else ". " if chance() < 0.08 else "") for w in out).capitalize() + pick([".", ".", "", "!"])

    def link(n: int = 3) -> str:
        return f'<a href="/{words(1, 1)}">{words(1, n)}</a>'

    def named(kinds: str) -> str:
        name = pick(kinds.split())
        if chance() < 0.3:
            name = pick(["js-", "c-", "page-", "site-", "l-"]) + name
        return f' {pick(["class", "class", "id"])}="{name}{pick(["", "", " wide", "-box", "-inner"])}"'

    def part(tag: str, kinds: str, body: str, chance_named: float = 0.8) -> str:
        return f"<{tag}{named(kinds) if chance() < chance_named else ''} data-in=0>{body}</{tag}>"

    def menu() -> str:
        items = "".join(f"<li>{link()}" + pick(["</li>", "</li>", ""]) for _ in range(rng.randint(3, 12)))
        inner = pick([f"<ul>{items}</ul>", " | ".join(link() for _ in range(rng.randint(3, 9)))])
        return pick([part("nav", "nav menu navbar breadcrumb toc", inner, 0.4), part("div", "nav menu navbar navigation breadcrumbs pagination tabs", inner, 1), part("ul", "menu nav links", items, 1)])

    def advert() -> str:
        body = pick([words(4, 25), link(6), f"<p>{words(5, 30)}</p>", f"{link(4)} {words(3, 10)}"])
        return part(pick(["div", "div", "aside", "section"]), "ad ads advert advertisement sponsored promo banner sponsor", body, 1)

    def notice() -> str:
        body = f"<p>{words(8, 30)}</p>" + pick(["", "<button>ok</button>", link()])
        return part(pick(["div", "div", "section", "aside"]), "cookie consent notice alert gdpr subscribe newsletter paywall popup modal notification", body, 1)

    def form() -> str:
        body = f'<label>{words(1, 3)}</label><input name="q"><button>{words(1, 2)}</button>' + pick(["", f"<p>{words(3, 12)}</p>"])
        return f"<form{named('search login subscribe contact signup') if chance() < 0.6 else ''} data-in=0>{body}</form>"

    def sidebar() -> str:
        body = "".join(pick([lambda: f"<h3>{words(1, 4)}</h3>", lambda: f"<p>{words(5, 40)}</p>", lambda: f"<ul><li>{link(6)}</li><li>{link(6)}</li></ul>"])() for _ in range(rng.randint(1, 5)))
        return pick([part("aside", "sidebar related widget", body, 0.5), part("div", "sidebar related widget recommended trending rail share social tags author bio", body, 1)])

    def comments() -> str:
        body = "".join(f'<{t}{named("comment reply")}><p>{words(4, 60)}</p></{t}>' for t in [pick(["div", "li", "article"])] for _ in range(rng.randint(1, 6)))
        return part(pick(["section", "div", "div", "ol"]), "comments discussion responses replies disqus comment", f"<h3>{words(1, 3)}</h3>" * (chance() < 0.5) + body, 1)

    def footer() -> str:
        body = pick([f"&copy; {words(1, 3)} &middot; {words(4, 14)}", f"<p>&copy; {words(3, 12)}</p>", f"<p>{words(5, 20)}</p>{link()} {link()}"])
        return pick([part("footer", "footer", body, 0.3), part("div", "footer copyright colophon legal", body, 1)])

    def header() -> str:
        return pick([part("header", "header masthead top", link() + pick(["", f"<p>{words(2, 8)}</p>"]), 0.5), part("div", "header masthead logo topbar", link(), 1)])

    def paragraph() -> str:
        text = words(*pick([(1, 4), (3, 15), (10, 60), (20, 120), (60, 250)]))
        mark = pick(["", "", "", "<b>", "<em>", "<span>"])
        return mark + text + (mark.replace("<", "</") if chance() < 0.6 else "") + pick(["", "", "", "<br>"])

    def block() -> str:
        k = chance()
        if k < 0.7:
            return f"<p>{paragraph()}" + ("</p>" if chance() < 0.85 else "")
        if k < 0.78:
            t = pick(["h2", "h2", "h3", "h4"])
            return f"<{t}>{words(1, 8)}</{t}>"
        if k < 0.86:
            t = pick(["ul", "ol"])
            return f"<{t}>" + "".join(f"<li>{words(2, 20)}" + pick(["</li>", ""]) for _ in range(rng.randint(2, 6))) + f"</{t}>"
        if k < 0.9:
            return f"<blockquote>{pick([words(5, 40), f'<p>{words(5, 40)}</p>'])}</blockquote>"
        if k < 0.93:
            return f"<div>{paragraph()}</div>"
        if k < 0.95:
            return f"<pre>{words(3, 20)}</pre>"
        if k < 0.97:
            return f'<figure><img src="a.png"><figcaption>{words(3, 12)}</figcaption></figure>'
        return "<table>" + "".join(f"<tr><td>{words(1, 3)}</td><td>{words(1, 3)}</td></tr>" for _ in range(rng.randint(2, 5))) + "</table>"

    blocks = [f"<h1>{paragraph() if chance() < 0.3 else words(1, 12)}</h1>"] * (chance() < 0.85) + [block() for _ in range(pick([rng.randint(1, 3), rng.randint(3, 10), rng.randint(8, 30)]))]
    quote = f"<aside{named('pullquote quote highlight callout') if chance() < 0.7 else ''} data-in=1>{pick([words(6, 30), f'<p>{words(6, 30)}</p>', f'<blockquote>{words(6, 30)}</blockquote>'])}</aside>"
    if chance() < 0.08:
        blocks.insert(rng.randint(1, len(blocks)), quote)
    for extra in (advert, notice, form, sidebar, menu):
        if chance() < 0.15:
            blocks.insert(rng.randint(1, len(blocks)), extra())
    body = "".join(blocks) + (comments() if chance() < 0.12 else "")
    article = pick(
        [f"<article data-in=1>{body}</article>"] * 5
        + [f"<main data-in=1>{body}</main>", f"<main><article data-in=1>{body}</article></main>", f'<div{named("content article post story entry main body text")} data-in=1>{body}</div>', f'<section{named("content article post story entry")} data-in=1>{body}</section>', f'<article{named("post article entry")} data-in=1>{body}</article>']
    )
    layout = chance()
    if layout < 0.09:  # one paragraph, or lines of text in no element
        only = pick([f"<p>{words(4, 120)}</p>", f"<p>{words(20, 200)}</p>", words(5, 150), f"{words(3, 60)}<br>{words(3, 60)}"])
        page = "<html data-in=0><head><title>t</title></head>{}</html>"
        frame = pick([ROOT_IN + "{}", "<body data-in=1>{}</body>", page.format("<body data-in=1>{}</body>"), page.format("<body data-in=0><div><div data-in=1>{}</div></div></body>")])
        return frame.format(only)
    soup = "post entry hentry news category tag ads sponsored social share related header footer nav menu sidebar comment form widget author bio food travel top left right wide"
    if layout < 0.15:
        article = f"<div><div data-in=1>{body}</div></div>"
    elif layout < 0.22:
        article = f'<{pick(["div", "div", "section", "article"])} class="{pick(["post", "entry", "content", "text", "x1", "css-1a2b", "story", "col"])} {" ".join(pick(["", "tag-", "category-", "has-", "no-", "format-"]) + pick(soup.split()) for _ in range(rng.randint(1, 4)))}" data-in=1>{body}</div>'
    elif layout < 0.27:
        cells = [f"<td data-in=1>{body}</td>", f"<td data-in=0>{pick([menu, sidebar, advert])()}</td>"]
        rng.shuffle(cells)
        article = f"<table><tr>{''.join(cells)}</tr></table>"
    elif layout < 0.4:
        article = body  # in the body itself, which then is inside
    inside = 1 if 0.27 <= layout < 0.4 else 0
    above = [header() for _ in range(chance() < 0.5)] + [menu() for _ in range(chance() < 0.85)] + [x() for x in (notice, advert, form) if chance() < 0.4]
    below = [x() for x in (sidebar, comments, advert, notice, form, menu) if chance() < 0.3] + [footer() for _ in range(chance() < 0.9)]
    rng.shuffle(above)
    side = sidebar() if chance() < (0.1 if inside else 0.25) else ""
    middle = pick([side + article, article + side])
    if chance() < 0.3 and not inside:
        middle = f'<div{pick(["", named("wrapper container page row layout")])}>{middle}</div>'
    if inside and chance() < 0.2:
        return f"{ROOT_IN}{''.join(above)}{middle}{''.join(below)}"
    return f"<!DOCTYPE html><html data-in=0><head><title>{words(2, 8)}</title><style>p{{}}</style></head><body data-in={inside}>{''.join(above)}{middle}{''.join(below)}" + pick(["</body></html>", "</body></html>", ""])


def extract(pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, blocks (the article's, in page order)."""
    held = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            blocks = held.value.extract([h or "" for h in batch.column(2).to_pylist()])
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(blocks, pa.list_(pa.string()))], ["page_id", "url", "blocks"])

    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return small_batches(rows).mapInArrow(tidy(run), f"page_id {kind}, url string, blocks array<string>")


def digest(extracted: DataFrame) -> DataFrame:
    text = F.array_join("blocks", "\n")
    return extracted.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"), F.size("blocks").alias("n_blocks"))
