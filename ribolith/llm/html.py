"""Main text of web pages by tag-path ratios.

A page is read as a row of text nodes, each with its root-to-leaf path of block tags (and the class or id names on it). For
each path the text length and the punctuation are summed over its nodes; both sums give a ratio to the number of nodes.
The ratios of the node row are smoothed with a Gaussian window and fused by product, as are the path's own ratios. A path's
value is the geometric mean of its own product and the mean of its nodes' smoothed ones, so that a short line is not lifted
by long neighbours alone, times the square of its share of text outside links, times a factor for the roles on it: 0 under
elements and names that say nothing but page furniture, `DOUBT` for each name that has such a word among others. Paths whose value reaches
`THRESHOLD` of the text-weighted mean are content. Paths below it (headings, list items, short lines) are kept where they
stand inside the article and are not mostly links.

Paths are nodes of a tree, numbered in the order of their first use, so the work is linear in the page at any depth.
"""

from __future__ import annotations

import html as entities
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ribolith.llm.common import with_arrow

#: HTML elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noframes noembed xmp svg math object audio video canvas select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rt rp s samp small span "
    "strike strong sub sup time tt u var wbr nobr".split()
)
FURNITURE = frozenset("nav header footer aside form menu button dialog fieldset select option datalist legend address head".split())
#: Elements whose open tag ends an open paragraph, and lists of elements that end their own kind.
ENDS_P = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
ENDS_SAME = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"thead", "tbody"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
#: Words of class, id or role names that mark page furniture, and words that say nothing beside them.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox adslot sponsor sponsored promo promotion banner sidebar "
    "side widget menu nav navbar navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "comment comments disqus reply replies respond discussion footer header masthead topbar toolbar pagination pager "
    "search copyright legal disclaimer complementary contentinfo dialog skip toc outbrain taboola trending popular tags".split()
)
PLAIN = frozenset(
    "list item items box block container wrapper wrap section area inner outer content bar left right top bottom main primary "
    "secondary row col column cell group panel site page global slot unit links link icons buttons text title heading body "
    "js css is id mobile desktop fixed sticky small large wide first last new".split()
)
PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、·¿¡]")
#: Every start of markup; the rest of a tag, with quotes or, once a quote never closes, without; one attribute.
START = re.compile(r"<!--|<!\[CDATA\[|<[!?]|<(/?)([a-zA-Z][^\s/>]*+)")
REST = re.compile(r"((?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?")
WORDS = re.compile(r"[a-z]+")
LAYOUT = re.compile(r"\b(?:has|with|no|without)[-_]?[a-z]+|-less\b")  # names of pages that have or lack a part
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Width of the smoothing window in nodes to each side, and the share of the text-weighted mean that a path must reach.
RADIUS, THRESHOLD = 2, 0.25
#: Factor of a name that has a word of furniture among words of its own.
DOUBT = 0.2
_KERNEL = [math.exp(-(d * d) / 2.0) for d in range(-RADIUS, RADIUS + 1)]


def _name_factor(value: str) -> float:
    """1 for names without a word of furniture, 0 if a name has no word besides (`ad-slot`), `DOUBT` else (`tags-of-war`)."""
    factor = 1.0
    for name in LAYOUT.sub("", value).split():
        words = set(WORDS.findall(name))
        if MARKS & words:
            factor = 0.0 if words <= MARKS | PLAIN else min(factor, DOUBT)
    return factor


def nodes(page: str) -> tuple[list[tuple[int, str, int]], list[tuple[int, str, float]]]:
    """The text blocks of a page in order, (path, text, characters inside links), and the tree of paths.

    A path is its place in the tree, a list of (parent path, tag, factor of the roles on it); path 0 is the page itself.
    Equal names under equal paths are one path. Blocks of white space alone are none. Markup that never ends reaches to the
    end of the page; after a tag with an unclosed quote, quotes no longer protect a `>`.
    """
    rows, buffer = [], []
    tree, known = [(-1, "", 1.0)], {}
    stack, places = [], {}  # open elements as (path, tag); for each tag its places in the stack
    linked = in_link = 0
    unshut, quoted = set(), True

    def flush():
        nonlocal linked
        text = "".join(buffer)
        buffer.clear()
        if "&" in text:
            text = entities.unescape(text)
        if text := " ".join(text.split()):
            rows.append((stack[-1][0] if stack else 0, text, min(linked, len(text))))
        linked = 0

    def add(text):
        nonlocal linked
        buffer.append(text)
        if in_link:
            linked += len(text.strip())

    def innermost(names):
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    def close(names, until=()):
        k = innermost(names)
        if k > innermost(until):
            while len(stack) > k:
                places[stack.pop()[1]].pop()

    def factor(tag, attributes):
        """The factor of one element and the names that tell its path."""
        role, name = 1.0, tag
        if tag in FURNITURE and not (tag in ("header", "address") and (places.get("article") or places.get("main"))):
            role = 0.0
        for a in ATTRIBUTE.finditer(attributes):
            key, value = a[1].lower(), (a[2] or a[3] or a[4] or "").lower()
            if key == "hidden" or key == "style" and HIDDEN.search(value):
                role, name = 0.0, name + ".hidden"
            elif key in ("class", "id", "role") and tag not in ("html", "body"):
                name += "." + value
                if tag != "main":
                    role *= _name_factor(value)
        return role, name

    at, end = 0, len(page)
    while at < end:
        m = START.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            shut = {"<!--": "-->", "<![CDATA[": "]]>"}.get(m[0], ">")
            stop = page.find(shut, at)
            if shut == "]]>":
                add(page[at : stop if stop >= 0 else end])
            at = stop + len(shut) if stop >= 0 else end
            continue
        rest = REST.match(page, at) if quoted else None
        if rest:
            attributes, at = rest[1], rest.end()
        else:
            quoted, stop = False, page.find(">", at)
            attributes, at = page[at : stop if stop >= 0 else end], stop + 1 if stop >= 0 else end
        tag, closing = m[2].lower(), bool(m[1])
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            continue
        if tag in VOID:
            if tag == "br":
                buffer.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in RAW:
            if not closing and not attributes.endswith("/") and tag not in unshut:
                shut = re.compile(rf"</{re.escape(tag)}\b[^>]*+(?:>|\Z)", re.I).search(page, at)
                if not shut:
                    unshut.add(tag)
                at = shut.end() if shut else (end if tag in ("script", "style") else at)
            continue
        flush()
        if closing:
            in_link = 0 if tag in ENDS_P else in_link
            close((tag,))
            continue
        if tag in ENDS_P:
            close(("p",), ("td", "th", "li", "article", "section", "div", "body"))
        if tag in ENDS_SAME:
            close(*ENDS_SAME[tag])
        parent = stack[-1][0] if stack else 0
        role, name = factor(tag, attributes)
        path = known.setdefault((parent, name), len(tree))
        if path == len(tree):
            tree.append((parent, tag, tree[parent][2] * role))
        places.setdefault(tag, []).append(len(stack))
        stack.append((path, tag))
    flush()
    return rows, tree


def path_values(rows: list, tree: list) -> tuple[dict[int, float], dict[int, int], dict[int, int]]:
    """For each path that has text: its value, its characters and those of them inside links."""
    length, marks, links, count = {}, {}, {}, {}
    for path, text, linked in rows:
        length[path] = length.get(path, 0) + len(text)
        marks[path] = marks.get(path, 0) + len(PUNCTUATION.findall(text))
        links[path] = links.get(path, 0) + linked
        count[path] = count.get(path, 0) + 1
    smooth_text = _smooth([length[r[0]] / count[r[0]] for r in rows])
    smooth_mark = _smooth([marks[r[0]] / count[r[0]] for r in rows])
    value = dict.fromkeys(length, 0.0)
    for (path, _, _), t, p in zip(rows, smooth_text, smooth_mark):
        value[path] += t * (p + 0.1) / count[path]
    for path in value:
        own = length[path] / count[path] * (marks[path] / count[path] + 0.1)
        value[path] = math.sqrt(own * value[path]) * (1.0 - links[path] / length[path]) ** 2 * tree[path][2]
    return value, length, links


def main_text(page: str | None, threshold: float = THRESHOLD) -> str:
    """The main text of a page, its blocks joined by one space; empty for a null, empty or textless page.

    Where article or main elements hold content, the text comes from them alone; else content paths count wherever they
    stand, and the article is the deepest element with 0.7 of their text in elements inside it.
    """
    rows, tree = nodes(page) if page else ([], [])
    value, length, links = path_values(rows, tree)
    weight = sum(length[p] for p, v in value.items() if v > 0)
    if not weight:
        return ""
    bound = threshold * sum(v * length[p] for p, v in value.items()) / weight
    content = {p for p, v in value.items() if v > 0 and v >= bound}
    held = [0] * len(tree)  # content text below a path
    for p in range(len(tree) - 1, 0, -1):  # a parent comes before its children
        held[tree[p][0]] += held[p] + (length[p] if p in content else 0)
    roots = {p for p, (_, tag, _) in enumerate(tree) if tag in ("article", "main") and (held[p] or p in content)}
    named, inside, depth = bool(roots), [False] * len(tree), [0] * len(tree)
    for p in range(1, len(tree)):
        depth[p] = depth[tree[p][0]] + 1
    if not named:
        total = sum(length[p] for p in content)
        roots = {max((p for p, n in enumerate(held) if n >= 0.7 * total), key=depth.__getitem__, default=0)}
    for p, (parent, _, _) in enumerate(tree):
        inside[p] = p in roots or parent >= 0 and inside[parent]
    kept = {
        p for p, v in value.items()
        if tree[p][2] > 0 and (inside[p] and (p in content or links[p] < 0.5 * length[p]) or p in content and not named)
    }
    return " ".join(text for path, text, _ in rows if path in kept)


def _smooth(row: list[float]) -> list[float]:
    n, out = len(row), []
    for i in range(n):
        a, b = max(0, i - RADIUS), min(n, i + RADIUS + 1)
        kernel = _KERNEL[a - i + RADIUS : b - i + RADIUS]
        out.append(sum(map(float.__mul__, kernel, map(float, row[a:b]))) / sum(kernel))
    return out


def extract(df: DataFrame, html: str = "html", out: str = "text", keep_html: bool = True) -> DataFrame:
    """`df` with the main text of the whole `html`. A null or empty page has an empty text; rows are never dropped."""

    def run(column):
        import pyarrow as pa

        return pa.array([main_text(x) for x in column.to_pylist()], pa.string())

    return with_arrow(df, html, out, T.StringType(), run, keep_html)


def report(df: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points)."""
    return extract(df.select("page_id", "url", "html"), keep_html=False).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )
