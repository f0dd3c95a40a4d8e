"""Tag-path ratios against a plain version over tuples of names, and pages that once took more than linear time."""

import math
import random
import time
from html.parser import HTMLParser

import pytest

from ribolith.llm import html

VOTE = "Deep in the hills, where the river turns, an old mill stood; nobody, it was said, had ground corn there for years. "


class Plain(HTMLParser):
    """Text blocks with whole tuples as paths; well-formed pages only."""

    def __init__(self):
        super().__init__()
        self.open, self.rows, self.text, self.linked, self.link = [], [], "", 0, False

    def flush(self):
        if self.text.split():
            self.rows.append((tuple(self.open), " ".join(self.text.split()), self.linked))
        self.text, self.linked = "", 0

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.link = True
            return
        self.flush()
        self.open.append(".".join([tag, *(v for _, v in attrs)]))

    def handle_endtag(self, tag):
        if tag == "a":
            self.link = False
            return
        self.flush()
        self.open.pop()

    def handle_data(self, data):
        self.text += data
        self.linked += len(data.strip()) if self.link else 0


def plain_values(rows):
    """The value of each path, every sum taken anew over all rows; no roles."""
    def ratio(path, of):
        own = [of(r) for r in rows if r[0] == path]
        return sum(own) / len(own)

    def smooth(k, of):
        near = [(math.exp(-((k - j) ** 2) / 2), ratio(rows[j][0], of)) for j in range(len(rows)) if abs(j - k) <= html.RADIUS]
        return sum(w * x for w, x in near) / sum(w for w, _ in near)

    def marks(r):
        return sum(c in ".,;:!?" for c in r[1])

    out = {}
    for path in {r[0] for r in rows}:
        own = [k for k, r in enumerate(rows) if r[0] == path]
        fused = sum(smooth(k, lambda r: len(r[1])) * (smooth(k, marks) + 0.1) for k in own) / len(own)
        links = sum(rows[k][2] for k in own) / sum(len(rows[k][1]) for k in own)
        own_product = ratio(path, lambda r: len(r[1])) * (ratio(path, marks) + 0.1)
        out[path] = math.sqrt(own_product * fused) * (1 - links) ** 2
    return out


def plain_text(page):
    parser = Plain()
    parser.feed(page)
    parser.flush()
    rows = parser.rows
    value = plain_values(rows)
    size = {p: sum(len(r[1]) for r in rows if r[0] == p) for p in value}
    weight = sum(size[p] for p in value if value[p] > 0)
    if not weight:
        return value, ""
    bound = html.THRESHOLD * sum(value[p] * size[p] for p in value) / weight
    content = {p for p in value if value[p] > 0 and value[p] >= bound}
    tops = {p[:k] for p in content for k in range(len(p) + 1)}
    roots = {t for t in tops if t and t[-1].split(".")[0] in ("article", "main")}
    named = bool(roots)
    if not named:
        total = sum(size[p] for p in content)
        around = [t for t in tops if sum(size[p] for p in content if p[: len(t)] == t and p != t) >= 0.7 * total]
        roots = {max(around, key=len, default=())}
    few_links = {p for p in value if sum(r[2] for r in rows if r[0] == p) < 0.5 * size[p]}
    inside = {p for p in value if any(p[: len(t)] == t for t in roots)}
    kept = inside & (content | few_links) | (set() if named else content)
    return value, " ".join(r[1] for r in rows if r[0] in kept)


def made_page(rnd, depth=0):
    tag = rnd.choice(["div", "div", "section", "blockquote"] if depth else ["div", "article", "section"])
    name = rnd.choice(["", ' class="x1"', ' class="story"', ' class="lead two"'])
    parts = []
    for _ in range(rnd.randint(1, 4)):
        kind = rnd.random()
        if kind < 0.3 and depth < 4:
            parts.append(made_page(rnd, depth + 1))
        elif kind < 0.6:
            parts.append("<p>" + VOTE * rnd.randint(1, 3) + "</p>")
        elif kind < 0.8:
            parts.append("<ul>" + "".join(f"<li><a href=q>go {k}</a> {'x' * rnd.randint(0, 9)}</li>" for k in range(rnd.randint(1, 4))) + "</ul>")
        else:
            parts.append(f"<h2>Part {rnd.randint(1, 9)}</h2>")
    return f"<{tag}{name}>" + "".join(parts) + f"</{tag}>"


@pytest.mark.parametrize("seed", range(60))
def test_values_and_text_equal_the_plain_version(seed):
    rnd = random.Random(seed)
    page = "<html><body>" + "".join(made_page(rnd) for _ in range(3)) + "</body></html>"
    value, text = plain_text(page)
    made, _, _ = html.path_values(*html.nodes(page))
    assert sorted(made.values()) == pytest.approx(sorted(value.values()))
    assert html.main_text(page) == text


def test_the_threshold_decides():
    lead = "<div class=x>" + f"<p>{VOTE * 3}</p>" * 4 + "<h2>Later</h2>" + f"<p>{VOTE * 2}</p></div>"
    page = f"<body><div><span>Words by R. Ow</span></div>{lead}<div><i>All rights kept</i></div></body>"
    story = " ".join([" ".join((VOTE * 3).split())] * 4 + ["Later", " ".join((VOTE * 2).split())])
    assert html.main_text(page) == story
    assert html.main_text(page, threshold=0.0) == f"Words by R. Ow {story} All rights kept"


def test_content_beside_the_container_and_in_several_articles():
    lead, body = VOTE * 4, VOTE * 3
    page = f"<body><div class=lead><p>{lead}</p></div><div class=body>" + f"<p>{body}</p>" * 4 + "</div></body>"
    assert html.main_text(page) == " ".join(" ".join(x.split()) for x in [lead] + [body] * 4)
    page = f"<body><article class=one><p>{lead}</p></article><p>{body}</p><article class=two><p>{body}</p></article></body>"
    assert html.main_text(page) == " ".join(" ".join(x.split()) for x in (lead, body))


def test_names_of_furniture():
    story = "The Tags of War is a novel, and a long one."
    assert html.main_text(f'<div id="tags-of-war"><p>{story}</p></div>') == story
    assert html.main_text(f'<div class="ad-slot-3"><p>{story}</p></div>') == ""
    assert html.main_text(f'<div class="post has-sidebar"><p>{story}</p></div>') == story
    assert html.main_text(f"<article><p>{story}</p><ul><li><a href=x>more</a></li></ul></article>") == story
    assert html.main_text(f'<div title="class = nav"><p>{story}</p></div><p hidden>No, never.</p>') == story


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div>" * 20_000 + "deep" + "</div>" * 20_000, "deep"),
        ('<a "' * 250_000, ""),
        ('<a" ">' * 160_000 + "'end", None),
        ("<svg>x" * 200_000, "x" * 200_000),
        ("<!x" * 300_000, ""),
        ("<p><x><td>" + "<ul>" * 20_000 + "deep", "deep"),
        ("<x>" * 20_000 + "</y>" * 50_000 + "deep", "deep"),
        ("<div>x" * 20_000, " ".join("x" * 20_000)),
        (" word" * 200_000, " ".join(["word"] * 200_000)),
    ],
    ids=["nested", "quotes", "odd quotes", "svg", "declarations", "cells", "stray ends", "nested text", "long text"],
)
def test_linear_in_the_page(page, text):
    begun = time.process_time()
    got = html.main_text(page)
    assert text is None or got == text
    assert time.process_time() - begun < 10


def test_tables_without_rows_and_with_clashing_columns(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    assert html.report(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, None, "<p>a</p>", "own", 7), (1, None, "<p>a</p>", "own", 7), (None, "u", None, None, None), (3, "u", " ", "own", 1)]
    got = html.report(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["text"], r["n_chars"]) for r in got) == [("", 0), ("", 0), ("a", 1), ("a", 1)]
    kept = html.extract(spark.createDataFrame(rows, schema))
    assert sorted(kept.columns) == ["html", "n_chars", "page_id", "text", "url"] and kept.count() == 4
