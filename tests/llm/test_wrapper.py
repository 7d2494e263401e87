"""Wrapper induction: matching against brute force, and pages whose text only the wrapper can tell."""

import itertools
import random
import time

import pytest

from shopmart.llm import wrapper as wr

STORY = "<p>It began with a long walk along the river and ended {0}.</p><p>Nobody knew why {0} came so late, but {0} did.</p>"


def random_tree(draw, depth=3):
    kids = [random_tree(draw, depth - 1) for _ in range(draw.randrange(4))] if depth else []
    return wr.Slot(draw.choice("ab"), kids)


def brute_force(left, right):
    """Size of the largest match by trying all ways to pair kids in order."""
    if left.label != right.label:
        return 0
    best = 0
    for size in range(min(len(left.kids), len(right.kids)) + 1):
        for a in itertools.combinations(left.kids, size):
            for b in itertools.combinations(right.kids, size):
                best = max(best, sum(brute_force(x, y) for x, y in zip(a, b)))
    return 1 + best


@pytest.mark.parametrize("cells", [wr.CELLS, 0])
def test_matching_equals_brute_force(cells):
    """Exact within the bound; beyond it a match that keeps labels, order and nesting, and no larger one."""
    draw = random.Random(4)
    for _ in range(300):
        left, right = random_tree(draw), random_tree(draw)
        left.label = right.label = "r"
        matcher = wr.Matcher(cells)
        size, _ = matcher.match(left, right)
        assert size == brute_force(left, right) if cells else size <= brute_force(left, right)
        waiting, counted = [(left, right)], 0
        while waiting:
            a, b = waiting.pop()
            counted += 1
            pairs = matcher.match(a, b)[1]
            places = [(a.kids.index(x), b.kids.index(y)) for x, y in pairs]
            assert all(x.label == y.label for x, y in pairs)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in itertools.pairwise(places))
            waiting.extend(pairs)
        assert counted == size


def test_merge_keeps_every_node():
    draw = random.Random(8)

    def labels(slot):
        return [slot.label, *(label for kid in slot.kids for label in labels(kid))]

    for _ in range(200):
        left, right = random_tree(draw), random_tree(draw)
        left.label = right.label = "r"
        size = wr.Matcher().match(left, right)[0]
        both = wr.merge(left, right)
        assert len(labels(both)) == len(labels(left)) + len(labels(right)) - size
        assert both.pages == 2
        assert wr.unpacked(wr.packed(both)).shape == both.shape


def shop_page(number, layout="a"):
    """No article, no telling names: only the other pages tell what is template."""
    story = STORY.format(f"guest {number}")
    if layout == "a":
        return (
            "<body><div class='x1'><p>Welcome to our town paper, read by many since 1901</p><div>Call us at the office</div></div>"
            f"<div class='x2'><h1>Day {number}</h1>{story}<p>Read on in our next number</p></div>"
            "<div class='x3'><p>All words in this paper belong to the paper and nobody else at all</p></div></body>"
        )
    return (
        f"<body><table><tr><td class='y1'>Old pages of the paper</td><td class='y2'><h1>Night {number}</h1>{story}"
        "<span>Told by the same old man</span></td></tr></table><div class='y3'>Write to the editor today</div></body>"
    )


def shop_text(number, layout="a"):
    story = wr.text_of(wr.parse(STORY.format(f"guest {number}")))
    return f"{'Day' if layout == 'a' else 'Night'} {number} {story}"


@pytest.mark.parametrize("layouts, limit", [("a", 1 << 20), ("b", 1 << 20), ("ab", -1)])
def test_wrapper_alone_finds_the_text(spark, monkeypatch, layouts, limit):
    """Every layout of a host is learned from all its pages, by the local form and by Spark, with and without broadcast."""
    monkeypatch.setattr(wr, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(wr, "PART_PAGES", 5)
    monkeypatch.setattr(wr, "FAN", 2)
    pages = [(i, layouts[i % len(layouts)]) for i in range(24)]
    found = wr.induce([shop_page(*page) for page in pages])
    assert [wr.extract(shop_page(*page), found) for page in pages] == [shop_text(*page) for page in pages]
    rows = [(i, "http://paper.example/p", shop_page(i, kind), "h", "t", "w") for i, kind in pages]
    rows += [(900, None, None, "h", "t", "w"), (901, "http://paper.example/p", "", "h", "t", "w")]
    schema = "page_id long, url string, html string, host string, tree string, wrapper string"
    texts = {row["id"]: row["text"] for row in wr.main_texts(spark.createDataFrame(rows, schema)).collect()}
    assert texts == {i: shop_text(i, kind) for i, kind in pages} | {900: "", 901: ""}


def test_plain_text_would_keep_the_template():
    assert "Welcome" in wr.extract(shop_page(1), None) and "Welcome" not in shop_text(1)


def test_copies_are_no_evidence():
    """Pages with own titles and one story: the story is content, however many copies there are."""
    story = STORY.format("the guest")
    pages = [f"<body><div><h1>Title {n}</h1>{story}</div></body>" for n in range(40)]
    found = wr.induce(pages)
    for number, page in enumerate(pages):
        assert wr.extract(page, found) == f"Title {number} " + wr.text_of(wr.parse(story))
    # Four copies among pages of other content: neither the story nor its place is taken for template.
    mixed = [shop_page(n) for n in range(30)] + [shop_page(99)] * 4
    assert wr.extract(shop_page(99), wr.induce(mixed)) == shop_text(99)


@pytest.mark.parametrize(
    "region, named",
    [
        ('div class="site has-sidebar"', False),
        ('div class="post social-policy"', False),
        ('div class="widget-review"', False),
        ('div id="shared"', False),
        ('div class="cookie-banner"', True),
        ('div class="x sidebar"', True),
        ('div id="site-footer"', True),
        ('div id="comments"', True),
        ('div role="navigation"', True),
        ("nav", True),
    ],
)
def test_names_of_regions(region, named):
    tag = region.split()[0]
    page = f"<body><{region}>some words</{tag}><div>{STORY}</div></body>"
    assert ("some words" in wr.extract(page, None)) != named


def test_a_name_does_not_take_most_of_the_page():
    page = f'<body><div class="comments"><h1>Title</h1>{STORY}</div><p>short</p></body>'
    assert "long walk" in wr.extract(page, None)
    beside = f'<body><article>The story itself.</article><div class="comments">{STORY * 5}</div></body>'
    assert wr.extract(beside, None) == "The story itself."


def test_long_pages_take_time_in_proportion():
    def page(number, paragraphs):
        parts = (f"<p>line {i} of {number} <b>x</b></p>" + "<h2>part</h2>" * (i % 3 == number % 3) for i in range(paragraphs))
        return f"<body><div>{''.join(parts)}</div></body>"

    start = time.perf_counter()
    found = wr.induce([page(n, 2000) for n in range(3)])
    text = wr.extract(page(9, 4000), found)
    assert time.perf_counter() - start < 5
    assert text.count("line") == 4000


@pytest.mark.parametrize(
    "html",
    [
        "<a b " * 40_000 + '"',
        '<a ">"' * 30_000,
        "<b>" * 40_000 + "<div></div>" * 40_000,
        "<i><div>" + "<b>" * 40_000 + "</i>" * 40_000,
        "<div>" * 40_000 + "</p>" * 40_000,
        "<!-- -- " * 40_000,
        "<a '" * 40_000 + ">",
        "<p>" * 40_000 + "<li>" * 40_000,
    ],
)
def test_broken_markup_is_read_in_one_pass(html):
    start = time.perf_counter()
    wr.extract(html, None)
    assert time.perf_counter() - start < 3


def test_odd_markup():
    page = '<body><p title="a > b">one</p><p>two<!-- hidden --!> three<p>4 < 5 & "6"</p><script>x("</p>")</script><P>&eacute;</body>'
    assert wr.extract(page, None) == 'one two three 4 < 5 & "6" é'


def test_pages_of_the_tables_without_their_names(spark):
    """The largest host with neutral tags only: the wrapper finds nearly all texts, and without it none comes out right."""
    from pyspark.sql import functions as F

    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    largest = pages.groupBy(wr.host_of(F.col("url")).alias("host")).count().orderBy(F.desc("count")).first()["host"]
    pages = pages.filter(wr.host_of(F.col("url")) == largest)
    html = F.regexp_replace(F.regexp_replace("html", "(article|nav|footer)>", "div>"), 'class="ad"', 'class="q"')
    named = {row["id"]: row["text"] for row in wr.main_texts(pages).collect()}
    unnamed = {row["id"]: row["text"] for row in wr.main_texts(pages.withColumn("html", html)).collect()}
    assert sum(unnamed[key] == named[key] for key in named) >= 0.9 * len(named) > 200
    plain = {row["page_id"]: wr.extract(row["html"], None) for row in pages.withColumn("html", html).collect()}
    assert not any(plain[key] == named[key] for key in named)
