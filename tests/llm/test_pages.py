"""Page texts against the known layout of the test pages, and single rules."""

import html
import random
import re

import pytest

from shelfrank.llm.pages import extract_pages, nearest_pages, op9_page_text, page_blocks, shared_lines

SCHEMA = "page_id long, url string, html string"


def article(source):
    """Headings and paragraphs of the only article element of a test page."""
    found = re.search(r"<article>(.*?)(</article>|$)", source, re.S)
    if not found:
        return ""
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*(>|$)", " ", x)).split()) for x in re.split(r"</?p>|</?h1>", found[1])]
    return "\n\n".join(x for x in parts if x)


def test_query(spark, small):
    want = {r.page_id: article(r.html) for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    found = op9_page_text(spark, small).collect()
    assert {r.page_id: r.text for r in found} == want
    assert all(r.n_chars == len(r.text) for r in found)


def texts(source):
    return [t for t, _ in page_blocks(source)]


@pytest.mark.parametrize(
    ("source", "want"),
    [
        (None, []), ("", []), ("plain  &amp;\n text", ["plain & text"]), ("<p>a<br>b<p>c</p>d", ["a b", "c", "d"]),
        ("<nav>x</nav><p>a</p><footer>y</footer>", ["a"]), ("<script>var t='</p>';</script>a", ["a"]),
        ("<div class='site-header'>h</div><p>a</p><div id=sidebar>s<p>t</div>b", ["a", "b"]),
        ("<body class='has-sidebar'><p>a", ["a"]), ("<ul><li>a<li>b</ul>", ["a", "b"]),
        ("<article><p>a</p><section class='comments'><p>no</p></section><p>b</p></article><p>out</p>", ["a", "b"]),
        ("<table><tr><td>a<td>b</tr></table>", ["a b"]), ("a <!-- b --> c <foot", ["a c"]), ("1 < 2", ["1 < 2"]),
        ('<p title="a>b">c</p>', ["c"]), ("<style>p{}</style><title>t</title>", []),
        ("<span class='ad'>x</span>y", ["y"]), ("<article>", []),
        ("<div class=post><p>long text</p><p>of some</p><p>blocks</p></div><article>short</article>", ["long text", "of some", "blocks", "short"]),
        ("<h1>Head</h1><article><p>b</p></article>", ["Head", "b"]), ("<article><header><h1>t</h1></header><p>b</p></article>", ["t", "b"]),
        ("<header><h1>site</h1></header><article><p>b</p></article>", ["b"]),
    ],
)
def test_blocks(source, want):
    assert texts(source) == want


def test_longest_common_subsequence():
    def length(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    rng = random.Random(3)
    for _ in range(1000):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        places = shared_lines(a, b)
        rest = iter(b)
        assert len(places) == length(a, b) and all(a[i] in rest for i in places)


def test_template_lines_go_and_copies_stay(spark):
    def page(own):
        return f"<div>Welcome to the site</div><div>{own}</div><p>All rights reserved</p>"

    data = [
        (1, "http://h/a/1", page("x" * 90)), (2, "http://h/a/2", page("y" * 80)), (3, "http://h/b", page("z" * 70)),
        (4, "http://copy/1", page("same text " * 30)), (5, "http://copy/2", page("same text " * 30)),
        (6, "http://alone/", page("q")), (7, None, None), (7, None, None), (8, "http://h/a/1", page("x" * 90)),
    ]
    pages = spark.createDataFrame(data, SCHEMA).selectExpr("*", "'u' AS text", "1 AS key")
    got = {r.page_id: r.text for r in extract_pages(pages).collect()}
    assert got[2] == "y" * 80 and got[3] == "z" * 70 and got[7] == ""
    assert got[4] == got[5] == "Welcome to the site\n\n" + ("same text " * 30).strip() + "\n\nAll rights reserved"
    assert got[6].startswith("Welcome") and extract_pages(pages).count() == len(data)
    assert extract_pages(pages.limit(0)).count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_nearest_over_range_borders(spark, parts):
    rng = random.Random(1)
    data = [(i, rng.choice(["h", "h", "g"]), "/" + "/".join(rng.choice("abc") for _ in range(rng.randint(1, 4)))) for i in range(60)]
    prints = spark.createDataFrame(data, "key long, host string, path string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {r.key: r.other for r in nearest_pages(prints).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)

    def common(a, b):
        return next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))

    want, line = {}, sorted((h, p, k) for k, h, p in data)
    for i, (h, p, k) in enumerate(line):
        sides = [(-common(p, line[j][1]), n, line[j][2]) for n, j in enumerate((i - 1, i + 1)) if 0 <= j < len(line) and line[j][0] == h]
        want[k] = min(sides)[2]
    assert got == want


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<article class='post comments-open'><p>a</p></article>", ["a"]),
        ("<div class='content-area no-sidebar'><article><p>a</p></article></div>", ["a"]),
        ("<div class='post has-banner'><p>a</p></div>", ["a"]),
        ("<article><h1 class='article-header'>t</h1><p>a</p></article>", ["t", "a"]),
        ("<div data-id='menu' data-role='search' title='a class=ad'><p>a</p></div>", ["a"]),
        ("<div class='modal'><article><p>a</p></article></div><p>out</p>", ["a"]),
        ("<div class='promo'><p>a</p></div>", ["a"]),
        ("<article class='comments'><p>a</p><article class='comment'><p>no</p></article></article>", ["a"]),
        ("<div class='related'><p>no</p></div><p>a</p>", ["a"]),
    ],
)
def test_names_do_not_hide_the_article(source, want):
    assert texts(source) == want
