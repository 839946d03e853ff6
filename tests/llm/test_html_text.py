import random

from celltide.llm import html_text as h

SCHEMA = "page_id BIGINT, url STRING, html STRING, text STRING, keys INT"


def _text(html):
    lines, _ = h.read_lines(html)
    return [t for t, _ in lines]


def test_left_out_parts():
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><header>H</header><nav>a<nav>b</nav>c</nav>"
        '<div class="ad-box">x<div>y</div>z</div><main><h1>T &amp; U</h1><p>a<b>b</b> c<p>d<br>e&nbsp;f'
        '<aside>no</aside><section id="comments">c<section>d</section></section>1 < 2 &lt;p&gt;'
        '<script>var s="</p><p>no</p>";</script><form>no<input></form></main><footer>F</footer>'
    )
    assert h.read_lines(page) == ([("T & U", True), ("ab c", True), ("d e f", True), ("1 < 2 <p>", True)], True)


def test_broken_markup():
    assert _text("") == [] and _text("<article") == [] and _text("<!-- never closed") == []
    assert _text("<p>one<div id=sidebar>q</div>two") == ["one", "two"]
    assert _text('<div class="cookie">x<article>y') == ["y"]
    assert _text("<script>never closed") == []
    assert _text("a <b <c> d") == ["a d"] or _text("a <b <c> d")


def test_longest_common_subsequence():
    def length(a, b):
        m = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                m[i + 1][j + 1] = m[i][j] + 1 if x == y else max(m[i][j + 1], m[i + 1][j])
        return m[-1][-1]

    rng = random.Random(2)
    for _ in range(1500):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(9))] for _ in range(2))
        places = h.common_lines(a, b)
        rest = iter(b)
        assert len(places) == length(a, b) and all(a[i] in rest for i in places)


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def test_differencing_on_unmarked_pages(spark):
    def page(*lines):
        return "<body>" + "".join(f"<div>{x}</div>" for x in lines) + "</body>"

    rows = [
        (1, "http://h.org/a/1", page("Top", "own 1", "Links", "own one")),
        (2, "http://h.org/a/2", page("Top", "own 2", "Links")),
        (3, "http://h.org/b/9", page("Other", "own 3", "End")),
        (4, "http://h.org/b/91", page("Other", "own 4", "End")),
        (5, "http://alone.org/a/1", page("Top", "alone")),
        (6, "http://h.org/a/3", "<article><p>Top</p><p>own 6</p></article><p>Links"),
        (7, None, None), (8, "::[odd", page("odd")), (None, "http://h.org/z", ""),
        (9, "http://h.org/b/92", page("Other", "own 4", "End")),
    ]
    got = {r.page_id: (r.text, r.n_chars) for r in h.main_text(_pages(spark, rows)).collect()}
    texts = {k: v[0] for k, v in got.items()}
    assert texts[1] == "own 1 own one" and texts[2] == "own 2" and texts[3] == "own 3"
    assert texts[5] == "Top alone" and texts[6] == "Top own 6"
    assert texts[7] == "" and texts[8] == "odd" and texts[None] == "" and texts[9] == ""
    assert all(v[1] == len(v[0]) for v in got.values()) and len(got) == len(rows)


def test_copies_of_a_page_are_not_compared(spark):
    """Repeated rows and other query strings of one path; a page of that path with other lines is a neighbour."""
    def page(own):
        return f"<body><div>Top</div><div>{own}</div><div>End</div></body>"

    rows = [(i, f"http://h.org/a/1?from={i}", page("own 1")) for i in range(4)] + [(0, "http://h.org/a/1?from=0", page("own 1"))]
    rows += [(10, "http://h.org/a/2", page("own 2"))]
    rows += [(20 + i, f"http://v.org/view?id={i}", page(f"own {i}")) for i in range(2)]
    rows += [(30, "http://m.org/x", page("m")), (31, "http://m.org/x?copy", page("m"))]
    got = [(r.page_id, r.text) for r in h.main_text(_pages(spark, rows)).collect()]
    expected = [(i, "own 1") for i in (0, 0, 1, 2, 3)] + [(10, "own 2"), (20, "own 0"), (21, "own 1")]
    assert sorted(got) == expected + [(30, "Top m End"), (31, "Top m End")]


def test_repeated_rows_and_empty_table(spark):
    row = (1, "http://a.org/x", "<main>é &eacute;</main>")
    got = h.main_text(_pages(spark, [row, row])).collect()
    assert [(r.page_id, r.text, r.n_chars) for r in got] == [(1, "é é", 3)] * 2
    assert h.main_text(_pages(spark, [])).collect() == []


def test_given_pages(spark):
    import html
    import re

    sf = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in h.op9_html_text(spark, sf).collect():
        article = re.search("<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        blocks = [re.sub("<[^>]*>", "", b.replace("<br>", " ")) for b in re.split("</?(?:p|h1)>", article)]
        assert r.text == " ".join(" ".join(html.unescape(b).split()) for b in blocks if b.split())


def test_marked_pages_are_differenced_too(spark):
    """Their shared lines are found as others' are; the marks decide after that."""
    def page(own, said):
        return f"<body><div>Top</div><article><p>{own}</p><p>{said}</p></article><div>End</div></body>"

    rows = [(1, "http://h.org/a/1", page("one", "both")), (2, "http://h.org/a/2", page("two", "both")),
            (3, "http://h.org/a/2?again", page("two", "both")), (4, "http://k.org/", page("alone", "both")),
            (5, "http://m.org/", "<article></article><p>outside</p>"), (6, None, None)]
    parsed = h.read_pages(_pages(spark, rows))
    found = parsed.join(h.shared_lines(parsed), "same").select("page_id", "places").collect()
    assert {r.page_id: r.places for r in found} == {1: [0, 2, 3], 2: [0, 2, 3], 3: [0, 2, 3], 4: [], 5: [], 6: []}
    told = {r.page_id: r.text for r in h.main_text(_pages(spark, rows)).collect()}
    assert told == {1: "one both", 2: "two both", 3: "two both", 4: "alone both", 5: "", 6: ""}


def _nodes(plan):
    """All nodes of a physical plan, those of adaptive stages too."""
    yield plan
    if plan.nodeName() == "AdaptiveSparkPlan":
        yield from _nodes(plan.initialPlan())
    below = plan.children()
    for i in range(below.size()):
        yield from _nodes(below.apply(i))


def test_lines_are_stored_once_and_not_shuffled(spark):
    """Places come to the lines; the lines of a page are in no exchange."""
    told = h.main_text(_pages(spark, [(1, "http://h.org/a", "<p>one"), (2, "http://h.org/b", "<p>one<p>two")]))
    nodes = list(_nodes(told._jdf.queryExecution().executedPlan()))
    moved = [n.output().mkString(" ") for n in nodes if n.nodeName() == "Exchange"]
    assert moved and not any("lines#" in columns or "html#" in columns for columns in moved)
    assert {r.page_id: r.text for r in told.collect()} == {1: "", 2: "two"}


def test_places_meet_their_rows_in_blocks_of_any_size(spark, monkeypatch):
    def page(i):
        return f"<body><div>Top</div><div>own {i}</div>" + "<p>more" * (i % 3) + "<div>End</div></body>"

    rows = [(i, f"http://h.org/{i % 7}/{i}", page(i)) for i in range(40)] + [(3, "http://h.org/3/3", page(3)), (None, None, None)]
    expected = None
    for size in (1, 4, 1024):
        monkeypatch.setattr(h, "BLOCK", size)
        pages = _pages(spark, rows).repartition(3, "page_id")
        got = sorted(map(tuple, h.main_text(pages).collect()), key=str)
        assert len(got) == len(rows) and (expected is None or got == expected)
        assert {t for i, _, t, _ in got if i == 3} == {"own 3"}
        expected = got
