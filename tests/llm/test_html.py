import random
import time

from lexweave.llm import html

LONG = "A paragraph with quite a few words in it, long enough to surge over any threshold of a window."


def test_article():
    page = f"""<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var a="</p>";</script></head><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a></li></ul></nav><div class="ad">Buy now and save a lot of money today with this wonderful offer, please.</div>
    <article><h1>Head &amp; more</h1><p>{LONG}<br>second&nbsp;line<p><b>Open bold &lt;tag&gt;</p><aside>Aside</aside><div id="comments"><p>{LONG} says a reader</p></div><p>End.</p></article>
    <form><p>Name</p></form><footer>&copy; Site</footer></body></html>"""
    assert html.main_text(page) == f"Head & more\n{LONG}\nsecond line\nOpen bold <tag>\nEnd."


def test_surge_and_dive_without_an_article_element():
    page = f"<body><div>Home</div><div><a href=1>one</a> <a href=2>two</a></div><div class=menu>m</div><h2>Title</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p><ul class='related'><li>x</li></ul><p>&copy; 2020 Someone</p></body>"
    assert html.main_text(page) == f"Title\n{LONG}\nShort.\n{LONG}"
    lengths = [0, 5, 0, 0, 0, 90, 3, 80, 0, 0, 0, 70]
    assert html.stretches(lengths) == [(5, 7), (11, 11)]


def test_odd_pages():
    for page, text in ((None, ""), ("", ""), ("<p>", ""), ("just text", "just text"), ("a < b & c", "a < b & c"), ("<form><p>only in a form</p></form>", "only in a form"), ("<p>x<!-- open", "x"), ("<script>never closed", ""), ("</div></p>y<br/>z", "y\nz")):
        assert html.main_text(page) == text, page
    assert html.main_text("<p>" + "w " * 200000 + "</p>") == ("w " * 200000).strip()


def test_columns(spark):
    pages = spark.createDataFrame([(1, "u", f"<article><p>{LONG}</p></article>", 5), (2, None, None, 6)], "page_id long, url string, html string, text int")
    got = html.extract(pages).collect()
    assert got[0].__fields__ == ["page_id", "url", "html", "text", "_text", "n_chars"]
    assert [(r["_text"], r["n_chars"]) for r in got] == [(LONG, len(LONG)), ("", 0)]
    assert html.extract(pages.filter("false")).count() == 0


def test_left_out_blocks_do_not_end_the_text():
    for block in ("<div class=ad><p>Buy</p></div>", "<ul class=related><li>x</li></ul>", "<ul><li><a>one</a></li><li><a>two</a></li><li><a>three</a></li></ul>"):
        assert html.main_text(f"<body><div><p>{LONG}</p><p>{LONG}</p>{block}<p>C {LONG}</p></div></body>") == f"{LONG}\n{LONG}\nC {LONG}", block
    links = "<p><a>one</a></p>" * 3
    assert html.main_text(f"<body><div><p>{LONG}</p><p>{LONG}</p></div>{links}<div><p>Other {LONG}</p></div></body>") == f"{LONG}\n{LONG}"


def test_heading_and_lead_beside_a_nested_article():
    page = f"<main><h1>Head</h1><p>Lead.</p><ul><li><a>menu</a></li></ul><article>{f'<p>{LONG}</p>' * 4}</article></main>"
    assert html.main_text(page) == "\n".join(["Head", "Lead.", *[LONG] * 4])


def test_layout_names_are_no_noise():
    for tag in ("article class='post comments-open'", "div class='content has-sidebar'", "div id=content class=no-sidebar", "article class=sidebar", "div class='hfeed site'", "div class=modal"):
        name = tag.split()[0]
        assert html.main_text(f"<body><{tag}><p>{LONG}</p><p>{LONG}</p></{name}></body>") == f"{LONG}\n{LONG}", tag
    assert html.main_text(f"<div><p>{LONG}</p><p class=search-engine>Engines.</p><p>{LONG}</p></div>") == f"{LONG}\nEngines.\n{LONG}"
    for name in ("comment-list", "sidebar-left", "site-header", "cookieBanner", "post-comments", "ad ad-300"):
        assert html.main_text(f"<div><div class='{name}'>{LONG} no</div><p>{LONG}</p></div>") == LONG, name


def plain_stretches(lengths):
    """Surge and dive line by line: sums over the next WINDOW lines, added up anew for each."""
    n, found, i = len(lengths), [], 0
    window = lambda k: sum(lengths[k : k + html.WINDOW])
    while i < n:
        if lengths[i] and window(i) >= html.SURGE:
            last = i
            while last < n and window(last) > 0:
                last += 1
            found.append((i, max(k for k in range(i, last) if lengths[k])))
            i = last
        else:
            i += 1
    return found


def test_stretches_like_the_plain_model():
    rng = random.Random(4)
    for _ in range(500):
        lengths = [rng.choice([0, 0, 0, rng.randrange(1, 25), rng.randrange(1, 120)]) for _ in range(rng.randrange(30))]
        assert html.stretches(lengths) == plain_stretches(lengths), lengths


def test_pages_like_the_plain_model():
    """Pages of paragraphs in one box: the text is what lies from the first to the last stretch, with its neighbours."""
    rng = random.Random(9)
    for _ in range(200):
        lines = [rng.choice([None, "x" * rng.randrange(1, 9), "word " * rng.randrange(5, 30) + "."]) for _ in range(rng.randrange(1, 25))]
        page = "".join("<p><a>link</a></p>" if x is None else f"<p>{x}</p>" for x in lines)
        found = plain_stretches([len(x or "") for x in lines])
        first, last = (min(a for a, _ in found), max(b for _, b in found)) if found else (0, -1)
        while found and first and lines[first - 1]:
            first -= 1
        while found and last + 1 < len(lines) and lines[last + 1]:
            last += 1
        want = "\n".join(x or "link" for x in lines[first : last + 1]) if found else "\n".join(x for x in lines if x)
        assert html.main_text(f"<body>{page}</body>") == want, page


def test_words_in_values_and_anchors_leave_text_alone():
    for odd in ("<p title='the hidden story'>A.</p>", '<p data-x="a hidden gem">A.</p>', "<section id=discussion><p>A.</p></section>", "<h2 id=related-work>A.</h2>", "<p>A <a>linked paragraph of some length</a>.</p>", "<p><math>A.</math></p>", "<object><p>A.</p></object>", "<p>Copyright law in the 18th century was new.</p>"):
        for box in ("article", "div"):
            text = html.main_text(f"<{box}><p>{LONG}</p>{odd}<p>{LONG}</p></{box}>").split("\n")
            assert len(text) == 3 and text[0] == text[2] == LONG and text[1][0] in "AC", odd
    for gone in ("<p hidden>A.</p>", "<div hidden=''>A.</div>", "<div style='display: none'>A.</div>", "<div id=comments>A.</div>", "<section class=comments>A.</section>"):
        assert html.main_text(f"<div><p>{LONG}</p>{gone}<p>{LONG}</p></div>") == f"{LONG}\n{LONG}", gone


def test_odd_pages_take_linear_time():
    pages = ["<x " * 350000, '<x a="' * 150000, "<x a='>' " * 60000 + '"', "<b>" * 50000 + "</i>" * 50000, "<b>" * 30000 + "<tr></tr>" * 30000, "<div>x" * 50000, "</script " * 100000, "<" * 1000000, "<ul><li><ul>" + "<b>" * 30000 + "<li></li>" * 30000, "<article><main>y" * 20000, "<p>" * 100000]
    for page in pages:
        begun = time.process_time()
        html.main_text(page)
        assert time.process_time() - begun < 10, page[:20]
    assert html.main_text("a <x b") == "a <x b" and html.main_text("<p>one <x y='2>two</p>") == "one two"


def test_ties_repeats_and_names(spark):
    page = f"<div><div><p>{LONG}</p></div><p><a>1</a></p><p><a>2</a></p><p><a>3</a></p><div><p>{LONG[::-1]}</p></div></div>"
    assert html.main_text(page) == LONG
    rows = [(1, "u", page, "x", 5, None)] * 3 + [(None, None, "", None, None, None)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int, _text string")).collect()
    assert [r["__text"] for r in got] == [LONG] * 3 + [""] and [r["_n_chars"] for r in got] == [len(LONG)] * 3 + [0] and got[0]["text"] == "x"
