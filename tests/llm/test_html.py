import pytest

from feedloom.llm.html import best_run, extracted, inside_of, main_text, places, scores, token_counts, tokens

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body>'
    '<header>Site name</header><nav><ul><li><a href="/x">Menu one</a></li></ul></nav><!-- ad --><div class="ad">Buy now</div>'
    "<article><h1>Big &amp; <b>bold</b></h1><p><b>First  line\n goes on.<br><p>Second.</p>"
    '<aside>Related</aside><form><input>Mail</form><div class="comments"><p>Nice!</p><div>me too</div></div><p>Third &lt;x&gt; &copy;</p></article>'
    '<section id="comments"><p>I liked it a lot</p></section><footer>&copy; me</footer></body></html>'
)
TEXT = "Big & bold\nFirst line goes on.\nSecond.\nThird <x> ©"
DEFAULT = {"word": 2.0, "tag:p": -0.05, "tag:other": -1.0, "skip:other": -4.0}


def test_main_text():
    assert main_text(PAGE, DEFAULT) == TEXT


@pytest.mark.parametrize("cut", [len(PAGE) - 30, PAGE.index("</article>"), PAGE.index("&copy;</p>") + 5, PAGE.index("goes on") + 4])
def test_pages_that_break_off(cut):
    got = main_text(PAGE[:cut], DEFAULT)
    assert got and (TEXT.startswith(got[:-3]) or got.startswith(TEXT[:20]))


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<>", "<p", "</", "<!--", "<script>", "<nav>", "<a b='", '<div class="ad', "&", "&#x;"])
def test_odd_pages(page):
    assert isinstance(main_text(page, DEFAULT), str)


def test_references_and_white_space():
    assert main_text("<p>a &amp;amp; b&nbsp;c &#233;&eacute &quo\t\n d</p>", DEFAULT) == "a &amp; b c éé &quo d"


def test_unclosed_menus_do_not_eat_the_page():
    assert "Real text" in main_text("<nav><ul><li>x</ul><article><p>Real text of the page</p></article>", DEFAULT)


def test_long_attributes_and_many_tags_take_linear_time():
    main_text("<p " + "a='" * 50_000, DEFAULT)
    main_text("<div>" * 30_000 + "x", DEFAULT)
    main_text('<div class="ad">' * 200 + "x", DEFAULT)


def test_scores_come_from_labelled_pages(spark, clashing):
    rows = [(i, f"http://x/{i}", PAGE) for i in range(20)] + [(20, None, None), (21, "u", ""), (None, None, "<p>lone words here</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = scores(token_counts(pages))
    assert found["word"] > 0 and all(v < 0 for k, v in found.items() if k[:4] != "word")
    assert found["word:outside"] < -2 < 2 < found["word:inside"]
    assert found["skip:nav"] < found["tag:p"]
    got = {r["page_id"]: r for r in extracted(clashing(pages)).collect()}
    assert got[3]["text"] == TEXT and got[3]["n_chars"] == len(TEXT)
    assert got[20]["text"] == got[21]["text"] == "" and got[None]["text"] == "lone words here"
    assert extracted(pages.limit(0)).count() == 0


def test_tokens_skip_whole_elements():
    kinds = tokens('<div class="ad"><div>x</div>y</div>z')
    assert kinds == [("skip", "div"), ("text", "z")]


BODY = "<article><h1>Big</h1><p>First line of the text.</p><p>Second line.</p></article>"


@pytest.mark.parametrize(
    "before, after",
    [
        ("<form id=aspnetForm>", "</form>"),
        ('<div class="content-sidebar-wrap">', "</div>"),
        ('<div class="layout has-sidebar with-widget">', "</div>"),
        ('<div class="sidebar"><div id="widget">', "</div></div>"),
    ],
)
def test_wrappers_do_not_take_the_article_with_them(before, after):
    page = f'<html><body><nav>Menu</nav>{before}{BODY}<div class="sidebar">Other</div>{after}<footer>me</footer></body></html>'
    assert main_text(page, DEFAULT) == "Big\nFirst line of the text.\nSecond line."


def test_forms_with_most_words_of_a_page_without_article():
    page = "<body><nav>Menu</nav><form id=aspnetForm><p>First line of the text.</p><p>Second line.</p></form></body>"
    assert main_text(page, DEFAULT) == "First line of the text.\nSecond line."
    assert ("skip", "form") in tokens(page.replace("<nav>Menu</nav>", f"<article>{'word ' * 9}</article>"))


def test_hints_are_whole_names():
    page = '<article><h1 class="entry-header">Big</h1><p>One.</p><section class="related-work"><p>Two.</p></section><div class="related">No</div></article>'
    assert main_text(page, DEFAULT) == "Big\nOne.\nTwo."
    assert ("hint", "related") in tokens(page)


def test_hints_are_learnt(spark):
    page = f'<div class="site-header"><p>Name of the site</p></div>{BODY}'
    found = scores(token_counts(spark.createDataFrame([(i, "u", page) for i in range(20)], "page_id long, url string, html string")))
    assert found["hint:header"] < -1


LEARNT = (
    '<body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><div class="ad">Buy this now or never again at all.</div>'
    f"<article><h1>A heading of some words</h1>{'<p>' + 'Long text of many words that goes on for a while and then some more of it. ' * 4 + '</p>' * 1}<p>A short end.</p></article>"
    "<footer>Copyright and terms of this site here</footer></body>"
)
PARAGRAPHS = [f"Paragraph {i} holds a good many words as texts do, and so it goes on to the end of the line." for i in range(3)]
RAILS = ['<div class="rail">Most read today / Weather maps</div>', '<div class="top-stories"><ul><li><a href="/x">Storm hits coast</a></li><li><a href="/y">Votes counted</a></li></ul></div>', '<div class="colophon">Copyright of the makers, all rights reserved</div>']


@pytest.fixture(scope="module")
def learnt(spark):
    pages = spark.createDataFrame([(i, "u", LEARNT) for i in range(40)], "page_id long, url string, html string")
    return scores(token_counts(pages))


@pytest.mark.parametrize("rail", RAILS)
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class='story'>{}</div>", "{}"], ids=["article", "main", "div", "none"])
def test_pages_without_listed_names(learnt, rail, wrap):
    text = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    page = f"<html><body>{rail}{wrap.format('<h1>The heading of it</h1>' + text)}{rail}</body></html>"
    assert main_text(page, learnt) == "\n".join(["The heading of it", *PARAGRAPHS])


def test_lists_and_plain_blocks_are_content(learnt):
    text = f"<p>{PARAGRAPHS[0]}</p><ul><li>One thing</li><li>Another <a href='/z'>thing</a></li></ul><p>{PARAGRAPHS[1]}</p>"
    want = "\n".join([PARAGRAPHS[0], "One thing", "Another thing", PARAGRAPHS[1]])
    assert main_text(f"<body>{RAILS[0]}<article>{text}</article>{RAILS[2]}</body>", learnt) == want
    assert main_text(f"<body>{RAILS[0]}<div>{text}</div>{RAILS[2]}</body>", learnt) == want
    plain = "".join(f"<div>{p}</div>" for p in PARAGRAPHS)
    assert main_text(f"<body>{RAILS[0]}{plain}{RAILS[2]}</body>", learnt) == "\n".join(PARAGRAPHS)


def test_pictures_that_close_themselves(learnt):
    page = f'<article><p>{PARAGRAPHS[0]} <svg class="icon"/></p><p>{PARAGRAPHS[1]}</p><svg><text>no</text></svg><p>{PARAGRAPHS[2]}</p></article>'
    assert main_text(page, learnt) == "\n".join(PARAGRAPHS)


def test_the_scan_finds_the_best_of_all_runs():
    import itertools
    import random

    rng = random.Random(1)
    for _ in range(300):
        gains = [rng.choice([-3, -1, -0.5, 0.5, 1, 4]) for _ in range(rng.randrange(0, 14))]
        a, b = best_run(gains)
        sums = [sum(gains[x:y]) for x, y in itertools.combinations(range(len(gains) + 1), 2)]
        assert sum(gains[a:b]) == max([0, *sums])


def test_places_and_sides():
    found = tokens("<main><p>one two</p><article><h2>a</h2><ul><li><a>b c</a> d</li></ul><p>e f g h i</p></article></main>x")
    text = [(v.strip(), p, s) for (k, v), p, s in zip(found, places(found), inside_of(found), strict=True) if k == "text"]
    assert text == [
        ("one two", ("unlinked", "short", "p"), False), ("a", ("unlinked", "short", "heading"), True), ("b c", ("linked", "short", "list"), True),
        ("d", ("unlinked", "short", "list"), True), ("e f g h i", ("unlinked", "middle", "p"), True), ("x", ("unlinked", "short", "other"), False),
    ]
