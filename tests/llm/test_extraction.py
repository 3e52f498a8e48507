import itertools
import random

import pytest

from asksift.llm import extraction as e

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
<header><h1>Site</h1><p>Welcome to our site of news.</p></header>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies. Please accept all of them now.</p></div>
<{0}><h1>A title</h1><p>First paragraph of the article, with words. And   more
of it.</p><div class="advert">Buy now. It is cheap.</div><p>Short.<p>Be.</p>
<script>var t = "</p><p>no</p>";</script><!-- <p>not this</p> -->
<ul><li>Item one of the list</li><li>Item two</li></ul><form><p>Your name, please.</p><input></form>
<p><b>Fish &amp; chips &lt;3 &eacute;t&#233;<br>next line &nbsp; end.</p></{1}>
<aside><p>Something else that is long enough. Yes it is.</p></aside>
<section id="comments"><h2>Comments</h2><p>I liked this article a lot. Great work indeed.</p></section>
<footer>&copy; 2020 &middot; All of it.</footer></body></html>"""
MAIN = [
    "A title", "First paragraph of the article, with words. And more of it.", "Short.", "Be.",
    "Item one of the list", "Item two", "Fish & chips <3 été next line end.",
]


@pytest.mark.parametrize("tag", ["article", 'div id="content"', 'main class="post"'])
def test_main_text(tag):
    assert e.main_text(PAGE.format(tag, tag.split()[0])) == "\n\n".join(MAIN)


def test_page_cut_off():
    page = PAGE.format("article", "article")
    cut = page[: page.index("Be.") + 2]
    assert e.main_text(cut) == "\n\n".join([*MAIN[:3], "Be"])
    assert e.main_text(cut + "<") .endswith("Be<")
    assert e.main_text(cut + "<p class='x") == "\n\n".join([*MAIN[:3], "Be"])


@pytest.mark.parametrize("page", [None, "", "<html>", "<", "</p>", "<script>x", "<!-- x"])
def test_nothing_to_extract(page):
    assert e.main_text(page) in ("", "<")


def test_very_long_page():
    body = "".join(f"<p>Sentence number {i} of a long text.</p>" for i in range(20_000))
    assert e.main_text(f"<article>{body}</article>").count("\n\n") == 19_999


@pytest.mark.parametrize("seed", range(30))
def test_cut_is_the_cheapest_labelling(seed):
    rng = random.Random(seed)
    n = rng.randrange(1, 9)
    scores = [rng.uniform(-2, 2) for _ in range(n)]
    edges = {(i, j): rng.uniform(0, 2) for i, j in itertools.combinations(range(n), 2) if rng.random() < 0.5}

    def cost(labels):
        own = sum(max(s, 0) * (not x) + max(-s, 0) * x for s, x in zip(scores, labels))
        return own + sum(w for (i, j), w in edges.items() if labels[i] != labels[j])

    found = e.minimum_cut(scores, edges)
    assert cost(found) == pytest.approx(min(map(cost, itertools.product([False, True], repeat=n))))


def test_columns_pass_through(spark):
    df = spark.createDataFrame([(1, None, "t"), (1, PAGE.format("article", "article"), "u")], "page_id long, html string, other string")
    rows = e.extract_text(df).collect()
    assert [r.text for r in rows] == ["", "\n\n".join(MAIN)] and [r.other for r in rows] == ["t", "u"]
    blocks = e.extract_blocks(df).collect()[1].blocks
    assert [b.text for b in blocks if b.content] == MAIN and len(blocks) > len(MAIN)
    assert e.extract_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("open_tag", [
    '<article class="overflow-hidden">', '<article style="overflow:hidden">', '<article aria-hidden="false">',
    '<article data-x="hidden">', '<article class="post tag-news">', '<div class="content has-sidebar">',
    '<main class="comments-open">', '<div class="layout-sidebar"><article>', "<main id=no-nav class='search-enabled'>",
    '<article class="share">',
])
def test_names_of_wrappers_do_not_hide_the_text(open_tag):
    text = [f"Paragraph {i} of the article has words. It goes on for a while, as such texts do." for i in range(5)]
    body = "".join(f"<p>{t}</p>" for t in text)
    page = f"<body><nav><a href='/'>Home</a></nav>{open_tag}{body}</body>"
    assert e.main_text(page) == "\n\n".join(text)


@pytest.mark.parametrize("open_tag", [
    "<div hidden>", '<div aria-hidden="true">', '<div style="color:red; display: none !important">',
    '<div style="visibility:hidden">', '<div class="site-footer">', '<div class="has-x sidebar-left">',
    '<div id="comments" class="comments-open">', '<div class="tag-cloud">', '<div class="cookie-notice">',
])
def test_what_is_hidden_or_boilerplate_still_goes(open_tag):
    text = [f"Paragraph {i} of the article has words. It goes on for a while, as such texts do." for i in range(5)]
    body = "".join(f"<p>{t}</p>" for t in text)
    page = f"<body><article>{body}{open_tag}<p>I am not of the article. Not at all.</p></div></article></body>"
    assert e.main_text(page) == "\n\n".join(text)


def test_comments_longer_than_the_article_go():
    text = "A short article with one paragraph only. It has two sentences."
    comments = "".join(f"<p>Comment {i} of many comments here. They are long indeed.</p>" for i in range(30))
    page = f'<body><article><p>{text}</p></article><section id="comments">{comments}</section></body>'
    assert e.main_text(page) == text


LONG = [f"Paragraph {i} of the article has words. It goes on for a while, as such texts do." for i in range(6)]


@pytest.mark.parametrize("blocks, kept", [
    ([f"<div>{LONG[0]}</div>", "<div>Yes</div>", f"<div>{LONG[1]}</div>"], [LONG[0], "Yes", LONG[1]]),
    (["<h1>A title of this</h1>", "<div>By A. Writer</div>", f"<p>{LONG[0]}</p>"], ["A title of this", "By A. Writer", LONG[0]]),
    (["<div><a href=a>Home</a></div>", "<div>All of it is here. Yes.</div>", "<div><a href=b>About us</a></div>"], []),
    (["<a href=a>Mail</a><hr><p>Sent.</p><hr>", "<div><a href=b>One</a></div>", "<div><a href=b>Two</a></div>"], []),
])
def test_the_cut_is_right_where_the_sign_errs(blocks, kept):
    found = e.label_blocks(f"<body><div>{''.join(blocks)}</div></body>")
    assert [t for t, _, keep in found if keep] == kept
    assert [t for t, score, _ in found if score > 0] != kept


@pytest.mark.parametrize("page, kept", [
    (f'<div class="story"><div class="post-header"><h1>A title</h1></div><p class="alert-text">{LONG[0]}</p></div>', ["A title", LONG[0]]),
    (f"<article><p>Let <math><mi>x</mi> = <mn>2</mn></math> be so. It is.</p><p>{LONG[0]}</p></article>", ["Let x = 2 be so. It is.", LONG[0]]),
    (f"<article><p>{LONG[0]}</p><iframe src=x><p>{LONG[1]}</p></article>", [LONG[0], LONG[1]]),
    (f"<article><p>{LONG[0]}</p><svg><p>{LONG[1]}</p></article>", [LONG[0], LONG[1]]),
    (f"<article><p title=don't>{LONG[0]}</p><p>{LONG[1]} Don't.</p></article>", [LONG[0], f"{LONG[1]} Don't."]),
    (f"<article><noscript><p>{LONG[0]}</p></noscript><p>{LONG[1]}</p></article>", [LONG[0], LONG[1]]),
    (f"<article><p data-x='a>b' title = \"c>d\">{LONG[0]}</p><svg><text>no</text></svg></article>", [LONG[0]]),
])
def test_pages_as_browsers_read_them(page, kept):
    assert e.main_text(f"<body><nav><a href='/'>Home</a></nav>{page}</body>") == "\n\n".join(kept)


def test_scores_are_bounded():
    for _, score, _ in e.label_blocks(PAGE.format("article", "article")):
        assert -e.BOUND < score < e.BOUND


def test_a_column_of_the_result_s_name(spark):
    df = spark.createDataFrame([("a", "b")], "html string, text string")
    with pytest.raises(ValueError, match="text"):
        e.extract_text(df)
    assert e.extract_text(df, into="main").columns == ["html", "text", "main"]
