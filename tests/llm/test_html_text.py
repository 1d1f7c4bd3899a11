import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from patronlens.llm import html_text, queries
from patronlens.llm.html_text import main_text, surge_and_dive

SF = "/root/testdata/sf0.01"


def squeezed(text):
    return "\n".join(" ".join(line.split()) for line in text.split("\n") if line.strip())


def test_whole_table_gives_the_documents_back(spark):
    """Every article is a title and the lines of a document."""
    documents = {squeezed(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op8_html_text(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert all(r.n_chars == len(r.text) for r in rows)
    assert all(r.text.split("\n", 1)[1] in documents for r in rows)


LONG = "This sentence is long enough to look like the text of an article, is it not? " * 3


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("<p>a &amp; b&nbsp;&lt;c&gt; &#233;&copy;</p>", "a & b <c> é©"),
        ("<article><h1>T</h1><p>one\n two<br>three <b>bo</b>ld</article>", "T\none two\nthree bold"),
        ("<nav>menu<ul><li>x</li></ul></nav><article>It.</article><footer>f", "It."),
        ("<article><p>t</p><aside>s</aside><form>f</form><p>u</p><div class='share-box'>v</div></article>", "t\nu"),
        ("<article>a</article><div id=comments><p>" + LONG + "</p></div>", "a"),
        ("<main><div class='cookie-notice'>c</div><p>m</p></main>", "m"),
        ("<header><h1>Site</h1></header><article><header><h1>Title</h1></header>x</article>", "Title\nx"),
        ("<body class='has-sidebar'><article>x</article></body>", "x"),
        ("<div class='content-with-sidebar'><article>x</article><div class=sidebar>y</div></div>", "x"),
        ("<script>var a = '<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>yes</p>", "yes"),
        ("<script>never closed <p>no</p>", ""),
        ("<nav>open <article>x</article>", "x"),
        ("<p title='a > b'>x</p><p", "x\n<p"),
        (f"<div><a href=1>Home</a></div><div><a href=2>News</a></div><p>{LONG}</p><p>{LONG}</p><ul><li><a>x</a></li></ul>",
         f"{LONG.strip()}\n{LONG.strip()}"),
        (f"<p>{LONG}</p><h2>Part</h2><p>{LONG}</p>", f"{LONG.strip()}\nPart\n{LONG.strip()}"),
        ("<p style='display: none'>no</p><p hidden>no</p><p>yes</p>", "yes"),
        ("<div itemprop='articleBody'>x</div><div>" + LONG + "</div>", "x"),
        ("<article>" + "<b>" * 5000 + "deep", "deep"),
    ],
)
def test_pages(page, want):
    assert main_text(page) == want


def plain_surge_and_dive(weights, share, window):
    sums = [sum(weights[i : i + window]) for i in range(len(weights))]
    least = share * max(sums, default=0)
    best = (0, 0, 0)
    for a in range(len(weights)):
        for b in range(a + 1, len(weights) + 1):
            run = all(s > least for s in sums[a:b])
            if run and (a == 0 or sums[a - 1] <= least) and (b == len(weights) or sums[b] <= least):
                low, high = a, min(len(weights), b + window - 1)
                while low < high and not weights[low]:
                    low += 1
                while high > low and not weights[high - 1]:
                    high -= 1
                best = max(best, (sum(weights[low:high]), low, high), key=lambda x: x[0])
    return best[1:]


def test_surge_and_dive():
    @settings(max_examples=400, deadline=None, database=None)
    @given(st.lists(st.sampled_from([0, 0, 1, 5, 40, 200]), max_size=14), st.integers(1, 4))
    def check(weights, window):
        assert surge_and_dive(weights, 0.2, window) == plain_surge_and_dive(weights, 0.2, window)

    check()


def test_any_markup_gives_a_text():
    parts = ["<p>", "</p>", "<nav>", "</nav>", "<article class=ad>", "</article>", "text ", "<", ">", "&amp", "<!--", "-->",
             "<a href='", "'", "<script>", "</script>", "<br/>", "<div id=comments>", "</div>"]

    @settings(max_examples=600, deadline=None, database=None)
    @given(st.lists(st.sampled_from(parts), max_size=25))
    def check(found):
        text = main_text("".join(found))
        assert text == squeezed(text)

    check()


def test_frames(spark):
    rows = [(1, "u", "<p>x</p>", 5), (None, None, None, 6), (1, "u", "<p>x</p>", 5), (2, "", "<p>" + "w " * 200_000, 7)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, N_CHARS int")
    got = html_text.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.n_chars for r in got.collect()) == [0, 1, 1, 399_999]
    assert html_text.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("page", "weights", "want"),
    [
        ("<p>head</p><article><h1>T</h1><p>a <a href=1>b</a></p></article><p>" + LONG, [3, 3, 3, 3], "T\na b"),
        ("<article>a</article>" + "<p>x</p>" * 4 + "<article>bcd</article>", [3, 1, 1, 1, 1, 3], "a\nbcd"),
        ("<p>one</p>", [3], "one"),
    ],
)
def test_every_page_goes_through_the_windows(page, weights, want, monkeypatch):
    seen = []

    def spy(found, *args, **kwargs):
        seen.append([min(w, 3) for w in found])
        return surge_and_dive(found, *args, **kwargs)

    monkeypatch.setattr(html_text, "surge_and_dive", spy)
    assert main_text(page) == want
    assert seen == [weights]


@pytest.mark.parametrize(
    "sizes",
    [
        [300] * 20 + [5000] + [300] * 20,
        [400] * 10 + [60] * 6 + [400] * 8,
        [300] * 3 + [5000],
        [30] * 20 + [5000] + [30] * 20,
        [100] * 5 + [50_000] + [40] * 10,
        [300] * 5 + [20] * 40 + [300] * 5,
        [3],
    ],
)
def test_whole_article_without_a_declaration(sizes):
    """One huge paragraph, or a list of short items in the middle, loses no other line."""
    want = ["x" * (n - 1) + "." for n in sizes]
    menu = "<div><a href=1>Home</a></div>" * 5
    page = menu + "".join(f"<p>{line}</p>" for line in want) + menu
    assert main_text(page).split("\n") == want


def test_many_tiny_lines_are_no_article():
    page = "<p>Today</p>" * 30 + f"<p>{LONG}</p>" * 10
    assert main_text(page).split("\n")[2:] == [LONG.strip()] * 10


def test_whole_table_without_declarations(spark):
    """The line weights alone find the documents, up to a few short lines at their ends."""
    lost = lines = 0
    for page in spark.read.parquet(f"{SF}/pages.parquet").collect():
        declared = main_text(page.html).split("\n")
        bare = main_text(page.html.replace("<article>", "<div>").replace("</article>", "</div>")).split("\n")
        assert set(bare) <= set(declared)
        lines += len(declared)
        lost += len(set(declared) - set(bare))
    assert lost < 0.01 * lines


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<head><title>no</title><body><article>x</article>", "x"),
        ("<html><head><meta charset=a><title>no</title><link href='b'><article><p>x</p></article>", "x"),
        ("<head><title>no</title><h1>x</h1><p>y", "x\ny"),
        ("<head><title>no</title><script>'</head><body><p>'</script><style>p</style><!-- <p> --><p>x", "x"),
        ("<head><title>no</title><p>x</p></head><body><p>y</p>", "x\ny"),
        ("<head><title>no <p> no</title></head>x", "x"),
        ("<head><meta content=\"it\"s\"><meta content='a'>no</head><body><p>x's</p>", "x's"),
        ("<head><title>no</title>", ""),
        ("<header><p>no</p></header><p>x</p>", "x"),
        ("<p>a<svg viewBox='0 0'/>b</p><p>c</p>", "ab\nc"),
        ("<p>a</p><iframe src=x /><p>b</p>", "a\nb"),
        ("<p>a<svg><svg><title>no</title></svg>no</svg>b</p>", "ab"),
        *((f"<p>a</p><{name}><p>b</p><p>c</p>", "a\nb\nc") for name in
          ("button", "select", "object", "noscript", "template", "svg", "iframe")),
        *((f"<p>a<{name} x='1>2'>no <p>no</{name}>b</p>", "ab") for name in
          ("button", "select", "object", "noscript", "template", "svg", "iframe")),
        ("<p>a</p><button>b<p>c</p><button>no</button><p>d</p>", "a\nb\nc\nd"),
        ("<div class=menu><noscript><div>no</noscript>no</div><p>x</p>", "x"),
        ("<p>a</p><noscript><article>no</article></noscript><p>b</p>", "a\nb"),
        *((f"<p>a</p><{name}><p>no</p>", "a") for name in ("script", "style", "textarea")),
    ],
)
def test_elements_without_an_end(page, want):
    assert main_text(page) == want


@pytest.mark.parametrize(
    ("inside", "want"),
    [
        ("<section id='discussion'><p>x</p></section>", "x"),
        ("<section class='related'>x</section>", "x"),
        ("<h2 id='related-work'>x</h2>", "x"),
        ("<div class='social-history'>x</div>", "x"),
        ("<div id='comments'>x</div>", "x"),
        ("<p id='response' class='notice'>x</p>", "x"),
        ("<p>a <span class='search-term'>x</span> b</p>", "a x b"),
        ("<div class='market-share'>x</div>", "x"),
        ("<div class='ad-hoc'>x</div>", "x"),
        ("<div class='adSlot big'>no</div><div class='cookie-notice'>no</div><ul class='share-buttons'><li>no</ul>x", "x"),
        ("<div class='sidebar-left'>no</div><div class='comments'><p>no</p></div>x", "x"),
        ("<p hidden>no</p><div role='search'>no</div>x", "x"),
    ],
)
@pytest.mark.parametrize("name", ["article", "main"])
def test_class_names_inside_an_article(name, inside, want):
    assert main_text(f"<{name}><p>one</p>{inside}</{name}><div class='related'>no</div>") == f"one\n{want}"


def test_class_names_beside_an_article():
    page = "<main><article><div class='related'>x</div></article><div class='related'>no</div></main>"
    assert main_text(page) == "x"


PARAGRAPHS = "".join(f"<p>{'word ' * 60}</p>" for _ in range(10))


def test_a_declared_teaser_does_not_hide_the_text():
    """The windows decide: ten long paragraphs stay although a short article is declared before them."""
    text = main_text(f"<article>Top story</article><div>{PARAGRAPHS}</div><footer>no</footer>")
    assert text.split("\n") == ["Top story", *["word " * 59 + "word"] * 10]
    assert main_text(f"<article>{PARAGRAPHS}</article><div>" + "<p>beside it</p>" * 3 + "</div>").count("\n") == 9


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<article><a title=it's href=x>link</a><p>two</p><p>don't</p></article>", "link\ntwo\ndon't"),
        ('<article><p>x</p><img alt="5" screen"><p>y</p></article>', "x\ny"),
        ('<article><p>x</p><p title="a>two</p></article>', "x\ntwo"),
        ('<article><p title="a>b">x</p><p title=\'a>b\' b>y</p></article>', "x\ny"),
        ("<article><p a = b/c>x</p><br/><p a=>y</p></article>", "x\ny"),
        ('<article><script data-x="a>b">no</script><p =x>y</p></article>', "y"),
    ],
)
def test_attributes_as_browsers_read_them(page, want):
    assert main_text(page) == want


def test_many_quotes_take_no_time():
    page = "<article>" + "<p a=\"b' c='d\" e>x</p>" * 3000 + "<p " + "a='\"" * 20_000 + "</article>"
    assert main_text(page).count("x") >= 3000
