"""HTML extraction: layouts, boilerplate, templates of hosts, odd markup."""

import random
import time

import pytest

from daygrain.llm import html_extract

BODY = "<h1>A &amp; B</h1><p>First  one,\n<b>bold</b> &eacute;<br>line.</p><p>Second &#x41;.</p>"
TEXT = "A & B\n\nFirst one, bold é line.\n\nSecond A."


def text(page, classes=None):
    return html_extract.main_text(page, classes or {})


@pytest.mark.parametrize("around", [
    "<nav><ul><li><a href='/x'>Menu</a></li></ul></nav><article>{}</article><footer>&copy; us</footer>",
    "<header><h2>Site</h2></header><main>{}</main><aside>More</aside>",
    "<div class='sidebar'>side<p>x</p></div><article>{}<div class='comments'><p>me too</p></div></article>",
    "<div id=cookie-notice>We use cookies</div><article>{}<form><input value=a>Search<button>Go</button></form></article>",
    "<article><script>var t='</p><p>no';</script>{}<style>p{{}}</style><!-- <p>no</p> --></article>",
    "<div class=\"ad\">Buy > now</div><article data-x='a>b'>{}</article>",
    "<article>{}<div class='share-buttons'>Tweet</div><section class=\"related\"><h2>See also</h2></section></article>",
    "<article>{}<p style='display: none'>hidden</p><p hidden>hidden</p><div role=complementary>c</div></article>",
    "<div role='navigation'>m</div><article>{}</article><div class='page-header'>h</div>",
])
def test_boilerplate_is_left_out(around):
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{around.format(BODY)}</body></html>"
    assert text(page) == TEXT


def test_unclosed_elements():
    assert text("<article><h1>T</h1><p><b>one<br><p>two <i>x</i>y<ul><li>a<li>b</ul>tail</article>") == "T\n\none\n\ntwo xy\n\na\n\nb\n\ntail"


def test_no_article_and_odd_pages():
    assert text("<p>a</p>b<div>c<span>d</span></div>") == "a\n\nb\n\ncd"
    assert text("plain text &lt;b&gt;") == "plain text <b>"
    assert text("a < b") == "a < b"
    assert text("") == "" and text("<article></article>") == ""
    assert text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, text string")


def test_template_of_a_host_is_deduced(spark):
    """Pages without an article: what stands on all pages of the host in the same order is template."""
    rows = []
    for i in range(12):
        page = f"<html><body><div>Daily News</div><div>Home</div><div><p>Story {i} begins.</p><p>It goes on {i * i}.</p></div><div>Imprint</div></body></html>"
        rows.append((i, f"https://News.example:8080/{i}", page))
    rows.append((50, "https://other.example/1", rows[0][2]))
    rows.append((51, None, rows[0][2]))
    got = {r.page_id: r for r in html_extract.extract(pages(spark, rows)).collect()}
    for i in range(12):
        assert got[i].text == f"Story {i} begins.\n\nIt goes on {i * i}."
        assert got[i].n_chars == len(got[i].text)
    assert got[50].text == got[51].text == "Daily News\n\nHome\n\nStory 0 begins.\n\nIt goes on 0.\n\nImprint"
    assert got[50].url == "https://other.example/1"


def test_article_text_that_repeats_is_kept(spark):
    rows = [(i, "https://same.example/", f"<body><article>{BODY}</article></body>") for i in range(9)]
    rows += [(9, "https://same.example/", None), (10, "x", ""), (9, "https://same.example/", None), (None, None, None)]
    got = html_extract.extract(pages(spark, rows)).collect()
    assert len(got) == len(rows)
    assert [r.text for r in got if r.page_id is not None and r.page_id < 9] == [TEXT] * 9
    assert all(r.text == "" and r.n_chars == 0 for r in got if r.page_id is None or r.page_id >= 9)


def test_copies_of_a_page_without_an_article_keep_their_text(spark):
    page = "<html><body><div>Daily News</div><div><p>{} begins.</p></div><div>Imprint</div></body></html>"
    rows = [(i, "https://copies.example/", page.format("One story")) for i in range(9)]
    got = html_extract.extract(pages(spark, rows)).collect()
    assert [r.text for r in got] == ["Daily News\n\nOne story begins.\n\nImprint"] * 9
    rows += [(i, "https://copies.example/", page.format(f"Story {i}")) for i in range(9, 13)]
    got = {r.page_id: r.text for r in html_extract.extract(pages(spark, rows)).collect()}
    assert got == {i: "One story begins." if i < 9 else f"Story {i} begins." for i in range(13)}


def test_template_inside_an_article_is_left_out(spark):
    page = "<body><article><h1>Story {0}</h1><p>It begins {0}.</p><div class='box'><p>By our own writer.</p></div></article></body>"
    rows = [(i, "https://teaser.example/", page.format(i)) for i in range(6)]
    got = {r.page_id: r.text for r in html_extract.extract(pages(spark, rows)).collect()}
    assert got == {i: f"Story {i}\n\nIt begins {i}." for i in range(6)}


def test_names_in_an_article_that_tell_of_its_text():
    body = "<h2 id='related-work'>Related</h2><p class='form'>Form</p><section id='legal'><p>Law</p></section>"
    assert text(f"<article>{body}<p>see <span id='search'>here</span></p></article>") == "Related\n\nForm\n\nLaw\n\nsee here"
    assert text("<article><p>a</p><section id='comments'>b</section><div class='related'>c</div></article>") == "a"
    page = "<article><p>so <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> holds</p></article>"
    assert text(page) == "so x=1 holds"


@pytest.mark.parametrize("page", [
    "<p data-hidden>kept</p>", "<div class='notice-of-motion'>kept</div>", "<ul class='menu-items'><li>kept</ul>",
    "<blockquote class='reply'>kept</blockquote>", "<table id='search'><tr><td>kept</table>", "<p it's>kept</p>",
    "<p title=it's>kept</p>", "<p title='a>b' \"x>kept</p>", "<titlepage>kept</titlepage>", "<p data-x='hidden'>kept</p>",
])
def test_text_of_an_article_is_kept(page):
    assert text(f"<article>{page}</article>") == "kept"


def test_repeated_headings_of_an_article_are_kept(spark):
    page = (
        "<body><div>Kitchen</div><article><h1>Cake {0}</h1><h2>Ingredients</h2><ul><li>{0} eggs</ul><h2>Method</h2><p>Bake {0}."
        "</p><h2>More from us</h2><p>Our book.</p></article></body>"
    )
    rows = [(i, "https://cakes.example/", page.format(i)) for i in range(6)]
    got = {r.page_id: r.text for r in html_extract.extract(pages(spark, rows)).collect()}
    assert got == {i: f"Cake {i}\n\nIngredients\n\n{i} eggs\n\nMethod\n\nBake {i}." for i in range(6)}


def brute_classes(rows):
    """{host: {token: class}} by comparing whole occurrence vectors over the host's distinct pages."""
    out = {}
    for host in {h for h, _ in rows}:
        distinct = sorted({p for h, p in rows if h == host and p})
        vectors = {}
        for n, page in enumerate(distinct):
            for token in html_extract.parse(page)[0]:
                vectors.setdefault(token, [0] * len(distinct))[n] += 1
        kept = {t: tuple(v) for t, v in vectors.items() if (n := sum(map(bool, v))) >= 3 and n >= 0.6 * len(distinct)}
        out[host] = kept
    return out


@pytest.mark.parametrize("most", [html_extract.MOST_TOKENS, 0])
def test_classes_and_texts_match_brute_force(spark, most):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        host = rng.choice("abc")
        parts = [f"<div>{host} head</div>"] * rng.choice([1, 1, 1, 2])
        parts += [f"<p>{rng.choice(['same', 'other', str(rng.random())])}</p>" for _ in range(rng.randint(0, 5))]
        parts += [f"<ul>{''.join(f'<li>{x}' for x in range(rng.randint(0, 3)))}</ul><div>{host} foot</div>"]
        rows.append((i, f"http://{host}.example/{i}", "".join(parts)))
    rows += [(100 + i, url, page) for i, (_, url, page) in enumerate(rows[:10])]
    frame = spark.createDataFrame([(u[7:].split("/")[0], p) for _, u, p in rows], "host string, html string")
    brute = brute_classes([(u[7:].split("/")[0], p) for _, u, p in rows])
    for r in html_extract.templates(frame).collect():
        got = {t["token"]: t["class"] for t in r.tokens}
        want = brute[r.host]
        assert set(got) == set(want)
        assert len(set(zip(got.values(), (want[t] for t in got)))) == len(set(got.values())) == len(set(want.values()))
    texts = {r.page_id: r.text for r in html_extract.extract(pages(spark, rows).repartition(3), most=most).collect()}
    for i, url, page in rows:
        assert texts[i] == html_extract.main_text(page, brute[url[7:].split("/")[0]])


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<b>" * 170_000 + "</i>" * 170_000, "<!" * 500_000, "<script" * 150_000, "<a x='" * 170_000, "<p><table>" + "<b>" * 100_000 + "<h1>" * 100_000,
    "<div>" * 100_000 + "x" + "</div>" * 100_000, "</" * 500_000, "<a b=" * 200_000, "< " * 500_000, "hidden " * 100_000,
])
def test_a_megabyte_of_odd_markup_is_read_at_once(page):
    start = time.time()
    text(page)
    text(f"<p {page}>")
    assert time.time() - start < 12


def test_classes_must_be_ordered_and_nested():
    a, b, c, d, x = 1, 2, 3, 4, 9
    classes = {a: 10, b: 10, c: 20, d: 20}
    assert html_extract.valid_tokens([a, c, x, d, b], classes) == {a, b, c, d}  # nested
    assert html_extract.valid_tokens([a, c, b, d], classes) == {a, b}  # crossing
    assert html_extract.valid_tokens([a, c, d, x, c, d, b], classes) == {a, b, c, d}  # two turns in one gap
    assert html_extract.valid_tokens([a, c, d, d, c, b], classes) == {a, b}  # out of order


def test_empty_table(spark):
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
