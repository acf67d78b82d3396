import json

import pytest

from pairwright.llm import html_text
from pairwright.llm.html_text import (
    compile_wrapper, constants_of, extract, extract_main_text, host_wrappers, infer_wrapper,
)

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
<header><div class="logo">Site</div></header><nav><ul><li><a href=a>Home</a></li><li><a href=b>About</a></li></ul></nav>
<div class="ad">Buy now</div><article><header><h1>Head &amp; {0}</h1></header><p>One  <b>bold</b>,
two.<p>Next&nbsp;line &#233;<br>more {0}</article><aside>Side</aside>
<section id="comments"><article><p>Nice {0}!</p></article></section>
<form><label>Name</label><input></form><script>var a = "<p>no</p>";</script><footer>Foot</footer></body></html>"""


def test_article_only():
    assert extract(PAGE.format("x")) == "Head & x\nOne bold, two.\nNext line é more x"


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a\nb"), ("<b>a<p>b</b>c", "a\nbc"),
    ("a < b <i>c</i>", "a < b c"), ("<!-- <p>x</p> --><p>y</p>", "y"), ("<p>y<!-- open", "y"),
    ("<script>x</p>", ""), ("<div class=ad>x<article>y</article>", "y"), ("<p title='a>b'>z</p>", "z"),
    ('<p title="open>z</p>', "z"), ("<ul><li>a<li>b</ul>c", "a\nb\nc"), ("<div id=cookie-notice>k</div><p>m</p>", "m"),
    ("&lt;p&gt; &amp;amp; &am", "<p> &amp; &am"), ("<main><p>m</p></main><p>out</p>", "m"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ("<div class=site-header>S</div><div class=post-header><h1>T</h1></div><p>x</p>", "T\nx"),
    ("<div class=has-sidebar><p>x</p><div class=sidebar>s</div></div>", "x"),
    ("<p>x</p><div hidden>h</div><p style='display: none'>n</p><p class='hidden-gem'>g</p>", "x\ng"),
    ("<div class='menu'>m</div><div class='content'><p>x</p><ul class='comment-list'><li>c</ul></div>", "x"),
    ("<article><p>x</p><div class='ad-box'>a</div><nav>n</nav><form>f</form><footer>t</footer></article>", "x"),
    ("<p>text</p><div><a href=x>one</a> <a href=y>two</a></div>", "text"),
])
def test_pages_without_a_wrapper(page, text):
    assert extract(page) == text


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + "x"
    assert extract(deep) == "x"
    mixed = "<dl>" + "<dt>a<dd>b" * 5_000 + "</dl>"
    assert extract(mixed).count("\n") == 9_999
    assert infer_wrapper([deep, mixed]).parts == []
    assert extract("<p>" + "word " * 200_000) == ("word " * 200_000).strip()


def test_wrapper_has_optional_repeated_and_slot():
    pages = ["<div><h2>A</h2><p>one</p><p>two</p><i>same</i></div>", "<div><h2>B</h2><p>three</p><hr><i>same</i></div>"]
    wrapper = str(infer_wrapper(pages))
    assert "<h2>#text</>" in wrapper and "(<p>#text</>)+" in wrapper
    assert "(<hr></>)?" in wrapper and "<i>same</>" in wrapper
    assert len(constants_of(infer_wrapper(pages))) == 1


def test_constants_of_a_host_are_no_main_text():
    body = "<div class=box><p>Welcome to our site</p><div><p>story {0} told</p><p>more {0}</p></div><p>All rights</p></div>"
    pages = [body.format(i) for i in range(4)]
    wrapper = compile_wrapper(pages)
    assert extract(body.format("new"), wrapper) == "story new told\nmore new"
    # constants inside an article stay: copies of one article are no furniture
    same = [PAGE.format("x")] * 3
    assert extract(PAGE.format("x"), compile_wrapper(same)) == extract(PAGE.format("x"))


def test_over_a_table(spark):
    rows = [(i, f"http://a.org/{i}", PAGE.format(i)) for i in range(12)]
    rows += [(90, "http://b.org/", None), ((1 << 62) + 1, None, "<p>x</p>"), (91, None, "<p>x</p>"), (None, "no url", ""), (91, None, "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = extract_main_text(df.selectExpr("*", "1 AS host", "2 AS text")).collect()
    assert sorted(str((r.page_id, r.url, r.text)) for r in got) == sorted(
        str((p, u, extract(h or ""))) for p, u, h in rows)
    by_id = {r.page_id: r for r in got}
    assert by_id[(1 << 62) + 1].text == "x"
    assert by_id[3].text == extract(PAGE.format(3)) and by_id[3].n_chars == len(by_id[3].text)
    assert by_id[90].text == "" and by_id[91].text == "x" and by_id[None].n_chars == 0
    assert extract_main_text(df.limit(0)).count() == 0


def test_a_teaser_is_not_the_article():
    whole = "<p>" + "The whole article of this page. " * 4 + "</p>"
    teaser = "<article class=card>teaser</article>"
    assert "The whole article" in extract(f"<main>{whole}{teaser}</main>")
    assert "The whole article" in extract(f"<aside>{teaser}</aside><main>{whole}</main>")
    assert "teaser" not in extract(f"<aside>{teaser}</aside><main>{whole}</main>")
    assert "The whole article" in extract(f"<aside>{teaser}</aside><div>{whole}</div>")
    assert "The whole article" in extract(f"<div class=sidebar>{teaser}</div><div>{whole}</div>")


def test_repeated_notices_in_main_are_the_hosts():
    page = "<main><div><p>Our terms have changed</p></div><p>story {0} told</p></main>"
    wrapper = compile_wrapper([page.format(i) for i in range(6)])
    assert extract(page.format("new"), wrapper) == "story new told"


def test_text_of_one_page_is_no_constant():
    page = "<div><p>story {0} told</p>{1}</div>"
    pages = [page.format(i, "<blockquote>said once</blockquote>" if i == 3 else "") for i in range(8)]
    assert extract(pages[3], compile_wrapper(pages)) == "story 3 told\nsaid once"
    assert constants_of(infer_wrapper(["<p>a<pre>x</pre>", "<p>b"])) == set()


def test_boilerplate_does_not_outvote_the_slots_of_its_path():
    page = "<p>story {0}</p><p>" + "All rights are reserved by the owners of this site. " * 9 + "</p>"
    pages = [page.format(i) for i in range(8)]
    assert extract(pages[0], compile_wrapper(pages)) == "story 0"


def test_all_pages_of_a_host_count(spark):
    """Many templates on one host, and one of long pages."""
    page = "<div class={0}><p>Notice of {0}</p><p>story {1} told</p><p>{2}</p></div>"
    kinds = "abcdefghijklmnopqrst"
    rows = [(i, "http://a.org/", page.format(k, i, "")) for i, k in enumerate(kinds * 4)]
    rows += [(100 + i, "http://long.org/", page.format("x", i, f"word{i} " * 40_000)) for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r.text for r in extract_main_text(df).collect()}
    assert all(got[i] == f"story {i} told" for i in range(80))
    assert all("Notice" not in got[100 + i] and got[100 + i].startswith(f"story {i} told") for i in range(3))
    of_host = [h for _, u, h in rows if u == "http://a.org/"]
    made = {r.host: json.loads(r.wrapper) for r in host_wrappers(df).collect()}
    whole = json.loads(compile_wrapper(of_host))
    assert made["a.org"] == {k: whole[k] for k in ("constants", "slots")}


def test_a_word_in_a_name_is_no_veto():
    text = "The whole article of this page. " * 4
    assert extract(f'<article class="post related-science"><p>{text}</p></article>') == text.strip()
    assert extract(f"<div id=share-market-news><p>{text}</p></div>") == text.strip()
    inner = "<div class=form-of-government>One</div><div class=alert-systems>Two</div>"
    assert extract(f"<article><p>x</p>{inner}</article>") == "x\nOne\nTwo"
    # nor is a whole name, of what holds nearly all of a page without landmarks
    assert extract(f"<div class=content-area><div class=announcement><p>{text * 4}</p></div><p>x</p></div>").startswith("The whole")
    assert extract("<p>x</p><div class='related-articles'>r</div><div class='c-ad ad-300x250'>a</div><div id=site-nav>n</div>") == "x"


def hosted(make, pages=20):
    """Pages of one host, and what its wrapper gives of them."""
    made = [make(i) for i in range(pages)]
    wrapper = compile_wrapper(made)
    return [extract(page, wrapper) for page in made]


def test_headings_and_quotes_that_pages_share_stay():
    got = hosted(lambda i: f"<div><h2>Introduction</h2><p>story {i} told</p><h2>References</h2><p>book {i}</p></div>"
                           "<div><h2>Latest</h2><p>always the same</p></div>")
    assert got == [f"Introduction\nstory {i} told\nReferences\nbook {i}" for i in range(20)]
    got = hosted(lambda i: f"<div><p>start {i}</p><p>{'A line that some quote' if i % 5 == 0 else i}</p><p>end {i}</p></div>")
    assert all("A line that some quote" in got[i] for i in range(0, 20, 5))
    assert got[3] == "start 3\n3\nend 3"


def test_adverts_go_by_their_position():
    turn = ["Buy shoes", "Buy hats", "Buy coats", "Buy socks"]
    assert hosted(lambda i: f"<div>{turn[i % 4]}</div><div><p>story {i}</p><p>more {i}</p></div>") == [
        f"story {i}\nmore {i}" for i in range(20)]
    article = "<article><p>story {0}</p><div>Buy shoes now</div><p>more {0}</p><ul><li>same</ul></article>"
    assert hosted(article.format)[7] == "story 7\nmore 7\nsame"
    # copies of one article are not furniture, whatever else differs
    copies = hosted(lambda i: f"<div class=ad>{i}</div><article><div>told by all</div><div>{'again' if i else 'once'}</div></article>")
    assert copies[3] == "told by all\nagain"


def test_repeated_groups_and_optional_elements():
    """Number of paragraphs, a picture and a list differ; the notice stands at one place of the wrapper."""
    def make(i):
        picture = "<figure><img src=x></figure>" if i % 2 else ""
        points = "<ul>" + "".join(f"<li>point {i}{k}" for k in range(i % 3)) + "</ul>" if i % 3 else ""
        story = "".join(f"<p>story {i} {k}</p>" for k in range(1 + i % 5))
        return f"<div><section>We moved house</section>{picture}{story}{points}</div>"

    got = hosted(make, 30)
    for i, text in enumerate(got):
        assert text.split("\n") == [f"story {i} {k}" for k in range(1 + i % 5)] + [f"point {i}{k}" for k in range(i % 3)]
    shown = str(infer_wrapper([make(i) for i in range(30)]))
    assert "(<figure>(<img></>)</>)?" in shown.replace("<figure><img></>", "<figure>(<img></>)") and "(<p>#text</>)+" in shown


def test_linked_sentences_stay_and_lists_of_links_go():
    text = "<p>Some words of the story that are no link.</p>"
    assert "A linked sentence" in extract(f"<div>{text}<p><a href=x>A linked sentence</a></p></div>")
    assert extract("<p><a href=x>All of this sentence is a link.</a></p>") == "All of this sentence is a link."
    assert extract(f"{text}<ul><li><a href=x>One</a><li><a href=y>Two</a></ul>").count("\n") == 0


def test_wrappers_of_tasks_merge_to_one(spark, monkeypatch):
    """The order and number of tasks change neither positions nor results."""
    monkeypatch.setattr(html_text, "FAN_IN", 2)
    page = "<div><b>Our notice</b>{1}<p>story {0}</p>{2}</div><div class=x{3}>Last word</div>"
    rows = [(i, "http://a.org/", page.format(i, "<hr>" * (i % 3 == 0), f"<p>more {i}</p>" * (i % 4), "ab"[i % 2])) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    wrapper = compile_wrapper([r[2] for r in rows])
    for tasks in (1, 13):
        got = {r.page_id: r.text for r in extract_main_text(df.repartition(tasks)).collect()}
        assert got == {i: extract(page, wrapper) for i, _, page in rows}
    assert got[5] == "story 5\nmore 5" and got[3] == "story 3\nmore 3\nmore 3\nmore 3"
