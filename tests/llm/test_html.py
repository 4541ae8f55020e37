"""Main text: exact results on pages of known structure, wrappers, furniture that only the host's other pages show."""

import json

import pandas as pd
import pytest

from loomlake.llm import html_text as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><div class="ad">Buy now</div><header>Site</header>
<article><h1>%s</h1><p><b>First &amp; last &lt;b&gt; caf&eacute;&#8217;s
   line.<br><p>Second <i>in</i>line<a href=x> link</a>.</p><ul><li>one<li>two</ul><aside>Side</aside><form>Name<input></form>
<pre>a
  b</pre><table><tr><td>c1<td>c2</table></article><div id="comments"><p>Nice!</p></div><footer>&copy; x</footer></body></html>"""
TEXT = "First & last <b> café’s line.\nSecond inline link.\none\ntwo\na b\nc1\nc2"


def text(page, out=frozenset()):
    return H.main_text(page, set(out))


def test_article_only():
    assert text(PAGE % "Title") == "Title\n" + TEXT


@pytest.mark.parametrize(("page", "want"), [
    ("", ""), ("plain words", "plain words"), ("<p>a<p>b", "a\nb"), ("<div>x<div>y</div>z</div>", "x\ny\nz"), ("<p>1 < 2 & 3 > 2</p>", "1 < 2 & 3 > 2"),
    ("<p>cut off <b", "cut off"), ("<!-- <p>no</p> --><p>yes</p>", "yes"), ("<p hidden>no</p><p>yes", "yes"), ("<p>&nbsp;a&nbsp;&nbsp;b&nbsp;</p>", "a b"),
    ("<script>if (a<b) x='<p>no</p>'</script>ok", "ok"), ("</p></div>stray", "stray"), ("<p>&amp;lt;</p>", "&lt;"), ("<main><p>m</p></main><p>out</p>", "m"),
    ("<div role='navigation'>n</div><p>y", "y"), ("<a title='1>0'>q</a>", "q"), ("<textarea>t</textarea><p>u", "u"), ("<p>" + "long " * 200_000, ("long " * 200_000).strip()),
])
def test_small_pages(page, want):
    assert text(page) == want


def test_deep_pages_are_read():
    assert text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"


def shape(node):
    return [node[H.S], node[H.REP], [shape(k) for k in node[H.KIDS]]]


def test_alignment_finds_optional_and_repeated_groups():
    one, two = H.tree_of("<ul><li>a<li>b<li>c</ul><p>x</p>"), H.tree_of("<ul><li>d</ul><h2>t</h2><p>y</p>")
    w = H.align_pages(one, two)
    ul, h2, p = w[H.KIDS]
    assert [x[H.S] for x in (ul, h2, p)] == ["ul", "h2", "p"]
    assert ul[H.KIDS][0][H.REP] and h2[H.N] == 1 < w[H.N] == 2 and p[H.N] == 2
    assert p[H.KIDS][0][H.TEXT] is None
    dl = H.tree_of("<dl><dt>a<dd>b<dt>c<dd>d<dt>e<dd>f</dl>")[H.KIDS][0]
    assert [(x[H.S], x[H.REP]) for x in dl[H.KIDS]] == [("dt", True), ("dd", True)]


def host_pages(n=8):
    row = "<html><body><div class='c1'><a href=/>Start</a> <a href=/x>More</a></div><div class='c2'><p>%s</p></div><div class='c3'>All about us, since 1999</div></body></html>"
    return [row % f"Story number {i} tells of {i * 7} things." for i in range(n)]


def test_furniture_shows_on_other_pages_of_the_host(spark):
    rows = [(i, "http://h.example/%d" % i, p) for i, p in enumerate(host_pages())] + [(100, "http://solo.example/", host_pages(1)[0]), (101, None, None), (102, "x", ""), (103, "http://H.example/9", host_pages()[3]), (100, "http://solo.example/", host_pages(1)[0])]
    df = spark.createDataFrame([(p, u, h, "x") for p, u, h in rows], "page_id long, url string, html string, _host string").repartition(5)
    got = H.extract_text(df).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    for i in range(8):
        assert by[i]["text"] == f"Story number {i} tells of {i * 7} things."
    assert "All about us" in by[100]["text"] and by[101]["text"] == by[102]["text"] == "" and by[103]["text"] == by[3]["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert H.extract_text(df.filter("page_id < 0")).count() == 0


def test_copies_of_one_page_keep_their_text(spark):
    df = spark.createDataFrame([(i, f"http://h.example/{i}", PAGE % "Same") for i in range(9)], "page_id long, url string, html string")
    assert {r["text"] for r in H.extract_text(df).collect()} == {"Same\n" + TEXT}


def test_whole_table(spark, sf):
    """The pages' own article element, read independently."""
    import html
    import re

    got = {r["page_id"]: r["text"] for r in H.op7_html_text(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        body = re.search(r"<article>(.*)</article>", r["html"] or "", re.S)
        blocks = re.split(r"</?(?:p|h1|div|li|ul)[^>]*>", body[1]) if body else []
        want = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", b.replace("<b>", "").replace("</b>", "")))).strip() for b in blocks]
        assert got[r["page_id"]] == "\n".join(filter(None, want)), r["page_id"]


def texts_of(spark, pages):
    df = spark.createDataFrame([(i, f"http://h.example/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string").repartition(3)
    return [r["text"] for r in sorted(H.extract_text(df).collect(), key=lambda r: r["page_id"])]


def test_furniture_of_one_place_leaves_its_siblings(spark):
    """One constant paragraph, and one list of links, beside content of the same symbol; some pages lack a part."""
    page = "<html><body><article><h1>T{0}</h1><p>Start of a long story {0}.</p>{1}<p>Go on {0}.</p><figure>Fig {0}</figure><p>Read more on our site.</p></article></body></html>"
    got = texts_of(spark, [page.format(i, f"<p>More {i}.</p>" * (i % 3)) for i in range(9)])
    assert got == ["\n".join([f"T{i}", f"Start of a long story {i}.", *[f"More {i}."] * (i % 3), f"Go on {i}.", f"Fig {i}"]) for i in range(9)]

    page = "<html><body><div><ul><li><a href=/a>Home of us</a><li><a href=/b>News</a></ul><h2>H{0}</h2>{1}<ul><li>point {0}<li>{2}</ul></div></body></html>"
    got = texts_of(spark, [page.format(i, "<p>Now</p>" * (i % 2), "<a href=/x>a long link that is content</a>" if i == 4 else f"more of the words on it {i}") for i in range(9)])
    assert [t.split("\n")[-2:] for t in got] == [[f"point {i}", "a long link that is content" if i == 4 else f"more of the words on it {i}"] for i in range(9)]
    assert not any("News" in t for t in got)


@pytest.mark.parametrize("batch", [1, 10_000])
def test_one_wrapper_for_each_host_when_tasks_give_early(spark, monkeypatch, batch):
    """Hosts whose parts come in several batches, and more of them than a task may hold."""
    run = {last: H._combined(lambda r: (r.host, 0), lambda r: H.tree_of(r.wrapper), last) for last in (False, True)}
    monkeypatch.setattr(H, "MAX_HELD", 2)
    rows = [(f"h{i // 5}", 0, p) for i, p in enumerate(host_pages(40))]
    batches = [pd.DataFrame(rows[i : i + batch], columns=["host", "part", "wrapper"]) for i in range(0, len(rows), batch)]
    got = pd.concat(run[True](iter(batches)))
    assert list(got["host"]) == [f"h{i}" for i in range(8)]
    assert [json.loads(w)[H.N] for w in got["wrapper"]] == [5] * 8
    assert pd.concat(run[False](iter(batches)))["host"].nunique() == 8


def test_pages_of_many_hosts_come_once(spark, monkeypatch):
    monkeypatch.setattr(H, "MAX_HELD", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        rows = [(i, f"http://h{i % 30}.example/{i}", p) for i, p in enumerate(host_pages(300))]
        got = H.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r["page_id"] for r in got) == list(range(300))
    assert {r["text"] for r in got} == {f"Story number {i} tells of {i * 7} things." for i in range(300)}


@pytest.mark.parametrize("name", ["class='content-sidebar-wrap'", "class='has-sidebar'", "class='layout-with-nav'", "id='search-results'", "class='has-cookie-banner'", "class='post comments-open'"])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_layout_around_the_article_is_no_furniture(name, tag):
    page = f"<nav>n</nav><div {name}><div><{tag}><h1>T</h1><p>Story.</p></{tag}></div><div class='sidebar'><p>Side</p></div></div><div class='footer'>End</div>"
    assert text(page) == "T\nStory."


@pytest.mark.parametrize(("page", "want"), [
    ("<article><h1>T</h1><div class='post-share-content'><p>A long story.<p>Its end.</div><div class='share'>Tell</div></article>", "T\nA long story.\nIts end."),
    ("<div class='content-sidebar-wrap'><p>A story without an article.<p>Its end.</div><div class='ad'>Buy</div>", "A story without an article.\nIts end."),
    ("<div class='has-nav'><main><p>m</p><div id='comments'><article class='comment'><p>A long comment on it</article></div></main></div>", "m"),
    ("<main><p>m</main><div class='related'><article><p>A longer text of another page</article></div>", "m"),
    ("<div class='entry'><p>The whole story</div><div id='comments'><article><p>c1</article></div>", "The whole story"),
    ("<article><p>x</p><div class='ad'>An ad longer than the text</div></article>", "x"),
    ("<nav class='nav'><main><p>no</main></nav><div class='has-nav' hidden><main>no</main></div><p>y", "y"),
])
def test_names_hold_for_what_is_furniture(page, want):
    assert text(page) == want


@pytest.mark.parametrize(("page", "want"), [
    ("<div class='overflow-hidden'><p>Whole story.</div>", "Whole story."), ("<p title='hidden gem'>text</p>", "text"), ("<p data-x='display:none'>text", "text"),
    ("<p style='display: none'>no</p><p aria-hidden='true'>no</p><p hidden=''>no</p><p>yes", "yes"), ("<p hidden=false>yes", "yes"),
    ("<article><div class='entry-header'><h1>Title</h1></div><p>Text.</article>", "Title\nText."),
    ("<article><p class='reply'>He said so.</p><label>A label</label><p>Text.</p><p class='ad'>Buy</p></article>", "He said so.\nA label\nText."),
    ("<article><p>Teaser</article><div><p>A story that is far longer than what the article element holds.</div>", "Teaser\nA story that is far longer than what the article element holds."),
    ("<article><p>A story of some length.</article><p>End note", "A story of some length."),
    ("<form><label>Name</label><input></form><label>Search</label><p>y", "y"),
])
def test_attributes_and_names_are_weighed(page, want):
    assert text(page) == want


def test_matches_are_longest_common_subsequences():
    import random

    def longest(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    rng = random.Random(3)
    for _ in range(400):
        a, b = ([rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(0, 12))] for _ in range(2))
        got = H.matches(a, b)
        assert all(a[i] == b[j] for i, j in got) and got == sorted(got)
        assert len({i for i, _ in got}) == len({j for _, j in got}) == len(got) == longest(a, b)
    assert len(H.matches(["x"] * 3000 + ["y"], ["z"] + ["x"] * 3000)) == 3000


def test_many_siblings_keep_their_order(spark):
    """Three hundred siblings of different kinds: furniture among them is found at its place."""
    page = lambda i: "<body>" + "".join(f"<div class='k{chr(97 + j % 26)}{chr(97 + j // 26)}'><p>{'Rights' if j == 200 else f'part {j} of {i}'}</p></div>" for j in range(300))
    got = texts_of(spark, [page(i) for i in range(6)])
    assert all(t.split("\n") == [f"part {j} of {i}" for j in range(300) if j != 200] for i, t in enumerate(got))


@pytest.mark.parametrize("n", [3, 7])
def test_an_articles_own_lists_of_links_stay(spark, n):
    """References differ from page to page; a menu within the article is the same on all, and lists outside are as before."""
    references = lambda i: "<h2>References</h2><ul>" + "".join(f"<li><a href='/r{i}{j}'>Source {j} of story {i}</a></li>" for j in range(1 + i % 3)) + "</ul>"
    menu = "<ol><li><a href='/a'>First part</a></li><li><a href='/b'>Second part</a></li></ol>"
    page = lambda i: f"<body><div><a href='/{i}'>Latest {i}</a></div><article><h1>Story {i}</h1>{menu}<p>Text of story {i}, and more of it {'again ' * i}.</p>{references(i)}</article>"
    for i, got in enumerate(texts_of(spark, [page(i) for i in range(n)])):
        want = [f"Story {i}", f"Text of story {i}, and more of it {'again ' * i}.", "References", *[f"Source {j} of story {i}" for j in range(1 + i % 3)]]
        if n < H.MIN_PAGES:
            want[1:1] = ["First part", "Second part"]
        assert got.split("\n") == want
