import pytest

from pagelathe.llm.extraction import _main_sections, extract_pages
from pagelathe.llm.markup import spaced, walk


def text_of(page):
    return spaced([" " if k == "break" else t for k, n, t in walk(page) if k != "open" and not n.aside])


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain", "plain"),
        ("<p>a<b>b</b>c<p>d<br>e", "abc d e"),
        ("<p>1 &lt; 2 &amp; 3 &#233;&nbsp;x &am", "1 < 2 & 3 é x &am"),
        ("<script>var t='</p>';</script>x<style>p{}</style><SCRIPT>never closed", "x"),
        ("<nav>menu</nav><header>top</header><main><header>head</header>text</main><footer>foot", "head text"),
        ("<div class='ad'>buy</div><div class='road'>stay</div><div id=comments>hm</div><p hidden>no</p>", "stay"),
        ("a<!-- b -->c<!-- never", "ac"),
        ("<a href='x>y'>link</a> <img alt='>'> tail <foot", "link tail"),
        ("<ul><li>one<li>two</ul>after", "one two after"),
        ("</div></p>stray<", "stray<"),
        ("<title>t</title><form>f<input></form><button>b</button>x", "x"),
    ],
)
def test_walk(page, text):
    assert text_of(page) == text


def test_main_section_is_the_article_around_most_text():
    skeleton = ["/html", "/html/body", "/html/body/div.top", "/html/body/article", "/html/body/article/div.body"]
    slots = [("/html/body/article/h1", 20, 1), ("/html/body/article/div.body/p", 900, 3), ("/html/body/div.top", 50, 1)]
    assert _main_sections(skeleton, slots) == ["/html/body/article"]
    assert _main_sections(skeleton[:3], slots) == ["/html/body"]
    assert _main_sections([], slots) == [] and _main_sections(skeleton, []) == []


def test_sentences_and_headings_beside_the_section_stay():
    skeleton = ["/body", "/body/div.intro", "/body/div.content", "/body/div.links"]
    slots = [("/body/h1", 30, 2), ("/body/div.content/p", 900, 9), ("/body/div.intro", 150, 2), ("/body/div.links/a", 90, 9)]
    assert _main_sections(skeleton, slots) == ["/body/div.content", "/body/div.intro", "/body/h1"]


@pytest.mark.parametrize("pages", [1, 2, 5, 50])
def test_an_introduction_stays_and_frames_go_on_hosts_of_any_size(spark, pages):
    def page(i):
        links = "".join(f"<a href=/{(i + j) % 9}>Post {(i + j) % 9}</a> " for j in range(3))
        return (
            "<html><body><div class=site-header>Site name</div><div id=sidebar>Popular posts</div><div class=cookie-notice>We use cookies</div>"
            f"<div class=intro>An introduction number {i} that says in one sentence what follows.</div>"
            f"<div class=content><h1>Title {i}</h1><p>Text {i}, {'rather long ' * 20}as texts go.</p><p>More of it.</p></div>"
            f"<div class=related>{links}</div><div class=user-comments>Reader {i} says hi</div><div class=site-footer>Copyright</div></body></html>"
        )

    frame = spark.createDataFrame([(i, "https://b.example/p", page(i)) for i in range(pages)], "page_id bigint, url string, html string")
    for r in extract_pages(frame.repartition(3)).select("row.page_id", "text").collect():
        i = r.page_id
        assert r.text == f"An introduction number {i} that says in one sentence what follows. Title {i} Text {i}, {'rather long ' * 20}as texts go. More of it."


def test_template_text_goes_and_repeated_paragraphs_stay(spark):
    rows = []
    for i in range(12):
        extra = "<p>said again and again</p>" if i % 2 else ""
        page = f"<html><body><div class=top>Welcome to our site</div><div class=x><div class=crumb>You are here</div><div class=content><h1>Title {i}</h1><p>Text number {i} of this page, rather long as texts go.</p>{extra}</div></div><div class=legal>All the small print</div></body></html>"
        rows.append((i, "https://Site.example/p", page))
    rows.append((50, "https://site.example/q", "<html><body><div class=x><div class=content><h1>Broken</h1><p>Off in the mid"))
    found = {r.page_id: r.text for r in extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)).select("row.page_id", "text").collect()}
    for i in range(12):
        assert found[i] == f"Title {i} Text number {i} of this page, rather long as texts go." + (" said again and again" if i % 2 else "")
    assert found[50] == "Broken Off in the mid"


def test_odd_pages(spark):
    article = "<body><nav>n</nav><article><h1>H</h1><p>same text</p></article><footer>f</footer>"
    rows = [(i, "http://copies/", article, "x", "y") for i in range(8)] + [(3, "http://copies/", article, "x", "y"), (20, None, None, None, None), (21, "", "", "", ""), (None, "no address", "<p>hello", "", ""), (22, "http://one/", "<div>" * 3000 + "deep", "", "")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, text string")
    found = extract_pages(frame).select("row.page_id", "text").collect()
    assert sorted((r.page_id is None, r.page_id or 0, r.text) for r in found) == sorted([*[(False, i, "H same text") for i in [*range(8), 3]], (False, 20, ""), (False, 21, ""), (True, 0, "hello"), (False, 22, "deep")])
    assert extract_pages(frame.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article class='post header-2'>kept<div role=complementary>not</div></article>", "kept"),
        ("<article><h2 id=related-work>Related</h2><p>a<h2 id=search>Search</h2><p id=comments>b</article>", "Related a Search b"),
        ("<section id='navigation-systems'><h2>Systems</h2>c</section><section id=navigation>d</section><div class=section id=comments>e</div>", "Systems c d e"),
        ("<article><div class='entry-header'><h1>Title</h1></div>f</article>", "Title f"),
        ("<article class='post category-social'>g</article><article class='post tag-advertising menu'>h</article>", "g h"),
        ("<body class='nav'><p class=ad>i<span class=menu>j</span></p></body>", "ij"),
        ("<div class='top ad-box'>k</div><ul class=nav-menu><li>l</ul><div id=comments-2>m</div><div class='comment-list'>n</div>o", "o"),
    ],
)
def test_only_whole_names_of_containers_are_aside(page, text):
    assert text_of(page) == text


def test_articles_named_like_asides_are_extracted(spark):
    def page(i):
        return f"<html><body><div class=menu>Home {i}</div><div class=share>Share this</div><article class='post category-social'><div class='entry-header'><h1 id=search>Title {i}</h1></div><h2 id=related-work-{i}>Related {i}</h2><section id=navigation><p>Long text number {i} of the section that is found in this page.</p></section></article></body></html>"

    frame = spark.createDataFrame([(i, "https://a.example/p", page(i)) for i in range(12)], "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in extract_pages(frame).select("row.page_id", "text").collect()}
    assert found == {i: f"Title {i} Related {i} Long text number {i} of the section that is found in this page." for i in range(12)}
