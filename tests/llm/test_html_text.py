import html
import re

import pytest

from scoremill.llm.html_text import extract, learned, main_text, weights
from scoremill.llm.registered import op5_html_extraction
from scoremill_checks.compare import duck

SF = "/root/testdata/sf0.001"
INLINE = "a|abbr|b|cite|code|em|font|i|mark|q|s|small|span|strong|sub|sup|u"


def brute(page):
    """The one article of a page of the tables, cut out by its tags."""
    found = re.search(r"<article>(.*?)</article>", page or "", re.S)
    if not found:
        return ""
    text = re.sub(rf"</?(?:{INLINE})(?:\s[^>]*)?>", "", found[1])
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", text)).split())


def test_query_equals_brute_force(spark):
    pages = duck(SF).execute("SELECT page_id, url, html FROM pages").fetchall()
    got = {r[0]: tuple(r[1:]) for r in op5_html_extraction(spark, SF).collect()}
    assert got == {i: (u, brute(h), len(brute(h))) for i, u, h in pages}


PAGE = ('<html><head><title>x</title></head><body><nav><a href="/">menu words here</a></nav>'
        '<div class="cookie-notice">we use cookies on this site</div><article><h1>Big&nbsp;Title</h1>'
        '<p>First <b>bo</b>ld text &amp; more.<!-- hidden --> And  so\n on.</p><div class="ad">buy now</div>'
        '<script>var a = "<p>no</p>";</script><p>Second paragraph, <a href="x?a>b">a link</a>.</p>'
        '<form><input name=q> search this</form></article><div id="comments"><p>nice post, thanks a lot</p></div>'
        '<aside>side words</aside><footer>foot words</footer></body></html>')
TEXT = "Big Title First bold text & more. And so on. Second paragraph, a link ."


def test_article_without_what_surrounds_it(spark):
    scores = learned(spark.read.parquet(f"{SF}/pages.parquet"))
    assert main_text(PAGE, scores) == TEXT.replace("link .", "link.")
    plain = PAGE.replace("<article>", '<div class="content">').replace("</article>", "</div>")
    assert main_text(plain, {}) == TEXT.replace("link .", "link.")


def test_awkward_pages(spark):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<"), (4, "u", "plain words only"), (5, "u", "<p><p><b>open"),
            (6, "u", "<script>x"), (7, "u", '<a href="'), (7, "u", "<nav>menu</nav>"), (None, "u", "&lt;b&gt; " * 3000)]
    pages = spark.createDataFrame([(i, u, h, 1, "z") for i, u, h in rows], "page_id long, url string, html string, text int, lang string")
    got = sorted((str(r[0]), r[2], r[3]) for r in extract(pages).collect())
    want = ["", "", "<", "plain words only", "open", "", '<a href="', "", " ".join(["<b>"] * 3000)]
    assert got == sorted((str(i), t, len(t)) for (i, _, _), t in zip(rows, want))
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract(none).collect() == []


WORDS = "plain words of a long enough article that tells something about its subject"


def test_wrapped_articles_stay(spark):
    scores = learned(spark.read.parquet(f"{SF}/pages.parquet"))
    wrappers = [f'<div class="{c}">|</div>' for c in ("content has-sidebar", "no-sidebar", "with-nav", "nav-fixed page")]
    wrappers += ['<div id="page-widget">|</div>', '<form id="aspnet" action="/">|</form>',
                 '<form><div class="has-sidebar with-nav">|</div></form>']
    around = '<nav><a href="/">menu words here</a></nav>|<div class="sidebar-left"><p>side words</p></div><footer>foot words</footer>'
    for wrapper in wrappers:
        for inner in ("<article>|</article>", "<main>|</main>", "|"):
            body = wrapper.replace("|", around.replace("|", inner.replace("|", f"<p>{WORDS}</p><p>{WORDS}</p>")))
            page = f"<html><body>{body}</body></html>"
            assert main_text(page, {} if inner == "|" else scores) == f"{WORDS} {WORDS}", page
    rows = "".join(f'<div class="row has-sidebar"><p>{WORDS}</p><div class="our-newsletter">join us</div></div>' for _ in range(3))
    assert main_text(f"<html><body>{rows}</body></html>", {}) == " ".join([WORDS] * 3)
    banner = f'<div class="banner"><main><p>{WORDS}</p></main></div>'
    assert main_text(f"<html><body>{banner}</body></html>", scores) == WORDS


def test_parts_of_names_within_an_article(spark):
    page = (f'<html><body><article><p>{WORDS}</p><section id="related-work"><p>{WORDS}</p></section>'
            f'<div class="search-results-method"><p>{WORDS}</p></div><div class="share-buttons"><p>send it</p></div>'
            f'<p>{WORDS}</p></article></body></html>')
    assert main_text(page, learned(spark.read.parquet(f"{SF}/pages.parquet"))) == " ".join([WORDS] * 4)


def test_comments_are_not_taken_for_the_article():
    said = '<li><article class="comment"><p>nice post thanks a lot</p></article></li>'
    page = (f'<html><body><div class="content"><p>{WORDS}</p></div><ol class="comment-list">{said * 9}</ol>'
            f'<form><p>write a comment</p><input name=q></form></body></html>')
    assert main_text(page, {}) == WORDS


PARTS = {
    "long list": "<ul>" + "".join(f"<li>item {i}</li>" for i in range(60)) + "</ul>",
    "longer list": "<ol>" + "".join(f"<li><a href='#{i}'>point {i}</a></li>" for i in range(200)) + "</ol>",
    "table": "<table><thead><tr><th>name</th><th>size</th></tr></thead><tbody>" + "".join(f"<tr><td>{i}</td><td>x</td></tr>" for i in range(150)) + "</tbody></table>",
    "code": "<pre><code>" + "for x in y:\n    pass\n" * 60 + "</code></pre>",
    "definitions": "<dl>" + "".join(f"<dt>t{i}</dt><dd>d{i}</dd>" for i in range(80)) + "</dl>",
    "figures": "".join(f"<figure><img src='{i}.png'><figcaption>fig {i}</figcaption></figure>" for i in range(60)),
    "sections": "".join(f"<section><h2>part {i}</h2><details><summary>more</summary>text {i}</details></section>" for i in range(40)),
}
SIX = f"<p>{WORDS}</p>" * 6
AROUND = ('<nav><ul><li><a href="/">menu words here</a></li></ul></nav>|<div id="responses"><p>a reader says this is nice</p></div>'
          '<aside><p>side words</p></aside><footer><p>foot words</p></footer>')


def plain(markup):
    return " ".join(re.sub(r"<[^>]*>", " ", markup).split())


@pytest.mark.parametrize("part", PARTS)
@pytest.mark.parametrize("layout", ["%s|%s", "|%s", "%s|", "<h1>A title</h1>|%s", "%s|%s|"])
def test_nothing_of_an_article_is_dropped(spark, part, layout):
    """Lists, tables, code and the like before, between and after paragraphs, under weights learned from pages without them."""
    scores = learned(spark.read.parquet(f"{SF}/pages.parquet"))
    body = layout.replace("%s", SIX).replace("|", PARTS[part])
    for article in ("<article>|</article>", "<main><article><div class='body'>|</div></article></main>"):
        page = f"<html><body>{AROUND.replace('|', article.replace('|', body))}</body></html>"
        assert main_text(page, scores) == plain(body), part
    page = f"<html><body>{AROUND.replace('|', f'<div class=post-body>{SIX}{PARTS[part]}{SIX}</div>')}</body></html>"
    if part != "longer list":  # of links, as a menu is
        assert main_text(page, scores) == plain(SIX + PARTS[part] + SIX)


def test_menus_beside_the_text_in_one_wrapper_stay_out():
    links = "".join(f"<li><a href='/{i}'>page {i}</a></li>" for i in range(30))
    page = f"<html><body><div class='wrap'><ul>{links}</ul>{SIX}<ul><li>one</li><li>two</li></ul><p>end</p><ul>{links}</ul></div></body></html>"
    assert main_text(page, {}) == plain(SIX) + " one two end"


def test_no_weight_is_beyond_the_evidence(spark):
    """Weights have degrees: what is seen more often on one side weighs more, and none reaches a limit."""
    assert weights({"tag-p": (10, 0)})["tag-p"] < weights({"tag-p": (100, 0)})["tag-p"] < weights({"tag-p": (10**9, 0)})["tag-p"] < 4
    found = learned(spark.read.parquet(f"{SF}/pages.parquet"))
    assert len({round(w, 6) for w in found.values()}) > 0.5 * len(found)


def test_very_long_pages_stay_whole():
    page = f"<html><body><article>{'<p>word</p>' * 100_000}<table>{'<tr><td>1</td></tr>' * 50_000}</table></article></body></html>"
    assert main_text(page, {}) == " ".join(["word"] * 100_000 + ["1"] * 50_000)
