"""The style tree inside articles, and names of classes that do not make clutter."""

from arcweave.llm import html_text


def texts_of(spark, scratch, pages):
    data = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r.page_id: r.text for r in html_text.extract(data, scratch).collect()}


def test_boxes_inside_articles_are_removed(spark, scratch):
    story = "<h1>Story {0}</h1><div class='body'><p>Text number {0} goes on for a while, and has {1} words</p></div>"
    box = "<div class='b1'><p>Read on every page</p></div><p>Tell your friends</p>"
    pages = [(i, f"http://a.example/{i}", f"<nav>x</nav><article>{story.format(i, i * 7)}{box}</article>") for i in range(12)]
    # A page-wide main, a box on most pages only; one page has a text of its own in the box.
    for i in range(12):
        own = "<p>Only here</p>" if i == 5 else "<p>Sent to you by mail</p>"
        pages.append((100 + i, f"http://b.example/{i}", f"<main><div class='b2'>{own}</div>{story.format(i, i * 7)}</main>"))
    # One article on two and on many pages, and versions of one article.
    same = story.format("same", 1) + "<p>End</p>"
    pages += [(200 + i, f"http://c.example/{i}", f"<nav>{i}</nav><article>{same}</article>") for i in range(2)]
    pages += [(300 + i, f"http://d.example/{i}", f"<nav>{i}</nav><article>{same}</article>") for i in range(9)]
    pages += [(400 + i, f"http://e.example/{i}", f"<article>{same}<p>Version {i}</p></article>") for i in range(9)]
    found = texts_of(spark, scratch, pages)
    for i in range(12):
        text = f"Story {i}\n\nText number {i} goes on for a while, and has {i * 7} words"
        assert found[i] == text
        assert found[100 + i] == ("Only here\n\n" if i == 5 else "") + text
    whole = "Story same\n\nText number same goes on for a while, and has 1 words\n\nEnd"
    assert all(found[k] == whole for k in found if 200 <= k < 400)
    assert all(found[400 + i] == f"{whole}\n\nVersion {i}" for i in range(9))


def kept(page):
    return [text for text, prior, _ in html_text.parse(page)[0] if prior != 0]


def test_names_are_whole_tokens_and_articles_override_them():
    for name in ("site-content no-sidebar", "content has-sidebar", "post comments-open", "elementor-widget", "article-header", "section-header"):
        assert kept(f'<div class="{name}"><article><h1>T</h1>x</article></div>') == ["T", "x"], name
        assert kept(f'<article><div class="{name}"><h2>T</h2></div>x</article>') == ["T", "x"], name
        assert kept(f'<div id="{name}">x</div>') == ["x"], name
    for name in ("sidebar", "cookie-notice", "x ad", "site_footer", "Share"):
        assert kept(f'<div class="{name}">a</div>b') == ["b"], name
        assert kept(f'<article><div class="{name}">a</div>b</article>') == ["b"], name
        assert kept(f'<div class="{name}">a<article>b<p>c</article>d</div>e') == ["b", "c"], name
        assert kept(f'<div class="{name}">a<main>b<article>c</article></main></div>') == ["b", "c"], name
    # An article elsewhere is the page's own; comments and hidden boxes are not lifted.
    assert kept('<div class="related"><article>a</article></div><article>b</article>') == ["b"]
    assert kept('<main>a<div class="sidebar"><article>b</article></div></main>') == ["a", "b"]
    assert kept('<main>a<div id="comments"><article class="comment">b</article></div></main>') == ["a"]
    assert kept('<div class="sidebar"><article>a<div class="ad">b</div><aside>c</aside>d</article></div>') == ["a", "d"]
    assert kept("<aside><article>a</article></aside><p>b") == ["b"]
    assert kept('<div hidden class="content"><article>a</article></div>b') == ["b"]
