"""HTML extraction over attributes, names and nested templates that the given pages do not have."""

import pytest

from cyclerlake.llm import html_text

from .test_pages import pages_of


def text_of(page):
    return html_text.text_at(html_text.blocks(page), [])


@pytest.mark.parametrize(
    "attribute",
    ['style="overflow:hidden"', "style='overflow-x: hidden'", 'aria-hidden="false"', 'title="the hidden valley"', "data-role=navigation", "data-hidden", "onclick=f('hidden')", 'alt="a role=search b"'],
)
@pytest.mark.parametrize("tag", ["body", "article", "div", "p"])
def test_attributes_that_do_not_hide(tag, attribute):
    assert text_of(f"<html><{tag} {attribute}><p>Text stays here</p></{tag}></html>") == "Text stays here"


@pytest.mark.parametrize("attribute", ["hidden", "HIDDEN=''", 'hidden="hidden"', 'aria-hidden="true"', "class=x hidden", "role=navigation"])
def test_attributes_that_hide(attribute):
    assert text_of(f"<html><body><article><p>Text</p><div {attribute}><p>gone</p></div></article></body></html>") == "Text"


LONG = "A sentence of the article that goes on for a while, so that it counts as text. " * 3


@pytest.mark.parametrize(("wrapper", "side"), [('class="content with-sidebar"', 2), ('class="has-nav"', 2), ('class="page no-comments"', 2), ('class="widget"', 0), ('id="share"', 0)])
def test_wrappers_with_a_word_in_their_name(wrapper, side):
    page = f'<html><body><div {wrapper}><p>{LONG}</p><div class="comments"><p>Reader</p></div></div><div class="sidebar"><p>Side {LONG * side}</p></div></body></html>'
    assert text_of(page) == LONG.strip()


@pytest.mark.parametrize("part", ['<h2 id="related-work">Part</h2>', '<h2 id="share">Part</h2>', '<h2 id="market-share">Part</h2>', '<p id="social-policy">Part</p>', '<p class="notice">Part</p>', '<div class="entry-header"><h1>Part</h1></div>', '<div class="social-policy"><p>Part</p></div>'])
@pytest.mark.parametrize("container", ["article", "div"])
def test_parts_of_articles_with_a_word_in_their_name(part, container):
    assert text_of(f"<html><body><{container}><p>{LONG}</p>{part}<p>End</p></{container}></body></html>") == f"{LONG.strip()}\nPart\nEnd"


@pytest.mark.parametrize("name", ["ad", "comments", "share-buttons", "cookie-notice", "sidebar left"])
def test_whole_names_inside_an_article(name):
    assert text_of(f'<html><body><div><p>{LONG}</p><div class="{name}"><div><p>Other</p></div></div><ul id="pagination"><li>2</ul></div></body></html>') == LONG.strip()


def test_names_on_the_winning_path_of_a_host(spark):
    """One page's comments are longer than its article."""
    page = f'<html><body><div class="widget"><p>{LONG}</p></div><div class="comments"><p>{{}}</p></div></body></html>'
    rows = [(i, "http://h.org/", page.format(LONG * 3 if i == 4 else "Reader")) for i in range(14)]
    assert {r.text for r in html_text.extract(pages_of(spark, rows)).collect()} == {LONG.strip()}


NESTED = [
    "<article><h1>T</h1><section class=lead><p>short</p></section><section class=text><p>{long}</p></section></article>",
    "<article><h1>T</h1><p>short</p><div class=body><p>{long}</p></div></article>",
    "<main><div class=top><h1>T</h1></div><div class=lead><p>short</p></div><div><p>{long}</p></div></main>",
    "<div class=story><h1>T</h1><div class=lead><p>short</p></div><div class=text><p>{long}</p></div></div>",
    "<div class=story><div class=head><h1>T</h1><p>short</p></div><div class=a><div class=b><p>{long}</p></div></div></div>",
    "<h1>T</h1><div class=lead><p>short</p></div><div class=text><p>{long}</p></div>",
]


@pytest.mark.parametrize("template", NESTED)
def test_articles_in_several_containers(spark, template):
    body = template.format(long=LONG)
    page = f'<html><body><nav><p>Menu</p></nav>{body}<div class="sidebar"><p>{LONG}</p></div><footer><p>Foot</p></footer></body></html>'
    want = f"T\nshort\n{LONG.strip()}"
    assert text_of(page) == want
    got = html_text.extract(pages_of(spark, [(i, "http://h.org/", page) for i in range(3)])).collect()
    assert [r.text for r in got] == [want] * 3


def test_running_text_in_several_containers():
    parts = "".join(f"<div class={c}><p>{LONG}{c}</p></div>" for c in "abc")
    assert text_of(f"<html><body><div id=w><div class=story>{parts}</div><div class=x><p>A box</p></div></div></body></html>").split("\n") == [f"{LONG}{c}" for c in "abc"]


def test_a_form_around_the_page_holds_the_article():
    inner = f'<div class="menu"><p>Menu</p></div><div class="content"><h1>Title</h1><p>{LONG}</p><form action="/join"><p>Join us</p><input name=a><label>Mail</label></form><p>End</p></div>'
    page = f'<html><body><form method="post" id="aspnetForm"><input type="hidden" name="state" value="x">{inner}<button>Go</button></form></body></html>'
    assert text_of(page) == f"Title\n{LONG.strip()}\nEnd"


@pytest.mark.parametrize(
    "part",
    ["<script>x()</script>", "<style>p {}</style>", "<noscript>no</noscript>", "<svg><g><text>pic</text></g></svg>", "<button>Go</button>", "<template><p>t</p></template>", "<iframe src=x>f</iframe>", "<select><option>1</select>", "<span hidden>h</span>", '<span class="ad">Buy</span>', "<svg><path d='a>b'/></svg>"],
)
def test_dropped_parts_do_not_end_a_paragraph(part):
    assert text_of(f"<html><body><article><p>one {part} two</p><p>{LONG}</p></article></body></html>") == f"one two\n{LONG.strip()}"
    assert text_of(f"<html><body><article>{part}<p>{LONG}</p>{part}<p>end</p>{part}</article></body></html>") == f"{LONG.strip()}\nend"


@pytest.mark.parametrize("name", ["page-head", "title", "row"])
def test_a_headline_beside_the_container(name):
    page = f'<html><body><div class="{name}"><h1>The title</h1></div><div class="nav"><h2>Menu</h2></div><div class="content"><p>{LONG}</p><p>End</p></div><div class="foot"><p>Foot</p></div></body></html>'
    assert text_of(page) == f"The title\n{LONG.strip()}\nEnd"
    # a headline inside the article is the article's
    inside = page.replace(f"<p>{LONG}", f"<h1>Own</h1><p>{LONG}")
    assert text_of(inside) == f"Own\n{LONG.strip()}\nEnd"
    # a headline behind the text is none
    after = f'<html><body><div class="content"><p>{LONG}</p></div><div class="{name}"><h1>More</h1></div></body></html>'
    assert text_of(after) == LONG.strip()


def test_headlines_beside_the_container_win_the_vote(spark):
    page = '<html><body><div class="top"><h1>Title {0}</h1></div><div class="content"><p>{1}</p></div></body></html>'
    rows = [(i, "http://a.org/x", page.format(i, LONG)) for i in range(4)]
    # the title of this one comes without text that could be scored against it
    rows.append((9, "http://a.org/y", '<html><body><div class="top"><h1>Short</h1></div><div class="content"><p>Few words</p></div></body></html>'))
    got = {r.page_id: r.text for r in html_text.extract(pages_of(spark, rows)).collect()}
    assert got == {i: f"Title {i}\n{LONG.strip()}" for i in range(4)} | {9: "Short\nFew words"}


@pytest.mark.parametrize(
    "part",
    ['<div class="user-comments"><p>Reader</p></div>', '<div class="comment-thread"><p>Reader</p></div>', '<div id="disqus_thread"><p>Reader</p></div>', '<div class="ad-slot"><p>Buy</p></div>',
     '<div class="related-articles"><p>More</p></div>', '<p class="advert">Buy</p>', '<p class="sponsored">Buy</p>', '<section id="comments"><p>Reader</p></section>'],
)
@pytest.mark.parametrize("container", ["article", "div"])
def test_comments_and_adverts_in_articles(part, container):
    assert text_of(f"<html><body><{container}><p>{LONG}</p>{part}<p>End</p></{container}></body></html>") == f"{LONG.strip()}\nEnd"


@pytest.mark.parametrize("kept", ['<p id="ad-policy">Part</p>', '<p class="advertised">Part</p>', '<h2 id="advertising">Part</h2>', '<p>The <span class="share">Part</span></p>', '<p class="comment">Part</p>'])
def test_paragraphs_with_other_names_stay(kept):
    text = text_of(f"<html><body><article><p>{LONG}</p>{kept}<p>End</p></article></body></html>")
    assert text.split("\n")[1] in ("Part", "The Part")
