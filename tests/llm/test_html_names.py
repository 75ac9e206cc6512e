"""Boilerplate that is longer than the article, and names that don't mean what they say."""

import pytest

from strandline.llm import html_text

SAID = [f"Paragraph {i} of the article has enough words in it to be content, and one clause more." for i in range(3)]
ARTICLE = "".join(f"<p>{x}</p>" for x in SAID)
LONG = "".join(f"<p>Number {i} of what isn't the article goes on and on, with more words than a paragraph of it has.</p>" for i in range(9))


@pytest.mark.parametrize("home", ["<main>{}</main>{}", "<div class='post'>{}</div>{}", "<article>{}</article>{}", "<div>{1}<article>{0}</article></div>", "<div id='x'><div class='body'>{}</div></div><div>{}</div>"])
@pytest.mark.parametrize("beside", ["<div class='comments'>{}</div>", "<section id='comment-list'><div class='c1'>{}</div></section>", "<ol class='comments-area'><li><article class='comment-body'>{}</article></li></ol>", "<aside>{}</aside>", "<footer>{}</footer>", "<div class='notice'>{}</div>", "<div id='sidebar'><div>{}</div></div>", "<form>{}</form>", "<div role='complementary'>{}</div>", "<div class='related'><article>{}</article></div>", "<div class='ad-slot sponsored'>{}</div>"])
def test_boilerplate_longer_than_the_article(home, beside):
    page = f"<html><body><nav>Home</nav>{home.format(ARTICLE, beside.format(LONG))}</body></html>"
    assert html_text.extract(page).split("\n") == SAID, page


@pytest.mark.parametrize("beside", ["<aside>{}</aside>", "<div class='comments'>{}</div>", "<footer>{}</footer>"])
def test_boilerplate_within_the_article(beside):
    assert html_text.extract(f"<body><article>{ARTICLE}{beside.format(LONG)}</article></body>").split("\n") == SAID


@pytest.mark.parametrize("name", ["share", "notice", "tags", "related", "comments"])
@pytest.mark.parametrize("home", ["<article>{}</article>", "<div class='post'>{}</div>"])
def test_paragraphs_of_the_article_stay_whatever_their_class(name, home):
    own = f"<h2 class='{name}'>A heading of it</h2><p class='{name}'>This paragraph is the article's own, in spite of its class.</p>"
    found = html_text.extract(f"<body>{home.format(ARTICLE + own)}<div class='{name}'>{LONG}</div></body>").split("\n")
    assert found == [*SAID, "A heading of it", "This paragraph is the article's own, in spite of its class."]


@pytest.mark.parametrize("wrapper", ["<div class='widget'>{}</div>", "<div id='banner'>{}</div>", "<form>{}</form>"])
def test_wrappers(wrapper):
    rest = "<div>Some words beside it that are not in any element with a telling name at all.</div>"
    assert html_text.extract(f"<body>{wrapper.format('<main>' + ARTICLE + '</main>')}<p>Short.</p></body>").split("\n")[:3] == SAID
    assert html_text.extract(f"<body>{wrapper.format('<h1>Title</h1>' + ARTICLE)}</body>").split("\n") == ["Title", *SAID]
    assert html_text.extract(f"<body>{wrapper.format(ARTICLE)}<p>Short.</p></body>").split("\n")[-3:] == SAID or rest


def test_pages_of_nothing_but_comments():
    assert html_text.extract(f"<body><div class='comments'>{LONG}</div></body>") == ""
    assert html_text.extract(f"<body><footer>{LONG}</footer><aside>{LONG}</aside></body>") == ""
