"""Names of wrappers do not hide the article; what stands around it stays hidden."""

import pytest

from foliospark.llm.html_extract import containers, text_at

TEXT = "The river rose in the night and the town woke to find the lower bridge under water."
PAGE = f"<p>{TEXT}</p><p>Nobody was hurt.</p>"
WANT = f"{TEXT}\nNobody was hurt."


def _text(page):
    return text_at(containers(page), None)


@pytest.mark.parametrize(
    "wrapper",
    [
        "<div class='layout has-sidebar'>%s</div>",
        "<main class='site-main no-sidebar'>%s</main>",
        "<article class='post no-comments'>%s</article>",
        "<article class='post share'>%s</article>",
        "<div id='search-result'>%s</div>",
        "<div class='widget'><div class='comments'>%s</div></div>",
        "<div class='promo page'><article>%s</article></div>",
        "<div class=content-with-sidebar>%s</div>",
    ],
)
@pytest.mark.parametrize("around", ["", "<div class='sidebar'>Latest news</div><div class='ad'>Buy <a href=x>this</a></div>"])
def test_wrappers_of_the_article(wrapper, around):
    assert _text(f"<body>{around}{wrapper % PAGE}{around}</body>") == WANT


def test_a_page_of_named_parts_is_not_empty():
    nodes = containers("<div class=widget>One part.</div><div class=promo>Two part.</div>")
    assert [text for text, _ in nodes[0].blocks] == ["One part.", "Two part."]
    assert _text("<div class=widget><a href=x>Only a link</a></div>") == "Only a link"


def test_what_stands_around_stays_hidden():
    for name in ("class='comments'", "id=sidebar", "role=complementary", "class='post-comments'"):
        assert _text(f"<div class=post>{PAGE}</div><div {name}>First! Nice one.</div>") == WANT
    # comments longer than their article
    assert _text(f"<article>{PAGE}</article><div class=comments>{'So true. ' * 60}</div>") == WANT
    assert _text(f"<div hidden>{PAGE}</div><p>Seen.</p>") == "Seen."
    assert _text(f"<div class=widget hidden>{PAGE}</div>") == ""


def test_names_that_may_be_about_the_content():
    assert _text(f"<article><p>{TEXT}</p><div class='share-price'>12.50 a share</div></article>") == f"{TEXT}\n12.50 a share"
    assert _text(f"<article><p>{TEXT}</p><p class='alert-story'>Sirens.</p><p id=discussion-paper-2>Text.</p></article>") == f"{TEXT}\nSirens.\nText."
    for name in ("share", "share-buttons", "social-links", "search-box", "post-comments", "ad-story", "related posts", "alert alert-box"):
        assert _text(f"<article><p>{TEXT}</p><div class='{name}'>Not this</div></article>") == TEXT, name


def test_a_name_does_not_hide_most_of_its_article():
    story = "A long story with many words in it. " * 3
    page = f"<article><p>Body</p><div class='widget'>{story}</div></article>"
    assert _text(page) == f"Body\n{story.strip()}"
    assert _text(f"<p>Top</p>{page}") == f"Body\n{story.strip()}"
    # two of them, neither of which is most of it
    half = f"<article><p>{TEXT}</p><div class=widget>{TEXT[:60]}</div><div class=ad>{TEXT[:60]}</div></article>"
    assert _text(half) == TEXT
    assert _text(f"<main><article><p>Body</p><div class=widget><div class=ad>{story}</div></div></article></main>") == f"Body\n{story.strip()}"
