"""Pages unlike the given ones: no article or main, telling names around or in the article."""

import pytest

from trackflow.llm.extraction import main_text


def paragraphs(name, n):
    return [f"{name}{i} " + "word " * 58 + "end." for i in range(n)]


def test_sections_in_plain_divs():
    first, second = paragraphs("a", 3), paragraphs("b", 4)
    parts = ["<section>" + "".join(f"<p>{t}</p>" for t in part) + "</section>" for part in (first, second)]
    menu = "<div>" + "".join(f"<p><a href=x>link {i}</a></p>" for i in range(9)) + "</div>"
    page = f"<html><body>{menu}<div id='content'>{''.join(parts)}</div>{menu}</body></html>"
    assert main_text(page) == "\n".join(first + second)


@pytest.mark.parametrize(
    "start, end",
    [
        ("<div class='layout has-sidebar'>", "</div>"),
        ("<div id='widget-area'>", "</div>"),
        ("<div class='sidebar'>", "</div>"),
        ("<form id='aspnetForm'>", "</form>"),
        ("<header>", "</header>"),
    ],
)
def test_wrappers_of_the_article_stay(start, end):
    want = paragraphs("a", 4)
    text = "".join(f"<p>{t}</p>" for t in want)
    for article in (f"<article>{text}</article>", f"<div>{text}</div>"):
        assert main_text(f"<html><body>{start}{article}{end}</body></html>") == "\n".join(want)


def test_named_parts_of_an_article():
    want = paragraphs("a", 4)
    links = "<section class='related'>" + "".join(f"<p><a href=x>more {i}</a></p>" for i in range(5)) + "</section>"
    advert = "<div class='ad'>Buy now, cheap as never before.</div>"
    page = (
        f"<article><p>{want[0]}</p>{advert}<p class='notice'>{want[1]}</p>"
        f"<section class='related'><p>{want[2]}</p></section>{links}<p>{want[3]}</p></article>"
    )
    assert main_text(f"<html><body>{page}</body></html>") == "\n".join(want)


def text_of(*want):
    return "".join(f"<p>{t}</p>" for t in want)


SAID = "I do not agree with any of this, as I have said many times before."


@pytest.mark.parametrize(
    "section",
    [
        f"<div class='comments'><p>{SAID}</p><p>{SAID}</p></div>",
        f"<div id='comments'><p>{SAID}</p></div>",
        f"<section class='comment-list'><article class='comment'><p>{SAID}</p></article><article class=comment><p>{SAID}</p></article></section>",
        f"<div class='cookie-banner'><p>{SAID}</p></div>",
        f"<div class='cookie'>{SAID}</div>",
        f"<div role='notice'>{SAID}</div>",
        f"<div id=disqus_thread>{SAID}</div>",
    ],
)
def test_comments_and_notices_go(section):
    """In an article, after it, and in a page without one."""
    want = paragraphs("a", 4)
    text = text_of(*want)
    for page in (f"<article>{text}{section}</article>", f"<article>{text}</article>{section}", f"{section}<div>{text}</div>"):
        assert main_text(f"<html><body>{page}</body></html>") == "\n".join(want)


def test_wrappers_named_after_comments_stay():
    want = paragraphs("a", 4)
    for name in ("has-comments", "post comments-open", "cookie-page"):
        for tag in ("article", "div"):
            page = f"<div class='{name}'><{tag}>{text_of(*want)}</{tag}></div>"
            assert main_text(f"<html><body>{page}</body></html>") == "\n".join(want)


@pytest.mark.parametrize(
    "unit, head, tail",
    [
        ("<a ", "", ""), ('<a title="x ', "", ""), ('<a title="x ', "", "<p>'>"), ('<a =">"', "", ""), ("<b>", "", "<p>x" * 20_000),
        ("<div>", "", "deep"), ("</script ", "<script>", ""), ("<b>", "<p><table><td>", "<div>x</div>" * 20_000),
        ("<article>", "", "<div class=x>y</div>" * 9000), ("<", "", ""), ("<!--", "", ""), ("</b>", "", ""), ("<b><i></b>", "", ""),
        ("<p class=comments>", "", ""), ("&amp", "<p>", ""), ("<li>", "<ul>", ""), ("<td>", "<table>", ""),
    ],
)
def test_hostile_pages_take_time_in_proportion(unit, head, tail):
    import time

    page = head + unit * (400_000 // len(unit)) + tail
    start = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - start < 15


def test_quotes_in_tags():
    assert main_text("<p title='a > b'>x</p><p title=don't>y</p><p \"odd>z</p>") == "x\ny\nz"
    assert main_text('<p title="never closed>x</p><p>y</p>') == "x\ny"
    assert main_text("<p>1 < 2 and </3 <3</p>") == "1 < 2 and </3 <3"
