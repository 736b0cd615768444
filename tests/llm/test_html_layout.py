"""Layout classes of elements that hold the page's text."""

import pytest

from cardlake.llm import html_text


@pytest.mark.parametrize("tag, end", [('<body class="has-sidebar">', "</body>"), ('<main id="nav-page">', "</main>"),
                                      ('<article class="post with-comments">', "</article>")])
def test_layout_classes_of_whole_pages(tag, end):
    text = "The council met on Monday and spoke for hours about the new bridge over the river. " * 3
    found = html_text.blocks(f"<html>{tag}<p>{text}</p><div class=sidebar>other</div>{end}</html>")
    assert [b[4] > 0 for b in found] == [True, False]
