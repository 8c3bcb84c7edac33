"""Pages with more open elements than are kept, and text of formulas and objects."""

import pytest

from conduit.llm import sitetree


@pytest.mark.parametrize("tag", ["div", "b", "span"])
def test_end_tags_beyond_the_limit_close_nothing_else(tag):
    deep = f"<{tag}>" * 600
    source = f"<body><article><div><p>one</p>{deep}<div><p>two</p><div class=menu><p>Menu</p></div></div>"
    source += f"</{tag}>" * 600 + "</div><p>three</p></article><p>outside</p></body>"
    assert sitetree.Page(source).text().split("\n") == ["one", "two", "three"]


def test_formulas_and_objects_keep_their_text():
    source = "<article><p>Let <math><mi>x</mi><annotation>tex</annotation></math> be.<object data=a><p>Shown instead</object></article>"
    assert sitetree.Page(source).text() == "Let x be.\nShown instead"


@pytest.mark.parametrize("source", ["<b>" * 30000 + "x</i>" * 20000, "<div>" * 20000 + "x</div>" * 20000, "<b><div>" * 600 + "<i>" * 20000 + "y</b>" * 20000])
def test_deep_pages_take_linear_time(source):
    assert isinstance(sitetree.Page(source).text(), str)
