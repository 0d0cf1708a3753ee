import pytest

from corpuslake import constants as C
from corpuslake.functions.html import compile_selector, page_text

TITLES = tuple(map(compile_selector, C.TITLE_SELECTORS))
BODIES = tuple(map(compile_selector, C.BODY_SELECTORS))


def text(html, titles=TITLES, bodies=BODIES):
    return page_text(html, titles, bodies)


def test_missing_html_has_no_title_prefix():
    assert text(None) == text("") == ("Title not found", "Main content not found")


def test_nothing_found():
    assert text("<p>x</p>")[1] == "Title not found Main content not found"


def test_title_without_body():
    assert text("<h2> T </h2>") == ("T", "T Main content not found")


def test_preferred_selectors_win_over_earlier_elements():
    html = (
        '<h2>first</h2><h2 class="a documentFirstHeading">second</h2>'
        '<div id="content-core">core</div><div id="parent-fieldname-text">field</div>'
    )
    assert text(html) == ("second", "second field")


def test_fallback_selectors():
    assert text('<h2>a</h2><h2>b</h2><div id=content-core>x</div>') == ("a", "a x")


def test_tags_leave_no_gap_and_scripts_no_text():
    html = (
        '<h2>t</h2><div id="content-core"><p>a</p><p>b</p><script>var s="</p>";</script>'
        "<style>p{}</style> c <!-- no -->\n d</div>"
    )
    assert text(html) == ("t", "t ab c d")


def test_nested_same_tag_and_unclosed_inner_tags():
    html = '<section><div id="content-core">a<div>b<b>c</div>d</section>e</div>'
    assert text(html)[1] == "Title not found abcd"


def test_stray_end_tag_is_ignored():
    assert text('<div id="content-core">a</span>b</p>c</div>d')[1] == "Title not found abc"


def test_void_and_self_closing_tags():
    html = '<div id="content-core">a<br>b<br/>c<img src=x>d<hr></hr>e<i/>f</div>g'
    assert text(html)[1] == "Title not found abcdef"


def test_entities():
    html = '<div id="content-core">&lt;a&gt; &amp;amp; &#65;&#x42; &eacute;&nbsp;&middot; &#150; &unknown; &</div>'
    assert text(html)[1] == "Title not found <a> &amp; AB é · – &unknown &"


def test_title_keeps_inner_line_breaks():
    assert text("<h2> a\n b </h2>")[0] == "a\n b"


def test_unclosed_page():
    assert text('<h2>t</h2><div id="content-core">a<p>b')[1] == "t ab"


def test_bad_selector():
    with pytest.raises(ValueError):
        compile_selector("div > p")
