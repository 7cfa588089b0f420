"""Blocks of pages whose silent elements are left open, are closed by a slash or only look like one."""

import pytest

from eventlake.llm import html_extract


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<html><head><meta charset=utf-8><title>T</title><script>x</script><body><article><p>One</p></article>", ["One"]),
        ("<head><title>T</title><p>One</p><p>Two</p>", ["One", "Two"]),
        ("<head><title>T<body><p>One</p>", ["One"]),
        ("<head><meta charset=utf-8>One", ["One"]),
        ("<p>A <svg class=i/> b</p><p>Two</p>", ["A b", "Two"]),
        ("<div><svg><path d=''></div><p>Two</p>", ["Two"]),
        ("<p>A <span><select><option>x</span> b</p>", ["A b"]),
        ("<svg><path><p>Two</p>", ["Two"]),
        ("<video-player><p>One</p></video-player><title-bar>Two</title-bar>", ["One", "Two"]),
        ("<p>If <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then</p>", ["If x=2 then"]),
        ("<p>A <object data=x>b</object> c</p>", ["A b c"]),
        ("<p>A <svg><title>no</title><g><text>no</text></g></svg> b <noscript><div>no</div></noscript> c</p>", ["A b c"]),
        ("<p>A</p><script>if (a < b) '<p>no</p>'</script ><style>no", ["A"]),
    ],
)
def test_silent_elements_end_where_their_parents_do(page, texts):
    assert [b.text for b in html_extract.blocks(page)] == texts
