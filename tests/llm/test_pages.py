"""The page reader loses no text and takes linear time."""

import time

import pytest

from sitescore.llm.html_text import leaf_blocks


def texts(page):
    return [b.text for b in leaf_blocks(page)]


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p title=it's>One here.</p><p>This isn't two</p>", ["One here.", "This isn't two"]),
        ("<!--><p>a b</p><!-- x --><p>c</p>", ["a b", "c"]),
        ("<!---><p>a</p><!-- q --!><p>b</p>", ["a", "b"]),
        ("<p>The text <button>Share</button> goes on.</p>", ["The text goes on."]),
        ('a < b <p x="1>2" y = \'3>4\'>c</p>', ["a < b", "c"]),
        ('<p a="x>y</p><p>z</p>', ["y", "z"]),
        ("<p>one<p>two<ul><li>three<li>four</ul>", ["one", "two", "three", "four"]),
        ("", []),
        ("no tag at all", ["no tag at all"]),
    ],
)
def test_text_stays(page, want):
    assert texts(page) == want


@pytest.mark.parametrize(
    "page",
    ['<p a="x"' * 130_000, '<p a="x"' * 130_000 + '<p a=">"', "<div>x" * 150_000, "<div>" * 50_000 + "</x>" * 100_000, "<p>it<b>" * 60_000, "<!" * 500_000],
    ids=["open tags", "end inside quotes", "nested", "strange ends", "open inline", "declarations"],
)
def test_linear(page):
    start = time.perf_counter()
    leaf_blocks(page)
    assert time.perf_counter() - start < 15


def test_paths_and_links():
    first, second = leaf_blocks('<div class="main7"><div class="main8"><p>go <a href=x>there</a></p></div></div><nav><a>home</a></nav>')
    assert first.path == ("div main 0", "p") and first.linked == 5
    assert second.path == ("nav",) and second.linked == 4
