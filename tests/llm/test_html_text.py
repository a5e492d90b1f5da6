from __future__ import annotations

import html
import random
import time

import pytest

from leaseload.llm import html_text

ARTICLE = "<article><h1>Title</h1><p>First &amp; second.</p><p>Short.</p></article>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        (None, ""),
        (f"<html><head><title>T</title></head><body><nav>Menu</nav>{ARTICLE}<footer>&copy; x</footer></body></html>",
         "Title First & second. Short."),
        ("<article><p>a<b>b</b>c <i>d</i><br>e</p></article>", "abc d e"),
        ("<article><p><b>Open.<br><p>Next.</article><footer>no</footer>", "Open. Next."),
        ("<article><p>cut off in the mid", "cut off in the mid"),
        ("<article><p>x</p><script>var a='</p>';</script><style>p{}</style><!-- c --><p>y</p></article>", "x y"),
        ("<article><p>x</p><div class='ad'>Buy</div><section id=\"comments\"><p>First!</p></section><p>y</p></article>", "x y"),
        ("<div class=sidebar><article>teaser</article></div><main><p>real</p><form><p>Mail?</p></form></main>", "real"),
        ("<header><h1>Site</h1></header><article><header><h1>Head</h1></header><p>t</p></article>", "Head t"),
        ("<article><p hidden>no</p><p style='display: none'>no</p><p>&lt;yes&gt; &#233;&nbsp;\n\t z</p></article>", "<yes> é z"),
        ("<article><p title='a > b'>x</p><ul><li><a href=1>one</a></li><li>two</li></ul></article>", "x two"),
        ("no tags at all", ""),
        # Names that only hold a word of something beside the text.
        ("<article><div class='post has-comments'><p>x</p></div><p class='social-history'>y</p></article>", "x y"),
        ("<article><div class='comments-area'>no</div><div class='ad-300x250'>no</div><p>x</p><div id=site_footer>no</div></article>", "x"),
        # Quotes and values as the rules of the markup read them.
        ("<article><p data-x=it's>one</p><p>it's two</p></article>", "one it's two"),
        ('<article><p title="5" tall">x</p></article>', "x"),
        ("<article><p a = 'b>c' d=\"e>f\" hidden2 g/>x</p><p =x=>y</p><p/>z</article>", "x y z"),
        ("<article><p>a < b <3 c<</p><p>x</p><p title='never closed>y</p></article>", "a < b <3 c< x"),
        # Drawings, embedded parts, comments.
        ("<article><svg><text>no</text><p>x</p><p>y</p></article>", "x y"),
        ("<article><object>no<object>no</object>no</object><p>x</p><select><option>no</select><p>y</p></article>", "x y"),
        ("<article><p>x<!-- a > b --!>y<!doctype z>z<?php a ?></p><!-- open <p>no</p></article>", "xyz"),
        ("<article><script>if (a</b) 1</SCRIPT ><p>x</p><title>no</title></article>", "x"),
    ],
)
def test_marked_articles(page, text):
    assert html_text.main_text(page) == text


def test_pages_without_an_article():
    long = "This is the text of a page that has no mark for its main part, and it is long enough to be decided."
    page = f"""<body><div><a href=1>Home</a> <a href=2>News</a></div><h2>Head of it</h2><p>{long}</p><p>Short one.</p>
        <p>{long}</p><div>buy cheap watches online today discount price offer best quality fast shipping worldwide now!!</div>
        <p>far</p></body>"""
    assert html_text.main_text(page) == f"Head of it {long} Short one. {long}"


def test_table(spark):
    rows = [(1, "u", ARTICLE, "x"), (1, "u", ARTICLE, "x"), (None, None, None, "x"), (3, "v", "<p>" + "word and the " * 40_000, "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = sorted(((r.page_id, r.url, r.text[:20], len(r.text)) for r in html_text.extracted(pages).collect()), key=repr)
    assert found == sorted(
        [(1, "u", "Title First & second", 28)] * 2 + [(None, None, "", 0), (3, "v", "word and the word an", 519_999)], key=repr
    )
    assert html_text.extracted(pages.filter("false")).count() == 0


@pytest.mark.parametrize("piece", ['<p title="', "<p title='", "<", "<!--", "<a b", "</", "<p a=b ", "<svg>", "<b>", "<script>", "<li><ul>"])
def test_broken_markup_takes_linear_time(piece):
    took = []
    for size in (125_000, 1_000_000):
        page = "<article><p>x</p>" + piece * (size // len(piece))
        begin = time.perf_counter()
        assert html_text.main_text(page).startswith("x")
        took.append(time.perf_counter() - begin)
    assert took[1] < 24 * took[0] + 0.5, took


def test_scripts_without_stop_words():
    for long in ("Это текст страницы без особой разметки, и он достаточно длинный, чтобы его можно было узнать. " * 2, "这是一个没有标记的页面的正文,它足够长,可以被识别出来。" * 5):
        page = f"<body><div><a href=1>Меню</a></div><p>{long}</p><div class='comments'><p>{long}</p></div></body>"
        assert html_text.main_text(page) == " ".join(long.split())


def test_a_name_does_not_condemn_a_whole_page():
    assert html_text.main_text("<body><div class='widget'><article><p>All there is.</p></article></div></body>") == "All there is."


def plain(tree):
    """What a reading of a small well-formed page gives: texts of its article's blocks."""
    tag, children = tree
    if tag in ("nav", "script"):
        return []
    out, line = [], ""
    for child in children:
        if isinstance(child, str):
            line += child
        elif child[0] in ("b", "i"):
            line += "".join(child[1])
        else:
            out += [line, *plain(child)]
            line = ""
    return [x for x in [*(" ".join(o.split()) for o in out), " ".join(line.split())] if x]


def test_random_small_pages():
    rng = random.Random(3)
    words = ["a", " b ", "&amp;", "x y", "é", "\n", "1 &lt; 2"]

    def made(depth):
        tag = rng.choice(["div", "p", "section", "nav", "blockquote"]) if depth else "article"
        children = []
        for _ in range(rng.randrange(1, 5)):
            kind = rng.random()
            if kind < 0.5 or depth > 2:
                children.append(rng.choice(words))
            elif kind < 0.7:
                children.append((rng.choice("bi"), [rng.choice(words)]))
            elif tag != "p":
                children.append(made(depth + 1))
        return tag, children

    def spelled(tree):
        tag, children = tree
        return f"<{tag}{rng.choice(['', ' data-a=1', ' title=\"x > y\"'])}>" + "".join(c if isinstance(c, str) else spelled(c) for c in children) + f"</{tag}>"

    for _ in range(300):
        tree = made(0)
        page = f"<html><body><nav>menu</nav>{spelled(tree)}<footer>f</footer></body></html>"
        assert html_text.main_text(page) == html.unescape(" ".join(plain(tree))), page
