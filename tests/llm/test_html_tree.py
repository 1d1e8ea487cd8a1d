"""The tree on pages it was not grown on, and pages of any depth in linear time."""

from __future__ import annotations

import html as plain
import random
import re
import time

import pyarrow.parquet as pq
import pytest

from tallyhouse.llm import html

WORDS = "some plain words of a text that goes on and on with more of them until it is long enough to be read as one".split()


def words(n: int, mark: str, stop: bool = True) -> str:
    return " ".join([mark, *(WORDS[i % len(WORDS)] for i in range(n - 1))]) + ("." if stop else "")


# Blocks marked + belong to the article. A number is a count of words; a star stands for text without a full stop.
UNSEEN_PAGES = (
    "<header><h2>-3*</h2><nav><a>-1*</a><a>-2*</a></nav></header><main><article><h1>+8*</h1><p>+55</p><p>+4</p><p>+17</p><p><a>+7</a></p></article></main><aside><p>-14</p></aside><footer><p>-9</p></footer>",
    "<div class='nav-menu'><a>-1*</a><a>-1*</a><a>-1*</a></div><div id='main-content'><h1>+6*</h1><p>+23</p><div class='social-study'><p>+24</p></div><p class='related-work'>+24</p><div class='ad-free-experience'><p>+24</p></div></div><div class='sidebar widget'><p>-13</p></div>",
    "<article><h1>+5*</h1><p>+12</p><section><h2>+2*</h2><p>+31</p><p>+9</p></section><div class='share-buttons'><a>-1*</a><a>-1*</a></div></article><div>-40</div><div class=comments-list><p>-22</p><p>-7</p></div>",
    "<h1>+4*</h1><p>+9</p><p>+8</p><p>+6</p>",
    "<ul><li><a>-1*</a><li><a>-2*</a><li><a>-1*</a></ul><h1>+7*</h1><p>+15</p><p>+21</p><p>+8</p><p>+33</p><div>-3*</div><div><a>-2*</a></div>",
    "<table><tr><td><a>-1*</a><td><a>-1*</a></table><h2>+5*</h2><p>+27</p><p>+44</p><blockquote>+19</blockquote><p>+12</p>",
    "<div><a>-2*</a></div><div><p>+36</p><p>+20</p><p>+11</p></div><div><a>-3*</a> <a>-2*</a></div>",
    "<div class=content><ul><li><a>+4*</a><li><a>+3*</a><li><a>+5*</a></ul><p>+10</p></div><nav><a>-2*</a></nav>",
    "<div class=cookie-banner><p>-16</p></div><div class='post entry'><h1>+6*</h1><p>+18</p><p>+2</p><form><label>-2*</label></form><p>+26</p></div><div id=footer><p>-11</p></div>",
    "<main><h1>+9*</h1><p>+3</p><div>+21</div><aside>-8</aside><ul><li>+5<li>+11</ul></main><div class=newsletter-signup><p>-12</p></div>",
)


def labelled(page: str) -> str:
    return re.sub(r"([+-])(\d+)(\*?)", lambda m: words(int(m[2]), "kept" if m[1] == "+" else "gone", not m[3]), page)


def test_precision_and_recall_on_unseen_pages():
    right = kept = wanted = 0
    for page in UNSEEN_PAGES:
        found = html.main_text(labelled(page)).split("\n\n")
        kept += sum(bool(text) for text in found)
        right += sum(text.startswith("kept") for text in found)
        wanted += page.count("+")
    assert right / kept > 0.95 and right / wanted > 0.95, (right, kept, wanted)


def test_link_density_and_neighbours_decide():
    """Splits of the dealt features come before those of names, and change decisions on pages without names."""
    used = set()

    def visit(node):
        if not isinstance(node, int):
            used.add(html.FEATURES[node[0]])
            visit(node[2])
            visit(node[3])

    visit(html.tree())
    assert html.FEATURES[html.tree()[0]] in ("links", "words") and used & {"words_before", "links_before", "words_after", "links_after"}
    # The same short block between paragraphs, and last, after them.
    page = labelled("<p>+30</p><div>+12</div><p>+28</p><div>-12</div>")
    assert html.main_text(page).count("kept") == 3 and "gone" not in html.main_text(page)
    linked = labelled("<p>+30</p><p>+28</p><p><a>-3*</a></p>")
    assert "gone" not in html.main_text(linked) and html.main_text(linked).count("kept") == 2


def random_page(rng: random.Random) -> str:
    """A page with or without names of regions; blocks of the article are marked + as above."""
    named = rng.random() < 0.6
    menu = "".join(f"<li><a>-{rng.randint(1, 3)}*</a>" for _ in range(rng.randint(2, 8)))
    shapes = ("<nav><ul>{}</ul></nav>", "<div class=menu><ul>{}</ul></div>") if named else ("<ul>{}</ul>",)
    out = [rng.choice(shapes).format(menu), f"<div class=ad>-{rng.randint(2, 7)}</div>" if named and rng.random() < 0.3 else ""]
    article = [f"<h1>+{rng.randint(3, 10)}*</h1>"]
    for _ in range(rng.randint(2, 12)):
        kind = rng.random()
        if kind < 0.8 or not named:
            article.append(f"<p>+{rng.randint(1 if named else 4, 70)}</p>")
        elif kind < 0.88:
            article.append("<ul>" + "".join(f"<li>+{rng.randint(1, 14)}" for _ in range(rng.randint(2, 5))) + "</ul>")
        elif kind < 0.94:
            article.append(f"<p><a>+{rng.randint(2, 9)}*</a></p>")
        else:
            article.append(f"<aside>-{rng.randint(4, 20)}</aside>")
    shapes = ("<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>", "<div id=main-content>{}</div>") if named else ("<div>{}</div>",)
    out.append(rng.choice(shapes).format("".join(article)))
    if named and rng.random() < 0.5:
        out.append("<div class=comments>" + "".join(f"<p>-{rng.randint(3, 40)}</p>" for _ in range(rng.randint(1, 5))) + "</div>")
    if rng.random() < 0.5:
        out.append(f"<div><a>-{rng.randint(1, 3)}*</a> <a>-2*</a></div>")
    if rng.random() < 0.7:
        out.append(f"<footer>-{rng.randint(2, 12)}*</footer>" if named else f"<div>-{rng.randint(2, 5)}*</div>")
    return "<body>" + "".join(out) + "</body>"


def test_precision_and_recall_on_random_pages():
    rng = random.Random(11)
    right = kept = wanted = 0
    for _ in range(400):
        page = random_page(rng)
        found = [text for text in html.main_text(labelled(page)).split("\n\n") if text]
        kept += len(found)
        right += sum(text.startswith("kept") for text in found)
        wanted += page.count("+")
    assert right / kept > 0.98 and right / wanted > 0.98, (right, kept, wanted)


def expected_article(page: str) -> str:
    """The article of a given page, read by its own layout: every tag but b and br parts blocks."""
    article = re.search(r"<article>(.*?)</article>", re.sub(r"(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>", "", page), re.S)
    if not article:
        return ""
    blocks = re.split(r"</?(?!b>|br>)[a-z0-9]+[^>]*>", article[1].replace("<br>", " "))
    texts = [" ".join(plain.unescape(re.sub(r"<[^>]+>", "", block)).split()) for block in blocks]
    return "\n\n".join(text for text in texts if text)


def test_given_pages_give_their_whole_articles():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"])["html"].to_pylist()
    assert [html.main_text(page) for page in pages] == [expected_article(page) for page in pages]


@pytest.mark.parametrize(
    "page",
    ["<div>x" * 100_000, "<p>" + "<b>x</i>" * 100_000, "<a>" * 100_000 + "</p>" * 1000, "<template>" * 50_000 + "</div>" * 50_000, "<article><ul>" + "<li><div class=ad><p>y" * 30_000],
)
def test_deep_pages_are_read_in_linear_time(page):
    begin = time.process_time()
    html.main_text(page)
    assert time.process_time() - begin < 8
