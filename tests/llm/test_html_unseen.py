"""Main text beside unseen elements: scripts in heads, heads without an end, elements that are never closed, math."""

from __future__ import annotations

import pytest

from tallyhouse.llm import html

ARTICLE = "<article><h1>A title of a page</h1><p>The first sentence of it is here.</p></article>"
TEXT = "A title of a page\n\nThe first sentence of it is here."

WHOLE = {
    "quotes of a script": '<html><head><script>for(i=0;i<a.length;i++)d.write("hello world")</script></head><body class="x">',
    "apostrophe of a comment": "<html><head><script>if(a<b){} // it's <c\n</script><style>/* plain */</style></head><body class='x'>",
    "end tag in a title": "<html><head><title>About </head> and <body></title></head><body>",
    "no end of the head, no body": "<html><head><meta charset=utf-8><title>T</title>\n",
    "no head at all": "<title>T</title>",
    "picture for pages without scripts": "<html><head><noscript><img src=x></noscript><link rel=x></head>",
    "page in a head": "<html><head><html lang=en><title>T</title>",
    "unclosed before a landmark": "<body><svg><path d='M0'>",
    "unclosed, another one closed": "<body><button>Menu",
    "unclosed in an element": "<body><div><svg><g></div>",
    "unclosed in a link": "<body><nav><a href=x><svg><path></a></nav>",
    "closed with elements of its name": "<body><template><template><p>gone</p></template><article><p>Gone as well.</p></article></template>",
    "closed around an end tag": "<body><div><noscript></div><p>Please enable scripts here.</p></noscript></div>",
    "slash inside a drawing": "<body><svg><title/><style/><path d=x/></svg>",
    "title inside a drawing": "<body><svg><title>Icon's</svg>",
    "frame without an end": "<body><div><iframe src=x /></div>",
    "longer name": "<head><script>'</scripts>'</script></head>",
}


@pytest.mark.parametrize("case", WHOLE)
def test_article_after_unseen_elements(case):
    after = "<svg></svg><button>More</button><script>last('</p>')</script><!-- 5\" --><!-- isn't -->"
    assert html.main_text(WHOLE[case] + ARTICLE + after) == TEXT


def test_text_after_an_open_head():
    blocks = [text for text, _, _ in html.flat_blocks("<html><head><title>T</title><base href=x> Plain <b>text</b>")]
    assert blocks == ["Plain text"]


def test_math_is_text():
    page = "<article><h1>On energy</h1><p>We know <math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><mspace/><annotation>E=mc^2</annotation></math> for long.</p></article>"
    assert html.main_text(page) == "On energy\n\nWe know E=mc2 for long."


def test_unseen_elements_are_read_in_linear_time():
    page = "<svg><article>" * 20000 + "<iframe/>" * 20000 + "<p>It is whole.</p>"
    assert html.flat_blocks("<div></div>" + page)[-1][0] == "It is whole."
