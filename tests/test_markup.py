import random
from html.parser import HTMLParser

import pytest

from lodestone.operators import markup


class Plain(HTMLParser):
    """The standard parser, reduced to tags with attributes and text."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.out = []

    def handle_starttag(self, tag, attrs):
        seen = {}
        for k, v in attrs:
            seen.setdefault(k, v or "")
        self.out.append(("open", tag, seen))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.out.append(("close", tag))


def tags(html):
    out = []
    for kind, name, text, _ in markup.tokens(html):
        if kind == "open":
            out.append(("open", name, markup.attributes(text)))
        elif kind == "close":
            out.append(("close", name))
    return out


CASES = [
    "<p class=a id='b' data-x=\"c>d\" hidden>x</p>", "<META content='a, b' NAME=keywords>", "<div><p>one<p>two<div>three</div>", "a < b and c > d <b>bold</b>", "<a href=x/y?q=1&amp;r=2>t</a><br/><img src='i.png' />",
    "<!-- <p>no</p> --><p title='it&#39;s'>yes</p>", "<!DOCTYPE html><html lang=de-DE><body>x", "<ul><li>a<li>b</ul>", "<p\n  id = \"n\"\n>multi</p>",
]


@pytest.mark.parametrize("html", CASES)
def test_tags_are_those_of_the_standard_parser(html):
    plain = Plain()
    plain.feed(html)
    plain.close()
    assert tags(html) == plain.out


def test_generated_markup_agrees_with_the_standard_parser():
    r = random.Random(1)
    for _ in range(200):
        parts = []
        for _ in range(r.randrange(1, 30)):
            quote = r.choice(["'", '"', ""])
            value = r.choice(["v", "w-1", "x y>z" if quote else "q"])
            parts.append(r.choice([f"<{r.choice(['p', 'DIV', 'h2', 'span'])} {r.choice(['a', 'B-c'])}={quote}{value}{quote} d>", "</p>", "</DIV>", "text &amp; more ", "<!-- c > -->", "<br/>", "1 < 2 "]))
        html = "".join(parts)
        plain = Plain()
        plain.feed(html)
        plain.close()
        assert tags(html) == plain.out


def test_facts_in_any_order_and_quoting():
    html = """<HTML class=x lang='fr-CA'><head><script>var a = "<title>no</title>";</script><title>A &amp; B
      C</title><meta content="first" name='Description'><meta name=description content=second><meta name="keywords" content='k1, k2'></head>
      <body onload="x > y"><style>p {}</style><p>One<b>two</b><script>if (a < b) {}</script>&lt;3<textarea>typed</textarea></body></html>"""
    got = markup.page_facts(html)
    assert got == {"title": "A & B C", "description": "first", "keywords": "k1, k2", "lang": "fr-CA", "preview": "One two <3 typed"}
    assert markup.page_facts("") == {"title": None, "description": None, "keywords": None, "lang": None, "preview": ""}
    assert markup.page_facts("<title>open <p>and")["title"] == "open <p>and"
    assert markup.page_facts("no markup at all")["preview"] == "no markup at all"
    assert len(markup.page_facts("<body>" + "<p>word " * 10_000)["preview"]) == 500


def test_stray_openings_take_linear_time():
    assert list(markup.tokens("<a " * 20_000))[-1][0] == "text"
    assert markup.page_facts("<b '" * 20_000)["title"] is None


def test_blocks_carry_their_headings():
    html = "<head><title>t</title></head><h1>Top</h1>intro<h2>Sub</h2><p>a <i>b</i></p><ul><li>c<li>d</ul><h2>Next</h2><p>e"
    assert [(p, t) for p, t, _ in markup.html_blocks(html)] == [((), "Top"), (("Top",), "intro"), (("Top",), "Sub"), (("Top", "Sub"), "a b"), (("Top", "Sub"), "c"), (("Top", "Sub"), "d"), (("Top",), "Next"), (("Top", "Next"), "e")]
    text = "# Top\nintro\nmore\n\n## Sub\n\nbody\n\n# Other\nend"
    assert [(p, t, text[o : o + 2]) for p, t, o in markup.text_blocks(text)] == [((), "# Top", "# "), (("Top",), "intro\nmore", "in"), (("Top",), "## Sub", "##"), (("Top", "Sub"), "body", "bo"), ((), "# Other", "# "), (("Other",), "end", "en")]


def test_chunks_hold_all_words_within_the_budget(spark):
    r = random.Random(4)
    word = lambda: r.choice(["alpha", "beta", "gamma.", "delta", "end!"])
    docs = []
    for k in range(30):
        parts = []
        for _ in range(r.randrange(0, 12)):
            parts.append(r.choice(["# Head", "## Deeper head", "### Figure"]) if r.random() < 0.3 else " ".join(word() for _ in range(r.choice([1, 5, 30, 200]))))
        docs.append((k, "\n\n".join(parts)))
    docs += [(100, None), (101, ""), (102, "  \n \n")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got: dict = {}
    for c in markup.chunk_documents(df, least=20, most=50).collect():
        got.setdefault(c.doc_id, []).append(c)
    assert not {100, 101, 102} & got.keys()
    for k, text in docs:
        rows = sorted(got.get(k, []), key=lambda c: c.chunk)
        assert [c.chunk for c in rows] == list(range(len(rows)))
        assert all(0 < c.tokens <= 50 and c.tokens == len(c.text.split()) for c in rows)
        assert [c.offset for c in rows] == sorted(c.offset for c in rows)
        left = iter(" ".join(c.text for c in rows).split())
        assert all(w in left for w in (text or "").split())  # all words of the document, in order
    page = [(1, "<h1>A</h1><p>" + "word " * 80 + "</p><p>tail</p>")]
    html = markup.chunk_documents(spark.createDataFrame(page, "page_id long, html string"), "page_id", "html", "html", 5, 40).collect()
    assert all(c.tokens <= 40 for c in html) and sum(c.text.count("word") for c in html) == 80
