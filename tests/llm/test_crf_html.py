import html
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import crf_html, queries
from tidemark.llm.crf_html import Field

STOCK = [
    ["The river runs past the old mill, and nobody knows why it was left there.", "A second paragraph says a little more. It ends here.", "Short one."],
    ["Prices rose again in spring, as they had in the year before.", "Experts disagree on what that means for the small towns along the coast, which live by fishing."],
]


@pytest.fixture(scope="module")
def field():
    return Field.fit(crf_html.training_pages([]))


def score(field, x, labels):
    own = x @ field.weights
    return sum(own[i] for i, y in enumerate(labels) if y) + sum(field.pairs[a, b] for a, b in zip(labels, labels[1:]))


def test_viterbi_and_likelihood_by_enumeration():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7):
        field = Field(rng.normal(size=len(crf_html.FEATURES)), rng.normal(size=(2, 2)))
        x = (rng.random((n, len(crf_html.FEATURES))) < 0.3).astype(float)
        every = list(itertools.product((0, 1), repeat=n))
        scores = np.array([score(field, x, y) for y in every])
        assert tuple(field.decode(x)) == every[int(scores.argmax())]
        labels = np.array(every[len(every) // 2])
        value, by_weight, by_pair = field.likelihood(x, labels)
        assert value == pytest.approx(score(field, x, labels) - np.logaddexp.reduce(scores))
        p = np.exp(scores - np.logaddexp.reduce(scores))
        marginal = sum(q * np.array(y) for q, y in zip(p, every))
        assert by_weight == pytest.approx(x.T @ (labels - marginal))
        pairs = np.zeros((2, 2))
        for q, y in zip([*-p, 1.0], [*every, tuple(labels)]):
            for a, b in zip(y, y[1:]):
                pairs[a, b] += q
        assert by_pair == pytest.approx(pairs)


def test_blocks():
    page = (
        "<p>a &amp; b&eacute;<br>c\n  <b>d</b>e<p>f<ul><li>x<li>y</ul><script>var t='</p>'</script><style>p{}</style>"
        "<!-- no --><div>g<p>h</div><noscript>z</noscript>i &lt"
    )
    assert [b.text for b in crf_html.blocks_of(page)] == ["a & bé c de", "f", "x", "y", "g", "h", "i <"]
    assert crf_html.blocks_of("") == []


def test_laid_out_pages(field):
    rng = random.Random(5)
    right = 0
    for _ in range(200):
        page, body = crf_html.laid_out(rng.choice(STOCK), rng)
        right += crf_html.main_text(page, field) == "\n".join(" ".join(t.split()) for t in body)
    assert right >= 150


def test_article_without_the_rest(field):
    page = (
        '<body><nav><a href="/">Home</a> <a href="/x">News</a></nav><div class="cookie-notice">We use cookies, please agree.</div>'
        f"<article><h1>The old mill by the river</h1><p>{STOCK[0][0]}</p><p>{STOCK[0][1]}</p></article>"
        f'<div class="comments"><p>I do not agree with this at all, said one reader, and went on.</p></div>'
        '<aside class="sidebar"><p>Related: another mill was sold last week for much less.</p></aside>'
        "<form><p>Subscribe to our letter and never miss a story.</p></form><footer>&copy; the paper</footer></body>"
    )
    assert crf_html.main_text(page, field) == "\n".join(["The old mill by the river", *STOCK[0][:2]])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<", ">", "<!--", "-->", "<![", "<!", "&", "&#x", "&amp;", "text ", "<div class=", '"ad"', "</", "<script>", "</script>", "<li>", "é", "\n", "<?", "]]>", "<article>"]), max_size=25).map("".join))
def test_any_markup_is_read(page):
    for b in crf_html.blocks_of(page):
        assert b.text and b.text == " ".join(b.text.split())


def test_frame(spark, field):
    long = "<article>" + f"<p>{STOCK[0][0]}</p>" * 20_000 + "</article>"
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(1, "u", None, "c"), (1, "u", None, "c"), (2, None, "", "c"), (None, "v", long, "c"), (4, "w", deep, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string")
    found = sorted(crf_html.extract(pages, field).collect(), key=lambda r: r.page_id or 0)
    assert [(r.page_id, r.url) for r in found] == [(None, "v"), (1, "u"), (1, "u"), (2, None), (4, "w")]
    assert found[0].text.count("\n") == 19_999 and all(r.n_chars == len(r.text) for r in found)
    assert [r.text for r in found[1:4]] == ["", "", ""]
    assert crf_html.extract(pages.limit(0), crf_html.fit(pages.limit(0))).count() == 0


def test_query(spark, sf_dir):
    rows = {r.page_id: r for r in queries.QUERIES["op10_crf_main_text"](spark, sf_dir).collect()}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for page in pages:
        inner = re.search("<article>(.*?)</article>", page.html, re.S)[1].replace("<br>", " ")
        blocks = [html.unescape(re.sub("<[^>]*>", "", x)) for x in re.split("</?(?:p|h1)>", inner)]
        expected = "\n".join(" ".join(b.split()) for b in blocks if b.strip())
        assert (rows[page.page_id].url, rows[page.page_id].text) == (page.url, expected)
