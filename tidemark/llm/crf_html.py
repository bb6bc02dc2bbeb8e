"""Main text of web pages: a linear-chain conditional random field over leaf blocks.

A page is cut into leaf blocks, the runs of text between block tags, each with the tags and names
of its ancestors. A field with two labels, text and boilerplate, scores a page's labels by features
of each block (ancestor tags and names, lengths, links, marks) and by pairs of neighbouring labels.
It is trained on labelled pages by maximum likelihood and decoded by Viterbi.

Labelled pages: pages whose own marks tell the label of every block (an article or main element
with headers, menus and the like around it), taken from the table, and pages laid out by rule from
their blocks, in which the marks are varied or left out. In training, ancestor features are hidden
from some pages, so that pages without such marks are judged by the rest.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, whole

#: Elements that begin and end blocks, that hold no text, and that hold no content.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot "
    "th thead title tr ul".split()
)
HIDDEN_TAGS = frozenset("script style noscript template svg math iframe object canvas head title textarea select button datalist".split())
EMPTY_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A new one of these ends an open one.
_SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Parts of class, id and role names that tell what an element is for.
NAMES = {
    "ad": "ad ads advert advertisement banner sponsor sponsored promo",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc",
    "side": "sidebar aside related widget teaser",
    "frame": "header footer masthead copyright legal",
    "comment": "comment comments reply replies disqus discussion respondents",
    "notice": "notice cookie cookies consent popup modal alert newsletter subscribe gdpr",
    "form": "form search login signup",
    "body": "article content post entry story main text body",
}
_NAME_OF = {word: kind for kind, words in NAMES.items() for word in words.split()}
_BOILERPLATE_TAGS = frozenset("nav footer header aside form menu dialog".split())
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w+")


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]  # ancestors, outermost first
    kinds: frozenset[str]  # what class, id and role names of ancestors tell
    linked: int  # characters inside links


class _Blocks(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self._open: list[tuple[str, frozenset[str]]] = []
        self._text: list[str] = []
        self._hidden = self._links = self._linked = 0
        self._kept: tuple | None = None

    def _end_block(self) -> None:
        text = _SPACE.sub(" ", "".join(self._text)).strip()
        if text:
            tags, kinds = self._kept or ((), frozenset())
            self.blocks.append(Block(text, tags, kinds, self._linked))
        self._text, self._linked, self._kept = [], 0, None

    def _pop(self) -> None:
        tag, _ = self._open.pop()
        self._hidden -= tag in HIDDEN_TAGS
        self._links -= tag == "a"

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK_TAGS:
            self._end_block()
        elif tag == "br":
            self.handle_data(" ")
        if tag in EMPTY_TAGS:
            return
        if tag in ("body", "article", "main") and self._hidden:  # an element without end before the page's text
            while self._open and self._hidden:
                self._pop()
        closes = _SELF_CLOSING.get(tag)
        if closes:
            for back in range(len(self._open) - 1, -1, -1):
                other = self._open[back][0]
                if other in closes:
                    while len(self._open) > back:
                        self._pop()
                    break
                if other in BLOCK_TAGS:
                    break
        names = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role"))
        kinds = frozenset(_NAME_OF[w] for w in re.split(r"[^a-z]+", names.lower()) if w in _NAME_OF) if names else frozenset()
        self._open.append((tag, kinds))
        self._hidden += tag in HIDDEN_TAGS
        self._links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in EMPTY_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK_TAGS:
            self._end_block()
        for back in range(len(self._open) - 1, -1, -1):
            if self._open[back][0] == tag:
                while len(self._open) > back:
                    self._pop()
                break
            if self._open[back][0] in ("article", "main", "body", "td") and tag not in ("html", "body"):
                break  # a stray end does not close what is around it

    def handle_data(self, data):
        if self._hidden:
            return
        if self._kept is None and data.strip():
            tags = tuple(t for t, _ in self._open if t in BLOCK_TAGS)
            self._kept = (tags, frozenset().union(*[k for _, k in self._open]))
        self._text.append(data)
        if self._links:
            self._linked += len(data.strip())

    def parse_html_declaration(self, i):
        # marked sections are read as browsers do: skipped up to the next >
        if self.rawdata.startswith("<![", i):
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)


def blocks_of(html: str) -> list[Block]:
    """Leaf blocks in page order: character references decoded, white space made single spaces."""
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser._end_block()
    return parser.blocks


FEATURES = (
    "bias", "in_article", "outside_article", "in_boilerplate_tag", "in_list", "heading", "paragraph", "table", "div_leaf",
    *[f"name_{k}" for k in NAMES], "short", "medium", "long", "linked", "half_linked", "ends_sentence", "commas",
    "copyright", "bar", "first", "last", "after_long", "before_long",
)
_AT = {name: i for i, name in enumerate(FEATURES)}
_MARKED = [_AT[n] for n in ("in_article", "outside_article", "in_boilerplate_tag", *[f"name_{k}" for k in NAMES])]


def features(blocks: list[Block]) -> np.ndarray:
    """(blocks, FEATURES) of 0 and 1, with some graded ones."""
    x = np.zeros((len(blocks), len(FEATURES)))
    words = [len(_WORD.findall(b.text)) for b in blocks]
    marked = any("article" in b.tags or "main" in b.tags for b in blocks)
    for i, (b, n) in enumerate(zip(blocks, words)):
        row = x[i]
        leaf = b.tags[-1] if b.tags else ""
        on = ["bias"]
        if "article" in b.tags or "main" in b.tags:
            on.append("in_article")
        elif marked:
            on.append("outside_article")
        if _BOILERPLATE_TAGS & set(b.tags):
            on.append("in_boilerplate_tag")
        if "li" in b.tags or "dl" in b.tags:
            on.append("in_list")
        if leaf in ("h1", "h2", "h3", "h4", "h5", "h6"):
            on.append("heading")
        if leaf in ("p", "pre", "blockquote"):
            on.append("paragraph")
        if "table" in b.tags:
            on.append("table")
        if leaf == "div":
            on.append("div_leaf")
        on += [f"name_{k}" for k in b.kinds]
        on.append("short" if n < 8 else "medium" if n < 25 else "long")
        share = b.linked / max(1, len(b.text))
        if share > 0.8:
            on.append("linked")
        elif share > 0.3:
            on.append("half_linked")
        if b.text[-1] in ".!?…\"'»”":
            on.append("ends_sentence")
        if "," in b.text:
            on.append("commas")
        if "©" in b.text or "all rights reserved" in b.text.lower():
            on.append("copyright")
        if " | " in b.text or " · " in b.text:
            on.append("bar")
        if i == 0:
            on.append("first")
        if i == len(blocks) - 1:
            on.append("last")
        if i and words[i - 1] >= 25:
            on.append("after_long")
        if i + 1 < len(blocks) and words[i + 1] >= 25:
            on.append("before_long")
        row[[_AT[f] for f in on]] = 1
    return x


@dataclass
class Field:
    """Weights of a block's features for the label text, and of pairs of neighbouring labels."""

    weights: np.ndarray
    pairs: np.ndarray  # (2, 2): label, next label

    def scores(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The likeliest labels of a page, by Viterbi; ties go to boilerplate."""
        n = len(x)
        if not n:
            return np.zeros(0, int)
        own = self.scores(x)
        best = np.array([0.0, own[0]])
        back = np.zeros((n, 2), int)
        for i in range(1, n):
            ways = best[:, None] + self.pairs
            back[i] = ways.argmax(axis=0)
            best = ways.max(axis=0) + np.array([0.0, own[i]])
        labels = np.zeros(n, int)
        labels[-1] = int(best[1] > best[0])
        for i in range(n - 1, 0, -1):
            labels[i - 1] = back[i, labels[i]]
        return labels

    def likelihood(self, x: np.ndarray, labels: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Log likelihood of a page's labels, and its gradient by weights and by pairs."""
        n, own = len(x), self.scores(x)
        node = np.column_stack([np.zeros(n), own])
        ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
        ahead[0] = node[0]
        for i in range(1, n):
            ahead[i] = np.logaddexp(*(ahead[i - 1][:, None] + self.pairs)) + node[i]
        for i in range(n - 2, -1, -1):
            behind[i] = np.logaddexp(*(self.pairs + (node[i + 1] + behind[i + 1])[None, :]).T)
        total = np.logaddexp(*ahead[-1])
        marginal = np.exp(ahead[:, 1] + behind[:, 1] - total)
        score = own @ labels + self.pairs[labels[:-1], labels[1:]].sum()
        both = np.exp(ahead[:-1, :, None] + self.pairs + (node[1:] + behind[1:])[:, None, :] - total).sum(axis=0)
        seen = np.zeros((2, 2))
        np.add.at(seen, (labels[:-1], labels[1:]), 1)
        return float(score - total), x.T @ (labels - marginal), seen - both

    @classmethod
    def fit(cls, pages: list[tuple[np.ndarray, np.ndarray]], rounds: int = 20, rate: float = 0.5, penalty: float = 1e-3, seed: int = 3) -> Field:
        """Maximum likelihood by stochastic gradient steps with per-weight rates."""
        field = cls(np.zeros(len(FEATURES)), np.zeros((2, 2)))
        seen_w, seen_p = np.full(len(FEATURES), 1e-8), np.full((2, 2), 1e-8)
        rng = random.Random(seed)
        order = [i for i, (x, _) in enumerate(pages) if len(x)]
        for _ in range(rounds):
            rng.shuffle(order)
            for i in order:
                _, by_weight, by_pair = field.likelihood(*pages[i])
                by_weight = by_weight / len(pages[i][0]) - penalty * field.weights
                by_pair = by_pair / len(pages[i][0]) - penalty * field.pairs
                seen_w += by_weight**2
                seen_p += by_pair**2
                field.weights += rate * by_weight / np.sqrt(seen_w)
                field.pairs += rate * by_pair / np.sqrt(seen_p)
        return field


def marked_labels(blocks: list[Block]) -> np.ndarray | None:
    """Labels that a page's own marks give, None if it has no article or main element."""
    inside = [("article" in b.tags or "main" in b.tags) for b in blocks]
    if not any(inside) or all(inside):
        return None
    out = {"ad", "menu", "side", "comment", "notice", "form"}
    return np.array([int(i and not _BOILERPLATE_TAGS & set(b.tags) and not out & b.kinds) for i, b in zip(inside, blocks)])


def laid_out(texts: list[str], rng: random.Random) -> tuple[str, list[str]]:
    """A page laid out by rule around the given texts, and the blocks of its article."""
    few = lambda n: " ".join(rng.choice(texts).split()[:n]) or "more"
    link = lambda: f'<a href="/x">{few(rng.randrange(1, 4))}</a>'
    menu = "".join(f"<li>{link()}</li>" for _ in range(rng.randrange(3, 9)))
    word = lambda kind: rng.choice(NAMES[kind].split())
    parts = {
        "menu": rng.choice([f"<nav><ul>{menu}</ul></nav>", f'<div class="{word("menu")}"><ul>{menu}</ul></div>', f"<ul>{menu}</ul>"]),
        "head": rng.choice([f"<header><div>{few(4)}</div></header>", f'<div id="{word("frame")}">{few(4)}</div>']),
        "ad": rng.choice([f'<div class="{word("ad")}">{few(9)}</div>', f'<aside class="{word("ad")}"><p>{few(9)}</p></aside>']),
        "side": rng.choice([f"<aside><h3>{few(2)}</h3><ul>{menu}</ul><p>{few(30)}</p></aside>", f'<div class="{word("side")}"><p>{few(25)}</p></div>']),
        "notice": f'<div class="{word("notice")}"><p>{few(12)}</p><button>ok</button></div>',
        "form": f'<form><label>{few(2)}</label><input><p>{few(8)}</p></form>',
        "comments": f'<section class="{word("comment")}"><h3>{few(2)}</h3>' + "".join(f"<div><b>{few(1)}</b><p>{few(40)}</p></div>" for _ in range(rng.randrange(1, 5))) + "</section>",
        "foot": rng.choice([f"<footer>&copy; {few(2)} &middot; {few(10)}</footer>", f'<div class="{word("frame")}"><p>&copy; {few(8)}</p></div>']),
    }
    body = [t for t in texts if t.split()][: rng.randrange(1, 12)] or ["more text"]
    title = few(8)
    inner = f"<h1>{title}</h1>" + "".join(f"<p>{t}</p>" for t in body)
    article = rng.choice(["<article>{}</article>", "<main>{}</main>", f'<div class="{word("body")}">{{}}</div>', "<div>{}</div>"]).format(inner)
    before = [parts[k] for k in ("head", "menu", "notice", "ad") if rng.random() < 0.7]
    after = [parts[k] for k in ("ad", "side", "form", "comments", "foot") if rng.random() < 0.6]
    rng.shuffle(before)
    return "<html><body>" + "".join(before) + article + "".join(after) + "</body></html>", [title, *body]


#: Paragraphs to lay out where the table has no marked page.
STOCK = [
    ["A page has some text, and this is a part of it that says a little more than a menu does.", "It goes on for a while.", "Then it stops."],
    ["Rain fell for three days, so the road to the village was closed until the water went down again.", "Nobody minded much."],
    ["First come the numbers, then what they mean, and at last why anyone should care about them at all.", "See below!", "Not yet."],
]


def training_pages(pages: list[str], seed: int = 11) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of the marked pages and of pages laid out from their blocks."""
    rng, out, stock = random.Random(seed), [], []
    for html in pages:
        blocks = blocks_of(html)
        labels = marked_labels(blocks)
        if labels is None:
            continue
        own = [b.text.replace("<", " ").replace("&", " ") for b, y in zip(blocks, labels) if y]
        stock.append(own)
        out.append((features(blocks), labels))
    stock = stock or STOCK
    for _ in range(max(500, len(out))):
        html, body = laid_out(rng.choice(stock), rng)
        blocks = blocks_of(html)
        start = next((i for i in range(len(blocks)) if [b.text for b in blocks[i : i + 1]] == [" ".join(body[0].split())] and _fits(blocks, i, body)), None)
        if start is not None:
            labels = np.zeros(len(blocks), int)
            labels[start : start + len(body)] = 1
            out.append((features(blocks), labels))
    for k, (x, labels) in enumerate(out):
        if k % 4 == 3:  # without marks
            x = x.copy()
            x[:, _MARKED] = 0
            out[k] = (x, labels)
    return out


def _fits(blocks: list[Block], start: int, body: list[str]) -> bool:
    return [b.text for b in blocks[start : start + len(body)]] == [" ".join(t.split()) for t in body]


def fit(pages: DataFrame, html_col: str = "html", sample_rows: int = 600, longest: int = 50_000) -> Field:
    """A field trained on at most ``sample_rows`` different pages of at most ``longest`` characters, chosen by a hash.

    The bounds hold for training alone. A table without marked pages trains on laid out pages. The
    tasks report hashes; only the chosen pages themselves reach the driver.
    """
    own = pages.select(F.col(html_col).cast("string").alias("html")).filter(F.length("html").between(1, longest))
    own = own.withColumn("h", F.xxhash64("html"))
    hashes = [r["h"] for r in own.select("h").distinct().orderBy("h").limit(sample_rows).collect()]
    chosen = own.filter(F.col("h").isin(hashes)).groupBy("h").agg(F.min("html").alias("html"))
    return Field.fit(training_pages([r["html"] for r in sorted(chosen.collect())]))


def main_text(html: str, field: Field) -> str:
    blocks = blocks_of(html)
    labels = field.decode(features(blocks))
    return "\n".join(b.text for b, y in zip(blocks, labels) if y)


def extract(pages: DataFrame, field: Field, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row from its whole html.

    Null and empty html give an empty text. A page is read by itself: repeated rows give equal
    texts; ties of two labellings go to boilerplate. Malformed, unfinished and very long pages are
    read to their end, in time proportional to their length. Other columns are not read; an empty
    table gives an empty result.
    """
    sent = pages.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [main_text(h, sent.value) for h in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), whole(F.col(html_col)).alias("text"))
    kinds = [own.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    found = own.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
