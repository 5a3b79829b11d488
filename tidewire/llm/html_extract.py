"""Main-text extraction: flat text blocks, classified by a small decision tree.

A page is cut at block-level tags into flat blocks of text.  A block is described by
its number of words and its link density, those of the blocks before and after it,
and what its containers say of themselves (an article; a menu, an advert, comments).
A decision tree, grown here from the blocks of a few labelled pages, says which blocks are
main text.  Scripts, styles, forms' controls and comments of the markup never make blocks.

Pages are read whole, each by itself; nothing is shuffled.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names and the words by which sites name their containers.
#: Their text ends only with their end tag, or with the page.
_RAW = "script|style|title|textarea"
#: Skipped up to the end tag; without one only the tag itself is.
_SKIPPED = frozenset("noscript template svg math iframe object select button datalist canvas audio video".split())
_NESTING = frozenset("template svg math object canvas audio video".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr picture q rp rt ruby"
    " s samp small source span strike strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_FOREIGN_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
_MAIN_TAGS = frozenset("article main".split())
_COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond disqus discussion related recommended".split())
_FOREIGN_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation"
    " menu sidebar aside footer masthead topbar toolbar breadcrumb breadcrumbs pagination pager cookie cookies consent gdpr"
    " notice notification alert newsletter subscribe subscription signup login popup modal overlay share sharing social"
    " widget widgets tags toc copyright legal disclaimer skip search".split()
)
#: Words that say nothing of their own in a class like comment-list.
_FILLERS = frozenset("area bar block body box buttons container form group inner item items left links list outer posts right section site"
    " text top bottom wrap wrapper".split())  # fmt: skip
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)
_WORD = re.compile(r"[a-z]+")

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})(?=[\s/>])[^>]*(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>[^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)>"""
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.I | re.S,
)

_FORM_END, _ARTICLE = re.compile(r"</form\s*>", re.I), re.compile(r"<(?:article|main|h1)(?=[\s/>])", re.I)
_CONTROLS = frozenset("button select".split())
_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _SKIPPED}
_START = {tag: re.compile(rf"<{tag}(?=[\s/>])", re.I) for tag in _SKIPPED}


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    foreign: bool
    in_main: bool
    heading: bool
    named: int  #: the container that calls itself a menu, an advert, ... or 0


def _kind(tag: str, rest: str) -> tuple[bool, bool, bool]:
    """(foreign wherever it stands, foreign unless an article is inside, called so by its class, id or role)."""
    strong, named = tag in _FOREIGN_TAGS, False
    if rest and tag not in ("html", "body"):
        for m in _ATTRIBUTE.finditer(rest):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" and value.lower() != "false" or name == "style" and _UNSEEN.search(value):
                return True, True, False
            if name in ("class", "id", "role"):
                for token in value.lower().split():
                    words = set(_WORD.findall(token)) - _FILLERS
                    # a token that has other words too (has-sidebar) says nothing of this container
                    if words and words <= _COMMENT_WORDS | _FOREIGN_WORDS:
                        strong = strong or not words.isdisjoint(_COMMENT_WORDS)
                        named = True
    return strong, tag == "header", named


def _skipped_to(html: str, tag: str, at: int, missing: set[str]) -> int:
    """Where the element ends whose start tag ends at ``at``, or ``at`` if its end tag is missing."""
    if tag in missing:
        return at
    end = _END[tag].search(html, at)
    if end is None:
        missing.add(tag)
        return at
    if tag not in _NESTING:
        again = _START[tag].search(html, at, end.start())
        if again is not None:
            return at
    return end.end()


def _holds_article(html: str, at: int) -> bool:
    """Whether an element that is not nested, opened before ``at``, has an article or the heading of a page in it."""
    end = _FORM_END.search(html, at)
    return _ARTICLE.search(html, at, end.start() if end else len(html)) is not None


def blocks_of(html: str | None) -> list[Block]:
    """The non-empty blocks of a page, in page order."""
    out: list[Block] = []
    if not html:
        return out
    # open containers: (tag, foreign, foreign even for an article in it, in an article, heading, number of the named container)
    stack: list[tuple[str, bool, bool, bool, bool, int]] = [("", False, False, False, False, 0)]
    n_named = 0
    missing: set[str] = set()
    pieces: list[str] = []
    linked: list[str] = []
    in_link = 0

    def say(text: str) -> None:
        if text:
            text = entities.unescape(text) if "&" in text else text
            pieces.append(text)
            if in_link:
                linked.append(text)

    def close() -> None:
        if pieces:
            words = "".join(pieces).split()
            if words:
                _, foreign, _, main, heading, named = stack[-1]
                n_linked = min(len(words), sum(len(x.split()) for x in linked))
                out.append(Block(" ".join(words), len(words), n_linked, foreign, main, heading, named))
            pieces.clear()
            linked.clear()

    at = 0
    while m := _TOKEN.search(html, at):
        say(html[at : m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        ending = m["close"] or m["close2"]
        if tag in _SKIPPED:
            if not ending and not (m["rest"] or m["rest2"] or "").endswith("/"):
                at = _skipped_to(html, tag, at, missing)
            if tag in _CONTROLS:
                pieces.append(" ")  # it stands between what is before and behind it
            continue
        if tag == "a":
            in_link = 0 if ending else 1
        elif tag == "br":
            pieces.append(" ")
        if tag in _INLINE:
            continue
        close()
        in_link = 0
        if ending:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if depth:
                del stack[depth:]
            continue
        rest = m["rest"] or m["rest2"] or ""
        if tag in _VOID or rest.endswith("/"):
            continue
        if tag in ("p", *_HEADINGS, "li", "dt", "dd", "tr", "td", "th", "option") and stack[-1][0] in ("p", *_HEADINGS, tag):
            stack.pop()  # these end by themselves
        strong, weak, called = _kind(tag, rest)
        if tag == "form" and strong and _holds_article(html, at):
            strong = False  # the form of a whole page, as some servers make it
        _, foreign, surely, main, heading, named = stack[-1]
        n_named += called
        if tag in _MAIN_TAGS:
            # outside an article, only comments and the like say something of the article
            stack.append((tag, surely or strong or weak, surely or strong, True, heading, n_named if called else 0))
        else:
            weak = weak and not (tag == "header" and main)
            foreign = foreign or strong or weak
            named = named or (n_named if called else 0)
            stack.append((tag, foreign, surely or strong, main, heading or tag in _HEADINGS, named))
    say(html[at:])
    close()
    return out


#: Words of the named container of blocks that are in none: more than any has.
_UNNAMED = 1e9


def features(blocks: list[Block]) -> np.ndarray:
    """A row per block: words, link density, those of the block before and after, containers, heading, words and link density of a named container."""
    own = np.array([[b.words, b.link_words / b.words] for b in blocks], float).reshape(-1, 2)
    none = np.zeros((1, 2))
    says = np.array([[b.foreign, b.in_main, b.heading] for b in blocks], float).reshape(-1, 3)
    before, after = np.vstack([none, own])[:-1], np.vstack([own, none])[1:]
    named = np.array([b.named for b in blocks], int)
    words = np.bincount(named, [b.words for b in blocks])[named] if blocks else np.zeros(0)
    linked = np.bincount(named, [b.link_words for b in blocks])[named] if blocks else np.zeros(0)
    inside = named > 0
    held = np.column_stack([np.where(inside, words, _UNNAMED), np.where(inside, linked / np.maximum(words, 1), 0)])
    return np.hstack([own, before, after, says, held])


#: Labelled pages: blocks in [[ ]] are main text.
_LABELLED = (
    """<body><nav><ul><li><a href=/>Home</a><li><a href=/n>News</a><li><a href=/c>Contact us today</a></ul></nav>
    <div class=ad>Buy two pairs of shoes and get one for free this week only.</div>
    <article><h1>[[The river town rebuilds]]</h1><p>[[After the flood the people of the town came back and began to clear their
    houses, street by street, with the help of many others.]]</p><p>[[Why?]]</p><p>[[It took a year, and in the end nearly all of the
    shops on the square were open again, some of them under new names.]]</p><ul><li>[[Two bridges]]</li><li>[[One school]]</li></ul>
    <p>[[See <a href=/x>the full report</a> for more.]]</p>
    <p>[[<a href=/y>The council's own account of the night</a>]]</p>
    <div class="share">Share this on your favourite network with all your friends</div>
    <aside>Also read what we wrote about rivers in the year before this one.</aside></article>
    <section id=comments><p>I was there and I can tell you that it was much worse than this says.</p><p>Thanks!</p></section>
    <form><label>Your mail</label> <p>We send you one letter a week and nothing else</p></form>
    <footer>&copy; The Paper, all rights reserved, no copying without permission in writing.</footer></body>""",
    """<body><div><a href=/>Start</a> <a href=/a>About</a> <a href=/b>Blog</a></div><div>Search</div>
    <div><h2>[[How bread rises]]</h2><div>[[Yeast eats sugar and makes gas, and the gas is caught in the dough, which is why
    kneading matters so much for the crumb of a loaf.]]</div><div>[[Let it rest for an hour.]]</div><div>[[When you bake it the gas grows,
    the crust sets, and what remains is a light loaf with many small and some larger holes in it.]]</div></div>
    <div><a href=/1>Ten soups for winter</a></div><div><a href=/2>Knives that last</a></div><div>Imprint</div></body>""",
    """<body><header><h1><a href=/>Daily</a></h1><p>News for everyone since 1901</p></header><main><h1>[[Chess final ends in a draw]]</h1>
    <p>[[Neither player found a way through in a game of sixty moves, and both were content to share the point before the last day.]]</p>
    <p>[[A rematch follows.]]</p><div class="advertisement"><p>Our new phone has a camera that sees in the dark and a battery for two days.</p></div>
    <p>[[The winner meets the champion in spring.]]</p></main><div class=sidebar><p>Most read stories of the past week on our site</p>
    <a href=/q>Quiz of the day</a></div><div class="cookie-notice">We use cookies to make this site better for all of its readers.</div></body>""",
    """<body><table><tr><td><a href=/>Index</a></td><td><a href=/o>Older</a> <a href=/n>Newer</a></td></tr></table>
    <p>[[This is an old page, written by hand, about the birds of the marsh, which I have counted each spring for twenty years.]]</p>
    <p>[[Herons: nine pairs.]]</p><p>[[There were more of them when I began, but the reeds have been cut since then, and they nest
    further up the river <a href=/m>(map)</a> now.]]</p><p><a href=/g>Guestbook</a> | <a href=/m>Mail me</a></p></body>""",
    """<body><main><article><header><h1>[[Rain]]</h1><p>[[By a reporter]]</p></header><p>[[It rained.]]</p><p>[[And then it rained again for most of
    the week, so that the match was called off and the lawns were closed.]]</p><p>[[More.]]</p></article>
    <div class=comments><article><p>Here it was dry all week, I don't know where you live.</p></article></div></main>
    <nav><a href=/p>Previous story</a><a href=/q>Next story about something else</a></nav><footer><p>Contact</p></footer></body>""",
    """<body><div class="post tags"><h2>[[A shed from old doors]]</h2><p>[[My neighbour threw out eleven doors when the school was rebuilt, and I have made
    a shed of them that has stood through two winters without a leak.]]</p><p>[[Measure first.]]</p><p>[[Set four posts a metre deep, and then hang the doors
    between them, so that each wall can <a href=/t>be opened</a> on a hot day.]]</p></div>
    <div class="widget sidebar"><p>Doors and windows of the month, chosen by our readers out of all that were sent in</p>
    <p><a href=/1>How to choose a hinge that does not squeak in the cold months of the year</a></p><p><a href=/2>Paint for wood that has been outside for
    more than a winter or two already</a></p><p><a href=/3>The tools that we would buy again and those that we would not</a></p><p>Archive</p></div>
    <div class="cookie-banner"><p>We and our partners store small files on your device to show you offers; you can refuse them at any time.</p><p>Accept</p></div></body>""",
    """<body><main><div class="post tags"><h1>[[Night train]]</h1><p>[[The train left the border station at two in the morning with nine people in a sleeping car that had been
    built for sixty, and none of us slept, because the guard told stories of the line until it was light.]]</p><p>[[He was born on it.]]</p><p>[[By noon the hills had
    gone, the fields were flat, and the nine of us had shared all the bread and most of the cheese that we had brought.]]</p></div>
    <div class="promo"><p>Our book of forty journeys by rail is out now in all good shops.</p></div></main>
    <aside><p>The writer has lived in five countries and has written for this magazine since the year in which it was founded, mostly on trains, ships, and the
    people who work on them, but now and then also on food.</p></aside>
    <section id=comments><p>I took the same train with my father when I was a child, and I remember that guard or one who was very much like him, he had a dog in his
    cabin and gave us all tea in tin cups.</p></section><div hidden><p>This browser is too old to show the map of the line, please use a newer one or turn on the scripts of this
    site in the settings of your browser and load the page again.</p></div><footer><p>Published by the travel press, all rights in texts and pictures reserved; no part may be
    copied, stored or sent on in any form without the written leave of the publisher, whose address is below.</p></footer></body>""",
)


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of the labelled pages."""
    x, y = [], []
    for page in _LABELLED:
        marked = blocks_of(page)
        y += ["[[" in b.text for b in marked]
        x.append(features(blocks_of(page.replace("[[", "").replace("]]", ""))))
    return np.vstack(x), np.array(y)


@cache
def decision_tree(max_depth: int = 6) -> tuple:
    """A tree of (feature, limit, below or at, above) with booleans as leaves, grown by Gini impurity."""

    def gini(y: np.ndarray) -> float:
        p = y.mean() if len(y) else 0.0
        return 2 * p * (1 - p) * len(y)

    def grow(x: np.ndarray, y: np.ndarray, depth: int):
        if depth == 0 or y.all() or not y.any():
            return bool(y.mean() >= 0.5)
        best = (gini(y) - 1e-9, None, None)
        for j in range(x.shape[1]):
            values = np.unique(x[:, j])
            for limit in (values[1:] + values[:-1]) / 2:
                low = x[:, j] <= limit
                best = min(best, (gini(y[low]) + gini(y[~low]), j, limit), key=lambda b: b[0])
        _, j, limit = best
        if j is None:
            return bool(y.mean() >= 0.5)
        low = x[:, j] <= limit
        return (j, float(limit), grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1))

    # what is foreign for certain stays so; blocks in a named container and all others have a tree each
    x, y = labelled_table()
    sure, named = x[:, 6] > 0.5, x[:, 9] < _UNNAMED
    trees = [grow(x[rows], y[rows], max_depth - 2) for rows in (named & ~sure, ~named & ~sure)]
    return (6, 0.5, (9, _UNNAMED / 2, *trees), False)


def is_main(row: list[float], tree) -> bool:
    while tree is not True and tree is not False:
        j, limit, low, high = tree
        tree = low if row[j] <= limit else high
    return tree


def main_text(html: str | None, tree) -> str:
    """The main blocks joined by line breaks; empty if there are none."""
    blocks = blocks_of(html)
    rows = features(blocks).tolist() if blocks else []
    return "\n".join(b.text for b, row in zip(blocks, rows, strict=True) if is_main(row, tree))


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per row of ``pages``: id, url, text, n_chars (code points).

    A null page and one without main text give the empty text; repeated rows give
    a row each; an empty table gives no rows.  Pages are read whole however long they are; markup that is not closed
    ends with the page (scripts, styles), or is taken as if it were not there (buttons and the like); elements of unknown names, also
    those whose names begin like others (title-bar, button-group), are containers like any other.
    """
    tree = decision_tree()
    schema = pages.select(id_col, url_col).schema.add("text", T.StringType()).add("n_chars", T.LongType())
    names = schema.names

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                texts = [main_text(h, tree) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                    names,
                )

    return pages.select(F.col(id_col), F.col(url_col), F.col(html_col)).mapInArrow(run, schema)
