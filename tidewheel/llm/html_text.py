"""Main text of web pages by a maximum-scoring subsequence of words and tags.

A page is a sequence of tokens: words and tags. Words score positive and tags negative, by weights that come from labelled
pages: for each kind of token the smoothed log-odds of standing in the content. A word's kind is what surrounds it (plain
text, link, boilerplate element), a tag's kind is its role (inline, paragraph, list, structure, boilerplate); the weights are trained until the scan finds the
labelled regions. One linear scan
(Kadane's) finds the best contiguous region; blocks of the region that lie in menus, notices, adverts, forms or reader
comments are left out, the rest are the text.

Every page is scanned whole. Where a page marks articles, the story stands in them or they are cards beside it: the side whose
own best region scores higher is the story's, a word in an article counting as much more as labelled pages tell. Text of the
other side scores like boilerplate. If the story is in articles, what lies between them costs nothing and is left out.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import table, utf8

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden|aria-label|style)\b\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
#: Elements whose content is no text of the page.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math object canvas audio video select datalist head".split())
UNTIL_CLOSED = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr basefont keygen".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br input".split())
BOILERPLATE = frozenset("nav footer aside form button menu dialog fieldset".split())
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figcaption dd dt".split())
LIST = frozenset("ul ol li dl table thead tbody tfoot tr td th caption figure".split())
#: Words of a class or id that tell of boilerplate, those that only tell where or what shape, and those that tell of content.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu topbar toolbar breadcrumb breadcrumbs crumbs "
    "sidebar aside rail widget widgets complementary footer foot contentinfo copyright masthead siteheader header cookie cookies consent gdpr notice notices notification alert popup modal "
    "overlay lightbox paywall comment comments commentlist discussion disqus respond replies reply reviews form search searchbox login signup subscribe subscription newsletter share sharing "
    "social follow related recommended recommendations trending popular tags tagcloud pagination pager skip hidden".split()
)
NEUTRAL = frozenset(
    "left right top bottom upper lower side main site page web global primary secondary box bar area block wrap wrapper wrap container section sections region holder list links link item items "
    "button buttons btn icon icons slot unit inner outer sticky fixed row col column group panel pane thread feed posts post stories more by on the to for your you may also like only print sr "
    "is has mobile desktop bs s".split()
)
CONTENT = frozenset("content article story body text".split())
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
GLUED = re.compile(r"(side|nav|menu|cookie|comment|advert|banner|footer|share|social|related|newsletter|subscribe|popup)(bars?|box|list|section|area|block|wrap|wrapper|container|thread|notice|form|links|posts|ment)")
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
CONTENT_ROLES = frozenset(("main", "article"))
CLOSES_P = PARAGRAPH | LIST | BOILERPLATE | frozenset("div section article main header hr address details summary center".split())


class Piece:
    """A token: a tag, or text that stands in one block and one surrounding."""

    __slots__ = ("kind", "words", "text", "block", "bad", "article")

    def __init__(self, kind: str, words: int, text: str, block: int, bad: bool, article: int):
        self.kind, self.words, self.text, self.block, self.bad, self.article = kind, words, text, block, bad, article


def boilerplate_name(name: str) -> bool:
    """Whether a class or id names boilerplate: each of its words does or says only where it stands. One such word among others tells nothing."""
    words = [w.lower() for w in PARTS.findall(name)]
    told = [w in HINTS or bool(GLUED.fullmatch(w)) for w in words]
    return any(told) and all(t or w in NEUTRAL for t, w in zip(told, words, strict=True))


def hinted(attributes: str) -> tuple[bool, bool, str]:
    """(whether the element is hidden or has a role of boilerplate, whether its names tell of boilerplate, the role)."""
    bad, named, content, role = False, False, False, ""
    for name, double, single, bare in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), double or single or bare
        if name == "role":
            role = value.strip().lower()
            bad |= role in BAD_ROLES
        elif name in ("class", "id"):
            for word in value.split():
                named |= boilerplate_name(word)
                parts = {w.lower() for w in PARTS.findall(word)}
                content |= bool(parts & CONTENT) and parts <= CONTENT | NEUTRAL
        elif name == "itemprop":
            bad |= value.strip().lower() == "comment"
        elif name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true"):
            bad = True
        elif name == "style":
            bad |= bool(HIDDEN.search(value))
    return bad, named and not content, role


class Open:
    """The elements that are open at a place of a page; each question takes constant time, however deep they are nested."""

    ROOT = ("", False, 0, False, False, -1, "body")

    def __init__(self):
        self.stack: list[tuple] = []  # name, boilerplate, article number, raw, in a link, last block element, nearest of body, main and article
        self.places: defaultdict[str, list[int]] = defaultdict(list)

    @property
    def top(self) -> tuple:
        return self.stack[-1] if self.stack else self.ROOT

    def push(self, name: str, bad: bool, article: int, raw: bool) -> None:
        above, k = self.top, len(self.stack)
        self.places[name].append(k)
        self.stack.append((name, bad, article, raw, above[4] or name == "a", above[5] if name in INLINE else k, name if name in ("article", "main", "body") else above[6]))

    def nearest(self, *names: str) -> int:
        """Place of the innermost open element of these names, -1 without one."""
        return max((self.places[n][-1] for n in names if self.places[n]), default=-1)

    def cut(self, depth: int) -> None:
        """Close all elements from a place on."""
        while len(self.stack) > depth:
            self.places[self.stack.pop()[0]].pop()

    def close(self, name: str) -> None:
        """A closing tag: ends the nearest element of its name; an inline one doesn't reach beyond its block."""
        depth = self.nearest(name)
        if depth >= 0 and (name not in INLINE or self.top[5] < depth):
            self.cut(depth)

    def make_way(self, name: str) -> None:
        """What an opening tag ends without a closing one: a paragraph, the item or cell before it."""
        if name in CLOSES_P:
            depth = self.nearest("p")
            if depth >= 0 and self.top[5] == depth:
                self.cut(depth)
        if name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            same = ("dt", "dd") if name in ("dt", "dd") else ("td", "th") if name in ("td", "th") else (name,)
            depth = self.nearest(*same)
            if depth > self.nearest("ul", "ol", "table", "dl"):
                self.cut(depth)


def tokens(page: str) -> Iterator[Piece]:
    """Tokens of a page in order. Copes with unclosed and wrongly nested elements, in time linear in the page."""
    elements = Open()
    block, at, articles, n = 0, 0, 0, len(page)

    def told(text: str) -> Iterator[Piece]:
        _, bad, article, raw, linked, _, _ = elements.top
        if text and not raw:
            text = html.unescape(text)
            words = len(text.split())
            yield Piece("word:bad" if bad else "word:link" if linked else "word", words, text, block, bad, article)

    while at < n:
        tag = TOKEN.search(page, at)
        if not tag:
            yield from told(page[at:])
            return
        yield from told(page[at : tag.start()])
        at = tag.end()
        closing, name, attributes = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        if not name:
            if tag[0].startswith("<![CDATA["):
                yield from told(html.escape(tag[0][9:].removesuffix("]]>"), quote=False))
            continue
        name = name.lower()
        inline = name in INLINE
        if name == "br":
            yield from told(" ")
        if closing:
            if name == "br":
                continue
            elements.close(name)
        else:
            elements.make_way(name)
            _, bad, article, raw, _, _, outer = elements.top
            hidden, named, role = hinted(attributes) if attributes else (False, False, "")
            main = name in ("article", "main") or role in CONTENT_ROLES
            bad = bad or name in BOILERPLATE or hidden or (named and name not in ("body", "html", "main")) or (name == "header" and outer == "body")
            if main and not article and not bad:
                articles += 1
                article = articles
            if name in UNTIL_CLOSED:
                at = re.compile(rf"</{re.escape(name)}\s*>|\Z", re.I).search(page, at).end()
            elif name not in VOID and not attributes.rstrip().endswith("/"):
                elements.push(name, bad, article, raw or name in RAW)
        if not inline:
            block += 1
        now = elements.top
        kind = "tag:bad" if now[1] else "tag:inline" if inline else "tag:paragraph" if name in PARAGRAPH else "tag:list" if name in LIST else "tag:structure"
        yield Piece(kind, 0, "", block, now[1], now[2])


#: Labelled pages: (markup, whether it is content), in page order. What is boilerplate inside content counts as content here, as a region is contiguous.
LABELLED = (
    (("<nav><ul><li><a href=x>Home</a></li><li><a href=x>News of today</a></li></ul></nav><div class=ad>Buy one and get one now</div>", False),
     ("<article><h1>A long day by the river</h1><p>The boat left before anyone was awake and came back late with nets that were <b>empty</b>.</p><p>Nobody asked why it had gone so far, and so the story stayed untold for years.</p><p>Then, short.</p></article>", True),
     ("<footer>Copyright by the people of the river</footer>", False)),
    (("<div id=header><a href=x>Site</a> <a href=x>Login</a></div><div class=sidebar><ul><li><a href=x>Read this next</a></li></ul></div>", False),
     ("<div class=content><h2>Growing beans</h2><p>Beans want warm soil, some water and a stick to climb, and <a href=x>not much else</a>.</p><ul><li>Sow them in May when the nights are mild.</li><li>Pick them young, for they turn hard.</li></ul><p>That is all there is to it, whatever the books say about the moon.</p></div>", True),
     ("<div id=comments><p>Great post, thank you!</p><p>I do it in April.</p></div><form><p>Your name</p><input></form><div class=footer>Imprint</div>", False)),
    (("<table><tr><td><a href=x>Index</a></td><td><a href=x>Archive</a></td></tr></table><div class='cookie-notice'>We use cookies on this site. Accept all of them?</div>", False),
     ("<p>It rained for a week, and the road to the mill was gone when we got up on the eighth day.</p><blockquote>Water keeps what it takes</blockquote><p>said the miller, who had lost two roads that way before and did not seem to mind a third.</p>", True),
     ("<aside>More stories for you</aside><div><a href=x>Next</a> <a href=x>Previous</a></div>", False)),
    (("<header><div class=logo><a href=x>The Paper</a></div></header>", False),
     ("<div><h1>The bridge</h1><p>It was built twice, and fell down once.</p><div class=ad>Cheap shoes here</div><p>Nobody was on it.</p><aside><a href=x>More on bridges</a></aside><p>They say that the third one will be made of stone from the old quarry, if the money lasts.</p></div>", True),
     ("<ul><li><a href=x>One</a></li><li><a href=x>Two</a></li></ul><p>Imprint</p>", False)),
)

#: Labelled pages on which articles stand beside other text: they tell how much more a word in an article counts.
MARKED = (
    (("<article><h2>The last ferry</h2><p>It left the pier at nine with two cars and a dog, and nobody saw the lights go out behind the island.</p><p>In the morning the dog was back.</p></article>", True),
     ("<div><p>I was there and it was foggy.</p><p>Me too, what a night!</p></div>", False)),
    (("<article><h3>Ten soups</h3><p>Warm and quick.</p></article><article><h3>A new mill</h3><p>Opens in June.</p></article>", False),
     ("<div><h1>Snow in the valley</h1><p>The pass was closed on Friday, and the school with it, for the first time in eleven years.</p></div>", True)),
)


def best_region(scores: list[float]) -> tuple[int, int]:
    """The contiguous region of the highest sum, by one scan; the longest of equal ones, (0, 0) if none is above 0."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for k, score in enumerate(scores):
        if total < 0:
            total, start = 0.0, k
        total += score
        if total > best or (total == best and best > 0 and k + 1 - start > span[1] - span[0]):
            best, span = total, (start, k + 1)
    return span


KINDS = ("word", "word:link", "word:bad", "tag:inline", "tag:paragraph", "tag:list", "tag:structure", "tag:bad")
#: Bounds of the weights: plain words score positive, tags and boilerplate negative.
LEAST, MOST = {"word": 0.1}, {k: -0.05 for k in KINDS if k.startswith("tag") or k == "word:bad"}


def learned(pages=LABELLED, marked=MARKED, rounds: int = 500, step: float = 0.02, margin: float = 0.2) -> dict[str, float]:
    """Weight of each kind of token from labelled pages, a plain word having 1.

    They start as smoothed log-odds of content and are then trained as the scan uses them: where the best region of a page,
    with `margin` a word against the labelled one, isn't the labelled region, weights move toward the tokens of that and away
    from those of the best. 'article': what a word in an article counts against one outside, 1 at least.
    """
    sides = {(side, content): 0.5 for side in (True, False) for content in (True, False)}
    for page in marked:
        for markup, content in page:
            for piece in tokens(markup):
                sides[bool(piece.article), content] += piece.words
    share = {side: sides[side, True] / (sides[side, True] + sides[side, False]) for side in (True, False)}
    labelled = [[(piece, content) for markup, content in page for piece in tokens(markup)] for page in pages]
    size = lambda piece: piece.words if piece.text else 1
    counts = [Counter(), Counter()]
    for page in labelled:
        for piece, content in page:
            counts[content][piece.kind] += size(piece)
    outside, inside = counts
    odds = {k: math.log((inside[k] + 0.5) / sum(inside.values())) - math.log((outside[k] + 0.5) / sum(outside.values())) for k in KINDS}
    held = lambda k, v: min(max(v, LEAST.get(k, v)), MOST.get(k, max(v, LEAST.get(k, v))))
    weights = {k: held(k, v) for k, v in odds.items()}
    for _ in range(rounds):
        moved = False
        for page in labelled:
            against = [weights[piece.kind] * size(piece) + (-margin if content else margin) * piece.words for piece, content in page]
            first, last = best_region(against)
            wrong = Counter()
            for k, (piece, content) in enumerate(page):
                if content != (first <= k < last):
                    wrong[piece.kind] += size(piece) if content else -size(piece)
            if any(content != (first <= k < last) and piece.words for k, (piece, content) in enumerate(page)):
                moved = True
                weights = {k: held(k, v + step * wrong[k]) for k, v in weights.items()}
        if not moved:
            break
    return {k: v / weights["word"] for k, v in weights.items()} | {"article": max(1.0, share[True] / share[False])}


WEIGHTS = learned()


def blocks_of(pieces: list[Piece]) -> list[str]:
    found: list[str] = []
    last, held = None, []
    for piece in [*pieces, None]:
        if piece is None or (piece.text and not piece.bad and piece.block != last):
            if held and (text := " ".join("".join(held).split())):
                found.append(text)
            held = []
            last = piece.block if piece else None
        if piece and piece.text and not piece.bad:
            held.append(piece.text)
    return found


def scored(pieces: list[Piece], weights: dict[str, float]) -> list[float]:
    return [weights[p.kind] * (p.words if p.text else 1) for p in pieces]


def extract(page: str, weights: dict[str, float] = WEIGHTS) -> list[str]:
    """The blocks of a page's main text."""
    pieces = list(tokens(page))
    scores = scored(pieces, weights)
    marked = [k for k, p in enumerate(pieces) if p.article]
    inside = False
    if marked:
        own, rest = [scores[k] for k in marked], [s for s, p in zip(scores, pieces) if not p.article]
        (a, b), (c, d) = best_region(own), best_region(rest)
        inside = b > a and weights["article"] * sum(own[a:b]) >= sum(rest[c:d])
        for k, piece in enumerate(pieces):
            if inside and not piece.article:
                scores[k] = 0.0 if marked[0] < k < marked[-1] else min(scores[k], weights["word:bad"])
            elif not inside and piece.article and piece.text:
                scores[k] = min(scores[k], weights["word:bad"] * piece.words)
    first, last = best_region(scores)
    return blocks_of([p for p in pieces[first:last] if p.article or not inside])


def extract_pages(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Main text of each page: page_id long, url string, text string, n_chars long; one row for each row of pages.

    Needs page_id, url and html; other columns are not read. Null html counts as empty; a page without content gives an empty
    text. Character references are decoded, white space inside a block becomes one space, blocks are joined by two line
    feeds. Text is never cut. Repeated rows give repeated rows. No shuffle: one pass over the input.
    """
    weights = weights or WEIGHTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ["\n\n".join(extract(raw.as_buffer().to_pybytes().decode("utf-8", "replace"), weights)) for raw in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), utf8("html"))
    return own.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
