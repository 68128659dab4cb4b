"""Main text of web pages by a tree-structured graphical model.

Every element of a page is a variable, content or not.  Its features (tag, words of its class, id
and role, length and link share of its own text) give it a unary potential; each parent and child
share a pairwise potential, of one kind where the child is marked as a part of its own (comments, adverts, menus and
the like) and of another where it is not.  Sum-product messages go up the tree and down again, which gives the
exact marginal of every element; a block of text is kept where its element is more likely content
than not.  Potentials are trained by counting on labelled pages: layouts written out below, each
element marked, in all their combinations.

Defined results: a null, empty or blank page, or one without content, has an empty text; broken
and cut-off markup is read as far as it goes; equal rows get equal rows; an empty table gives no
rows; nothing is cut from long pages; columns of the input other than those named are ignored.
"""

from __future__ import annotations

import html
import itertools
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|noscript|template|svg|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    # A quote counts where a value begins; one that is not closed before the next tag ends with its own tag.
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"<]*\"|=\s*'[^'<]*'|[^>])*)(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTES = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
#: Shares of the unary potentials that training tries; of equally good ones the first.
SHARES = (1.0, 0.7, 0.5, 0.4, 0.3, 0.2, 0.1)
#: Menus and notices rarely have so many characters in one element.
LONG_TEXT = 150
_LABEL = re.compile(r"data-content=\"([01])\"")
_WORDS = re.compile(r"[a-z]+")
_SPACES = re.compile(r"\s+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
_HIDDEN = frozenset("head title meta link select option button".split())
#: A start tag closes an open element of these kinds (as browsers do), up to the given ancestors.
_CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table", "tbody", "thead"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
_BARRIERS = frozenset("html body article main section div table td th ul ol li nav header footer aside form blockquote figure".split())
# Words of classes and ids, by what they usually mark.
KINDS = {
    "content": "article main content post entry story body text hentry prose",
    "navigation": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toc",
    "top": "header masthead topbar logo branding toolbar",
    "bottom": "footer bottom copyright legal colophon",
    "side": "sidebar aside side widget related recommended popular trending rail",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion banner",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay newsletter subscribe signup",
    "form": "form search login register",
    "comments": "comment comments commentlist discussion disqus reply replies respond",
    "share": "share sharing social tags meta byline",
}
_KIND_OF = {word: kind for kind, words in KINDS.items() for word in words.split()}
_TAG_KIND = {"nav": "navigation", "footer": "bottom", "aside": "side", "form": "form", "article": "content", "main": "content"}


class Page:
    """Elements in page order: parent, features, and their blocks of text."""

    def __init__(self, source: str) -> None:
        self.parents, self.tags, self.attributes = [-1], ["#root"], [""]
        self.texts: list[list[str]] = [[]]
        self.linked = [0]
        #: (element, text) in page order
        self.blocks: list[tuple[int, str]] = []
        self._run: list[str] = []
        self._owner = 0
        self._read(source)

    def _flush(self) -> None:
        if self._run:
            text = _SPACES.sub(" ", html.unescape("".join(self._run))).strip()
            self._run = []
            if text:
                self.blocks.append((self._owner, text))
                self.texts[self._owner].append(text)

    def _read(self, source: str) -> None:
        stack, block, at, links, hidden = [0], [0], 0, 0, 0
        tags = self.tags
        #: How many elements of each tag are open.
        open_ = self._open = Counter()
        for found in _MARKUP.finditer(source):
            if found.start() > at and not hidden:
                self._text(source[at : found.start()], block[-1], links)
            at = found.end()
            tag = found[3]
            if tag is None:
                continue
            tag = tag.lower()
            if found[2]:
                if not open_[tag]:
                    continue
                while True:
                    node = stack.pop()
                    open_[tags[node]] -= 1
                    links -= tags[node] == "a"
                    hidden -= tags[node] in _HIDDEN
                    if block[-1] == node:
                        self._flush()
                        block.pop()
                    if tags[node] == tag:
                        break
                continue
            inline = tag in _INLINE
            if not inline:
                self._flush()
                links, hidden = self._close_before(tag, stack, block, links, hidden)
            if tag in _VOID:
                if tag == "br":
                    self._run.append(" ")
                continue
            self.parents.append(stack[-1])
            self.tags.append(tag)
            self.attributes.append(found[4])
            self.texts.append([])
            self.linked.append(0)
            node = len(tags) - 1
            if found[4].endswith("/") and not inline and tag not in _BARRIERS:
                continue
            stack.append(node)
            open_[tag] += 1
            links += tag == "a"
            hidden += tag in _HIDDEN
            if not inline:
                block.append(node)
        if at < len(source) and not hidden:
            self._text(source[at:], block[-1], links)
        self._flush()

    def _close_before(self, tag, stack, block, links, hidden):
        kinds, limits = _CLOSES.get(tag, ({"p"}, _BARRIERS))
        if not any(self._open[kind] for kind in kinds):
            return links, hidden
        for k in range(len(stack) - 1, 0, -1):
            name = self.tags[stack[k]]
            if name in kinds:
                for node in stack[k:]:
                    links -= self.tags[node] == "a"
                    hidden -= self.tags[node] in _HIDDEN
                    self._open[self.tags[node]] -= 1
                while block[-1] >= stack[k]:  # blocks stand in the order of the stack
                    block.pop()
                del stack[k:]
                break
            if name in limits:
                break
        return links, hidden

    def _text(self, text: str, owner: int, links: int) -> None:
        if self._run and self._owner != owner:
            self._flush()
        self._owner = owner
        self._run.append(text)
        if links:
            self.linked[owner] += len(text)

    def features(self, node: int) -> list[str]:
        tag = self.tags[node]
        out = [f"tag {tag}"]
        kinds = {_TAG_KIND[tag]} if tag in _TAG_KIND else set()
        for groups in _ATTRIBUTES.findall(self.attributes[node]):
            kinds.update(_KIND_OF[word] for word in _WORDS.findall("".join(groups).lower()) if word in _KIND_OF)
        # A word of a non-content kind says more than one of content ("main-menu", "post-footer").
        if len(kinds) > 1:
            kinds.discard("content")
        out += [f"kind {kind}" for kind in kinds]
        length = sum(map(len, self.texts[node]))
        if length:
            if length >= LONG_TEXT:
                out.append("long")
            out.append(f"links {min(2, int(3 * self.linked[node] / max(length, 1)))}")
        return out


# --- labelled pages --------------------------------------------------------------------------
_LONG = "This is a sentence of the story that the page is about, as long as such sentences are. " * 4
_SHORT = "A short line."
_ITEMS = "".join(f'<li><a href="/{k}">Entry {k}</a></li>' for k in range(6))
_TOPS = [
    f"<nav><ul>{_ITEMS}</ul></nav>",
    f'<header><div class="logo">Name of the site</div><nav class="menu"><ul>{_ITEMS}</ul></nav></header>',
    f'<div id="header"><p>Name of the site</p><div class="main-menu"><a href="/">Home</a> <a href="/b">More</a></div></div>',
    f'<div class="cookie-notice"><p>This site uses cookies. {_SHORT}</p><button>Yes</button></div><div class="breadcrumbs"><a href="/">Home</a></div>',
]
_BODY = f"<h1>Title of the story</h1><p>{_LONG}</p><p>{_SHORT}</p><p>{_LONG}</p><h2>Part</h2><p>Yes.</p><p>{_LONG[:100]}</p><h3>More</h3><ul><li>{_SHORT}</li><li>{_LONG}</li></ul><blockquote><p>{_LONG}</p></blockquote>"
_MAINS = [
    f'<article data-content="1">{_BODY}</article>',
    f'<main data-content="1">{_BODY}<div class="ad" data-content="0"><p>{_SHORT}</p></div><p>{_LONG}</p></main>',
    f'<div class="post-content" data-content="1">{_BODY}<div class="share-links" data-content="0"><a href="/s">Share</a></div></div>',
    f'<div id="content"><div class="entry" data-content="1">{_BODY}<aside data-content="0"><p>{_SHORT}</p></aside></div></div>',
    f'<div><div data-content="1">{_BODY}<p>{_LONG}</p></div></div>',
    f'<article data-content="1">{_BODY}<div class="comments" data-content="0"><div class="comment"><p>{_SHORT}</p></div><div class="comment"><p>{_LONG}</p></div></div></article>',
    f'<main><article class="post" data-content="1">{_BODY}<section id="comment-list" data-content="0"><h3>Replies</h3><ul><li>{_SHORT}</li><li>{_LONG}</li></ul></section></article></main>',
    f'<div class="story-body" data-content="1">{_BODY}<div class="newsletter-box" data-content="0"><p>{_SHORT}</p><form><p>{_SHORT}</p></form></div><p>{_LONG}</p><p>{_SHORT}</p></div>',
    f'<article data-content="1"><header><p>{_SHORT}</p></header><section>{_BODY}<figure><figcaption>{_SHORT}</figcaption></figure></section><div class="comment-box" data-content="0"><p>{_SHORT}</p></div></article>',
    f'<table><tr><td data-content="1">{_BODY}</td><td><ul>{_ITEMS}</ul></td></tr></table>',
]
_ENDS = [
    f'<footer>Name of the site. {_SHORT}</footer>',
    f'<div class="ad">{_LONG[:120]}</div><footer><p>{_SHORT}</p><ul>{_ITEMS}</ul></footer>',
    f'<aside class="sidebar"><h3>Related</h3><ul>{_ITEMS}</ul><p>{_LONG}</p></aside><div id="footer">{_SHORT}</div>',
    f'<section class="comments"><h3>Comments</h3><div class="comment"><p>{_LONG}</p></div><div class="comment"><p>{_SHORT}</p></div><form><p>Write one</p></form></section>',
    f'<div id="comments"><ol><li><p>{_LONG}</p></li><li><p>{_SHORT}</p></li></ol></div><form class="newsletter"><p>{_SHORT}</p></form><div class="footer">{_SHORT}</div>',
]


def labelled_pages() -> list[str]:
    """Pages whose elements inherit the mark ``data-content`` of their nearest marked ancestor."""
    return [
        f"<html><head><title>x</title></head><body>{top}{main}{end}</body></html>"
        for top, main, end in itertools.product(_TOPS, _MAINS, _ENDS)
    ]


def _apart(features: list[str]) -> bool:
    """Whether an element is marked as something other than content."""
    return any(feature.startswith("kind ") and feature != "kind content" for feature in features)


class Model:
    """Potentials as ratios of content to other."""

    def __init__(self, pages: list[str]) -> None:
        total, seen, pairs = Counter(), Counter(), Counter()
        read = [Page(page) for page in pages]
        marked = []
        for page in read:
            labels = [0]
            marked.append(labels)
            for node in range(1, len(page.tags)):
                mark = _LABEL.search(page.attributes[node])
                labels.append(int(mark[1]) if mark else labels[page.parents[node]])
                label = labels[node]
                total[label] += 1
                features = page.features(node)
                pairs[_apart(features), labels[page.parents[node]], label] += 1
                seen.update((feature, label) for feature in features)
        names = {feature for feature, _ in seen}
        self.feature = {
            f: math.log((seen[f, 1] + 0.5) / (total[1] + 1)) - math.log((seen[f, 0] + 0.5) / (total[0] + 1)) for f in names
        }
        #: By whether the child is a part of its own: chances of the child's label for each label of the parent.
        self.pair = [
            [[(pairs[own, a, b] + 1) / (pairs[own, a, 0] + pairs[own, a, 1] + 2) for b in (0, 1)] for a in (0, 1)]
            for own in (False, True)
        ]
        # Features of an element depend on each other, so their sum says too much; the share of it
        # that classifies most of the labelled elements with text is taken.
        single = self.feature

        def right(share: float) -> int:
            self.feature = {f: share * value for f, value in single.items()}
            return sum(
                (odds[node] > 0) == labels[node]
                for page, labels in zip(read, marked, strict=True)
                for odds in [self.marginals(page)]
                for node in {node for node, _ in page.blocks}
            )

        self.share = max(SHARES, key=right)
        self.feature = {f: self.share * value for f, value in single.items()}

    def marginals(self, page: Page) -> list[float]:
        """Log-odds of content for every element, by messages up and down the tree."""
        count, parents = len(page.tags), page.parents
        weight = self.feature.get
        pair = [self.pair[0]] * count
        below = [0.0] * count  # own potential and all messages from children
        up = [0.0] * count
        for node in range(1, count):
            features = page.features(node)
            below[node] = sum(weight(feature, 0.0) for feature in features)
            pair[node] = self.pair[_apart(features)]

        def passed(log_odds: float, a: float, b: float, c: float, d: float) -> float:
            ratio = math.exp(max(-50.0, min(50.0, log_odds)))
            return math.log((a + b * ratio) / (c + d * ratio))

        for node in range(count - 1, 0, -1):
            (p00, p01), (p10, p11) = pair[node]
            up[node] = passed(below[node], p10, p11, p00, p01)
            below[parents[node]] += up[node]
        out = below[:]
        out[0] = below[0] - 20.0  # the page as a whole is not content
        for node in range(1, count):
            (p00, p01), (p10, p11) = pair[node]
            from_above = out[parents[node]] - up[node]
            out[node] = below[node] + passed(from_above, p01, p11, p00, p10)
        return out


_model: Model | None = None


def trained() -> Model:
    global _model
    if _model is None:
        _model = Model(labelled_pages())
    return _model


def main_text(source: str | None) -> str:
    page = Page(source or "")
    odds = trained().marginals(page)
    return "\n".join(text for node, text in page.blocks if odds[node] > 0)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars)."""

    def extracted(batches):
        for batch in batches:
            texts = [main_text(body) for body in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch["page_id"],
                    "url": batch["url"],
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(text) for text in texts], pa.int64()),
                }
            )

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html"))
    return rows.mapInArrow(extracted, "page_id long, url string, text string, n_chars long")
