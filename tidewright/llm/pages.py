"""Main text of web pages: boosted trees over DOM-node features, decoded along the hierarchy.

A page is cut into its element tree. Every block element gets features (text and link density of its
subtree, tag and attribute tokens of itself and its ancestors, depth, siblings), a probability of being
main text, and the best consistent choice is taken: a dropped element takes all below it along, so an
ancestor and a descendant never contradict each other.

There are no labelled pages. The trees are fitted on a bounded sample of pages that mark their article,
and on variants of these in which the article is marked otherwise or parts known to be no main text
(taken from other pages) are put around and into it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm import boosting
from tidewright.llm.common import per_batch

# Pages the trees are fitted on, the largest that is taken for it, and the variants made of each.
TRAIN_PAGES = 150
TRAIN_BYTES = 100_000
VARIANTS = 5

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)")
_OTHER = re.compile(r"<!--.*?(?:-->|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<", re.S)
_QUOTE_OR_END = re.compile("[>\"']")
# Elements whose content is no text of the page; those of the second group end with their tag if no end tag follows.
_RAW_END = {
    name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in "script style iframe textarea title noscript template svg".split()
}
_NEVER_OPEN = frozenset(("noscript", "template", "svg"))
_ATTR = re.compile(r"\b(class|id|role|itemprop|aria-label|data-main)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# How HTML nests. Elements without content, those inside a line, and those that end an open <p>.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split()
)
SAME_CLOSES = {"p": "p", "li": "li", "dt": "dd dt", "dd": "dd dt", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
# Element names and attribute words that speak for or against main text; the trees decide what they weigh.
GOOD_TAGS = ("article", "main", "p", "section", "h1", "blockquote", "pre")
BAD_TAGS = ("nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "head")
GOOD_WORDS = frozenset("article content main post entry story body text blog page".split())
BAD_WORDS = {
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner doubleclick",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toolbar pagination pager tabs sitemap",
    "frame": "header footer masthead foot head top copyright legal branding",
    "side": "sidebar side aside widget related recommended rail trending popular more teaser complementary",
    "talk": "comment comments reply replies discussion disqus respond reader",
    "notice": "cookie cookies notice consent gdpr popup modal overlay alert privacy paywall warning",
    "ask": "form subscribe newsletter signup login search share social sharing follow contact",
}
_BAD = {w: name for name, words in BAD_WORDS.items() for w in words.split()}
GROUPS = tuple(BAD_WORDS)

FEATURES = (
    "depth", "log_text", "own_text", "density", "link_share", "stops", "commas", "n_children", "place", "siblings", "like_siblings", "from_top",
    *(f"is_{t}" for t in GOOD_TAGS), *(f"is_{t}" for t in BAD_TAGS), "in_good_tag", "in_bad_tag", "good_word", "in_good_word",
    *(f"word_{g}" for g in GROUPS), *(f"in_{g}" for g in GROUPS), "in_any_bad", "main_like", "is_list", "is_table", "is_block",
)


class _TagEnds:
    """Where the tags of a page end. Whatever the page holds, no stretch is searched twice in vain: the next quote or ``>`` is
    remembered, and so are the quotes from which no end of a tag can be reached."""

    def __init__(self, source: str):
        self.source, self.asked, self.found = source, 0, -1
        self.dead: set[int] = set()

    def _next(self, at: int) -> int:
        if not self.asked <= at <= self.found:
            m = _QUOTE_OR_END.search(self.source, at)
            self.asked, self.found = at, m.start() if m else len(self.source)
        return self.found

    def after(self, at: int) -> int:
        """The place of the first ``>`` from ``at`` that stands in no quotes, or -1."""
        passed = []
        here = self._next(at)
        while here < len(self.source) and here not in self.dead:
            if self.source[here] == ">":
                return here
            passed.append(here)
            close = self.source.find(self.source[here], here + 1)
            if close < 0:
                break
            here = self._next(close + 1)
        self.dead.update(passed)
        return -1


def _tokens(source: str) -> Iterator[tuple[str | None, str, bool]]:
    """The tokens of a page in order, without its raw elements and what is in them: (element name, attributes, is an
    end tag) or (None, text, False). A tag that never ends is text; the time is linear in the page."""
    ends, at, never_closed = _TagEnds(source), 0, set()
    while at < len(source):
        tag = _TAG.match(source, at)
        stop = ends.after(tag.end()) if tag else -1
        if stop < 0:
            m = _OTHER.match(source, at)
            at = m.end()
            if m[0][0] != "<" or len(m[0]) == 1:
                yield None, m[0], False
            continue
        at, name, attrs = stop + 1, tag[2].lower(), source[tag.end() : stop]
        if tag[1] or name not in _RAW_END:
            yield name, attrs, bool(tag[1])
            continue
        if name in never_closed or (name == "svg" and attrs.rstrip().endswith("/")):
            continue
        closed = _RAW_END[name].search(source, at)
        over = source.find(">", closed.end()) if closed else -1
        if over >= 0:
            at = over + 1
        elif name in _NEVER_OPEN:
            never_closed.add(name)
        else:
            return


class Page:
    """The element tree: parallel lists, an element's parent always before it; 0 is the page itself."""

    def __init__(self, source: str):
        self.tag, self.parent, self.words, self.main = ["#page"], [-1], [frozenset()], [None]
        self.pieces: list[tuple[int, int, str, bool]] = []  # element, block, text, inside a link
        # The open elements, for each the place of the innermost one that is no inline element, and how many of a name are open.
        stack, bases, opened = [0], [0], Counter()
        block, links = 0, 0
        for name, text, is_end in _tokens(source):
            if name is None:
                self.pieces.append((stack[-1], block, html.unescape(text), links > 0))
                continue
            if is_end:
                while opened[name]:
                    bases.pop()
                    closed = self.tag[stack.pop()]
                    opened[closed] -= 1
                    links -= closed == "a"
                    block += closed not in INLINE
                    if closed == name:
                        break
                continue
            if name in VOID:
                if name == "hr":
                    block += 1
                elif name == "br":
                    self.pieces.append((stack[-1], block, " ", links > 0))
                continue
            if name not in INLINE:
                block += 1
                # An open paragraph (or item, cell) ends where the next block begins.
                ends, depth = SAME_CLOSES.get(name, "p").split(), bases[-1]
                if depth and self.tag[stack[depth]] in ("p", *ends):
                    for i in stack[depth:]:
                        opened[self.tag[i]] -= 1
                        links -= self.tag[i] == "a"
                    del stack[depth:], bases[depth:]
            words, main = frozenset(), None
            if "=" in text:
                found = set()
                for key, *values in _ATTR.findall(text):
                    value = "".join(values)
                    if key.lower() == "data-main":
                        main = value == "1"
                    else:
                        found |= {p.lower() for p in _PART.findall(value)}
                words = frozenset(found)
            self.tag.append(name)
            self.parent.append(stack[-1])
            self.words.append(words)
            self.main.append(main)
            if not text.rstrip().endswith("/"):
                bases.append(bases[-1] if name in INLINE else len(stack))
                stack.append(len(self.tag) - 1)
                opened[name] += 1
                links += name == "a"

    def features(self) -> np.ndarray:
        n = len(self.tag)
        own, link, stops, commas = (np.zeros(n) for _ in range(4))
        for at, _, text, linked in self.pieces:
            size = len(text.strip())
            own[at] += size
            link[at] += size * linked
            stops[at] += text.count(".") + text.count("!") + text.count("?")
            commas[at] += text.count(",")
        text, nodes, children = own.copy(), np.ones(n), np.zeros(n)
        linked, ends, pauses = link.copy(), stops.copy(), commas.copy()
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            text[p] += text[i]
            nodes[p] += nodes[i]
            linked[p] += linked[i]
            ends[p] += ends[i]
            pauses[p] += pauses[i]
            children[p] += 1
        x = np.zeros((n, len(FEATURES)))
        inherited = np.zeros((n, 3 + len(GROUPS)))
        depth, seen, alike = np.zeros(n), np.zeros(n), {}
        start = 12 + len(GOOD_TAGS) + len(BAD_TAGS)
        before = 0.0
        for i in range(n):
            p, tag, words = self.parent[i], self.tag[i], self.words[i]
            if p >= 0:
                depth[i] = depth[p] + 1
                inherited[i] = inherited[p]
                alike[p, tag] = alike.get((p, tag), 0) + 1
            x[i, 8] = seen[p] if p >= 0 else 0
            x[i, 11] = before / max(text[0], 1.0)
            before += own[i]
            if p >= 0:
                seen[p] += 1
            good, bad = tag in GOOD_TAGS, tag in BAD_TAGS
            if good:
                x[i, 12 + GOOD_TAGS.index(tag)] = 1
            if bad:
                x[i, 12 + len(GOOD_TAGS) + BAD_TAGS.index(tag)] = 1
            if tag in ("article", "main"):
                # What surrounds an article says nothing about it.
                inherited[i, 1], inherited[i, 3:] = 0, 0
                inherited[i, 0] = 1
            inherited[i, 1] = max(inherited[i, 1], bad)
            if words:
                hit = bool(words & GOOD_WORDS)
                inherited[i, 2] = max(inherited[i, 2], hit)
                x[i, start + 2] = hit
                for w in words:
                    if w in _BAD:
                        g = GROUPS.index(_BAD[w])
                        x[i, start + 4 + g] = 1
                        inherited[i, 3 + g] = 1
            x[i, -5] = inherited[i, 1] or inherited[i, 3:].any()
            x[i, -4] = (inherited[i, 0] or inherited[i, 2]) and not x[i, -5]
            x[i, -3], x[i, -2] = tag in ("ul", "ol", "dl", "li"), tag in ("table", "tr", "td", "th")
            x[i, -1] = tag not in INLINE
        x[:, 0], x[:, 1], x[:, 2] = depth, np.log1p(text), np.log1p(own)
        x[:, 3], x[:, 4] = text / nodes, linked / np.maximum(text, 1)
        x[:, 5], x[:, 6], x[:, 7] = ends / np.maximum(text, 1), pauses / np.maximum(text, 1), children
        parents = np.maximum(np.array(self.parent), 0)
        x[:, 9] = children[parents]
        x[:, 10] = [alike.get((p, t), 0) for p, t in zip(self.parent, self.tag)]
        x[:, start : start + 2], x[:, start + 3] = inherited[:, :2], inherited[:, 2]
        x[:, start + 4 + len(GROUPS) : start + 4 + 2 * len(GROUPS)] = inherited[:, 3:]
        return x

    def choose(self, odds: np.ndarray) -> np.ndarray:
        """Which elements stay, given the log-odds of each: the consistent choice with the largest sum
        over the elements of their odds times the root of their own text. Inline elements follow their parent."""
        n = len(self.tag)
        own = np.zeros(n)
        for at, _, text, _ in self.pieces:
            own[at] += len(text.strip())
        gain = np.sqrt(own) * odds
        for i in range(n - 1, 0, -1):
            if self.tag[i] in INLINE:
                gain[self.parent[i]] += np.sqrt(own[i]) * odds[self.parent[i]]
                gain[i] = 0.0
        best, kept = gain.copy(), np.zeros(n, dtype=bool)
        for i in range(n - 1, 0, -1):
            if self.tag[i] in INLINE:
                best[self.parent[i]] += best[i]
            else:
                best[self.parent[i]] += max(best[i], 0.0)
        kept[0] = True
        for i in range(1, n):
            kept[i] = kept[self.parent[i]] and (self.tag[i] in INLINE or best[i] > 0)
        return kept

    def text(self, kept: np.ndarray) -> str:
        blocks: list[list[str]] = []
        last = None
        for at, block, text, _ in self.pieces:
            if kept[at]:
                if block != last:
                    blocks.append([])
                    last = block
                blocks[-1].append(text)
        joined = (" ".join("".join(b).split()) for b in blocks)
        return "\n".join(b for b in joined if b)

    def truth(self) -> np.ndarray:
        """Labels of a training page: in the article and in nothing inside it that is marked otherwise."""
        inside = np.zeros(len(self.tag), dtype=bool)
        for i in range(1, len(self.tag)):
            inside[i] = inside[self.parent[i]] if self.main[i] is None else self.main[i]
        return inside


_ARTICLE = re.compile(r"<(article|main)\b[^>]*>(.*?)(?:</\1\s*>|\Z)", re.S | re.I)
_OUTSIDE = (
    '<aside class="sidebar">{}</aside>', '<div class="cookie-notice">{}</div>', '<form action="/s"><label>{}</label><input name="q"></form>',
    '<section class="comments" id="comments"><h3>{}</h3><div class="comment"><p>{}</p></div></section>', '<header class="site-header">{}</header>',
    '<div class="related"><ul><li><a href="/x">{}</a></li><li><a href="/y">{}</a></li></ul></div>', '<div id="banner" class="ad">{}</div>',
    '<nav class="breadcrumbs"><a href="/">{}</a></nav>', '<div class="newsletter">{}</div>', '<div role="complementary">{}</div>',
    '<div class="alert">{}</div>', '<ul class="menu"><li><a href="/z">{}</a></li></ul>', '<div class="social-share"><a href="#">{}</a></div>',
    '<div class="footer"><p>{}</p></div>', '<div class="reader-comments"><p>{}</p><p>{}</p></div>', '<p class="notice">{}</p>',
)
_MARKS = ('<article data-main="1">{}</article>', '<main data-main="1">{}</main>', '<div class="content" data-main="1">{}</div>',
          '<div class="post-body entry" data-main="1">{}</div>', '<section id="main-content" data-main="1">{}</section>')


def training_pages(sources: list[str], seed: int = 3) -> list[Page]:
    """Pages with marked articles, each as it is and in variants; any without a marked article are left out."""
    draw = np.random.default_rng(seed)
    found = [(s, m) for s in sources if (m := _ARTICLE.search(s))]
    spare = [t for _, m in found for t in re.findall(r">([^<>]{10,300})", m[2])][:5000] or ["nothing to see"]

    def part(shape: str) -> str:
        said = shape.replace(">", ' data-main="0">', 1)
        return said.format(*[spare[int(draw.integers(len(spare)))] for _ in range(shape.count("{}"))])

    pages = []
    for source, m in found:
        for v in range(1 + VARIANTS):
            body, mark = m[2], _MARKS[0 if v == 0 else int(draw.integers(len(_MARKS)))]
            head, tail = source[: m.start()], source[m.end() :]
            if v:
                # Other shapes of the same article: without its title, shorter, wrapped, on a page with less around it.
                if draw.random() < 0.4:
                    body = re.sub(r"<h1\b.*?</h1>", "", body, flags=re.S)
                if draw.random() < 0.5:
                    ends = [p.end() for p in re.finditer(r"</p>", body)]
                    body = body[: ends[int(draw.integers(min(4, len(ends))))]] if ends else body
                if draw.random() < 0.4:
                    body = re.sub(r"<b>|<br>", "", body)
                if draw.random() < 0.5:
                    head, tail = "<html><body>", "</body></html>"
                for _ in range(int(draw.integers(4))):
                    mark = "<div>" + mark + "</div>" if draw.random() < 0.7 else '<div class="wrap">' + mark + "</div>"
                places = [0] + [p.end() for p in re.finditer(r"</p>|</h\d>", body)]
                for at in sorted(draw.choice(places, size=min(2, len(places)), replace=False).tolist(), reverse=True):
                    body = body[:at] + part(_OUTSIDE[int(draw.integers(len(_OUTSIDE)))]) + body[at:]
                head += "".join(part(_OUTSIDE[int(i)]) for i in draw.integers(len(_OUTSIDE), size=2))
                tail = "".join(part(_OUTSIDE[int(i)]) for i in draw.integers(len(_OUTSIDE), size=2)) + tail
            pages.append(Page(head + mark.replace("{}", body, 1) + tail))
    return pages


def train(pages: DataFrame, key: str = "page_id", source: str = "html", rows: int = TRAIN_PAGES) -> boosting.Boosted:
    """Trees fitted on at most ``rows`` pages that mark their article; only these reach the driver."""
    usable = pages.where(F.col(source).rlike(r"(?i)<(article|main)\b") & (F.length(source) <= TRAIN_BYTES))
    drawn = usable.select(F.xxhash64(F.col(key), F.col(source)).alias("at"), F.col(source).alias("html")).orderBy("at", "html").limit(rows)
    x, y = [np.zeros((0, len(FEATURES)))], [np.zeros(0)]
    for page in training_pages(drawn.toArrow().column("html").to_pylist()):
        block = np.array([t not in INLINE for t in page.tag])
        x.append(page.features()[block])
        y.append(page.truth()[block].astype(float))
    return boosting.fit(np.concatenate(x), np.concatenate(y), trees=40, depth=4, least=40.0)


def extract_batch(sources: list[str | None], model: boosting.Boosted) -> list[str]:
    pages = [Page(s or "") for s in sources]
    if not pages:
        return []
    sizes = np.cumsum([0] + [len(p.tag) for p in pages])
    odds = model.margin(np.concatenate([p.features() for p in pages]))
    return [p.text(p.choose(odds[a:b])) for p, a, b in zip(pages, sizes, sizes[1:])]


def extract_main_text(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html", rows: int = TRAIN_PAGES) -> DataFrame:
    """One row per page: ``key``, ``url``, ``text`` (empty if none) and ``n_chars``.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by
    line ends in page order. Null and empty pages give an empty text; null and repeated keys keep their
    rows; without a page that marks its article nothing can be learned and every element stays; an empty
    table gives an empty result; nothing is shuffled but the training sample; other columns are not read.
    Pages of more than ``TRAIN_BYTES`` characters are extracted like any other but never learned from.
    Broken markup (tags and quotes without an end, stray end tags) takes time linear in the page, as any other.
    """
    model = train(pages, key, source, rows)
    if not len(model.leaf):
        model = boosting.Boosted(1.0, model.feature, model.threshold, model.leaf)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = extract_batch(batch.column(2).to_pylist(), model)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["key", "url", "text"])

    rows_ = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(source).alias("html"))
    out = rows_.mapInArrow(per_batch(work), rows_.select("key", "url").schema.add("text", "string"))
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))
