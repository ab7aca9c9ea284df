"""Main text of web pages by composite text density.

A page becomes a tree of its elements. Scripts, styles, forms and elements that say they
are menus, headers, footers, sidebars, notices, adverts or comments are left out with all
below them; the latter not if they hold the page's only articles or the bulk of its text.
For every other block element, with ``C`` characters and ``T`` tags (blocks and links) in its
subtree, of which ``LC`` and ``LT`` are in links, and ``¬LC = C - LC``:

    density = C / T * log(1 + C / LC * T / LT) to the base C / ¬LC * LC + LC_body / C_body * C + e

with 1 in place of 0 in divisors. (The usual form has the base's logarithm as base and no
1; it is not defined where there are no links. Elements inside a line, as bold words, are
neither nodes nor tags: they say how a line looks, not how a page is built.) A block's sum is
that of its children's densities; the lines right in a block count as a child without tags.
The subtree of the greatest sum is the article. Its threshold is the least density on the
path from the body to it; blocks outside it that reach the threshold belong to the text too,
each with its own subtree of greatest sum. If the subtree is in an element that a page names
as its article or main part, only blocks of that element are added, and the text is the
whole element where the chosen blocks hold more than half of it.

Block elements part the text; inside a block white space becomes one blank.

Cases: NULL, empty, markup without text and text without markup work (the last is one
block); unclosed and crossed tags are closed as browsers do; ties of sums go to the first
node; nesting of any depth is walked without recursion; repeated rows are extracted each.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truegrain.llm import common

# Kinds of elements as HTML defines them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = set(
    "head script style noscript template iframe object embed svg canvas audio video form input select textarea button "
    "label fieldset nav menu aside footer dialog title xmp noembed noframes".split()
)
#: Words of a class, id or role that mark what is not the article.
NOISE = set(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice notices alert popup modal overlay paywall subscribe subscription newsletter signup "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar sidebar sidenav aside rail widget "
    "comment comments commentlist disqus replies reply respond discussion footer foot footnav copyright legal "
    "header masthead topbar share sharing social related recommended recommendations teaser teasers tags login search skip "
    "complementary contentinfo dialog form".split()
)
ARTICLE = {"article", "main"}
#: More than this share of an article's text, once chosen, stands for all of it.
WIDENED = 0.5
#: Noise words of parts that can be longer than the article.
REPLIES = set("comment comments commentlist disqus replies reply respond discussion".split())
#: Words that make a header one of the article.
OF_ARTICLE = set("article post entry story".split())
#: Why an element is left out: not at all, always, for words among others, for a word that stands alone
#: or replies among other words, for replies alone.
LIVE, ALWAYS, SOME_WORD, WORD_ALONE, REPLIES_ALONE = range(5)
#: An element with more than this share of the page's text is not left out for its words.
BULK = {SOME_WORD: 0.5, WORD_ALONE: 0.9, REPLIES_ALONE: 1.0}
#: A start tag of the key closes an open element of these, unless a boundary stands between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}

_MARKUP = re.compile(
    r"<!--(?P<comment>.*?)(?:-->|--!>|\Z)|<(?P<odd>[!?])[^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>[^>\"']*+(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*+)*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def noise_kind(name: str, rest: str, in_article: bool) -> int:
    """Whether a start tag marks noise; for its words (kinds beyond ``ALWAYS``) only if ``Page`` finds no article in it."""
    if name in DROPPED or (name == "header" and not in_article):
        return ALWAYS
    kind = LIVE
    for mark, value in _ATTRIBUTE.findall(rest) if rest else ():
        mark, value = mark.lower(), value.strip("\"'")
        if mark == "hidden" or (mark == "aria-hidden" and value.lower() == "true"):
            return ALWAYS
        if mark == "style" and _HIDES.search(value):
            return ALWAYS
        if mark not in ("class", "id", "role") or name in ("html", "body"):
            continue
        if name in ARTICLE:
            if any(w.lower() in {"comment", "comments", "reply", "ad", "advert", "teaser", "related", "sponsored"} for w in _WORD.findall(value)):
                kind = max(kind, SOME_WORD)
            continue
        for token in value.split():
            words = {w.lower() for w in _WORD.findall(token)}
            found = words & NOISE
            if found == {"header"} and (in_article or words & OF_ARTICLE):
                continue
            if found and found == words and found & REPLIES:
                kind = max(kind, REPLIES_ALONE)
            elif found:
                kind = max(kind, WORD_ALONE if found == words or found & REPLIES else SOME_WORD)
    return kind


class Page:
    """Nodes of a page in document order: elements, and runs of text as nodes named ``#``."""

    def __init__(self, source: str):
        self.name: list[str] = ["#root"]
        self.parent: list[int] = [-1]
        self.text: list[str | None] = [None]
        self.kind: list[int] = [LIVE]
        self._build(source)
        self.noise = self._noise()

    def _add(self, name: str, parent: int, text: str | None, kind: int) -> int:
        self.name.append(name)
        self.parent.append(parent)
        self.text.append(text)
        self.kind.append(kind)
        return len(self.name) - 1

    def _build(self, source: str) -> None:
        open_, at, articles = [0], 0, 0

        def close(down_to: int) -> None:
            nonlocal articles
            for node in open_[down_to:]:
                articles -= self.name[node] in ARTICLE
            del open_[down_to:]

        def close_one_of(names: set, boundary: set) -> None:
            for k in range(len(open_) - 1, 0, -1):
                if self.name[open_[k]] in names:
                    close(k)
                    return
                if self.name[open_[k]] in boundary:
                    return

        find, size = _MARKUP.search, len(source)
        while at < size:
            tag = find(source, at)
            stop = tag.start() if tag else size
            if stop > at and not source[at:stop].isspace():
                self._add("#", open_[-1], source[at:stop], LIVE)
            elif stop > at:
                self._add("#", open_[-1], " ", LIVE)
            if tag is None:
                break
            at = tag.end()
            name = tag["name"] or tag["name2"]
            if name is None:
                continue
            name, rest = name.lower(), tag["rest"] or tag["rest2"] or ""
            if tag["end"] or tag["end2"]:
                for k in range(len(open_) - 1, 0, -1):
                    if self.name[open_[k]] == name:
                        close(k)
                        break
                    if name not in BLOCK and self.name[open_[k]] in BLOCK:
                        break
                    if name in ("li", "p", "td", "tr", "dd", "dt") and self.name[open_[k]] in ("table", "ul", "ol", "article", "section"):
                        break
                continue
            if name in BLOCK:
                close_one_of({"p"}, BLOCK - {"p"})
            if name in CLOSES:
                close_one_of(*CLOSES[name])
            node = self._add(name, open_[-1], None, noise_kind(name, rest, articles > 0))
            if name in RAW:
                end = re.compile(f"</{name}[^>]*(?:>|\\Z)", re.I).search(source, at)
                body, at = (source[at : end.start()], end.end()) if end else (source[at:], size)
                if body:
                    self._add("#", node, body, LIVE)
            elif name not in VOID and not rest.endswith("/") or name in BLOCK and name not in VOID:
                open_.append(node)
                articles += name in ARTICLE

    def _noise(self) -> list[bool]:
        """Which nodes are left out before densities are computed.

        An element is left out for its words unless it holds the page's only articles or
        is the bulk of its text, as layouts are named for what they hold.
        """
        n = len(self.name)
        never, holder = [False] * n, [0] * n  # holder: the nearest element with noise words
        chars, articles, own = [0] * n, [0] * n, [0] * n
        for i in range(1, n):
            up = self.parent[i]
            never[i] = never[up] or self.kind[i] == ALWAYS
            holder[i] = i if self.kind[i] > ALWAYS else holder[up]
        for i in range(n - 1, 0, -1):
            if never[i]:
                continue
            if self.text[i] is not None:
                chars[i] = sum(map(len, self.text[i].split()))
            elif self.name[i] in ARTICLE and self.kind[i] == LIVE:
                articles[i] += 1
                own[holder[i]] += 1
            chars[self.parent[i]] += chars[i]
            articles[self.parent[i]] += articles[i]
        found, noise = own[0] > 0, [False] * n
        for i in range(1, n):
            noise[i] = never[i] or noise[self.parent[i]]
            if noise[i] or self.kind[i] <= ALWAYS:
                continue
            bulk = chars[i] > BULK[self.kind[i]] * chars[0] and (self.kind[i] == SOME_WORD or not found)
            if bulk or (articles[i] and not found):
                found = found or own[i] > 0
            else:
                noise[i] = True
        return noise

    def densities(self) -> tuple[list[float], list[float]]:
        """Density of every block, and the sum of its children's. Other nodes have 0."""
        n = len(self.name)
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        in_link, block = [False] * n, [0] * n
        for i in range(1, n):
            up = self.parent[i]
            in_link[i] = in_link[up] or self.name[i] == "a"
            block[i] = i if self.name[i] in BLOCK and not self.noise[i] else block[up]
        # What stands right in a block, elements inside a line included, is one child of it.
        for i in range(1, n):
            if self.noise[i]:
                continue
            own = block[i]
            if self.text[i] is not None:
                size = sum(map(len, self.text[i].split()))
                chars[own] += size
                link_chars[own] += size if in_link[i] else 0
            elif self.name[i] == "a":
                tags[own] += 1
                link_tags[own] += 1
        line = [(c, lc, t, lt) for c, lc, t, lt in zip(chars, link_chars, tags, link_tags)]
        for i in range(n - 1, 0, -1):
            if block[i] == i:
                up = block[self.parent[i]]
                chars[up] += chars[i]
                link_chars[up] += link_chars[i]
                tags[up] += tags[i] + 1
                link_tags[up] += link_tags[i]
        share = link_chars[0] / max(1, chars[0])

        def of(c: int, lc: int, t: int, lt: int) -> float:
            if not c:
                return 0.0
            t, lt = max(1, t), max(1, lt)
            base = c / max(1, c - lc) * lc + share * c + math.e
            return c / t * math.log(1 + c / max(1, lc) * t / lt) / math.log(base)

        density, total = [0.0] * n, [0.0] * n
        for i in range(n):
            if block[i] == i and not self.noise[i]:
                density[i] = of(chars[i], link_chars[i], tags[i], link_tags[i])
                total[i] += of(*line[i])
                if i:
                    total[block[self.parent[i]]] += density[i]
        return density, total

    def chosen(self) -> list[int]:
        """The subtrees of the main text: that of the greatest sum, and those beside it that reach its threshold."""
        n = len(self.name)
        density, total = self.densities()
        blocks = [i for i in range(n) if total[i] > 0]
        if not blocks:
            return []
        best = max(blocks, key=lambda i: (total[i], -i))
        path, node, bound = [], best, 0
        while node > 0:
            if self.name[node] in BLOCK or node == best:
                path.append(node)
            if self.name[node] in ARTICLE:
                bound = node
            node = self.parent[node]
        threshold = min(density[i] for i in path) if path else 0.0
        # Subtrees that reach the threshold, outermost first, give their own greatest sum.
        greatest = list(range(n))
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            if total[greatest[i]] > total[greatest[up]]:
                greatest[up] = greatest[i]
        found, on_path, done = [best], set(path), [False] * n
        done[best] = True
        within = [i == bound for i in range(n)]
        for i in range(1, n):
            within[i] = within[i] or within[self.parent[i]]
            done[i] = done[i] or done[self.parent[i]]
            if within[i] and not done[i] and i not in on_path and density[i] >= threshold > 0 and self.name[i] not in ("html", "body"):
                found.append(greatest[i] if total[greatest[i]] > 0 else i)
                done[i] = True
        if bound and self._characters(found) > WIDENED * self._characters([bound]):
            return [bound]
        return found

    def _under(self, tops: list[int]) -> list[bool]:
        """Which nodes are in the subtrees of ``tops`` and not noise."""
        inside = [False] * len(self.name)
        for i in tops:
            inside[i] = True
        for i in range(1, len(inside)):
            inside[i] = (inside[i] or inside[self.parent[i]]) and not self.noise[i]
        return inside

    def _characters(self, tops: list[int]) -> int:
        return sum(sum(map(len, self.text[i].split())) for i, there in enumerate(self._under(tops)) if there and self.text[i])

    def content(self) -> list[bool]:
        """Which nodes belong to the main text."""
        return self._under(self.chosen())

    def blocks(self) -> list[str]:
        """The main text's blocks in page order."""
        inside = self.content()
        n = len(self.name)
        holder = [0] * n  # the block element that a node is in
        for i in range(1, n):
            holder[i] = i if self.name[i] in BLOCK else holder[self.parent[i]]
        found, run, last = [], [], None

        def flush() -> None:
            # Raw pieces are decoded together: a reference does not cross a tag, but spaces do.
            words = "".join(run).split()
            if words:
                found.append(" ".join(words))
            run.clear()

        for i in range(1, n):
            if self.name[i] in BLOCK or holder[i] != last:
                flush()
                last = holder[i]
            if not inside[i]:
                continue
            if self.text[i] is not None:
                run.append(html.unescape(self.text[i]))
            elif self.name[i] == "br":
                run.append(" ")
        flush()
        return found


def main_text(source: str | None) -> str:
    return "\n\n".join(Page(source).blocks()) if source else ""


def extract(df: DataFrame, key: dict[str, Column], html_col: str = "html") -> DataFrame:
    """The columns of ``key``, ``text`` and ``n_chars`` (code points) of every page."""
    source = df.select(*[c.alias(n) for n, c in key.items()], F.col(html_col).cast("string").alias("_html"))
    names = list(key)
    schema = ", ".join(f"`{n}` {source.schema[n].dataType.simpleString()}" for n in names)

    def work(piece: pa.RecordBatch):
        texts = [main_text(h) for h in common.texts_of(piece, "_html")]
        return {n: piece.column(n) for n in names} | {
            "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        }

    return common.map_texts(source, "_html", schema + ", text string, n_chars bigint", work)
