"""Main text of web pages: flat text blocks, their neighbours' word counts and link densities, a decision tree."""

from __future__ import annotations

import html
import random
import re
from collections import namedtuple
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import batch, bounded_batches, text_of

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: An attribute: its name, and its value in double quotes, in single quotes or bare.
ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>=]+|=)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
BARE = re.compile(r"""[\s/]*([^\s/>=]+|=)(?:\s*=\s*()()([^\s>]*))?""")
#: Elements whose text is never read; without an end the first two reach to the end of the page, the others are passed over.
RAW = frozenset("script style noscript template textarea select svg".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code em font i img kbd label mark q s small span strike strong sub sup time tt u var wbr ins del acronym".split())
#: Containers that hold no main text, by tag.
ASIDE = frozenset("nav footer aside form header menu dialog button head title".split())
#: The same by words of class, id and role; a name of these and of neutral words only is sure, any other that holds one is a hint.
SIDE = frozenset("""ad ads advert adverts advertisement banner sponsor sponsored promo nav navigation navbar menu breadcrumb breadcrumbs sidebar footer masthead notice notices
    cookie cookies consent popup modal comment comments discussion disqus thread replies responses respond related share sharing social subscribe newsletter widget
    complementary contentinfo search""".split())
NEUTRAL = frozenset("""site main top bottom left right list box bar wrap wrapper container link links item items section area block post posts article entry page blog global primary
    secondary inner outer row col column button buttons signup user reader group panel message header""".split())
#: Sides within each other that are told apart; what lies deeper is in these.
DEEPEST = 16
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Elements of a head; any other ends a head that is still open.
METADATA = frozenset("head title base link meta script style noscript template".split())
#: Names of the whole page (``no-sidebar``) say nothing about its text.
WHOLE = frozenset("html body main".split())
#: Tags whose end may be left out: opening the first closes an open one of the second, up to the boundary.
CLOSES = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select"),
}
CLOSES = {tag: (frozenset(ends.split()), frozenset(upto.split())) for tag, (ends, upto) in CLOSES.items()}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADING, CELL = frozenset("h1 h2 h3 h4 h5 h6".split()), frozenset("li td th dt dd".split())


def tokens(page: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """(kind, name or text, attributes): kinds are text, open, close and void. Every character is looked at a bounded number of times.

    A tag that never ends is dropped with what follows it, as browsers do; a ``<`` before anything but a letter, ``/``,
    ``!`` or ``?`` is text.
    """
    at, n, low = 0, len(page), None
    last = {q: page.rfind(q) for q in "\"'>"}
    endless: set[str] = set()
    while at < n:
        i = page.find("<", at)
        if i < 0:
            yield "text", page[at:], {}
            return
        if i > at:
            yield "text", page[at:i], {}
        c = page[i + 1 : i + 2]
        if c in ("!", "?"):
            mark = "-->" if page.startswith("<!--", i) else ">"
            j = page.find(mark, i + (4 if mark == "-->" else 2))
            if j < 0:
                return
            at = j + len(mark)
            continue
        m = NAME.match(page, i + 1 + (c == "/"))
        if not m:
            yield "text", "<", {}
            at = i + 1
            continue
        if i > last[">"]:
            return
        tag, fields, j = m[0].lower(), {}, m.end()
        while True:
            a = (ATTRIBUTE if j < last["'"] or j < last['"'] else BARE).match(page, j)
            if not a or a.end() == j:
                break
            fields.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
            j = a.end()
        j = page.find(">", j)
        if j < 0:
            return
        at = j + 1
        if c == "/":
            yield "close", tag, {}
            continue
        yield "void" if tag in VOID or page[j - 1] == "/" else "open", tag, fields
        if tag in RAW and page[j - 1] != "/" and tag not in endless:
            low = low or page.lower()
            low = low if len(low) == n else page  # a letter that grows in lower case moves places
            j = low.find(f"</{tag}", at)
            if j >= 0:
                at = j
            elif tag in ("script", "style"):
                return
            else:
                endless.add(tag)


def named(fields: dict[str, str]) -> int:
    """2 where class, id or role surely name a side container, 1 where they hold a word of one, else 0."""
    level = 0
    for name in (x for f in ("class", "id", "role") for x in fields.get(f, "").split()):
        words = {w.lower() for w in WORDS.findall(name)}
        if words & SIDE or words == {"header"} or words == {"site", "header"}:
            level = max(level, 2 if words <= SIDE | NEUTRAL else 1)
    return level


#: A block: its text and what the tree is told of it, its neighbours aside.
Block = namedtuple("Block", "text words density side kind region")


def blocks(page: str) -> tuple[list[Block], dict[int, str]]:
    """The flat text blocks in page order, and the tag of each region (an article or main element) by its number.

    side is 2 in a side container, 1 in one whose name hints at it; kind is 2 for headings, 1 for list items and
    cells; region is the number of the innermost article or main element, 0 outside of them. A container is no side
    where it is the page itself: it holds over half of the page's words and all of its first headings, articles and main
    elements that no other side holds, or it is a form and there are none.
    """
    found, text, links, in_link, link_depth = [], [], 0, False, 0
    #: tag, the sides around and their levels, region
    stack: list[tuple[str, tuple[int, ...], int]] = []
    regions: dict[int, str] = {}
    levels: list[tuple[int, str]] = []
    sides: list[tuple[int, ...]] = []
    marks: list[bool] = []

    def close() -> None:
        nonlocal links
        whole = " ".join("".join(text).split())
        if whole:
            n, tags = len(whole.split()), {t for t, _, _ in stack[-2:]}
            kind = 2 if tags & HEADING else 1 if tags & CELL else 0
            found.append(Block(whole, n, min(1.0, links / n), 0, kind, stack[-1][2] if stack else 0))
            sides.append(stack[-1][1] if stack else ())
            marks.append("h1" in tags or bool(stack and stack[-1][2]))
        text.clear()
        links = 0

    def pop(k: int) -> None:
        nonlocal in_link
        del stack[k:]
        in_link = in_link and len(stack) >= link_depth

    open_at: dict[str, int] = {}  # how many of a tag are open: an end tag without its start costs no search
    for what, tag, fields in tokens(page):
        if what == "text":
            plain = html.unescape(tag)
            text.append(plain)
            links += len(plain.split()) if in_link else 0
            continue
        if what != "close" and open_at.get("head") and tag not in METADATA:
            close()
            k = next(k for k, (t, _, _) in enumerate(stack) if t == "head")
            for t, _, _ in stack[k:]:
                open_at[t] -= 1
            pop(k)
        if tag == "a":
            in_link, link_depth = what == "open", len(stack)
        if tag in INLINE:
            if tag == "br":
                text.append(" ")
            continue
        close()
        if what == "close":
            if open_at.get(tag):
                k = len(stack) - 1
                while stack[k][0] != tag:
                    k -= 1
                for t, _, _ in stack[k:]:
                    open_at[t] -= 1
                pop(k)
        elif what == "open":
            ended, upto = CLOSES.get(tag, (frozenset(), frozenset()))
            first = len(stack) - 1 if stack and stack[-1][0] == "p" else len(stack)
            if any(open_at.get(t) for t in ended):
                for k in range(first - 1, -1, -1):
                    if stack[k][0] in upto:
                        break
                    if stack[k][0] in ended:
                        first = k
                        break
            for t, _, _ in stack[first:]:
                open_at[t] -= 1
            pop(first)
            level = 2 if tag in ASIDE else 0 if tag in WHOLE else named(fields)
            region, around = stack[-1][1:][::-1] if stack else (0, ())
            if tag in ("article", "main") or fields.get("role", "").lower() == "main":
                level = 0 if tag == "article" and level == 1 else level
                region = len(regions) + 1
                regions[region] = "article" if tag == "article" else "main"
            # a side within one that is as sure adds nothing, but that either may turn out to be the page
            if level and (len(around) < DEEPEST or level > max(levels[c][0] for c in around)):
                around = (*around, len(levels))
                levels.append((level, tag))
            stack.append((tag, around, region))
            open_at[tag] = open_at.get(tag, 0) + 1
    close()
    total, held = sum(x.words for x in found), [0] * len(levels)
    for x, around in zip(found, sides, strict=True):
        for c in around:
            held[c] += x.words
    own: list[int] = [0] * len(levels)
    free = 0  # marks that no side holds
    for around, mark in zip(sides, marks, strict=True):
        for c in around if mark else ():
            own[c] += 1
        free += mark and not around
    wide = [c for c in range(len(levels)) if 2 * held[c] > total]
    outside = dict.fromkeys(wide, free)
    for around, mark in zip(sides, marks, strict=True):
        # a mark in wide sides alone speaks against those of them that do not hold it
        if mark and around and all(2 * held[c] > total for c in around):
            for c in wide:
                outside[c] += c not in around
    page_itself = {c for c in wide if not outside[c] and (own[c] or levels[c][1] == "form")}
    return [x._replace(side=max((levels[c][0] for c in around if c not in page_itself), default=0)) for x, around in zip(found, sides, strict=True)], regions


def rows_of(page: str) -> tuple[list[str], list[tuple]]:
    """Texts of the blocks and their features: words, link density, the same of the block before and of the one after, side, place, kind.

    place is 1 in an article or main element, 0.5 in an article of under a third of the words of the page's longest,
    -1 outside of them on a page that has one beside its side containers, 0 on other pages.
    """
    got, regions = blocks(page)
    size: dict[int, int] = {}
    for x in got:
        if x.region and x.side < 2:
            size[x.region] = size.get(x.region, 0) + x.words
    longest = max((n for r, n in size.items() if regions[r] == "article"), default=0)
    near = [(0, 0.0), *((x.words, x.density) for x in got), (0, 0.0)]

    def place(x: Block) -> float:
        if not x.region:
            return -1.0 if size else 0.0
        return 0.5 if regions[x.region] == "article" and 3 * size.get(x.region, 0) < longest else 1.0

    return [x.text for x in got], [(x.words, x.density, *near[i], *near[i + 2], x.side, place(x), x.kind) for i, x in enumerate(got)]


#: The labelled table as pages in short: ``{n}`` stands for n words, ``[n]`` for n linked words, ``+`` marks a block of the main text.
LABELLED = [
    "<nav><ul><li>[1]<li>[2]<li>[1]</ul></nav><div class=ad>{9}</div><article><h1>+{8}</h1><p>+{80}<p>+{60}<h2>+{3}</h2><p>+{45}<p>+[6]<p>+{30}<p>+{2}<p>+[4] {1}<ul><li>+[3]<li>+[4]</ul><p>+{12}</article><footer>{14} [2]</footer>",
    "<header>{3} [4]</header><main><h1>+{6}</h1><p>+{70}<p>+{5}<p>+{40} [3]<div class=comments><p>{30}<p>{12}</div></main><aside><h3>{2}</h3><p>{40}<ul><li>[5]<li>[6]</ul></aside><footer>{9}</footer>",
    "<div id=top>[1] [1] [2] [1]</div><div><h1>+{7}</h1><p>+{90}<p>+{65} [4]<p>+{4}<p>+{50}<p>+{2}</div><div>[4]</div><div>[3]</div><div>{5} [6]</div>",
    "<div>[2]</div><div>[3]</div><div>[2]</div><h2>+{5}</h2><div>+{75}</div><div>+{3}</div><div>+{24}</div><div>+{9}</div><div>+{48} [2]</div><div>[6]</div><div>[9]</div><div>[5]</div>",
    "<table><tr><td>[1]<td>[1]<td>[2]</table><h1>+{4}</h1><div>+{35} [12]</div><div>+{28}</div><div>+{60}</div><div>+{14}</div><div>[8]</div><div>[3] {1}</div>",
    "<body class=no-sidebar><div class=site-header>{4}</div><div class=content><h1>+{9}</h1><div class=share-content><p>+{55}<p>+{40}</div><div class=related-work><h2>+{2}</h2><p>+{33}<p>+{21} [4]</div></div><div class='related posts'><p>{30}<p>[7]</div>",
    "<article><h1>+{5}</h1><p>+{120}<div class=notice-inline>{6} [4]</div><p>+{70}<div class=promo-teaser-x>[5]</div><p>+{20}</article><article class=teaser><h2>[6]</h2><p>{18}</article><article class=teaser><h2>[5]</h2><p>{14} [2]</article>",
    "<main><article><h1>+{7}</h1><p>+{50}<p>+{44}<p>+[9]<p>+{31}</article><article><h3>[4]</h3><p>{11}</article><article><h3>[5]</h3><p>{9}</article></main><p>{20}<p>{60}<div>{3}</div>",
    "<article><h2>+[5]</h2><p>+{40}</article><article><h2>+[6]</h2><p>+{38} [2]</article><article><h2>+[4]</h2><p>+{52}</article><div>{12}</div><div>{80}</div>",
    "<div class=page-header><h1>+{6}</h1></div><div>+{60}</div><div>+{45}</div><div class=reader-comments-x><p>{2} [3]<p>[4]</div><div class=social>[2] [2]</div>",
    "<nav>[1] [1] [1]</nav><h1>+{6}</h1><p>+{18}<p>+{22}<p>+{10}<p>+{18} [2]<p>+{12}<p>[4]<p>[3]",
    "<form>{5}</form><p>+{100}<p>+{120}<div class=cookie-consent>{25} [2]</div><p>+{90}<div>{4} [8]</div>",
    "<article><h1>+{4}</h1><p>+{90}<p>+[7]<p>+{64}<ul><li>+[2]<li>+[5] {1}</ul><div class=promo-box-x>[6]</div><p>+{15}<p>+[9]<div class=share-this>[2] [1]</div><p>+{70}<p>+[3] [4]</article>",
    "<main><h1>+{3}</h1><p>+{60}<p>+[5]<p>+{75} [30]<div class=menu-x>[2] [3]</div><p>+{8}<div class=search-x>{3} [2]</div></main>",
    "<nav>[1] [2]</nav><article><h1>+{5}</h1><p>+{40}<p>+{25}<p>+{8}</article>",
    "<h1>+{5}</h1><p>+{60}<p>+{30}<p>+{9}<p>+{2}",
    "<p>+{40}<p>+{6}<p>+{3} [1]",
    "<div>[2]</div><main><p>+{30}<p>+{1}<p>+{1}<p>+{14}</main>",
    "<article><p>+{12}</article>",
    "<h2>+{3}</h2><div>+{50} [2]</div><div>+{20}</div><div>+{4}</div>",
    "<p>+{1}<p>+{1}<p>+{30} [3]<p>+{3}",
    "<article><h1>+{6}</h1><p>+{30}<p>+{1}<p>+{55}<p>+[4]</article>",
    "<main><p>+{2}</main><footer>{10}</footer>",
    "<article><p>+{18}</article><div class=sidebar><p>{100}<p>{60}</div>",
    "<h1>+{2}</h1><p>+{24}<p>+{24}<h3>+{2}</h3><p>+{24}<p>+{2}<p>+{36}<div>[2]</div><div>[2]</div>",
    "<div>[2] {1}</div><div>[1]</div><div>+{40}</div><ul><li>+{8}<li>+{6}<li>+{11}</ul><div>+{30}</div><ul><li>[3]<li>[4]<li>[2]</ul>",
    "<div>+{15} [2]</div><div>+{30}</div><div>+{6}</div><div>+{40}</div><div>[7] {2}</div><div>[6]</div>",
]


def labelled(variants: int = 16, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the blocks of the labelled pages, each as written and with other lengths and some blocks left out."""
    rng, x, y = random.Random(seed), [], []
    for short in LABELLED:
        for k in range(variants):

            def words(n: str, k: int = k) -> int:
                return int(n) if not k else 0 if rng.random() < 0.2 else max(1, round(int(n) * rng.uniform(0.1, 2.0)))

            def filled(m: re.Match) -> str:
                n = words(m[2] or m[3])
                return (m[1] + "w " * n if m[2] else f"{m[1]}<a href=x>{'l ' * n}</a>") if n else ""

            page = re.sub(r"(\+?)(?:\{(\d+)\}|\[(\d+)\])", filled, short)
            texts, rows = rows_of(page)
            x += rows
            y += [float(t.startswith("+")) for t in texts]
    return np.array(x, float), np.array(y)


class Tree:
    """A decision tree by Gini impurity; small enough to travel with the task. A leaf holds ``least`` rows or more."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 12):
        self.share = float(y.mean()) if len(y) else 0.0
        self.split = None
        best, n = self.share * (1 - self.share) * len(y) - 1e-9, len(y)
        for j in range(x.shape[1]) if depth and 0 < self.share < 1 else ():
            order = np.argsort(x[:, j], kind="stable")
            values, ones = x[order, j], np.cumsum(y[order])
            low = np.arange(1, n)
            fits = (values[1:] > values[:-1]) & (low >= least) & (n - low >= least)
            a, b = ones[:-1] / low, (ones[-1] - ones[:-1]) / (n - low)
            cost = np.where(fits, a * (1 - a) * low + b * (1 - b) * (n - low), np.inf)
            if fits.any() and cost.min() < best:
                k = int(np.argmin(cost))
                best, self.split = float(cost[k]), (j, float(values[k] + values[k + 1]) / 2)
        if self.split:
            low = x[:, self.split[0]] <= self.split[1]
            self.low, self.high = Tree(x[low], y[low], depth - 1, least), Tree(x[~low], y[~low], depth - 1, least)

    def says(self, row: tuple) -> bool:
        node = self
        while node.split:
            node = node.low if row[node.split[0]] <= node.split[1] else node.high
        return node.share >= 0.5


@lru_cache(maxsize=1)
def trained() -> Tree:
    """The tree over the labelled blocks."""
    return Tree(*labelled())


def main_text(page: str, tree: Tree) -> str:
    texts, rows = rows_of(page)
    return " ".join(t for t, row in zip(texts, rows, strict=True) if tree.says(row))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text: the blocks that the tree calls main text, joined by spaces.

    A null or empty html, or a page without main text, has the empty text. Pages are read whole, in time linear
    in their length. Repeated rows and null ids or urls stay as they are; other columns are ignored; an empty
    table gives no rows.
    """
    bounded_batches(pages.sparkSession)
    tree = trained()
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch(schema, [b.column(0), b.column(1), [main_text(x, tree).encode("utf-8", "replace").decode() for x in b.column(2).to_pylist()]])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), text_of("html").alias("html")).mapInArrow(run, "page_id long, url string, text string")


def digest(pages: DataFrame) -> DataFrame:
    """The columns of query op10."""
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
