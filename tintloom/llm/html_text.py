"""HTML extraction by consensus host paths.

A page's containers are scored by the text of their paragraphs, and the best one is widened to the article or
main around it; the page votes for its generalised tag-class path. Votes are counted per host and path in Spark; each page's text is then taken from the
elements on its host's winning path, or from its own best container where it has none there.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tintloom.llm.common import slices, small_batches, stored
from tintloom.llm.url_filter import url_host

# Fixed values of HTML: elements without content, with raw text, and that begin or end a block of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCKS - {"br", "button", "body", "caption", "head", "html", "legend", "option", "optgroup", "tbody", "td", "tfoot", "th", "thead", "tr", "select"}
#: An opening tag of the key closes an open element of the value, unless an element of the second set stands between.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
# What the extraction leaves out: elements, roles, and words of a class or id.
DROPPED = frozenset("head nav footer aside form button select dialog menu search".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
DROPPED_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header masthead menu modal nav navbar navigation "
    "newsletter notice popup promo promotion related replies reply respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
#: Words that name the part or the place of furniture, those of a head, and those of an article, whose head is its own.
NEUTRAL_WORDS = frozenset(
    "area article bar block blog bottom box btn button buttons center column container content count desktop entry form global group icon icons inline inner item items label left link links list message mobile module "
    "msg news outer overlay page panel post posts region right row section sign signup site slot sticky story sub text thread title top unit up user users view wrap wrapper zone".split()
)
HEADS, TEXTS = frozenset("banner header masthead".split()), frozenset("article content entry post story".split())
CONTAINERS = frozenset("article body div main section td".split())
#: Score of a container for its name, and the share of a container's score that its parent gets.
NAMED, PARENT = {"article": 1.5, "main": 1.3}, 0.5
#: What a container around the best one may add, as a share of its text.
WIDEN = 0.3

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|textarea|title|svg|math|iframe|object|canvas|noembed|noframes|xmp)\b[^>]*+>.*?(?:</(?P=raw)\s*+[^>]*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>|<[!?/][^>]*+>",
    re.DOTALL | re.IGNORECASE,
)
#: An attribute after the one before it: its name, and a quoted or bare value.
ATTRIBUTE = re.compile(r"([^\s/=>]++|=[^\s/=>]*+)(?:\s*+=\s*+(?:\"([^\"]*+)(?:\"|\Z)|'([^']*+)(?:'|\Z)|([^\s>]++)))?+")
ATTRIBUTES = frozenset("class id role hidden aria-hidden style".split())
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
WORDS, CAMEL = re.compile(r"[a-z]+"), re.compile(r"(?<=[a-z])(?=[A-Z])")


class Element:
    """An element with what it takes from those around it: nothing is looked up along the ancestors later."""

    __slots__ = ("tag", "step", "key", "parent", "dropped", "order", "holder", "linking", "article", "main", "chars", "linked", "score", "headed")

    def __init__(self, tag: str, step: str, parent: Element | None, dropped: bool, order: int):
        self.tag, self.step, self.parent, self.dropped, self.order = tag, step, parent, dropped, order
        #: Stands for the path within this process; inline elements have their parent's.
        self.key: int = 0 if parent is None else hash((parent.key, step)) if step else parent.key
        holds = parent is None or tag in CONTAINERS
        self.holder: Element = self if holds else parent.holder
        self.linking: bool = not holds and (tag == "a" or parent.linking)
        self.article: Element | None = self if tag == "article" else parent and parent.article
        self.main: Element | None = self if tag == "main" else parent and parent.main
        self.chars, self.linked, self.score, self.headed = 0, 0, 0.0, False

    def path(self) -> str:
        steps, e = [], self
        while e is not None:
            if e.step:
                steps.append(e.step)
            e = e.parent
        return "/".join(reversed(steps))


def _attributes(text: str) -> dict[str, str]:
    """The attributes of a tag that count here; of a repeated one the first, as in a browser."""
    out: dict[str, str] = {}
    if text and not text.isspace():
        for m in ATTRIBUTE.finditer(text):
            if (name := m[1].lower()) in ATTRIBUTES and name not in out:
                out[name] = m[2] or m[3] or m[4] or ""
    return out


def _step(tag: str, attrs: dict[str, str]) -> str:
    """An element in a generalised path: tag and sorted classes, without the digits of a class."""
    names = sorted({n for c in attrs.get("class", "").lower().split() if (n := re.sub(r"[\d]+", "", c).strip("-_"))})
    return ".".join([tag, *names])


def _dropped(tag: str, attrs: dict[str, str], inside: bool) -> bool:
    """Whether an element is furniture; a header inside an article or main holds its headline and stays.

    A class or id counts if it has a word of furniture and no other words but neutral ones, so "share-buttons"
    does and "social-history" doesn't.
    """
    if tag in DROPPED or (tag == "header" and not inside):
        return True
    if not attrs or tag in ("html", "body", "article", "main"):
        return False
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or HIDDEN_STYLE.search(attrs.get("style", "")):
        return True
    if attrs.get("role", "").lower() in DROPPED_ROLES:
        return True
    for name in [*attrs.get("class", "").split(), attrs.get("id", "")]:
        words = set(WORDS.findall(CAMEL.sub(" ", name).lower()))
        if inside or words & TEXTS:
            words -= HEADS
        if words & DROPPED_WORDS and words <= DROPPED_WORDS | NEUTRAL_WORDS:
            return True
    return False


def parse(page: str) -> tuple[list[Element], list[tuple[Element, str, bool]]]:
    """The elements of a page and its pieces of text: (innermost element, text, whether a block begins here)."""
    root = Element("", "", None, False, 0)
    stack, elements, pieces, fresh, at = [root], [root], [], True, 0
    open_: dict[str, int] = {}

    def close(i: int) -> None:
        for e in stack[i:]:
            open_[e.tag] -= 1
        del stack[i:]

    for m in TOKEN.finditer(page):
        if m.start() > at:
            pieces.append((stack[-1], page[at : m.start()], fresh))
            fresh = False
        at = m.end()
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        fresh = fresh or tag in BLOCKS
        if m["end"] or m["end2"]:
            for i in range(len(stack) - 1, 0, -1) if open_.get(tag) else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag not in BLOCKS and stack[i].tag in BLOCKS:
                    break  # an inline end tag closes nothing beyond its block
            continue
        if tag in VOID:
            continue
        closes, stops = IMPLIED.get(tag, (set(), set()))
        ends_p = tag in CLOSES_P and open_.get("p")
        for i in range(len(stack) - 1, 0, -1) if ends_p or any(open_.get(t) for t in closes) else ():
            if stack[i].tag in closes or (stack[i].tag == "p" and ends_p):
                close(i)
                break
            if stack[i].tag in stops or stack[i].tag in BLOCKS and tag not in IMPLIED:
                break
        attrs = _attributes(m["attrs"] or m["attrs2"] or "")
        parent = stack[-1]
        inside = parent.article is not None or parent.main is not None
        element = Element(tag, _step(tag, attrs) if tag in BLOCKS else "", parent, parent.dropped or _dropped(tag, attrs, inside), len(elements))
        open_[tag] = open_.get(tag, 0) + 1
        elements.append(element)
        stack.append(element)
    if at < len(page):
        pieces.append((stack[-1], page[at:], fresh))
    return elements, pieces


def _widened(best: Element, elements: list[Element]) -> Element:
    """The container with what belongs to it: headline and lead often stand beside it.

    Inside an article or main that is the article, or the main where it has one article and most of the text
    beside that isn't links. Elsewhere it is the container around, as long as that adds little text, which isn't
    mostly links; the whole body only where the headline is in what it adds.
    """
    article, main = best.article, best.main
    if article is not None and main is not None:
        if any(e.tag == "article" and not e.dropped and e.main is main and e.article is e and e is not article and (e.parent is None or e.parent.article is not article) for e in elements[main.order :]):
            return article
        chars, linked = main.chars - article.chars, main.linked - article.linked
        return main if 2 * linked < chars else article
    if article or main:
        return article or main
    while best.parent is not None and (up := best.parent.holder).parent is not None:
        chars, linked = up.chars - best.chars, up.linked - best.linked
        if chars > WIDEN * best.chars or 2 * linked > chars or (up.tag == "body" and not (up.headed and not best.headed)):
            break
        best = up
    return best


def best_container(elements: list[Element], pieces: list[tuple[Element, str, bool]]) -> Element | None:
    """The container with the highest score, widened: the text of its paragraphs without links, and part of its inner containers'."""
    own: dict[int, list[int]] = {}
    for element, text, _ in pieces:
        if element.dropped:
            continue
        n = len(text.strip())
        sums = own.setdefault(element.holder.order, [0, 0])
        sums[0] += n
        sums[1] += n * element.linking
    best = None
    for e in reversed(elements):  # children come before their parents
        up = e.parent and e.parent.holder
        if e.tag == "h1" and not e.dropped:
            up.headed = True
        if e.holder is not e:
            continue
        chars, linked = own.get(e.order, (0, 0))
        e.chars, e.linked = e.chars + chars, e.linked + linked
        e.score += max(0, chars - 2 * linked) * NAMED.get(e.tag, 1.0)
        if up is not None:
            up.score += e.score * PARENT
            up.chars, up.linked, up.headed = up.chars + e.chars, up.linked + e.linked, up.headed or e.headed
        if e.tag in CONTAINERS and not e.dropped and e.score > 0 and (best is None or e.score >= best.score):
            best = e
    # Text outside of any container belongs to the page itself.
    return _widened(best, elements) if best is not None else elements[0] if elements[0].chars else None


def text_of(elements: list[Element], pieces: list[tuple[Element, str, bool]], roots: list[Element]) -> str:
    """Text of the blocks inside `roots`: references decoded piece by piece, white space single, blocks joined by a blank."""
    wanted = {r.order for r in roots}
    under: list[bool] = []
    for e in elements:  # parents come before their children
        under.append(e.order in wanted or (e.parent is not None and under[e.parent.order]))
    out: list[str] = []
    for element, text, fresh in pieces:
        if element.dropped or not under[element.order]:
            out.append(" ")
            continue
        text = entities.unescape(text) if "&" in text else text
        out.append(f" {text}" if fresh else text)
    return " ".join("".join(out).split())


def vote(page: str | None) -> str | None:
    """The generalised path of a page's best container."""
    best = best_container(*parse(page)) if page else None
    return best.path() or None if best else None


def extract(page: str | None, path: str | None) -> str:
    """The page's main text: of the elements on `path`, else of its own best container; empty if it has none."""
    if not page:
        return ""
    elements, pieces = parse(page)
    key = 0
    for step in path.split("/") if path else ():
        key = hash((key, step))
    roots = [e for e in elements if path and e.key == key and e.tag in CONTAINERS and not e.dropped and e.path() == path]
    text = text_of(elements, pieces, roots) if roots else ""
    if not text and (best := best_container(elements, pieces)):
        text = text_of(elements, pieces, [best])
    return text


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, votes, voters): the winning path of each host; ties go to the smaller path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            paths = [vote(p) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(paths, pa.string())], ["host", "path"])

    ballots = pages.select(url_host(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, path string")
    counts = ballots.where("path is not null").groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"))
    winner = F.min(F.struct((-F.col("votes")).alias("against"), "path")).alias("w")
    return counts.groupBy("host").agg(winner, F.sum("votes").alias("voters")).select("host", F.col("w")["path"].alias("path"), (-F.col("w")["against"]).alias("votes"), "voters")


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of `pages` (page_id, url, html).

    A null or empty html, or one without text, gives an empty text; a null url belongs to the empty host.
    Repeated rows are kept and vote once each. Further columns are left out. No rows give no rows.
    """
    small_batches(pages.sparkSession)
    known = pages.select("page_id", "url", "html")
    winners = stored(host_paths(known), "hosts").select("host", "path")
    joined = known.withColumn("host", url_host(F.col("url"))).join(winners, "host", "left").select("page_id", "url", "html", "path")
    schema = T.StructType([*known.select("page_id", "url").schema.fields, T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [extract(p, path) for p, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return joined.mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("long"))
