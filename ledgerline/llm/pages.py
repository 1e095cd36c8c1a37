"""Main text of web pages, with site templates removed (operator 10).

A page is parsed into elements, scripts, styles and what else is never shown left out. Of every
block element two hashes are kept: of its subtree with its text, and, outside the article, of its
frame, the subtree's tags and classes without text, for a site's menus and advert slots show other
words on each page. Spark counts, for each host, on how many different pages each hash is. What is
on MIN_PAGES pages or more and on MIN_SHARE of the host's pages is the site's template, and is cut
out of its pages.

Frames are judged of containers that a site's designer marks: landmarks (menus, footers, headers,
sidebars, forms) and lists of links, and, where the page has an article or main element, outside
it every container with a class, id or role. Inside an article or main element subtrees are judged
by their text, and containers only, never its paragraphs and headings, which may quote each other.
Pages whose text is the same count once, so copies of a page don't turn it into a template.

A host with few pages has no template that could be counted. So, after that, what remains and
has a tag, role or class that never belongs to an article goes too: menus, footers, sidebars,
notices, adverts, forms and comments by readers. Class names count only if all their words are
such words, ids only on plain containers: headings and sections have ids from their own titles
(a section called "comments" and no more is taken for its readers').
Last, the text is that of the page's article elements; of its main element if it has none; else
of its body. removed() tells how many words each of the three took.

Character references are decoded, white space becomes one space, and blocks are joined in page
order by one space. Nothing else is dropped, and nothing is capped.

Nulls and odd input: a null or empty html has the empty text; pages with a null or unreadable
url form one host; rows with a null page_id are pages like others; repeated rows are kept and
count once; unclosed elements end with the element around them or with the page; very long pages
are taken whole. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Why a segment stays or goes.
KEPT, LISTED, OUTSIDE, TEMPLATE = range(4)
MIN_PAGES = 5
MIN_SHARE = 0.2
#: Templates of so many values together are broadcast (8 MB); larger ones are joined by shuffle.
BROADCAST_VALUES, SALTS = 1_000_000, 32

# HTML's element names, and the words of classes and ids that tell what isn't text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("canvas head iframe noscript object option script select style svg template textarea title video audio".split())
DROPPED = frozenset("aside button dialog footer form input label menu nav".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br".split())
PLAIN = frozenset("aside div dl form nav ol table ul".split())
LANDMARKS = frozenset("aside footer form header menu nav".split())
READERS = frozenset("comments disqus replies respond".split())
ARTICLE_WORDS = frozenset("comment comments promo related reply teaser".split())
CONTAINERS = frozenset("article aside div dl fieldset figure footer form header menu nav ol section table ul".split())
JUDGED = CONTAINERS | frozenset("address blockquote dd details dt h1 h2 h3 h4 h5 h6 li p pre td th tr".split())
#: A start tag of the key ends the element before it if that is one of these.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_P = BLOCKS - frozenset("body html br td th tr tbody thead tfoot caption legend summary li dd dt".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus footer gdpr login menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted promotion recommended related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe teaser toolbar widget widgets".split()
)
OUTSIDE_WORDS = frozenset("header masthead topbar".split())
#: Words that say nothing of their own beside one of WORDS: "comment-list", "site-footer".
FILLERS = frozenset(
    "area article articles bar block bottom box btn button buttons col column container content fixed form global group header icons inner item items js left link links list main message outer overlay page panel post posts primary right row secondary section side site slot sticky text thread top unit wrap wrapper".split()
)

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<raw>script|style)\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z!?][^>]*>""",
    
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


def names_of(attributes: str) -> list[tuple[str, str]]:
    return [(key.lower(), a or b or c) for key, a, b, c in _ATTRIBUTE.findall(attributes)] if attributes.strip(" /") else []


def is_word(value: str, words: frozenset[str]) -> bool:
    """Is one of the names in value made of these words, with nothing beside but fillers?"""
    for name in value.split():
        own = {w.lower() for w in _WORD.findall(name)}
        if own & words and own <= words | FILLERS:
            return True
    return False


def is_listed(name: str, named: list[tuple[str, str]], inside: bool) -> bool:
    """Has the element a tag, role or class that never belongs to an article?"""
    if name in DROPPED or name == "header" and not inside:
        return True
    for key, value in named:
        if key == "class" or key == "id" and name in PLAIN:
            if name == "article" and is_word(value, ARTICLE_WORDS):
                return True
            if name in CONTAINERS and (is_word(value, WORDS) or not inside and is_word(value, OUTSIDE_WORDS)):
                return True
        elif key == "id" and name == "section" and value.lower() in READERS:
            return True
        elif key == "role" and value.lower() in ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        elif key == "style" and _HIDDEN.search(value):
            return True
    return False


@dataclass
class Element:
    """A judged element: where its text and its tags are in the page."""

    name: str
    region: str
    marked: bool  # has a class, id or role
    token: int
    mark: int
    chars: int
    linked: int
    stop: tuple[int, int, int, int] = (0, 0, 0, 0)

    def frame(self, marks: list[tuple[int, str]]) -> int:
        own = marks[self.mark : self.stop[1]]
        top = own[0][0]
        return number_of(" ".join(sorted({f"{depth - top}{name}" for depth, name in own})))

    def has_frame(self, articled: bool) -> bool:
        """Is its frame one of a site's template, if it recurs?"""
        if self.region != "body" or self.name not in CONTAINERS:
            return False
        chars, linked = self.stop[2] - self.chars, self.stop[3] - self.linked
        return self.name in LANDMARKS or 2 * linked > chars or articled and self.marked


def number_of(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


class Page:
    """The text blocks of a page: (text, region, listed, the judged elements around it)."""

    def __init__(self, source: str):
        self.blocks: list[tuple[str, str, bool, tuple[int, ...]]] = []
        self.elements: list[Element] = []
        self.tokens: list[str] = []
        self.marks: list[tuple[int, str]] = []  # depth, tag and class of each start tag
        self.stack: list[tuple[str, bool, bool, str, int]] = []  # name, hidden, listed, region, element or -1
        self.held: list[str] = []
        self.chars = self.linked = self.links = 0
        at = 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                self.text(source[at : m.start()])
            at = m.end()
            if name := m["name"]:
                (self.end if m["end"] else self.start)(name.lower(), m["attributes"])
        self.text(source[at:])
        while self.stack:
            self.pop()
        self.flush()

    def region(self) -> str:
        return self.stack[-1][3] if self.stack else "body"

    def text(self, raw: str) -> None:
        if raw and not (self.stack and self.stack[-1][1]):
            self.held.append(raw)
            n = len(raw.strip())
            self.chars += n
            self.linked += n if self.links else 0

    def flush(self) -> None:
        text = " ".join(html.unescape("".join(self.held)).split()) if self.held else ""
        self.held = []
        if text:
            self.tokens.append(text)
            self.blocks.append((text, self.region(), bool(self.stack and self.stack[-1][2]), tuple(x[4] for x in self.stack if x[4] >= 0)))

    def start(self, name: str, attributes: str) -> None:
        block = name in BLOCKS
        if block:
            self.flush()
        if name in VOID:
            return
        if name in ENDS and self.stack and self.stack[-1][0] in ENDS[name]:
            self.pop()
        if name in ENDS_P:
            for k in range(len(self.stack) - 1, -1, -1):
                if self.stack[k][0] == "p":
                    while len(self.stack) > k:
                        self.pop()
                    break
                if self.stack[k][0] in BLOCKS:
                    break
        _, hidden, listed, region, _ = self.stack[-1] if self.stack else ("", False, False, "body", -1)
        named = names_of(attributes)
        hidden = hidden or name in HIDDEN_TAGS
        listed = listed or is_listed(name, named, region != "body")
        if not hidden and not listed and (name == "article" or name == "main" and region == "body"):
            region = name
        judged = -1
        if not hidden and block:
            own = " ".join(v for k, v in named if k in ("class", "role"))
            judged = len(self.elements) if name in (JUDGED if region == "body" else CONTAINERS) else -1
            if judged >= 0:
                marked = any(k in ("class", "id", "role") for k, _ in named)
                self.elements.append(Element(name, region, marked, len(self.tokens), len(self.marks), self.chars, self.linked))
            self.tokens.append(f"<{name}>")
            self.marks.append((len(self.stack), f"{name}.{own}"))
        self.links += name == "a"
        self.stack.append((name, hidden, listed, region, judged))
        if attributes.rstrip().endswith("/") and name in ("svg", "path"):
            self.pop()

    def end(self, name: str, _attributes: str) -> None:
        if name in BLOCKS:
            self.flush()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == name:
                while len(self.stack) > k:
                    self.pop()
                return

    def pop(self) -> None:
        name = self.stack[-1][0]
        if name in BLOCKS:
            self.flush()
        _, hidden, _, _, element = self.stack.pop()
        self.links -= name == "a"
        if not hidden and name in BLOCKS:
            self.tokens.append(f"</{name}>")
        if element >= 0:
            self.elements[element].stop = (len(self.tokens), len(self.marks), self.chars, self.linked)

    def segments(self) -> list[tuple[str, list[int], int]]:
        """All shown text: (text, the hashes of the judged subtrees and frames around it, why it is
        left out if no template has it: KEPT, LISTED or OUTSIDE the article)."""
        regions = {r for _, r, listed, _ in self.blocks if not listed}
        chosen = next((r for r in ("article", "main") if r in regions), "body")
        out: list[tuple[list[str], tuple[int, ...], int]] = []
        for text, region, listed, around in self.blocks:
            why = LISTED if listed else KEPT if region == chosen else OUTSIDE
            if out and out[-1][1:] == (around, why):
                out[-1][0].append(text)
            else:
                out.append(([text], around, why))
        hashes: dict[int, list[int]] = {}
        for k in {k for _, around, _ in out for k in around}:
            own = self.elements[k]
            hashes[k] = [number_of("\x00".join(self.tokens[own.token : own.stop[0]]))]
            if own.has_frame(chosen != "body"):
                hashes[k].append(own.frame(self.marks))
        return [(" ".join(texts), [h for k in around for h in hashes[k]], why) for texts, around, why in out]


SEGMENTS = "array<struct<text:string,around:array<long>,why:tinyint>>"


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, host, body (a hash of the page's own text) and segments of every page."""
    segment = pa.struct([("text", pa.string()), ("around", pa.list_(pa.int64())), ("why", pa.int8())])
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("body", pa.int64()), ("segments", pa.list_(segment))])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in common.sliced(batches):
            ids, urls, hosts, sources = common.batches_of(table, "page_id", "url", "host", "html")
            found = [Page(x).segments() if x else [] for x in sources]
            bodies = [number_of("\x00".join(t for t, _, why in own if why == KEPT)) for own in found]
            yield common.batch(schema, ids, urls, hosts, bodies, [[{"text": t, "around": h, "why": w} for t, h, w in own] for own in found])

    host = F.lower(F.coalesce(F.nullif(F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")), F.lit("")))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", host.alias("host"), "html")
    return rows.mapInArrow(parse, f"page_id long, url string, host string, body long, segments {SEGMENTS}")


def templates(found: DataFrame) -> DataFrame:
    """host, subtrees: the hashes of its template. Each level is summed before it is shuffled."""
    around = F.array_distinct(F.flatten(F.transform("segments", lambda s: s["around"])))
    on = found.select("host", "body", F.explode(around).alias("subtree")).distinct().groupBy("host", "subtree").agg(F.count("*").alias("n"))
    all_pages = found.select("host", "body").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    many = on.where(F.col("n") >= MIN_PAGES).join(all_pages, "host").where(F.col("n") >= MIN_SHARE * F.col("pages"))
    return many.groupBy("host").agg(F.collect_set("subtree").alias("subtrees"))


def judged(pages: DataFrame) -> DataFrame:
    """page_id, url and segments of every page, with why TEMPLATE for those that its host's
    template has."""
    found = common.saved(parsed(pages), "pages")
    cut = common.saved(templates(found), "templates")
    size = cut.agg(F.coalesce(F.sum(F.size("subtrees") + F.lit(8)), F.lit(0))).first()[0]
    if size <= BROADCAST_VALUES:
        both = found.join(F.broadcast(cut), "host", "left")
    else:  # a host's pages are dealt over SALTS tasks, and its template is sent to each
        salted = cut.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        both = found.withColumn("salt", F.pmod(F.xxhash64("page_id", "body"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    around = F.array_distinct(F.flatten(F.transform("segments", lambda s: s["around"])))
    both = both.withColumn("hits", F.array_intersect(around, F.coalesce("subtrees", F.array().cast("array<long>"))))
    why = lambda s: F.when(F.arrays_overlap(s["around"], F.col("hits")), F.lit(TEMPLATE)).otherwise(s["why"])
    return both.select("page_id", "url", F.transform("segments", lambda s: F.struct(s["text"].alias("text"), why(s).alias("why"))).alias("segments"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page. pages: page_id, url, html."""
    own = F.transform(F.filter("segments", lambda s: s["why"] == KEPT), lambda s: s["text"])
    return judged(pages).select("page_id", "url", F.array_join(own, " ").alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def removed(pages: DataFrame) -> DataFrame:
    """why, segments and words: what the template, the lists and the choice of the article each took
    (of what more than one would take, the first in this order), and what is kept."""
    names = F.create_map(*(F.lit(x) for k in enumerate(("kept", "listed", "outside", "template")) for x in k))
    rows = judged(pages).select(F.explode("segments").alias("s"))
    words = F.size(F.split("s.text", " "))
    return rows.groupBy(names[F.col("s.why").cast("int")].alias("why")).agg(F.count("*").alias("segments"), F.sum(words).alias("words"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
