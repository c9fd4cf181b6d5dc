"""Main text of web pages by block rules in two passes.

The markup is cut into blocks: runs of text between block-level tags. The first pass looks
at each block alone. Blocks inside containers that say what they are (menus, footers,
sidebars, adverts, forms, comments, by tag, role or class) are boilerplate, and so are
blocks that are mostly links. Long blocks with many stop words are content. What is short
or has few stop words is ambiguous. The second pass gives ambiguous blocks the label of
their nearest decided neighbours before and after: content where these agree on it, or
where one says so and the block has stop words or is a heading.

Stop words are known for a few languages only, and code, tables and lists have few in any.
So where long blocks without them outweigh those with them, they say nothing about the page:
long blocks are content and shorter ones ambiguous, unless they are mostly links. On other
pages blocks with few stop words are ambiguous, too.

A class, an id or a form tag is weak evidence: layouts are called `with-sidebar`, and whole
pages lie in one form. Such a container is opened, and what it encloses judged like the
rest, if it holds the page's only article or most of its running text.

A page that marks its article (`article` or `main`) settles two questions that densities
cannot: nothing outside is content, and inside a block is ambiguous unless it is mostly
links, with neighbours sought inside only and the article itself as the last word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from bisect import bisect_right
from functools import cached_property
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outreach.llm.common import rows_of

SHORT = 70  # characters; a shorter block alone decides nothing
LONG = 200
LINKS = 0.5  # share of characters in links that makes a block boilerplate
STOP_LOW, STOP_HIGH = 0.20, 0.30
WIDE = 3

# Function words of English, French, German and Spanish.
STOP_WORDS = {
    "en": "a an and are as at be but by for from had has have he her his if in into is it its not of on or she that the their there they this to was we were what which who will with you",
    "fr": "au aux avec ce ces dans de des du elle en est et eux il je la le les leur lui mais me ne nous ou par pas pour qu que qui sa se ses son sur un une vous",
    "de": "aber als am an auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich im in ist mit nach nicht oder sich sie sind so und von war wie wir zu zum zur",
    "es": "a al como con de del el ella en entre es esta este la las lo los más me no nos o para pero por que se si sin sobre su sus un una y ya",
}
_STOP = {k: frozenset(v.split()) for k, v in STOP_WORDS.items()}

_BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol option p pre section select summary table tbody "
    "td tfoot th thead title tr ul".split()
)
_SKIPPED = frozenset("aside button datalist dialog footer form input label menu nav option select title".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_SELF_CLOSING = frozenset("p li dd dt option tr td th".split())  # end where the next block begins
_ROLES = frozenset("banner navigation complementary contentinfo search form dialog alert alertdialog menu menubar".split())
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer disqus footer gdpr menu modal nav navbar navigation newsletter notice notification pagination popup promo "
    "related replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
# Running text that is not the page's own: opened only if the page has no other.
_OTHERS = frozenset("comment comments consent cookie cookies disclaimer disqus gdpr newsletter replies respond".split())
_ROOTS = frozenset("html body article main".split())
# What stands beside a boilerplate name without changing its sense. Inside an article a name
# beside any other word, as in `related-work`, says nothing: links and density decide.
_STRUCTURE = frozenset(
    "area bar block body bottom box button buttons card cards center column container content form inner item items large layer left link links "
    "list main mobile outer page panel post posts article articles entry right row section site slot small stories top unit wrap wrapper".split()
)
_FOREIGN = frozenset("svg math".split())  # close themselves with `/>`, end where a block begins
_INERT = frozenset("template object canvas".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<raw>script|style|noscript|iframe|textarea|title|xmp|noembed|noframes)\b(?:[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attrs>(?:[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+)>?",
    re.DOTALL | re.IGNORECASE,
)
_NAMED = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORD = re.compile(r"[^\W\d_]+")
_WIDE = re.compile("[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff\U00020000-\U0003ffff]")  # say as much as WIDE others


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    heading: bool
    inside: int  # number of the article it lies in, 0 for none
    skipped: bool
    weak: int = 0  # number of the container it is skipped with on weak evidence, 0 for none
    own: bool = False  # lies in an article inside that container
    others: bool = False  # that container is named as one of other people's text
    at: int = 0  # where in the page it ends

    @cached_property
    def stops(self) -> float:
        return stop_share(self.text)

    @cached_property
    def size(self) -> int:
        """Characters, wide ones counted WIDE times."""
        return len(self.text) if self.text.isascii() else len(self.text) + (WIDE - 1) * len(_WIDE.findall(self.text))

    @property
    def links(self) -> bool:
        return self.linked > LINKS * len(self.text)

    def running(self, dense: bool) -> int:
        """Size, if the block is running text: by its stop words, or else by its length."""
        return self.size if not self.links and (self.stops >= STOP_LOW if dense else self.size >= SHORT) else 0


def _boilerplate_names(attrs: str, in_article: bool) -> set[str] | None:
    """What in class or id says boilerplate; None if the role says so."""
    found: set[str] = set()
    for name, value in _NAMED.findall(attrs):
        value = value.strip("\"'")
        if name.lower() == "role":
            if value.lower() in _ROLES:
                return None
        elif name.lower() in ("class", "id"):
            for token in value.split():
                parts = {p.lower() for p in _PARTS.findall(token)}
                if in_article and parts - _NAMES - _STRUCTURE:
                    continue
                found |= parts & _NAMES
                if "header" in parts and not in_article:
                    found.add("header")
    return found


def blocks(html: str | None, opened: frozenset[int] = frozenset()) -> list[Block]:
    """Blocks with text, in page order. `opened` containers are skipped on strong evidence
    only."""
    out: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    skip = ""  # the tag whose end closes the skipped container
    weak = own = 0  # its number if the evidence is weak; articles open inside it
    others = False
    depth = articles = inside = nested = links = 0
    heading = False

    def flush() -> None:
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, len(" ".join("".join(linked).split())), heading, inside, bool(skip), weak if skip else 0, bool(skip and own), bool(skip and others), at))
        parts.clear()
        linked.clear()

    def add(data: str) -> None:
        if data:
            data = unescape(data)
            parts.append(data)
            if links:
                linked.append(data)

    at = 0
    html = html or ""
    inert, deep = "", 0  # the foreign or inert element whose text is no one's, and its depth
    for m in _TOKEN.finditer(html):
        if not inert:
            add(html[at : m.start()])
        at = m.end()
        tag = m.group("tag")
        if not tag:
            if m.group("raw"):
                parts.append(" ")
            continue
        tag, end = tag.lower(), bool(m.group("end"))
        if inert:
            if tag == inert:
                deep += -1 if end else 1
                inert = inert if deep else ""
                continue
            if not (end and tag in ("article", "main", "body", "html") or not end and inert in _FOREIGN and tag in _BLOCKS):
                continue
            inert = ""
        if tag in _FOREIGN or tag in _INERT:
            parts.append(" ")
            if not end and not (tag in _FOREIGN and m.group("attrs").rstrip().endswith("/")):
                inert, deep = tag, 1
            continue
        if tag == "a":
            links = 0 if end else 1
        if tag == "br":
            parts.append(" ")
            continue
        block = tag in _BLOCKS
        if block:
            flush()
            heading = not end and tag in ("h1", "h2", "h3", "h4", "h5", "h6")
            if not end:
                links = 0
        if skip:
            if not end and block and skip in _SELF_CLOSING:
                skip = ""
            elif tag == skip and tag not in _VOID:
                depth += -1 if end else 1
                if not depth:
                    flush()
                    skip = ""
                continue
            elif tag in ("article", "main") and (own or not end):
                own += -1 if end else 1
                continue
            elif end and tag in ("article", "main", "body", "html"):
                skip = ""
            else:
                continue
        if tag in ("article", "main"):
            if not end:
                if not nested:
                    articles += 1
                    inside = articles
                nested += 1
            elif nested:
                nested -= 1
                inside = inside if nested else 0
        elif not end and tag not in _VOID:
            strong = (tag in _SKIPPED and tag != "form") or (tag == "header" and not inside)
            names: set[str] | None = set()
            if not strong and tag not in _ROOTS and (block or tag in ("span", "ins", "b", "i")):
                names = _boilerplate_names(m.group("attrs"), bool(inside))
                strong = names is None
            if strong or ((names or tag == "form") and at not in opened):
                if not block:
                    flush()
                skip, depth, own = tag, 1, 0
                weak, others = (0, False) if strong else (at, bool(names & _OTHERS))
    if not inert:
        add(html[at:])
    flush()
    return out


def stop_share(text: str) -> float:
    """Share of stop words, in the language that has most of them."""
    words = _WORD.findall(text.lower())
    if not words:
        return 0.0
    return max(sum(w in own for w in words) for own in _STOP.values()) / len(words)


def stops_tell(found: list[Block]) -> bool:
    """Whether stop words tell text from boilerplate in these blocks."""
    long = [b for b in found if b.size >= SHORT and not b.links]
    return 2 * sum(b.size for b in long if b.stops >= STOP_LOW) >= sum(b.size for b in long)


def _weak_spans(html: str) -> list[tuple[int, int]]:
    """Where the containers of names and forms begin and end, by tags alone, nested ones too."""
    spans: list[tuple[int, int]] = []
    inner: list[list] = []  # open containers: tag, depth, begin
    for m in _TOKEN.finditer(html):
        tag = (m.group("tag") or "").lower()
        end = bool(m.group("end"))
        if inner and tag == inner[-1][0]:
            inner[-1][1] += -1 if end else 1
            if not inner[-1][1]:
                spans.append((inner.pop()[2], m.start()))
                continue
        if tag and not end and tag not in _ROOTS and (tag == "form" or (tag in _BLOCKS and tag not in _SKIPPED and _boilerplate_names(m.group("attrs"), False))):
            if inner and tag == inner[-1][0]:
                inner[-1][1] -= 1
            inner.append([tag, 1, m.end()])
    return spans + [(begin, len(html)) for _, _, begin in inner]


def _nested(html: str, found: list[Block], opened: frozenset[int]) -> frozenset[int]:
    """Containers inside the ones just opened that hold most of the page's text as well: a
    nest of wrappers is opened at once, however deep it is."""
    inside = [b for b in found if b.weak in opened]
    dense = stops_tell([b for b in found if b.weak or not b.skipped])
    total = sum(b.running(dense) for b in found if b.weak or not b.skipped)
    ends = [b.at for b in inside]
    sums = [0, *accumulate(b.running(dense) for b in inside)]
    held = lambda begin, end: sums[bisect_right(ends, end)] - sums[bisect_right(ends, begin)]
    return frozenset(begin for begin, end in _weak_spans(html) if 2 * held(begin, end) > total)


def _to_open(found: list[Block]) -> frozenset[int]:
    """Numbers of the containers skipped on weak evidence that hold the page's text."""
    numbers = {b.weak for b in found if b.weak}
    if not numbers:
        return frozenset()
    dense = stops_tell([b for b in found if b.weak or not b.skipped])
    outside = sum(b.running(dense) for b in found if not b.skipped)
    marked = any(b.inside and not b.skipped for b in found)
    total = outside + sum(b.running(dense) for b in found if b.weak)
    whole, article, others = dict.fromkeys(numbers, 0), {}, set()
    for b in found:
        if b.weak:
            whole[b.weak] += b.running(dense)
            if b.own:
                article[b.weak] = article.get(b.weak, 0) + b.running(dense)
            if b.others:
                others.add(b.weak)
    return frozenset(
        n for n in numbers
        if (2 * whole[n] > total or (not marked and article.get(n, -1) >= outside)) and not (n in others and outside)
    )


def page_blocks(html: str | None) -> list[Block]:
    """Blocks, with the containers opened that hold the page's text."""
    opened: frozenset[int] = frozenset()
    while True:
        found = blocks(html, opened)
        more = _to_open(found)
        if not more:
            return found
        opened |= more | _nested(html or "", found, more)


def first_pass(block: Block, marked: bool, dense: bool = True) -> str:
    """good, bad, near (ambiguous with stop words or long) or short (ambiguous). Unless
    `dense`, few stop words say nothing."""
    size = block.size
    if block.skipped or (marked and not block.inside) or block.links:
        return "bad"
    if size < SHORT:
        return "short"
    stops = block.stops
    if stops >= STOP_HIGH:
        return "good" if size > LONG or block.inside else "near"
    if stops >= STOP_LOW:
        return "near"
    if block.inside:
        return "short"
    if dense:
        return "near" if size > LONG else "short"
    return "good" if size > LONG else "near"


def second_pass(found: list[Block], labels: list[str]) -> list[bool]:
    """Which blocks are content, ambiguous ones by their nearest decided neighbours. Where no
    block is good by itself, the better ambiguous ones are. Of neighbours that differ the
    nearer one counts; a skipped container only ends the text and says nothing beyond itself."""
    if "good" not in labels:
        labels = ["good" if x == "near" else x for x in labels]
    before, after = [-1] * len(labels), [-1] * len(labels)
    last = -1
    for i in range(len(labels)):
        before[i] = last
        last = i if labels[i] in ("good", "bad") else last
    last = -1
    for i in reversed(range(len(labels))):
        after[i] = last
        last = i if labels[i] in ("good", "bad") else last
    out = []
    for i, (block, label) in enumerate(zip(found, labels)):
        if label in ("good", "bad"):
            out.append(label == "good")
            continue
        near = [labels[j] for j in (before[i], after[i]) if j >= 0 and found[j].inside == block.inside and not (block.inside and found[j].skipped)]
        if block.inside:
            out.append(near.count("bad") < 2)
        elif near and near[0] == near[-1]:  # both say the same, or there is one only
            out.append(near[0] == "good")
        else:
            kept = "good" in near and (label == "near" or block.heading)
            if "good" in near and not kept:
                good, bad = (before[i], after[i]) if labels[before[i]] == "good" else (after[i], before[i])
                kept = found[bad].skipped or abs(i - good) < abs(i - bad)
            out.append(kept)
    return out


def main_text(html: str | None) -> str:
    """Content blocks, white space in each turned into single spaces, joined by blank lines."""
    found = page_blocks(html)
    marked = any(b.inside for b in found)
    dense = marked or stops_tell([b for b in found if not b.skipped])
    labels = [first_pass(b, marked, dense) for b in found]
    return "\n\n".join(b.text for b, keep in zip(found, second_pass(found, labels)) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row of `pages`.

    Null and empty html, and pages without content, give an empty text. Broken markup is
    read as far as it makes sense: unclosed tags end with the page, a `<` that begins no
    tag is text. Repeated rows, null ids and urls are returned like others; further
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, 500):
            texts = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
