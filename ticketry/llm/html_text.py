"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags. A block's features are its ancestors' tags and
class words, and figures of its text (length, links, place in the page). The field knows which blocks are content from
labelled pages and how labels follow each other; Viterbi decoding labels all blocks of a page together.

Labelled pages are rows (html, content), content being the texts of the content blocks. Without any, pages label
themselves: what stands in an ``article`` or ``main`` element outside of navigation, asides, forms and the like is
content. Of each such page the field also learns copies: with ``div`` for ``article`` and ``main``, so that it reads pages
without them from the rest, and with some blocks put into elements that are no content. Learning uses the ``sample_pages`` pages with the smallest hash; every page is decoded.

Defined cases: null or empty html gives an empty text; text outside of any tag is a block; line breaks inside a block are
white space; unclosed tags end with the element around them, an unclosed ``head`` where the body begins; pages without any labelled example around are decoded with
no weights learned, as content; repeated rows come out as often; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketry.llm.common import small_batches

SLOTS = 1 << 12
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
#: Elements whose inside is not text of the page: of RAW all up to the end tag, or to the end of the page, is no markup either.
RAW = frozenset("script style textarea title".split())
HIDDEN = frozenset("noscript template svg iframe select head".split())
#: What may stand in a head; any other element begins the body.
OF_HEAD = RAW | HIDDEN - {"svg", "iframe", "select"} | frozenset("html meta link base basefont bgsound noframes".split())
CONTENT = frozenset(("article", "main"))
#: Elements and class words that a page's own content does not stand in.
ASIDE = frozenset("nav header footer aside form button menu dialog".split())
ASIDE_WORDS = frozenset("nav menu navbar breadcrumb breadcrumbs header footer sidebar aside ad ads advert adverts advertisement banner promo sponsor sponsored cookie "
                        "cookies consent notice notices popup modal newsletter subscribe share social related comment comments reply replies respond widget "
                        "login signup toolbar pagination copyright".split())
#: Possessive, so that broken markup costs no more than its length. A quoted value may hold > but not <.
_REST = r"(?:[^<>=]++|=\s*+(?:\"[^\"<]*+\"|'[^'<]*+')?+)*+"
_PIECE = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)\]\]>|<[!?][^<>]*+>"
                    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*+)(?P<rest>{_REST})>", re.DOTALL | re.IGNORECASE)
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in RAW}
_HEAD_END = re.compile(r"</head\s*>", re.IGNORECASE)
_CLASS = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_WORD = re.compile(r"[a-z0-9]+")


@dataclass
class Block:
    text: str
    tags: list[str]
    words: list[str]
    links: int = 0


@dataclass
class _Open:
    tag: str
    words: list[str] = field(default_factory=list)


def leaf_blocks(page: str | None) -> list[Block]:
    """The blocks of a page in order, texts with character references decoded and white space made single."""
    page = page or ""
    blocks: list[Block] = []
    stack: list[_Open] = []
    text: list[str] = []
    where: tuple[list[str], list[str]] = ([], [])
    links = anchors = hidden = svgs = 0
    begun = False
    head: int | None = None  # depth of the outermost open one
    last_head_end: int | None = None

    def add(piece: str) -> None:
        nonlocal where, links, begun
        if hidden:
            return
        if not piece or piece.isspace():
            text.extend(" " if piece else "")
            return
        if not begun:
            begun, where = True, ([o.tag for o in stack], [w for o in stack for w in o.words])
        if anchors:
            links += len(piece)
        text.append(piece)

    def flush() -> None:
        nonlocal links, begun
        if hidden:
            return
        if shown := " ".join(html.unescape("".join(text)).split()):
            blocks.append(Block(shown, *where, min(links, len(shown))))
        text.clear()
        links, begun = 0, False

    def close(depth: int) -> None:
        nonlocal anchors, hidden, svgs, head
        anchors -= sum(o.tag == "a" for o in stack[depth:])
        hidden -= sum(o.tag in HIDDEN for o in stack[depth:])
        svgs -= sum(o.tag == "svg" for o in stack[depth:])
        del stack[depth:]
        head = None if head is not None and head >= depth else head

    at = 0
    while (m := _PIECE.search(page, at)) is not None:
        add(page[at:m.start()])
        at = m.end()
        if (data := m["cdata"]) is not None:
            add(html.escape(data))
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        empty = m["rest"].endswith("/")
        if head is not None and not m["end"] and (tag == "body" or stack[-1].tag == "head" and at > last_head_end and tag not in OF_HEAD):
            close(head)
        if tag in RAW:
            # inside of svg these are elements like others
            if not m["end"] and not (empty and svgs):
                at = end.end() if (end := _RAW_END[tag].search(page, at)) else len(page)
            continue
        if tag in HIDDEN:
            if m["end"]:
                if hidden and (depth := next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag), None)) is not None:
                    close(depth)
            elif not empty:
                if tag == "head" and head is None:
                    head = len(stack)
                    if last_head_end is None:
                        last_head_end = max((e.start() for e in _HEAD_END.finditer(page)), default=-1)
                stack.append(_Open(tag))
                hidden += 1
                svgs += tag == "svg"
            continue
        if tag in INLINE:
            if tag == "br":
                add(" ")
            elif m["end"]:
                if (depth := next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag), None)) is not None and all(
                        o.tag in INLINE or o.tag in HIDDEN for o in stack[depth:]):
                    close(depth)
            elif tag not in VOID:
                stack.append(_Open(tag, _class_words(m["rest"])))
                anchors += tag == "a"
            continue
        flush()
        if m["end"]:
            if (depth := next((i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag), None)) is not None:
                close(depth)
                flush()
        elif tag not in VOID:
            # an open paragraph or item ends where the next block begins
            ends = {"li": ("li", "p"), "dt": ("dd", "dt", "p"), "dd": ("dd", "dt", "p"), "tr": ("td", "th", "tr", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p")}.get(tag, ("p",))
            stop = ("ul", "ol", "dl", "table", "td", "th", "li", "div", "article", "section", *HIDDEN)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag in ends:
                    close(i)
                    break
                if stack[i].tag in stop:
                    break
            if not empty:
                stack.append(_Open(tag, _class_words(m["rest"])))
    add(page[at:])
    flush()
    return blocks


def _class_words(rest: str) -> list[str]:
    if not rest:
        return []
    return [w for m in _CLASS.finditer(rest) for w in _WORD.findall((m[1] or m[2] or m[3] or "").lower())]


def is_content(block: Block) -> bool:
    """What a page says of a block itself."""
    inside = next((i for i, t in enumerate(block.tags) if t in CONTENT), None)
    return inside is not None and not ASIDE.intersection(block.tags) and not ASIDE_WORDS.intersection(block.words)


def disturbed(blocks: list[Block]) -> list[Block]:
    """The blocks, some of them put into an element that is no content."""
    made = []
    for n, b in enumerate(blocks):
        draw = zlib.crc32(f"{n}:{b.text}".encode())
        if draw % 4:
            made.append(b)
        elif draw % 8:
            made.append(Block(b.text, [*b.tags[:-1], "div", *b.tags[-1:]], [*b.words, sorted(ASIDE_WORDS)[draw // 8 % len(ASIDE_WORDS)]], b.links))
        else:
            made.append(Block(b.text, [*b.tags[:-1], sorted(ASIDE)[draw // 8 % len(ASIDE)], *b.tags[-1:]], b.words, b.links))
    return made


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % SLOTS


def features(blocks: list[Block], plain: bool = False) -> list[list[int]]:
    """Slots of each block's features; ``plain`` hides the elements that name content."""
    made = []
    for n, b in enumerate(blocks):
        tags = ["div" if plain and t in CONTENT else t for t in b.tags]
        outer = [t for t in tags if t not in INLINE]
        words = len(b.text.split())
        names = {f"in:{t}" for t in tags} | {f"word:{w}" for w in b.words}
        names |= {f"own:{outer[-1] if outer else ''}", f"two:{'/'.join(outer[-2:])}", f"words:{min(8, words.bit_length())}", f"links:{round(4 * b.links / max(1, len(b.text)))}",
                  f"stop:{b.text[-1:] in '.!?:;…'}", f"from-start:{min(n, 3)}", f"from-end:{min(len(blocks) - 1 - n, 3)}", f"sign:{b.text[:1] in '©®'}",
                  f"content:{bool(CONTENT.intersection(tags))}",
                  f"aside:{bool(ASIDE.intersection(tags) or ASIDE_WORDS.intersection(b.words))}", "any"}
        made.append(sorted({_slot(x) for x in names}))
    return made


class Field:
    """Two labels, 1 for content: one weight a feature and label, and one a pair of neighbours."""

    def __init__(self) -> None:
        self.w = np.zeros((SLOTS + 1, 2))
        self.move = np.zeros((2, 2))

    def fit(self, pages: list[tuple[list[list[int]], list[int]]], steps: int = 60, rate: float = 0.3, penalty: float = 1e-4, longest: int = 64) -> Field:
        """Maximum likelihood by Adam; chains longer than ``longest`` blocks are cut for learning, not for decoding."""
        chains = [(f[i:i + longest], y[i:i + longest]) for f, y in pages for i in range(0, len(f), longest)]
        if not chains:
            return self
        wide = max(len(x) for f, _ in chains for x in f)
        most = max(len(f) for f, _ in chains)
        index = np.full((len(chains), most, wide), SLOTS, np.int32)
        label, mask = np.zeros((len(chains), most), int), np.zeros((len(chains), most), bool)
        for c, (f, y) in enumerate(chains):
            for t, x in enumerate(f):
                index[c, t, :len(x)] = x
            label[c, :len(y)], mask[c, :len(y)] = y, True
        count, total = len(chains), mask.sum()
        gold_move = np.zeros((2, 2))
        pair = mask[:, 1:]
        np.add.at(gold_move, (label[:, :-1][pair], label[:, 1:][pair]), 1)
        ends = mask.sum(axis=1) - 1
        moments = [np.zeros_like(x) for x in (self.w, self.w, self.move, self.move)]
        for step in range(1, steps + 1):
            emit = self.w[index].sum(axis=2)
            forward, backward = np.zeros((count, most, 2)), np.zeros((count, most, 2))
            forward[:, 0] = emit[:, 0]
            for t in range(1, most):
                forward[:, t] = emit[:, t] + np.logaddexp(forward[:, t - 1, :1] + self.move[0], forward[:, t - 1, 1:] + self.move[1])
            for t in range(most - 2, -1, -1):
                ahead = emit[:, t + 1] + backward[:, t + 1]
                back = np.logaddexp(self.move[:, 0] + ahead[:, :1], self.move[:, 1] + ahead[:, 1:])
                backward[:, t] = np.where((t < ends)[:, None], back, 0)
            logz = np.logaddexp(forward[np.arange(count), ends, 0], forward[np.arange(count), ends, 1])
            p = np.exp(forward + backward - logz[:, None, None]) * mask[:, :, None]
            wrong = p - np.eye(2)[label] * mask[:, :, None]
            grad_w = np.stack([np.bincount(index.ravel(), np.repeat(wrong[:, :, k].ravel(), wide), SLOTS + 1) for k in (0, 1)], axis=1) / total
            moved = np.exp(forward[:, :-1, :, None] + self.move + (emit + backward)[:, 1:, None, :] - logz[:, None, None, None]) * pair[:, :, None, None]
            grad_m = (moved.sum(axis=(0, 1)) - gold_move) / total
            for x, g, a, b in ((self.w, grad_w + penalty * self.w, 0, 1), (self.move, grad_m + penalty * self.move, 2, 3)):
                moments[a] = 0.9 * moments[a] + 0.1 * g
                moments[b] = 0.99 * moments[b] + 0.01 * g * g
                x -= rate * (moments[a] / (1 - 0.9 ** step)) / (np.sqrt(moments[b] / (1 - 0.99 ** step)) + 1e-8)
            self.w[SLOTS] = 0
        return self

    def decode(self, slots: list[list[int]]) -> list[int]:
        """The labels of the most likely chain; content on ties."""
        if not slots:
            return []
        emit = np.stack([self.w[x].sum(axis=0) for x in slots]).tolist()
        move, best, back = self.move.tolist(), emit[0], []
        for e in emit[1:]:
            come = [[best[0] + move[0][k], best[1] + move[1][k]] for k in (0, 1)]
            back.append([int(c[1] >= c[0]) for c in come])
            best = [e[k] + max(come[k]) for k in (0, 1)]
        label = int(best[1] >= best[0])
        chain = [label]
        for step in reversed(back):
            label = step[label]
            chain.append(label)
        return chain[::-1]

    def text(self, page: str | None) -> str:
        blocks = leaf_blocks(page)
        return "\n".join(b.text for b, y in zip(blocks, self.decode(features(blocks)), strict=True) if y)


def train(pages: DataFrame, sample_pages: int = 200, **how) -> Field:
    """From the ``sample_pages`` rows with the smallest hash of the html, of rows (html) or (html, content: list of block texts)."""
    labelled = "content" in pages.columns
    columns = ["html", "content"] if labelled else ["html"]
    rows = pages.select(*columns).where("html IS NOT NULL")
    if not labelled:  # cheap test for pages that can label themselves; leaf_blocks decides
        rows = rows.where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    edge = rows.select(F.xxhash64("html").alias("h")).orderBy("h").limit(sample_pages).agg(F.max("h")).first()[0]
    if edge is None:
        return Field()
    examples = []
    for row in rows.where(F.xxhash64("html") <= edge).dropDuplicates(["html"]).orderBy(F.xxhash64("html")).limit(sample_pages).collect():
        blocks = leaf_blocks(row["html"])
        if labelled:
            wanted = set(row["content"] or ())
            examples.append((features(blocks), [int(b.text in wanted) for b in blocks]))
        elif any(map(is_content, blocks)):
            examples += [(features(b, plain), [int(is_content(x)) for x in b]) for plain in (False, True) for b in (blocks, disturbed(blocks))]
    return Field().fit([e for e in examples if e[0]], **how)


def extract(pages: DataFrame, model: Field | None = None) -> DataFrame:
    """page_id, url, text, n_chars per page; a model learned from the pages themselves unless one is given."""
    small_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(train(pages.select("html")) if model is None else model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [shared.value.text(h) for h in frame.pop("html")]
            yield frame.assign(text=texts, n_chars=[len(t) for t in texts])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return pages.select("page_id", "url", "html").mapInPandas(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
