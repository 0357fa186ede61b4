"""Main text of web pages by tree scoring (op6).

The page is read into a tree of blocks. Each block with text of its own gives
points (one, its commas, and up to three for its length) to its parent, half
of them to the grandparent, less to further ancestors (32 at most). A container's points
are discounted by its link density. The best container is kept, together with
siblings that score a fifth of it or are link-poor paragraphs; if it lies in
an ``article`` (else ``main``) element, that element is kept whole.

Left out wherever they stand: scripts, styles, menus, page headers and
footers, told by element and role. A header inside an article is its heading
and stays. Sidebars, notices, adverts and reader comments are told by words of
class or id, and such words also stand on wrappers of the whole page
(``has-sidebar``), so a marked part is judged by what it holds once the page is
read. It stays if it holds the page's largest ``article`` or ``main``, or too
large a share of its paragraph text (``NEEDED``; its points then count half
unless the word tells a state of the page); a marked passage of prose inside an article stays too where the word is
one that authors use for passages (``SOFT_WORDS``). If nothing is left, the
marks are ignored. A form is such a part, too, as some wrap the whole page: it stays if it holds the article or nearly all
paragraph text. The text of formulas stays. The work on a page is linear in its length, however deep it nests.

Character references are decoded; white space inside a block becomes one
space; blocks follow in page order with one space between. Defined cases: NULL
and empty pages and pages without text give the empty string; unclosed and
stray tags are closed or ignored as browsers do in common cases, a comment or tag still open at the end is no text and
unknown declarations are comments; repeated rows
give repeated results; an empty table gives an empty result. Every page is
worked through alone, whole, without a shuffle.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_slices

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr math maction merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms msqrt mstyle msub "
    "msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "script style noscript template head title nav footer aside fieldset button select option textarea iframe object applet svg "
    "canvas audio video map dialog menu search annotation annotation-xml".split()
)
#: Words of a class or id that mark a part as no main text.
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar aside rail widget widgets footer masthead topbar toolbar comment comments commentlist disqus respond replies share "
    "sharing social related recommended pagination pager".split()
)
#: Marking words of reader comments: they can be longer than the text they are about.
READER_WORDS = frozenset("comment comments commentlist disqus respond replies".split())
#: Marking words that authors also give to passages of their text.
SOFT_WORDS = frozenset("notice notices notification alert related share sharing promotion banner overlay rail widget widgets".split())
#: Words that make a name tell the state of a page rather than what a part is.
STATE_WORDS = frozenset("has no not with without open opened closed enabled disabled".split())
#: A marked part with a larger share of the paragraph text than this is no side matter.
NEEDED = {"state": 0.2, "part": 0.5, "form": 0.85, "reader": 0.9}
#: Ancestors that a block gives points to.
LEVELS = 32
#: A marked passage with fewer characters, or with a quarter of them in links, is short or link-heavy.
PASSAGE = 40
PARAGRAPHS = frozenset("p pre blockquote dd".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
}
_WORD = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
_SPLIT = re.compile(r"[^A-Za-z]+")


def _marks(value: str, header: bool) -> list[tuple[str, bool]]:
    """(kind in NEEDED, soft) for each marking name of a class or id; ``header`` counts as one outside articles."""
    found = []
    for name in value.split():
        words = {w.lower() for part in _SPLIT.split(name) for w in (part, *_WORD.findall(part))}
        marking = words & DROPPED_WORDS
        if header and "header" in _SPLIT.split(name.lower()):
            marking = marking | {"header"}
        if marking:
            kind = "state" if words & STATE_WORDS else "reader" if marking & READER_WORDS else "part"
            found.append((kind, marking <= SOFT_WORDS))
    return found


class Mark:
    """A part of the page whose class or id tells side matter."""

    __slots__ = ("parent", "need", "form", "soft", "chars", "link_chars", "prose", "stays", "gone", "weight")

    def __init__(self, parent: Mark | None, found: list[tuple[str, bool]], passage: bool):
        self.parent = parent
        self.need = max(NEEDED[kind] for kind, _ in found)
        self.form = any(kind == "form" for kind, _ in found)
        self.soft = passage and all(soft for _, soft in found)
        self.chars = self.link_chars = self.prose = 0
        self.stays = self.gone = False
        self.weight = 1.0


class Block:
    __slots__ = ("tag", "parent", "depth", "words", "chars", "link_chars", "commas", "points", "mark", "marked")

    def __init__(self, tag: str, parent: Block | None):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.chars = self.link_chars = self.commas = 0
        self.points = 0.0
        self.mark: Mark | None = None  # the innermost marked part it stands in
        self.marked = False  # the element itself has a mark


class PageTree(HTMLParser):
    """Blocks of a page and its text pieces in page order, without the dropped parts; marked parts are in it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Block("", None)
        self.block = self.root
        self.blocks = [self.root]  # all, in page order
        self.open: list[tuple[str, Block | None, Mark | None]] = []  # open elements; inline ones have no block
        self.places: dict[str, list[int]] = {}  # of the open elements of each name
        self.outer: list[int] = []  # places of the open elements that are blocks
        self.pieces: list[tuple[Block, str, Mark | None, bool]] = []  # with the innermost mark, and whether in a link
        self.mark: Mark | None = None
        self.marks: list[Mark] = []
        self.articles: list[Block] = []
        self.links = 0
        self.dropped = 0  # depth of the open elements inside a dropped part, with it

    def _drops(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        if tag in DROPPED:
            return True
        if tag in ("html", "body", "article", "main"):
            return False
        if tag == "header" and not self._inside():
            return True
        for key, value in attrs:
            if key == "hidden" or key == "aria-hidden" and value == "true":
                return True
            elif key == "role" and value in DROPPED_ROLES:
                return True
            elif key == "style" and value and re.search(r"display\s*:\s*none", value):
                return True
        return False

    def _last(self, *names: str) -> int:
        """Place of the innermost open element with one of the names, or -1."""
        return max((places[-1] for name in names if (places := self.places.get(name))), default=-1)

    def _inside(self) -> bool:
        return self._last("article", "main") >= 0

    def _push(self, tag: str, block: Block | None, mark: Mark | None) -> None:
        self.places.setdefault(tag, []).append(len(self.open))
        if block is not None:
            self.outer.append(len(self.open))
        self.open.append((tag, block, mark))

    def parse_marked_section(self, i, report=1):
        """As browsers do: a section of any name is a comment up to the next ">", character data up to its end."""
        end = "]]>" if self.rawdata.startswith("<![CDATA[", i) else ">"
        at = self.rawdata.find(end, i + 3)
        return at + len(end) if at >= 0 else -1

    def finish(self) -> None:
        """The end of the page. A comment or tag that is still open there is no text."""
        if re.match(r"<[!?/A-Za-z]", self.rawdata):
            self.rawdata = ""
        self.close()

    def _found(self, attrs: list[tuple[str, str | None]], header: bool) -> list[tuple[str, bool]]:
        return [m for key, value in attrs if key in ("class", "id") and value for m in _marks(value, header)]

    def _close_to(self, position: int) -> None:
        """Close the open elements from ``position`` on."""
        for tag, block, mark in reversed(self.open[position:]):
            self.places[tag].pop()
            if block is not None:
                self.outer.pop()
            if mark is not None:
                self.mark = mark.parent
            if block is not None:
                self.block = block.parent
            elif tag == "a":
                self.links -= 1
            if self.dropped:
                self.dropped -= 1
        del self.open[position:]

    def _implied_ends(self, tag: str) -> None:
        if tag in INLINE:
            return
        if tag in CLOSES:
            ends, limits = CLOSES[tag]
            while (k := self._last(*ends)) > self._last(*limits):
                self._close_to(k)
        if self.outer and self.open[self.outer[-1]][0] == "p":
            self._close_to(self.outer[-1])

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if not self.dropped and tag in ("br", "hr"):
                self.pieces.append((self.block, " ", self.mark, False))
            return
        self._implied_ends(tag)
        if self.dropped:
            self._push(tag, None if tag in INLINE else self._enter(tag), None)
            if tag == "a":
                self.links += 1
            self.dropped += 1
            return
        drop = self._drops(tag, attrs)
        mark = None
        if not drop and tag not in ("html", "body", "article", "main"):
            inside = self._inside()
            found = self._found(attrs, not inside)
            if tag == "form":  # some wrap the whole page
                found.append(("form", False))
            if found:
                mark = self.mark = Mark(self.mark, found, inside or tag in PARAGRAPHS)
                self.marks.append(mark)
        block = None if tag in INLINE else self._enter(tag)
        self._push(tag, block, mark)
        if tag == "a":
            self.links += 1
        if block is not None:
            block.mark, block.marked = self.mark, mark is not None
            if tag in ("article", "main") and not any(kind == "reader" for kind, _ in self._found(attrs, False)):
                self.articles.append(block)
        if drop:
            self.dropped = 1

    def _enter(self, tag: str) -> Block:
        self.block = Block(tag, self.block)
        self.blocks.append(self.block)
        return self.block

    def handle_startendtag(self, tag, attrs):
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:  # browsers ignore the slash of other elements
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        k = self._last(tag)
        if k < 0 or tag in INLINE and self.outer and self.outer[-1] > k:
            return
        if tag not in ("tr", "table", "tbody", "div", "article", "main", "body", "html") and self._last("td", "th", "table") > k:
            return
        self._close_to(k)

    def handle_data(self, data):
        if not self.dropped:
            self.pieces.append((self.block, data, self.mark, self.links > 0))

    def text(self, marks: bool) -> list[tuple[Block, str]]:
        """Pieces without the marked parts that go (``marks``), or all; counts what they give each block."""
        if self.marks:
            self._judge() if marks else self._ignore_marks()
        out = []
        for block, data, mark, linked in self.pieces:
            if mark is not None and mark.gone:
                continue
            out.append((block, data))
            n = _chars(data)
            if n:
                block.chars += n
                block.commas += data.count(",") + data.count("，")
                if linked:
                    block.link_chars += n
        return out

    def _ignore_marks(self) -> None:
        """All but forms stay."""
        for mark in self.marks:  # a part stands before the parts in it
            mark.gone = mark.gone and mark.form or mark.parent is not None and mark.parent.gone
            mark.weight = 1.0

    def _judge(self) -> None:
        """Which marked parts go: reader comments first, the others by their share of the remaining paragraph text."""
        own: dict[Block, list[int]] = {}
        for block, data, mark, linked in self.pieces:
            if n := _chars(data):
                sums = own.setdefault(block, [0, 0])
                sums[0] += n
                sums[1] += n * linked
                if mark is not None:
                    mark.chars += n
                    mark.link_chars += n * linked
        prose = {b for b, (n, linked) in own.items() if b.tag in PARAGRAPHS or n >= 80 and linked < 0.25 * n}
        total = 0
        for block, data, mark, linked in self.pieces:
            if block in prose and not linked:
                n = _chars(data)
                total += n
                if mark is not None:
                    mark.prose += n
        for mark in reversed(self.marks):  # a part stands before the parts in it
            if mark.parent is not None:
                mark.parent.chars += mark.chars
                mark.parent.link_chars += mark.link_chars
                mark.parent.prose += mark.prose
        for tag in ("article", "main"):
            below = self._below([b for b in self.articles if b.tag == tag], own)
            if below:
                mark = max(below, key=below.get).mark
                while mark is not None:
                    mark.stays, mark = True, mark.parent
        rest = total
        for readers in (True, False):
            for mark in self.marks:
                up = mark.parent
                if mark.gone or up is not None and up.gone:
                    mark.gone = True
                elif (mark.need == NEEDED["reader"]) == readers:
                    passage = mark.soft and mark.chars >= PASSAGE and mark.link_chars < 0.25 * mark.chars
                    main = mark.stays or mark.prose > mark.need * rest
                    mark.gone = not (main or passage)
                    mark.weight = 1.0 if passage or mark.stays or mark.need in (NEEDED["state"], NEEDED["form"]) else 0.5
                    if mark.gone and readers:
                        total -= mark.prose
            rest = total
        for mark in self.marks:
            if mark.parent is not None:
                mark.weight *= mark.parent.weight

    def _below(self, blocks: list[Block], own: dict[Block, list[int]]) -> dict[Block, int]:
        """Characters below each of ``blocks`` that has any."""
        sums = {b: n for b, (n, _) in own.items()} if blocks else {}
        for block in reversed(self.blocks):  # children come before their parents
            if block in sums and block.parent is not None:
                sums[block.parent] = sums.get(block.parent, 0) + sums[block]
        return {b: sums[b] for b in blocks if sums.get(b)}


def _chars(data: str) -> int:
    return 0 if data.isspace() else len(data) - data.count(" ")


def lines(pieces: list[tuple[Block, str]]) -> list[tuple[Block, str]]:
    """Text of each run of pieces of one block, with single spaces."""
    out: list[tuple[Block, str]] = []
    held: list[str] = []
    last: Block | None = None
    for block, text in [*pieces, (None, "")]:
        if block is not last:
            if held and (whole := " ".join("".join(held).split())):
                out.append((last, whole))
            held, last = [], block
        held.append(text)
    return out


def main_text(html: str | None) -> str:
    tree = PageTree()
    tree.feed(html or "")
    tree.finish()
    found = lines(tree.text(True)) or tree.marks and lines(tree.text(False))
    if not found:
        return ""
    total: dict[Block, list[int]] = {}  # characters and link characters below each container
    for block in dict.fromkeys(b for b, _ in found):
        points = (1 + block.commas + min(block.chars / 100, 3)) * (block.mark.weight if block.mark else 1)
        share, up = 1.0, block.parent or block
        for level in range(1, LEVELS + 1):
            if up is None:
                break
            up.points += points * share
            share = 0.5 if level == 1 else 1 / (3 * level)
            up = up.parent
        total[block] = [block.chars, block.link_chars]
    for block in reversed(tree.blocks):  # children come before their parents
        if block in total and block.parent is not None:
            sums = total.setdefault(block.parent, [0, 0])
            sums[0] += total[block][0]
            sums[1] += total[block][1]

    def score(b: Block) -> float:
        chars, linked = total.get(b, (0, 0))
        return b.points * (1 - linked / chars if chars else 1)

    best = max(total, key=lambda b: (score(b), b.depth))
    for wanted in ("article", "main"):
        up = best
        while up is not None and up.tag != wanted:
            up = up.parent
        if up is not None:
            best = up
            break
    limit = 0.2 * score(best)
    kept: set[Block] = set()  # the best container, its good siblings and what is in them
    for b in tree.blocks:
        if b is best:
            kept.add(b)
        elif b.parent is not None and b.parent is best.parent:
            chars, linked = total.get(b, (0, 0))
            if not b.marked and (score(b) >= limit > 0 or b.tag == "p" and chars >= 80 and linked < 0.25 * chars):
                kept.add(b)
        elif b.parent in kept:
            kept.add(b)
    return " ".join(text for block, text in found if block in kept)


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep_columns: tuple[str, ...] = ()) -> DataFrame:
    """(id, kept columns, text, n_chars) for every page."""
    names = {c: f"own_{i}" for i, c in enumerate((id_col, *keep_columns))}
    rows = pages.select(F.col(f"`{html_col}`").alias("html"), *[F.col(f"`{c}`").alias(o) for c, o in names.items()])
    schema = rows.drop("html").schema.add("text", "string").add("n_chars", "long")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch.column(0).to_pylist()]
        own = [batch.column(i) for i in range(1, batch.num_columns)]
        return pa.RecordBatch.from_arrays([*own, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema.names)

    out = map_slices(rows, run, schema, "html")
    return out.select(*[F.col(o).alias(c) for c, o in names.items()], "text", "n_chars")
