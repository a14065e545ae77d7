"""Main text of HTML pages by two-pass block rules.

The page is cut into blocks at block-level tags. The first pass looks at a block's place (menus,
headers, footers, asides, forms, hidden parts and boxes whose class or id says so), its share of
words in links, its length and its share of stop words, and calls it good, bad, or undecided (short,
or long without stop words). In the second pass undecided blocks take the label of the nearest
decided blocks on both sides, in their own container if there are any; where these differ, the
nearer one decides, then the share of stop words. Where the page marks its article, blocks outside
it are bad and those inside are decided among themselves.

A form or a box of a telling name that encloses the page's heading or article and most of its text is
a frame of the page, not a part of it: it decides nothing. A name tells if all its words do, those aside
that only say what kind of box it is; a heading that counts or calls for comments tells of the box that
it begins.

Time and memory grow with the length of the page, whatever its nesting.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import DataFrame

from skeinworks.llm._common import batch_of, batches, ready, spread

# Tags by their part in a page.
SKIPPED = frozenset("script style noscript template svg math iframe object embed canvas audio video head title textarea select option button datalist".split())
RAW = frozenset("script style textarea title iframe".split())
BOILER = frozenset("nav footer aside form menu dialog header".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "hr html legend li main menu nav ol optgroup p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that hold text but do not set it apart from their siblings.
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd ul ol dl blockquote pre center address figure figcaption table tbody thead tfoot tr td th caption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = frozenset(("article", "main"))
#: Words of class and id names that mark boilerplate anywhere, and those that do so outside an article only.
BOILER_WORDS = (
    "ad ads adv advert adverts advertisement advertisements adsense adbox banner sponsor sponsored promo promotion sidebar leftsidebar rightsidebar widget nav navbar navigation menu breadcrumb breadcrumbs "
    "footer masthead topbar comment comments commentlist commentbox commentform reply replies disqus cookie cookies cookiebar cookiebanner cookienotice consent gdpr notice notices notification "
    "popup modal overlay share sharing social related recommended recommendations newsletter subscribe subscription signup pagination pager copyright feedback"
).split()
LAYOUT_WORDS = "side header respond discussion alert login search legal disclaimer toolbar skip".split()
BOILER_NAMES = frozenset(BOILER_WORDS)
BOILER_OR_LAYOUT = BOILER_NAMES | frozenset(LAYOUT_WORDS)
#: Words of names that only say what kind of box it is, or whose or where.
NEUTRAL_WORDS = frozenset(
    "site page main post posts article entry blog user users reader readers visitor box list bar link links button buttons icon icons item items section block container wrapper wrap area inner outer "
    "content top bottom left right head title group panel module unit slot placeholder text small large mobile desktop fixed sticky first last stories the by js id".split()
)
#: Headings of reader comments, whole.
_COMMENTS = re.compile(
    r"(?:\(?\d+\)?\s+(?:reader\s+|user\s+)?(?:comments?|responses?|repl(?:y|ies)|reactions?|kommentare?|antwort(?:en)?|commentaires?|réponses?|réactions?|comentarios?|respuestas?)"
    r"|(?:reader\s+|user\s+)?(?:comments|responses|replies|reactions|kommentare|commentaires|comentarios)|leave an? (?:comment|reply)|join the (?:discussion|conversation))"
    r"(?:\s*\(\d+\))?(?:\s+(?:to|on)\s+[\"“'‘«].*)?[:.!]?", re.I | re.S)
#: Names are cut into words at separators, digits and inner capitals.
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
BOILER_ROLE = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Frequent function words of the languages that pages come in.
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her his if in is it its not of on or she so that the their there they this to was we were which will with you "
    "der die das den dem des ein eine einen einem einer und ist im in mit nicht von zu auf für als auch sich es an dass er sie wie bei aus "
    "le la les un une des du de et est en dans que qui pour pas sur par au aux avec ce il elle ne se plus son sa "
    "el los las una unos del y en que es por con para no su al lo como más se".split()
)
# Limits of the rules: words of a short and a long block, stop-word shares, link share.
SHORT, LONG, STOP_LOW, STOP_HIGH, LINKS = 8, 25, 0.12, 0.2, 0.3

_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+(?:\"[^\"]*+(?:\"|$)|'[^']*+(?:'|$)|[^\s\"'>][^\s>]*+)?)*+)(?:>|$)", re.S)
_ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?""")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
_WORDS = re.compile(r"[^\W_]+")
GOOD, BAD, OPEN = 1, -1, 0


@dataclass(slots=True)
class Block:
    text: str
    bad_place: bool
    in_main: int  # number of the enclosing article, 0 if none
    heading: bool
    linked: int  # characters inside links
    container: int  # number of the enclosing element that is no paragraph, heading or cell
    box: int = 0  # the innermost enclosing box that is boilerplate unless it frames the page, 0 if none
    around: int = 0  # the innermost one that encloses a first heading or the block's article
    label: int = OPEN
    stop: float = 0.0
    words: int = 0


@dataclass(slots=True)
class _Open:
    tag: str
    bad: bool
    skip: bool
    main: int
    container: int
    box: int


def _telling(name: str, words: frozenset[str]) -> bool:
    """Whether some word of a class or id name is one of these, and all others only say what kind of box it is."""
    said = {w.lower() for w in _NAME_WORDS.findall(name)}
    return not said.isdisjoint(words) and said <= words | NEUTRAL_WORDS


def _hidden_or_boiler(tag: str, attrs: str, in_main: bool) -> tuple[bool, bool, bool]:
    """(boilerplate by its tag or role, a box that is boilerplate unless it frames the page, not shown)."""
    surely = tag in BOILER and tag != "form" and not (tag == "header" and in_main)
    if not attrs.strip():
        return surely, tag == "form", False
    got = {k.lower(): html.unescape(v[1:-1] if v[:1] in ("'", '"') else v) for k, v in _ATTR.findall(attrs)}
    hidden = "hidden" in got or got.get("aria-hidden", "").lower() == "true" or bool(re.search(r"display\s*:\s*none", got.get("style", ""), re.I))
    named = False
    if tag not in ("body", "html", "article", "main"):
        layout = not in_main and tag not in ("p", "h1", "h2", "h3", "b", "i", "em", "strong", "a")
        named = any(_telling(name, BOILER_OR_LAYOUT if layout else BOILER_NAMES) for name in f"{got.get('class', '')} {got.get('id', '')}".split())
    return surely or got.get("role", "").lower() in BOILER_ROLE, named or tag == "form", hidden


def blocks(page: str) -> list[Block]:
    """The page's blocks in order. Unclosed, stray and cut-off tags are tolerated."""
    found: list[Block] = []
    stack: list[_Open] = []
    parts: list[str] = []
    linked = links = mains = containers = 0
    heading = first_heading = False
    around: dict[int, int] = {}
    within = [0]  # the box around each box; the page's own number is 0
    opened: Counter[str] = Counter()
    begun: set[int] = set()  # containers with a block
    endless: set[str] = set()  # tags of raw text without an end in the rest of the page
    none = _Open("", False, False, 0, 0, 0)

    def push(o: _Open) -> None:
        stack.append(o)
        opened[o.tag] += 1

    def pop() -> str:
        opened[stack[-1].tag] -= 1
        return stack.pop().tag

    def boxed(box: bool, inside: int) -> int:
        if box:
            within.append(inside)
        return len(within) - 1 if box else inside

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                top = stack[-1] if stack else none
                if heading and top.container not in begun and _COMMENTS.fullmatch(text):
                    # The box that this heading begins, unless that is the page or the article itself.
                    own = list(takewhile(lambda o: o.container == top.container, reversed(stack)))
                    if own and own[-1].tag in ("div", "section", "details", "fieldset", "dl"):
                        for o in own:
                            o.bad = True
                begun.add(top.container)
                found.append(Block(text, top.bad, top.main, heading, linked, top.container, top.box, top.box if first_heading else around.get(top.main, 0)))
            parts.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw and not (stack and stack[-1].skip):
            parts.append(raw)
            if links:
                linked += len(raw.strip())

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = max(m.end(), m.start() + 1)
        if m.group(2) is None:
            continue
        tag, closing = m.group(2).lower(), bool(m.group(1))
        if tag == "br":
            say(" ")
        elif tag == "a":
            links = 0 if closing else 1
        elif closing:
            if opened[tag]:
                if tag in BLOCK or any(o.tag in BLOCK for o in takewhile(lambda o: o.tag != tag, reversed(stack))):
                    flush()
                while pop() != tag:
                    pass
                links = 0 if tag in BLOCK else links
            elif tag in BLOCK:
                flush()
            if tag in BLOCK:
                heading = first_heading = False
        elif tag in BLOCK or tag in SKIPPED:
            if tag in RAW:
                # Without an end, code goes on to the end of the page; other tags of this kind are overlooked.
                end = None if tag in endless else _RAW_END[tag].search(page, at)
                if end is None:
                    endless.add(tag)
                at = end.end() if end else size if tag in ("script", "style") else at
                continue
            if tag in BLOCK:
                flush()
                links = 0
                if tag not in VOID:
                    # A paragraph or item ends where the next begins.
                    while stack and stack[-1].tag == "p" or stack and tag == stack[-1].tag and tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                        pop()
                heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
                first_heading = tag == "h1"
            if tag in VOID or m.group(3).rstrip().endswith("/"):
                continue
            top = stack[-1] if stack else none
            boiler, box, hidden = _hidden_or_boiler(tag, m.group(3), top.main > 0)
            main = top.main
            if tag in MAIN and not top.main and not (boiler or top.bad):
                mains += 1
                main = mains
                around[main] = top.box
            containers += tag not in PLAIN
            push(_Open(tag, top.bad or boiler, top.skip or hidden or tag in SKIPPED, main, top.container if tag in PLAIN else containers, boxed(box, top.box)))
        elif m.group(3):
            # An inline element is followed only if it hides or marks its content.
            top = stack[-1] if stack else none
            boiler, box, hidden = _hidden_or_boiler(tag, m.group(3), top.main > 0)
            if (boiler or box or hidden) and tag not in VOID and not m.group(3).rstrip().endswith("/"):
                flush()
                push(_Open(tag, top.bad or boiler, top.skip or hidden, top.main, top.container, boxed(box, top.box)))
    flush()
    _without_frames(found, within)
    return found


def _without_frames(found: list[Block], within: list[int]) -> None:
    """Blocks in a box are bad, unless it encloses the first heading or the article and half of the text that is in no other bad place.

    ``within``: the box around each box, which has a smaller number.
    """
    frame = [False] * len(within)
    for b in found:
        box = b.around
        while box and not frame[box]:
            frame[box] = True
            box = within[box]

    def clear() -> list[bool]:
        """Whether a box and all around it are frames."""
        out = [True] * len(within)
        for box in range(1, len(within)):
            out[box] = frame[box] and out[within[box]]
        return out

    only_frames = clear()
    inside = [0] * len(within)
    for b in found:
        if not b.bad_place and only_frames[b.box]:
            inside[b.box] += len(b.text)
    for box in range(len(within) - 1, 0, -1):
        inside[within[box]] += inside[box]
    for box in range(1, len(within)):
        frame[box] = frame[box] and 2 * inside[box] >= inside[0]
    only_frames = clear()
    for b in found:
        b.bad_place = b.bad_place or not only_frames[b.box]


def first_pass(found: list[Block]) -> None:
    article = any(b.in_main and not b.bad_place for b in found)
    for b in found:
        words = _WORDS.findall(b.text.lower())
        b.words = len(words)
        b.stop = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
        if b.bad_place or article and not b.in_main:
            b.label = BAD
        elif b.linked > LINKS * len(b.text) and not (article and b.linked < 0.9 * len(b.text)):
            b.label = BAD
        elif b.words >= SHORT and b.stop >= STOP_HIGH or b.words >= LONG and b.stop >= STOP_LOW:
            b.label = GOOD
        else:
            b.label = OPEN


def _nearest(found: list[Block], place) -> tuple[list[int | None], list[int | None]]:
    """For each block, the nearest decided ones before and after it of the same place. In an article, bad blocks are no neighbours."""
    n = len(found)
    before: list[int | None] = [None] * n
    after: list[int | None] = [None] * n
    for order, into in ((range(n), before), (range(n - 1, -1, -1), after)):
        last: dict = {}
        for i in order:
            b = found[i]
            into[i] = last.get(place(b))
            if b.label != OPEN and not (b.in_main and b.label == BAD):
                last[place(b)] = i
    return before, after


def second_pass(found: list[Block]) -> None:
    """Undecided blocks take the label of the nearest decided neighbours, those of their own container first.

    Inside a marked article only its own blocks are neighbours, and one without any is good;
    elsewhere one without any is good if it is a heading or has stop words, else bad.
    """
    own = _nearest(found, lambda b: (b.in_main, b.container))
    wide = _nearest(found, lambda b: b.in_main)
    labels = []
    for i, b in enumerate(found):
        before, after = own if own[0][i] is not None or own[1][i] is not None else wide
        sides = [j for j in (before[i], after[i]) if j is not None]
        decided = {found[j].label for j in sides}
        if b.label != OPEN:
            labels.append(b.label)
        elif b.words >= LONG and own[0][i] is own[1][i] is None:
            labels.append(GOOD)  # a long text without links, among nothing that is decided
        elif b.heading and after[i] is not None:
            labels.append(found[after[i]].label)
        elif len(decided) == 1:
            labels.append(decided.pop())
        elif not sides:
            labels.append(GOOD if b.in_main or b.heading or b.stop >= STOP_LOW else BAD)
        else:
            near = min(sides, key=lambda j: (abs(j - i), -found[j].label))
            apart = abs(before[i] - i) != abs(after[i] - i)
            labels.append(found[near].label if apart else GOOD if b.stop >= STOP_LOW else BAD)
    for b, label in zip(found, labels, strict=True):
        b.label = label


def extract(page: str) -> str:
    """Good blocks in page order, joined by one space; empty if none."""
    found = blocks(page)
    first_pass(found)
    second_pass(found)
    return " ".join(b.text for b in found if b.label == GOOD)


SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def main_texts(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` per input row.

    Null or empty html gives empty text; a page may be of any length and depth; null ids and urls stay; repeated rows repeat; an empty
    table gives none; other columns are ignored.
    """
    ready(pages)
    rows = spread(pages.select(pages[id_column].cast("long").alias("page_id"), pages[url_column].cast("string").alias("url"), pages[html_column].cast("string").alias("html")))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            texts = [extract(h or "") for h in batch.column(2).to_pylist()]
            yield batch_of(SCHEMA, batch.column(0), batch.column(1), texts, [len(t) for t in texts])

    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
