"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  The first pass decides the clear ones: blocks
inside containers that never hold an article (by tag, role, or a class or id that says so), blocks that are mostly links,
and long blocks with many stop words.  In the second pass the undecided ones (short, or
long with few stop words) take the label of the nearest decided neighbour, one in the same
container before others.  A page that marks its article (``article`` or ``main``) starts with the blocks
outside as decided against and the blocks inside as near an article.

A class or id that only contains such a word (``comments-open``, ``with-sidebar``) is evidence: its container is left out unless
it holds more than half of the words of dense blocks, and on ``article`` and ``main`` it counts for nothing.

Every step is linear in the page, whatever its markup: a tag's end is looked up in one table of quotes and
closing brackets once a tag does not end, and open tags are counted by name.
"""

from __future__ import annotations

import bisect
import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import blocks

# Tags, class words and stop words.
RAW = "script style title textarea xmp iframe noembed noframes".split()
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre search section select summary "
    "table tbody td tfoot th thead tr ul noscript template svg math object".split()
)
BAD_TAGS = frozenset("nav footer aside form head header menu dialog select button fieldset noscript template svg math object search".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form toolbar".split())
BAD_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo "
    "promoted promotion related respond reply replies share sharing sidebar signup social sponsor sponsored subscribe teaser teasers toolbar widget widgets".split()
)
# Words that leave the meaning of a class name to the others in it.
NEUTRAL_WORDS = frozenset(
    "area bar block body bottom box button buttons container content group holder inner item items left link links list main outer page panel "
    "post posts row section site top right text title wrap wrapper".split()
)
STOP_WORDS = frozenset(
    "a an and are as at be but by for from had has have he her his in is it its not of on or she that the their they this to was were which with you "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour que qui sa se ses son sont sur un une vous "
    "als am auf aus bei bin das dass dem den der des die durch ein eine einem einen einer er es für hat ich im ist mit nach nicht oder sich sie sind so und von war wie wir zu zum zur "
    "al como con del el ella ellos entre era es esta este ha hay la las lo los mas me mi muy no nos o para pero por que se ser si sin su sus también un una y ya".split()
)
LONG, DENSE, LINKS = 12, 0.22, 0.5

_NAME_AT = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)")
_ATTRS = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_MARKS = re.compile(r"[>\"']")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
_ATTR = re.compile(r"([^\s=\"'/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")
_ZEROS, _HUGE = re.compile(r"&#0{9,}+"), re.compile(r"&#[0-9]{8,}+;?")
HARD, STRONG, WEAK = 3, 2, 1


@dataclass
class Block:
    text: str
    links: int          # characters inside links
    bad: bool           # inside a container that never holds an article
    inside: bool        # inside the marked article
    container: int      # number of the innermost container
    item: bool          # a list item
    weak: int           # number of the innermost container with a doubtful class or id, 0: none


def decode(text: str) -> str:
    """Character references decoded; a number of any length is a character or U+FFFD."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = _HUGE.sub("\ufffd", _ZEROS.sub("&#0", text))
    return html.unescape(text)


def _evidence(tag: str, attrs: str) -> int:
    """How clearly a container is none of the article's: HARD by tag or role, STRONG or WEAK by class or id, else 0."""
    if tag in BAD_TAGS:
        return HARD
    found = 0
    if not attrs.strip():
        return found
    for name, a, b, c in _ATTR.findall(attrs):
        value, name = a or b or c, name.lower()
        if name == "role" and value.strip().lower() in BAD_ROLES:
            return HARD
        if name in ("class", "id") and tag not in ("html", "body"):
            for word in value.split():
                # A name of one or two words, such as side-bar or cookieNotice; words are read alone and joined.
                parts = [x.lower() for x in _NAME.findall(word)]
                if "".join(parts) in BAD_WORDS:
                    found = STRONG
                elif any(x in BAD_WORDS for x in parts):
                    found = max(found, STRONG if all(x in BAD_WORDS or x in NEUTRAL_WORDS for x in parts) else WEAK)
    return found if found == STRONG or tag not in ("article", "main") else 0


class _Ends:
    """Where tags end, for a page with a tag that does not."""

    def __init__(self, page: str):
        marks = [(m.start(), m[0]) for m in _MARKS.finditer(page)]
        self.at, self.end = [i for i, _ in marks], [-1] * (len(marks) + 1)
        following = {}
        for k in range(len(marks) - 1, -1, -1):          # the end seen from each mark outside quotes
            i, c = marks[k]
            if c == ">":
                self.end[k] = i
            else:
                self.end[k] = self.end[following[c] + 1] if c in following else -1
                following[c] = k

    def after(self, i: int) -> int:
        return self.end[bisect.bisect_left(self.at, i)]


def tags(page: str):
    """(text before, tag, closing?, attributes) of each tag; tag is None for comments, scripts and the like and at the end."""
    at = i = 0
    last, ends = page.rfind(">"), None
    while (i := page.find("<", i)) >= 0:
        if page.startswith("<!--", i):
            end = page.find("-->", i + 4)
            yield page[at:i], None, False, ""
            at = i = len(page) if end < 0 else end + 3
            continue
        if i > last:                                     # nothing closes any more
            break
        m = _NAME_AT.match(page, i)
        if m is None:
            if page[i + 1:i + 2] in ("!", "?", "/") and page[i + 1:i + 2]:
                yield page[at:i], None, False, ""
                at = i = page.index(">", i) + 1
            else:
                i += 1
            continue
        end = -1
        if ends is None:
            found = _ATTRS.match(page, m.end())
            if found:
                end = found.end() - 1
            else:
                ends = _Ends(page)
        else:
            end = ends.after(m.end())
        yielded = page[at:i]
        if end < 0:                                      # a quote that is never closed: up to the next bracket
            yield yielded, None, False, ""
            at = i = page.index(">", i) + 1
            continue
        closing, tag = bool(m[1]), m[2].lower()
        if tag in _RAW_END and not closing:
            stop = _RAW_END[tag].search(page, end + 1)
            stop = page.find(">", stop.end()) if stop else -1
            yield yielded, None, False, ""
            at = i = len(page) if stop < 0 else stop + 1
            continue
        yield yielded, tag, closing, page[m.end():end]
        at = i = end + 1
    yield page[at:], None, False, ""


def cut(page: str) -> tuple[list[Block], list[int]]:
    """The blocks of a page, and for each doubtful container the doubtful one around it (0: none)."""
    blocks: list[Block] = []
    stack: list[tuple[str, bool, bool, int, int, bool]] = []   # tag, bad, inside, container, weak, bad by itself
    open_, bad_open = Counter(), 0                           # open tags by name; those bad by themselves, without forms
    around = [0]
    text, links, in_link, numbers = [], 0, 0, 0
    outside = ("", False, False, 0, 0, False)

    def flush():
        nonlocal links
        if text:
            joined = " ".join(decode("".join(text)).split())
            if joined:
                _, bad, inside, number, weak, _ = stack[-1] if stack else outside
                blocks.append(Block(joined, links, bad, inside, number, any(s[0] == "li" for s in stack[-2:]), weak))
            text.clear()
        links = 0

    def push(tag, bad, inside, number, weak, evidence=0):
        nonlocal bad_open
        own = evidence >= STRONG and tag != "form"
        stack.append((tag, bad or evidence >= STRONG, inside, number, weak, own))
        open_[tag] += 1
        bad_open += own

    def pop():
        nonlocal bad_open
        entry = stack.pop()
        open_[entry[0]] -= 1
        bad_open -= entry[5]
        return entry[0]

    def doubtful(evidence: int, weak: int) -> int:
        if evidence != WEAK:
            return weak
        around.append(weak)
        return len(around) - 1

    for piece, tag, closing, attrs in tags(page):
        if piece:
            if in_link:
                links += len(" ".join(decode(piece).split()))
            text.append(piece)
        if tag is None:
            continue
        if closing:
            if tag == "a":
                in_link = max(0, in_link - 1)
            if tag in BLOCK_TAGS:
                flush()
                in_link = 0 if tag in ("nav", "ul", "table", "article") else in_link
            if open_[tag]:
                if tag not in BLOCK_TAGS:
                    flush()
                while pop() != tag:
                    pass
            continue
        if tag == "a":
            in_link = 1
        elif tag == "br":
            text.append(" ")
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        _, bad, inside, number, weak, _ = stack[-1] if stack else outside
        if tag in BLOCK_TAGS:
            flush()
            while stack and (stack[-1][0] == "p" or tag == "li" and stack[-1][0] == "li" or tag in ("dt", "dd") and stack[-1][0] in ("dt", "dd")):
                pop()                                    # closed without saying so
            _, bad, inside, number, weak, _ = stack[-1] if stack else outside
            marks = tag in ("article", "main")
            evidence = _evidence(tag, attrs)
            if tag == "header" and inside:
                evidence = 0                             # the heading of the article itself
            if marks and evidence < STRONG and not bad_open:
                bad, inside = False, True                # a form around the whole page is no form
            if tag not in ("p", "li"):
                numbers += 1
                number = numbers
            if not attrs.rstrip().endswith("/") or tag not in ("svg", "math"):
                push(tag, bad, inside, number, doubtful(evidence, weak), evidence)
        elif attrs and (evidence := _evidence(tag, attrs)):   # such as a span with class ad
            flush()
            push(tag, bad, inside, number, doubtful(evidence, weak), evidence)
        elif tag == "span" and open_["span"]:
            push(tag, bad, inside, number, weak)
    flush()
    return blocks, around


def _dense(words: list[str]) -> bool:
    return len(words) >= LONG and sum(w.strip(".,;:!?\"'()").lower() in STOP_WORDS for w in words) >= DENSE * len(words)


def weigh(blocks: list[Block], around: list[int]) -> None:
    """Mark as bad the blocks of doubtful containers, but for those with more than half of the words in dense blocks."""
    if len(around) == 1:
        return
    held, total = [0] * len(around), 0
    for b in blocks:
        words = b.text.split()
        if not b.bad and b.links <= LINKS * len(b.text) and _dense(words):
            total += len(words)
            held[b.weak] += len(words)
    for i in range(len(around) - 1, 0, -1):              # containers have higher numbers than those around them
        held[around[i]] += held[i] if around[i] else 0
    bad = [False] * len(around)
    for i in range(1, len(around)):
        bad[i] = bad[around[i]] or 2 * held[i] <= total
    for b in blocks:
        b.bad = b.bad or bad[b.weak]


def classify(blocks: list[Block]) -> list[bool]:
    """Which blocks belong to the main text."""
    marked = any(b.inside and not b.bad for b in blocks)
    label: list[bool | None] = []
    for b in blocks:
        words = b.text.split()
        link_share = b.links / max(1, len(b.text))
        if b.bad or marked and not b.inside:
            label.append(False)
        elif link_share > LINKS and (not marked or b.item and link_share > 0.9):
            label.append(False)
        elif _dense(words):
            label.append(True)
        else:
            label.append(None)
    decided = [i for i, x in enumerate(label) if x is not None]
    if not any(x for x in label):
        return [x is None for x in label]                # nothing clear: all that is not clearly boilerplate
    out, near = list(label), 0
    for i, x in enumerate(label):
        while near < len(decided) and decided[near] < i:
            near += 1
        if x is not None:
            continue
        around = decided[max(0, near - 1):near + 1]
        best = min(around, key=lambda j: (
            marked and not blocks[j].inside, blocks[j].container != blocks[i].container, abs(j - i), not label[j],
        ))
        out[i] = True if marked and blocks[i].inside and not label[best] and not blocks[i].item else label[best]
    return out


def main_text(page: str | None) -> str:
    found, around = cut(page or "")
    weigh(found, around)
    return " ".join(b.text for b, keep in zip(found, classify(found)) if keep)


def _extract(batches):
    for part, _, _ in blocks(batches, "html"):
        texts = [main_text(x) for x in part.column("html").to_pylist()]
        yield pa.RecordBatch.from_pydict({
            "page_id": part.column("page_id"), "url": part.column("url"),
            "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        })


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): text and n_chars (code points).

    Null and empty pages have an empty text.  Character references are decoded, white space in a block
    becomes one space, blocks are joined by one space.  Malformed markup of any length costs time in proportion.  Null and repeated page_ids pass; other columns are ignored.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
