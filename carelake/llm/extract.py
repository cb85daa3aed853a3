"""Main text of web pages by two-pass block rules.

The page is cut into blocks at block-level tags; inline tags, comments, scripts and the
like leave no text.  Pass one classifies each block by itself:

* inside a navigation, header, footer, aside or form element or role, or where comments and
  consent notices are named by class or id, it is bad;
* inside a container whose class or id is a name of boilerplate (``SUSPECT_NAMES`` as a whole
  word, its first or its last part) it is bad, unless that container holds more than half
  of the running text of the page (of its article, if there is text in one): then the name
  says nothing;
* with more than ``max_link_density`` of its characters in links it is bad, and so is a
  copyright line outside an article;
* shorter than ``short`` it is ambiguous (a character of a script without spaces counts as three);
* otherwise a stop-word density of ``stop_high`` makes it good, of ``stop_low`` near
  good, less makes it bad outside an article and ambiguous inside one.

Running text is that of blocks which the last three rules don't make bad or ambiguous.  If the
long blocks of a page, taken together, have fewer stop words than ``stop_low``, its language
is not among those covered: a long block is then good if it has a sentence mark.

Pass two settles the ambiguous blocks in one sweep forward and one back that carry the last
decided label: each takes the label of its nearest decided neighbour, a heading that of the
next one; inside an article (or main) element only neighbours within it count, and if there
are none the block is article text.  Near good counts as good unless both neighbours are bad.
The good blocks, references decoded and white space folded, are joined by a space in page order.

Cases: a null or empty page gives an empty text; a page cut off anywhere gives what came
before; unclosed elements end with their ancestors; whole pages are read, whatever
their length, in time linear in their tags and blocks; repeated rows stay; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.llm.common import map_text

RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"  # a whole tag
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)"                       # unbalanced quotes, or cut off
    r"|<[!?/][^>]*(?:>|\Z)", re.S)
ATTR = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

#: elements whose content is no page text at all
SILENT = frozenset("script style noscript template svg math iframe object embed audio video canvas head title textarea select datalist".split())
RAW = frozenset("script style noscript iframe title textarea template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img br".split())
BAD_TAGS = frozenset("nav footer aside form button fieldset menu dialog".split())
GOOD_TAGS = frozenset("article main".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form "
                      "toolbar".split())
#: class and id names of what is never page text, and of containers that may turn out to hold it
SEALED_NAMES = frozenset("comment comments consent cookie cookies discussion disqus gdpr newsletter replies reply "
                         "respond".split())
SUSPECT_NAMES = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs copyright "
                          "dialog footer header login masthead menu modal nav navbar navigation notice notices "
                          "notification overlay pager pagination popup promo promoted recommended related search "
                          "share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget "
                          "widgets".split())
COMMENT_ARTICLES = frozenset("comment comment-body comment-content comment-item reply".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: frequent function words of the languages covered
STOP_WORDS = frozenset((
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their "
    "they this to was we were which will with you "
    "al como con de del el en es esta este la las lo los más no o para pero por que se si sin sobre su sus un una y "
    "au aux avec ce cette dans des du elle est et il ils je le les leur mais ne nous ou par pas plus pour qui sa ses "
    "son sont sur une vous à "
    "als auch auf aus bei das dem den der des die durch ein eine einem einen einer er es für hat im ist mit nach "
    "nicht oder sich sie sind und von war werden wie wird zu zum zur").split())


SENTENCE_END = re.compile(r"[.!?…。！？।؟۔]")
#: scripts that are written without spaces
WIDE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")


class Block:
    __slots__ = ("parts", "linked", "bad", "region", "suspect", "heading", "text", "kind", "label")

    def __init__(self, bad: bool, region: int, suspect: int, heading: bool):
        self.parts, self.linked = [], 0
        self.bad, self.region, self.suspect, self.heading = bad, region, suspect, heading


def named(words: list[str], in_article: bool) -> str | None:
    """What the words of a class or id say."""
    said = None
    for word in words:
        parts = re.split(r"[^a-z0-9]+", word)
        if word == "hidden":
            return "bad"
        if not {"has", "with", "without", "no"}.isdisjoint(parts):
            continue
        ends = {parts[0], parts[-1]}
        if not SEALED_NAMES.isdisjoint(ends):
            return "sealed"
        if not SUSPECT_NAMES.isdisjoint(ends) and not (in_article and parts == ["header"]):
            said = "suspect"
    return said


def standing(tag: str, attrs: str, in_article: bool) -> str | None:
    """What an element says about its content: good, plain, bad, sealed (bad, whatever is inside),
    suspect or nothing."""
    if tag in ("body", "html"):
        return "plain"
    if tag in BAD_TAGS or tag == "header" and not in_article:
        return "bad"
    said = "good" if tag in GOOD_TAGS else None
    if attrs:
        for name, *values in ATTR.findall(attrs):
            name, value = name.lower(), (values[0] or values[1] or values[2]).lower()
            if name in ("class", "id") and tag in GOOD_TAGS:
                if not COMMENT_ARTICLES.isdisjoint(value.split()):
                    return "sealed"
            elif tag in GOOD_TAGS:
                continue
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                return "bad"
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return "bad"
            elif name == "role":
                if value in ("main", "article"):
                    return "good"
                if value in BAD_ROLES:
                    return "bad"
            elif name in ("class", "id"):
                found = named(value.split(), in_article)
                if found in ("bad", "sealed"):
                    return found
                said = said or found
    return said


def blocks_of(page: str) -> tuple[list[Block], list[int]]:
    """The non-empty blocks of a page, in order, and the enclosing suspect of each suspect
    container (0: none)."""
    blocks: list[Block] = []
    outer = [0]
    outside = ("ok", 0, 0)  # standing, region, innermost suspect container
    stack: list[tuple[str, tuple[str, int, int]]] = []  # open elements, with the state inside them
    open_tags: Counter = Counter()
    state = outside
    regions = links = silent = 0
    current: Block | None = None
    heading = False
    at = 0

    def add(raw: str) -> None:
        nonlocal current
        if silent or not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        if current is None:
            if text.isspace():
                return
            current = Block(state[0] != "ok", state[1], state[2], heading)
            blocks.append(current)
        current.parts.append(text)
        if links:
            current.linked += len(text)

    while m := TAG.search(page, at):
        add(page[at:m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[2] is None and not m[0].endswith(">"):
            break  # cut off inside a tag
        closing, attrs = m[1] or m[4], m[3] or m[6] or ""
        if tag == "br":
            if current is not None:
                current.parts.append(" ")
            continue
        if tag not in INLINE:
            current = None
            heading = tag in HEADINGS and not closing
        if closing:
            while open_tags[tag]:
                gone, _ = stack.pop()
                open_tags[gone] -= 1
                links -= gone == "a"
                silent -= gone in SILENT
                if gone == tag:
                    state = stack[-1][1] if stack else outside
                    break
            continue
        if tag in VOID or attrs.endswith("/") and tag in ("svg", "path", "iframe"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "body":  # whatever the head left open ends here
            stack, links, silent, state = [], 0, 0, outside
            open_tags.clear()
        kind, region, suspect = state
        said = standing(tag, attrs, region > 0)
        if said == "plain":
            state = outside
        elif kind != "sealed":
            if said == "good":
                regions += 1
                state = ("ok", regions, 0)
            elif said in ("bad", "sealed"):
                state = (said, region, suspect)
            elif said == "suspect" and kind == "ok":
                outer.append(suspect)
                state = ("ok", region, len(outer) - 1)
        if tag == "a" and open_tags["a"]:  # a link ends the one before
            k = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "a")
            del stack[k]
            open_tags["a"] -= 1
            links -= 1
        stack.append((tag, state))
        open_tags[tag] += 1
        links += tag == "a"
        silent += tag in SILENT
    else:
        add(page[at:])
    kept = []
    for b in blocks:
        b.text = " ".join("".join(b.parts).split())
        if b.text:
            kept.append(b)
    return kept, outer


def stop_words(text: str) -> tuple[int, int]:
    words = text.lower().split()
    return sum(w.strip(".,;:!?()\"'") in STOP_WORDS for w in words), len(words)


def first_pass(blocks: Sequence[Block], outer: Sequence[int], short: int, max_link_density: float, stop_low: float,
               stop_high: float) -> None:
    """The labels that blocks have by themselves: good, near, short or bad."""
    counts = {}
    for i, b in enumerate(blocks):
        n = len(b.text)
        size = n if b.text.isascii() else n + 2 * len(WIDE.findall(b.text))
        if b.linked > max_link_density * n or b.region <= 0 and "©" in b.text:
            b.kind = "bad"
        elif size < short:
            b.kind = "short" if b.region > 0 or not b.linked else "bad"
        else:
            b.kind = "long"
            counts[i] = stop_words(b.text)
    judged = [counts[i] for i in counts if not blocks[i].bad]
    covered = sum(s for s, _ in judged) >= stop_low * sum(n for _, n in judged)
    for i, (stops, n) in counts.items():
        b = blocks[i]
        if covered and stops >= stop_high * n or not covered and SENTENCE_END.search(b.text):
            b.kind = "good"
        elif covered and stops >= stop_low * n:
            b.kind = "near"
        else:
            b.kind = "short" if b.region > 0 else "bad"
    running = [b for b in blocks if not b.bad and b.kind in ("good", "near")]
    if any(b.region > 0 for b in running):
        running = [b for b in running if b.region > 0]
    held = [0] * len(outer)  # by suspect container; inner ones come later
    for b in running:
        held[b.suspect] += len(b.text)
    total = sum(held)
    for k in range(len(outer) - 1, 0, -1):
        held[outer[k]] += held[k]
    barred = [False] * len(outer)
    for k in range(1, len(outer)):
        barred[k] = 2 * held[k] <= total or barred[outer[k]]
    for b in blocks:
        b.bad = b.bad or barred[b.suspect]
        b.label = "bad" if b.bad else b.kind


def second_pass(blocks: Sequence[Block]) -> None:
    """Ambiguous labels from the decided neighbours."""
    def sweep(order) -> dict[int, tuple[str | None, int]]:
        """By ambiguous block, the last decided label before it in ``order`` and how far away it is."""
        last: dict[int, tuple[str, int]] = {}  # by region; 0: of the whole page
        found = {}
        for i in order:
            b = blocks[i]
            region = max(b.region, 0)
            if b.label in ("good", "bad"):
                last[0] = (b.label, i)
                if region and not b.bad:
                    last[region] = (b.label, i)
            else:
                label, k = last.get(region, (None, 0))
                found[i] = (label, abs(k - i))
        return found

    ahead, behind = sweep(range(len(blocks))), sweep(range(len(blocks) - 1, -1, -1))
    for i, (before, d1) in ahead.items():
        b, (after, d2) = blocks[i], behind[i]
        if b.label == "near":
            b.label = "bad" if before == after == "bad" and b.region <= 0 else "good"
        elif b.region > 0:  # neighbours that differ leave it to the article
            b.label = "bad" if "bad" in (before, after) and "good" not in (before, after) else "good"
        elif before == after and before or b.heading and after:
            b.label = after
        elif before is None or after is None:
            b.label = "bad"
        elif d2 < d1:
            b.label = after
        else:
            b.label = before if d1 < d2 else "bad"


def main_text(page: str | None, short: int = 70, max_link_density: float = 0.5, stop_low: float = 0.1,
              stop_high: float = 0.2) -> str:
    blocks, outer = blocks_of(page or "")
    first_pass(blocks, outer, short, max_link_density, stop_low, stop_high)
    second_pass(blocks)
    return " ".join(b.text for b in blocks if b.label == "good")


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", markup: str = "html",
                      **rules) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    def start():
        def each(pages: list):
            out = [main_text(p, **rules) for p in pages]
            return out, [len(x) for x in out]
        return each

    done = map_text(pages, markup, RESULT, start, [page_id, url])
    return done.select(F.col("c0").alias("page_id"), F.col("c1").alias("url"), F.col("r_text").alias("text"),
                       F.col("r_n_chars").alias("n_chars"))
