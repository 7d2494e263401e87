"""Main text of web pages by wrapper induction.

Every page is parsed to a tree; siblings in a row with one label (list items, paragraphs, rows) are folded into one
node, and the folded trees of all pages of a host are aligned by simple tree matching: the largest set
of node pairs that keeps labels, order and nesting. Matched nodes merge into one slot of the host's template,
nodes without a partner are inserted as slots of their own, so pages of another layout add their parts. Equal trees are
counted first; the rest is merged in groups of about ``FAN``, and the results again, until a host has one template.

All pages are then aligned with their host's template, and the texts of each slot are counted. Pages count by their
content, the longest block (other than the counted one) that few pages of the host have: pages that agree in it are one, and pages
with less than ``OWN_SHARE`` of such text are none, so an article that is copied does not become template. A text
is template where it stands in a slot on at least ``MIN_PAGES`` contents, which are at least ``SLOT_SHARE`` of those
with the slot and ``HOST_SHARE`` of the host's. What varies
in a slot is content. The main region of a page is the deepest container whose slots hold nearly all
varying text and all varying first headings; an article or main element is not cut further. The text of that region, without template
text and without regions that name themselves a menu, header, footer, side bar, notice, advert, form or comments, is the
page's text. Template text is only what a node says itself: its kids are judged by their own slots. A class or id names
a region by whole words (``cookie-banner``, not ``has-sidebar``), and never one that holds most of the page's text
while no article stands elsewhere.

Tables of the matching are exact up to ``CELLS`` cells a pair of trees; kids beyond are matched by label from both ends and
then by their number among kids of that label, so that long pages take time in proportion to their length.

Defined cases: null or empty html gives an empty text; a page whose host has no other content to compare with, or that
has no varying text, gives the text of its article or main element, else of its
body; broken markup is read as far as browsers do; a null url belongs to the nameless host; repeated rows
are extracted one by one, and there are no ties; pages of any length are read whole; other columns may have any names; identifiers are whole
numbers; an empty table gives no rows. Nodes below ``MAX_DEPTH`` are not aligned; their text belongs to the node above.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from html import unescape
from pyspark.sql import Column, DataFrame, functions as F

from shopmart.llm import by_value
from shopmart.llm.storage import discard, store
from shopmart.operators.joins import dimension_join

by_value(__name__)

MIN_PAGES = 5
SLOT_SHARE, HOST_SHARE, OWN_SHARE = 0.5, 0.05, 0.25
MAIN_SHARE = 0.8
MAX_DEPTH = 40
FAN = 32
CELLS = 40_000
#: Up to so many bytes of templates or wrappers are broadcast; beyond, parts of about so many pages of a host meet its own.
BROADCAST_BYTES, PART_PAGES = 32 << 20, 500
#: A template keeps at most so many slots, those of the most pages; rarer ones could not hold template text.
MAX_SLOTS = 20_000
#: Alignments that a task remembers for a host.
KNOWN_FORMS = 1000

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noembed noframes plaintext".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
CONTAINERS = set("html body main article section div td center".split())
NAMED_TAGS = set(
    "head nav header footer aside form script style noscript template svg button select textarea iframe menu dialog "
    "title object canvas".split()
)
NAMED_WORDS = set(
    "nav navbar navigation menu header masthead footer sidebar side aside notice notices cookie cookies consent banner "
    "alert ad ads advert adverts advertisement advertising promo sponsor sponsored comment comments reply replies share "
    "social related newsletter subscribe signup login breadcrumb breadcrumbs popup modal widget toolbar".split()
)
#: Words that may stand beside one of them in a class or id that names a region.
NEUTRAL_WORDS = set(
    "site page main global primary secondary top bottom left right upper lower inner outer wrapper container box list area "
    "section block bar links link items item form widget widgets content module region group panel js".split()
)
NAMED_ROLES = set("navigation banner contentinfo complementary search form menu dialog alert".split())

_PLAIN_TAG = re.compile("<(/?)([a-zA-Z][^\\s/<>\"']*)([^\"'<>]*)>")
_TAG_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_QUOTE_OR_END = re.compile("[\"'>]")
_DIGITS = re.compile(r"\d+")
_PARTS = re.compile(r"[a-z]+")
_ENDED_BY_ITSELF = ("li", "dt", "dd", "tr", "td", "th", "option")


def _names_region(value: str) -> bool:
    """Whether one of the tokens of a class or id consists of words for such regions, alone or with neutral ones."""
    for token in value.split():
        words = _PARTS.findall(token)
        if not NAMED_WORDS.isdisjoint(words) and all(word in NAMED_WORDS or word in NEUTRAL_WORDS for word in words):
            return True
    return False


class Node:
    """An element: its tag, its label (tag and class), kids (nodes and strings), and whether it is left out by name."""

    __slots__ = ("tag", "label", "kids", "named", "by_word")

    def __init__(self, tag: str, attributes: str) -> None:
        self.tag, self.kids, self.label = tag, [], tag
        self.named, self.by_word = tag in NAMED_TAGS, False
        if attributes and "=" in attributes:
            for name, *values in _ATTRIBUTE.findall(attributes):
                value, name = "".join(values).lower(), name.lower()
                if name == "class":
                    self.label = f"{tag}.{_DIGITS.sub('#', value)}"
                if tag not in ("html", "body") and not self.named:
                    found = not NAMED_ROLES.isdisjoint(value.split()) if name == "role" else _names_region(value)
                    self.named = self.by_word = found


class _Reader:
    """Builds the tree of a page. Every step costs what it adds or closes, however broken the markup is."""

    def __init__(self, html: str) -> None:
        self.html, self.root = html, Node("#root", "")
        self.open = [self.root]
        self.blocks = [0]  # places of open nodes that are not inline
        self.places: dict[str, list[int]] = {}  # places of open nodes by tag
        self.quotes = True
        self.chars = self.articles = 0  # of text, and elements, read so far
        self.before: dict[int, tuple[int, int]] = {}  # what was read when an open node named by a word began
        self.by_word: list[tuple[Node, int, int]] = []  # closed ones with the text and articles they hold

    def tag_end(self, at: int) -> int:
        """Where a tag that starts before ``at`` ends: the next > outside of quotes, if there is one."""
        place = at
        while self.quotes:
            found = _QUOTE_OR_END.search(self.html, place)
            if found is None:
                break
            if found.group() == ">":
                return found.start()
            place = self.html.find(found.group(), found.end()) + 1
            if not place:
                break
        self.quotes = False  # a quote that never ends: quotes mean nothing from here on
        return self.html.find(">", at)

    def cut(self, place: int) -> None:
        """Close all nodes from a place on."""
        while len(self.open) > place:
            node = self.open.pop()
            self.places[node.tag].pop()
            if node.by_word:
                self._weigh(node)
        while self.blocks[-1] >= place:
            self.blocks.pop()

    def _weigh(self, node: Node) -> None:
        """A class or id does not name a region that holds most of the text; see :meth:`read` for articles elsewhere."""
        chars, articles = self.before.pop(id(node))
        self.by_word.append((node, self.chars - chars, self.articles - articles))

    def end(self, tag: str) -> None:
        at = self.places.get(tag)
        if at and (tag not in INLINE or at[-1] > self.blocks[-1]):
            self.cut(at[-1])

    def start(self, tag: str, attributes: str) -> Node:
        if tag not in INLINE:  # a block ends the paragraph it stands in, a list item the item before it
            block = self.blocks[-1]
            own = self.open[block].tag
            if own == "p" or (own == tag and tag in _ENDED_BY_ITSELF):
                self.cut(block)
        node = Node(tag, attributes)
        self.open[-1].kids.append(node)
        opens = tag not in VOID and tag not in RAW and not attributes.endswith("/")
        if opens:
            if node.by_word:
                self.before[id(node)] = self.chars, self.articles
            self.places.setdefault(tag, []).append(len(self.open))
            if tag not in INLINE:
                self.blocks.append(len(self.open))
            self.open.append(node)
        self.articles += tag in ("article", "main")
        return node

    def text(self, text: str) -> None:
        self.open[-1].kids.append(text)
        self.chars += len(text.strip())

    def read(self) -> Node:
        html, at, end = self.html, 0, len(self.html)
        last_close = html.rfind(">")
        while at < end:
            start = html.find("<", at)
            if start < 0:
                start = end
            if start > at:
                self.text(html[at:start])
            at = start
            if start == end:
                break
            plain = _PLAIN_TAG.match(html, start)
            if plain:
                at = self.tag(*plain.groups(), plain.end())
                continue
            if html.startswith("<!--", start):
                stop = html.find("--", start + 4)
                while 0 <= stop < end and not html.startswith((">", "!>"), stop + 2):
                    stop = html.find("--", stop + 1)
                at = end if stop < 0 else html.find(">", stop) + 1
                continue
            if html.startswith(("<!", "<?"), start):
                at = html.find(">", start) + 1 or end
                continue
            found = _TAG_NAME.match(html, start + 1)
            stop = self.tag_end(found.end()) if found and start < last_close else -1
            if stop < 0:  # a sign, not a tag
                self.text("<")
                at = start + 1
            else:
                at = self.tag(*found.groups(), html[found.end() : stop], stop + 1)
        self.cut(1)
        for node, chars, articles in self.by_word:
            if 2 * chars > self.chars and articles == self.articles:
                node.named = False
        return self.root

    def tag(self, closing: str, tag: str, attributes: str, at: int) -> int:
        """Take a tag that ends before ``at``; returns where to read on."""
        tag = tag.lower()
        if closing:
            self.end(tag)
            return at
        node = self.start(tag, attributes)
        if tag not in RAW:
            return at
        close = re.compile(rf"</{tag}\b", re.I).search(self.html, at)
        node.kids.append(self.html[at : close.start() if close else None])
        return len(self.html) if not close else (self.html.find(">", close.end()) + 1 or len(self.html))


def parse(html: str) -> Node:
    """The tree of a page: kids are nodes and strings in page order."""
    return _Reader(html).read()


def _walk(root: Node) -> list[Node]:
    """All nodes outside regions named by their tag, parents first."""
    found, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        found.append(node)
        waiting.extend(k for k in node.kids if not isinstance(k, str) and (not k.named or k.by_word))
    return found


def text_of(node: Node, left_out: set[int] = frozenset()) -> str:
    """Text of a node in page order: blocks apart by one space, white space as one space; own strings of some nodes left out."""
    parts: list[str] = []
    waiting: list = [node]
    while waiting:
        item = waiting.pop()
        if isinstance(item, str):
            parts.append(unescape(item) if "&" in item else item)
        elif not (item.named and item is not node):
            block = item.tag not in INLINE
            if block:
                parts.append(" ")
                waiting.append(" ")
            if id(item) in left_out:  # kids are judged by their own slots; a string leaves a gap between them
                waiting.extend(" " if isinstance(k, str) else k for k in reversed(item.kids))
            else:
                waiting.extend(reversed(item.kids))
    return " ".join("".join(parts).split())


def _own_text(node: Node) -> str:
    own = "".join(k if isinstance(k, str) else " " for k in node.kids)
    return " ".join((unescape(own) if "&" in own else own).split())


class Slot:
    """A node of a folded tree or a template: label, kids, page nodes, and on how many pages it stood."""

    __slots__ = ("label", "kids", "nodes", "pages", "shape", "number")

    def __init__(self, label: str, kids: list[Slot], nodes: list[Node] = (), pages: int = 1) -> None:
        self.label, self.kids, self.nodes, self.pages, self.number = label, kids, list(nodes), pages, 0
        self.shape = hash((label, tuple(kid.shape for kid in kids)))


class Matcher:
    """Simple tree matching of two trees: for each compared pair of nodes its size and the pairs of its kids."""

    def __init__(self, cells: int = CELLS) -> None:
        self.cells, self.known = cells, {}

    def match(self, left: Slot, right: Slot) -> tuple[int, list[tuple[Slot, Slot]]]:
        """Nodes in the largest match of two trees with one label, and the matched kids."""
        key = id(left), id(right)
        if key not in self.known:
            pairs = self._kids(left, right)
            self.known[key] = 1 + sum(self.match(a, b)[0] for a, b in pairs), pairs
        return self.known[key]

    def _kids(self, left: Slot, right: Slot) -> list[tuple[Slot, Slot]]:
        a, b = left.kids, right.kids
        if left.shape == right.shape:
            return list(zip(a, b))
        if not a or not b:
            return []
        if len(a) * len(b) <= self.cells:
            self.cells -= len(a) * len(b)
            return self._best(a, b)
        first = 0
        while first < min(len(a), len(b)) and a[first].label == b[first].label:
            first += 1
        last = 0
        while last < min(len(a), len(b)) - first and a[-1 - last].label == b[-1 - last].label:
            last += 1
        ends = list(zip(a[:first], b[:first])), list(zip(a[len(a) - last :], b[len(b) - last :]))
        return ends[0] + _by_number(a[first : len(a) - last], b[first : len(b) - last]) + ends[1]

    def _best(self, a: list[Slot], b: list[Slot]) -> list[tuple[Slot, Slot]]:
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            row, above = best[i + 1], best[i]
            for j, y in enumerate(b):
                size = above[j] + self.match(x, y)[0] if x.label == y.label else 0
                row[j + 1] = max(row[j], above[j + 1], size)
        pairs, i, j = [], len(a), len(b)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((a[i], b[j]))
        return pairs[::-1]


def _by_number(a: list[Slot], b: list[Slot]) -> list[tuple[Slot, Slot]]:
    """The n-th kid of a label with the n-th of it on the other side, as many as keep the order."""
    seen: Counter = Counter()
    places = {}
    for place, kid in enumerate(b):
        places[kid.label, seen[kid.label]] = place
        seen[kid.label] += 1
    seen = Counter()
    ends: list[int] = []
    chains: list[tuple] = []
    for kid in a:
        place = places.get((kid.label, seen[kid.label]))
        seen[kid.label] += 1
        if place is not None:
            at = bisect_left(ends, place)
            chain = (kid, b[place], chains[at - 1] if at else None)
            ends[at:], chains[at:] = ([place], [chain]) if at == len(ends) else ([place, *ends[at + 1 :]], [chain, *chains[at + 1 :]])
    chain, pairs = chains[-1] if chains else None, []
    while chain:
        pairs.append(chain[:2])
        chain = chain[2]
    return pairs[::-1]


def merge(slot: Slot, other: Slot, matcher: Matcher | None = None) -> Slot:
    """One tree for two with one label: matched nodes are merged, the others inserted behind their last matched sibling."""
    matcher = matcher or Matcher()
    partner = {id(b): a for a, b in matcher.match(slot, other)[1]}
    behind: dict[int | None, list[Slot]] = {}
    last = None
    for kid in other.kids:
        if id(kid) in partner:
            last = id(partner[id(kid)])
        else:
            behind.setdefault(last, []).append(kid)
    of = {id(a): b for a, b in matcher.match(slot, other)[1]}
    kids = list(behind.get(None, ()))
    for kid in slot.kids:
        kids.append(merge(kid, of[id(kid)], matcher) if id(kid) in of else kid)
        kids.extend(behind.get(id(kid), ()))
    return Slot(slot.label, kids, [*slot.nodes, *other.nodes], slot.pages + other.pages)


def fold(node: Node, depth: int = 0) -> Slot:
    """The tree of a page with every run of siblings of one label as one node."""
    kids: list[Slot] = []
    if depth < MAX_DEPTH:
        runs: list[list[Slot]] = []
        for kid in node.kids:
            if not isinstance(kid, str) and not kid.named:
                if runs and runs[-1][0].label == kid.label:
                    runs[-1].append(fold(kid, depth + 1))
                else:
                    runs.append([fold(kid, depth + 1)])
        kids = [_folded(run) for run in runs]
    return Slot(node.label, kids, [node])


def _folded(run: list[Slot]) -> Slot:
    """One node for a run of siblings: those of one shape at once, then the different shapes merged."""
    shapes: dict[int, list[Slot]] = {}
    for slot in run:
        shapes.setdefault(slot.shape, []).append(slot)
    same = [_together(slots) for slots in shapes.values()]
    found = same[0]
    for slot in same[1:]:
        found = merge(found, slot)
    return _on_pages(found, 1)


def _together(slots: list[Slot]) -> Slot:
    """Nodes of one shape as one, with all their page nodes."""
    if len(slots) == 1:
        return slots[0]
    kids = [_together(list(column)) for column in zip(*(slot.kids for slot in slots))]
    return Slot(slots[0].label, kids, [node for slot in slots for node in slot.nodes])


def _on_pages(slot: Slot, pages: int) -> Slot:
    waiting = [slot]
    while waiting:
        one = waiting.pop()
        one.pages = pages
        waiting.extend(one.kids)
    return slot


def packed(slot: Slot) -> list:
    return [slot.label, slot.pages, [packed(kid) for kid in slot.kids]]


def unpacked(value: list, times: int = 1) -> Slot:
    return Slot(value[0], [unpacked(kid, times) for kid in value[2]], (), value[1] * times)


def _slots(template: Slot) -> list[Slot]:
    """All slots in a fixed order, numbered by it."""
    found, waiting = [], [template]
    while waiting:
        slot = waiting.pop()
        slot.number = len(found)
        found.append(slot)
        waiting.extend(reversed(slot.kids))
    return found


def merged(templates: Iterable[Slot]) -> Slot:
    """One template for several trees; of more than ``MAX_SLOTS`` slots those on the fewest pages go."""
    found = None
    for tree in templates:
        found = tree if found is None else merge(found, tree)
        slots = _slots(found)
        if len(slots) > MAX_SLOTS:
            least = sorted((slot.pages for slot in slots), reverse=True)[MAX_SLOTS]
            found = _with_pages(found, least + 1)
    return found


def _with_pages(slot: Slot, least: int) -> Slot:
    return Slot(slot.label, [_with_pages(kid, least) for kid in slot.kids if kid.pages >= least], (), slot.pages)


class Template:
    """The slots of a host by number, and the alignments of the shapes of pages met last."""

    def __init__(self, root: Slot) -> None:
        self.root, self.known = root, {}
        _slots(root)

    def align(self, tree: Slot) -> Iterator[tuple[int, list[Node]]]:
        """The numbers of the slots that a folded page has, each with its nodes."""
        own, form, waiting = [], [], [tree]
        while waiting:
            slot = waiting.pop()
            own.append(slot)
            form.append((slot.label, len(slot.kids)))
            waiting.extend(reversed(slot.kids))
        key = tuple(form)  # labels and numbers of kids, parents first, tell a tree
        if key not in self.known:
            if len(self.known) >= KNOWN_FORMS:
                self.known.clear()
            matcher, numbers, waiting = Matcher(), {}, [(self.root, tree)]
            while waiting:
                slot, mine = waiting.pop()
                numbers[id(mine)] = slot.number
                waiting.extend(matcher.match(slot, mine)[1])
            self.known[key] = [(place, numbers[id(slot)]) for place, slot in enumerate(own) if id(slot) in numbers]
        return ((number, own[place].nodes) for place, number in self.known[key])


def text_key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def slot_texts(tree: Slot) -> dict[int, int]:
    """Length of every different text that a node of a folded page says itself."""
    found, waiting = {}, [tree]
    while waiting:
        slot = waiting.pop()
        waiting.extend(slot.kids)
        for node in slot.nodes:
            own = _own_text(node)
            if own:
                found[text_key(own)] = len(own)
    return found


def page_texts(html: str, template: Template, frequent: set[int]) -> Iterator[tuple[int, int | None, int | None, int]]:
    """(slot, text, content, characters) of a page, and (slot, None, content, 1) for each slot it has.

    The content is null if too little of the page is its own; ``frequent`` are the texts on many pages of the host.
    """
    texts: dict[tuple[int, int], int] = {}
    lengths: dict[int, int] = {}
    slots = []
    for number, nodes in template.align(fold(parse(html))):
        slots.append(number)
        for node in nodes:
            own = _own_text(node)
            if own:
                key = text_key(own)
                texts[number, key] = texts.get((number, key), 0) + len(own)
                lengths[key] = len(own)
    rare = sorted((key for key in lengths if key not in frequent), key=lambda key: (-lengths[key], key))
    if sum(lengths[key] for key in rare) < OWN_SHARE * sum(lengths.values()):
        rare = []
    first, second, *_ = *rare[:2], None, None
    for number in slots:
        yield number, None, first, 1
    for (number, key), chars in texts.items():
        yield number, key, second if key == first else first, chars


class Wrapper:
    """A template with what was counted: which texts of a slot are template, and how much of it varies on a page."""

    __slots__ = ("template", "constants", "weights")

    def __init__(self, template: Slot, constants: Iterable[tuple[int, int]], weights: dict[int, float]) -> None:
        self.template, self.weights = Template(template), weights
        self.constants: dict[int, set[int]] = {}
        for slot, text in constants:
            self.constants.setdefault(slot, set()).add(text)


def least_contents(of_slot: int, of_host: int) -> float:
    """On how many different contents a text must stand to be template."""
    return max(MIN_PAGES, SLOT_SHARE * of_slot, HOST_SHARE * of_host)


def frequent_on(pages: int) -> float:
    """On how many of a host's pages a text must stand to say nothing about a page's content."""
    return max(MIN_PAGES, HOST_SHARE * pages)


def induce(pages: Iterable[str]) -> Wrapper:
    """The wrapper of some pages of a host, without Spark."""
    pages = [page for page in pages if page]
    trees = [fold(parse(page)) for page in pages]
    known = Counter(key for tree in trees for key in slot_texts(tree))
    frequent = {key for key, number in known.items() if number >= frequent_on(len(pages))}
    template = Template(merged(trees))
    seen: dict[tuple, set] = {}
    sizes: Counter = Counter()
    for page in pages:
        for slot, text, content, chars in page_texts(page, template, frequent):
            seen.setdefault((slot, text), set()).update([] if content is None else [content])
            sizes[slot, text] += chars
    constants, chars, of_host = set(), Counter(), len(seen[0, None])
    for (slot, text), found in seen.items():
        if text is not None and len(found) >= least_contents(len(seen[slot, None]), of_host):
            constants.add((slot, text))
        elif text is not None and of_host >= MIN_PAGES:
            chars[slot] += sizes[slot, text]
    return Wrapper(template.root, constants, {slot: size / sizes[slot, None] for slot, size in chars.items()})


def _main(tree: Node, weights: dict[int, float]) -> Node | None:
    """The deepest container that holds nearly all varying text of a page, and every first heading with some."""
    mass: dict[int, float] = {}
    headings: dict[int, int] = {}
    for node in reversed([n for n in _walk(tree) if not n.named or n is tree]):
        own = weights.get(id(node), 0)
        kids = [id(k) for k in node.kids if not isinstance(k, str) and id(k) in mass]
        mass[id(node)] = own + sum(mass[k] for k in kids)
        headings[id(node)] = (node.tag == "h1" and mass[id(node)] > 0) + sum(headings[k] for k in kids)
    here, main, whole = tree, None, mass[id(tree)]
    while here is not None and whole and (main is None or main.tag not in ("article", "main")):
        here = next(
            (
                k
                for k in here.kids
                if not isinstance(k, str)
                and k.tag in CONTAINERS
                and mass.get(id(k), 0) >= MAIN_SHARE * whole
                and headings[id(k)] == headings[id(tree)]
            ),
            None,
        )
        main = here or main
    return main


def extract(html: str, wrapper: Wrapper | None) -> str:
    """The main text of a page."""
    if not html:
        return ""
    tree = parse(html)
    main, left_out = None, set()
    if wrapper:
        weights = {}
        for number, nodes in wrapper.template.align(fold(tree)):
            for node in nodes:
                weights[id(node)] = wrapper.weights.get(number, 0) / len(nodes)
            constants = wrapper.constants.get(number, ())
            left_out.update(id(node) for node in nodes if constants and text_key(_own_text(node)) in constants)
        main = _main(tree, weights)
    return text_of(main or _named_main(tree), left_out)


def _named_main(tree: Node) -> Node:
    """The first article, else the first main element, else the body, else all."""
    found: dict[str, Node] = {}
    waiting = [tree]
    while waiting:
        node = waiting.pop()
        found.setdefault(node.tag, node)
        waiting.extend(k for k in reversed(node.kids) if not isinstance(k, str) and not k.named)
    return next((found[tag] for tag in ("article", "main", "body") if tag in found), tree)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


class _Held(dict):
    """What a task has read for the hosts that it met last."""

    def of(self, host: str, read: Callable[[str], object], known: dict[str, str]) -> object:
        if host not in self:
            if len(self) >= 200:
                self.clear()
            self[host] = read(known[host])
        return self[host]


def _read_template(text: str) -> tuple[Template, set[int]]:
    template, frequent = json.loads(text)
    return Template(unpacked(template)), set(frequent)


def _read_wrapper(text: str) -> Wrapper:
    template, constants, weights = json.loads(text)
    return Wrapper(unpacked(template), map(tuple, constants), dict(map(tuple, weights)))


def _rows(counted: dict[tuple, int], names: list[str]) -> pd.DataFrame:
    """A row per key with its number. Whole numbers that may be null must not turn to floats on the way."""
    columns = list(zip(*((*key, number) for key, number in counted.items()))) or [()] * len(names)
    kinds = {"host": object, "tree": object}
    return pd.DataFrame({n: pd.Series(values, dtype=kinds.get(n, "Int64")) for n, values in zip(names, columns)})


def learned_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From all pages (host, html): different folded trees with their pages (host, tree, pages), and frequent texts (host, texts)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: Counter = Counter()
            for host, html in zip(batch["host"], batch["html"], strict=True):
                if html:
                    tree = fold(parse(html))
                    seen[host, json.dumps(packed(tree)), None] += 1
                    seen.update((host, None, key) for key in slot_texts(tree))
            yield _rows(seen, ["host", "tree", "text", "pages"])

    schema = "host string, tree string, text long, pages long"
    counted = store(
        pages.mapInPandas(read, schema).groupBy("host", "tree", "text").agg(F.sum("pages").alias("pages")), "page-parts"
    )
    trees = counted.filter("tree IS NOT NULL").select("host", "tree", "pages")
    limits = trees.groupBy("host").agg(F.greatest(F.lit(MIN_PAGES), HOST_SHARE * F.sum("pages")).alias("least"))
    often = counted.filter((F.col("tree").isNull()) & (F.col("pages") >= MIN_PAGES)).select("host", "text", "pages")
    # As each is on a share of the pages, a host has few of them, whatever its number of pages.
    frequent = dimension_join(often, limits, ["host"]).filter("pages >= least")
    return trees, frequent.groupBy("host").agg(F.sort_array(F.collect_list("text")).alias("texts"))


def templates(trees: DataFrame) -> DataFrame:
    """One template per host: host, tree, pages."""

    def together(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(["pages", "tree"], ascending=[False, True])
        trees = ((json.loads(tree), pages) for tree, pages in zip(ordered["tree"], ordered["pages"].tolist()))
        # A tree that was counted but not merged yet stands for one page.
        found = merged(unpacked(tree, pages // tree[1]) for tree, pages in trees)
        row = {"host": group["host"].iloc[0], "tree": json.dumps(packed(found)), "pages": int(group["pages"].sum())}
        return pd.DataFrame([row])

    held = trees
    while True:
        groups = held.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / FAN).alias("groups"), F.count(F.lit(1)).alias("rows"))
        most = groups.agg(F.max("rows")).first()[0] or 0
        if most <= 1:
            return held
        dealt = dimension_join(held, groups.select("host", "groups"), ["host"])
        salt = F.pmod(F.xxhash64("tree"), F.col("groups")).alias("salt")
        one = dealt.select("host", salt, "tree", "pages").groupBy("host", "salt")
        before, held = held, store(one.applyInPandas(together, "host string, tree string, pages long"), "page-trees")
        if before is not trees:
            discard(before)


def _page_by_page(pages: DataFrame, known: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work(pages, known)`` over batches of pages, with what is known of their hosts (host, known) by host.

    Up to ``BROADCAST_BYTES`` (measured) all that is known is broadcast; beyond, parts of a host's pages meet it in a
    shuffle, so that it travels once a part and not once a page.
    """
    size = known.agg(F.sum(F.octet_length("known") + F.octet_length("host"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        shared = pages.sparkSession.sparkContext.broadcast({row["host"]: row["known"] for row in known.collect()})

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = _Held()
            for batch in batches:
                yield work(batch, held, shared.value)

        return pages.mapInPandas(run, schema)

    parts = pages.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / PART_PAGES).alias("parts"))
    salted = dimension_join(pages, parts, ["host"]).withColumn("part", F.pmod(F.xxhash64(*pages.columns), "parts"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    # Both sides come from one table; new aliases keep their columns apart.
    dealt = parts.join(known, "host").select(F.col("host").alias("host"), F.col("known").alias("known"), every)

    def meet(batch: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        return work(batch, _Held(), dict(zip(own["host"], own["known"])))

    return salted.groupBy("host", "part").cogroup(dealt.groupBy("host", "part")).applyInPandas(meet, schema)


def wrappers(pages: DataFrame) -> DataFrame:
    """One wrapper per host from all its pages; pages: id, host, html."""
    trees, frequent = learned_pages(pages)
    often = F.coalesce(F.col("texts"), F.array().cast("array<long>"))
    listing = F.concat(F.lit("["), "tree", F.lit(", "), F.to_json(often), F.lit("]")).alias("known")
    known = store(templates(trees).join(frequent, "host", "left").select("host", "tree", listing), "templates")

    def texts(batch: pd.DataFrame, held: _Held, of_hosts: dict[str, str]) -> pd.DataFrame:
        seen: dict[tuple, int] = {}
        for host, html in zip(batch["host"], batch["html"], strict=True):
            for slot, text, content, chars in page_texts(html, *held.of(host, _read_template, of_hosts)):
                key = host, slot, text, content
                seen[key] = seen.get(key, 0) + chars
        return _rows(seen, ["host", "slot", "text", "content", "chars"])

    def listed(group: pd.DataFrame) -> pd.DataFrame:
        constants = group[group["text"].notna()]
        weights = group[group["text"].isna()]
        value = [
            json.loads(group["tree"].iloc[0]),
            sorted(zip(constants["slot"].tolist(), map(int, constants["text"].tolist()))),
            sorted(zip(weights["slot"].tolist(), weights["weight"].tolist())),
        ]
        return pd.DataFrame({"host": [group["host"].iloc[0]], "known": [json.dumps(value)]})

    each = _page_by_page(
        pages.filter("html <> ''"),
        known.select("host", "known"),
        texts,
        "host string, slot int, text long, content long, chars long",
    )
    contents = each.groupBy("host", "slot", "text", "content").agg(F.sum("chars").alias("chars"))
    counted = store(
        contents.groupBy("host", "slot", "text").agg(F.count("content").alias("contents"), F.sum("chars").alias("chars")),
        "slot-texts",
    )
    of_slot = counted.filter("text IS NULL").select("host", "slot", F.col("contents").alias("of_slot"), F.col("chars").alias("pages"))
    of_host = of_slot.filter("slot = 0").select("host", F.col("of_slot").alias("of_host"))
    # At most a row per slot of a template.
    least = F.greatest(F.lit(MIN_PAGES), SLOT_SHARE * F.col("of_slot"), HOST_SHARE * F.col("of_host"))
    slots = store(of_slot.join(of_host, "host").withColumn("least", least), "slots")
    frequent = counted.filter(F.col("text").isNotNull() & (F.col("contents") >= MIN_PAGES))
    # A slot has at most one constant for each text of half its pages, whatever the number of pages.
    constants = store(
        dimension_join(frequent, slots, ["host", "slot"]).filter("contents >= least").select("host", "slot", "text", "chars"),
        "constants",
    )
    sums = counted.filter("text IS NOT NULL").select("host", "slot", "chars").unionAll(
        constants.select("host", "slot", -F.col("chars"))
    )
    varying = sums.groupBy("host", "slot").agg(F.sum("chars").alias("chars")).join(slots, ["host", "slot"])
    weights = varying.filter(F.col("of_host") >= MIN_PAGES).select(
        "host", "slot", F.lit(None).cast("long").alias("text"), (F.col("chars") / F.col("pages")).alias("weight")
    )
    rows = weights.unionAll(constants.select("host", "slot", "text", F.lit(0.0)))
    root = known.select("host", F.lit(0), F.lit(None).cast("long"), F.lit(0.0))  # each host has a wrapper
    listing = rows.unionAll(root).withColumn("text", F.col("text").cast("string"))  # a nullable long would turn to a float
    found = listing.join(known.select("host", "tree"), "host").groupBy("host")
    learned = store(found.applyInPandas(listed, "host string, known string"), "wrappers")
    discard(counted, slots, constants)
    return learned


def main_texts(documents: DataFrame, *, identifier: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``id``, ``url`` and ``text`` of every page."""
    pages = documents.select(
        F.col(identifier).cast("long").alias("id"),
        F.col(url).alias("url"),
        host_of(F.col(url)).alias("host"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    )
    known = wrappers(pages.select("id", "host", "html"))

    def read(batch: pd.DataFrame, held: _Held, of_hosts: dict[str, str]) -> pd.DataFrame:
        found = zip(batch["host"], batch["html"], strict=True)
        texts = [extract(html, held.of(host, _read_wrapper, of_hosts)) for host, html in found]
        return pd.DataFrame({"id": batch["id"], "url": batch["url"], "text": texts})

    filled = pages.filter("html <> ''").select("id", "url", "host", "html")
    empty = pages.filter("html = ''").select("id", "url", F.lit("").alias("text"))
    return _page_by_page(filled, known, read, "id long, url string, text string").unionAll(empty)
