"""Main-text extraction by wrapper induction.

Pages of one host are aligned by simple tree matching. A wrapper is a tree of
slots: like-named neighbours share one slot, and a slot keeps on how many pages
it stands and its commonest texts. Across pages the tag decides, names only count
as a preference where the rest agrees. Tasks build partial wrappers of the pages they
scan; partial wrappers of a host are small and merge by the same matching, in two
steps, so a host with a third of all pages is no hot group. Slots whose text is
the same on nearly all pages are template, varying ones can be content.

Each page then meets its host's wrapper (a join salted by page), is aligned with
it, and the text of its main part comes out block by block: without template
slots, elements that are no article by their kind or name, and link lists.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import salt

#: A slot is template if it stands on this share of the host's pages, with one text on this share of those ...
TEMPLATE_PAGES, TEMPLATE_TEXT = 0.5, 0.9
#: ... and the host has at least so many different pages. On fewer it is if it has one text on all of them, while others vary.
MIN_PAGES = 8
#: A single node beside varying neighbours of its label, which may be a line that articles share, is template by the same shares on so many.
MIN_PAGES_NODE = 16
#: A page of such a host stays whole if less than this share of its text would.
LEAST_LEFT = 0.1
#: Texts counted per slot (the rest cancel out, as in Misra and Gries), page digests kept to tell pages apart.
TEXTS_A_SLOT, DIGESTS = 8, 32
#: A wrapper beyond so many slots forgets those on less than a tenth of its pages.
MAX_SLOTS = 3_000
#: Hosts whose wrappers a task holds before it passes them on.
HOSTS_A_TASK = 2_000
#: The wrapper's slots go so deep (text is read at any depth); sibling lists longer than this are matched in one pass, in order.
MAX_DEPTH, MAX_TABLE = 120, 40_000
#: Own texts of single nodes counted per slot; beyond it those on less than half of its pages are forgotten.
NODE_TEXTS = 256
#: Pieces that a host's pages are dealt into for the join.
PIECES = 32

#: Elements whose content is no markup.
RAW = frozenset("script style textarea title noscript template iframe svg xmp noembed noframes".split())
TAG_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
TAG_MARK = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img label".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
NO_TEXT = frozenset("head script style noscript template iframe svg object canvas video audio nav footer aside form button select textarea input menu dialog title datalist".split())
NO_ROLE = frozenset("navigation contentinfo complementary search alert alertdialog dialog menu menubar form status".split())
#: Words in a class or id that name something other than an article.
NO_NAME = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer cookie cookies consent notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended comment comments disqus reply replies respond discussion pagination pager toolbar search masthead topbar copyright "
    "adbox adslot adsense adunit sidenav sidemenu topnav mainnav subnav cookiebar cookiebanner gdpr commentlist usercomments".split())
#: Of these, the ones that make even an article's element something else.
NO_ARTICLE_NAME = frozenset("ad ads advert promo sponsored related recommended comment comments reply replies".split())
#: Within an article, a class of one of these words, and of these beside it, is an advert or a comment list.
UNMISTAKABLE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored adbox adslot adsense adunit comment comments commentlist usercomments disqus reply replies".split())
#: Of these, on containers of an article, newsletter forms and consent notices; and the words beside comments there.
SIGN_UP = frozenset("newsletter subscribe subscription signup cookie cookies consent gdpr".split())
BESIDE_COMMENTS = frozenset("post entry article page site blog respond".split())
#: Ids of an article's containers that say comments or a form, as a whole.
PURPOSE_IDS = frozenset("comments comment-list commentlist comment-section comments-section user-comments respond disqus-thread disqus replies newsletter newsletter-signup "
                        "newsletter-form subscribe-form cookie-notice cookie-banner".split())
CONTAINERS = frozenset("div section ul ol dl table details fieldset article".split())
BESIDE = frozenset("slot box unit container wrapper wrap area block list section thread inline top bottom middle left right small large google user reader item body form".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that stand once on a page, whatever their names.
ONCE = frozenset(("html", "head", "body", "main"))
DIGITS = re.compile(r"\d+")
NAME_PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("tag", "names", "classes", "ids", "role", "hidden", "children", "chars", "linked")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.names, self.classes, self.ids, self.role, self.hidden, self.children = tag, "", "", "", "", False, []
        self.chars = self.linked = 0  # of the text in it, and of what of that is in links
        if attributes and attributes != "/":
            for name, a, b, c in ATTRIBUTE.findall(attributes):
                value, name = (a or b or c).strip().lower() if name.lower() not in ("class", "id") else (a or b or c).strip(), name.lower()
                if name in ("class", "id"):
                    self.names = f"{self.names} {value}".strip()
                    if name == "class":
                        self.classes = f"{self.classes} {value}".strip()
                    else:
                        self.ids = f"{self.ids} {value}".strip()
                elif name == "role":
                    self.role = value
                elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
                    self.hidden = True

    def no_article(self, within: bool) -> bool:
        """Whether it is something other than an article by its kind or name; ``within``: inside an article's element.

        No heading is, by its name. An article's id counts if it is one word. Within an article only those classes count
        that say adverts, comments or sign-up forms and nothing else, or any on lists of links; and on containers the
        ids that say comments or a form as a whole.
        """
        if self.tag in NO_TEXT or self.hidden or self.role in NO_ROLE:
            return True
        if not within and (self.tag == "header" or self.role == "banner"):
            return True
        if not self.names or self.tag in ("html", "body", "main") or self.tag in HEADINGS:
            return False
        if within and self.tag in CONTAINERS and not PURPOSE_IDS.isdisjoint(self.ids.lower().replace("_", "-").split()):
            return True
        if self.tag == "article":
            words = words_of(self.classes)
            slug = words_of(self.ids)
            return not (words | slug if len(slug) == 1 else words).isdisjoint(NO_ARTICLE_NAME)
        if within:
            for token in self.classes.split():
                words = words_of(token)
                if not words.isdisjoint(UNMISTAKABLE) and words <= UNMISTAKABLE | BESIDE:
                    return True
                if self.tag in CONTAINERS and not words.isdisjoint(UNMISTAKABLE | SIGN_UP) and words <= UNMISTAKABLE | SIGN_UP | BESIDE | BESIDE_COMMENTS:
                    return True
            return not words_of(self.classes).isdisjoint(NO_NAME) and mostly_links(self)
        words = words_of(self.names)
        return not words.isdisjoint(NO_NAME) or "header" in words


def words_of(names: str) -> set[str]:
    return {w.lower() for w in NAME_PART.findall(names)}


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """The page's parts in order, in one pass: ("text", text, ""), ("open", tag, attributes), ("close", tag, ""), ("raw", tag, "").

    Comments, declarations and processing instructions are left out. A ``<`` that no ``>`` follows is text. Quotes hide a
    ``>`` as long as they are balanced; from the first tag on that has no end for them, they don't.
    """
    at, start, last, quotes, size = 0, 0, page.rfind(">"), True, len(page)
    while True:
        lt = page.find("<", at)
        if lt < 0:
            break
        ahead = page[lt + 1:lt + 2]
        if ahead in ("!", "?") and ahead:
            mark = next((m for begin, m in (("<!--", "-->"), ("<![CDATA[", "]]>")) if page.startswith(begin, lt)), ">")
            end = page.find(mark, lt + (4 if mark == "-->" else 2))
            if start < lt:
                yield "text", page[start:lt], ""
            at = start = size if end < 0 else end + len(mark)
            continue
        if lt > last:
            at = lt + 1
            if page.find("<!", at) < 0 and page.find("<?", at) < 0:
                break
            continue
        closing = ahead == "/"
        name = TAG_NAME.match(page, lt + 1 + closing)
        if name is None:
            at = lt + 1
            continue
        end = -1
        if quotes and not closing:
            mark = TAG_MARK.search(page, name.end())
            while mark is not None and mark[0] != ">":
                shut = page.find(mark[0], mark.end())
                mark = TAG_MARK.search(page, shut + 1) if shut >= 0 else None
            quotes, end = mark is not None, mark.start() if mark is not None else -1
        if end < 0:
            end = page.find(">", name.end())
        if start < lt:
            yield "text", page[start:lt], ""
        at = start = end + 1
        tag, attributes = name[0].lower(), page[name.end():end]
        if closing:
            yield "close", tag, ""
        elif tag in RAW and not (tag == "svg" and attributes.endswith("/")):
            yield "raw", tag, ""
            shut = _raw_end(tag).search(page, at)
            end = -1 if shut is None else page.find(">", shut.end())
            at = start = size if end < 0 else end + 1
        else:
            yield "open", tag, attributes
    if start < size:
        yield "text", page[start:], ""


@lru_cache(None)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(f"</{tag}(?=[\\s/>])", re.I)


def parse(page: str) -> Node:
    """Tree of elements and texts (strings, character references decoded later); any input gives one, of any depth, in one pass."""
    root = Node("#page")
    stack, open_tags = [root], Counter()

    def pop(to: int) -> None:
        for node in stack[to:]:
            open_tags[node.tag] -= 1
        del stack[to:]

    for kind, tag, attributes in tokens(page):
        if kind == "text":
            stack[-1].children.append(tag)
        elif kind == "raw":
            stack[-1].children.append(Node(tag))
        elif kind == "close":
            if open_tags[tag]:
                pop(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            elif tag == "p":
                stack[-1].children.append(Node("p"))
        else:
            if tag in CLOSES_P and open_tags["p"]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == "p":
                        pop(i)
                        break
                    if stack[i].tag not in INLINE:
                        break
            elif tag in SIBLINGS and any(open_tags[t] for t in SIBLINGS[tag]):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in SIBLINGS[tag]:
                        pop(i)
                        break
                    if stack[i].tag in ("ul", "ol", "dl", "table", "select"):
                        break
            node = Node(tag, attributes)
            stack[-1].children.append(node)
            if tag not in VOID and not (attributes.endswith("/") and tag not in INLINE and tag not in CLOSES_P):
                stack.append(node)
                open_tags[tag] += 1
    _count(root)
    return root


def _count(root: Node) -> None:
    """Characters of text, and of linked text, in every element, from the leaves up."""
    order, left = [], [root]
    while left:
        node = left.pop()
        order.append(node)
        left += [c for c in node.children if isinstance(c, Node)]
    for node in reversed(order):
        for c in node.children:
            if isinstance(c, str):
                node.chars += len(c.strip())
            else:
                node.chars, node.linked = node.chars + c.chars, node.linked + c.linked
        if node.tag == "a":
            node.linked = node.chars


def text_key(text: str) -> str:
    return hashlib.blake2b(text.encode(), digest_size=8).hexdigest()


class Slot:
    """A node of a page's slot tree or of a wrapper: label, pages it stands on, counted texts, children.

    ``texts`` counts the pages by all own text of the slot, ``parts`` by the own text of each of its nodes, where it has several.
    """

    __slots__ = ("label", "pages", "texts", "parts", "children", "own", "nodes")

    def __init__(self, label: str, pages: int = 1):
        self.label, self.pages, self.texts, self.parts, self.children, self.own, self.nodes = label, pages, {}, {}, [], [], []

    def packed(self) -> list:
        often = {k: n for k, n in self.parts.items() if 2 * n >= self.pages}
        return [self.label, self.pages, self.texts, often, [c.packed() for c in self.children]]

    @classmethod
    def unpacked(cls, data: list) -> Slot:
        slot = cls(data[0], data[1])
        slot.texts, slot.parts, slot.children = data[2], data[3], [cls.unpacked(c) for c in data[4]]
        return slot

    def size(self) -> int:
        return 1 + sum(c.size() for c in self.children)

    def prune(self, least: float) -> None:
        self.children = [c for c in self.children if c.pages >= least]
        for c in self.children:
            c.prune(least)


def slots_of(root: Node) -> Slot:
    """The slot tree of one page; neighbours of one label share a slot. Each slot knows its nodes and own texts."""
    top = Slot("#page")
    _fill(top, root)
    _settle(top)
    return top


def _fill(slot: Slot, node: Node, depth: int = 0) -> None:
    slot.nodes.append(node)
    place = 0
    for child in node.children:
        if isinstance(child, str):
            if not child.isspace():
                slot.own.append(child)
            continue
        if depth == MAX_DEPTH:
            continue
        label = f"{child.tag} {child.names.lower()}" if child.names else child.tag
        # the next slot of this label, from the place where the last child of this node went
        for i in range(max(place - 1, 0), len(slot.children)):
            if slot.children[i].label == label:
                place = i + 1
                break
        else:
            slot.children.insert(place, Slot(label))
            place += 1
        _fill(slot.children[place - 1], child, depth + 1)


def _own_key(node: Node) -> str | None:
    """Key of a node's own text (what stands right in it); None without any."""
    own = " ".join(" ".join(c for c in node.children if isinstance(c, str)).split())
    return text_key(own) if own else None


def _settle(slot: Slot) -> None:
    own = " ".join(" ".join(slot.own).split())
    slot.texts = {text_key(own): 1} if own else {}
    if own and len(slot.nodes) > 1:
        slot.parts = {k: 1 for k in map(_own_key, slot.nodes) if k}
    for c in slot.children:
        _settle(c)


def tag_of(label: str) -> str:
    return label.partition(" ")[0]


@lru_cache(1 << 16)
def numberless(label: str) -> str:
    return DIGITS.sub("0", label)


def matching(a: Slot, b: Slot, memo: dict) -> float:
    """Simple tree matching: the size of the largest order-keeping match of two trees with one root label.

    Elements of one tag but other names match at half their size, if they stand once on a page, their names
    differ by numbers only, they share a text, or half of what is below them matches.
    """
    same = a.label == b.label
    if not same and tag_of(a.label) != tag_of(b.label):
        return 0
    key = (id(a), id(b))
    if key not in memo:
        below = _table(a.children, b.children, memo)[-1][-1] if a.children and b.children and len(a.children) * len(b.children) <= MAX_TABLE else 0
        if same:
            memo[key] = 1 + below
        else:
            alike = (tag_of(a.label) in ONCE or numberless(a.label) == numberless(b.label) or not a.texts.keys().isdisjoint(b.texts)
                     or (below > 0 and 2 * below >= max(len(a.children), len(b.children))))
            memo[key] = (1 + below) / 2 if alike else 0
    return memo[key]


def _table(xs: list[Slot], ys: list[Slot], memo: dict) -> list[list[float]]:
    rows = [[0] * (len(ys) + 1)]
    for x in xs:
        above, row = rows[-1], [0]
        for j, y in enumerate(ys):
            best = max(above[j + 1], row[j])
            match = matching(x, y, memo)
            if match:
                best = max(best, above[j] + match)
            row.append(best)
        rows.append(row)
    return rows


def aligned(a: Slot, b: Slot, memo: dict) -> list[tuple[int, int]]:
    """Matched children of two matched slots, as places in order."""
    xs, ys = a.children, b.children
    if len(xs) == len(ys) and all(x.label == y.label for x, y in zip(xs, ys, strict=True)):
        return [(i, i) for i in range(len(xs))]
    if len(xs) * len(ys) > MAX_TABLE:
        pairs, j = [], 0
        places: dict[str, list[int]] = {}
        for k, y in enumerate(ys):
            places.setdefault(numberless(y.label), []).append(k)
        for i, x in enumerate(xs):
            later = next((k for k in places.get(numberless(x.label), ()) if k >= j), None)
            if later is not None:
                pairs.append((i, later))
                j = later + 1
        return pairs
    rows, pairs, i, j = _table(xs, ys, memo), [], len(xs), len(ys)
    while i and j:
        if rows[i][j] == rows[i - 1][j]:
            i -= 1
        elif rows[i][j] == rows[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j))
    return pairs[::-1]


def merge(into: Slot, other: Slot, memo: dict | None = None) -> None:
    """Enter the pages of ``other`` in the wrapper ``into``; slots without a partner come in at their place."""
    memo = {} if memo is None else memo
    pairs = aligned(into, other, memo)
    into.pages += other.pages
    texts = dict(into.texts)
    for k, n in other.texts.items():
        texts[k] = texts.get(k, 0) + n
    if len(texts) > TEXTS_A_SLOT:
        cut = sorted(texts.values(), reverse=True)[TEXTS_A_SLOT]
        texts = {k: n - cut for k, n in texts.items() if n > cut}
    into.texts = texts
    for k, n in (other.parts or ({k: n for k, n in other.texts.items()} if into.parts else {})).items():
        into.parts[k] = into.parts.get(k, 0) + n
    if len(into.parts) > NODE_TEXTS:
        into.parts = {k: n for k, n in into.parts.items() if 2 * n >= into.pages}
    if len(pairs) == len(other.children):
        for i, j in pairs:
            merge(into.children[i], other.children[j], memo)
        return
    children, at = [], 0
    partner = {j: i for i, j in pairs}
    for j, y in enumerate(other.children):
        i = partner.get(j)
        if i is None:
            y.own, y.nodes = [], []
            children.append(y)
            continue
        children += into.children[at:i + 1]
        at = i + 1
        merge(into.children[i], y, memo)
    into.children = children + into.children[at:]


class Wrapper:
    """Slots of a host's pages and the smallest digests of its different pages."""

    def __init__(self, slots: Slot, digests: list[str]):
        self.slots, self.digests = slots, digests

    def add(self, other: Wrapper) -> None:
        merge(self.slots, other.slots)
        self.digests = sorted({*self.digests, *other.digests})[:DIGESTS]
        if self.slots.size() > MAX_SLOTS:
            self.slots.prune(self.slots.pages / 10)

    def dump(self) -> str:
        return json.dumps([self.slots.packed(), self.digests])

    @classmethod
    def load(cls, data: str) -> Wrapper:
        slots, digests = json.loads(data)
        return cls(Slot.unpacked(slots), digests)

    def template(self, page: Slot) -> set[int]:
        """ids of the page's nodes whose own text is template."""
        found: set[int] = set()
        if len(self.digests) >= MIN_PAGES or (self.few() and self._varies(self.slots)):
            self._template(self.slots, page, found, {})
        return found

    def few(self) -> bool:
        return 1 < len(self.digests) < MIN_PAGES

    def _varies(self, slot: Slot) -> bool:
        return len(slot.texts) > 1 or any(map(self._varies, slot.children))

    def _template(self, slot: Slot, page: Slot, found: set[int], memo: dict) -> None:
        pages_share, text_share = (1, 1) if self.few() else (TEMPLATE_PAGES, TEMPLATE_TEXT)
        if page.texts and slot.pages >= pages_share * self.slots.pages:
            (key,) = page.texts
            if slot.texts.get(key, 0) >= text_share * slot.pages:
                found.update(map(id, page.nodes))
            elif slot.parts and len(self.digests) >= MIN_PAGES_NODE:  # single nodes beside varying ones
                found.update(id(node) for node in page.nodes if slot.parts.get(_own_key(node), 0) >= text_share * slot.pages)
        for i, j in aligned(slot, page, memo):
            self._template(slot.children[i], page.children[j], found, memo)


def main_parts(root: Node) -> list[Node]:
    """The outermost article or main elements that are not within something else; the page itself if there is none."""
    found, left = [], [root]
    while left:
        node = left.pop()
        if node is not root and (node.tag in ("article", "main") or node.role in ("main", "article")):
            found.append(node)
            continue
        left += [c for c in reversed(node.children) if isinstance(c, Node) and not c.no_article(False)]
    return found or [root]


def mostly_links(node: Node) -> bool:
    return node.linked > 0.6 * node.chars


def blocks(root: Node, template: set[int]) -> list[str]:
    """Texts of the main part's blocks in page order."""
    out: list[str] = []
    inline: list[str] = []

    def flush() -> None:
        if inline:
            text = " ".join(entities.unescape("".join(inline)).split())
            inline.clear()
            if text:
                out.append(text)

    for part in main_parts(root):
        # (children to come, whether the node's own text is template, within an article, ends a block)
        left = [(iter(part.children), id(part) in template, part is not root, True)]
        while left:
            children, constant, within, ends = left[-1]
            c = next(children, None)
            if c is None:
                left.pop()
                if ends:
                    flush()
            elif isinstance(c, str):
                if not constant:
                    inline.append(c)
            elif c.tag in ("br", "wbr"):
                if c.tag == "br":
                    inline.append(" ")
            elif c.no_article(within) or (c.tag in ("ul", "ol", "table") and not within and mostly_links(c)):
                continue
            elif c.tag in INLINE:
                left.append((iter(c.children), id(c) in template, within, False))
            else:
                flush()
                left.append((iter(c.children), id(c) in template, within or c.tag in ("article", "main"), True))
    return out


def main_text(page: str, wrapper: Wrapper | None) -> str:
    root = parse(page)
    template = wrapper.template(slots_of(root)) if wrapper else set()
    text = "\n\n".join(blocks(root, template))
    if template and wrapper.few():  # copies of one page that differ in a date or a counter
        whole = "\n\n".join(blocks(root, set()))
        return text if len(text) >= LEAST_LEFT * len(whole) else whole
    return text


def host(url_col: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def induce(pages: DataFrame) -> DataFrame:
    """host, wrapper of every host, from all its pages (columns url, html)."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Wrapper] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"host": list(held), "wrapper": [w.dump() for w in held.values()]}, pa.schema([("host", pa.string()), ("wrapper", pa.string())]))

        for batch in batches:
            for name, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                page = page.as_py() or ""
                new = Wrapper(slots_of(parse(page)), [text_key(page)])
                if name in held:
                    held[name].add(new)
                else:
                    held[name] = Wrapper.load(new.dump())  # without the page's nodes
                if len(held) > HOSTS_A_TASK:
                    yield out()
                    held = {}
        if held:
            yield out()

    def merged(group: pa.Table) -> pa.Table:
        first, *rest = sorted(group["wrapper"].to_pylist())
        whole = Wrapper.load(first)
        for w in rest:
            whole.add(Wrapper.load(w))
        return pa.table({"host": group["host"][:1], "piece": pa.array([0], pa.int32()), "wrapper": [whole.dump()]})

    kinds = "host string, piece int, wrapper string"
    parts = pages.select(host().alias("host"), "html").filter("host <> ''").mapInArrow(partial, "host string, wrapper string")
    parts = parts.withColumn("piece", salt("wrapper"))
    return parts.groupBy("host", "piece").applyInArrow(merged, kinds).groupBy("host").applyInArrow(merged, kinds).select("host", "wrapper")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page: the main text of the whole html, one row per input row.

    Blocks are joined by an empty line; white space in a block is one space. Null or empty html, or a page
    without an article, gives the empty text. Pages whose url has no host are read without a wrapper, and
    a host with one page, or copies of one, shows no template. On hosts with fewer than ``MIN_PAGES`` different
    pages a text is template if it stands on all of them. Only page_id, url and html are read.
    """
    wrappers = induce(pages).checkpoint()
    dealt = wrappers.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(PIECES - 1)))).withColumnRenamed("host", "of").withColumnRenamed("piece", "share")
    keyed = pages.select("page_id", "url", "html", host().alias("host")).withColumn("piece", salt(F.struct("page_id", "url"), PIECES))
    joined = keyed.join(dealt.hint("shuffle_hash"), (F.col("host") == F.col("of")) & (F.col("piece") == F.col("share")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Wrapper] = {}
        for batch in batches:
            texts = []
            for name, page, dumped in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4), strict=True):
                if dumped.is_valid and name not in known:
                    if len(known) >= HOSTS_A_TASK:
                        known = {}
                    known[name] = Wrapper.load(dumped.as_py())
                texts.append(main_text(page.as_py() or "", known.get(name) if dumped.is_valid else None))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return joined.select("page_id", "url", "host", "html", "wrapper").mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
