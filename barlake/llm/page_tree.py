"""One page as a tree: forgiving parsing, text blocks with their branches, style and content features."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import xxhash

#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
#: Elements that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
_IN_HEAD = frozenset("base link meta noscript script style template title".split())
#: Which open elements a start tag ends, and which stop the search for them.
_ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table", "thead", "tbody", "tfoot")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "option": (("option",), ("select", "optgroup")),
    "optgroup": (("optgroup", "option"), ("select",)),
}
_NO_PARAGRAPH_END = frozenset("body caption col colgroup head html legend option optgroup select tbody td tfoot th thead tr dt dd li summary".split())

#: Elements that say themselves that they are not the article, and what is never shown.
NOISE_TAGS = frozenset("nav footer aside menu dialog search button select label option textarea template svg canvas object audio video head".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
#: Beginnings of words in class and id that name surroundings.
NOISE_WORDS = tuple(
    "advert adsense sponsor promo sidebar breadcrumb cookie consent gdpr newsletter subscri signup navbar navigation menubar commentlist "
    "disqus footer recommend popup pagin toolbar masthead teaser outbrain taboola".split()
)
#: Whole words of the same kind.
NOISE_EXACT = frozenset("ad ads pager copyright login nav menu comment comments share sharing related modal skip".split())
#: Words that name surroundings unless the article is named too.
WEAK_WORDS = frozenset("header banner notice notices alert side widget search social legal disclaimer form".split())
ARTICLE_WORDS = frozenset("article post entry content story main body text title headline".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>")
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
_CAMEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Running numbers in names are no differences.
_DIGITS = re.compile(r"\d{3,}")
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}


def _hash(text: str, seed: int = 0) -> int:
    """A signed 64-bit hash."""
    h = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed & 0xFFFFFFFFFFFFFFFF)
    return h - (1 << 64) if h >> 63 else h


@dataclass
class Node:
    tag: str
    up: Node | None
    id: int
    noise: bool
    weak_noise: bool  # by class, id or as a form: not if it holds the whole article
    marked: bool  # has a class or an id
    children: list[int] = field(default_factory=list)

    def path(self) -> list[Node]:
        """The node and those above it, lowest first."""
        out, node = [], self
        while node is not None:
            out.append(node)
            node = node.up
        return out


@dataclass
class Page:
    blocks: list[tuple[str, Node]]
    nodes: list[Node]
    content: list[tuple[int, int]]  # (node, feature) of texts, links and images
    root: int  # the id above all nodes


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(raw)}


def _named_noise(names: str) -> bool:
    words = [w.lower() for w in _CAMEL.findall(names)]
    if any(w in NOISE_EXACT or w.startswith(NOISE_WORDS) for w in words):
        return True
    return any(w in WEAK_WORDS for w in words) and not any(w in ARTICLE_WORDS for w in words)


class _Builder:
    def __init__(self, host: str):
        self.root = Node("", None, _hash(host), False, False, False)
        self.top, self.open, self.depth = self.root, Counter(), 0
        self.page = Page([], [], [], self.root.id)
        self.text: list[str] = []

    def flush(self) -> None:
        if self.text:
            words = "".join(self.text).split()
            self.text = []
            if words:
                text = " ".join(words)
                self.page.blocks.append((text, self.top))
                self.page.content.append((self.top.id, _hash(text)))

    def add(self, text: str) -> None:
        if self.top.tag == "head" and not text.isspace():
            self.pop()
        self.text.append(html.unescape(text) if "&" in text else text)

    def pop(self) -> None:
        if self.top.tag in BLOCK:
            self.flush()
        self.open[self.top.tag] -= 1
        self.top = self.top.up

    def pop_to(self, tag: str) -> None:
        while self.top.tag != tag:
            self.pop()
        self.pop()

    def end_implied(self, tag: str) -> None:
        names, stops = _ENDS[tag]
        if not any(self.open[n] for n in names):
            return
        node = self.top
        while node is not self.root and node.tag not in stops:
            if node.tag in names:
                while True:
                    last = self.top is node
                    self.pop()
                    if last:
                        break
                node = self.top
            else:
                node = node.up

    def start(self, tag: str, raw: str) -> None:
        if self.top.tag == "head" and tag not in _IN_HEAD:
            self.pop()
        if tag in ("html", "body", "head") and (self.open[tag] or (tag == "head" and self.open["body"])):
            return
        if tag in _ENDS:
            self.end_implied(tag)
        if tag in BLOCK:
            if self.open["p"] and tag not in _NO_PARAGRAPH_END:
                self.pop_to("p")
            self.flush()
        attributes = _attributes(raw) if "=" in raw or "hidden" in raw.lower() else {}
        for name in ("href", "src"):
            if attributes.get(name):
                self.page.content.append((self.top.id, _hash(f"{name}={attributes[name]}")))
        if tag in VOID:
            if tag == "br":
                self.text.append("\n")
            return
        names = f"{attributes.get('class', '')} {attributes.get('id', '')}".strip()
        hidden = (
            "hidden" in attributes
            or attributes.get("aria-hidden") == "true"
            or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I) is not None
        )
        noise = tag in NOISE_TAGS or hidden or attributes.get("role", "").lower() in NOISE_ROLES
        named = bool(names) and tag not in ("html", "body", "main", "article") and _named_noise(names)
        if tag == "header" and not (self.open["article"] or self.open["main"]):
            noise = True
        if tag in BLOCK or names or noise:
            label = f"{tag} {_DIGITS.sub('0', ' '.join(sorted(names.split())))}"
            node = Node(tag, self.top, _hash(label, self.top.id), noise, named or tag == "form", bool(names))
            self.top.children.append(node.id)
            self.page.nodes.append(node)
        else:
            # plain inline markup belongs to the node around it
            node = Node(tag, self.top, self.top.id, False, False, False)
        self.open[tag] += 1
        self.top = node

    def end(self, tag: str) -> None:
        if not self.open[tag] or tag in ("html", "body"):
            return
        if tag not in BLOCK:
            # inline markup that a block has been opened in stays without effect
            node = self.top
            while node.tag != tag:
                if node.tag in BLOCK:
                    return
                node = node.up
        self.pop_to(tag)


def parse(source: str | None, host: str) -> Page:
    """The tree of a page; node ids are hashes of the host and the labels (tag, class, id) from the root on.

    Nothing fails: unknown, unclosed and misnested tags are read as browsers do
    as far as text is concerned.
    """
    source = source or ""
    build, at = _Builder(host), 0
    while True:
        low = source.find("<", at)
        if low < 0:
            if at < len(source):
                build.add(source[at:])
            break
        if low > at:
            build.add(source[at:low])
        if source.startswith("<!--", low):
            end = source.find("-->", low + 4)
            at = len(source) if end < 0 else end + 3
            continue
        if source.startswith(("<!", "<?"), low):
            end = source.find(">", low)
            at = len(source) if end < 0 else end + 1
            continue
        tag = _TAG.match(source, low)
        if tag is None:
            # a tag that the page's end cuts off is dropped, any other "<" is text
            if source[low + 1 : low + 2].isalpha() or source[low + 1 : low + 2] == "/":
                end = source.find(">", low)
                at = len(source) if end < 0 else end + 1
            else:
                build.add("<")
                at = low + 1
            continue
        at, name = tag.end(), tag[2].lower()
        if tag[1]:
            build.end(name)
        elif name in RAW:
            end = _RAW_ENDS[name].search(source, at)
            at = len(source) if end is None else end.end()
        else:
            build.start(name, tag[3])
    build.flush()
    while build.top is not build.root:
        build.pop()
    return build.page


def judged_blocks(page: Page) -> list[tuple[str, bool, list[int]]]:
    """(text, whether the page's own markup rules it out, nodes whose importance decides on it) for every block.

    A page that declares an article (``main`` or ``article``) has its text there;
    a heading of first order may stand outside.  Inside, only branches with a
    class or an id are open to judgement, elsewhere every branch.
    """

    def surely_noise(path: list[Node]) -> bool:
        return any(n.noise for n in path)

    paths = [(text, node.path()) for text, node in page.blocks]
    declared = [n for n in page.nodes if n.tag in ("main", "article")]
    clean = [n for n in declared if not any(x.noise or x.weak_noise for x in n.path())]
    excused: set[int] = set()
    if declared and not clean:
        # what names itself surroundings but holds all of the article is none
        clean = [n for n in declared if not surely_noise(n.path())]
        excused = {id(x) for n in clean for x in n.path()}
    mains = [n for n in clean if n.tag == "main"]
    inside = {id(n) for n in (mains or clean)}
    out = []
    for text, path in paths:
        noise = any(n.noise or (n.weak_noise and id(n) not in excused) for n in path)
        depth = next((k for k, n in enumerate(path) if id(n) in inside), None)
        if inside and depth is None:
            noise = noise or not any(n.tag == "h1" for n in path)
        open_to = path[:depth] if depth is not None and not noise else path
        nodes = {n.id for n in open_to if n.up is not None and n.tag not in ("html", "body") and (depth is None or noise or n.marked)}
        out.append((text, noise, sorted(nodes)))
    return out


def branches(page: Page) -> list[tuple[int, list[int]]]:
    """(node, ids above it, lowest first), once for each node of the page."""
    out: dict[int, list[int]] = {}
    for node in page.nodes:
        if node.id not in out:
            out[node.id] = list(dict.fromkeys(n.id for n in node.path() if n.up is not None and n.id != node.id))
    return list(out.items())


def features(page: Page) -> list[tuple[int, int, int, int]]:
    """(node, kind, feature, times): kind 0 are presentation styles, 1 texts, links and images.

    A style is the sequence of child labels, runs of equal ones counted once.
    """
    counts: Counter[tuple[int, int, int]] = Counter()
    for node in page.nodes:
        style = [c for k, c in enumerate(node.children) if k == 0 or c != node.children[k - 1]]
        counts[node.id, 0, _hash(repr(style))] += 1
    # what stands outside of any element belongs to no branch
    counts.update((node, 1, feature) for node, feature in page.content if node != page.root)
    return [(node, kind, feature, n) for (node, kind, feature), n in counts.items()]
