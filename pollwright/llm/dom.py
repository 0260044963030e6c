"""A page as a tree of blocks, and the features of each block."""

from __future__ import annotations

import html
import math
import re
from collections import Counter

VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style template noscript iframe xmp textarea title svg object canvas".split())
BLOCK = set(
    "html body main article section div p ul ol li dl dt dd h1 h2 h3 h4 h5 h6 header footer nav "
    "aside form fieldset table caption thead tbody tfoot tr td th blockquote pre figure figcaption "
    "address details summary center select option button label hgroup menu dialog search".split()
)
#: An opening tag ends these open elements, unless one of the fences lies between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
FENCES = set("table td th caption button object body html".split())
NO_PARAGRAPH = BLOCK - set("html body td th tr tbody thead tfoot caption option select button label".split())

#: Searched up to the last ``>`` of a page, so that every tag has an end there: a
#: quote opens a value only after ``=`` and only where it is closed.
TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?P<ended>--!?>|\Z))|<[!?][^>]*+>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')|[^>])*+)>",
    re.S,
)
HEAD_END = re.compile(r"</head\s*>|<body", re.I)
MARKS = re.compile(
    r"""\b(?:class|id|role|itemprop|itemtype|aria-label|data-role|type)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""",
    re.I,
)
PART = re.compile(r"[a-z]+|[A-Z][a-z]*")

#: What words in the attributes of an element speak for.
SIGNS = {
    "main": "article content main post entry story body text prose page blog section readable",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs tabs pagination pager toc skip toolbar topbar",
    "head": "header head masthead top site",
    "foot": "footer foot bottom copyright legal contentinfo colophon",
    "side": "aside sidebar side rail widget related recommended complementary more trending popular latest",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted dfp",
    "notice": "cookie cookies consent gdpr notice alert notification warning popup modal overlay banner dialog paywall",
    "form": "form login signup signin subscribe subscription newsletter search register contact input",
    "comment": "comment comments reply replies disqus respond discussion feedback review reviews commentlist reader",
    "social": "share sharing social follow like tweet author byline tags tag meta rating print",
}
SIGN_OF = {word: sign for sign, words in SIGNS.items() for word in words.split()}
SIGN_AT = {sign: i for i, sign in enumerate(SIGNS)}
KINDS = {
    tag: kind
    for kind, tags in enumerate((
        "p", "h1 h2 h3 h4 h5 h6 hgroup", "li dt dd", "ul ol dl menu", "div center", "section", "article main",
        "nav", "header", "footer", "aside", "form fieldset label button select option search", "table thead tbody tfoot tr td th caption",
        "blockquote pre figure figcaption", "html body", "address details summary dialog",
    ))
    for tag in tags.split()
}
N_KINDS = 17
#: Elements that say by themselves what a class would.
TAG_SIGN = {
    "nav": "menu", "header": "head", "footer": "foot", "aside": "side", "form": "form", "fieldset": "form",
    "label": "form", "button": "form", "select": "form", "option": "form", "article": "main", "main": "main",
    "dialog": "notice", "search": "form",
}


class Node:
    """A block; its pieces are the texts that stand directly in it."""

    __slots__ = (
        "tag", "signs", "parent", "children", "depth", "own", "own_links", "inputs", "elements",
        "total", "links", "blocks", "paragraphs", "stops", "place", "at", "shade",
    )

    def __init__(self, tag: str, attrs: str, parent: Node | None) -> None:
        self.tag, self.parent, self.children = tag, parent, []
        self.depth = parent.depth + 1 if parent else 0
        self.own = self.own_links = self.inputs = self.elements = self.stops = 0
        self.signs = [0] * len(SIGNS)
        if tag in TAG_SIGN:
            self.signs[SIGN_AT[TAG_SIGN[tag]]] = 1
        if "=" in attrs:
            for value in MARKS.findall(attrs):
                for word in PART.findall(value):
                    sign = SIGN_OF.get(word.lower())
                    if sign:
                        self.signs[SIGN_AT[sign]] = 1
        #: signs of the blocks above
        self.shade = [a | b for a, b in zip(parent.signs, parent.shade, strict=True)] if parent else [0] * len(SIGNS)
        self.place = len(parent.children) if parent else 0
        self.at = 0
        if parent:
            parent.children.append(self)


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Blocks in page order, parents first, and the lines with the number of their block.

    A line is what stands in a block between the starts and ends of other blocks,
    with character references decoded and white space made single blanks. Comments
    and raw elements end as in HTML. Time is linear in the page, also where tags
    are broken or never closed: a tag without an end at the page's end is text.
    """
    root = Node("html", "", None)
    nodes, lines = [root], []
    number = {id(root): 0}
    #: open elements: tag, block they are in, whether inside a link
    stack: list[tuple[str, Node, bool]] = [("html", root, False)]
    #: places in the stack of the open elements of a tag, of blocks, and of fences
    places: dict[str, list[int]] = {}
    blocks: list[int] = []
    fences: list[int] = []
    pieces: list[str] = []
    held = root
    seen = 0

    def flush() -> None:
        nonlocal pieces
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                lines.append((number[id(held)], text))
            pieces = []

    def text(raw: str) -> None:
        nonlocal held, seen
        if not raw:
            return
        block, linked = stack[-1][1], stack[-1][2]
        if block is not held:
            flush()
            held = block
        pieces.append(raw)
        n = len(raw) - raw.count(" ") if not raw.isspace() else 0
        block.own += n
        seen += n
        if linked:
            block.own_links += n
        block.stops += raw.count(".") + raw.count(",")

    def close(upto: int) -> None:
        if any(x[1] is not stack[upto - 1][1] for x in stack[upto:]):
            flush()
        for x in stack[upto:]:
            places[x[0]].pop()
        del stack[upto:]
        while blocks and blocks[-1] >= upto:
            blocks.pop()
        while fences and fences[-1] >= upto:
            fences.pop()

    def last(tags: set[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    at, low, headed = 0, None, True
    stop = page.rfind(">") + 1
    while True:
        found = TOKEN.search(page, at, stop)
        if not found:
            # an unfinished comment hides what follows
            open_at = page.find("<!--", max(at, stop))
            text(page[at:] if open_at < 0 else page[at:open_at])
            break
        text(page[at : found.start()])
        at = found.end()
        tag = found["tag"]
        if tag is None:
            if found["ended"] == "":
                later = page.find("-->", max(found.start() + 4, stop - 2))
                at = len(page) if later < 0 else later + 3
            continue
        tag = tag.lower()
        if found["end"]:
            i = places[tag][-1] if places.get(tag) else 0
            barred = fences if tag in BLOCK else blocks
            if i and (not barred or i >= barred[-1]):
                close(i)
            continue
        if tag in RAW:
            low = page.lower() if low is None else low
            if len(low) == len(page):
                end = low.find(f"</{tag}", at)
            else:
                later = re.compile(re.escape(f"</{tag}"), re.I).search(page, at)
                end = later.start() if later else -1
            # only a foreign element can be empty by a slash
            if tag != "svg" or not found["attrs"].endswith("/"):
                at = len(page) if end < 0 else end
            continue
        if tag == "head":
            later = HEAD_END.search(page, at) if headed else None
            if later:
                at = later.start()
            headed = bool(later)
            continue
        stack[-1][1].elements += 1
        if tag in VOID:
            if tag in ("br", "hr", "wbr"):
                pieces.append("" if tag == "wbr" else " ")
            elif tag == "input":
                stack[-1][1].inputs += 1
            continue
        if tag in NO_PARAGRAPH and blocks and stack[blocks[-1]][0] == "p":
            close(blocks[-1])
        if tag in ENDS:
            ended, bars = ENDS[tag]
            bar = last(bars)
            while (i := last(ended)) > bar:
                close(i)
                if tag not in ("tr", "tbody", "tfoot"):
                    break
        if tag == "html" or tag == "body" and places.get("body"):
            continue
        places.setdefault(tag, []).append(len(stack))
        if tag in FENCES:
            fences.append(len(stack))
        if tag in BLOCK:
            blocks.append(len(stack))
            flush()
            node = Node(tag, found["attrs"], stack[-1][1])
            node.at = seen
            number[id(node)] = len(nodes)
            nodes.append(node)
            if tag in ("button", "select"):
                node.inputs += 1
            stack.append((tag, node, stack[-1][2]))
        else:
            stack.append((tag, stack[-1][1], stack[-1][2] or tag == "a"))
    flush()
    for node in reversed(nodes):
        node.total, node.links, node.blocks = node.own, node.own_links, 1
        node.paragraphs = int(node.tag == "p")
        for child in node.children:
            node.total += child.total
            node.links += child.links
            node.blocks += child.blocks
            node.paragraphs += child.paragraphs
            node.inputs += child.inputs
            node.elements += child.elements
            node.stops += child.stops
    return nodes, lines


def log(x: float) -> float:
    return math.log1p(x)


def features(nodes: list[Node]) -> list[list[float]]:
    """A row for each block: element, attributes, depth, density, siblings, parent, place."""
    whole = max(1, nodes[0].total)
    rows = []
    tags = {id(n): Counter(child.tag for child in n.children) for n in nodes if n.children}
    for n in nodes:
        up = n.parent or n
        beside = up.children if n.parent else [n]
        before = beside[n.place - 1] if n.place else None
        after = beside[n.place + 1] if n.place + 1 < len(beside) else None
        kind = KINDS.get(n.tag, N_KINDS - 1)
        alike = tags[id(up)][n.tag] if n.parent else 1
        row = [0.0] * N_KINDS
        row[kind] = 1.0
        row += n.signs
        row += n.shade
        row += [
            n.depth, log(n.total), log(n.own), n.total / whole, n.own / (n.total + 1),
            n.links / (n.total + 1), n.total / (n.elements + 1), n.stops / (n.total + 1) * 20,
            log(n.blocks), log(n.paragraphs), log(n.inputs), n.at / whole,
            log(len(beside)), n.place / len(beside), alike / len(beside),
            log(before.total) if before else -1.0, before.links / (before.total + 1) if before else -1.0,
            log(after.total) if after else -1.0, after.links / (after.total + 1) if after else -1.0,
            KINDS.get(up.tag, N_KINDS - 1), log(up.total), up.links / (up.total + 1), log(up.paragraphs),
        ]
        rows.append(row)
    return rows


def decode(nodes: list[Node], kept: list[float], dropped: list[float]) -> list[bool]:
    """The likeliest choice of blocks in which every kept block stands in kept ones.

    ``kept`` and ``dropped`` are log probabilities. What is dropped is dropped
    with all that it holds.
    """
    number = {id(n): i for i, n in enumerate(nodes)}
    with_it, without = list(kept), list(dropped)
    for i in range(len(nodes) - 1, 0, -1):
        up = number[id(nodes[i].parent)]
        with_it[up] += max(with_it[i], without[i])
        without[up] += without[i]
    chosen = [True] * len(nodes)
    for i, n in enumerate(nodes):
        chosen[i] = with_it[i] >= without[i] and (n.parent is None or chosen[number[id(n.parent)]])
    return chosen
