"""Walking HTML as it is found: elements with their paths, and the text in them."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

# A comment, a declaration, or a tag; a construct that the page breaks off goes on to its end.
MARK = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s"'>]+))""")

# Element names of HTML by how they nest and show.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_ITSELF = frozenset("li dt dd tr td th option".split())
SECTIONS = frozenset("article main section div body td center".split())

# Elements and roles that mark what is no article text, and names that as a whole
# mark a menu, a site's head or foot, a side column, a notice, an advert or readers' comments, if a
# block container has them as a class or id.
ASIDE = frozenset("nav footer aside form button select template svg dialog menu head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
CONTAINERS = frozenset("center dd div dl fieldset li ol section table tbody td tr ul".split())
WHOLE_NAMES = (
    r"ads?|advert|adverts|advertisements?|adsense|sponsored",
    r"(?:(?:site|main|top|page)[_-]?)?(?:menu|nav|navigation)|breadcrumbs?|pagination",
    r"(?:site|global|top)[_-]?(?:header|footer)|masthead|page[_-]?footer|footer",
    r"(?:(?:left|right|main|page|primary|secondary|site)[_-]?)?sidebar|related[_-]?(?:articles|links|posts)|popular[_-]?posts|related",
    r"(?:cookies?|consent|gdpr|privacy|site)[_-]?(?:banner|message|notice|overlay|popup)|cookies",
    r"(?:(?:reader|user|visitor)s?[_-]?)?comments?|respond|disqus",
)
NAMES = re.compile(
    rf"(?:{'|'.join(WHOLE_NAMES)})(?:[_-]?(?:area|bar|block|box|container|form|list|menu|section|slot|thread|unit|wrap|wrapper|[0-9]+))*",
    re.I,
)
DEEP = 256
DIGITS = re.compile(r"\d+")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)} if "=" in text else {}


def _aside(tag: str, values: dict[str, str], raw: str, inside: bool) -> bool:
    """Whether an element holds no article text; ``inside`` an article or main element."""
    if tag in ASIDE or tag == "header" and not inside:
        return True
    if tag in ("html", "body", "main") or not raw.strip():
        return False
    if values.get("role", "").lower() in ROLES or values.get("aria-hidden") == "true" or re.search(r"(?:^|\s)hidden(?:$|[\s=/])", raw):
        return True
    if tag not in CONTAINERS:
        return False
    names = values.get("class", "").split()
    # The ids of sections come from their headings.
    if "id" in values and tag != "section" and "section" not in names:
        names.append(values["id"].strip())
    return any(NAMES.fullmatch(n) for n in names)


class Node:
    """An open element: its path, and whether it or one around it is aside."""

    __slots__ = ("aside", "inside", "path", "tag")

    def __init__(self, tag: str, path: str, aside: bool, inside: bool):
        self.tag, self.path, self.aside, self.inside = tag, path, aside, inside


def walk(page: str) -> Iterator[tuple[str, Node, str]]:
    """('open', node, '') for elements, ('text', node, plain text), ('break', node, '') between blocks.

    Paths name elements with their classes and ids, numbers left out.  Scripts,
    styles, titles and the like give no text; a paragraph ends where a block
    starts, an end without a start is ignored.
    """
    stack = [Node("", "", False, False)]
    at = 0
    while at < len(page):
        mark = MARK.search(page, at)
        upto = mark.start() if mark else len(page)
        if upto > at:
            yield "text", stack[-1], html.unescape(page[at:upto])
        if not mark:
            return
        at = mark.end()
        if not (tag := mark[2]):
            continue
        tag = tag.lower()
        block = tag not in INLINE
        if mark[1]:
            if any(n.tag == tag for n in stack[1:]):
                while stack.pop().tag != tag:
                    pass
            if block:
                yield "break", stack[-1], ""
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if block:
            shut = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p" or stack[i].tag in SECTIONS), 0)
            if tag not in VOID and stack[shut].tag == "p":
                del stack[shut:]
            if tag in CLOSES_ITSELF and stack[-1].tag == tag:
                stack.pop()
            yield "break", stack[-1], ""
        if tag in VOID:
            continue
        around = stack[-1]
        values = _attributes(mark[3])
        # Deeper elements go by the path of the last one, as their paths would only grow.
        deep = len(stack) > DEEP
        label = tag + "".join(sign + DIGITS.sub("", values[k]).strip().replace("/", "").replace(" ", ".") for sign, k in ((".", "class"), ("#", "id")) if values.get(k))
        node = Node(tag, around.path if deep else f"{around.path}/{label}", around.aside or _aside(tag, values, mark[3], around.inside), around.inside or tag in ("article", "main"))
        stack.append(node)
        yield "open", node, ""


def spaced(pieces: list[str]) -> str:
    """Every run of white space as one space, ends trimmed."""
    return " ".join("".join(pieces).split())
