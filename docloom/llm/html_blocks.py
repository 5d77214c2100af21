"""An HTML page as a stream of text blocks, each with the containers it stands in."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass
from hashlib import blake2b

# Element names of HTML, and words that sites use in class, id and role attributes.
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup"
    " time tt u var wbr".split()
)
#: Blocks that end on their own when the next block or their container's end comes.
LOOSE = frozenset("p li dt dd tr td th thead tbody tfoot option optgroup colgroup caption h1 h2 h3 h4 h5 h6".split())
OUTSIDE_NAMES = frozenset("head nav footer aside menu dialog button select datalist svg math object audio video canvas".split())
#: Elements that hold controls, or a whole page.
DOUBTED_NAMES = frozenset("form fieldset".split())
MAIN_NAMES = frozenset("article main".split())
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb"
    " breadcrumbs sidebar aside complementary footer contentinfo header masthead topbar toolbar comment comments commentlist disqus reply replies respond"
    " cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login search share sharing"
    " social related recommended recommendations widget pagination pager copyright hidden form".split()
)
HEADER_WORDS = frozenset("header banner masthead".split())
MAIN_WORDS = frozenset("articlebody article-body article-content post-content entry-content main-content".split())

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)"""
    r"""|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"""|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)"""
    r"""|<[!?/][^>]*(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORD = re.compile(r"[a-z]+|[0-9]+")
#: Class names that say what a page is laid out with or without, not what the element is.
LAYOUT = re.compile(r"(?:no|not|has|with|without|hide)[-_]")
#: Characters of a path; a longer one goes by its digest from there on, so that deep nesting takes memory by blocks alone.
LONGEST_PATH = 2000


@dataclass
class Block:
    """path: the containers from the outside in, e.g. 'body>div.content>p', the outer ones as a digest where it gets too long; place: 'main', 'outside', 'plain', or 'doubt' and 'doubt main';
    inside: the number, on its page, of the innermost container other than a paragraph, item or the like.

    In doubt is what a form holds, or a container whose class, id or role has a telling word only as a part of a longer
    name: `menu-open` may be a menu, or a page whose menu is open.
    """

    path: str
    place: str
    text: str
    linked: int
    inside: int = 0


def _container(name: str, attributes: str, in_main: bool) -> tuple[str, str]:
    """(label, place) of a container: 'outside', 'doubt', 'main', or '' where it changes nothing."""
    found = {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
    names = [x for x in f"{found.get('class', '')} {found.get('id', '')} {found.get('role', '')}".split() if not LAYOUT.match(x)]
    words = set(WORD.findall(" ".join(names)))
    label = name + "".join(f".{w}" for w in sorted(words) if not w.isdigit())
    if name in OUTSIDE_NAMES or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        return label, "outside"
    bad = words & OUTSIDE_WORDS
    if name == "header":
        bad |= {"header"}
    if in_main:  # an article's own header holds its headline
        bad -= HEADER_WORDS
    if name in ("html", "body"):
        bad = set()
    if bad or name in DOUBTED_NAMES:
        return label, "outside" if bad & {*names, name} else "doubt"
    if name in MAIN_NAMES or "main" in found.get("role", "").split() or found.get("itemprop") == "articlebody" or set(names) & MAIN_WORDS:
        return label, "main"
    return label, ""


def _inside(above: str, own: str) -> str:
    """The place of a container of its own place `own` in one of place `above`."""
    if "main" in above and own == "doubt":
        return "outside"
    return "doubt main" if above == "doubt" and own == "main" else own or above


def _below(path: str, label: str) -> str:
    longer = f"{path}>{label}" if path else label
    return longer if len(longer) <= LONGEST_PATH else "~" + blake2b(longer.encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


def blocks_of(page: str) -> list[Block]:
    """The page's text blocks in order; text of raw elements, comments and declarations is left out."""
    out: list[Block] = []
    stack: list[tuple[str, str, str, int]] = []  # name, path, place, number of the innermost lasting container
    opened: Counter[str] = Counter()  # how often each name stands in the stack
    parts: list[str] = []
    links, linked, position, containers = 0, 0, 0, 0
    end = len(page)

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            path, place, inside = stack[-1][1:] if stack else ("", "plain", 0)
            out.append(Block(path, place, text, min(linked, len(text)), inside))
        parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if links:
            linked += len(text)

    while position < end:
        start = page.find("<", position)
        if start < 0:
            add(page[position:])
            break
        token = TOKEN.match(page, start)
        if token is None:  # a lone <
            add(page[position : start + 1])
            position = start + 1
            continue
        if start > position:
            add(page[position:start])
        position = token.end()
        closing, name, attributes = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if not name:
            continue
        name = name.lower()
        if name in RAW:
            if not closing and not (attributes or "").endswith("/"):
                stop = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, position)
                position = stop.end() if stop else end
            if name not in ("textarea", "noscript"):
                continue
            parts.append(" ")
            continue
        if name in INLINE:
            if name == "a":
                links = 0 if closing else 1
            elif name in ("br", "wbr", "img"):
                parts.append(" " if name == "br" else "")
            continue
        flush()
        if name in VOID:
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1) if opened[name] else ():
                if stack[i][0] == name:
                    opened.subtract(x[0] for x in stack[i:])
                    del stack[i:]
                    break
                if name in LOOSE and stack[i][0] not in LOOSE:
                    break
            links = 0
            continue
        if name in LOOSE or stack and stack[-1][0] == "p":
            while stack and stack[-1][0] in LOOSE and (stack[-1][0] == name or stack[-1][0] in ("p", "h1", "h2", "h3", "h4", "h5", "h6")):
                opened[stack.pop()[0]] -= 1
        above = stack[-1] if stack else ("", "", "plain", 0)
        if above[2] == "outside":
            label, place = name, "outside"
        else:
            label, place = _container(name, attributes or "", "main" in above[2])
        containers += name not in LOOSE
        stack.append((name, _below(above[1], label), _inside(above[2], place), above[3] if name in LOOSE else containers))
        opened[name] += 1
    flush()
    return out
