"""HTML pages as small token trees: repaired markup, decoded text, names that mark boilerplate."""

from __future__ import annotations

import functools
import html
import re

# ---- fixed values: HTML element kinds ----
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
#: Formatting inside a block; their text runs on.
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q ruby rb rt rp s samp small span
    strike strong sub sup time tt u var""".split())
#: A start tag of these ends an open paragraph.
ENDS_P = frozenset("""address article aside blockquote center details dialog dir div dl dt dd fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul""".split())
#: Start tag -> (open elements it ends, elements that shield them).
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
        "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
        "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "body": ({"head"}, set())}
#: An end tag doesn't reach past these.
SHIELD = frozenset("table td th caption button object".split())
#: Elements that never hold the text of an article.
BOILERPLATE = frozenset("""head nav footer aside button select option textarea input dialog menu script style noscript template iframe
    object svg canvas audio video map datalist noembed noframes xmp""".split())
#: Words of class, id and role names that mark boilerplate, alone or as the last or first word of a name.
NAMES = frozenset("""ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox banner banners sponsor sponsored promo
    promos promotion nav navbar navigation navi menu menus breadcrumb breadcrumbs footer foot footnav masthead sidebar sidebars aside complementary
    widget widgets rail cookie cookies consent gdpr notice notices alert alerts popup modal overlay toast newsletter subscribe subscription signup
    login signin share sharing social related recommended recommendations comment comments commentlist disqus respond reply replies search searchbox
    pagination pager paging toolbar copyright legal disclaimer skip skiplink""".split())
#: First words that only describe the layout around it.
LAYOUT = frozenset("has with no without is content main page layout body wrap wrapper site post single template".split())
HEADER_OF = frozenset("post entry article content story page title".split())
# ----

#: Elements nested deeper than this count as part of the one at this depth.
DEPTH = 80
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>"
                  r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}


class Element:
    """``label``: tag with normalised id and classes. ``kids``: elements, and (text, characters inside links)."""

    __slots__ = ("tag", "label", "out", "kids")

    def __init__(self, tag: str, label: str, out: bool):
        self.tag, self.label, self.out, self.kids = tag, label, out, []


@functools.lru_cache(maxsize=20_000)
def described(tag: str, attrs: str) -> tuple[str, bool]:
    """(label, whether tag or names mark boilerplate) of a start tag."""
    given = {}
    for m in _ATTR.finditer(attrs):
        given.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    out = tag in BOILERPLATE or "hidden" in given or given.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", given.get("style", ""), re.I) is not None
    names = [*given.get("class", "").split(), given.get("id", ""), given.get("role", "")]
    if tag not in ("html", "body", "main"):
        out = out or any(marks(n, tag) for n in names)
    label = re.sub(r"[0-9]+", "0", ".".join([given.get("id", ""), *sorted(set(given.get("class", "").split()))])).strip(".")
    return (f"{tag}|{label}" if len(label) <= 80 else f"{tag}|{label[:60]}~{len(label)}"), out


def marks(name: str, tag: str) -> bool:
    """Whether a class, id or role name marks boilerplate."""
    words = [w.lower() for w in _WORDS.findall(name)]
    words = [w for w in words if not w.isdigit()] or words
    if not words or (words[0] in LAYOUT and len(words) > 1 and words[-1] not in ("comments", "footer", "ad", "ads")):
        return False
    if tag == "article":
        return words[-1] in ("comment", "comments", "ad", "ads", "reply", "related", "sponsored")
    if "header" in (words[0], words[-1]):
        return words[0] not in HEADER_OF and tag not in ("h1", "h2", "h3", "h4", "h5", "h6", "article")
    return words[0] in NAMES or words[-1] in NAMES


def parse(page: str | None) -> Element:
    """The token tree of a page. Unclosed elements end with their parent, stray end tags are left out.

    Scripts, styles, comments and the head leave nothing; formatting tags are transparent, and a
    boilerplate element keeps no content. Any string gives a tree; a null page an empty one.
    """
    root = Element("html", "html", False)
    if not page:
        return root
    stack, links, text, linked = [root], 0, [], 0
    at, n = 0, len(page)
    dropped = 0                                         # depth of the boilerplate element around, or 0

    def close_text() -> None:
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            if joined and not dropped:
                stack[-1].kids.append((joined, min(linked, len(joined))))
            text.clear()
            linked = 0

    def pop_to(size: int) -> None:
        nonlocal dropped, links
        close_text()
        del stack[size:]
        links = 0
        if size <= dropped:
            dropped = 0

    def say(piece: str) -> None:
        nonlocal linked
        if piece and not dropped:
            if "&" in piece:
                piece = html.unescape(piece)
            text.append(piece)
            if links:
                linked += len(piece)

    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at:m.start()])
        at = m.end()
        tag = m[2] or m[4]
        if tag:
            tag = tag.lower()
            if tag in RAW:
                end = _RAW_END[tag].search(page, at)
                at = end.end() if end else n
                continue
            if tag in INLINE:
                links += tag == "a"
                if tag == "span" and described(tag, (m[3] or m[5] or "")[:2_000])[1]:
                    pass                                # a marked span is an element of its own
                else:
                    continue
            if tag == "br":
                text.append(" ")
                continue
            if tag in VOID:
                if tag == "hr":
                    close_text()
                continue
            if tag == "html" or (tag == "body" and any(e.tag == "body" for e in stack)):
                continue
            if tag in ENDS_P:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in SHIELD:
                        break
                    if stack[k].tag == "p":
                        pop_to(k)
                        break
            if tag in ENDS:
                ends, shield = ENDS[tag]
                size = len(stack)
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in shield:
                        break
                    if stack[k].tag in ends:
                        size = k
                if size < len(stack):
                    pop_to(size)
            close_text()
            label, out = described(tag, (m[3] or m[5] or "")[:2_000])
            out = out or (tag == "header" and not any(e.tag in ("article", "main") for e in stack))
            if len(stack) > DEPTH:
                if out and not dropped:
                    dropped = len(stack)
                stack.append(stack[-1] if not dropped else Element(tag, label, out))
                continue
            new = Element(tag, label, out)
            if not dropped:
                stack[-1].kids.append(new)
                if out:
                    dropped = len(stack)
            stack.append(new)
        elif m[1]:
            tag = m[1].lower()
            if tag in INLINE and not (tag == "span" and stack[-1].tag == "span"):
                if tag == "a" and links:
                    links -= 1
                continue
            if tag == "br":
                text.append(" ")
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    pop_to(k)
                    break
                if stack[k].tag in SHIELD and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html", "article", "main"):
                    break
    pop_to(1)
    return root
