"""Leaf blocks of an HTML page: tag path, text and link share."""

from __future__ import annotations

import html
import re

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9-]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)",
    re.S,
)
#: Content that is no text of the page and holds no tags: up to the closing tag, else the end.
RAW = {
    tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I)
    for tag in "script style title noscript template iframe textarea".split()
}
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[a-z]+|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MATH = frozenset(
    "annotation annotation-xml maction math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms"
    " mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
#: Tags that do not end a block of text.
INLINE = MATH | frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark output q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
#: An opening tag ends these where they are still open.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "button": ("button",), "select": ("select",), "object": (), "tbody": ("thead", "tbody"), "body": ("head",),
}
#: These keep an implied end from reaching outside.
SCOPES = frozenset("table ul ol dl article section div main body aside nav header footer form blockquote button select object".split())
#: What may stand in a head; another tag ends it.
IN_HEAD = frozenset("head html base basefont bgsound link meta title noscript noframes style script template".split())
#: These end a button or select left open, as they cannot stand in one.
ENDS_CONTROL = frozenset(
    "article aside blockquote body dl footer form h1 h2 h3 h4 h5 h6 header main nav ol p section table ul".split()
)
#: These end a drawing left open, as the HTML parsing rules say.
ENDS_SVG = ENDS_CONTROL | frozenset(
    "b big br center code dd div dt em embed head hr i img li listing menu meta nobr pre ruby s small span strong strike sub sup tt u var".split()
)


class Block:
    """Text between two block boundaries."""

    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple, text: str, linked: int):
        self.path, self.text, self.linked = path, text, linked


def _close(stack: list, names: tuple) -> None:
    for k in range(len(stack) - 1, -1, -1):
        if stack[k][0] in names:
            del stack[k:]
            return
        if stack[k][0] in SCOPES:
            return


def _ends_itself(attrs: str) -> bool:
    """``/>`` that is not the end of an unquoted value."""
    if not attrs.endswith("/"):
        return False
    before = attrs[:-1]
    word = re.match(r"[^\s\"']*", before[::-1])[0]
    return "=" not in word and not before[: len(before) - len(word)].rstrip().endswith("=")


def _end_control(stack: list) -> None:
    for k in range(len(stack) - 1, -1, -1):
        if stack[k][0] in ("button", "select"):
            del stack[k:]
            return


def blocks_of(page: str | None) -> list[Block]:
    """Non-empty blocks in page order.  A path entry is (tag, words of class, id and
    role); text has its character references decoded and white space folded.
    Drawings (svg) give no text; formulas and an object's own content do."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, tuple]] = []
    pieces: list[str] = []
    linked = links = 0
    in_head = False
    drawn: list[str] = []  # open tags of a drawing

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(tuple(e for e in stack if e[0] not in INLINE), text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def leave_head() -> None:
        nonlocal in_head
        in_head = False
        _close(stack, ("head",))

    def say(raw: str) -> None:
        nonlocal linked, in_head
        if in_head and raw.strip():
            leave_head()
        if raw and not in_head and not drawn:
            text = html.unescape(raw)
            pieces.append(text)
            if links:
                linked += len(text.strip())

    at = 0
    while m := TOKEN.search(page, at):
        say(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if drawn:
            if m["close"]:
                k = next((k for k in range(len(drawn) - 1, -1, -1) if drawn[k] == tag), None)
                if k is not None:
                    del drawn[k:]
                    continue
                if all(e[0] != tag for e in stack):
                    continue
                drawn.clear()
            elif tag in ENDS_SVG and "foreignobject" not in drawn:
                drawn.clear()
            else:
                if tag not in VOID and not _ends_itself(m["attrs"]) and len(drawn) < 512:
                    drawn.append(tag)
                continue
        if not m["close"]:
            if in_head and tag not in IN_HEAD:
                leave_head()
            if tag in RAW:
                end = RAW[tag].search(page, at)
                at = end.end() if end else len(page)
                continue
            if tag == "svg":
                if not _ends_itself(m["attrs"]):
                    drawn.append(tag)
                continue
            if tag in MATH and _ends_itself(m["attrs"]):
                continue
        inline = tag in INLINE
        if not inline:
            flush()
        if m["close"]:
            if tag in ("head", "body", "html", "br"):
                in_head = False
            if tag == "a":
                links = max(0, links - 1)
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if inline and stack[k][0] not in INLINE:
                    break
            continue
        if tag == "head":
            in_head = True
        if tag in VOID:
            continue
        if not inline:
            links = 0
            if tag in ENDS_CONTROL:
                _end_control(stack)
            _close(stack, ("p",) if tag not in CLOSES else CLOSES[tag])
        elif tag == "a":
            links += 1
        names = ()
        if m["attrs"]:
            said = " ".join(x for g in NAMES.findall(m["attrs"]) for x in g if x)
            names = tuple(WORDS.findall(said.lower())) if said else ()
        stack.append((tag, names))
        if len(stack) > 512:
            del stack[1]
    say(page[at:])
    flush()
    return out
