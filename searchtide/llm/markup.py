"""Markup as a sequence of tokens: tags with their path, and the text between them."""

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import blake2b

# Elements by how markup treats them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe xmp noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp "
    "rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_PARAGRAPH = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
# Elements whose text is never part of an article.
NEVER = set("nav footer aside form dialog menu".split())
# Words of class, id and role that mark what is beside an article.
BESIDE = set(
    "ad ads advert adverts advertisement advertising advertorial banner breadcrumb breadcrumbs comment "
    "comments commentlist consent cookie cookies discussion disqus footer gdpr login menu modal nav "
    "navbar navigation newsletter notice notification outbrain pagination pager popup popups promo "
    "promos promoted promotion recommendations related replies reply respond search share sharing "
    "sidebar signup skip social sponsor sponsored sponsors subscribe subscription taboola toolbar "
    "widget widgets complementary contentinfo alert alertdialog tablist".split()
)
# The same, but only outside an article: inside one they may hold its title.
BESIDE_OUTSIDE = {"header", "masthead", "topbar", "hero"}
# Words of what looks like an article and is a reader's comment.
COMMENT = {"comment", "comments", "reply"}
# Names of classes that begin so say what a page has, not what an element is.
SAYS_ONLY = set("with has have no not without is js page body layout".split())
# Elements that do not end the line that they stand in.
UNSEEN = INLINE | set("script style noscript template link meta".split())
# Elements that are lines of a text rather than what holds it.
LINES = set("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre figcaption".split())
# Elements that have no text of a page, whatever is around them.
HARD = RAW | set("head button select template svg math canvas audio video object".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([A-Za-z][^\s/>]*)"
    r"((?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)>|<[!?/][^>]*(?:>|\Z)|<[A-Za-z][^>]*\Z",
    re.S,
)
_MARKS = re.compile(r"(?:^|[\s\"'/])(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[^\W\d_]+")
_DIGITS = re.compile(r"\d+")
#: Signs that part the text between two tags into tokens of their own.
_SIGNS = re.compile(r"[|·•»«:–—©]")


@lru_cache(maxsize=200_000)
def number_of(parent: int, key: str) -> int:
    """An even 63-bit number of a tag by its path; text has odd ones."""
    digest = blake2b(f"{parent}/{key}".encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True) & ~1


def text_number(parent: int, text: str) -> int:
    digest = blake2b(f"{parent}#{text}".encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True) | 1


@lru_cache(maxsize=20_000)
def _described(name: str, marks: str) -> tuple[str, frozenset[str], bool]:
    """A tag's key (no digits of its class), the words of its marks, whether it says main."""
    words, classes, main = set(), "", False
    for kind, value in _MARKS.findall(marks):
        kind, value = kind.lower(), value.strip("\"'")
        main = main or (kind, value.lower()) in (("role", "main"), ("itemprop", "articlebody"))
        for one in value.split():
            parts = [w.lower() for w in _PARTS.findall(one)]
            if parts and parts[0] not in SAYS_ONLY:
                words.update(parts)
        if kind == "class":
            classes = " ".join(sorted(_DIGITS.sub("#", value).split()))
    return f"{name}.{classes}", frozenset(words), main


@dataclass(slots=True)
class Element:
    name: str
    number: int
    depth: int
    hard: bool  # its text is never part of the page's text
    beside: bool  # it is an element for what is beside an article
    marked: bool  # a word of its class says that it is beside the article
    article: bool  # it is the article or inside of it
    link: bool


@dataclass(slots=True)
class Block:
    """Text between two tags that end a line, and where it is."""

    path: tuple[Element, ...]
    parts: list[str] = field(default_factory=list)
    tokens: list[int] = field(default_factory=list)
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


@dataclass
class Page:
    tokens: list[int]  # numbers of tags and texts, in page order
    tags: dict[int, int]  # depth of every tag that can hold an article, by its number
    blocks: list[Block]


def _raw_end(markup: str, name: str, start: int) -> int:
    """Where a raw element ends; one that is not closed takes the rest of the page."""
    found = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(markup, start)
    return found.end() if found else len(markup)


def _pieces(markup: str) -> Iterator[tuple[str, str, str]]:
    """('text', its text, ''), ('start', name, attributes) and ('end', name, '')."""
    at = 0
    while True:
        found = _TOKEN.search(markup, at)
        stop = found.start() if found else len(markup)
        if stop > at:
            yield "text", html.unescape(markup[at:stop]), ""
        if not found:
            return
        at = found.end()
        if markup.startswith("<![CDATA[", stop):
            yield "text", markup[stop + 9 : at].removesuffix("]]>"), ""
        elif found[2]:
            name = found[2].lower()
            if found[1]:
                yield "end", name, ""
                continue
            yield "start", name, found[3]
            if name in RAW:
                at = _raw_end(markup, name, at)
                yield "end", name, ""


class _Reader:
    def __init__(self) -> None:
        self.stack = [Element("", 0, 0, False, False, False, False, False)]
        self.names: dict[str, int] = {}
        self.page = Page([], {}, [])
        self.block: Block | None = None

    def flush(self) -> None:
        if self.block and self.block.tokens:
            self.page.blocks.append(self.block)
        self.block = None

    def pop(self, to: int) -> None:
        while len(self.stack) > to:
            gone = self.stack.pop()
            self.names[gone.name] -= 1

    def start(self, name: str, attributes: str) -> None:
        if name not in UNSEEN:
            self.flush()
        if name in CLOSES_PARAGRAPH and self.names.get("p"):
            self.end_open({"p"}, lambda n: n not in INLINE and n != "p")
        if name in ENDED_BY:
            ends, scope = ENDED_BY[name]
            self.end_open(ends, scope.__contains__)
        up = self.stack[-1]
        key, words, main = _described(name, attributes if "=" in attributes else "")
        number = number_of(up.number, key)
        self.page.tokens.append(number)
        if name not in INLINE and name not in LINES:
            self.page.tags[number] = up.depth + 1
        if name == "br" and self.block:
            self.block.parts.append(" ")
        if name in VOID:
            return
        article = main or name == "main" or (name == "article" and not words & COMMENT)
        marked = not article and name not in ("html", "body") and bool(words & BESIDE)
        if not up.article and not article:
            marked = marked or name == "header" or bool(words & BESIDE_OUTSIDE)
        self.stack.append(
            Element(
                name,
                number,
                up.depth + 1,
                up.hard or name in HARD,
                up.beside or name in NEVER,
                up.marked or marked,
                up.article or article,
                up.link or name == "a",
            )
        )
        self.names[name] = self.names.get(name, 0) + 1

    def end_open(self, ends: set[str], scope) -> None:
        """Close the outermost open element of ``ends`` that no element of ``scope`` holds in."""
        found = None
        for i in range(len(self.stack) - 1, 0, -1):
            name = self.stack[i].name
            if name in ends:
                found = i
            elif scope(name):
                break
        if found:
            self.pop(found)

    def end(self, name: str) -> None:
        if name not in UNSEEN:
            self.flush()
        if self.names.get(name):
            at = len(self.stack) - 1
            while self.stack[at].name != name:
                # An inline tag's end does not close the block that it is in.
                if name in INLINE and self.stack[at].name not in INLINE:
                    return
                at -= 1
            self.pop(at)

    def text(self, text: str) -> None:
        if self.block is None:
            self.block = Block(tuple(e for e in self.stack))
        self.block.parts.append(text)
        up = self.stack[-1]
        size = 0
        for segment in _SIGNS.split(text):
            words = " ".join(segment.split())
            if words:
                number = text_number(up.number, words)
                self.block.tokens.append(number)
                self.page.tokens.append(number)
                size += len(words)
        if up.link:
            self.block.linked += size


def parse(markup: str) -> Page:
    """Tokens and blocks of a page; any string is accepted."""
    reader = _Reader()
    for kind, value, attributes in _pieces(markup):
        if kind == "start":
            reader.start(value, attributes)
        elif kind == "end":
            reader.end(value)
        elif kind == "text":
            reader.text(value)
    reader.flush()
    return reader.page
