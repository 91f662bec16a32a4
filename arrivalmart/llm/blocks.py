"""Blocks of text of an HTML page, each with the path of tags above it."""

from __future__ import annotations

import bisect
import functools
import html
import re
import zlib
from dataclasses import dataclass

# The elements of HTML that stand inside a line, that have no end tag, and whose text is not shown.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rb rt rp s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "iframe")  # their text has no tags, so without end tag they reach to the body or the end
HIDDEN = ("template", "noscript", "head", "svg", "object", "math")
FOREIGN = frozenset(("svg", "math"))  # empty where their tag is closed in itself
IN_HEAD = frozenset("html base basefont bgsound link meta".split())
# An open element of these ends where another of its group begins.
CLOSED_BY = {"p": "p", "li": "li", "dt": "dd", "dd": "dd", "tr": "tr", "td": "td", "th": "td", "option": "option"}

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|(?=<body[\s>])|\Z)"
    r"|<(?P<hidden>" + "|".join(HIDDEN) + r")(?=[\s/>])(?:(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*)>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
NAMES = re.compile(r"""(?:^|\s)(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
PATH = 192  # buckets of tags and words of a path
PART = re.compile(r"[a-z]+|[A-Z][a-z]*")


@dataclass
class Block:
    """A run of text between block-level tags: white space as one space, references decoded."""

    text: str
    path: int  # a bit for each bucket that a tag above it, or a word of such a tag's class, id, role or itemprop, falls in
    linked: int  # characters inside links


@functools.lru_cache(maxsize=100_000)
def _bit(token: str) -> int:
    return 1 << zlib.crc32(token.encode()) % PATH


def _bits(name: str, attributes: str) -> int:
    found = _bit(name)
    if "=" in attributes:
        for m in NAMES.finditer(attributes):
            for w in PART.findall(m[2] or m[3] or m[4] or ""):
                found |= _bit(f".{w.lower()}")
    return found


def _hidden(page: str, tags: list[re.Match]) -> dict[int, tuple[int, int]]:
    """For each tag that begins a hidden element, the number of the tag to go on with and the place from which text counts again.

    An element without end tag hides nothing, except a head: it ends at the first tag or text that can't stand in it.
    """
    found: dict[int, tuple[int, int]] = {}
    open_: list[tuple[str, int]] = []
    depths: dict[str, list[int]] = {name: [] for name in HIDDEN}
    heads = []
    ends: dict[str, list[int]] = {"title": [], "noframes": []}
    for k, m in enumerate(tags):
        if m["hidden"]:
            name = m["hidden"].lower()
            if name == "head":
                heads.append(k)
            elif name in FOREIGN and m[0].endswith("/>"):
                found[k] = k + 1, m.end()
            else:
                depths[name].append(len(open_))
                open_.append((name, k))
        elif m["end"]:
            name = m["name"].lower()
            if name in ends:
                ends[name].append(k)
            elif depths.get(name):
                depth = depths[name][-1]
                found[open_[depth][1]] = k + 1, m.end()
                while len(open_) > depth:
                    depths[open_.pop()[0]].pop()
    # From the last head on, since a head inside one ends where that one ends.
    for k in reversed(heads):
        found[k] = _end_of_head(page, tags, k + 1, tags[k].end(), found, ends)
    return found


def _end_of_head(page: str, tags: list[re.Match], k: int, at: int, hidden: dict[int, tuple[int, int]], ends: dict[str, list[int]]) -> tuple[int, int]:
    while True:
        start = tags[k].start() if k < len(tags) else len(page)
        if k == len(tags) or page[at:start].strip():
            return k, at
        m = tags[k]
        name = (m["name"] or "").lower()
        if m["end"] and name == "head":
            return k + 1, m.end()
        if k in hidden:
            if m["hidden"].lower() == "head":
                return hidden[k]
            k, at = hidden[k]
            continue
        if name in ("title", "noframes") and not m["end"]:
            after = bisect.bisect_right(ends[name], k)
            if after == len(ends[name]):
                return k, start
            k = ends[name][after]
            m = tags[k]
        elif m["hidden"] and m["hidden"].lower() not in ("template", "noscript", "head") or name and not m["end"] and name not in IN_HEAD:
            return k, start
        k, at = k + 1, m.end()


def _unclosed(tag: re.Match) -> bool:
    """Whether a match is a comment, or an element of raw text, that lacks its end."""
    if tag["raw"]:
        inside = tag[0][tag[0].index(">") + 1 :]
        return not (inside.endswith(">") and inside[:-1].rstrip().lower().endswith("</" + tag["raw"].lower()))
    return tag[0].startswith("<!--") and (len(tag[0]) < 7 or not tag[0].endswith("-->"))


def blocks_of(page: str) -> list[Block]:
    """All blocks of a whole page in order, hidden elements left out. Broken markup is read as far as it goes; text is never lost to it."""
    found: list[Block] = []
    open_: list[tuple[str, int]] = []  # open elements with the path down to them
    depths: dict[str, list[int]] = {}  # where the open elements of each name are, and those that aren't inline
    walls: list[int] = []
    pieces: list[str] = []
    linked = links = at = 0

    def close() -> None:
        nonlocal linked
        text = "".join(pieces)
        text = " ".join((html.unescape(text) if "&" in text else text).split())
        if text:
            found.append(Block(text, open_[-1][1] if open_ else 0, linked))
        pieces.clear()
        linked = 0

    def end(depth: int) -> None:
        nonlocal links
        while len(open_) > depth:
            name = open_.pop()[0]
            depths[name].pop()
            links -= name == "a"
            if walls and walls[-1] == len(open_):
                walls.pop()

    # Behind the last > only a comment can begin; one without end, or a script, takes in all that follows.
    limit = page.rfind(">") + 1
    tags = list(TAG.finditer(page, 0, limit))
    unclosed = bool(tags) and tags[-1].end() == limit and _unclosed(tags[-1])
    stop = limit if unclosed else page.find("<!--", limit)
    page = page if stop < 0 else page[:stop]
    hidden, next_ = _hidden(page, tags), 0
    for number, m in enumerate(tags):
        if number < next_:
            continue
        start = m.start()
        if start > at:
            pieces.append(page[at:start])
            linked += (start - at) * (links > 0)
        at = m.end()
        if number in hidden:
            next_, at = hidden[number]
            continue
        closing, name, attributes = m.group("end", "name", "attributes")
        if not name:
            continue
        name = name.lower()
        inline = name in INLINE
        if name == "br":
            pieces.append(" ")
        elif not inline and pieces:
            close()
        if name in VOID:
            continue
        if closing:
            # An end tag inside a line doesn't end a block-level element.
            if depths.get(name) and not (inline and walls and walls[-1] > depths[name][-1]):
                end(depths[name][-1])
            continue
        if not inline:
            # A paragraph ends where any block begins, an item where its next one does; what is open inside a line ends with them.
            other = open_[walls[-1]][0] if walls else ""
            if other == "p" or other in CLOSED_BY and CLOSED_BY[other] == CLOSED_BY.get(name):
                end(walls[-1])
        if inline or not attributes.endswith("/"):
            path = open_[-1][1] if open_ else 0
            depths.setdefault(name, []).append(len(open_))
            if not inline:
                walls.append(len(open_))
            open_.append((name, path | _bits(name, attributes)))
            links += name == "a"
    if at < len(page):
        pieces.append(page[at:])
        linked += (len(page) - at) * (links > 0)
    close()
    return found
