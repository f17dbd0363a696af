"""Leaf blocks of an HTML page: runs of text between block-level tags, with their tag paths.

Unclosed, crossed and unknown tags never fail: an end tag closes the nearest open tag of its name
or nothing, and paragraphs, list items and cells close each other as browsers do. Comments,
scripts, styles and other raw or hidden elements give no text. Character references are decoded;
white space inside a block becomes one blank. A tag that never closes is text.

Time and memory are in proportion to the page, whatever it holds: unclosed tags and quotes are looked
up, not scanned again, and blocks share their paths.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from html import unescape

_OTHER = r"<!--(?:.*?--!?>|.*\Z)|<\?[^>]*+>?|<[!/][^a-zA-Z>][^>]*+>?|<![a-zA-Z][^>]*+>?"
_TAG = re.compile(
    _OTHER + r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|(?P<open></?[a-zA-Z])",
    re.S,
)
_HEAD = re.compile(_OTHER + r"|(?P<open><(?P<close>/?)(?=[a-zA-Z]))", re.S)
_NAME_END = re.compile(r"[\s/>]|\Z")
_MARKS = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[a-z]+")
# Element names of HTML.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "svg", "math", "object", "select"}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {
    "p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
    "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}, "body": {"head"},
}
ENDS_PARAGRAPH = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split())


class Path:
    """The open tags above a block, as a list linked upwards: names, and words of class, id and role."""

    __slots__ = ("parent", "marks", "size", "notes")

    def __init__(self, parent: Path | None = None, marks: tuple[str, ...] = ()):
        self.parent, self.marks, self.notes = parent, marks, {}
        self.size = len(marks) + (parent.size if parent else 0)

    def fold(self, name: str, value, step):
        """``step(value, marks)`` from the top down; remembered under ``name`` at every level."""
        todo, at = [], self
        while at is not None and name not in at.notes:
            todo.append(at)
            at = at.parent
        value = at.notes[name] if at is not None else value
        for at in reversed(todo):
            value = at.notes[name] = step(value, at.marks)
        return value


@dataclass
class Block:
    above: Path
    text: str
    linked: int  # code points inside links

    @property
    def path(self) -> tuple[str, ...]:
        levels, at = [], self.above
        while at is not None:
            levels.append(at.marks)
            at = at.parent
        return tuple(m for marks in reversed(levels) for m in marks)


class _Tags:
    """The tags of a page, from left to right.

    One expression finds them, until it meets a tag that never closes. From there on the ends of names
    and the marks ``> " '`` are looked up, and marks from which no end can be reached are remembered,
    so that no stretch is scanned for every unclosed tag before it.
    """

    def __init__(self, html: str):
        self.html, self.marks, self.dead = html, None, set()
        self.name_begin, self.name_end = 0, -1

    def after(self, at: int) -> tuple[int, int, str | None, str | None, str | None] | None:
        """Begin, end, slash, name and attributes of the first tag from ``at`` on; no name for comments and the like."""
        while self.marks is None:
            found = _TAG.search(self.html, at)
            if found is None:
                return None
            if found["open"] is None:
                return found.start(), found.end(), found["close"], found["name"], found["attributes"]
            self.marks, at = [m.start() for m in _MARKS.finditer(self.html)], found.start()
        while found := _HEAD.search(self.html, at):
            if found["open"] is None:
                return found.start(), found.end(), None, None, None
            begin = found.end()
            if not self.name_begin <= begin <= self.name_end:
                self.name_begin, self.name_end = begin, _NAME_END.search(self.html, begin).start()
            end = self._end(self.name_end)
            if end is not None:
                return found.start(), end, found["close"], self.html[begin : self.name_end], self.html[self.name_end : end - 1]
            at = found.start() + 1
        return None

    def _end(self, at: int) -> int | None:
        """Where the tag ends whose attributes begin at ``at``."""
        i, passed = bisect_left(self.marks, at), []
        while i < len(self.marks) and i not in self.dead:
            passed.append(i)
            mark = self.html[self.marks[i]]
            if mark == ">":
                return self.marks[i] + 1
            other = self.html.find(mark, self.marks[i] + 1)
            if other < 0:
                break
            i = bisect_left(self.marks, other) + 1
        self.dead.update(passed)
        return None


def _mark(name: str, attributes: str) -> tuple[str, ...]:
    if "=" not in attributes:
        return (name,)
    words = [w for m in _ATTRIBUTE.finditer(attributes) for w in _PART.findall(next(filter(None, m.groups()), "").lower())]
    return (name, *("." + w for w in words))


def blocks(html: str | None) -> list[Block]:
    html = html or ""
    out: list[Block] = []
    tags, stack, open_names = _Tags(html), [("", Path())], Counter()
    parts: list[str] = []
    links, linked = 0, 0

    def flush():
        nonlocal linked
        if parts:
            text = "".join(parts)
            parts.clear()
            text = " ".join(text.split())
            if text:
                out.append(Block(stack[-1][1], text, min(linked, len(text))))
        linked = 0

    def add(begin: int, end: int):
        nonlocal linked
        if begin < end:
            text = html[begin:end]
            if "&" in text:
                text = unescape(text)
            parts.append(text)
            if links:
                linked += len(text.strip())

    def pop() -> str:
        name, _ = stack.pop()
        open_names[name] -= 1
        return name

    at = 0
    while found := tags.after(at):
        begin, end, close, name, attributes = found
        add(at, begin)
        at = end
        if name is None:
            continue
        name = name.lower()
        if close:
            if name == "a":
                links = max(0, links - 1)
            if name in INLINE:
                continue
            flush()
            while open_names[name] and pop() != name:
                pass
            continue
        if name == "br":
            parts.append("\n")
            continue
        if name == "a":
            links += 1
        if name in INLINE:
            continue
        flush()
        if name in RAW:
            if not attributes.endswith("/") or name in ("script", "style", "textarea", "title"):
                end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        shut = CLOSES.get(name, {"p"} if name in ENDS_PARAGRAPH else ())
        while shut and stack[-1][0] in shut:
            pop()
        if name not in VOID:
            stack.append((name, Path(stack[-1][1], _mark(name, attributes))))
            open_names[name] += 1
    add(at, len(html))
    flush()
    return out
