"""One pass over the source of a page: its tags and texts, in time proportional to its length.

A tag ends at the first ``>`` outside quoted values; one that has none ends at its next ``>``, and where no ``>``
follows the rest is text. Where the tag of a quote ends is worked out once for every quote, so unclosed quotes and tags
cost no second look. Scripts, styles and comments give no token.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

# What a page repeats around its content, and elements that start a line.
BOILERPLATE = frozenset("nav header footer aside form noscript".split())
BLOCKS = frozenset(
    "p div br li ul ol h1 h2 h3 h4 h5 h6 tr td table section article main blockquote pre dd dt".split()
)

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_EVENT = re.compile("[>\"']")
_SPACE = re.compile(r"\s+")
_HIDDEN_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style")}
_TITLE_END = re.compile("</title", re.I)
# Attributes one after the other, each with its value.
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

TEXT, OPEN, CLOSE = range(3)
# Kind, name (of a tag) or None, start and end of the text or of what stands in the tag after its name.
Token = tuple[int, "str | None", int, int]


def _tag_end(source: str, at: int, ends: dict[int, int]) -> int:
    """Place of the ``>`` of a tag from inside it, -1 where its quotes leave none."""
    seen, end = [], -1
    while event := _EVENT.search(source, at):
        at = event.start()
        if source[at] == ">":
            end = at
            break
        if at in ends:
            end = ends[at]
            break
        seen.append(at)
        close = source.find(source[at], at + 1)
        if close < 0:
            break
        at = close + 1
    for quote in seen:
        ends[quote] = end
    return end


def tokens(source: str) -> Iterator[Token]:
    """Texts and tags in order; comments and declarations are tags without a name."""
    last = source.rfind(">")
    ends: dict[int, int] = {}
    start = at = 0
    while True:
        at = source.find("<", at)
        if at < 0:
            break
        if source.startswith("<!--", at):
            close = source.find("-->", at + 4)
            if at > start:
                yield TEXT, None, start, at
            if close < 0:
                return
            start = at = close + 3
            continue
        closing = source.startswith("/", at + 1)
        found = _NAME.match(source, at + 1 + closing)
        if not found and source[at + 1 + closing : at + 2 + closing] not in ("!", "?"):
            at += 1
            continue
        inside = found.end() if found else at + 2
        name = found.group().lower() if found else None
        hidden = _HIDDEN_END.get(name) if not closing else None
        end = _tag_end(source, inside, ends) if at < last else -1
        if end < 0:
            end = source.find(">", at)
        if end < 0:
            if hidden:
                if at > start:
                    yield TEXT, None, start, at
                return
            break
        if at > start:
            yield TEXT, None, start, at
        if hidden:
            close = hidden.search(source, end + 1)
            if not close:
                return
            end = close.end() - 1
        else:
            yield (CLOSE if closing else OPEN), name, inside, end
        start = at = end + 1
    if start < len(source):
        yield TEXT, None, start, len(source)


def attributes(source: str, start: int, end: int) -> dict[str, str]:
    """Names (in lower case) and values as written, of the first of each name."""
    found: dict[str, str] = {}
    for match in _ATTRIBUTE.finditer(source, start, end):
        found.setdefault(match[1].lower(), (match[2] or "").strip("\"'") if match[2] and match[2][0] in "\"'" else match[2] or "")
    return found


def visible(source: str) -> str:
    """All text, with a blank for each tag; references as written."""
    return "".join(source[start:end] if kind == TEXT else " " for kind, _, start, end in tokens(source))


def hrefs(source: str) -> list[str]:
    """Targets of all anchors, as written."""
    found = (attributes(source, start, end).get("href") for kind, name, start, end in tokens(source) if kind == OPEN and name == "a")
    return [href for href in found if href]


def metadata(source: str) -> dict[str, str | None] | None:
    """Raw language, title, description and keywords; None without an html tag."""
    root, title, named = None, None, {}
    for kind, name, start, end in tokens(source):
        if kind != OPEN:
            continue
        if name == "html" and root is None:
            root = attributes(source, start, end)
        elif name == "title" and title is None:
            close = _TITLE_END.search(source, end + 1)
            title = source[end + 1 : close.start()] if close else ""
        elif name == "meta":
            held = attributes(source, start, end)
            named.setdefault(held.get("name", "").lower(), held.get("content", ""))
    if root is None:
        return None
    return {"lang": root.get("lang"), "title": title, "description": named.get("description"), "keywords": named.get("keywords")}


def _framed(found: list[Token]) -> list[bool]:
    """Whether each token lies in an element of ``BOILERPLATE`` that is closed; unclosed ones are not elements."""
    depth = [0] * (len(found) + 1)
    opened: dict[str, list[int]] = {}
    for i, (kind, name, _, _) in enumerate(found):
        if name in BOILERPLATE:
            if kind == OPEN:
                opened.setdefault(name, []).append(i)
            elif opened.get(name):
                depth[opened[name].pop()] += 1
                depth[i + 1] -= 1
    held, out = 0, []
    for i in range(len(found)):
        held += depth[i]
        out.append(held > 0)
    return out


def _scope(found: list[Token]) -> tuple[int, int]:
    """Tokens of the main part: from the first article to the end of the last, else of the body, else all."""
    opens: dict[str, int] = {}
    article = body = 0
    for i, (kind, name, _, _) in enumerate(found):
        if kind == OPEN:
            opens.setdefault(name, i)
        elif kind == CLOSE and name == "article":
            article = i
        elif kind == CLOSE and name == "body" and "body" in opens and not body:
            body = i
    first = opens.get("article", len(found))
    if first + 1 < article:
        return first + 1, article
    if "body" in opens and opens["body"] + 1 < (body or len(found)):
        return opens["body"] + 1, body or len(found)
    return 0, len(found)


def blocks(source: str) -> list[dict]:
    """Lines of the main part: text with references as written, its characters, and those of them in links."""
    found = list(tokens(source))
    if any(name in BOILERPLATE for _, name, _, _ in found):
        found = [token for token, framed in zip(found, _framed(found)) if not framed]
    first, stop = _scope(found)
    out: list[dict] = []
    parts: list[str] = []
    chars = linked = open_links = 0

    def close() -> None:
        nonlocal chars, linked
        if chars:
            out.append({"text": "".join(parts), "chars": chars, "linked": linked})
        parts.clear()
        chars = linked = 0

    for kind, name, start, end in found[first:stop]:
        if kind == TEXT:
            text = _SPACE.sub(" ", source[start:end])
            parts.append(text)
            size = len(text) - text.count(" ")
            chars += size
            linked += size if open_links else 0
        elif name == "a":
            # A link inside a link ends it.
            open_links = int(kind == OPEN)
        elif name in BLOCKS:
            close()
    close()
    return out
