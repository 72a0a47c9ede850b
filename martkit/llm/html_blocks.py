"""Web pages as sequences of leaf blocks, and the features that the labeller reads.

A block is the text between two tags that break a line on the page; inline tags do not break it. Each block knows the path
of its open elements, with the words of their classes and ids.
"""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

import numpy as np

BREAKING = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html label legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements without content, and elements whose content is no markup (of which only a title is text).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An element that opens closes these, if it stands in them, up to the nearest of the containers.
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol menu dl table select".split())
#: Roots of content in which ``/>`` ends an element and a title is no title of the page, and what sets its texts apart.
FOREIGN = frozenset(("svg", "math"))
APART = frozenset("title desc text".split())

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|template|textarea)\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>"
    r"|<(?P<end>/?)(?P<name>[a-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*+)>"
    r"|<[!?/][^>]*+>"
    r"|(?P<text>[^<]++|<)",
    re.S | re.I,
)
_RAW_END = {n: re.compile(rf"</{n}\s*+[^>]*+>", re.I) for n in ("script", "style", "template", "textarea")}
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[^\W_]+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int = 0


def blocks(page: str | None) -> list[Block]:
    """All blocks with text, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    linked = links = foreign = at = 0
    page = page or ""

    def flush():
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append(Block(text, tuple(x for _, words in stack for x in words), min(linked, len(text))))
            held.clear()
        linked = 0

    while at < len(page):
        m = _PIECE.match(page, at)
        at = m.end()
        text = m["text"]
        if text is not None:
            text = html.unescape(text)
            held.append(text)
            if links:
                linked += len(text)
            continue
        if m["raw"]:
            if not (foreign and m[0].endswith("/>")):
                end = _RAW_END[m["raw"].lower()].search(page, at)
                at = end.end() if end else len(page)
            continue
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name in FOREIGN:
            if m["end"]:
                foreign = max(0, foreign - 1)
            elif not m["rest"].endswith("/"):
                foreign += 1
            continue
        if foreign and name in APART:
            held.append(" ")
            continue
        if name in BREAKING:
            foreign = 0  # such a tag stands in no drawing or formula: one that is open was never closed
        else:
            if name == "br":
                held.append(" ")
            elif name == "a":
                links = 0 if m["end"] else 1
            continue
        flush()
        if m["end"]:
            if any(n == name for n, _ in stack):
                while stack.pop()[0] != name:
                    pass
            continue
        links = 0
        if name != "p" and stack and stack[-1][0] == "p" or name == "p" and any(n == "p" for n, _ in stack[-1:]):
            stack.pop()
        if name in CLOSES:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in HOLDS:
                    break
                if stack[k][0] in CLOSES[name]:
                    del stack[k:]
                    break
        if name not in VOID:
            words = [w.lower() for found in _NAMED.findall(m["rest"] or "") for w in _WORD.findall("".join(found))]
            stack.append((name, ("<" + name, *("." + w for w in words))))
    flush()
    return out


TAGS, WORDS, NUMBERS = 512, 4096, 5


def hashed(names: list[str], size: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(n.encode("utf-8", "surrogatepass")) % size for n in names), np.int64, len(names))


def features(found: list[Block]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each block the hashed path, the hashed words of its whole text, and some numbers."""
    paths = [hashed(list(b.path) + [f"{len(b.path) and b.path[-1]}^"], TAGS) for b in found]
    words = [b.text.lower().split() for b in found]
    numbers = np.array(
        [(np.log1p(len(w)) / 5, b.linked / max(1, len(b.text)), b.text[-1] in ".!?:\"'", len(b.path) / 10, 1.0) for b, w in zip(found, words)], np.float32
    ).reshape(-1, NUMBERS)
    return paths, [hashed(w, WORDS) for w in words], numbers
