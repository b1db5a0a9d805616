"""Character classes of the tokenizer patterns, built from the Unicode tables of the interpreter."""

from __future__ import annotations

import functools
import re
import sys
import unicodedata

# White space as the tokenizer patterns see it: the information separators U+001C..U+001F are not part of it.
_SEPARATORS = range(0x1C, 0x20)
#: Regular expressions are several times faster over classes that end here, and few texts go beyond.
_PLANE = 0xFFFF


def _ranges(belongs, top: int) -> str:
    """The body of a character class holding every code point up to ``top`` that belongs."""
    spans, start = [], None
    for point in range(top + 2):
        inside = point <= top and belongs(point)
        if inside and start is None:
            start = point
        elif not inside and start is not None:
            spans.append((start, point - 1))
            start = None
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in spans)


@functools.cache
def classes(top: int = _PLANE) -> dict[str, str]:
    """Class bodies: ``L`` letters, ``N`` numbers, ``S`` white space, ``X`` code points these tables do not know."""
    kind = [unicodedata.category(chr(p)) for p in range(top + 1)]
    return {
        "L": _ranges(lambda p: kind[p][0] == "L", top),
        "N": _ranges(lambda p: kind[p][0] == "N", top),
        "S": _ranges(lambda p: chr(p).isspace() and p not in _SEPARATORS, top),
        "X": _ranges(lambda p: kind[p] == "Cn", top),
    }


@functools.cache
def _unknown(top: int) -> re.Pattern:
    return re.compile(f"[{classes(top)['X']}]")


_BEYOND_LATIN = re.compile("[^\\x00-\\u024f]")  # every code point below is known
_BEYOND_PLANE = re.compile("[\\U00010000-\\U0010ffff]")


def _top(text: str) -> int:
    return sys.maxunicode if not text.isascii() and _BEYOND_PLANE.search(text) else _PLANE


def all_known(text: str) -> bool:
    """Whether these tables know every code point; a text with newer ones is left to the tokenizer's own splitter."""
    return text.isascii() or not _BEYOND_LATIN.search(text) or not _unknown(_top(text)).search(text)


@functools.cache
def _spaced(top: int) -> re.Pattern:
    c = classes(top)
    letters, numbers, space = c["L"], c["N"], c["S"]
    return re.compile(
        f" ?[{letters}]+|'(?:s|t|re|ve|m|ll|d)| ?[{numbers}]+| ?[^{letters}{numbers}{space}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


@functools.cache
def _bare(top: int) -> re.Pattern:
    c = classes(top)
    letters, numbers, space = c["L"], c["N"], c["S"]
    return re.compile(f"[{letters}]+|'(?:s|t|re|ve|m|ll|d)|[{numbers}]|[^{letters}{numbers}{space}]+")


def spaced_words(text: str) -> list[str]:
    """Pre-tokens that carry the space before them: contractions, letters, numbers, other signs, white space."""
    return _spaced(_top(text)).findall(text)


def bare_words(text: str) -> list[str]:
    """Pre-tokens without white space: letters, contractions, single numbers, runs of other signs."""
    return _bare(_top(text)).findall(text)


@functools.cache
def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
