"""Splitting texts into words by a vocabulary's pattern, with the standard library's matcher where it agrees."""

from __future__ import annotations

import re
import sys

import regex


def _odd_characters() -> str:
    """A class of the characters that the two matchers sort differently: numbers that are no decimal digits, and separators 28 to 31."""
    odd = [c for c in range(0xA0, sys.maxunicode + 1) if (x := chr(c)).isalnum() and not x.isalpha() and not x.isdecimal()]
    runs: list[list[int]] = []
    for c in odd:
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "[\x1c-\x1f" + "".join(f"{chr(a)}-{chr(b)}" for a, b in runs) + "]"


ODD = re.compile(_odd_characters())
#: The odd characters of Latin-1: a text without others is searched for each, which is faster than the class.
ODD_LATIN = [chr(c) for c in range(256) if ODD.match(chr(c))]


def odd(text: str) -> bool:
    if not text.isascii():
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return ODD.search(text) is not None
    return any(c in text for c in ODD_LATIN)


class Splitter:
    """``exact`` decides; ``quick`` must give the same words for texts without odd characters."""

    def __init__(self, exact: str, quick: str, specials: dict[str, int]):
        self.exact, self.quick = regex.compile(exact).findall, re.compile(quick).findall
        self.specials = specials
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None

    def plain(self, text: str) -> list[str]:
        return self.exact(text) if odd(text) else self.quick(text)

    def words(self, text: str, prepare=lambda t: t) -> list[str]:
        """Words in order; a special token stands for itself behind a zero character."""
        if self.special is None or "<|" not in text or not self.special.search(text):
            return self.plain(prepare(text))
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self.plain(prepare(text[at : m.start()]))
            out.append("\0" + m[0])
            at = m.end()
        return out + self.plain(prepare(text[at:]))
