"""Cutting a text into the pieces within which byte-level merges happen."""

from __future__ import annotations

import re

import regex

# Fixed value: the public pattern of byte-level BPE vocabularies.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# The same with its classes written out for texts of ASCII and the letters of Latin-1 only, where the
# standard library's engine is faster.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
SPACES = r"\t-\r "
LATIN_PIECES = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^{SPACES}{LETTERS}0-9]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)

_cut_any = regex.compile(PIECES).findall
_cut_latin = re.compile(LATIN_PIECES).findall
_beyond_latin = re.compile("[^\0-\x7fÀ-ÖØ-öø-ÿ]").search


def cut(text: str) -> list[str]:
    """All matches of the pattern, in order; together they are the text."""
    if text.isascii() or not _beyond_latin(text):
        return _cut_latin(text)
    return _cut_any(text)
