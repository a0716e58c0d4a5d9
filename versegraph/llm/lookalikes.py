"""Characters that look alike. Tables of Unicode facts, and the rules that widen them."""

from __future__ import annotations

import unicodedata

# Greek and Cyrillic letters and the Latin letter that each looks like (a part of the public Unicode confusables data, UTS 39).
GREEK = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "ι": "i", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "χ": "x", "ϲ": "c", "ϳ": "j",
}
CYRILLIC = {
    "А": "A", "В": "B", "Е": "E", "З": "3", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ӏ": "l",
}
# Characters without a width.
INVISIBLE = "​‌‍‎‏⁠⁡⁢⁣⁤﻿­͏؜᠎‪‫‬‭‮⁦⁧⁨⁩"
# Spaces that look like the ordinary one.
SPACES = "               　"
# Hyphens that look like the ordinary one.
HYPHENS = "‐‑﹣"


def fullwidth() -> dict[str, str]:
    """Full-width form -> ASCII; both blocks run in the same order."""
    return {chr(c + 0xFEE0): chr(c) for c in range(0x21, 0x7F)}


def compatible() -> dict[str, str]:
    """Roman numeral characters and mathematical letters and digits -> the plain letters they are compatible with, by Unicode's own decomposition."""
    pairs = ((chr(c), unicodedata.normalize("NFKC", chr(c))) for c in (*range(0x2160, 0x2180), *range(0x1D400, 0x1D800)))
    return {c: plain for c, plain in pairs if plain != c and plain.isascii() and plain.isalnum()}


def to_latin() -> dict[str, str]:
    """Every look-alike letter, full-width form and odd space -> its plain character."""
    return GREEK | {k: v for k, v in CYRILLIC.items() if v.isalpha()} | fullwidth() | dict.fromkeys(SPACES, " ") | dict.fromkeys(HYPHENS, "-")
