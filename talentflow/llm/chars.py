"""Vectorised character sequences: case, white space, letters, q-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .tokens import U64, Powers, mix, range_hashes

CHAR_POWERS = Powers(0xA0761D6478BD642F)
CHUNK_CHARS = 1 << 19
# Lower case of the characters that have a one-character lower case.
LOWER = np.arange(0x110000, dtype=np.uint32)
for _c in range(0x20000):
    _l = chr(_c).lower() if not 0xD800 <= _c < 0xE000 else ""
    if len(_l) == 1:
        LOWER[_c] = ord(_l)
SPACES = np.array([c for c in range(0x3001) if chr(c).isspace()], np.uint32)
MAY_SPACE = np.zeros(0x3002, bool)
MAY_SPACE[SPACES] = True


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(characters, place of each in the joined input, row bounds) of the texts
    in lower case with every run of white space as one space."""
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    space = MAY_SPACE[np.minimum(raw, 0x3001)]
    again = np.zeros(len(raw), bool)
    again[1:] = space[1:] & space[:-1]
    inner = bounds[:-1][bounds[:-1] < len(raw)]
    again[inner] = False  # a row's first character never continues a run
    place = np.flatnonzero(~again)
    chars = np.where(space[place], np.uint32(0x20), LOWER[raw[place]])
    return chars, place, np.searchsorted(place, bounds)


def q_grams(chars: np.ndarray, bounds: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of every q-gram that stays within its row."""
    n = len(chars) - q + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    ok = np.ones(n, bool)
    for k in range(1, q):  # a q-gram that starts k before a row's end crosses it
        cross = bounds[1:] - k
        ok[cross[(cross >= 0) & (cross < n)]] = False
    at = np.flatnonzero(ok)
    values = mix(chars.astype(U64) + U64(1))
    return range_hashes(values, at, at + q, CHAR_POWERS), at


IS_LETTER = np.zeros(0x110000, bool)
IS_LETTER[[c for c in range(0x33480) if chr(c).isalpha()]] = True


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(characters, row bounds): lower-case letters, every other run as one
    space, with a space before and after each text."""
    raw = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.concatenate([[0], np.cumsum([len(t) + 2 for t in texts])]).astype(np.int64)
    chars = np.where(IS_LETTER[raw], LOWER[raw], np.uint32(0x20))
    blank = chars == 0x20
    again = np.zeros(len(raw), bool)
    again[1:] = blank[1:] & blank[:-1]
    again[bounds[:-1]] = False
    place = np.flatnonzero(~again)
    return chars[place], np.searchsorted(place, bounds)


def chunks(texts: list[str], chunk_chars: int = CHUNK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) in runs of bounded size, or one longer text."""
    at = 0
    while at < len(texts):
        end, size = at + 1, len(texts[at])
        while end < len(texts) and size + len(texts[end]) <= chunk_chars:
            size += len(texts[end])
            end += 1
        yield at, texts[at:end]
        at = end
