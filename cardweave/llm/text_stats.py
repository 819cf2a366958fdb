"""Counts over one text that several operators use."""

from __future__ import annotations

import numpy as np

#: ASCII white space, as bytes.
SPACE = b" \t\n\v\f\r"
#: Marks that junk is full of.
SYMBOLS = b"#*$%&|<>"
#: Words of a window whose repeats are counted.
REPEAT = 5


def repeated_words(words: list[bytes], width: int = REPEAT) -> int:
    """Words that lie in a window of ``width`` words found twice or more, the first included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    if len(number) == len(words):
        return 0
    key, span = ids[:n].copy(), len(number)
    for k in range(1, width):
        if span * len(number) >= 1 << 62:  # number the distinct keys anew, so that they stay exact
            key = np.unique(key, return_inverse=True)[1]
            span = int(key.max()) + 1
        key = key * len(number) + ids[k:n + k]
        span *= len(number)
    ascending = np.sort(key)
    twice = ascending[1:][ascending[1:] == ascending[:-1]]
    if not len(twice):
        return 0
    spot = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    starts = np.flatnonzero(twice[spot] == key)
    steps = np.zeros(len(words) + 1, np.int64)
    steps[starts] += 1
    steps[starts + width] -= 1
    return int((np.cumsum(steps[:-1]) > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    return len(lines) - len(set(lines))
