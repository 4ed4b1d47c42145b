"""Statistics of whole texts, for quality rules."""

from __future__ import annotations

import numpy as np

BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 3

# Bytes of the UTF-8 form that feed the shares below.
UPPER, DIGIT, PUNCTUATION = np.zeros(256), np.zeros(256), np.zeros(256)
UPPER[65:91] = DIGIT[48:58] = 1
PUNCTUATION[[ord(c) for c in ".,;:!?"]] = 1

FEATURES = (
    "log_words", "word_length", "symbols_per_word", "duplicate_lines", "repeated_words", "upper_share", "digit_share",
    "punctuation_per_word", "distinct_words", "words_per_line", "longest_word", "top_word", "marks_per_word", "one_sign_words",
)


def numbered(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The words as numbers, and the distinct words in the order of their numbers."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)), list(known)


def repeated_words(ids: np.ndarray, base: int) -> int:
    """Words that stand in a three-word window found twice or more. `ids` are below `base`."""
    n = len(ids)
    if n <= WINDOW:
        return 0
    if base < 2_000_000:  # three numbers fit in 63 bits
        keys = (ids[:-2] * base + ids[1:-1]) * base + ids[2:]
    else:
        keys = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)[1][:-1] * base + ids[2:]
    order = np.argsort(keys, kind="stable")
    equal = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    covered = np.zeros(n, bool)
    for shift in range(WINDOW):
        covered[shift : shift + len(keys)] |= twice
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[str] = set()
    repeated = 0
    for line in text.split("\n"):
        if line in seen:
            repeated += 1
        elif line.strip(BLANKS):
            seen.add(line)
    return repeated


def statistics(text: str) -> tuple[list[int], list[float]]:
    """The base values (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the features, in the order of FEATURES."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # on bytes: exactly the six ASCII blanks
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in BLANKS)
    symbols = sum(text.count(c) for c in SYMBOLS)
    ids, distinct = numbered(words)
    lines, repeats = duplicate_lines(text), repeated_words(ids, len(distinct))
    if not n:
        return [0, chars, symbols, lines, repeats], [0.0] * len(FEATURES)
    tally = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    counts = np.bincount(ids)
    sizes = np.fromiter(map(len, distinct), np.int64, len(distinct))
    n_lines = text.count("\n") + 1
    features = [
        np.log1p(n), chars / n, symbols / n, lines / n_lines, repeats / n, tally @ UPPER / chars, tally @ DIGIT / chars,
        tally @ PUNCTUATION / n, len(distinct) / n, n / n_lines, np.log1p(sizes.max()), counts.max() / n,
        float(tally[33] + tally[34] + tally[39]) / n, counts[sizes == 1].sum() / n,
    ]
    return [n, chars, symbols, lines, repeats], [float(f) for f in features]
