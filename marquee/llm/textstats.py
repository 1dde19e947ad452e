"""Statistics of a text, shared by the quality rules and the quality classifier."""

from __future__ import annotations

from collections import Counter

SYMBOLS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"
#: One long each; words are runs without ASCII white space.
FIELDS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_twice", "n_distinct",
          "n_upper", "n_digits", "n_short", "n_bytes")
DDL = ", ".join(f"{f} long" for f in FIELDS)


def repeat_words(words: list[bytes]) -> int:
    """Words inside a 3-word window that occurs twice or more, the first occurrence included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    n = covered = 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            n += i + 3 - max(i, covered)
            covered = i + 3
    return n


def stats(text: str | None) -> tuple[int, ...]:
    """The values of ``FIELDS``; NULL counts like the empty text."""
    if not text:
        return (0,) * len(FIELDS)
    data = text.encode()
    words = data.split()  # splits at exactly the ASCII white space \x20, \x09-\x0D
    spaces = len(data) - sum(map(len, words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    size = len(data)
    return (
        len(words),
        len(text) - spaces,
        size - len(data.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeat_words(words),
        sum(map(bytes.__eq__, words, words[1:])),
        len(set(words)),
        # other capitals and small letters both count as letters only through these ASCII ones
        size - len(data.translate(None, UPPER)),
        size - len(data.translate(None, DIGITS)),
        sum(1 for w in words if len(w) <= 3),
        size,
    )


def make_stats():
    def f(texts):
        rows = [stats(t) for t in texts]
        return tuple(zip(*rows, strict=True)) if rows else ((),) * len(FIELDS)
    return f
