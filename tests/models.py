"""Plain-Python models of the three analytics, written from the documented semantics."""

import bisect
import math
from collections import Counter


def py_strip_key(s):
    return s.strip()


def model_avg(rows, min_count=50):
    """rows: (genre, rating) -> {genre: (avg_text, n)}"""
    acc = {}
    for genre, rating in rows:
        if genre is None or rating is None:
            continue
        g = genre.strip()
        if not g or not rating > 0:
            continue
        s, n = acc.get(g, (0.0, 0))
        acc[g] = (s + rating, n + 1)
    return {g: ("{:.2f}".format(s / n), n) for g, (s, n) in acc.items() if n >= min_count}


def model_topk(rows, k=10):
    """rows: dicts with movie_id, title, year, votes, rating, fetched_at, genre (+ others).

    First by (fetched_at, genre, then what the result shows) per id, NULLs last; then
    validation as the mapper reads a silver line; votes desc, id asc.
    """
    def key(r):
        order = ["fetched_at", "genre", "title", "year", "votes", "rating"]
        return tuple((r[c] is None, r[c] if r[c] is not None else 0) for c in order)
    first = {}
    for r in rows:
        cur = first.get(r["movie_id"])
        if cur is None or key(r) < key(cur):
            first[r["movie_id"]] = r
    by_year = {}
    for r in first.values():
        # a silver line omits NULL fields: a missing key reads as the mapper's default
        line = {c: v for c, v in r.items() if v is not None}
        year, votes = int(line.get("year", 0)), int(line.get("votes", 0))
        if year <= 0 or votes <= 0:
            continue
        by_year.setdefault(year, []).append((r["movie_id"], votes, line.get("title", "").strip(),
                                             float(line.get("rating", 0))))
    out = []
    for y, rs in by_year.items():
        rs.sort(key=lambda r: (-r[1], (r[0] is None, r[0] or 0)))
        for i, (_, votes, title, rating) in enumerate(rs[:k], 1):
            out.append((y, i, title[:50], votes, "{:.1f}".format(rating)))
    return sorted(out)


LABELS = ["0-2", "2-4", "4-6", "6-8", "8-10"]


EDGES = [2, 4, 6, 8]


def model_hist(ratings):
    """A rating's bucket is the number of edges at or below it (NaN passes them all)."""
    positive = [r for r in ratings if r is not None and (math.isnan(r) or r > 0)]
    place = Counter(len(EDGES) if math.isnan(r) else bisect.bisect_right(EDGES, r) for r in positive)
    share = [place[i] / len(positive) * 100 if positive else 0.0 for i in range(len(LABELS))]
    return [(label, place[i], f"{share[i]:.2f}") for i, label in enumerate(LABELS)]
