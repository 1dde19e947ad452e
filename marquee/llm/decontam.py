"""Benchmark decontamination by suffix arrays of the training documents.

The documents of one Arrow batch form a shard.  Its words become codes of the benchmark's
vocabulary (0 for any other word), and the suffixes that can begin a match are sorted by
their first words: the shard's suffix array.  Every whole window of every benchmark item is
binary searched in it; no longest matches are computed.  Occurrences of whole windows mark the
words of a document that are hit.

The benchmark travels to the tasks in blocks of bounded size; documents are not shuffled.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import add_columns, struct_of, written

WINDOW = 10
BLOCK_BYTES = 8_000_000  # benchmark text that one pass carries to the tasks
SHARD_WORDS = 4_000_000  # words of a shard, rounded up to whole documents

# Everything but digits, letters and non-ASCII bytes separates words; A-Z count as a-z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


class Items:
    """One block of the benchmark: coded words, its suffixes, and its windows."""

    def __init__(self, items, window: int = WINDOW):
        self.window = window
        self.codes: dict[bytes, int] = {}
        rows, owners, whole = [], [], []
        for item_id, text in items:
            code = [self.codes.setdefault(w, len(self.codes) + 1) for w in words_of(text)]
            for at in range(len(code)):
                part = code[at:at + window]
                # a shorter item is one window; the shorter suffixes at the end of others are none
                rows.append(part + [0] * (window - len(part)))
                owners.append(item_id)
                whole.append(len(part) == window or at == 0)
        self.suffixes = np.array(rows, dtype=np.int32).reshape(-1, window)
        self.owners, self.whole = owners, np.array(whole, dtype=bool)
        self.lengths = (self.suffixes > 0).sum(axis=1)


def _numbers(codes: np.ndarray, width: int, base: int) -> np.ndarray:
    """The first ``width`` codes of each row as one number (three codes of a block fit)."""
    out = np.zeros(len(codes), dtype=np.int64)
    for k in range(width):
        out = out * base + codes[:, k]
    return out


def suffix_array(codes: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the suffixes of a shard that can begin a window, sorted by their first
    ``window`` codes, and those codes row by row.  ``codes`` ends documents with 0."""
    w = items.window
    padded = np.concatenate([codes, np.zeros(w, dtype=np.int32)])
    at = np.flatnonzero(codes)
    base = len(items.codes) + 1
    wanted = items.suffixes[items.whole]
    lengths = items.lengths[items.whole]
    for k in range(1, min(w, 3) + 1):
        # windows of fewer than k words must not be lost to longer beginnings
        mine = _numbers(np.stack([padded[at + j] for j in range(k)], axis=1), k, base) if len(at) else np.empty(0, np.int64)
        begins = np.unique(_numbers(wanted[lengths >= k], k, base))
        ok = _in(mine, begins)
        for short in range(1, k):
            if (lengths == short).any():
                ok |= _in(_numbers(np.stack([padded[at + j] for j in range(short)], axis=1), short, base),
                          np.unique(_numbers(wanted[lengths == short], short, base)))
        at = at[ok]
    rows = np.stack([padded[at + j] for j in range(w)], axis=1) if len(at) else np.empty((0, w), np.int32)
    order = np.lexsort(rows.T[::-1]) if len(at) else np.empty(0, np.int64)
    return at[order], rows[order]


def _in(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), dtype=bool)
    i = np.searchsorted(among, values)
    i[i == len(among)] = 0
    return among[i] == values


def search(rows: np.ndarray, suffixes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix the range ``[low, high)`` of the sorted ``rows`` that begin with its
    first ``lengths`` codes (binary search, one code deeper at a time)."""
    low = np.zeros(len(suffixes), dtype=np.int64)
    high = np.full(len(suffixes), len(rows), dtype=np.int64)
    for d in range(suffixes.shape[1]):
        live = np.flatnonzero((lengths > d) & (low < high))
        if not len(live):
            break
        code = suffixes[live, d]
        low[live], high[live] = _bound(rows[:, d], low[live], high[live], code), _bound(rows[:, d], low[live], high[live], code + 1)
    return low, high


def _bound(column: np.ndarray, low: np.ndarray, high: np.ndarray, code: np.ndarray) -> np.ndarray:
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        right = open_ & (column[np.minimum(mid, len(column) - 1)] < code)
        low = np.where(right, mid + 1, low)
        high = np.where(open_ & ~right, mid, high)
    return low


def matches(texts, items: Items):
    """For each text ``(n_words, spans, item ids)``: the word spans ``[start, end)`` of maximal
    runs of hit words and the items with a window in it, in order."""
    out, codes, starts, size = [], [], [], 0
    get = items.codes.get

    def shard():
        nonlocal codes, starts, size
        flat = np.zeros(size + len(codes), dtype=np.int32)
        first, at = [], 0
        for c in codes:
            first.append(at)
            flat[at:at + len(c)] = c
            at += len(c) + 1
        places, rows = suffix_array(flat, items)
        w = np.flatnonzero(items.whole)
        # equal windows are searched once
        distinct, back = np.unique(items.suffixes[w], axis=0, return_inverse=True) if len(w) else (np.empty((0, items.window), np.int32), [])
        back = np.asarray(back).reshape(-1)
        lengths = (distinct > 0).sum(axis=1)
        low, high = search(rows, distinct, lengths)
        owners: dict[int, set] = {}
        for k, i in enumerate(w):
            if low[back[k]] < high[back[k]]:
                owners.setdefault(int(back[k]), set()).add(items.owners[i])
        delta = np.zeros(len(flat) + 1, dtype=np.int32)
        found: dict[int, set] = {}
        first_a = np.array(first, dtype=np.int64)
        for k, ids in owners.items():
            hit = places[low[k]:high[k]]
            np.add.at(delta, hit, 1)
            np.add.at(delta, hit + lengths[k], -1)
            for doc in np.unique(np.searchsorted(first_a, hit, side="right") - 1):
                found.setdefault(int(doc), set()).update(ids)
        covered = np.cumsum(delta[:-1]) > 0
        for doc, c in enumerate(codes):
            spans = []
            if doc in found:
                edge = np.diff(np.concatenate([[0], covered[first[doc]:first[doc] + len(c)].astype(np.int8), [0]]))
                spans = [(int(a), int(b)) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
            out.append((len(c), spans, sorted(found.get(doc, ()))))
        codes, size = [], 0

    for t in texts:
        words = words_of(t)
        codes.append(np.fromiter((get(w, 0) for w in words), dtype=np.int32, count=len(words)))
        size += len(words)
        if size >= SHARD_WORDS:
            shard()
    if codes:
        shard()
    return out


SPANS = "array<struct<start:int,end:int>>"


def _find(df: DataFrame, block, text: str, window: int, keep) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(block)

    def make():
        items = Items(shared.value, window)

        def f(texts):
            got = matches(texts, items)
            return ([g[0] for g in got], [[{"start": a, "end": b} for a, b in g[1]] for g in got], [g[2] for g in got])
        return f
    return add_columns(df, [text], f"__words long, __spans {SPANS}, __items array<string>", make, keep)


def _benchmark_blocks(benchmark: DataFrame, item_id: str, item_text: str, block_bytes: int) -> list:
    """Functions that each fetch one block of the benchmark, ``[(id, text)]``, of about
    ``block_bytes``."""
    items = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("i"), F.col(item_text).alias("t")) \
                     .filter(F.col("t").isNotNull())
    total = items.agg(F.coalesce(F.sum(F.octet_length("t") + F.octet_length("i")), F.lit(0))).first()[0]
    blocks = -(-total // block_bytes) or 1

    def block(k: int):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k)
        return [(r["i"], r["t"]) for r in part.collect()]
    return [lambda k=k: block(k) for k in range(blocks)]


def find_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", window: int = WINDOW, keep=None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``df`` with ``n_words``, ``n_hit`` (words inside an occurrence of a window of
    ``window`` item words; a shorter item is one window), ``leak_spans`` (maximal runs of hit
    words, ``[start, end)``), ``leak_items`` (ids of the items found, sorted as text) and
    ``contaminated``.

    NULL and empty texts have no words and match nothing; items without words have no
    window; repeated rows are each marked; an item id of NULL is written ``null``; empty
    tables are fine, and columns named like an output are replaced.  A benchmark within
    ``block_bytes`` takes one pass over the documents.  A larger one takes a pass for each
    block; the hits of a pass, keyed by the text's digest, are written and joined at the end.
    """
    names = ("n_words", "n_hit", "leak_spans", "leak_items", "contaminated")
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    blocks = _benchmark_blocks(benchmark, item_id, item_text, block_bytes)

    if len(blocks) == 1:
        found = _find(df, blocks[0](), text, window, kept)
    else:
        texts = df.select(F.col(text).alias("__text"), F.sha2(F.col(text), 256).alias("__digest"))
        hits = []
        for block in blocks:
            part = _find(texts, block(), "__text", window, ["__digest"]).filter(F.size("__items") > 0)
            hits.append(written(part.select("__digest", "__spans", "__items").dropDuplicates(["__digest"]), "leaks"))
        union = hits[0]
        for h in hits[1:]:
            union = union.unionByName(h)
        per_text = union.groupBy("__digest").agg(
            F.flatten(F.collect_list("__spans")).alias("__all"), F.array_sort(F.flatten(F.collect_set("__items"))).alias("__items"))
        per_text = per_text.select("__digest", "__items", _union_of_spans("__all").alias("__spans"))
        counted = _find(df, [], text, window, kept + ([text] if text not in kept else [])).drop("__spans", "__items")
        counted = counted.withColumn("__digest", F.sha2(F.col(text), 256))
        found = counted.join(per_text, "__digest", "left").select(
            *kept, "__words", F.coalesce("__spans", F.array().cast(SPANS)).alias("__spans"),
            F.array_distinct(F.coalesce("__items", F.array().cast("array<string>"))).alias("__items"))
    n_hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(*kept, F.col("__words").alias("n_words"), n_hit.alias("n_hit"), F.col("__spans").alias("leak_spans"),
                        F.col("__items").alias("leak_items"), (F.size("__items") > 0).alias("contaminated"))


def _union_of_spans(spans: str):
    """Overlapping or touching spans merged."""
    empty = F.array().cast(SPANS)

    def step(done, s):
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return (F.when(last.isNotNull() & (s["start"] <= last["end"]),
                       F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined)))
                .otherwise(F.concat(done, F.array(s))))
    return F.aggregate(F.array_sort(spans), empty, step)


def remove_leaked(df: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents without any window of the benchmark, with their own columns.  Only texts
    go to Python, and one truth value each comes back."""
    for block in _benchmark_blocks(benchmark, "item_id", "text", BLOCK_BYTES):
        df = df.filter(~_hit(df, block(), text, window))
    return df


def _hit(df: DataFrame, block, text: str, window: int) -> Column:
    shared = df.sparkSession.sparkContext.broadcast(block)

    def make():
        items = Items(shared.value, window)
        return lambda texts: ([bool(g[2]) for g in matches(texts, items)],)
    return struct_of(F.col(f"`{text}`"), "hit boolean", make)["hit"]
