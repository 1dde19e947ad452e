"""Phrase collocations from FM-indexes over word ids, one index per shard.

A shard is some megabytes of text.  Its words become ids of the shard's own dictionary, its
pieces (text between punctuation) are separated by 0, and two Burrows-Wheeler transforms, of
the words forward and backward, index it.  A phrase is an interval of rows in either; extending
it by a word on the left or on the right moves both intervals along, for all phrases at
once.  Phrases have four words at most, so rows are sorted by four words.

Counts of a phrase are the sums over the shards.  A phrase cannot be more frequent than its
parts, so each length extends only phrases that were frequent over all shards.  Shards learn
these as a bitmap of fixed size over phrase hashes: what it lets pass by accident is counted
in vain and dropped by its sum, and nothing frequent is ever missed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import give_back, written
from marquee.llm.shingles import mixed

LONGEST = 4  # words of a phrase
MIN_COUNT = 30
COVERED = 80  # per cent of a phrase's occurrences that a longer one must have to replace it
TOP = 2000  # phrases reported per language
SHARD_BYTES = 2_000_000  # text of a shard, rounded up to whole texts
EMITTED = 25_000  # rows that a task hands over at a time
BATCH_BYTES = 1_000_000  # of the batches that a task gets, rounded up to whole texts or shards
# A shard is a row group and a page a column of its own.  Parquet looks at sizes after 100 rows unless told
# otherwise; pages with all shards of a task take an executor that reads them up to 700 MB more, outside its heap.
SHARD_FILES = {"parquet.block.size": "1000000", "parquet.page.size.row.check.min": "1", "parquet.enable.dictionary": "false"}
JOINED = 4  # input splits of shards that one task counts, so that phrases add up before they are shuffled
FILTER_BITS = 24  # the bitmap of frequent phrases has 2**FILTER_BITS bits: two megabytes at any size of corpus
UNKNOWN = "und"  # language of rows without one

# A-Z fold to a-z, a tab is a space, and every byte that ends a piece is a line feed.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 9 else 10 if c in b".,;:!?\x0a\x0b\x0c\x0d" else c for c in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _free_at_once() -> None:
    """Arrow's own allocator keeps what a worker has once used; the system's gives it back."""
    pa.set_memory_pool(pa.system_memory_pool())


# --- words of a shard -------------------------------------------------------------------------

def word_codes(texts: list[str]) -> tuple[np.ndarray, list[bytes]]:
    """The words of all texts as codes 1.. into the list of distinct words; 0 ends a piece
    (texts are apart, too)."""
    data = "\n".join(texts).encode().translate(_FOLD).replace(b"\n", b" \n ")
    parts = pc.split_pattern(pa.array([data], pa.large_binary()), b" ").flatten().dictionary_encode()
    words = parts.dictionary.to_pylist()
    code = np.zeros(len(words), dtype=np.int32)
    names = []
    for k, w in enumerate(words):
        if w == b"":
            code[k] = -1
        elif w != b"\n":
            names.append(w)
            code[k] = len(names)
    got = code[parts.indices.to_numpy()]
    return got[got >= 0], names


def word_hash(lang: str, word: bytes) -> int:
    """A word of a language as a 64-bit number."""
    return xxhash.xxh3_64_intdigest(lang.encode() + b"\0" + word)


def shards(batches, limit: int):
    """The texts of Arrow batches (lang, text) by language, some megabytes at a time."""
    held, size = {}, 0
    for b in batches:
        langs, column = b.column(0), b.column(1)
        at = 0
        while at < b.num_rows:  # so many rows as Python strings at a time as fit a shard
            lengths = pc.fill_null(pc.binary_length(column.slice(at)), 0).to_numpy()
            n = max(1, int(np.searchsorted(np.cumsum(lengths), max(1, limit - size))))
            for lang, text in zip(langs.slice(at, n).to_pylist(), column.slice(at, n).to_pylist(), strict=True):
                if text:
                    held.setdefault(UNKNOWN if lang is None else lang, []).append(text)
            size += int(lengths[:n].sum())
            at += n
            if size >= limit:
                yield held
                held, size = {}, 0
                give_back()
    if held:
        yield held
        del held
        give_back()


def count_words(df: DataFrame, lang: str, text: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(lang, word, h, f)``: every word of every language with its number and its count."""
    def run(batches):
        _free_at_once()
        for held in shards(batches, shard_bytes):
            for name, texts in held.items():
                codes, words = word_codes(texts)
                f = np.bincount(codes, minlength=len(words) + 1)[1:]
                for k in range(0, len(words), EMITTED):
                    part = words[k:k + EMITTED]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(part)), pa.array([w.decode() for w in part]),
                                                      pa.array(f[k:k + EMITTED])], ["lang", "word", "f"])

    def numbered(batches):
        for b in batches:
            h = [word_hash(name, w.encode()) for name, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.array(h, dtype=np.uint64).view(np.int64)), b.column(2)],
                                             ["lang", "word", "h", "f"])
    found = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(run, "lang string, word string, f long")
    # numbers are had after the shuffle, in which they would take as much room as the words
    return found.groupBy("lang", "word").agg(F.sum("f").alias("f")).mapInArrow(numbered, "lang string, word string, h long, f long")


# --- the index --------------------------------------------------------------------------------

def _starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


class HalfIndex:
    """One direction: rows are the positions of words ``w`` (0 at both ends) sorted by the
    ``LONGEST`` words that begin there, a piece's end first; ``bwt`` is the word before each,
    ``step`` the row that an interval moves to when that word is put before it."""

    def __init__(self, bwt: np.ndarray, first: np.ndarray):
        self.bwt, self.first = bwt, first  # first[c]: row where words c begin, one more at the end
        # by word, then row: one sort of packed numbers
        order = np.sort((bwt.astype(np.int64) << 32) + np.arange(len(bwt)))
        self.step = np.empty(len(bwt), dtype=np.int32)
        self.step[order & 0xFFFFFFFF] = np.arange(len(bwt), dtype=np.int32)

    @classmethod
    def of(cls, w: np.ndarray, words: int) -> HalfIndex:
        n = len(w)
        padded = np.concatenate([w.astype(np.int64), np.zeros(LONGEST, dtype=np.int64)])
        alive, columns = np.ones(n, dtype=bool), []
        for k in range(LONGEST):
            alive = alive & (padded[k:k + n] > 0)
            columns.append(np.where(alive, padded[k:k + n], 0))
        # pairs of words become ranks, and pairs of ranks the order of four words
        pair = np.unique(columns[0] * (words + 1) + columns[1], return_inverse=True)[1]
        later = np.concatenate([pair, np.zeros(2, dtype=pair.dtype)])[2:]
        later = np.where(columns[2] > 0, later, -1)
        rows = np.argsort((pair.astype(np.int64) << 32) + later + 1)
        before = np.concatenate([[0], w[:-1]]) if n else w
        counts = np.bincount(w, minlength=words + 1)
        return cls(before[rows].astype(np.int32), _starts(counts)[1:])


class Phrases:
    """Phrases of one length in a shard: their words' codes (a row each), and their intervals
    ``[low, low + count)`` in the forward rows and from ``back`` on in the backward rows."""

    def __init__(self, codes, low, back, count):
        self.codes, self.low, self.back, self.count = codes, low, back, count

    def __len__(self) -> int:
        return len(self.count)

    def only(self, keep: np.ndarray) -> Phrases:
        return Phrases(self.codes[keep], self.low[keep], self.back[keep], self.count[keep])


class ShardIndex:
    """The bidirectional index of one shard: ``ahead`` indexes the words as they are read,
    ``behind`` the words backward; ``names`` are the words' 64-bit numbers by code."""

    def __init__(self, names: np.ndarray, ahead: HalfIndex, behind: HalfIndex):
        self.names, self.ahead, self.behind = names, ahead, behind

    @classmethod
    def of(cls, codes: np.ndarray, names: np.ndarray) -> ShardIndex:
        w = np.concatenate([[0], codes, [0]]).astype(np.int32)
        w = w[(w > 0) | (np.concatenate([[1], w[:-1]]) > 0)]  # ends of pieces in a row say no more than one
        return cls(names, HalfIndex.of(w, len(names)), HalfIndex.of(w[::-1], len(names)))

    def words(self) -> Phrases:
        first = self.ahead.first
        return Phrases(np.arange(1, len(self.names) + 1)[:, None], first[:-1], self.behind.first[:-1], np.diff(first))

    def left(self, p: Phrases) -> Phrases:
        """Every phrase of the shard that is one of ``p`` with one more word before it."""
        code, low, back, count, word = _extended(self.ahead, p.low, p.back, p.count)
        return Phrases(np.column_stack([word, p.codes[code]]), low, back, count)

    def right(self, p: Phrases) -> Phrases:
        """Every phrase of the shard that is one of ``p`` with one more word behind it."""
        code, back, low, count, word = _extended(self.behind, p.back, p.low, p.count)
        return Phrases(np.column_stack([p.codes[code], word]), low, back, count)

    def hashes(self, p: Phrases) -> np.ndarray:
        """The words of phrases as 64-bit numbers, a row a phrase."""
        return self.names[p.codes - 1]


def _extended(half: HalfIndex, low: np.ndarray, other: np.ndarray, count: np.ndarray):
    """All intervals of ``half`` extended by every word at once: ``(phrase, low, other, count,
    word)`` of the results.  Rows step to where their word is put before them; rows of one phrase
    and word arrive side by side, as one interval.  In the other direction the result lies
    behind the phrase's ends of pieces and its extensions by smaller words."""
    rows = len(half.bwt)
    label = np.full(rows, -1, dtype=np.int32)
    order = np.argsort(low, kind="stable").astype(np.int32)
    covered = np.repeat(order, count[order])
    shift = (low[order] - (np.cumsum(count[order]) - count[order])).astype(np.int32)
    at = np.repeat(shift, count[order]) + np.arange(len(covered), dtype=np.int32)
    word = half.bwt[at]
    inside = word > 0
    label[half.step[at[inside]]] = covered[inside]
    hit = np.flatnonzero(label >= 0)
    if not len(hit):
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none, none
    owner = label[hit]
    begin = np.searchsorted(half.first, hit, side="right")  # the word whose rows these are
    new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (begin[1:] != begin[:-1]) | (np.diff(hit) > 1)]))
    size = np.diff(np.append(new, len(hit)))
    owner, word, low = owner[new], begin[new], hit[new]
    ends = np.bincount(covered[~inside], minlength=len(count))
    by_owner = np.lexsort((word, owner))
    owner, word, low, size = owner[by_owner], word[by_owner], low[by_owner], size[by_owner]
    before = np.cumsum(size) - size
    heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    before = before - np.repeat(before[heads], np.diff(np.append(heads, len(owner))))
    return owner, low, other[owner] + ends[owner] + before, size, word


# --- bitmaps of what is frequent --------------------------------------------------------------

def phrase_bits(hashes: np.ndarray) -> np.ndarray:
    """The bit of each phrase (a row of word numbers) in the bitmap."""
    h = np.zeros(len(hashes), dtype=np.uint64)
    for j in range(hashes.shape[1]):
        h = mixed(h * _STEP + hashes[:, j])
    return (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def frequent_bitmap(phrases: DataFrame, length: int) -> np.ndarray:
    """The bits of all ``phrases`` (columns h1..): set by tasks, combined by 64-bit words, of
    which there are 2**18 at most whatever the number of phrases."""
    names = [f"h{k + 1}" for k in range(length)]

    def run(batches):
        held = {}
        for b in batches:
            bits = phrase_bits(np.column_stack([c.to_numpy() for c in b.columns]).view(np.uint64))
            at, inverse = np.unique(bits >> 6, return_inverse=True)
            value = np.zeros(len(at), dtype=np.uint64)
            np.bitwise_or.at(value, inverse, np.uint64(1) << (bits & 63).astype(np.uint64))
            for k, v in zip(at.tolist(), value.tolist(), strict=True):
                held[k] = held.get(k, 0) | v
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array(np.array(list(held.values()), dtype=np.uint64).view(np.int64))],
                                             ["at", "bits"])
    got = phrases.select(*names).mapInArrow(run, "at int, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    out[got["at"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return out


def passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = phrase_bits(hashes)
    return (bitmap[bits >> 6] >> (bits & 63).astype(np.uint64)) & np.uint64(1) == 1


# --- shards as a table, and their phrases -----------------------------------------------------

INDEX = "names binary, counts binary, ahead binary, behind binary"


def build_indexes(df: DataFrame, lang: str, text: str, frequent_words: np.ndarray, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard: its dictionary and both transforms as packed integers.  Words that are
    not frequent end a piece, since no phrase with one can be frequent."""
    shared = df.sparkSession.sparkContext.broadcast(frequent_words)

    def run(batches):
        _free_at_once()
        bitmap = shared.value
        for held in shards(batches, shard_bytes):
            codes, names, size = [], [], 0
            for name, texts in held.items():
                c, words = word_codes(texts)
                h = np.array([word_hash(name, w) for w in words], dtype=np.uint64)
                known = passes(bitmap, h[:, None]) if len(h) else np.empty(0, bool)
                number = np.zeros(len(words) + 1, dtype=np.int32)
                number[1:][known] = size + 1 + np.arange(known.sum())
                size += int(known.sum())
                codes += [number[c], np.zeros(1, dtype=np.int32)]
                names.append(h[known])
            index = ShardIndex.of(np.concatenate(codes), np.concatenate(names))
            code = _code_type(len(index.names))
            packed = [index.names, np.diff(index.ahead.first).astype(np.int32), index.ahead.bwt.astype(code), index.behind.bwt.astype(code)]
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in packed], ["names", "counts", "ahead", "behind"])
    return df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(run, INDEX)


def _code_type(words: int):
    """The narrowest integers that hold a shard's codes."""
    return np.uint16 if words < 1 << 16 else np.int32


def _loaded(names: bytes, counts: bytes, ahead: bytes, behind: bytes) -> ShardIndex:
    code = _code_type(len(names) // 8)
    ahead, behind = np.frombuffer(ahead, dtype=code).astype(np.int32), np.frombuffer(behind, dtype=code).astype(np.int32)
    counts = np.frombuffer(counts, dtype=np.int32)
    ends = len(ahead) - int(counts.sum())
    first = ends + _starts(counts)
    return ShardIndex(np.frombuffer(names, dtype=np.uint64), HalfIndex(ahead, first), HalfIndex(behind, first))


def grown(index: ShardIndex, length: int, bitmaps: dict[int, np.ndarray]) -> Phrases:
    """The phrases of ``length`` words whose parts may be frequent: grown to the right, to the
    left and to the right again, and after each step kept where both parts pass."""
    p = index.words()
    for n in range(2, length + 1):
        p = index.left(p) if n == 3 else index.right(p)
        if n - 1 in bitmaps:
            h = index.hashes(p)
            p = p.only(passes(bitmaps[n - 1], h[:, :-1]) & passes(bitmaps[n - 1], h[:, 1:]))
        if n < length and n in bitmaps:
            p = p.only(passes(bitmaps[n], index.hashes(p)))
    return p


def phrase_counts(indexes: DataFrame, length: int, bitmaps: dict[int, np.ndarray], min_count: int) -> DataFrame:
    """``(h1.., f)``: the phrases of ``length`` words counted ``min_count`` times or more over
    all shards, which add up before the shuffle and after it."""
    shared = indexes.sparkSession.sparkContext.broadcast(bitmaps)
    names = [f"h{k + 1}" for k in range(length)]

    def run(batches):
        _free_at_once()
        maps = shared.value
        for b in batches:
            for row in range(b.num_rows):
                index = _loaded(*[b.column(j)[row].as_buffer() for j in range(4)])
                p = grown(index, length, maps)
                h = index.hashes(p).view(np.int64)
                for k in range(0, len(p), EMITTED):
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(h[k:k + EMITTED, j])) for j in range(length)]
                                                     + [pa.array(p.count[k:k + EMITTED])], [*names, "f"])
                del index, p, h
                give_back()
    schema = ", ".join(f"{c} long" for c in [*names, "f"])
    files = indexes.rdd.getNumPartitions()  # so many more shards add up before the shuffle, where cores allow it
    tasks = max(math.ceil(files / JOINED), min(files, indexes.sparkSession.sparkContext.defaultParallelism))
    found = indexes.coalesce(tasks).mapInArrow(run, schema)
    return found.groupBy(*names).agg(F.sum("f").alias("f")).filter(F.col("f") >= min_count)


# --- scores -----------------------------------------------------------------------------------

def scored(words: DataFrame, phrases: dict[int, DataFrame], covered: int) -> DataFrame:
    """``(hs, lang, a, l, r, score, n_left, n_right)`` of the phrases that no longer one replaces."""
    parts = words.select(F.array("h").alias("hs"), "f", "lang")
    for n, p in phrases.items():
        parts = parts.unionByName(p.select(F.array(*[f"h{k + 1}" for k in range(n)]).alias("hs"), "f", F.lit(None).cast("string").alias("lang")))
    every = parts.filter(F.size("hs") > 1).select("hs", F.col("f").alias("a"))
    cuts = every.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("hs") - 1)))
    cuts = cuts.select("hs", "a", "k", F.slice("hs", F.lit(1), F.col("k")).alias("left"),
                       F.slice("hs", F.col("k") + 1, F.size("hs") - F.col("k")).alias("right"))
    cuts = cuts.join(parts.select(F.col("hs").alias("left"), F.col("f").alias("l"), "lang"), "left") \
               .join(parts.select(F.col("hs").alias("right"), F.col("f").alias("r")), "right")
    # whole numbers throughout: 2,000,000 a may leave 64 bits, the quotient does not
    wide = lambda c: F.col(c).cast("decimal(28,0)")
    cuts = cuts.withColumn("score", F.expr("cast(2000000 as decimal(10,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    best = cuts.groupBy("hs", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.max("lang").alias("lang"))

    longer = every.filter(F.size("hs") > 2)
    inside = longer.select(F.slice("hs", F.lit(1), F.size("hs") - 1).alias("hs"), "a", F.lit(1).alias("n_right"), F.lit(0).alias("n_left")) \
        .unionByName(longer.select(F.slice("hs", F.lit(2), F.size("hs") - 1).alias("hs"), "a", F.lit(0).alias("n_right"), F.lit(1).alias("n_left")))
    # a phrase inside one of two more words is also inside one of one more, no less frequent
    around = inside.groupBy("hs").agg(F.max("a").alias("around"), F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))
    kept = best.join(around, "hs", "left").filter(F.col("around").isNull() | (100 * wide("around") < covered * wide("a")))
    return kept.select("hs", "lang", "a", "cut.l", "cut.r", "cut.score",
                       F.coalesce("n_left", F.lit(0)).alias("n_left"), F.coalesce("n_right", F.lit(0)).alias("n_right"))


def collocations(df: DataFrame, lang: str = "lang", text: str = "text", min_count: int = MIN_COUNT,
                 covered: int = COVERED, top: int = TOP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per language its ``top`` phrases of 2 to 4 words: ``lang``, ``rank``, ``phrase``, ``a``, ``l``,
    ``r``, ``n``, ``score`` and the numbers of frequent phrases that extend it by a word on
    either side, ``n_left`` and ``n_right``.

    Texts are cut into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and tabs,
    A-Z in lower case.  ``a`` counts the phrase inside pieces (``min_count`` or more); ``l`` and
    ``r`` count its two parts at the cut with the least ``score = 2,000,000 a / (l + r)``, rounded
    down.  A phrase inside a longer one that has ``covered`` per cent of its occurrences is
    left out.  ``n`` counts the words of the language; ties in score and count go by phrase.

    A NULL language is ``und``, NULL and empty texts have no words, repeated rows count each
    time, whole texts are read whatever their length, an empty table gives no rows, and
    other columns are not looked at.  Two words of one 64-bit number raise an error.
    """
    words = written(count_words(df, lang, text, shard_bytes), "words", BATCH_BYTES)
    frequent = written(words.filter(F.col("f") >= min_count), "frequent-words")
    if frequent.groupBy("h").count().filter("count > 1").limit(1).count():
        raise RuntimeError("two words share a 64-bit number")
    bitmaps = {1: frequent_bitmap(frequent.select(F.col("h").alias("h1")), 1)}
    indexes = written(build_indexes(df, lang, text, bitmaps.pop(1), shard_bytes), "shard-indexes", BATCH_BYTES, SHARD_FILES)
    phrases = {}
    for n in range(2, LONGEST + 1):
        phrases[n] = written(phrase_counts(indexes, n, bitmaps, min_count), f"phrases-{n}", BATCH_BYTES)
        if n < LONGEST:
            bitmaps[n] = frequent_bitmap(phrases[n], n)
    kept = scored(frequent, phrases, covered)

    # texts only for what can be reported: all that tie with the last place come along
    order = [F.col("score").desc(), F.col("a").desc()]
    near = kept.withColumn("__place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("__place") <= top)
    near = written(near.drop("__place"), "near-top")
    spelled = near.select("hs", F.posexplode("hs").alias("at", "h")).join(frequent.select("h", "word"), "h") \
        .groupBy("hs").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda s: s["word"]), " ").alias("phrase"))
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    ranked = near.join(spelled, "hs").withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(*order, F.col("phrase").asc()))).filter(F.col("rank") <= top)
    numbers = ["a", "l", "r", "n", "score", "n_left", "n_right"]
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase",
                                             *[F.col(c).cast("long").alias(c) for c in numbers])
