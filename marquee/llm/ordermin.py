"""Document fingerprints by Order MinHash.

A text is the sequence of its k-mers of code points, each numbered by its occurrence (the
second "the cat " is another element than the first).  Each of many hash functions selects the few
elements of least hash, puts them back into their order in the text and hashes that tuple:
one number of the fingerprint.  Texts agree in a number when they share the selected
elements *and their order*, so the share of equal numbers follows edit distance, not only
the overlap of sets.

Fingerprints of a text and of the text with its end replaced are taken together: the common
beginning selects its elements once.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import slices, written
from marquee.llm.shingles import mixed

KMER = 8  # code points of an element
PICKED = 2  # elements of a tuple
TUPLES = 64  # numbers of a fingerprint
PART = 1024  # elements that are hashed at a time
PLACE_BITS = 24  # places that are sorted along with 40 bits of a k-mer; longer texts sort them apart

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MAX = np.uint32(2**32 - 1)
# Odd multipliers: of neighbouring stretches of a k-mer, and the hash functions on elements,
# which are scrambled already.
_WEIGHTS = mixed(np.arange(101, 101 + KMER, dtype=np.uint64)) | np.uint64(1)
MULTIPLIERS = (mixed(np.arange(1, TUPLES + 1, dtype=np.uint64) * _STEP) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def kmers(points: np.ndarray) -> np.ndarray:
    """A 40-bit number for each k-mer; a shorter text is one k-mer, none has none."""
    n = len(points)
    if n < KMER:
        h = np.array([xxhash.xxh3_64_intdigest(points.tobytes())], dtype=np.uint64)[:n]
    else:
        h, width = points.astype(np.uint64), 1
        while 2 * width <= KMER:  # twice the length from two neighbours
            h = h[:-width] * _WEIGHTS[width] + h[width:]
            width *= 2
        for k in range(width, KMER):
            h = h[:n - k] * _WEIGHTS[k] + points[k:]
        h = h * _STEP
    return (h ^ (h >> np.uint64(32))) >> np.uint64(PLACE_BITS)


def numbered(h: np.ndarray) -> np.ndarray:
    """How many equal k-mers lie before each."""
    n = len(h)
    place = np.arange(n, dtype=np.int64)
    if n <= 1 << PLACE_BITS:
        both = np.sort((h << np.uint64(PLACE_BITS)) | place.astype(np.uint64))
        order = (both & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        value = both >> np.uint64(PLACE_BITS)
    else:
        order = np.argsort(h, kind="stable")
        value = h[order]
    first = np.zeros(n, dtype=np.int64)
    np.multiply(place[1:], value[1:] != value[:-1], out=first[1:])
    out = np.empty(n, dtype=np.int64)
    out[order] = place - np.maximum.accumulate(first)
    return out


@dataclass(frozen=True)
class Picks:
    """Per hash function the least values so far, rising, with place and element."""
    value: np.ndarray
    place: np.ndarray
    element: np.ndarray


def picks(elements: np.ndarray, offset: int = 0, known: Picks | None = None) -> Picks:
    """The ``PICKED`` elements of least hash per function, of ``known`` and ``elements``, whose
    places count from ``offset``.  Unused places hold -1."""
    known = known or Picks(np.full((TUPLES, PICKED), _MAX), np.full((TUPLES, PICKED), -1), np.zeros((TUPLES, PICKED), dtype=np.uint64))
    if not len(elements):
        return known
    lines, high = np.arange(TUPLES), (elements >> np.uint64(32)).astype(np.uint32)
    room = np.empty((TUPLES, min(PART, len(elements))), dtype=np.uint32)
    value, place = [], []
    for at in range(0, len(elements), PART):
        part = high[at:at + PART]
        hashed = np.multiply(MULTIPLIERS[:, None], part, out=room[:, :len(part)])
        for _ in range(min(PICKED, len(part))):
            least = hashed.argmin(axis=1)
            value.append(hashed[lines, least])
            place.append(least + at)
            hashed[lines, least] = _MAX
    found = np.stack(place, axis=1)
    value = np.concatenate([known.value, np.stack(value, axis=1)], axis=1)
    place = np.concatenate([known.place, found + offset], axis=1)
    element = np.concatenate([known.element, elements[found]], axis=1)
    rank = (value.astype(np.uint64) + ((place < 0).astype(np.uint64) << np.uint64(32)))  # unused places last
    order = np.argsort(rank, axis=1, kind="stable")[:, :PICKED]  # ties by place
    rows = lines[:, None]
    return Picks(value[rows, order], place[rows, order], element[rows, order])


def signature(best: Picks) -> np.ndarray:
    """The tuples in text order as one 32-bit number each (none for a text without elements)."""
    if (best.place < 0).all():
        return np.empty(0, dtype=np.uint32)
    order = np.argsort(best.place, axis=1, kind="stable")
    rows = np.arange(TUPLES)[:, None]
    element, used = best.element[rows, order], best.place[rows, order] >= 0
    h = np.zeros(TUPLES, dtype=np.uint64)
    for j in range(PICKED):
        h = np.where(used[:, j], mixed(h * _STEP + element[:, j]), h)
    return (h >> np.uint64(32)).astype(np.uint32)


def elements_of(h: np.ndarray, number: np.ndarray) -> np.ndarray:
    return mixed(h + number.astype(np.uint64) * _STEP)


def fingerprint(text: str | None) -> np.ndarray:
    """The fingerprint of a whole text."""
    h = kmers(code_points(text or ""))
    return signature(picks(elements_of(h, numbered(h))))


class Fingerprints:
    """One text: its fingerprint, and what fingerprints of texts with the same beginning need."""

    def __init__(self, text: str):
        self.text, self.points = text, code_points(text)
        self.keep = len(self.points) - len(self.points) // 3  # code points before the replaced end
        h = kmers(self.points)
        elements = elements_of(h, numbered(h))
        # k-mers inside the beginning have the same number in every text that begins like it
        self.shared = max(0, self.keep - KMER + 1) if len(self.points) >= KMER else 0
        self.begun, self.h = picks(elements[:self.shared]), h[:self.shared]
        self.own = signature(picks(elements[self.shared:], self.shared, self.begun))

    def edited(self, following: str) -> tuple[str, np.ndarray]:
        """The text whose last third is replaced by the beginning of ``following``, and its
        fingerprint."""
        third = len(self.points) // 3
        text = self.text[:self.keep] + following[:third]
        points = code_points(text)
        if not self.shared or len(points) < KMER:
            return text, fingerprint(text)
        tail = kmers(points[self.shared:]) if len(points) - self.shared >= KMER else self.h[:0]
        number = numbered(np.concatenate([self.h, tail]))[self.shared:]
        return text, signature(picks(elements_of(tail, number), self.shared, self.begun))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal numbers; two texts without elements are alike, one with none is not."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return float((a == b).mean())


# --- the documents in order -------------------------------------------------------------------

FOUND = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _judged(prints: Fingerprints, following: Fingerprints) -> list:
    text, edited = prints.edited(following.text)
    return [len(prints.points), hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest(), prints.own.tobytes(), edited.tobytes(),
            likeness(prints.own, edited), likeness(prints.own, following.own)]


def document_fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``n_chars``, ``edited_sha256``, ``fingerprint`` and
    ``edited_fingerprint`` (eight hexadecimal digits a number), ``near_edited`` (likeness to the
    edited text's fingerprint) and ``near_next`` (to the next document's).

    The next document is the one after it by falling id, the first after the last.  The edited
    text has its last ``floor(n_chars / 3)`` code points replaced by the first as many of
    the next document's, or by all if it has fewer.

    A NULL text is empty; an empty text has an empty fingerprint, like to another empty one (1)
    and to nothing else (0); a text shorter than a k-mer is one k-mer.  Rows that share an
    id go by a digest of their texts, ids of NULL come last; repeated rows follow one
    another; a single document is its own next one; an empty table gives no rows.

    Texts are shuffled once, into ranges of the order.  A task reads its range as a stream and
    holds two texts; only the last document of each range needs the first of the following
    one, and these few are joined afterwards.
    """
    rows = df.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("id").desc_nulls_last(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        before, first = None, None
        for b in (b for whole in batches for b in slices(whole, ["text"])):
            ids, out = b.column(0), []
            for i, t in zip(ids.to_pylist(), b.column(1).to_pylist(), strict=True):
                now = (i, Fingerprints(t))
                if before is None:
                    first = t
                else:
                    out.append([part, before[0], None, None, *_judged(before[1], now[1])])
                before = now
            yield _batch(out, ids.type)
        if before is not None:  # the last document waits for the next range's first
            yield _batch([[part, before[0], before[1].text, first, *[None] * len(NAMES)]], ids.type)

    placed = written(ranged.mapInArrow(run, f"part int, id {id_type}, last string, first string, {FOUND}"), "fingerprints")
    ends = placed.filter(F.col("last").isNotNull()).select("part", "id", "last", "first")
    # one narrow row per range: each learns the number of the one that follows, the last the first's
    around = Window.orderBy("part")
    ring = ends.select("part", F.coalesce(F.lead("part").over(around), F.first("part").over(around)).alias("following"))
    closed = ends.join(ring, "part").join(ends.select(F.col("part").alias("following"), F.col("first").alias("next")), "following")

    def close(batches):
        for b in batches:
            for k in range(b.num_rows):
                ids, last, following = b.column(0).slice(k, 1), b.column(1)[k].as_py(), b.column(2)[k].as_py()
                values = _judged(Fingerprints(last), Fingerprints(following))
                yield pa.RecordBatch.from_arrays([ids, *_columns([values])], ["id", *NAMES])
    closed = closed.select("id", "last", "next").mapInArrow(close, f"id {id_type}, {FOUND}")
    done = placed.filter(F.col("last").isNull()).select("id", *NAMES).unionByName(closed)
    text_of = lambda c: F.lower(F.hex(c)).alias(c)
    return done.select(F.col("id").alias(doc_id), "n_chars", text_of("edited_sha256"), text_of("fingerprint"),
                       text_of("edited_fingerprint"), "near_edited", "near_next")


def _columns(values: list[list]) -> list[pa.Array]:
    types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
    return [pa.array([v[j] for v in values], t) for j, t in enumerate(types)]


def _batch(rows: list[list], id_type: pa.DataType) -> pa.RecordBatch:
    head = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], id_type),
            pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.string())]
    return pa.RecordBatch.from_arrays([*head, *_columns([r[4:] for r in rows])], ["part", "id", "last", "first", *NAMES])
