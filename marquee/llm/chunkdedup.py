"""Substring de-duplication by content-defined chunks.

A gear rolling hash over the bytes of a text places the cuts, so equal passages are cut alike
wherever they stand and an insertion only disturbs the chunks around it.  A chunk whose digest
occurs in an earlier document, or earlier in its own, is a repeat; runs of repeats that are
long enough are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import add_columns
from marquee.llm.shingles import mixed

WINDOW = 16  # bytes that decide a cut
MASK_BITS = 5  # a cut every 2**5 bytes on average, beyond the least size
LEAST, MOST = 16, 128  # bytes of a chunk
MIN_RUN = 64  # bytes of consecutive repeated chunks that are removed

GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of a text's bytes, always between characters."""
    n = len(data)
    if n == 0:
        return []
    b = np.frombuffer(data, dtype=np.uint8)
    h = GEAR[b]
    m = 1
    while m < WINDOW:  # h[i] over 2m bytes: the newer half plus the older one shifted
        h = np.concatenate([h[:m], h[m:] + (h[:-m] << np.uint32(m))])
        m *= 2
    here = ((h >> np.uint32(WINDOW - MASK_BITS)) & np.uint32((1 << MASK_BITS) - 1)) == 0
    begins = (b & 0xC0) != 0x80  # the first byte of a character
    here[:-1] &= begins[1:]
    out, start = [], 0
    for p in (np.flatnonzero(here) + 1).tolist():
        while p - start > MOST:
            start = _character(data, start + MOST)
            out.append(start)
        if p - start >= LEAST:
            out.append(p)
            start = p
    while n - start > MOST:
        start = _character(data, start + MOST)
        out.append(start)
    if start < n:
        out.append(n)
    return out


def _character(data: bytes, p: int) -> int:
    while p < len(data) and data[p] & 0xC0 == 0x80:
        p += 1
    return p


def chunks(data: bytes) -> list[tuple[int, int, bytes]]:
    """``(start, end, digest)`` of each chunk."""
    out, start = [], 0
    for end in cuts(data):
        out.append((start, end, hashlib.blake2b(data[start:end], digest_size=16).digest()))
        start = end
    return out


def chunk_rows(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(doc_id, digest)``: every distinct chunk of a text once."""
    schema = df.select(F.col(doc_id).alias("doc_id"), F.lit(b"").alias("digest")).schema

    def run(batches):
        for b in batches:
            counts, digests = [], []
            for t in b.column(1).to_pylist():
                own = dict.fromkeys(c[2] for c in chunks(t.encode())) if t else ()
                counts.append(len(own))
                digests.extend(own)
            ids = b.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(digests, pa.binary())], names=["doc_id", "digest"])
    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """``df`` with repeated passages removed from ``text`` and ``n_bytes`` (of the input
    text), ``n_chunks``, ``n_repeats`` (chunks found earlier), ``n_removed`` (bytes),
    ``has_repeats`` (something was removed) and ``first_docs`` (ids of the documents that hold
    the first copies of what was removed, sorted, own id included) added.

    The document of least id keeps its copy, later ones lose theirs, and within a document the
    first stays.  NULL and empty texts have no chunks and stay; rows that share an id count
    as one document, so repeated rows read alike; an id of NULL comes last; an empty table
    gives no rows; columns named like an output are replaced.
    """
    names = ("n_bytes", "n_chunks", "n_repeats", "n_removed", "has_repeats", "first_docs")
    keep = [c for c in df.columns if c not in names]
    rows = chunk_rows(df, doc_id, text)
    # one partial row per chunk and task; only chunks of two or more rows go on
    repeated = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    foreign = rows.join(repeated, "digest").filter(~F.col("doc_id").eqNullSafe(F.col("first")))
    per_doc = foreign.select(F.col("doc_id").alias("__doc"), "digest", "first").distinct().groupBy("__doc").agg(
        F.collect_list("digest").alias("__digests"), F.collect_list("first").alias("__firsts"))
    joined = df.select(*keep).join(per_doc, F.col(doc_id).eqNullSafe(F.col("__doc")), "left").drop("__doc")
    id_type = df.schema[doc_id].dataType.simpleString()
    others = [c for c in keep if c != text]

    def make():
        def f(ids, texts, digests, firsts):
            out = [_cleaned(i, t, dict(zip(d or (), s or (), strict=True)), min_run) for i, t, d, s in
                   zip(ids, texts, digests, firsts, strict=True)]
            return tuple(zip(*out, strict=True)) if out else ((),) * 7
        return f
    done = add_columns(joined, [doc_id, text, "__digests", "__firsts"],
                       f"`{text}` string, n_bytes long, n_chunks long, n_repeats long, n_removed long, has_repeats boolean, "
                       f"first_docs array<{id_type}>", make, keep=others)
    return done.select(*keep, *names)


def _cleaned(doc, text, foreign: dict, min_run: int):
    if not text:
        return text, 0, 0, 0, 0, False, []
    data = text.encode()
    own = chunks(data)
    seen, repeats, run, kept, firsts, removed = set(), 0, [], [], set(), 0

    def close():
        nonlocal removed
        if run and run[-1][1] - run[0][0] >= min_run:
            removed += run[-1][1] - run[0][0]
            firsts.update(foreign.get(c[2], doc) for c in run)
        else:
            kept.extend(data[a:b] for a, b, _ in run)
        run.clear()
    for c in own:
        if c[2] in foreign or c[2] in seen:
            repeats += 1
            run.append(c)
        else:
            close()
            kept.append(data[c[0]:c[1]])
            seen.add(c[2])
    close()
    ids = sorted(x for x in firsts if x is not None)
    return b"".join(kept).decode(), len(data), len(own), repeats, removed, removed > 0, ids
