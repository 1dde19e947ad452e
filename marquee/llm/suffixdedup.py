"""Repeated byte strings by a distributed difference-cover suffix sort.

Every start of a string of ``LENGTH`` bytes belongs to one sampled position: the least of the
hashed k-grams in the string, which two equal strings have at the same place.  The sampled
positions are sorted first: only where a sample's k-gram occurs twice can a string repeat.
The remaining starts are merged in behind their sample: each is named by triples of names of
triples (3, 9, 27, 81 bytes, then three names that overlap to cover the string), the names of
one sample are sorted together, and adjacent strings are compared byte by byte.

Names are digests, so the recursion runs where the text lies and no ranks travel.  Stretches
of starts that recur as a whole are settled by one digest; copies meet before they are sent.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import add_columns, written
from marquee.llm.shingles import mixed

LENGTH = 200
GRAM = 32
# Distinct stretches (rows of contexts) of a sample beyond which its starts are counted instead of grouped: a group
# of this many is 3 MB of text and about 100 MB of working arrays in its task.
HOT = 8_000
BATCH = 4_000  # stretches whose starts are sorted at once

_MUL = np.uint64(6364136223846793005)
_SEED = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-byte substrings, k a power of two."""
    h, m, mul = b.astype(np.uint64) + np.uint64(1), 1, int(_MUL)
    while m < k:
        h = h[:-m] * np.uint64(mul) + h[m:]
        mul = mul * mul % 2**64
        m *= 2
    return mixed(h + _SEED)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    m = 1
    y = x
    while 2 * m <= w:
        y = np.minimum(y[:-m], y[m:])
        m *= 2
    return np.minimum(y[:len(y) - (w - m)], y[w - m:]) if m < w else y


def stretches(data: bytes, length: int = LENGTH, gram: int = GRAM):
    """The starts of all strings of ``length`` bytes in maximal runs with the same sample:
    arrays ``(first start, number of starts, sample - first start, sample hash)``."""
    if len(data) < length:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    h = gram_hashes(np.frombuffer(data, dtype=np.uint8), gram)
    w = length - gram + 1
    least = sliding_min(h, w)
    # the sample of a start is the first position at or after it that holds its minimum
    change = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    ends = np.concatenate([change[1:], [len(least)]])
    lo, n, off, hashes = [], [], [], []
    for a, e in zip(change.tolist(), ends.tolist(), strict=True):
        value = least[a]
        while a < e:  # equal k-grams may follow each other under one minimum
            p = a + int(np.argmax(h[a:a + w] == value))
            stop = min(e, p + 1)
            lo.append(a)
            n.append(stop - a)
            off.append(p - a)
            hashes.append(value)
            a = stop
    return np.array(lo), np.array(n), np.array(off), np.array(hashes, dtype=np.uint64)


def text_key(data: bytes) -> tuple[int, int]:
    """96 bits that stand for a text."""
    d = xxhash.xxh3_128_intdigest(data)
    return (d & (2**64 - 1)) - 2**63, (d >> 64) % 2**31


def sample_rows(df: DataFrame, text: str, hashes_only: bool) -> DataFrame:
    """A row per stretch: the sample's hash ``h``; unless ``hashes_only`` also the digest of
    the stretch's bytes ``seg``, the text's key ``k1, k2`` and ``loc`` (first start, number of
    starts and offset of the sample packed into one number)."""
    names = ["h"] if hashes_only else ["h", "seg", "k1", "k2", "loc"]

    def run(batches):
        for b in batches:
            out = {n: [] for n in names}
            for t in b.column(0).to_pylist():
                data = t.encode() if t else b""
                lo, n, off, h = stretches(data)
                if not len(lo):
                    continue
                out["h"].append(h.view(np.int64))
                if hashes_only:
                    continue
                k1, k2 = text_key(data)
                ends = lo + n + LENGTH - 1
                out["seg"].append(np.array([xxhash.xxh3_64_intdigest(data[a:e], seed=int(o)) for a, e, o in
                                            zip(lo.tolist(), ends.tolist(), off.tolist(), strict=True)], dtype=np.uint64).view(np.int64))
                out["k1"].append(np.full(len(lo), k1, dtype=np.int64))
                out["k2"].append(np.full(len(lo), k2, dtype=np.int32))
                out["loc"].append((lo.astype(np.int64) << 16) | ((n - 1) << 8) | off)
            empty = {"k2": np.int32}
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v) if v else np.empty(0, empty.get(k, np.int64)))
                                              for k, v in out.items()], names=names)
    schema = "h long" if hashes_only else "h long, seg long, k1 long, k2 int, loc long"
    return df.select(text).mapInArrow(run, schema)


def names_of(b: np.ndarray, starts: int) -> np.ndarray:
    """Names of the first ``starts`` strings of ``LENGTH`` bytes: triples, triples of their
    names, and so on up to 81 bytes, then three that cover the string."""
    name = b.astype(np.uint64) + np.uint64(1)
    size = 1
    while size < 81:
        n = len(name) - 2 * size
        name = mixed(mixed(name[:n] * _MUL + name[size:size + n]) * _MUL + name[2 * size:2 * size + n])
        size *= 3
    last = LENGTH - 81
    return mixed(mixed(name[:starts] * _MUL + name[81:81 + starts]) * _MUL + name[last:last + starts])


def _contexts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted stretches, each cut once: copies of a text meet in their tasks
    and then as one row, so a sample has as many rows as distinct stretches."""
    per_text = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("h", "loc", "m", "n")).alias("wanted"))
    joined = texts.groupBy("k1", "k2").agg(F.any_value("text").alias("text")).join(per_text, ["k1", "k2"])

    def run(batches):
        for b in batches:
            k1, k2, text, want = (b.column(i).to_pylist() for i in range(4))
            rows = []
            for x, y, t, ws in zip(k1, k2, text, want, strict=True):
                data = t.encode()
                for w in ws:
                    lo, n = w["loc"] >> 16, ((w["loc"] >> 8) & 255) + 1
                    rows.append((w["h"], x, y, w["loc"], w["m"], w["n"], data[lo:lo + n + LENGTH - 1]))
            for at in range(0, len(rows) or 1, 20_000):
                part = list(zip(*rows[at:at + 20_000], strict=True)) or [()] * 7
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(part, types, strict=True)],
                                                 names=["h", "k1", "k2", "loc", "m", "n", "bytes"])
    return joined.select("k1", "k2", "text", "wanted").mapInArrow(
        run, "h long, k1 long, k2 int, loc long, m long, n long, bytes binary")


def _repeats_of(h: np.ndarray, loc: np.ndarray, data: list[bytes]) -> np.ndarray:
    """For stretches of whole samples: one flag per start (stretch after stretch), whether
    another start of the same sample begins the same string."""
    n = ((loc >> 8) & 255) + 1
    off = loc & 255
    total = int(n.sum())
    flat = np.frombuffer(b"".join(data), dtype=np.uint8)
    sizes = n + LENGTH - 1
    base = np.cumsum(sizes) - sizes
    name = names_of(np.concatenate([flat, np.zeros(2 * 81 + LENGTH, np.uint8)]), len(flat))
    row = np.repeat(np.arange(len(n)), n)
    step = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    at = base[row] + step
    # equal strings lie equally far from their sample
    key = mixed(name[at] ^ mixed(h[row].view(np.uint64) + (off[row] - step).astype(np.uint64) * _SEED))
    order = np.argsort(key, kind="stable")
    twin = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    out = np.zeros(total, dtype=bool)
    for k in range(0, len(twin), 50_000):  # adjacent strings byte by byte
        a, b = order[twin[k:k + 50_000]], order[twin[k:k + 50_000] + 1]
        span = np.arange(LENGTH)
        same = (flat[at[a][:, None] + span] == flat[at[b][:, None] + span]).all(axis=1)
        out[a[same]] = True
        out[b[same]] = True
    return out


def _runs(loc: np.ndarray, n: np.ndarray, flags: np.ndarray, k1, k2, wanted: np.ndarray):
    """Byte spans covered by flagged starts, one row per run of starts."""
    out = []
    at = 0
    for i in range(len(n)):
        f = flags[at:at + n[i]]
        at += n[i]
        if wanted[i] and f.any():
            edge = np.diff(np.concatenate([[0], f.astype(np.int8), [0]]))
            lo = int(loc[i]) >> 16
            for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
                out.append((k1[i], k2[i], lo + int(a), lo + int(b) - 1 + LENGTH))
    return out


SPANS = "k1 long, k2 int, start long, end long"


def _grouped(contexts: DataFrame) -> DataFrame:
    """Spans repeated within samples of bounded size: all stretches of a sample meet in one
    task, in sorted order, and whole samples are handled together."""
    def run(batches):
        rest = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([rest, t]) if rest is not None else t
            h = t.column("h").to_numpy()
            if len(h) < BATCH:
                rest = t
                continue
            cut = int(np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))[-1])  # the last sample may go on
            rest = t.slice(cut)
            if cut:
                yield from emit(t.slice(0, cut))
        if rest is not None and rest.num_rows:
            yield from emit(rest)

    def emit(t):
        h = t.column("h").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        ends = np.concatenate([starts[1:], [len(h)]])
        at = 0
        while at < len(starts):  # whole samples, about BATCH stretches at once
            stop = at + max(1, int(np.searchsorted(ends[at:], starts[at] + BATCH, side="right")))
            yield from one(t.slice(int(starts[at]), int(ends[stop - 1] - starts[at])))
            at = stop

    def one(t):
        loc = t.column("loc").to_numpy()
        n = ((loc >> 8) & 255) + 1
        flags = _repeats_of(t.column("h").to_numpy(), loc, t.column("bytes").to_pylist())
        rows = _runs(loc, n, flags, t.column("k1").to_pylist(), t.column("k2").to_pylist(), t.column("n").to_numpy() == 1)
        if rows:
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=x) for c, x in zip(
                cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["k1", "k2", "start", "end"])
    return contexts.repartition("h").sortWithinPartitions("h").mapInArrow(run, SPANS)


def _counted(contexts: DataFrame) -> DataFrame:
    """Spans repeated within hot samples: every start's string by its digest, counted with a
    partial count per task, so no task holds a whole sample."""
    def run(batches):
        for b in batches:
            k1, k2, loc, n, data = (b.column(i).to_pylist() for i in range(5))
            for i in range(len(loc)):
                lo, starts = loc[i] >> 16, ((loc[i] >> 8) & 255) + 1
                digests = [hashlib.blake2b(data[i][s:s + LENGTH], digest_size=16).digest() for s in range(starts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), pa.array([k1[i]] * starts, pa.int64()), pa.array([k2[i]] * starts, pa.int32()),
                     pa.array(range(lo, lo + starts), pa.int64()), pa.array([n[i] == 1] * starts, pa.bool_())],
                    names=["d", "k1", "k2", "i", "open"])
    rows = contexts.select("k1", "k2", "loc", "n", "bytes").mapInArrow(run, "d binary, k1 long, k2 int, i long, open boolean")
    twice = rows.groupBy("d").agg(F.count("*").alias("c")).filter("c > 1").select("d")
    return rows.filter("open").join(twice, "d", "left_semi").select("k1", "k2", F.col("i").alias("start"), (F.col("i") + LENGTH).alias("end"))


def repeated_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """``(k1, k2, spans)``: for each text with a repeat, by its key, the byte spans covered by
    strings of ``LENGTH`` bytes that start at another place too (not yet merged)."""
    texts = df.select(F.col(text).alias("text")).filter(F.octet_length(text) >= LENGTH)
    shared = sample_rows(texts, "text", True).groupBy("h").agg(F.count("*").alias("c")).filter("c > 1").select("h")
    rows = written(sample_rows(texts, "text", False).join(shared, "h", "left_semi"), "stretches")
    segs = written(rows.groupBy("h", "seg").agg(F.count("*").alias("n"), F.first("k1").alias("k1"), F.first("k2").alias("k2"),
                                                F.first("loc").alias("loc")), "distinct-stretches")
    whole = rows.join(segs.filter("n > 1").select("h", "seg"), ["h", "seg"], "left_semi")
    lo, n = F.shiftright("loc", 16), F.shiftright("loc", 8).bitwiseAND(F.lit(255)) + 1
    whole = whole.select("k1", "k2", lo.alias("start"), (lo + n + LENGTH - 1).alias("end"))
    # samples with two different stretches: those met once are open, of the others one takes part
    mixed_samples = segs.groupBy("h").agg(F.count("*").alias("m"), F.min("n").alias("least")).filter("m > 1 and least = 1").select("h", "m")
    wanted = segs.join(mixed_samples, "h").select("h", "k1", "k2", "loc", "m", "n")
    keyed = add_columns(texts, ["text"], "k1 long, k2 int", _make_keys)
    contexts = written(_contexts(keyed, wanted), "contexts")
    spans = whole.unionByName(_grouped(contexts.filter(F.col("m") <= HOT))).unionByName(_counted(contexts.filter(F.col("m") > HOT)))
    return spans.distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _make_keys():
    def f(texts):
        keys = [text_key((t or "").encode()) for t in texts]
        return [k[0] for k in keys], [k[1] for k in keys]
    return f


def remove_repeated(df: DataFrame, text: str = "text", keep=None, texts: bool = True) -> DataFrame:
    """``df`` with ``n_bytes`` (UTF-8), ``n_removed``, ``n_spans`` (maximal removed runs) and
    ``kept_sha256`` (of the remaining bytes joined); with ``texts`` also ``kept_bytes``.

    A byte goes when a string of 200 bytes that covers it also starts anywhere else, in the
    same or another document, whether or not that one is removed too; strings never cross
    documents.  NULL counts as empty; shorter texts keep all bytes; repeated rows are copies
    and lose everything from 200 bytes on; an empty table gives no rows; carried columns named
    like an output are replaced.
    """
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + (["kept_bytes"] if texts else [])
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    spans = written(repeated_spans(df, text), "spans")
    carried = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("__row"), F.col(text).alias("__text"))
    # texts too short for a repeat need no look-up
    short = F.coalesce(F.octet_length("__text") < LENGTH, F.lit(True))
    keyed = add_columns(carried.filter(~short), ["__text"], "k1 long, k2 int", _make_keys)
    found = keyed.join(spans, ["k1", "k2"], "left").select("__row", "__text", "spans")
    bare = carried.filter(short).withColumn("spans", F.lit(None).cast(found.schema["spans"].dataType))

    def make():
        def f(values, spans_of):
            out = []
            for t, spans in zip(values, spans_of, strict=True):
                data = (t or "").encode()
                rest, at, removed, runs, end = [], 0, 0, 0, -1
                for s in sorted((s["start"], s["end"]) for s in spans or ()):
                    if s[0] > end:  # a new run; touching ones are one
                        rest.append(data[at:s[0]])
                        runs += 1
                        removed += s[1] - s[0]
                        end = s[1]
                    elif s[1] > end:
                        removed += s[1] - end
                        end = s[1]
                    at = end
                rest.append(data[at:])
                left = b"".join(rest)
                out.append((len(data), removed, runs, hashlib.sha256(left).hexdigest()) + ((left,) if texts else ()))
            return tuple(zip(*out, strict=True)) if out else ((),) * len(names)
        return f
    ddl = "n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept_bytes binary" if texts else "")
    done = add_columns(found.unionByName(bare), ["__text", "spans"], ddl, make, keep=["__row"])
    return done.select("__row.*", *names)
