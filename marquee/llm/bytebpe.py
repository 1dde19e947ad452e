"""Byte-level BPE encoding and decoding with DuckDB recursive queries inside each task.

A text is cut by the vocabulary's pattern; each distinct piece becomes one row, the list of its
tokens, each with the rank of the pair that it starts.  A recursive query contracts the leftmost
pair of minimum rank of every row and joins the two pairs beside it with the merge table, until
no pair of any row merges.  The ids of a piece are decoded by the token table, which must give
the piece, and so are the ids of a whole text.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import process_cache, struct_of

# Pieces of more bytes than this are contracted by a priority queue under the same rule: the
# rows of the recursive query grow with the square of a piece's length.
LONG_PIECE = 512
# Pieces in a generation of a worker's cache, of which it keeps two (bounds memory, not the data);
# a piece counts once more for every 32 characters.
CACHE = 150_000
# Characters cut into pieces at a time.
RUN_CHARS = 1_000_000
# Pieces and bytes that one query contracts: its rows stay far below the memory it may use.
QUERY_PIECES, QUERY_BYTES = 10_000, 100_000

# An entry of a row holds the rank of the pair it starts (from bit 36, UNPAIRED if it merges with
# nothing), where its token starts (12 bits) and the token (24 bits): the least entry is the
# leftmost pair of minimum rank.  An entry without a token stands at either end.
UNPAIRED, TOKEN = 1 << 60, (1 << 24) - 1
CONTRACT = f"""
with recursive step(w, entries, least) as (
  select w, entries, list_min(entries) from start
  union all
  select w, entries, list_min(entries) from (
    select w, list_concat(entries[:p - 2],
                          [coalesce(l.rank, {UNPAIRED}) | (entries[p - 1] & {(1 << 36) - 1}),
                           coalesce(r.rank, {UNPAIRED}) | (least & {TOKEN << 12 & ~TOKEN}) | merged],
                          entries[p + 2:]) as entries
    from (select w, entries, least, least >> 36 as merged, list_position(entries, least) as p from step where least < {UNPAIRED})
    left join merges l on l.pair = ((entries[p - 1] & {TOKEN}) << 24) | merged
    left join merges r on r.pair = (merged << 24) | (entries[p + 2] & {TOKEN}))
)
select w, entries[2:-2] as entries from step where least >= {UNPAIRED}
"""


def load_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}


class Encoder:
    """The pieces of one vocabulary, encoded in batches of distinct unknown pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        import duckdb

        self.ranks = ranks
        tokens = {i: t for t, i in ranks.items()}
        if max(tokens) >= TOKEN:
            raise ValueError(f"a rank does not fit into an entry: {max(tokens)}")
        self.tokens = pa.array([tokens.get(i) for i in range(max(tokens) + 1)], pa.binary())
        # no folder to spill to: a query's rows are bounded
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        merges = np.fromiter((x for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks
                              for x in (ranks[t[:k]] << 24 | ranks[t[k:]], i << 36)), dtype=np.int64)
        self._table("merges", pair=pa.array(merges[0::2]), rank=pa.array(merges[1::2]))
        self.single = np.array([ranks[bytes([x])] for x in range(256)], dtype=np.int64)
        # the ranks of pairs of bytes, those that rows begin with
        self.pairs = np.array([ranks.get(bytes([x, y]), UNPAIRED >> 36) for x in range(256) for y in range(256)], dtype=np.int64) << 36
        # ids of pieces as the bytes of int32 numbers, in two generations
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0

    def _table(self, name: str, **columns: pa.Array) -> None:
        t = pa.table(columns)
        # DuckDB finds t under its variable's name
        self.con.execute(f"create or replace temp table {name} as select * from t")
        del t

    def _contract(self, pieces: list[bytes]) -> Iterator[tuple[int, bytes]]:
        """The number of each piece and its ids as the bytes of int32 numbers, by one query."""
        sizes = np.array([len(p) for p in pieces])
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        ends = np.cumsum(sizes)
        rows = np.concatenate([[0], ends + 2 * np.arange(1, len(pieces) + 1)])
        place = np.arange(len(data)) - np.repeat(ends - sizes, sizes)
        rank = np.full(len(data), UNPAIRED)
        rank[:-1] = self.pairs[data[:-1].astype(np.int64) << 8 | data[1:]]
        rank[ends - 1] = UNPAIRED
        entries = np.full(rows[-1], UNPAIRED | TOKEN)
        entries[np.repeat(rows[:-1] + 1, sizes) + place] = rank | place << 24 | self.single[data]
        self._table("start", w=pa.array(np.arange(len(pieces), dtype=np.int32)),
                    entries=pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(entries)))
        out = self.con.sql(CONTRACT).to_arrow_table().combine_chunks()
        lists = out.column("entries").combine_chunks()
        ids = (lists.flatten().to_numpy() & TOKEN).astype(np.int32)
        cuts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        order = out.column("w").to_numpy()
        if not np.array_equal(np.sort(order), np.arange(len(pieces))):
            raise RuntimeError("a piece got no ids, or more than once")
        decoded = self.tokens.take(pa.array(ids))
        lengths = np.add.reduceat(pc.binary_length(decoded).to_numpy(), cuts[:-1])
        words = order.tolist()
        if not np.array_equal(lengths, sizes[order]) or joined(decoded) != b"".join([pieces[w] for w in words]):
            raise RuntimeError("a piece does not decode to itself")
        raw, cuts = ids.tobytes(), (4 * cuts).tolist()
        for w, at, end in zip(words, cuts, cuts[1:]):
            yield w, raw[at:end]

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """The ids of at least these pieces; those not known yet are encoded.  A full generation
        becomes the older one, from which pieces in use move to the new one."""
        new = pieces - self.known.keys()
        if self.size + _entries(new) > CACHE:
            self.older = self.known if self.size <= CACHE else {}
            self.known, self.size, new = {}, 0, pieces
        self.size += _entries(new)
        rows = []
        for p in new:
            ids = self.older.pop(p, None)
            if ids is not None:
                self.known[p] = ids
                continue
            data = p.encode()
            whole = self.ranks.get(data)
            if whole is not None:  # a piece that is a token stays whole
                self.known[p] = array("i", (whole,)).tobytes()
            elif len(data) > LONG_PIECE:
                self.known[p] = array("i", self._by_queue(data)).tobytes()
            else:
                rows.append((p, data))
        rows.sort(key=lambda row: len(row[1]))  # a query takes as many steps as its longest piece
        ends = np.cumsum([len(d) for _, d in rows])
        at = 0
        while at < len(rows):
            limit = (ends[at - 1] if at else 0) + QUERY_BYTES
            part = rows[at:min(at + QUERY_PIECES, int(np.searchsorted(ends, limit, side="right")))]
            at += len(part)
            for w, ids in self._contract([d for _, d in part]):
                self.known[part[w][0]] = ids
        return self.known

    def _by_queue(self, data: bytes) -> list[int]:
        """Leftmost minimum-rank contraction of one long piece by a priority queue."""
        n = len(data)
        tok = [data[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, tok[i], tok[i + 1]) for i in range(n - 1) if (r := self.ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if tok[i] is not a or j >= n or tok[j] is not b:
                continue  # one of the two has been merged since
            tok[i], tok[j], after[i] = a + b, None, after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := self.ranks.get(tok[left] + tok[right])) is not None:
                    heapq.heappush(heap, (r, left, tok[left], tok[right]))
        return [self.ranks[t] for t in tok if t is not None]


def _entries(pieces: set[str]) -> int:
    return len(pieces) + sum(map(len, pieces)) // 32


BEFORE_PIECE = re.compile(r" (?=\S)")


def runs(text: str, chars: int) -> Iterator[str]:
    """The text in runs of little over ``chars`` characters that the pattern never crosses: cuts are
    made before a space followed by something other than white space, which always starts a new piece."""
    at = 0
    while len(text) - at > chars and (m := BEFORE_PIECE.search(text, at + chars)):
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def grouped(texts: Iterable[str], chars: int) -> Iterator[list[tuple[int, str]]]:
    """Consecutive runs, each with the number of its text, in groups of about ``chars`` characters."""
    group, size = [], 0
    for i, t in enumerate(texts):
        for run in runs(t, chars):
            group.append((i, run))
            size += len(run)
            if size >= chars:
                yield group
                group, size = [], 0
    if group:
        yield group


# Most pieces are words, and an alternative that starts with an apostrophe never matches where one
# does: tried first, they are found sooner.  Another pattern stays as it is.
LETTERS_LAST, LETTERS_FIRST = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+|", r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d|"


def joined(values: pa.BinaryArray) -> bytes:
    """The bytes of all values of a whole array, one behind the other."""
    return values.buffers()[2].to_pybytes() if len(values) else b""


def make_encoder(data: bytes, pattern: str):
    """``f(texts) -> [(ids as text, number of ids, decoded bytes, ids)]`` for a rank file and pattern."""
    import regex

    key = hashlib.sha256(data + pattern.encode()).hexdigest()
    cache = process_cache()
    if key not in cache:
        encoder = Encoder(load_ranks(data))
        # \\s here means Unicode white space only, as in the tokenizer's own engine
        cache[key] = (encoder, regex.compile(pattern.replace(LETTERS_LAST, LETTERS_FIRST).replace(r"[^\s", r"[^\p{White_Space}")
                                             .replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")),
                      pa.array([b"%d " % i for i in range(len(encoder.tokens))], pa.binary()))
    encoder, splitter, digits = cache[key]

    def finished(ids: np.ndarray) -> tuple[str, int, bytes, np.ndarray]:
        """The ids as text and decoded, some at a time."""
        blocks = [pa.array(ids[k:k + 50_000]) for k in range(0, len(ids), 50_000)]
        return (b"".join([joined(digits.take(b)) for b in blocks])[:-1].decode(), len(ids),
                b"".join([joined(encoder.tokens.take(b)) for b in blocks]), ids)

    def encode(texts: list[str]) -> list[tuple[str, int, bytes, np.ndarray]]:
        """The pieces of a group of runs are learnt together, so few queries run."""
        got: list[list[bytes]] = [[] for _ in texts]
        for group in grouped(texts, RUN_CHARS):
            pieces = [splitter.findall(run) for _, run in group]
            known = encoder.learn(set().union(*pieces))
            for (i, _), ps in zip(group, pieces, strict=True):
                got[i].append(b"".join(map(known.__getitem__, ps)))
        return [finished(np.frombuffer(b"".join(g), dtype=np.int32)) for g in got]

    return encode


def encode_and_decode(df: DataFrame, ranks: str, pattern: str, text: str = "text", keep=None, ids: bool = False,
                      decoded: bool | None = None) -> DataFrame:
    """``df`` with ``n_tokens``, ``ids_sha256`` (decimal ids joined by a space) and
    ``decoded_sha256`` (bytes decoded from the ids); with ``ids`` also ``token_ids``
    (array) and, unless ``decoded`` is false, ``decoded`` (text).

    ``ranks`` is the path of the rank file as the driver sees it; its content (about a
    megabyte, a fixed vocabulary) is broadcast.  Row by row, without a shuffle: repeated rows
    stay, NULL and empty texts have no tokens, whole texts are encoded whatever their length,
    an empty table stays empty and a column named like an output is replaced.
    """
    with open(ranks, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())
    decoded = ids if decoded is None else decoded
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * ids + ", decoded string" * decoded

    def make():
        encode = make_encoder(shared.value, pattern)

        def f(texts):
            out = []
            for at in range(0, len(texts), 250):
                for line, n, back, numbers in encode([t or "" for t in texts[at:at + 250]]):
                    row = [n, hashlib.sha256(line.encode()).hexdigest(), hashlib.sha256(back).hexdigest()]
                    if ids:
                        row.append(numbers)
                    if decoded:
                        row.append(back.decode())
                    out.append(row)
            return tuple(zip(*out, strict=True)) if out else ((),) * (3 + ids + decoded)
        return f
    # the texts alone go to Python, the columns kept wait in the JVM
    out = T.StructType.fromDDL(schema).names
    kept = [F.col(f"`{c}`") for c in (df.columns if keep is None else keep) if c not in out]
    return df.select(*kept, struct_of(F.col(f"`{text}`"), schema, make).alias("__coded")).select(*kept, "__coded.*")
