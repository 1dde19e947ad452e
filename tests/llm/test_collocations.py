"""Collocations against plain counting, the index against plain n-grams, and edge cases."""

import collections
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from marquee.llm import collocations as C
from marquee.llm.common import BATCH
from marquee.llm.oracles import ORACLES
from marquee.llm.queries import QUERIES

SCHEMA = "doc_id long, lang string, text string, rank string"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
        words = re.findall(r"[^\x20\x09]+", piece)
        if words:
            yield words


def brute_force(rows, min_count=30, covered=80, top=2000):
    """``[(lang, rank, phrase, a, l, r, n, score)]`` of ``(lang, text)`` rows."""
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        replaced = set()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    part = p[i:i + k]
                    if 100 * a >= covered * counts[part]:
                        replaced.add(part)
        scored = []
        for p, a in candidates.items():
            if p not in replaced:
                score, _, left, right = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                            for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def result(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


def corpus(rnd, documents=60):
    words = ["alpha", "Beta", "gamma", "délta", "x", "-", "Ω"]
    fixed = ["new york city hall", "ad hoc", "x x x x x", "one two\tthree"]
    out = []
    for i in range(documents):
        parts = []
        for _ in range(rnd.randrange(12)):
            parts.append(rnd.choice(fixed) if rnd.random() < 0.5 else " ".join(rnd.choices(words, k=rnd.randrange(1, 9))))
        out.append((i, rnd.choice(["en", "de", None, "und"]), rnd.choice([" ", ", ", "\n", " .  ", " "]).join(parts), "z"))
    return out


@pytest.mark.parametrize("min_count,covered,top", [(3, 80, 2000), (5, 60, 7), (1, 100, 50)])
def test_collocations_equal_plain_counting(spark, min_count, covered, top):
    data = corpus(random.Random(min_count)) + [(900, None, None, None), (901, "fr", "", None), (902, "fr", " . ", None)]
    df = spark.createDataFrame(data + data[:5], SCHEMA).repartition(4)
    got = result(C.collocations(df, min_count=min_count, covered=covered, top=top, shard_bytes=300))
    assert got == brute_force([(r[1], r[2]) for r in data + data[:5]], min_count, covered, top)
    assert got


def test_one_long_text_and_an_empty_table(spark):
    rnd = random.Random(5)
    text = " ".join(rnd.choices(["a", "b", "c", "d,", "e"], k=120_000))
    df = spark.createDataFrame([(1, "en", text, None)], SCHEMA)
    assert result(C.collocations(df)) == brute_force([("en", text)])
    assert C.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    """Bits that pass by accident cost counting, not results."""
    monkeypatch.setattr(C, "frequent_bitmap", lambda phrases, length: np.full(1 << (C.FILTER_BITS - 6), 2**64 - 1, dtype=np.uint64))
    data = corpus(random.Random(9))
    got = result(C.collocations(spark.createDataFrame(data, SCHEMA), min_count=4))
    assert got == brute_force([(r[1], r[2]) for r in data], 4)


def test_shared_numbers_of_words_are_noticed(spark, monkeypatch):
    df = spark.createDataFrame([(1, "en", "a b a b a b a b", None)], SCHEMA)
    words = C.count_words(df, "lang", "text")
    monkeypatch.setattr(C, "count_words", lambda *_: words.withColumn("h", words["f"]))
    with pytest.raises(RuntimeError, match="64-bit"):
        C.collocations(df, min_count=1)


def test_shards_are_read_one_at_a_time(spark, monkeypatch):
    """A row group and a batch hold one shard: those of a whole task took up to 700 MB more outside the heap."""
    rnd = random.Random(3)
    data = [(i, "en", " ".join(rnd.choices([f"w{k}" for k in range(2000)], k=300_000)) + ". alpha beta" * 40, None) for i in range(4)]
    was, indexes, batches = C.written, [], []

    def rows(given):
        for b in given:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    def written(df, name, *settings):
        if name == "phrases-2":
            batches.extend(r["n"] for r in was(indexes[0].coalesce(1).mapInArrow(rows, "n long"), "batches", *settings).collect())
        out = was(df, name, *settings)
        if name == "shard-indexes":
            indexes.append(out)
        return out
    monkeypatch.setattr(C, "written", written)
    before = spark.conf.get(BATCH)
    got = result(C.collocations(spark.createDataFrame(data, SCHEMA).coalesce(1), shard_bytes=500_000))
    assert got == [("en", 1, "alpha beta", 160, 160, 160, 4 * 300_080, 1_000_000)]
    assert batches == [1] * 4 and spark.conf.get(BATCH) == before
    groups = []
    for f in indexes[0].inputFiles():
        m = pq.ParquetFile(f.removeprefix("file:").replace("///", "/")).metadata
        groups += [m.row_group(k).num_rows for k in range(m.num_row_groups)]
    assert groups == [1] * 4


def test_index_intervals_in_both_directions():
    rnd = random.Random(2)
    text = [rnd.randrange(6) for _ in range(800)]
    names = np.arange(100, 105, dtype=np.uint64)
    index = C.ShardIndex.of(np.array(text), names)
    exact = {k: collections.Counter() for k in range(1, 5)}
    for k in exact:
        for i in range(len(text) - k + 1):
            if all(text[i:i + k]):
                exact[k][tuple(text[i:i + k])] += 1
    grow = {"left": index.left, "right": index.right}
    for first in grow:
        for second in grow:
            for third in grow:
                p = index.words()
                for k, way in enumerate((first, second, third), 2):
                    p = grow[way](p)
                    assert dict(zip(map(tuple, p.codes.tolist()), p.count.tolist(), strict=True)) == exact[k]
                    # both intervals are those of the phrase: disjoint, inside its first and last word's rows
                    for low, half, word in ((p.low, index.ahead, p.codes[:, 0]), (p.back, index.behind, p.codes[:, -1])):
                        order = np.argsort(low)
                        assert (low[order][1:] >= (low + p.count)[order][:-1]).all()
                        assert (low >= half.first[word - 1]).all() and (low + p.count <= half.first[word]).all()


def test_query_equals_brute_force_and_sql(spark):
    root = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{root}/documents.parquet").select("lang", "text").collect()
    expected = brute_force([(r[0], r[1]) for r in given])
    assert result(QUERIES["op13_collocations"](spark, root)) == expected and len(expected) > 100
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{root}/documents.parquet'")
    got = con.execute(f"select lang, rank, phrase, a, l, r, n, score from ({ORACLES['op13_collocations']})").fetchall()
    assert sorted(got) == expected
