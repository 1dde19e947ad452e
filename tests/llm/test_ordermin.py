"""Order MinHash against a plain version, its likeness, the order of documents, edge cases."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import ordermin as O
from marquee.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, n_chars string, part string"
M64 = 2**64 - 1


def scramble(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & M64
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & M64
    return x ^ (x >> 31)


def plain_fingerprint(text):
    """Straight from the definition: number the k-mers, take per function the least, restore
    their order, hash the tuple."""
    names = O.kmers(O.code_points(text)).tolist()
    if len(text) >= O.KMER:
        by_text = collections.defaultdict(set)
        for i, h in enumerate(names):
            by_text[text[i:i + O.KMER]].add(h)
        assert all(len(v) == 1 for v in by_text.values()) and len(set(names)) == len(by_text)
    seen, elements = collections.Counter(), []
    for h in names:
        elements.append(scramble((h + seen[h] * int(O._STEP)) & M64))
        seen[h] += 1
    out = []
    for m in O.MULTIPLIERS.tolist():
        least = sorted(range(len(elements)), key=lambda i: ((elements[i] >> 32) * m & (2**32 - 1), i))[:O.PICKED]
        h = 0
        for i in sorted(least):
            h = scramble((h * int(O._STEP) + elements[i]) & M64)
        out.append(h >> 32)
    return out if elements else []


def text_of(rnd, n, letters="abcdefgh  éß漢😀"):
    return "".join(rnd.choices(letters, k=n))


@pytest.mark.parametrize("n", [0, 1, 2, 7, 8, 9, 10, 12, 30, 500, 3000])
def test_fingerprints_equal_the_definition(n):
    rnd = random.Random(n)
    for letters in ("abcdefgh  éß漢😀", "ab", "a"):
        text = text_of(rnd, n, letters)
        assert O.fingerprint(text).tolist() == plain_fingerprint(text)
        one = O.Fingerprints(text)
        assert one.own.tolist() == plain_fingerprint(text)
        for m in (0, 1, 5, n, 2 * n):  # sharing the beginning changes nothing
            other = text_of(rnd, m, letters)
            edited, got = one.edited(other)
            assert edited == text[:n - n // 3] + other[:n // 3] and got.tolist() == plain_fingerprint(edited)


def test_longer_texts_are_sorted_apart_alike(monkeypatch):
    rnd = random.Random(4)
    h = O.kmers(O.code_points(text_of(rnd, 4000, "abc")))
    expected = O.numbered(h)
    seen = collections.Counter()
    for k, v in zip(expected.tolist(), h.tolist(), strict=True):
        assert k == seen[v]
        seen[v] += 1
    monkeypatch.setattr(O, "PLACE_BITS", 10)
    assert (O.numbered(h) == expected).all()


def test_likeness_follows_edits_and_order():
    rnd = random.Random(7)
    words = [text_of(rnd, 6, "abcdefghijklmnop") for _ in range(600)]
    text = " ".join(words)
    near = O.likeness(O.fingerprint(text), O.fingerprint(text.replace(words[5], "changed")))
    swapped = O.likeness(O.fingerprint(text), O.fingerprint(" ".join(words[300:] + words[:300])))
    far = O.likeness(O.fingerprint(text), O.fingerprint(" ".join(text_of(rnd, 6) for _ in range(600))))
    assert near > 0.9 and far == 0
    assert 0.2 < swapped < 0.8  # the same set of words in another order


def expected_rows(data):
    order = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for k, (i, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text)
        edited = text[:n - n // 3] + following[:n // 3]
        own, changed, nxt = map(plain_fingerprint, (text, edited, following))

        def like(a, b):
            return sum(x == y for x, y in zip(a, b)) / len(a) if a and b else float(len(a) == len(b))
        raw = [np.array(x, dtype=np.uint32).tobytes().hex() for x in (own, changed)]
        out[i] = (n, hashlib.sha256(edited.encode()).hexdigest(), *raw, like(own, changed), like(own, nxt))
    return out


def result(df):
    return {r["doc_id"]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_documents_in_order(spark, ranges):
    rnd = random.Random(ranges)
    base = text_of(rnd, 900)
    texts = [base, base, base[:700], None, "", "x", text_of(rnd, 20_000), base + text_of(rnd, 40)] + [text_of(rnd, rnd.randrange(60)) for _ in range(40)]
    rnd.shuffle(texts)
    data = list(enumerate(texts)) + [(None, "no id, but words")]
    df = spark.createDataFrame([(i, t, "7", "p") for i, t in data], SCHEMA).repartition(6)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        out = O.document_fingerprints(df)
        got = result(out)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert got == expected_rows(data)


def test_one_document_repeated_rows_and_none(spark):
    one = spark.createDataFrame([(5, "abcdefghijkl", None, None)], SCHEMA)
    assert result(O.document_fingerprints(one)) == expected_rows([(5, "abcdefghijkl")])
    twice = O.document_fingerprints(one.unionByName(one)).collect()
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0]["near_next"] == 1.0
    assert O.document_fingerprints(one.filter("false")).collect() == []


def test_query_on_given_documents(spark):
    root = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{root}/documents.parquet").select("doc_id", "text")
    small = [tuple(r) for r in given.orderBy(F.length("text")).limit(60).collect()]
    assert result(O.document_fingerprints(spark.createDataFrame(small, "doc_id long, text string"))) == expected_rows(small)
    rows = QUERIES["op11_document_fingerprints"](spark, root)
    assert rows.count() == given.count()
    assert rows.agg(F.avg("near_edited")).first()[0] > 0.2 + rows.agg(F.avg("near_next")).first()[0]
