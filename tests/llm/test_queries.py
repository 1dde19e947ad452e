"""The registered queries on the smallest tables, and the pipeline against a brute-force version."""

import random

import duckdb
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from marquee.llm import bytebpe
from marquee.llm.common import vocabulary
from test_operators import PRIVATE, exact_components, exact_leaks, prose, word

ROOT = "/root/testdata/sf0.001"
LAYOUT = {
    "op1_main_text": ("pages", ["page_id", "url", "text", "n_chars"]),
    "op2_near_duplicates": ("documents", ["doc_id", "n_shingles", "component_id", "kept"]),
    "op3_surrogates": ("documents", ["doc_id", "text", "n_replaced"]),
    "op4_suffix_dedup": ("documents", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]),
    "op5_quality_rules": ("documents", ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                        "base_failed", "kept", "p_good"]),
    "op6_chunk_dedup": ("documents", ["doc_id", "text", "n_bytes", "n_chunks", "n_repeats", "n_removed", "has_repeats", "first_docs"]),
    "op7_byte_bpe": ("documents", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]),
    "op8_decontamination": ("documents", ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]),
    "op9_url_filter": ("pages", ["page_id", "host", "path", "rule", "verdict"]),
    "op10_quality_classifier": ("documents", ["doc_id", "held_out", "score", "predicted"]),
}


@pytest.mark.parametrize("name", LAYOUT)
def test_query_covers_its_table(spark, name):
    table, columns = LAYOUT[name]
    out = entry.queries()[name](spark, ROOT)
    assert out.columns == columns
    assert out.count() == spark.read.parquet(f"{ROOT}/{table}.parquet").count()


def test_url_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{ROOT}/pages.parquet'")
    cur = con.execute(entry.oracle_sql()["op9_url_filter"])
    names = [c[0] for c in cur.description]
    expected = sorted((dict(zip(names, r)) for r in cur.fetchall()), key=lambda r: r["page_id"])
    got = sorted((r.asDict() for r in entry.queries()["op9_url_filter"](spark, ROOT).collect()), key=lambda r: r["page_id"])
    assert got == expected


def test_pipeline_equals_brute_force(spark, tmp_path):
    rnd = random.Random(21)
    good = [prose(rnd, rnd.randrange(70, 200)) for _ in range(40)]
    item = prose(rnd, 30)
    texts = list(good)
    texts += ["### " + " ".join(word(rnd.randrange(900)) + "%%%" for _ in range(90)) for _ in range(6)] + [None, "", "short"]
    junk = set(range(len(good), len(texts)))
    texts += [good[3], good[4] + " more", good[5].replace(" ", "\n")]           # copies: the first stays
    texts += [prose(rnd, 60) + " " + item + " " + prose(rnd, 20)]               # holds a benchmark passage
    texts += [prose(rnd, 60) + " " + PRIVATE]
    private = len(texts) - 1
    rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in enumerate(texts)]
    root = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")

    left = [(i, t) for i, t in enumerate(texts) if i not in junk]
    components = exact_components(left)
    left = [(i, t) for i, t in left if components[i][1] == i]
    leaks = exact_leaks([t for _, t in left], [(1, item)])
    left = {i: t for (i, t), leak in zip(left, leaks) if not leak[1]}

    docs = spark.read.parquet(f"{root}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, root).columns == docs.columns
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, root).collect()}
    assert set(out) == set(left) and private in left

    path, pattern = vocabulary()
    with open(path, "rb") as f:
        reference = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bytebpe.load_ranks(f.read()), special_tokens={})
    for i, t in left.items():
        if i != private:
            assert out[i].token_ids == reference.encode_ordinary(t) and out[i].n_tokens == len(out[i].token_ids)
    replaced = reference.decode(out[private].token_ids)
    assert replaced.startswith(texts[private][:40]) and "ann.34@mail7" not in replaced and "97.51.17.173" not in replaced


def test_pipeline_drops_near_copies_from_four_fifths(spark):
    rnd = random.Random(8)
    texts = []
    for _ in range(12):
        w = prose(rnd, 200).split()
        for tail in (0, 38, 44, 60):  # similarities of about 0.84, 0.82 and 0.77 to the first
            texts.append(" ".join(w + prose(rnd, tail).split()))
    rows = [(i, t, "en", "src", len(t)) for i, t in enumerate(texts)]
    left = [i for i, (_, c) in exact_components(list(enumerate(texts)), 80).items() if i == c]
    assert len(left) == 24 and len(set(c for _, c in exact_components(list(enumerate(texts))).values())) == 48
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert sorted(r.doc_id for r in stage(spark, df, "").collect()) == left
