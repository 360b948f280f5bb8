"""The pipeline's stages and the registered queries on a small folder of tables."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from cinegraph.llm import mixing, queries
from cinegraph.llm.bpe import load
from conftest import SF001
from test_operators_small import brute_fingerprint, brute_repeats, classes, sorted_rows, words

ITEM = "Which of the seven old lanterns did the keeper of the northern harbour light before the storm came in?"


def documents():
    rng = random.Random(9)
    vocab = [a + b + c for a in "bdfklmnprst" for b in "aeiou" for c in "lmnrs"]
    out = []
    for i in range(150):
        text = " ".join(rng.choice(vocab) for _ in range(rng.randint(20, 200)))
        if i % 3 == 0:
            text += " you vile scum" * 2
        out.append([i, text, "en", f"s{i % 4}" if i % 7 else None, len(text), i * 2])
    for i in range(150, 170):
        out.append([i, out[i - 149][1], "en", "s1", 1, 1])                  # exact copies
    out += [[170, "Intro here. " + ITEM + " Outro there.", "en", "s2", 1, 1], [171, None, None, "s0", None, None],
            [172, "", "en", None, 0, 0], [None, " ".join(vocab[:90]), "en", "s3", 1, 1], out[5], out[5]]
    return [tuple(r) for r in out]


DOCS = "doc_id long, text string, lang string, source string, n_chars long, mix_copy long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(documents(), DOCS).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(150)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def key(r):
    return tuple("" if v is None else str(v) for v in r)


def test_stages_and_run(spark, sf_dir):
    docs, kept = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), "t-stage")
        kept[name] = [tuple(r) for r in docs.collect()]
        if name != "token_output":
            assert docs.columns == [f.split()[0] for f in DOCS.split(", ")]
    toxic = {r[0] for r in documents() if "scum" in (r[1] or "")}
    assert {r[0] for r in kept["toxicity"]} == {r[0] for r in documents()} - toxic
    assert len(kept["toxicity"]) == sum(r[0] not in toxic for r in documents())

    rows = sorted(kept["toxicity"], key=key)
    fps = [brute_fingerprint(r[1]) for r in rows]
    group = classes([(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4],
                    range(len(rows)))
    best = {}
    for i, g in group.items():
        if rows[i][0] is not None:
            best[g] = min(best.get(g, 1 << 60), rows[i][0])
    alone = {rows[i] for i, g in group.items() if g not in best}
    expect = {r for i, r in enumerate(rows) if r[0] is not None and best[group[i]] == r[0]} | alone
    assert sorted(kept["simhash_dedup"], key=key) == sorted(expect, key=key)

    clean = [r for r in kept["simhash_dedup"] if ITEM not in (r[1] or "")]
    assert len(clean) == len(kept["simhash_dedup"]) - 1
    assert sorted(kept["decontamination"], key=key) == sorted(clean, key=key)

    plan = {r.doc_id: r.copies for r in mixing.plan_mix(spark.createDataFrame(clean, DOCS)).collect()}
    assert sorted(kept["mixing"], key=key) == sorted((r for r in clean for _ in range(plan[r[0]])), key=key)

    tok, at, expect = load(queries.tokenizer_path()), 0, []
    for r in sorted(kept["mixing"], key=lambda r: (r[0] is None, r[0] or 0)):
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [2]
        expect.append((r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted_rows(kept["token_output"]) == sorted_rows(expect)
    assert sorted_rows(corpus_pipeline.run(spark, sf_dir).collect()) == sorted_rows(expect)


def test_empty_tables(spark, sf_dir, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    for name in ("op8_token_files", "op10_decontamination"):
        assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_queries_are_registered():
    names = set(entry.queries())
    assert names >= set(queries.QUERIES) | {"pipeline"} and len(queries.QUERIES) == 13
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_mixing_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    found = con.execute(entry.oracle_sql()["op1_mixing"])
    cols = [d[0] for d in found.description]
    expect = sorted(map(tuple, found.fetchall()))
    df = queries.op1_mixing(spark, SF001)
    assert sorted(map(tuple, df.select(*cols).collect())) == expect
    by_source = df.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    total = sum(r.target for r in by_source)
    assert abs(sum(r.taken for r in by_source) - total) < 0.1 * total


def test_digests_match_brute_force(spark):
    import hashlib
    data = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op5_substring_dedup(spark, SF001).collect()}
    assert found == {d: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for d, n, gone, kept in brute_repeats(data, 50)}
    fps = {r.doc_id: r.fingerprint for r in queries.op4_simhash(spark, SF001).collect()}
    assert fps == {d: f"{brute_fingerprint(t):016x}" for d, t in data}
    counts = {r.doc_id: r.n_words for r in queries.op2_licenses(spark, SF001).collect()}
    assert set(counts) == {d for d, _ in data} and all(counts[d] > 0 for d, t in data if words(t))


def test_language_accuracy_on_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    held = [r for r in queries.op9_language(spark, SF001).collect() if r.held_out and truth[r.doc_id]]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
