"""Prefix trie, hard negatives and suffix-array dedup against brute-force versions: nulls in any
column, empty and very long texts, ties, repeated rows, empty tables, clashing extra columns."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinegraph.llm import hard_negatives, prefix_trie, suffix_dedup
from cinegraph.llm.common import hashed_fold
from cinegraph.llm.queries import QUERIES


def sorted_rows(found):
    return sorted(map(tuple, found), key=str)


# ---- conversation prefix trie ------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, path string, sizes int, base string"


def turn_rows():
    rng = random.Random(3)
    roles, said = ["user", "assistant", None], ["", None, "hi", "hello", "é漢", "x" * 5000]
    out = []
    for c in [*range(-7, 40), 4097, 9000, 10**12 + 1]:
        if c == 15:
            continue                                                 # a base that is absent
        for t in range(rng.randint(1, 9)):
            out.append((c, t if rng.random() < 0.9 else None, rng.choice(roles), rng.choice(said[:4])))
    out += [(50 + i, t, "user", f"copy {t}") for i in range(40) for t in range(3)]        # one conversation, 40 times
    out += [(200, t, "user", "long") for t in range(300)] + [(None, 1, "user", "lost"), (None, None, None, None)]
    out += [(100, 1, "b", "y"), (100, 1, "a", "z"), (100, 1, "a", "z"), (101, 0, "user", said[5])]
    return [(*r, "p", 1, "b") for r in out]


def rebuilt(rows, branch=True):
    by = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            by[c].append(((turn is not None, turn or 0, key), role, text))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in by.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if branch else 0
        base = c - int(math.fmod(c, 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n in members:
        own = (len(members[n]) - 1) * len(n[-1][1].encode()) if n else 0
        for d in range(len(n) + 1):
            leaves[n[:d]] += n not in children
            saved[n[:d]] += own
    out = []
    for n, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(convs[c]) == len(n))))
        out.append((min(cs), len(n), min(members[n[:-1]]) if n else None, len(cs), children[n], leaves[n], saved[n],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted_rows(out)


@pytest.mark.parametrize("shards,turns", [(1, 32), (4, 32), (9, 2), (50, 400)])
def test_prefix_trie(spark, shards, turns):
    c = F.col("conv_id")
    table = spark.createDataFrame(turn_rows(), TURNS).repartition(3)
    paths = prefix_trie.turn_paths(table, c - c % 5, hashed_fold(c, 9))
    found = prefix_trie.prefix_trie(paths, shards=shards, splitter_turns=turns)
    assert sorted_rows(found.collect()) == trie(rebuilt(turn_rows()))


def test_prefix_trie_without_branches_and_query(spark, tmp_path):
    table = spark.createDataFrame(turn_rows(), TURNS)
    found = prefix_trie.prefix_trie(prefix_trie.turn_paths(table))
    assert sorted_rows(found.collect()) == trie(rebuilt(turn_rows(), branch=False))
    table.repartition(2).write.parquet(str(tmp_path / "conversations.parquet"))
    result = QUERIES["op11_prefix_trie"](spark, str(tmp_path))
    assert sorted_rows(result.collect()) == trie(rebuilt(turn_rows()))


def test_prefix_trie_empty(spark):
    table = spark.createDataFrame([], TURNS)
    assert prefix_trie.prefix_trie(prefix_trie.turn_paths(table)).count() == 0


def test_skeleton_holds_every_node_of_two_shards():
    rng = random.Random(9)
    turn = [bytes([i]) * prefix_trie.KEY for i in range(4)]
    paths = sorted({b"".join(rng.choice(turn) for _ in range(rng.randint(0, 6))) for _ in range(500)})
    splitters = sorted(rng.sample(paths, 7))
    skeleton = prefix_trie._skeleton(splitters)
    shards = defaultdict(set)
    for p in paths:
        for at in range(0, len(p) + 1, prefix_trie.KEY):
            shards[p[:at]].add(prefix_trie.bisect_right(splitters, p))
    assert all(n in skeleton for n, s in shards.items() if len(s) > 1)


# ---- hard negatives ----------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, row long, size int, code string, anchor int"


def vector_rows():
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((4, 12))
    out = []
    for i in range(600):
        x = (centre[i % 4] + rng.standard_normal(12)) * 0.3
        out.append((i, [float(np.float32(v)) for v in x], i % 4))
    nan, inf = float("nan"), float("inf")
    out += [(700, None, 1), (7, None, 1), (701, [], 2), (800, [], 2), (900, [], 3), (None, out[0][1], 0), (1000, out[1][1], None)]
    out += [(1100, [nan] * 12, 1), (1200, [inf] + [0.0] * 11, 1), (1300, [None] + [0.5] * 11, 1)]
    out += [(1400, [0.0] * 12, 1), (1500, [0.5, -0.25, 1.0], 1), (1501, [0.5, -0.5, 1.0], 1), (1502, [0.4, -0.2, 0.5], 2)]
    out += [out[100], out[100], out[5], out[5], (2000, out[200][1], 0), (2001, out[200][1], 1)]     # repeats and ties
    return [(*r, 1, 1, "c", 1) for r in out]


def mined(rows, scale=256, positives=5, negatives=10):
    live = []
    for i, x, label, *_ in rows:
        if i is None or x is None or label is None or not all(v is not None and math.isfinite(v) for v in x):
            continue
        live.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(scale * float(np.float32(v))) for v in x]))
    out = []
    for a, (anchor, label, x) in enumerate(live):
        if anchor % 100:
            continue
        found = [(-sum(p * q for p, q in zip(x, y, strict=True)), i, c == label) for b, (i, c, y) in enumerate(live)
                 if b != a and len(y) == len(x)]
        best = sorted((s, i) for s, i, same in found if same)[:positives]
        for s, positive in best:
            inside = sorted((t, i) for t, i, same in found if not same and 30 * -s <= 100 * -t <= 90 * -s)
            out += [(anchor, positive, r, i, -s, -t) for r, (t, i) in enumerate(inside[:negatives], 1)]
    return sorted_rows(out)


def query_of(spark, rows, tmp_path):
    spark.createDataFrame(rows, VECTORS).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    return QUERIES["op12_hard_negatives"](spark, str(tmp_path))


def test_hard_negatives(spark, tmp_path):
    found = query_of(spark, vector_rows(), tmp_path).collect()
    want = mined(vector_rows())
    assert len(want) > 100 and sorted_rows(found) == want


def test_hard_negatives_in_blocks(spark):
    rows = [r for r in vector_rows() if r[0] is not None]
    table = spark.createDataFrame(rows, VECTORS)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.hard_negatives(table.withColumn("label", label), F.col("vec_id") % 100 == 0, block=3)
    assert sorted_rows(found.collect()) == mined(rows)


def test_hard_negatives_empty_and_too_large(spark, tmp_path):
    assert query_of(spark, [], tmp_path).count() == 0
    table = spark.createDataFrame([(1, [0.5], 1, 1, 1, "c", 1)], VECTORS)
    assert hard_negatives.hard_negatives(table, F.col("vec_id") % 100 == 0).count() == 0       # no anchor
    large = spark.createDataFrame([(100, [1e30], 1, 1, 1, "c", 1)], VECTORS)
    with pytest.raises(ValueError):
        hard_negatives.hard_negatives(large, F.col("vec_id") % 100 == 0)


def test_table_scores_are_exact():
    rng = np.random.default_rng(1)
    for most, size, kind in ((3, 5, np.int32), (256, 64, np.int32), (2**27, 9, np.int64)):
        a, c = (rng.integers(-most, most + 1, (n, size)) for n in (7, 300))
        planes = hard_negatives.planes_for(most)
        tables = hard_negatives.subset_tables(a, kind)
        assert (hard_negatives.scores(tables, hard_negatives.pack(c, planes)) == c @ a.T).all()


# ---- suffix-array dedup ------------------------------------------------------------------

DOCS = "doc_id long, text string, t string, anchor long, copies int, first string, runs int"


def doc_rows():
    rng = random.Random(8)
    word = ["alpha", "beta", "gamma", "δέλτα", "ε", "zeta\n", "漢字", "\x00"]

    def prose(n):
        return " ".join(rng.choice(word) + str(rng.randint(0, 999)) for _ in range(n))
    shared = [prose(60) for _ in range(3)]
    texts = [prose(rng.randint(1, 120)) for _ in range(25)]
    texts += [prose(20) + shared[i % 3][i:300 - i] + prose(20) for i in range(20)]          # runs begin and end anywhere
    texts += [texts[3], texts[3], shared[0], shared[0][:200], shared[1][:199], None, None, "", "short"]
    texts += ["a" * 1000, "ab" * 300, "abc" * 67, "q" * 200, prose(10) + "q" * 150, prose(4000)]
    texts += [prose(30) + "One common line. " + prose(30) for _ in range(15)]
    texts += [prose(5) + shared[2] + prose(5) + shared[2]]                                  # inside one document
    out = [(None if i in (2, 30) else i, t) for i, t in enumerate(texts)]
    out += [out[4], out[4], (5, "another text of one id " + prose(40))]
    return [(*r, "t", 1, 1, "f", 1) for r in out]


def cut(rows, width=200):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    starts = Counter(b[i:i + width] for _, b in texts for i in range(len(b) - width + 1))
    out = []
    for doc, b in texts:
        gone = [False] * len(b)
        for i in range(len(b) - width + 1):
            if starts[b[i:i + width]] > 1:
                gone[i:i + width] = [True] * width
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted_rows(out)


@pytest.mark.parametrize("how", [{}, {"hot": 1}, {"hot": 3, "gram": 8}, {"bucket_blocks": 3, "batch": 1, "gram": 200}])
def test_suffix_dedup(spark, how):
    table = spark.createDataFrame(doc_rows(), DOCS).repartition(3)
    found = suffix_dedup.remove_repeated_bytes(table, **how).collect()
    want = cut(doc_rows())
    assert sum(r[2] for r in want) > 5000
    assert sorted_rows((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]),
                        hashlib.sha256(r["kept"]).hexdigest()) for r in found) == want


def test_suffix_dedup_query_and_spans(spark, tmp_path):
    table = spark.createDataFrame(doc_rows(), DOCS)
    table.write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted_rows(QUERIES["op13_suffix_dedup"](spark, str(tmp_path)).collect()) == cut(doc_rows())
    for r in suffix_dedup.remove_repeated_bytes(table, width=64, gram=16).collect():
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] == r["n_bytes"] - len(r["kept"])


def test_suffix_dedup_empty(spark):
    assert suffix_dedup.remove_repeated_bytes(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeated_bytes(spark.createDataFrame([], DOCS), gram=10)


def test_levels_are_logarithmic_and_mark_both_sides():
    rng = np.random.default_rng(2)
    levels, seen = suffix_dedup.Levels(8), []
    for _ in range(37):
        rows = rng.integers(0, 3, (5, 8)).astype(np.uint8)
        levels.add(rows)
        seen += [bytes(r) for r in rows]
        assert len(levels.levels) <= len(seen).bit_length()
    times = Counter(seen)
    assert levels.repeated.tolist() == [times[s] > 1 for s in seen]


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_hard_negatives"])
def test_queries_match_sql(spark, name):
    import duckdb

    from cinegraph.llm.oracle import ORACLE
    con = duckdb.connect()
    for t in ("conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    found = con.execute(ORACLE[name])
    cols = [d[0] for d in found.description]
    result = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert set(result.columns) == set(cols)
    assert sorted_rows(result.select(*cols).collect()) == sorted_rows(found.fetchall())
