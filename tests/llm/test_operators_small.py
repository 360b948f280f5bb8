"""Every operator against a brute-force version, on a small table with nulls, empty and very
long texts, ties, repeated rows and extra columns, and on an empty table."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from cinegraph.llm import (components, decontamination, language, licenses, mixing, simhash, substrings, token_counts,
                           token_files, toxicity, vectors)
from cinegraph.llm.bpe import load
from cinegraph.llm.queries import tokenizer_path

WS = r"[^\x20\x09-\x0D]+"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "fp long, n_tokens string, score string, component_id string, doc long, words string")


def rows():
    rng = random.Random(5)
    word = [a + b + c for a in "bdfklmn" for b in "aeiou" for c in ("", "x")][:40]
    base = [" ".join(rng.choice(word) for _ in range(rng.randint(1, 120))) for _ in range(30)]
    shared = " ".join(rng.choice(word) for _ in range(30))
    texts = base + [b + " tail" for b in base[:8]] + base[:5] + base[:5]
    texts += [f"{rng.choice(word)} {shared} {rng.choice(word)} end{i}" for i in range(12)]
    texts += [None, "", " \t\n", None, "   ", "É x y", "a\x1cb  c\n d", "<|endoftext|> hi  <|endoftext|>", "🙂 漢字"]
    texts += [" ".join(rng.choice(word) for _ in range(30_000)), shared, "One two One two"]
    out = []
    for i, t in enumerate(texts):
        out.append((None if i == 11 else i, t, [None, "en", "fr"][i % 3], [None, "a", "b", "é", "c"][i % 5], i,
                    1, "x", "y", "z", 2, "q"))
    return out + [out[3], out[3], (3, "another text with the id three", "en", "a", 1, 1, "x", "y", "z", 2, "q")]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("small") / "documents.parquet")
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sorted_rows(found):
    return sorted(map(tuple, found), key=str)


def words(text, lower=False):
    text = text or ""
    if lower:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return regex.findall(WS, text)


def classes(links, nodes):
    root = {n: n for n in nodes}

    def up(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in links:
        a, b = up(a), up(b)
        root[max(a, b)] = min(a, b)
    return {n: up(n) for n in nodes}


def test_mixing(docs, empty):
    found = mixing.plan_mix(docs).collect()
    sizes = defaultdict(int)
    for r in rows():
        sizes[r[3]] += len(words(r[1]))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, held = 1.5 * sum(sizes.values()), {}
    while True:
        free = {s: w for s, w in weight.items() if s not in held}
        level = (total - sum(held.values())) / sum(free.values())
        over = {s: 2.0 * sizes[s] for s, w in free.items() if w * level > 2 * sizes[s]}
        if not over:
            break
        held |= over
    target = held | {s: w * level for s, w in free.items()}
    assert len(found) == len(rows())
    for r in found:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
        rate = target[r.source] / sizes[r.source]
        assert int(rate) <= r.copies <= int(rate) + 1 and r.copies <= 2
    assert sorted_rows(found) == sorted_rows(mixing.plan_mix(docs.repartition(5)).collect())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in found)
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_licenses(docs, empty):
    found = {(r.doc_id, r.n_words, r.n_base) for r in licenses.scan_licenses(docs).collect()}
    for r in rows():
        w = regex.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                          "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or ""))
        assert (r[0], len(w), 0) in found
    assert licenses.scan_licenses(empty).count() == 0
    scan = licenses.Scanner(licenses.PHRASES, licenses.TEMPLATES)
    assert scan("x CC-BY cc by. All Rights Reserved")[:6] == (8, 3, 1, 5, "cc-by,reserved", "cc-by,reserved")
    assert scan("cc by cc by")[1:4] == (2, 0, 2)
    assert scan("xcc by acc byte")[1] == 0
    assert scan("Licensed under CC BY-NC 4.0.")[5] == "cc-by,cc-by-nc-4.0"
    assert scan("Licensed under the Apache License, Version 2.0.")[5] == "apache-2.0"
    assert scan("Licensed under the terms of the Apache License 2.0")[5] == "apache-2.0"
    assert scan("Licensed under the Apache Public License, Version 2.0.")[5] == ""
    assert scan("licensed under licensed under the GNU General Public License, version 3.")[5] == "gpl,gpl-3.0"
    nine = "licensed under the general public license a b c d e f g h i version 3"
    assert scan(nine)[5] == "gpl" and scan(nine.replace(" i ", " "))[5] == "gpl,gpl-3.0"
    assert scan("")[1:] == (0, None, None, "", "", 0.0)


def brute_templates(markup):
    """All word sequences of a template without replaceable regions."""
    found = [[]]
    parts = regex.split(r"<<beginOptional>>(.*?)<<endOptional>>", markup)
    for i, p in enumerate(parts):
        more = [f + p.split() for f in found]
        found = more + found if i % 2 else more
    return {" ".join(f) for f in found}


@pytest.mark.parametrize("label", [k for k, v in licenses.TEMPLATES.items() if "var" not in v])
def test_every_wording_of_a_template_is_accepted_and_no_other(label):
    scan = licenses.Scanner({}, {label: licenses.TEMPLATES[label]})
    for wording in brute_templates(licenses.TEMPLATES[label]):
        assert scan(f"x {wording} y")[5] == label
        w = wording.split()
        for i in range(len(w)):
            assert (scan(" ".join(w[:i] + ["zz"] + w[i + 1:]))[5] == label) is False


def brute_vectors(table, cosine):
    links = defaultdict(list)
    good = {}
    for i, (vid, v, label) in enumerate(table):
        if vid is None or label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, float)
        good[i] = (label, x / np.linalg.norm(x))
    for i, (la, a) in good.items():
        for j, (lb, b) in good.items():
            if i != j and la == lb and len(a) == len(b) and a @ b >= cosine:
                links[i].append(j)
    return links


def test_vectors(spark):
    rng = np.random.default_rng(3)
    table, centre = [], rng.standard_normal((6, 16))
    for i in range(220):
        x = centre[i % 6] + rng.standard_normal(16) * (0.02 if i % 6 < 4 else 3.0)
        table.append((i, x.astype(np.float32).tolist(), i % 2))
    table += [(300 + i, table[0][1], 0) for i in range(30)] + [(0, table[6][1], 0)]
    table += [(400, None, 0), (401, [], 0), (402, [0.0] * 16, 0), (403, [None] * 16, 0), (404, table[0][1], None),
              (405, [float("nan")] * 16, 0), (None, table[0][1], 0), (406, [float("inf")] * 16, 0), (407, [1.0, 2.0], 0),
              (408, [2.0, 4.0], 0)]
    df = spark.createDataFrame([(*r, "x") for r in table], "vec_id long, embedding array<float>, label int, node string")
    found = sorted_rows(vectors.near_duplicate_vectors(df, chunk=16).select(
        "vec_id", "n_links", "component_id", "kept").collect())
    links = brute_vectors(table, 0.93)
    ids = classes([(i, j) for i, js in links.items() for j in js], range(len(table)))
    least = defaultdict(list)
    for i, c in ids.items():
        least[c].append(table[i][0])
    expect = []
    for i, r in enumerate(table):
        comp = None if r[0] is None else min(x for x in least[ids[i]] if x is not None)
        expect.append((r[0], len(links[i]), comp, r[0] is not None and comp == r[0]))
    assert found == sorted_rows(expect)
    assert vectors.near_duplicate_vectors(df.limit(0)).count() == 0


def test_collision_count_reaches_the_recall():
    m, z, n = 24, 3.0, 4000
    least = vectors.calibrate(m, z, 0.995)
    rng = np.random.default_rng(1)
    gaps = rng.standard_normal((n, m))                       # projections of pairs at the threshold, in spreads
    assert ((np.abs(gaps) <= z).sum(axis=1) >= least).mean() > 0.99
    assert vectors.calibrate(m, z, 0.9999) <= least


def brute_fingerprint(text, k=4):
    w = words(text, lower=True)
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs, empty):
    data = rows()
    fps = [brute_fingerprint(r[1]) for r in data]
    ids = classes([(i, j) for i in range(len(data)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= 4],
                  range(len(data)))
    least = {}
    for i, c in ids.items():
        if data[i][0] is not None:
            least[c] = min(least.get(c, 1 << 60), data[i][0])
    expect = [(r[0], fp - (1 << 64) if fp >> 63 else fp, least.get(ids[i])) for i, (r, fp) in
              enumerate(zip(data, fps, strict=True))]
    for chunk in (4096, 2):
        found = simhash.near_duplicates(docs, chunk=chunk).select("doc_id", "fp", "component_id")
        assert sorted_rows(found.collect()) == sorted_rows(expect)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == len(set(got)) == len(set(ids.values()))
    assert sorted(d for d, _ in got if d is not None) == sorted(v for v in least.values())


@pytest.mark.parametrize("n,flips", [(3, 1), (16, 2), (17, 4), (300, 3), (700, 6)])
def test_hamming_index_links_what_brute_force_links(n, flips):
    rng = np.random.default_rng(n)
    centre = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    codes = set()
    for i in range(n):
        x = int(centre[i % 5])
        for b in rng.integers(0, 64, flips):
            x ^= 1 << int(b)
        codes.add(x)
    codes = np.array(sorted(codes, key=lambda x: int(simhash._gray_rank(np.array([x], np.uint64))[0])), np.uint64)
    root = simhash.link_group(codes, 4, tile=64)
    expect = classes([(i, j) for i in range(len(codes)) for j in range(i)
                      if int(codes[i] ^ codes[j]).bit_count() <= 4], range(len(codes)))
    for i in range(len(codes)):
        for j in range(i):
            assert (root[i] == root[j]) == (expect[i] == expect[j])


def test_masks_cover_every_pair():
    for blocks in (5, 6, 8):
        chosen = simhash.masks(4, blocks)
        rng = random.Random(blocks)
        for _ in range(300):
            diff = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(not diff & m for m in chosen)


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(500, 560)]
    links += [(900, i) for i in range(600, 700)] + [(5, 5), (5, 5)]
    found = {r.node: r.component for r in components.components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert found == {n: c for n, c in classes(links, nodes | {5}).items() if n in nodes}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(data, width):
    first = {}
    for r in data:
        if r[0] is not None:
            w = words(r[1])
            for i in range(len(w) - width + 1):
                key = tuple(w[i:i + width])
                first[key] = min(first.get(key, r[0]), r[0])
    out = []
    for r in data:
        w = words(r[1])
        gone = [False] * len(w)
        if r[0] is not None:
            for i in range(len(w) - width + 1):
                if first[tuple(w[i:i + width])] < r[0]:
                    gone[i:i + width] = [True] * width
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((r[0], len(w), sum(gone), " ".join(kept)))
    return out


@pytest.mark.parametrize("width,gram", [(50, 16), (8, 3), (3, 3), (2, 1)])
def test_substrings(docs, empty, width, gram):
    found = substrings.remove_repeats(docs, width, gram).select("doc_id", "n_words", "n_removed", "kept").collect()
    data = rows()
    assert sorted_rows(found) == sorted_rows(brute_repeats(data, width))
    assert any(r.n_removed and r.n_removed < r.n_words for r in found)
    assert substrings.remove_repeats(empty).count() == 0


def test_token_counts(docs, empty):
    tok = load(tokenizer_path())
    found = token_counts.count_tokens(docs, tokenizer_path()).select("doc_id", "n_bytes", "n_tokens").collect()
    expect = [(r[0], len((r[1] or "").encode()), len(tok.encode(r[1] or "", add_special_tokens=False).ids))
              for r in rows()]
    assert sorted_rows(found) == sorted_rows(expect)
    assert token_counts.count_tokens(empty, tokenizer_path()).count() == 0


def test_pieces_equal_the_library_on_odd_texts():
    from cinegraph.llm.bpe import counter, encoder, whole_tokens
    enc, cnt = encoder(tokenizer_path()), counter(tokenizer_path(), whole_tokens(tokenizer_path()))
    rng = random.Random(1)
    parts = [" ", " ", "\n", "\t", "  ", "a", "B", "é", "ß", "1", "٣", ".", ",", "'s", "'ll", "'", "-", "\xa0", " ",
             "\x1c", "\x85", "漢", "🙂", "​", "<|endoftext|>", "<|", "\r", "　", "\x0b", "ǅ", "²", "Ⅷ", "don't"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    texts += [s.format(chr(c)) for c in range(0x250) for s in ("{}", "a{}b", " {}", "{} ", "1{0}{0}1", "a {} b", "x\n{}")]
    for t in texts:
        ids = enc.tokenizer.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(enc(t), "<u4").tolist() == ids and cnt(t) == len(ids), repr(t)


def test_token_files(spark, docs, empty, tmp_path):
    tok, path = load(tokenizer_path()), str(tmp_path / "tokens")
    token_files.write_tokens(docs, path, tokenizer_path(), 2)
    found = token_files.with_checksums(token_files.read_tokens(spark, path)).collect()
    ids = [(r[0], tok.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in rows()]
    crc = sorted((d is None, d or 0, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in ids)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in found) == crc
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    in_order = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert in_order == sorted(in_order, key=lambda d: (d is None, d or 0))
    some = token_files.look_up(spark, path, [3, 40])
    assert some.count() == sum(r[0] in (3, 40) for r in rows())
    assert "EqualTo" in some._jdf.queryExecution().toString() or "In(doc_id" in some._jdf.queryExecution().toString()
    token_files.write_tokens(empty, str(tmp_path / "none"), tokenizer_path(), 2)


def slow_ftrl(data, s):
    z, n, size = defaultdict(float), defaultdict(float), (1 << s.bits) + 1

    def weight(i):
        if abs(z[i]) <= s.l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * s.l1) / ((s.beta + n[i] ** 0.5) / s.alpha + s.l2)
    for _ in range(s.epochs):
        for at, y in data:
            w = {i: weight(i) for i in at}
            g = 1 / (1 + np.exp(-sum(w.values()))) - y
            for i in at:
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / s.alpha * w[i]
                n[i] += g * g
    return np.array([weight(i) for i in range(size)])


def test_toxicity(spark, docs, empty):
    rng = random.Random(3)
    plain = [" ".join(f"t{rng.randrange(300)}" for _ in range(rng.randint(5, 60))) for _ in range(120)]
    bad = docs.unionByName(spark.createDataFrame(
        [(1000 + i, t + " you vile scum" * (i % 2), *rows()[0][2:]) for i, t in enumerate(plain)], SCHEMA))
    labels = spark.createDataFrame([(1000 + i, i % 2, "x") for i in range(120)] + [(None, 1, "x"), (4, None, "x"),
                                   (1001, 0, "x")], "doc_id long, toxic int, text string")
    train = F.col("doc_id") < 1100
    found = toxicity.toxic_documents(bad, labels, train).select("doc_id", "score", "predicted").collect()
    assert len(found) == bad.count()
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        if (r.doc_id or 0) >= 1100:
            assert r.predicted == r.doc_id % 2, r
    # brute force: the same optimiser over the same rows, feature by feature
    settings = toxicity.Settings(bits=12, epochs=2)
    sample = [(toxicity.buckets(t + " you vile scum" * (i % 2), 12, toxicity._Words()), i % 2) for i, t in
              enumerate(plain[:100])]
    fast = toxicity.ftrl([(np.append(np.unique(at), 1 << 12), y) for at, y in sample], settings)
    assert np.allclose(fast, slow_ftrl([(sorted(set(at.tolist())) + [1 << 12], y) for at, y in sample], settings))
    assert (fast == 0).mean() > 0.5
    kept = toxicity.keep_clean(bad, labels, train)
    assert kept.columns == docs.columns and kept.where("score = 'y'").count() == kept.count()
    no_labels = toxicity.toxic_documents(docs, labels.limit(0), F.lit(True))
    assert {(r.score, r.predicted) for r in no_labels.collect()} == {(0.0, 0)}
    assert toxicity.toxic_documents(empty, labels, F.lit(True)).count() == 0


def test_language(docs, empty):
    found = language.identify(docs, language.fit(docs, F.col("doc_id") % 2 == 0)).collect()
    assert len(found) == len(rows())
    by = defaultdict(set)
    for r in found:
        by[r.doc_id].add((r.lang_pred, r.score))
    for r in rows():
        if not regex.search(r"\p{L}", r[1] or ""):
            assert ("und", 0.0) in by[r[0]]
    assert all(r.lang_pred in ("en", "fr", "und") and 0 <= r.score <= 1 for r in found)
    assert language.identify(empty, language.fit(empty, F.lit(True))).count() == 0


def test_language_vectors_are_sums_of_bound_permuted_letters():
    letters = np.random.default_rng(2024).integers(0, 2, (48, language.SIZE)).astype(np.int8) * 2 - 1
    text, expect = " ab c ", np.zeros(language.SIZE)
    for x, y, z in zip(text, text[1:], text[2:], strict=False):
        a, b, c = (letters[0 if ch == " " else ord(ch) - 96].astype(float) for ch in (x, y, z))
        expect += np.roll(a, 2) * np.roll(b, 1) * c
    assert np.array_equal(language.encode("Ab, 1 C!"), expect)


def test_decontamination(spark, docs, empty):
    item = "If Anna buys 12 apples and then Anna sells 5 kg of pears to Boris, how much does Anna keep today?"
    bench = spark.createDataFrame([(1, item, "x"), (2, None, "x"), (3, "too short here", "x"), (4, "", "x"),
                                   (5, rows()[0][1], "x")], "item_id long, text string, doc string")
    other = item.replace("Anna", "Clara").replace("12", "7,5").replace("kg", "miles").replace("Boris", "Dora")
    mixed = other.replace("Clara keep", "Eve keep")
    cases = [(1000, "Before it. " + other + " After it."), (1001, mixed), (1002, item.lower().replace("apples", "cars")),
             (1003, "nothing of this kind stands here at all today"), (1004, None), (1005, item), (1005, item)]
    planted = spark.createDataFrame([(i, t, *rows()[0][2:]) for i, t in cases], SCHEMA)
    found = decontamination.find_contamination(docs.unionByName(planted), bench).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert {(1000, 1), (1005, 1)} <= got and not {(1001, 1), (1003, 1), (1004, 1)} & got
    assert {(d, i) for d, i in got if i == 5} == {(r[0], 5) for r in rows() if rows()[0][1] in (r[1] or "")}
    assert {i for _, i in got} == {1, 5} and len(found) == len(got)
    clean = decontamination.remove_contaminated(docs.unionByName(planted), bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == ({r[0] for r in rows()} | {c[0] for c in cases}) - {d for d, _ in got}
    assert decontamination.find_contamination(empty, bench).count() == 0
    assert decontamination.find_contamination(docs, bench.limit(0)).count() == 0


def test_decontamination_removes_rows_not_ids(spark):
    item = "which of the seven old bridges over this river was built before the great fire of that year"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    clean = [(None, "a clean text without an id"), (7, "a clean text of id seven"), (None, None), (7, "")]
    docs = spark.createDataFrame(clean + [(None, item), (7, "so " + item), (8, item)], "doc_id long, text string")
    kept = decontamination.remove_contaminated(docs, bench).collect()
    assert sorted_rows(kept) == sorted_rows(clean)


def test_decontamination_slots_beyond_an_inserted_word(spark):
    names = ("yesterday the old teacher Anna Smith walked slowly along the quiet river and then "
             "the same teacher Anna Smith read some short poems aloud to us")
    numbers = "we paid 12 30 coins for the red lamp that stood there and again 12 30 coins for the blue one"
    repeats = "then Anna met Boris and then Anna met Boris and then Anna met Boris and then all went home"
    bench = spark.createDataFrame([(1, names), (2, numbers), (3, repeats)], "item_id long, text string")
    wrong = names.replace("Anna Smith read", "Anna Jones read")
    cases = [(1, names.replace("and then", "and very then")), (2, numbers.replace("that stood", "that once stood")),
             (3, repeats), (4, wrong), (5, wrong.replace("and then", "and very then")),
             (6, names.replace("quiet ", "")), (7, repeats.replace("Anna", "Clara").replace("Boris", "Dora"))]
    docs = spark.createDataFrame([(i, "so it was that " + t) for i, t in cases], "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.find_contamination(docs, bench).collect()}
    assert found == {(1, 1), (2, 2), (3, 3), (6, 1), (7, 3)}


def test_decontamination_rewrapped_and_lower_cased_copies(spark):
    item = ("how far does Anna walk when she visits Boris near Lake Como if the trip takes 12 hours and she and "
            "Clara meet old Peter")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    wrapped = item
    for name in ("Anna", "Boris", "Lake", "Como", "Clara", "Peter"):
        wrapped = wrapped.replace(" " + name, "\n" + name if name < "C" else " \t " + name)
    other = wrapped.replace("Anna", "Eva").replace("12", "7").replace("Clara", "Rosa")
    cases = [wrapped, item.lower(), item.upper(), item.replace(" ", "\u00a0\n"), other,
             item.lower().replace("12 hours", "12\nHours"),
             "how far does a trip go when all the others visit us near the lake and they meet there again"]
    docs = spark.createDataFrame([(i, "so. " + t) for i, t in enumerate(cases)], "doc_id long, text string")
    assert {r.doc_id for r in decontamination.find_contamination(docs, bench).collect()} == set(range(6))


def test_kept_digest_rule():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
