"""Mixing's draws for rows without ids of their own, and decontamination against brute force."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cinegraph.llm import decontamination as dc
from cinegraph.llm import mixing

DOCS = "doc_id long, text string, source string, mix_key string, nth long"


def mixed_rows():
    out = [(i, f"word{i} two", "a") for i in range(3000)]
    out += [(None, f"word{i} two", "b") for i in range(3000)]                    # no ids
    out += [(7, f"word{i} two", "c") for i in range(3000)]                       # one id
    out += [(8, "the same two", "d")] * 2000 + [(None, None, None)] * 5          # rows that repeat as a whole
    return [(*r, "k", 1) for r in out]


def test_every_source_lands_near_its_target(spark):
    docs = spark.createDataFrame(mixed_rows(), DOCS).repartition(4)
    plan = mixing.plan_mix(docs)
    by = plan.groupBy("source").agg(F.first("target").alias("target"), F.sum(F.col("copies") * F.col("size")).alias("taken"),
                                    F.max("copies").alias("most"))
    for r in by.where("source is not null").collect():
        assert abs(r["taken"] - r["target"]) <= 0.05 * r["target"], r
        assert r["most"] <= 2
    rows = sorted(map(tuple, plan.collect()), key=str)
    assert rows == sorted(map(tuple, mixing.plan_mix(docs.repartition(7)).collect()), key=str)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.groupBy("source").count().orderBy("source").collect() == \
        plan.groupBy("source").agg(F.sum("copies").alias("count")).where("count > 0").orderBy("source").collect()


WIDTH, COVERAGE, DRIFT, SHORT, LEAST = 5, 0.5, 2, 8, 4


def brute(doc, item):
    """Whether an item is found in a document, by the docstring; both are lists of (template, plain)."""
    slot = [t.startswith("<") for t, _ in item]
    n = len(item)

    def same(at, start, size, form):
        return 0 <= at <= len(doc) - size and all(doc[at + i][form] == item[start + i][form] for i in range(size))
    if n < SHORT:
        values = [p for (_, p), s in zip(item, slot, strict=True) if s]
        forms = [1] + ([0] if not values or n - len(values) >= LEAST and len(set(values)) == len(values) and n > 2 else [])
        places = range(len(doc)) if n > 2 else ([0] if len(doc) == n else [])
        return any(same(at, 0, n, f) for at in places for f in forms)
    starts = range(n - WIDTH + 1)
    heavy = {p: 2 * sum(slot[p:p + WIDTH]) > WIDTH for p in starts}
    hits = defaultdict(set)
    for at in range(len(doc) - WIDTH + 1):
        for p in starts:
            if same(at, p, WIDTH, 1) or (not heavy[p] or all(heavy.values())) and same(at, p, WIDTH, 0):
                hits[at - p].add(p)
    for shift in hits:
        near = {by: hits[by] for by in hits if abs(by - shift) <= DRIFT}
        found = set().union(*near.values())
        under = {p + i for p in found for i in range(WIDTH)}
        literal = sum(not slot[i] for i in under)
        if len(found) < COVERAGE * len(starts) or literal < min(LEAST, slot.count(False)):
            continue
        values = defaultdict(set)
        for i in under:
            if slot[i]:
                by = min((b for b, ps in near.items() if any(p <= i < p + WIDTH for p in ps)), key=lambda b: (abs(b - shift), b))
                values[item[i][1]].add(doc[i + by][1])
        if all(len(v) == 1 for v in values.values()):
            return True
    return False


def sentences(rng):
    words = "who wrote the play about old kings and how many apples were sold for each box in town today".split()
    names, units = ["Anna", "Boris", "Chloe", "Dmitri"], ["kg", "hours", "miles"]

    def sentence(n):
        out = ["so"]
        while len(out) < n:
            x = rng.random()
            out += [rng.choice(names)] if x < 0.15 else [str(rng.randint(1, 99)), rng.choice(units)] if x < 0.25 else [rng.choice(words)]
        return out[:n]
    items = [sentence(n) for n in range(1, 9) for _ in range(2)] + [sentence(rng.randint(8, 30)) for _ in range(12)]
    items += [["who", "wrote", "Hamlet"], ["very"] * 7 + sentence(13), ["so", "3", "4", "5", "6", "7", "8", "9", "10", "and"]]
    docs = [["who", "wrote", "Hamlet", "Shakespeare", "did"], ["very"] * 30, ["is", "so"], ["so"]]
    for item in items:
        for _ in range(6):
            copy, kind = list(item), rng.randint(0, 5)
            if kind == 1:
                copy.insert(rng.randint(0, len(copy)), "indeed")
            if kind == 2 and len(copy) > 1:
                del copy[rng.randrange(len(copy))]
            if kind == 3:
                swap = dict(zip(names, rng.sample(names, 4), strict=True))
                copy = [swap.get(w, str(rng.randint(1, 99)) if w.isdigit() else w) for w in copy]
            if kind == 4:
                copy = copy[:rng.randint(1, len(copy))] * 2
            if kind == 5:
                copy = [w.lower() for w in copy]
            docs.append(sentence(rng.randint(1, 6)) + copy + sentence(rng.randint(1, 6)) if rng.random() < 0.8 else copy)
    return [" ".join(d) for d in docs], [" ".join(i) for i in items]


@pytest.mark.parametrize("seed", [1, 2])
def test_decontamination_equals_brute_force(spark, seed):
    texts, asked = sentences(random.Random(seed))
    docs = spark.createDataFrame([*enumerate(texts), (900, None), (901, "")], "doc_id long, text string")
    bench = spark.createDataFrame([*enumerate(asked), (900, None), (901, "...")], "item_id long, text string")

    def parsed(table, key):
        rows = table.select(key, F.transform(dc.tokens(F.col("text")), lambda t: F.struct(dc.canonical(t), dc.plain(t))).alias("t"))
        return {r[0]: [tuple(x) for x in r["t"]] for r in rows.collect()}
    there, items = parsed(docs, "doc_id"), parsed(bench, "item_id")
    want = {(d, i) for d, doc in there.items() for i, item in items.items() if item and brute(doc, item)}
    rows = dc.find_contamination(docs, bench).collect()
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    assert len(rows) == len(found) and all(0 < r["n_found"] <= r["n_windows"] and r["coverage"] <= 1 for r in rows)
    assert found == want and len(want) > 40
    hamlet = len(items) - 5
    assert asked[hamlet] == "who wrote Hamlet" and (0, hamlet) in found
    assert (1, hamlet + 1) not in found                                       # one word repeated is no item
    kept = {r["doc_id"] for r in dc.remove_contaminated(docs, bench).collect()}
    assert kept == set(there) - {d for d, _ in want}


def plain_rule(text):
    """The (template, plain) words of a text, by one pattern after another: marks to spaces, white space collapsed, units, names."""
    space, number = r"[\s\p{Z}\x1c-\x1f\x85]", r"\p{N}++(?:[.,]\p{N}++)*+"
    text = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), "\1\2", "  "), rf"{space}+", " ")
    text = F.regexp_replace(text, rf"(?<=\p{{N}} ?)(?=(?i:{'|'.join(dc.UNITS)})(?![\p{{L}}\p{{N}}]))", "\2")
    text = F.regexp_replace(text, r"(?<=[\p{L}\p{N},;] )(?=\p{Lu}\p{Ll})", "\1")
    words = F.regexp_extract_all(text, F.lit("[\1\2]?" + rf"(?:{number}(?!\p{{L}})|[\p{{L}}\p{{N}}]+)"), F.lit(0))
    return F.transform(words, lambda t: F.struct(
        F.when(t.startswith("\1"), "<name>").when(t.startswith("\2"), "<unit>").when(t.rlike(f"^{number}$"), "<number>")
        .otherwise(F.lower(t)), F.translate(F.lower(t), "\1\2", "")))


def test_words_and_windows_of_odd_texts(spark):
    rng = random.Random(3)
    bits = ["5", "12", "3.5", "1,000", "kg", "Km", "hours", "and", "x", "Anna", "BOB", "Éva", "Москва", "слово", ",", ";", ".",
            "\t", "\n", "  ", "\u00a0", "\u3000", "\x1c", "\x85", "\x01", "\x02", "5kg", "x5", "\U0001d7d3", "\u0663", "\U0001d400",
            "\u0130s", "A\u03a3", "\u6f22", "'"]
    texts = ["".join(rng.choice(bits) + " " * (rng.random() < 0.7) for _ in range(rng.randint(0, 20))) for _ in range(1500)]
    table = spark.createDataFrame([*enumerate(texts), (5000, None)], "doc_id long, text string")
    words = table.select("doc_id", "text", dc.tokens(F.col("text")).alias("words")).repartition(4)
    forms = words.select("doc_id", "text", F.transform("words", dc.canonical).alias("c"), F.transform("words", dc.plain).alias("p"),
                         plain_rule(F.col("text")).alias("rule"))
    parsed = {}
    for r in forms.collect():
        parsed[r["doc_id"]] = list(zip(r["c"], r["p"], strict=True))
        assert parsed[r["doc_id"]] == [tuple(x) for x in r["rule"]], repr(r["text"])
    hashes = {}
    for width in (1, 3, 5):
        rows = [(r["doc_id"], r["pos"], r["literal"], r["window"]) for r in dc._windows(words, width, ["doc_id"]).collect()]
        want = {}
        for d, there in parsed.items():
            for pos in range(len(there) - width + 1):
                template, literal = zip(*there[pos:pos + width], strict=True)
                want[d, pos, 0] = template
                if template != literal:
                    want[d, pos, 1] = literal
        assert len(rows) == len(want) and {r[:3] for r in rows} == set(want)
        for *key, h in rows:                                     # one hash a window, another for each other one
            assert hashes.setdefault(want[tuple(key)], h) == h
    assert len(set(hashes.values())) == len(hashes) > 10000


def test_windows_are_hashed_in_generated_code(spark):
    docs = spark.createDataFrame([(1, "one two three four five six")], "doc_id long, text string")
    windows = dc._windows(docs.select("doc_id", dc.tokens(F.col("text")).alias("words")), 5, ["doc_id"])
    plan = windows._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")).splitlines()
    hashing = [line for line in plan if "AS window" in line]
    assert len(hashing) == 1 and "*(" in hashing[0] and "lambda" not in hashing[0]
