"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Words become tokens; numbers, names (capitalised words inside a sentence) and units
(after a number) become typed placeholders, so a question with other parameters has the
same template.  Windows of consecutive tokens of the benchmark items are hash-joined to
the documents' windows, as templates and as plain lower-cased words (names are told by
capitals, which a copy may have lost); either form is a match.  Matches are gathered per document, item and alignment; an item
counts as found when enough of its windows lie in one place and its slots agree: within a
place, one original value must always have been replaced by one and the same value.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import fresh

# Units recognised after a number.
UNITS = ("kg g mg lb lbs oz km m cm mm mi ft in l ml s sec secs second seconds min mins minute minutes "
         "h hr hrs hour hours day days week weeks month months year years mile miles meter meters metre "
         "metres foot feet inch inches gram grams kilogram kilograms liter liters litre litres dollar "
         "dollars euro euros cent cents usd eur percent mph kmh").split()

_NAME, _UNIT = "\u0001", "\u0002"
_SPACE = r"[[^!-~]&&[\s\p{Z}\x1c-\x1f\x85]]"     # most characters fail the first part
_NUMBER = r"\p{N}++(?:[.,]\p{N}++)*+"
_TOKEN = rf"[{_NAME}{_UNIT}]?(?:{_NUMBER}(?!\p{{L}})|[\p{{L}}\p{{N}}]+)"


def tokens(text: Column) -> Column:
    """The words of a text in order, names and units marked by their first character."""
    text = F.coalesce(text, F.lit(""))
    text = F.when(text.contains(_NAME) | text.contains(_UNIT), F.translate(text, _NAME + _UNIT, "  ")).otherwise(text)
    # the patterns begin with what is rare, a digit or a white space, and look around from there
    units = F.regexp_replace(text, rf"\p{{N}}(?:(?<=\p{{N}}){_SPACE}++)?+(?=(?i:{'|'.join(UNITS)})(?![\p{{L}}\p{{N}}]))",
                             "$0" + _UNIT)
    # a capitalised word after a word or a comma (not after a sentence's end)
    named = F.regexp_replace(units, rf"{_SPACE}(?<=[\p{{L}}\p{{N}},;]{_SPACE}){_SPACE}*+(?=\p{{Lu}}\p{{Ll}})", " " + _NAME)
    return F.regexp_extract_all(named, F.lit(_TOKEN), F.lit(0))


def _latin(token: Column) -> Column:
    """Whether a token begins with A-Z or a-z: neither marked nor a number."""
    return (token >= "A") & (token < "{")


def canonical(token: Column) -> Column:
    """A token's template form: itself in lower case, or its type."""
    return (F.when(_latin(token), F.lower(token)).when(token.startswith(_NAME), F.lit("<name>"))
            .when(token.startswith(_UNIT), F.lit("<unit>")).when(token.rlike(f"^{_NUMBER}$"), F.lit("<number>"))
            .otherwise(F.lower(token)))


def plain(token: Column) -> Column:
    """A token without its mark, in lower case."""
    return F.lower(F.when(_latin(token), token).otherwise(F.ltrim(token, F.lit(_NAME + _UNIT))))


def _windows(rows: DataFrame, width: int, keep: list[str]) -> DataFrame:
    """``keep`` columns, pos, window hash and literal (0: template, 1: plain words) of every
    window of column ``words``; the plain form only where it differs."""
    hashed = rows.withColumn("plains", F.transform("words", lambda t: F.xxhash64(plain(t))))
    codes = F.zip_with("words", "plains", lambda t, p: F.when(_latin(t), p).otherwise(F.xxhash64(canonical(t))))
    # templates, then plain words: a window is hashed after the explode, in generated code
    forms = hashed.select(*keep, F.size("words").alias("n"), F.concat(codes, "plains").alias("forms"))
    at, n = F.col("at"), F.col("n")
    literal = at >= n
    pos = F.when(literal, at - n).otherwise(at)
    window = [F.get("forms", at + k) for k in range(width)]
    differs = reduce(or_, (w != F.get("forms", at + k - n) for k, w in enumerate(window)))
    # outer: an inner explode makes Catalyst filter on the array's size below the
    # projections, where it would compute the hashes again
    return (forms.select(*keep, "n", "forms", F.posexplode_outer("forms").alias("at", "code"))
            .where((pos <= n - width) & (~literal | differs))
            .select(*keep, pos.alias("pos"), F.xxhash64(*window).alias("window"), literal.cast("int").alias("literal")))


def _row_hash() -> Column:
    """What a document is told apart by: its id and text, in two hash lanes."""
    return F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64(F.lit(7), "doc_id", "text").alias("b"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = 5, coverage: float = 0.5,
                       drift: int = 2, short: int = 8, least_words: int = 4) -> DataFrame:
    """(doc_id, item_id, n_windows, n_found, coverage, n_slots), one row per document id,
    text and benchmark item found in it.

    An item of ``short`` tokens or more is found when at least ``coverage`` of all its
    windows match in one place (up to ``drift`` inserted or lost tokens), each counted
    once, when the matched windows hold ``least_words`` of its literal words (or all of
    them), and when its slots are consistent.  Windows of which more than half are slots
    match as plain words only, unless the item has no others.

    Shorter items are found by their whole token sequence, as plain words or, with
    ``least_words`` literal words and no slot value twice, as a template; one or two tokens
    stand in any text, so such an item is found only where it is the whole document.  They
    have one window.

    Items without tokens are not searched.  Null and empty texts match nothing; repeated
    rows (same id and text) give one row; null ids match like any other; other columns are
    not read; empty tables give an empty result."""
    return _find(docs, benchmark, width, coverage, drift, short, least_words).drop("doc")


def _find(docs: DataFrame, benchmark: DataFrame, width: int = 5, coverage: float = 0.5, drift: int = 2,
          short: int = 8, least_words: int = 4) -> DataFrame:
    """The rows of ``find_contamination`` with the hashes ``doc`` of the document's id and text."""
    if short < width:
        raise ValueError("items shorter than a window must be searched whole")
    items = (benchmark.where(F.col("text").isNotNull())
             .select("item_id", F.struct(F.xxhash64("item_id", "text").alias("a"), F.xxhash64(F.lit(7), "item_id", "text")
                                         .alias("b")).alias("item"), tokens(F.col("text")).alias("words"))
             .where(F.size("words") > 0).dropDuplicates(["item"]))
    slot = F.transform("words", lambda t: canonical(t).rlike("^<").cast("int"))
    items = materialize(items.withColumn("slot", slot), "benchmark-items")
    long_items = items.where(F.size("words") >= short)
    index = (_windows(long_items, width, ["item", "words", "slot"])
             .withColumn("slots", F.aggregate(F.slice("slot", F.col("pos") + 1, width), F.lit(0), lambda a, x: a + x)))
    usable = F.max((F.col("slots") * 2 <= width).cast("int")).over(Window.partitionBy("item"))
    index = (index.withColumn("usable", usable)
             .where((F.col("literal") == 1) | (F.col("slots") * 2 <= width) | (F.col("usable") == 0))
             .select("item", "window", (F.size("words") - (width - 1)).alias("n_windows"), F.col("pos").alias("item_pos"),
                     "slots"))
    index = materialize(index, "benchmark-windows")

    rows = docs.select("doc_id", _row_hash().alias("doc"), tokens(F.col("text")).alias("words"))
    hits = (_windows(rows, width, ["doc_id", "doc"]).join(index, "window")
            .withColumn("shift", F.col("pos") - F.col("item_pos"))
            .groupBy("doc", "item", "shift", "item_pos")
            .agg(F.first("doc_id").alias("doc_id"), F.first("n_windows").alias("n_windows"),
                 F.first("slots").alias("slots")))
    places = (hits.groupBy("doc", "item", "shift")
              .agg(F.first("doc_id").alias("doc_id"), F.first("n_windows").alias("n_windows"),
                   F.collect_set("item_pos").alias("matched"), F.max("slots").alias("slots")))
    near = Window.partitionBy("doc", "item").orderBy("shift").rangeBetween(-drift, drift)
    best = (places.withColumn("any_slots", F.max("slots").over(near))
            .withColumn("pooled", F.collect_list(F.struct(F.col("shift").alias("by"), "matched")).over(near))
            .withColumn("windows", F.array_distinct(F.flatten("pooled.matched")))
            .withColumn("n_found", F.size("windows"))
            .where(F.col("n_found") >= F.lit(coverage) * F.col("n_windows")))
    # literal words of the item under matched windows
    under = F.array_distinct(F.flatten(F.transform("windows", lambda p: F.sequence(p, p + (width - 1)))))
    literal = F.aggregate(under, F.lit(0), lambda a, i: a + 1 - F.element_at("slot", (i + 1).cast("int")))
    all_literal = F.aggregate("slot", F.lit(0), lambda a, x: a + 1 - x)
    found = materialize(best.join(items.select("item", "slot"), "item")
                        .where(literal >= F.least(F.lit(least_words), all_literal)).drop("slot", "windows"),
                        "contamination-places")

    free = found.where("any_slots = 0").withColumn("n_slots", F.lit(0).cast("long"))
    checked = _consistent(found.where("any_slots > 0"), docs, items, width)
    keep = ["doc", "item", "doc_id", "n_windows", "n_found", "n_slots"]
    matched = free.select(keep).union(checked.select(keep)).groupBy("doc", "item").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_windows").alias("n_windows"),
        F.max("n_found").alias("n_found"), F.max("n_slots").cast("long").alias("n_slots"))
    long_found = (matched.join(items.select("item", "item_id"), "item")
                  .select("doc", "doc_id", "item_id", F.col("n_windows").cast("long").alias("n_windows"),
                          F.col("n_found").cast("long").alias("n_found"),
                          (F.col("n_found") / F.col("n_windows")).alias("coverage"), "n_slots"))
    return long_found.unionByName(_find_short(rows, items, short, least_words))


def _find_short(rows: DataFrame, items: DataFrame, short: int, least_words: int) -> DataFrame:
    """Items below ``short`` tokens, by windows of each of their lengths."""
    few = items.where(F.size("words") < short)
    lengths = sorted(r["n"] for r in few.select(F.size("words").alias("n")).distinct().collect())   # under ``short``
    one = F.lit(1).cast("long")
    out = rows.sparkSession.createDataFrame([], rows.select("doc", "doc_id").schema.add(items.schema["item_id"])) \
        .select("*", one.alias("n_windows"), one.alias("n_found"), F.lit(1.0).alias("coverage"), one.alias("n_slots"))
    for n in lengths:
        slots = F.aggregate("slot", F.lit(0), lambda a, x: a + x)
        values = F.transform(F.filter(F.arrays_zip("words", "slot"), lambda z: z["slot"] == 1), lambda z: F.lower(z["words"]))
        index = (_windows(few.where(F.size("words") == n), n, ["item_id", "slot", "words"])
                 .select("item_id", "window", "literal", slots.cast("long").alias("slots"),
                         F.size(F.array_distinct(values)).alias("different"))
                 .where((F.col("literal") == 1) | (F.col("slots") == 0)
                        | ((F.lit(n) - F.col("slots") >= least_words) & (F.col("slots") == F.col("different")))))
        if n <= 2:
            index = index.where((F.col("literal") == 1) | (F.col("slots") == 0))
        searched = rows if n > 2 else rows.where(F.size("words") == n)
        hits = (_windows(searched, n, ["doc_id", "doc"]).join(materialize(index, "short-items"), "window")
                .groupBy("doc", "doc_id", "item_id").agg(F.max("slots").alias("n_slots")))
        out = out.unionByName(hits.select("doc", "doc_id", "item_id", one.alias("n_windows"), one.alias("n_found"),
                                          F.lit(1.0).alias("coverage"), "n_slots"))
    return out


def _consistent(places: DataFrame, docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """The places whose slots agree; only documents with such places are read again.

    A slot is compared where a window over it matched, at that window's own shift (of
    several, the one nearest to the place's); slots outside matched windows say nothing."""
    wanted = places.select("doc").distinct()
    words = (docs.select(_row_hash().alias("doc"), "text").join(wanted, "doc", "left_semi")
             .dropDuplicates(["doc"]).select("doc", tokens(F.col("text")).alias("there")))
    slots = (items.select("item", F.posexplode("words").alias("at", "original"))
             .where(canonical(F.col("original")).startswith("<")))
    matched = (places.select("doc", "item", "shift", F.explode("pooled").alias("p"))
               .select("doc", "item", "shift", "p.by", F.explode("p.matched").alias("start"))
               .select("doc", "item", "shift", "by", F.explode(F.sequence("start", F.col("start") + (width - 1))).alias("at"))
               .groupBy("doc", "item", "shift", "at")
               .agg(F.min_by("by", F.struct(F.abs(F.col("by") - F.col("shift")), "by")).alias("by")))
    pairs = (matched.join(slots, ["item", "at"]).join(words, "doc")
             .withColumn("value", plain(F.get("there", F.col("at") + F.col("by"))))
             .groupBy("doc", "item", "shift", F.lower("original").alias("original"))
             .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("value").alias("values")))
    verdict = pairs.groupBy("doc", "item", "shift").agg(F.max("values").alias("most"), F.sum("n").alias("n_slots"))
    return (places.join(verdict, ["doc", "item", "shift"], "left")
            .where(F.coalesce("most", F.lit(1)) == 1)
            .withColumn("n_slots", F.coalesce("n_slots", F.lit(0))))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, with all their columns.

    Rows go by id and text (null ids too), so a repeated row goes with its like; null and
    empty texts stay; nulls, very long texts and short items as in ``find_contamination``;
    other columns may be called anything; an empty table gives none."""
    mark = fresh(docs, "contaminated_doc")[0]
    found = _find(docs, benchmark, **how).select(F.col("doc").alias(mark)).distinct()
    return docs.join(materialize(found, "contaminated"), _row_hash() == F.col(mark), "left_anti")
