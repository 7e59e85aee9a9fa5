"""Quality rules with thresholds that adapt to language and source; DataFrame functions only.

Measures of each document go into quantile sketches: counts of values per language, source,
measure and bin. Bins are exact up to 2,047 and keep eleven significant bits beyond, so a
sketch has a bounded number of bins, and sketches merge by adding their counts. From them come
the quartiles of each measure, and fences three spreads outside. A group of fewer than
``LEAST_GROUP`` documents uses the sketches of its language merged, or all of them. Documents
beyond a fence are rejected. The base rules reject first; what they reject enters no sketch.

Results for odd input: null or empty text has no words and fails the base rules; null language
or source is a group like others; ids play no part, so null and repeated ids and rows are
judged each by themselves; other columns pass through ``judge``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartulary.llm.shared import BLANK, read, store

LEAST_WORDS, MOST_REPEATED = 20, 30
REPEAT = 8
LEAST_GROUP = 200
SPREADS = 3
_BLANKS = " \t\n\u000b\f\r"
_SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Measures in thousandths (mean word length: of a character), and the least spread of each.
MEASURES = {
    "word_length": ("word_chars", "n_words", 1000),
    "symbols": ("n_symbols", "word_chars", 15),
    "dup_lines": ("n_dup_lines", "n_lines", 100),
    "repeats": ("n_repeat_words", "n_words", 50),
}


def _measures() -> list[Column]:
    return [F.expr(f"{above} * 1000 div greatest({below}, 1)").alias(name) for name, (above, below, _) in MEASURES.items()]


def _covered(places: Column) -> Column:
    """Words in windows that start at the places, in order; each word once."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def step(done: Column, place: Column) -> Column:
        end = place.cast("long") + REPEAT
        return F.struct(end.alias("end"), (done["n"] + end - F.greatest(done["end"], place.cast("long"))).alias("n"))

    return F.aggregate(places, start, step, lambda done: done["n"])


def count_words(docs: DataFrame) -> DataFrame:
    """``docs`` without its ``text``, with the base counts and ``n_lines``.

    The steps are separate projections, as each is used several times by the next; what is
    handed on are plain columns, since fields of a struct would be computed anew at each use.
    """
    others = [c for c in docs.columns if c != "text"]
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = F.translate(text, _BLANKS, "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, _BLANKS, "") != "")
    words = F.filter(F.split(text, BLANK + "+", -1), lambda x: x != "")
    out = docs.select(
        *others,
        F.length(plain).cast("long").alias("word_chars"),
        (F.length(plain) - F.length(F.translate(plain, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        F.transform(words, lambda x: F.xxhash64(x)).alias("_words"),
    )
    windows = F.when(F.size("_words") <= REPEAT, F.array().cast("array<long>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size("_words") - REPEAT), lambda i: F.xxhash64(*[F.get("_words", i + j) for j in range(REPEAT)]))
    )
    out = out.select(
        *others,
        F.size("_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        windows.alias("_windows"),
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines"]
    ranked = F.array_sort(F.transform("_windows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    out = out.select(*others, *counts, F.when(repeated, ranked).alias("_ranked"))

    def again(row: Column, j: Column) -> Column:
        return (row["x"] == F.get("_ranked", j - 1)["x"]) | (row["x"] == F.get("_ranked", j + 1)["x"])

    places = F.transform(F.filter("_ranked", lambda row, j: F.coalesce(again(row, j), F.lit(False))), lambda row: row["i"])
    out = out.select(*others, *counts, F.array_sort(places).alias("_places"))
    out = out.select(*others, *counts, F.coalesce(_covered(F.col("_places")), F.lit(0)).alias("n_repeat_words"))
    # out of a generator, so that filters on the counts do not compute them a second time
    return out.select(*others, F.inline(F.array(F.struct(*counts, "n_repeat_words"))))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def sketch(counted: DataFrame) -> DataFrame:
    """``lang, source, measure, bin, n``: the quantile sketches of documents with their counts."""
    measured = counted.select("lang", "source", base_failed().alias("failed"), *_measures())
    each = F.array(*[F.struct(F.lit(name).alias("measure"), F.col(name).alias("value")) for name in MEASURES])
    rows = measured.select("lang", "source", F.explode(F.when(~F.col("failed"), each)).alias("m")).select("lang", "source", "m.measure", "m.value")
    extra = F.greatest(F.length(F.bin("value")) - 11, F.lit(0)).alias("extra")
    rows = rows.select("lang", "source", "measure", "value", extra)
    rough = F.expr("shiftleft(shiftright(value, extra), extra)").alias("bin")
    return rows.groupBy("lang", "source", "measure", rough).agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches of the same group added up."""
    return sketches.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, *by: str) -> DataFrame:
    """``measure, total, low, high`` of each group, from the quartiles of its sketch."""
    upto = Window.partitionBy(*by, "measure").orderBy("bin")
    every = Window.partitionBy(*by, "measure")
    ranked = merge(sketches, *by).withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(every))
    quartile = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bin")))
    found = ranked.groupBy(*by, "measure", "total").agg(quartile(1).alias("q1"), quartile(3).alias("q3"))
    least = F.coalesce(*[F.when(F.col("measure") == name, F.lit(m[2])) for name, m in MEASURES.items()])
    spread = F.greatest(F.col("q3") - F.col("q1"), least)
    return found.select(*by, "measure", "total", (F.col("q1") - SPREADS * spread).alias("low"), (F.col("q3") + SPREADS * spread).alias("high"))


def thresholds(sketches: DataFrame) -> DataFrame:
    """``lang, source, fences`` of each group: a struct of low and high for each measure."""
    own = fences(sketches, "lang", "source")
    language = fences(sketches, "lang").select(F.col("lang").alias("l"), F.col("measure").alias("m"), F.col("total").alias("t"), F.struct("low", "high").alias("of_language"))
    every = fences(sketches).select(F.col("measure").alias("e"), F.struct("low", "high").alias("of_all"))
    joined = own.join(language, F.col("lang").eqNullSafe(F.col("l")) & (F.col("measure") == F.col("m"))).join(every, F.col("measure") == F.col("e"))
    chosen = F.when(F.col("total") >= LEAST_GROUP, F.struct("low", "high")).when(F.col("t") >= LEAST_GROUP, F.col("of_language")).otherwise(F.col("of_all"))
    one = [F.max(F.when(F.col("measure") == name, chosen)).alias(name) for name in MEASURES]
    return joined.groupBy("lang", "source").agg(F.struct(*one).alias("fences"))


def verdict(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """``counted`` (``lang, source`` and the counts) with ``base_failed`` and ``kept``.

    ``limits`` has a row for each language and source; it is small or not, which the optimizer
    sees from its files.
    """
    limits = limits.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "fences")
    joined = counted.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    joined = joined.withColumns({f"_{name}": m for name, m in zip(MEASURES, _measures(), strict=True)})
    inside = F.lit(True)
    for name in MEASURES:
        inside = inside & F.col(f"_{name}").between(F.col(f"fences.{name}.low"), F.col(f"fences.{name}.high"))
    out = joined.withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))).drop("_lang", "_source", "fences", *[f"_{n}" for n in MEASURES])


def judge(docs: DataFrame) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), the counts, ``base_failed`` and ``kept``.

    ``docs`` needs ``text, lang, source``. Texts are counted once, written with their counts, and not shuffled.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), "text", "lang", "source")
    counted = store(count_words(rows), "counted")
    limits = store(thresholds(sketch(counted)), "fences")
    return verdict(counted, limits)


def quality_rules(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` for each row of ``docs`` (``doc_id, text, lang, source``)."""
    counted = store(count_words(docs.select("doc_id", "text", "lang", "source")), "counts")
    limits = store(thresholds(sketch(counted)), "fences")
    return verdict(counted, limits).select("doc_id", *COUNTS, "base_failed", "kept")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"))
