"""Quality rules with adaptive thresholds from mergeable quantile sketches per language and source.

Each whole text is measured once. A measure's sketch is a histogram over buckets whose bounds
grow by ``GROWTH`` (so a quantile is off by less than that factor), with the least value seen per bucket. Such
sketches merge by adding counts: tasks fold theirs before the shuffle, and the sketches of
sources merge to those of languages and of the corpus. A group's ceiling is a high quantile moved out by a multiple of its
distance from a low one, and its floor, where low values fail too, the low one moved down alike (``MEASURES``). No
distance below the sketch's own error, one bucket, is believed; there is no other least spread. Every group's fences are averaged with those of its language, and
a language's with those of the corpus, which weigh as much as ``PRIOR`` texts: small groups lean on their parents, large ones stand alone, and no count
switches. Texts are then joined to the fences of their group; only DataFrame functions are used.

Symbols and repeats are read as (count + 3) per word, the bound that a rate without a single hit in n words still has: a
short text has an uncertain rate, and groups without any mark differ by the lengths of their texts instead of all being zero.

Windows of three words are compared by 64-bit hashes within one text.

Defined results: a null or empty text has no words and fails the base rule; null languages and sources
are groups of their own; repeated rows are each returned and counted; ties at a fence are kept; an empty
table gives an empty table; other columns are ignored. Texts are never cut off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hardwood.llm.common import staged

GROWTH, PRIOR = 1.02, 100
#: What a bucket's bounds differ by, in hundredths.
ERROR = round(100 * GROWTH) - 100
#: Measure (in thousandths): low and high quantile in hundredths, how many of their distances the fence lies beyond, and whether a low value fails too.
MEASURES = {
    "mean_word": (25, 75, 3, True), "symbols": (50, 90, 3, False), "dup_lines": (50, 98, 1, False), "repeats": (50, 95, 3, False),
}
BLANK = "[\\x20\\x09-\\x0D]+"


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base counts of every row."""
    text = F.coalesce("text", F.lit(""))
    split = docs.select(
        "doc_id", "lang", "source", text.alias("text"), F.filter(F.split(text, BLANK), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
    )
    starts = F.when(F.size("words") >= 3, F.sequence(F.lit(0), F.size("words") - 3)).otherwise(F.array().cast("array<int>"))
    window = F.transform(
        starts, lambda i: F.struct(F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("i"))
    )
    windows = split.select(
        "doc_id", "lang", "source", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.array_sort(window).alias("sorted"),
    )
    # Sorted by hash, a repeated window stands beside its like.
    repeated = F.filter(
        "sorted", lambda x, k: (x["h"] == F.get("sorted", k - 1)["h"]) | (x["h"] == F.get("sorted", k + 1)["h"])
    )
    covered = F.array_distinct(F.flatten(F.transform(repeated, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    return windows.select(*windows.columns[:-1], F.size(covered).cast("long").alias("n_repeat_words"))


def with_measures(counts: DataFrame) -> DataFrame:
    """The counts with ``base_failed`` and the measures, whole numbers."""
    return counts.withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    ).withColumns({
        name: F.expr(f"1000 * {part} div greatest({whole}, 1)")
        for name, part, whole in (
            ("mean_word", "word_chars", "n_words"), ("symbols", "(n_symbols + 3)", "n_words"), ("dup_lines", "n_dup_lines", "n_lines"),
            ("repeats", "(n_repeat_words + 3)", "n_words"),
        )
    })


def bucket(value: Column) -> Column:
    return F.when(value <= 0, F.lit(0)).otherwise(1 + F.ceil(F.log(value.cast("double")) / F.log(F.lit(GROWTH)))).cast("int")


def sketches(rows: DataFrame) -> DataFrame:
    """lang, source, measure, bucket, n and low (the least value in the bucket), from the rows that pass the base rule."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES]))
    long = rows.filter("not base_failed").select("lang", "source", values.alias("v")).select("lang", "source", "v.measure", "v.value")
    return long.groupBy("lang", "source", "measure", bucket(F.col("value")).alias("bucket")).agg(F.count("*").alias("n"), F.min("value").alias("low"))


def merged(sketch: DataFrame, *by: str) -> DataFrame:
    """Sketches of larger groups: the counts of the smaller ones added up."""
    return sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"), F.min("low").alias("low"))


def fences(sketch: DataFrame, *by: str) -> DataFrame:
    """Per group: rows, and its own floor_ and ceiling_ of each measure. Quantiles are read off the running counts of a sketch's buckets."""
    order = Window.partitionBy(*by, "measure").orderBy("bucket")
    whole = Window.partitionBy(*by, "measure")
    running = sketch.withColumns({"upto": F.sum("n").over(order), "total": F.sum("n").over(whole)})

    def quantile(m: str, part: int) -> Column:
        return F.min(F.when((F.col("measure") == m) & (100 * F.col("upto") >= part * F.col("total")), F.col("low")))

    columns = []
    for m, (lower, upper, times, both) in MEASURES.items():
        low, high = quantile(m, lower), quantile(m, upper)
        reach = times * F.greatest(high - low, F.ceil(high * ERROR / 100))
        columns += [(F.greatest(low - reach, F.lit(0)) if both else F.lit(0)).cast("long").alias(f"floor_{m}"), (high + reach).alias(f"ceiling_{m}")]
    return running.groupBy(*by).agg(F.max("total").alias("rows"), *columns)


def blended(own: Column, rows: Column, parent: Column) -> Column:
    """A group's fence with its parent's, which counts as ``PRIOR`` texts; whole numbers, rounded down."""
    sum_ = rows * own + PRIOR * parent
    return ((sum_ - F.pmod(sum_, rows + PRIOR)) / (rows + PRIOR)).cast("long")


def thresholds(rows: DataFrame) -> DataFrame:
    """lang, source and the fences that hold there: the group's own, blended with its language's, blended with the corpus's."""
    sketch = staged(sketches(rows), "sketch")
    names = [f"{side}_{m}" for m in MEASURES for side in ("floor", "ceiling")]
    own = fences(sketch, "lang", "source")
    # One row: the corpus's fences are a few numbers.
    corpus = fences(merged(sketch.withColumn("all", F.lit(1)), "all"), "all").first()
    lang = fences(merged(sketch, "lang"), "lang").select(
        F.col("lang").alias("l_lang"),
        *[blended(F.col(n), F.col("rows"), F.lit(corpus[n] if corpus else None).cast("long")).alias("l_" + n) for n in names],
    )
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("l_lang")))
    return joined.select(
        F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *[blended(F.col(n), F.col("rows"), F.col("l_" + n)).alias(n) for n in names]
    )


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, and failed (the measures outside their fences) of every row."""
    rows = staged(with_measures(measured(docs)), "measured")
    held = staged(thresholds(rows), "thresholds")
    joined = rows.join(held, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    outside = F.array_compact(F.array(*[
        F.when((F.col(m) < F.col(f"floor_{m}")) | (F.col(m) > F.col(f"ceiling_{m}")), F.lit(m)) for m in MEASURES
    ]))
    failed = F.when(F.col("base_failed"), F.lit("base")).otherwise(F.array_join(outside, ","))
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (failed == "").alias("kept"), failed.alias("failed")
    )
