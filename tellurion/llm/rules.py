"""Quality rules with thresholds learned per language and source (operator 4).

All steps are DataFrame functions. ``features`` counts words, symbols, repeated
lines and repeated word windows of whole texts, row by row. ``sketch`` turns each
measure into a quantile sketch per language and source: counts of logarithmic
buckets, which are whole numbers, so sketches of any parts of a corpus merge by
adding counts and give the same quantiles however the rows were dealt. A bucket
is at most a sixteenth of its value wide. ``thresholds`` reads quartiles off the
sketches and sets cutoffs beyond them; languages and sources with few documents
use the merged sketch of their language, or of all. ``verdicts`` joins them back.

The features are written once and read twice. Groups are pre-aggregated before
the shuffle, so a hot source costs one row per bucket and task; thresholds have
one row per language and source.

Cases: a null text has no words. Documents that fail the base rules are not kept
and do not take part in the sketches. Null languages and sources are groups of
their own. Repeated rows and ids are judged row by row. An empty table gives no
row. Columns of other names are not read. Words are compared by 64-bit hashes of
three words within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tellurion.llm.common import staged

#: ASCII white space: space, tab, line feed, vertical tab, form feed, return.
SPACE = " \t\n\x0b\f\r"
SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Measures in parts of 10,000, and the least spread assumed for each.
MEASURES = {"word_length": 5000, "symbols": 500, "dup_lines": 500, "repeats": 500}
TWO_SIDED = ("word_length",)
WIDTH = 4
MIN_ROWS = 200
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _less(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _covered(positions: Column) -> Column:
    """Words covered by the three-word windows at ascending positions."""
    start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
    step = lambda a, p: F.struct(
        (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")
    )
    return F.aggregate(positions, start, step)["n"]


def features(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Counts of every text and the outcome of the base rules."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    hashes = F.transform(
        F.filter(F.split("text", SPACES), lambda w: w != ""), lambda w: F.xxhash64(w)
    )
    lines = F.filter(F.split("text", "\n"), lambda line: _less(line, SPACE) != "")
    rows = rows.select(
        "doc_id", "lang", "source",
        hashes.alias("hashes"),
        lines.alias("lines"),
        F.length(_less(F.col("text"), SPACE)).alias("word_chars"),
        (F.length("text") - F.length(_less(F.col("text"), SYMBOLS))).alias("n_symbols"),
    )
    n = F.size("hashes")
    windows = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(
            F.get("hashes", i), F.get("hashes", i + 1), F.get("hashes", i + 2)
        ),
    )
    rows = rows.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols",
        n.alias("n_words"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(n >= 3, windows).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    repeated = F.size("windows") > F.size(F.array_distinct("windows"))
    placed = F.sort_array(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    rows = rows.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols", "n_words", "n_lines", "n_dup_lines",
        F.when(repeated, placed).alias("placed"),
    )

    def twice(item: Column, at: Column) -> Column:
        return F.coalesce(F.get("placed", at - 1)["h"] == item["h"], F.lit(False)) | F.coalesce(
            F.get("placed", at + 1)["h"] == item["h"], F.lit(False)
        )

    positions = F.sort_array(F.transform(F.filter("placed", twice), lambda s: s["i"]))
    repeats = F.when(F.col("placed").isNull(), F.lit(0)).otherwise(_covered(positions))
    rows = rows.withColumn("n_repeat_words", repeats).drop("placed")
    rows = rows.withColumns({c: F.col(c).cast("long") for c in (*COUNTS, "n_lines")})
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return rows.withColumn("base_failed", failed)


def measured(counts: DataFrame) -> DataFrame:
    """Add the measures that have thresholds, as whole parts of 10,000 (0 without words)."""

    def parts(part: str, whole: str) -> Column:
        return F.expr(f"if({whole} > 0, 10000 * {part} div {whole}, 0L)")

    return counts.withColumns(
        {
            "word_length": parts("word_chars", "n_words"),
            "symbols": parts("n_symbols", "n_words"),
            "dup_lines": parts("n_dup_lines", "n_lines"),
            "repeats": parts("n_repeat_words", "n_words"),
        }
    )


def bucket(value: Column) -> Column:
    """Least value of the bucket of a whole number: its five leading bits."""
    drop = F.greatest(F.length(F.bin(value)) - 5, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketch(rows: DataFrame) -> DataFrame:
    """Bucket counts of each measure per language and source."""
    pairs = F.explode(
        F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES))
    )
    exploded = rows.where(~F.col("base_failed")).select("lang", "source", pairs.alias("p"))
    return exploded.groupBy(
        "lang", "source", F.col("p.measure").alias("measure"), bucket(F.col("p.value")).alias("bucket")
    ).agg(F.count(F.lit(1)).alias("n"))


def merged(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of coarser groups, or of several corpora, by adding counts."""
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, lower and upper quartile of each group and measure."""
    group = Window.partitionBy(*keys, "measure")
    below = F.sum("n").over(group.orderBy("bucket"))
    ranked = sketches.select(
        *keys, "measure", "bucket", below.alias("below"), F.sum("n").over(group).alias("rows")
    )

    def quantile(part: int) -> Column:
        return F.min(F.when(4 * F.col("below") >= part * F.col("rows"), F.col("bucket")))

    return ranked.groupBy(*keys, "measure").agg(
        F.max("rows").alias("rows"), quantile(1).alias("low"), quantile(3).alias("high")
    )


def thresholds(sketches: DataFrame, width: int = WIDTH, min_rows: int = MIN_ROWS) -> DataFrame:
    """Cutoffs of each language and source: one row with a lower and upper bound per measure."""

    def cutoffs(keys: list[str], prefix: str) -> DataFrame:
        found = quartiles(sketches if len(keys) == 2 else merged(sketches, keys), keys)
        least = F.create_map(*(F.lit(x) for item in MEASURES.items() for x in item))[F.col("measure")]
        spread = width * F.greatest(F.col("high") - F.col("low"), least)
        bounds = F.struct((F.col("low") - spread).alias("low"), (F.col("high") + spread).alias("high"))
        return found.groupBy(*(F.col(k).alias(f"{prefix}_{k}") for k in keys)).agg(
            F.max("rows").alias(f"{prefix}_rows"),
            F.map_from_entries(F.collect_list(F.struct("measure", bounds))).alias(f"{prefix}_cut"),
        )

    own, lang = cutoffs(["lang", "source"], "own"), cutoffs(["lang"], "lang")
    every = cutoffs([], "all").withColumn("one", F.lit(1))
    joined = own.join(lang, F.col("own_lang").eqNullSafe(F.col("lang_lang")), "left")
    joined = joined.withColumn("one", F.lit(1)).join(every, "one", "left")
    chosen = (
        F.when(F.col("own_rows") >= min_rows, F.col("own_cut"))
        .when(F.col("lang_rows") >= min_rows, F.col("lang_cut"))
        .otherwise(F.col("all_cut"))
    )
    return joined.select(F.col("own_lang"), F.col("own_source"), chosen.alias("cut"))


def verdicts(rows: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Whether each document passes the base rules and the cutoffs of its group."""
    joined = rows.join(
        cutoffs,
        F.col("lang").eqNullSafe(F.col("own_lang")) & F.col("source").eqNullSafe(F.col("own_source")),
        "left",
    )
    within = F.lit(True)
    for name in MEASURES:
        cut = F.col("cut")[name]
        within = within & (F.col(name) <= cut["high"])
        if name in TWO_SIDED:
            within = within & (F.col(name) >= cut["low"])
    kept = ~F.col("base_failed") & F.coalesce(within, F.lit(True))
    return joined.withColumn("kept", kept).drop("own_lang", "own_source", "cut")


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    width: int = WIDTH,
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Counts, measures and verdict of every document."""
    rows = staged(measured(features(docs, id_col, text_col, lang_col, source_col)), "rule-counts")
    return verdicts(rows, thresholds(sketch(rows), width, min_rows))
