"""Quality rules with adaptive thresholds, with DataFrame functions only.

Each rule is a whole number that a document's counts give. Every (language,
source) group keeps a mergeable quantile sketch of each rule: a histogram
whose bins keep the eight leading bits of the value (relative error under
1/128, sums of histograms are the sketch of the union). Two quantiles of the
sketch set a group's fence: the upper one plus ``reach`` times their distance,
and for some rules the lower one less as much. A group's quantiles are drawn
towards those of its language, and a language's towards those of all rows, as
if PRIOR rows of the wider sketch belonged to the narrower one; so a large
group stands for itself and a small one mostly reads the wider sketch,
without a switch. The thresholds are joined back to the rows and filter them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, SPACE, stage, text_of

#: Fixed values of the base rules.
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30


@dataclass(frozen=True)
class Rule:
    """Fails beyond high + reach * max(high - low, least), and, if two-sided,
    below low - reach * the same; low and high are quantiles (per thousand)
    of the group. ``least`` only keeps a distance where a group's sketch has
    almost none."""

    name: str
    value: str
    low: int
    high: int
    reach: int
    least: int
    two_sided: bool = False


#: Values per thousand, and hundredths of a character for the mean word. Most documents have no repeats at
#: all, so the repeat rules look at the tail of the sketch, the others at its middle half. Where no document
#: of a group's middle half has a symbol, ``least`` is the symbols' distance.
RULES = (
    Rule("symbols", "1000 * n_symbols div greatest(word_chars, 1)", 250, 750, 4, 10),
    Rule("marks", "1000 * n_marks div greatest(word_chars, 1)", 250, 750, 9, 2),
    Rule("dup_lines", "1000 * n_dup_lines div greatest(n_lines, 1)", 500, 990, 2, 50),
    Rule("repeat_words", "1000 * n_repeat_words div greatest(n_words, 1)", 500, 990, 2, 50),
    Rule("word_length", "100 * word_chars div greatest(n_words, 1)", 250, 750, 6, 8, True),
)
#: Rows of the wider sketch that count with a group's own; leading bits that a bin keeps.
PRIOR, BITS = 100, 8

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_marks")


def _let(value: Column, f) -> Column:
    """f(value), with the value evaluated once."""
    return F.transform(F.array(value), f)[0]


def _covered(hashes: Column) -> Column:
    """Words in windows of WINDOW words that occur twice or more. ``hashes``
    must be a bound value: every window looks into it."""
    def walk(found):  # (hash, place) in order; a place counts if a neighbour has its hash
        twice = F.filter(F.sequence(F.lit(0), F.size(found) - 1), lambda k: (
            F.get(found, k - 1)["h"].eqNullSafe(F.get(found, k)["h"]) | F.get(found, k + 1)["h"].eqNullSafe(F.get(found, k)["h"])))
        places = F.sort_array(F.transform(twice, lambda k: F.get(found, k)["i"]))
        return F.aggregate(places, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
                           lambda a, p: F.struct((a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n"), (p + WINDOW).alias("end")))["n"]

    def windows(step, width, h):  # hashes of windows, each of two of half the width
        if width > WINDOW:
            return _let(F.slice(h, 1, F.size(h) - WINDOW + 1), found)
        return _let(F.zip_with(h, F.slice(h, step + 1, F.size(h)), lambda a, b: F.xxhash64(a, b)), lambda x: windows(width, 2 * width, x))

    def found(w):
        return F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(_let(
            F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), walk))

    return F.when(F.size(hashes) <= WINDOW, 0).otherwise(windows(1, 2, hashes))


def counts(text: Column) -> Column:
    """A struct of COUNTS (long) of a text that is not null."""
    def of(words):
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return _let(lines, lambda found: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"),
            _let(F.transform(words, lambda w: F.xxhash64(w)), _covered).cast("long").alias("n_repeat_words"),
            F.size(found).cast("long").alias("n_lines"),
            F.length(F.regexp_replace(text, r"[^!-/:-@\[-`{-~0-9]+", "")).cast("long").alias("n_marks")))

    return _let(F.array_remove(F.split(text, SPACE), ""), of)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def measure(docs: DataFrame, keep: list[str]) -> DataFrame:
    """One pass over the texts: a row struct of the columns to keep, the
    group, the counts and the rule values."""
    counted = docs.select(
        F.struct(*[F.col(quoted(c)) for c in keep]).alias("row"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"), counts(text_of()).alias("c"))
    flat = counted.select("row", "lang", "source", *[F.col(f"c.{c}").alias(c) for c in COUNTS])
    return flat.withColumn("base_failed", base_failed()).withColumns({f"v_{r.name}": F.expr(r.value) for r in RULES})


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, rule, bin, rows: the sketch of each group. Rows that
    fail the base rules take no part."""
    shift = F.greatest(F.length(F.bin("value")) - BITS, F.lit(0))
    values = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"v_{r.name}").alias("value")) for r in RULES])).alias("v")
    return (measured.filter("NOT base_failed").select("lang", "source", values).select("lang", "source", "v.*")
            .withColumn("shift", shift).withColumn("bin", F.expr("shiftleft(shiftright(value, shift), shift)"))
            .groupBy("lang", "source", "rule", "bin").agg(F.count("*").alias("rows")))


def _quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rule, rows, low, high: the rule's two quantiles in each merged sketch."""
    merged = sketch.groupBy(*keys, "rule", "bin").agg(F.sum("rows").alias("rows"))
    by = Window.partitionBy(*keys, "rule")
    ranked = (merged.withColumn("total", F.sum("rows").over(by))
              .withColumn("upto", F.sum("rows").over(by.orderBy("bin"))))
    at = {s: F.create_map(*[F.lit(x) for r in RULES for x in (r.name, getattr(r, s))])[F.col("rule")] for s in ("low", "high")}
    q = lambda side: F.min(F.when(1000 * F.col("upto") >= at[side] * F.col("total"), F.col("bin")))
    return ranked.groupBy(*keys, "rule").agg(F.max("total").alias("rows"), q("low").alias("low"), q("high").alias("high"))


def _drawn(narrow: DataFrame, wide: DataFrame, on, prior: int) -> DataFrame:
    """The narrow sketches' quantiles, drawn towards the wide ones by their rows."""
    wide = wide.select(*[F.col(c).alias(f"w_{c}") for c in wide.columns])
    blend = {c: F.expr(f"(rows * {c} + {prior} * w_{c}) div (rows + {prior})") for c in ("low", "high")}
    return narrow.join(wide, (F.col("rule") == F.col("w_rule")) & on).withColumns(blend).select(*narrow.columns)


def thresholds(sketch: DataFrame, prior: int = PRIOR) -> DataFrame:
    """lang, source and a struct of each rule's lower and upper fence, for
    every group of the sketch. Fences are bounded in number by the groups."""
    every = _quantiles(sketch.withColumn("every", F.lit(0)), ["every"]).drop("every")
    lang = _drawn(_quantiles(sketch, ["lang"]), every, F.lit(True), prior)
    own = _drawn(_quantiles(sketch, ["lang", "source"]), lang, F.col("lang").eqNullSafe(F.col("w_lang")), prior)
    fences = []
    for r in RULES:
        spread = r.reach * F.greatest(F.col("high") - F.col("low"), F.lit(r.least))
        pick = lambda c: F.max(F.when(F.col("rule") == r.name, c))
        fences += [pick(F.col("high") + spread).alias(f"{r.name}_most"), pick(F.col("low") - spread if r.two_sided else F.lit(-1)).alias(f"{r.name}_least")]
    return own.groupBy("lang", "source").agg(F.struct(*fences).alias("fences"))


def judge(docs: DataFrame, keep: list[str] | None = None, prior: int = PRIOR, staged: bool = True) -> DataFrame:
    """Judge every row of ``docs`` (text, lang, source and any other columns).

    Returns row (a struct of the columns ``keep``, by default all), the
    counts, base_failed and kept. The counts are staged with the kept
    columns, so that the texts are read and counted once; ``staged=False``
    counts them twice and writes nothing. A null text has no words and fails;
    null lang or source form groups of their own; repeated rows are judged alike; an
    empty table gives no rows. Columns of ``docs`` may have any names.
    """
    measured = measure(docs, docs.columns if keep is None else keep)
    if staged:
        measured = stage(measured, "measures")
    fences = thresholds(sketches(measured), prior).select(
        F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), "fences")
    joined = measured.join(fences, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    passed = F.lit(True)
    for r in RULES:
        passed = passed & F.col(f"v_{r.name}").between(F.col(f"fences.{r.name}_least"), F.col(f"fences.{r.name}_most"))
    kept = ~F.col("base_failed") & F.coalesce(passed, F.lit(False))
    return joined.select("row", *COUNTS, "base_failed", kept.alias("kept"))
