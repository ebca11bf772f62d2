"""Operator 9: quality rules with adaptive thresholds.

Every rule is a measure of the text.  For each language and source its values go
into a mergeable quantile sketch: a histogram with logarithmic bins (about 1 %
relative width), kept as rows (group, rule, bin, count), merged by adding counts.
A group's threshold lies ``reach`` spreads above its median, so it follows the
language and source instead of being one fixed cutoff.  Groups with few documents
use the merged sketch of their language, or of the whole corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from actuaria.llm.common import SPACE_CHARS, Workspace, words_of


@dataclass(frozen=True)
class Rule:
    """A measure that is too high beyond median + reach * max(spread, least).

    The spread is the distance from the median to the quantile of 7/8, which up to an eighth of junk does not
    move; ``least`` holds where hardly any document of a group has the measure at all, so that
    the first ones that do are not junk for that.
    """

    name: str
    value: str
    least: float
    reach: float = 16.0


#: The measures are shares, of the words, word characters or lines of a text.
RULES = (
    Rule("symbols", "n_symbols / word_chars", 0.0015),
    Rule("lines", "n_dup_lines / n_lines", 0.025),
    Rule("repeats", "n_repeat_words / n_words", 0.01),
    Rule("capitals", "n_capitals / word_chars", 0.002),
    Rule("marks", "n_marks / word_chars", 0.0075),
)


def bind(value: Column, body) -> Column:
    """body(value) with the value computed once, also where lambdas use it."""
    return F.get(F.transform(F.array(value), body), 0)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts that the rules use, one row per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(
        "doc_id", "lang", "source", words_of(F.col("text")).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "").alias("lines"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.regexp_count(text, F.lit("[!?;:]")).cast("long").alias("n_marks"),
    )
    n = F.size("words")
    windows = F.transform("words", lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    hashed = split.select(
        "doc_id", "lang", "source", "n_symbols", "n_capitals", "n_marks", n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, F.slice(windows, 1, F.greatest(n - 2, F.lit(1)))).otherwise(F.array().cast("array<bigint>")).alias("windows"),
    )
    # Windows found twice or more: neighbours in the sorted array that are equal.
    ordered = hashed.withColumn(
        "ordered",
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array("windows")).otherwise(
            F.array().cast("array<bigint>")
        ),
    )
    twice = ordered.withColumn(
        "twice", F.array_distinct(F.filter("ordered", lambda h, i: h == F.get("ordered", i - 1)))
    ).drop("ordered")
    # Dealt over about sqrt(size) lists, so that a look-up stays short in very long texts.
    lists = F.greatest(F.ceil(F.sqrt(F.size("twice"))).cast("int"), F.lit(1))
    dealt = lambda n: F.transform(
        F.sequence(F.lit(0), n - 1), lambda k: F.filter("twice", lambda h: F.pmod(h, n).cast("int") == k)
    )
    looked_up = bind(
        lists,
        lambda n: bind(dealt(n), lambda d: F.transform("windows", lambda h: F.array_contains(F.get(d, F.pmod(h, n).cast("int")), h))),
    )
    marked = twice.withColumn("marked", F.when(F.size("twice") > 0, looked_up))
    covered = F.size(
        F.filter(
            F.sequence(F.lit(0), F.col("n_words").cast("int") - 1),
            lambda p: F.coalesce(F.get("marked", p), F.lit(False))
            | F.coalesce(F.get("marked", p - 1), F.lit(False))
            | F.coalesce(F.get("marked", p - 2), F.lit(False)),
        )
    )
    return marked.withColumn("n_repeat_words", F.when(F.size("twice") > 0, covered).otherwise(0).cast("long")).drop(
        "windows", "twice", "marked"
    )


#: Values below LOWEST share bin 0; bin k > 0 holds [LOWEST * 2^((k-1)/DEPTH), LOWEST * 2^(k/DEPTH)).
LOWEST, DEPTH = 0.0001, 64


def bin_of(value: Column) -> Column:
    return F.when(value < LOWEST, 0).otherwise(F.floor(F.log2(value / LOWEST) * DEPTH) + 1).cast("int")


def bin_value(k: Column) -> Column:
    """The upper end of a bin, so that a threshold is never below the values it stands for."""
    return F.when(k == 0, F.lit(0.0)).otherwise(F.lit(LOWEST) * F.pow(F.lit(2.0), k.cast("double") / DEPTH))


def sketches(values: DataFrame, keys: list[str]) -> DataFrame:
    """(keys.., rule, value) → (keys.., rule, bin, n): merged by summing n."""
    return values.groupBy(*keys, "rule", bin_of(F.col("value")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def quantiles(sketch: DataFrame, keys: list[str], points: dict[str, float]) -> DataFrame:
    """The bins' quantiles per group and rule, with the number of values ``held``."""
    group = Window.partitionBy(*keys, "rule")
    summed = sketch.withColumn("held", F.sum("n").over(group)).withColumn(
        "upto", F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    )
    return summed.groupBy(*keys, "rule").agg(
        F.max("held").alias("held"),
        *[F.min(F.when(F.col("upto") >= F.col("held") * q, bin_value(F.col("bin")))).alias(name) for name, q in points.items()],
    )


def thresholds(sketch: DataFrame, rules: tuple[Rule, ...], least_docs: int) -> DataFrame:
    """(lang, source) sketches → (lang, source, rule, threshold), null-safe keys.

    The first of (lang, source), (lang), () whose sketch holds ``least_docs`` values
    gives the threshold; the corpus does whatever it holds.
    """
    points = {"q50": 0.5, "q875": 0.875}
    merged = lambda keys: sketch.groupBy(*keys, "rule", "bin").agg(F.sum("n").alias("n"))
    own = quantiles(sketch, ["lang", "source"], points)
    by_lang = quantiles(merged(["lang"]), ["lang"], points).select(
        F.col("lang").alias("l"), F.col("rule").alias("lr"), *[F.col(c).alias(f"l_{c}") for c in ("held", *points)]
    )
    overall = quantiles(merged([]), [], points).select(F.col("rule").alias("r"), *[F.col(c).alias(f"all_{c}") for c in points])
    joined = own.join(by_lang, F.col("lang").eqNullSafe(F.col("l")) & (F.col("rule") == F.col("lr"))).join(
        overall, F.col("rule") == F.col("r")
    )
    pick = lambda c: F.when(F.col("held") >= least_docs, F.col(c)).when(F.col("l_held") >= least_docs, F.col(f"l_{c}")).otherwise(F.col(f"all_{c}"))  # noqa: E731, E501
    of = lambda attr: F.element_at(F.create_map(*[F.lit(x) for r in rules for x in (r.name, getattr(r, attr))]), F.col("rule"))  # noqa: E731, E501
    spread = F.greatest(pick("q875") - pick("q50"), of("least"))
    return joined.select("lang", "source", "rule", (pick("q50") + of("reach") * spread).alias("threshold"))


def judge(
    docs: DataFrame,
    work: Workspace,
    rules: tuple[Rule, ...] = RULES,
    least_words: int = 50,
    most_repeat_percent: int = 50,
    least_docs: int = 100,
) -> DataFrame:
    """One row per document: doc_id, lang, source, the counts, base_failed, n_broken, kept.

    ``base_failed``: fewer than ``least_words`` words, or more than
    ``most_repeat_percent`` percent of the words in repeated 3-word windows.  The
    sketches hold the documents that pass the base.  ``n_broken`` counts the rules
    whose measure is above the threshold of the document's language and source;
    ``kept`` = base passed and no rule broken.  Null and empty texts have no words
    and fail the base.  Null languages and sources are groups of their own.
    Repeated rows count and come each.  An empty table gives an empty one.
    Other columns of ``docs`` are not read.  A hot source costs one partial sketch
    per task: at most a few thousand bins for each rule and group.
    """
    measured = work.write(measures(docs), "measures").withColumn(
        "base_failed",
        (F.col("n_words") < least_words) | (F.lit(100) * F.col("n_repeat_words") > F.lit(most_repeat_percent) * F.col("n_words")),
    )
    valued = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.expr(f"double({r.value})").alias("value")) for r in rules])
    values = measured.filter("not base_failed").select("lang", "source", F.inline(valued))
    limits = work.write(thresholds(sketches(values, ["lang", "source"]), rules, least_docs), "thresholds")
    wide = limits.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("rule") == r.name, F.col("threshold"))).alias(f"t_{r.name}") for r in rules]
    )
    wide = wide.withColumnsRenamed({"lang": "t_lang", "source": "t_source"})
    judged = measured.join(wide, F.col("lang").eqNullSafe(F.col("t_lang")) & F.col("source").eqNullSafe(F.col("t_source")), "left")
    broken = [F.when(~F.col("base_failed") & (F.expr(f"double({r.value})") > F.col(f"t_{r.name}")), 1).otherwise(0) for r in rules]
    return (
        judged.withColumn("n_broken", sum(broken[1:], broken[0]).cast("long"))
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_broken") == 0))
        .drop("t_lang", "t_source", *[f"t_{r.name}" for r in rules])
    )
