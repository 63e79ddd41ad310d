"""Quality rules: a table of thresholds compiled into one projection.

A rule bounds a ratio of the figures that :func:`measured` adds. The rules become one
boolean expression, so a change of the table changes no code and adds no pass.

Defined results: a null or blank text has no words; its ratios are null, a rule whose
ratio is null fails, and the text is not kept. Equal rows get equal results. An empty
table gives an empty result. Names of added columns replace those of the input.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountwatch.llm.text import BLANKS, unused, whole, words

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
SYMBOLS = r"[#*$%&|<>]"

# Frequent function words of the four languages.
STOP_WORDS = (
    "the of and to a in is that it for was on with as by be this are at from "
    "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als "
    "de la le et les des en un du une que pour est dans qui par sur pas au avec "
    "el y los se las del por con no una su para al es lo"
).split()


@dataclass(frozen=True)
class Rule:
    """``least <= ratio <= most``, the ratio an SQL expression over the figures."""

    name: str
    ratio: str
    least: float | None = None
    most: float | None = None

    def holds(self) -> Column:
        value = F.expr(self.ratio)
        bounds = [value >= self.least] if self.least is not None else []
        bounds += [value <= self.most] if self.most is not None else []
        return F.coalesce(reduce(Column.__and__, bounds, F.lit(True)), F.lit(False))


RULES = (
    Rule("length", "n_words", 20, 1_000_000),
    Rule("word_length", "word_chars / nullif(n_words, 0)", 2.5, 14.0),
    Rule("symbols", "n_symbols / nullif(word_chars, 0)", None, 0.05),
    Rule("stop_words", "n_stop_words / nullif(n_words, 0)", 0.02, None),
    Rule("repeated_lines", "n_dup_lines / nullif(n_lines, 0)", None, 0.5),
)


def _with_window_hashes(df: DataFrame, tokens: str, out: str) -> DataFrame:
    """Adds a 64-bit hash of the eight words from each word on, by doubling: of 1, 2, 4, 8 words."""
    df = df.withColumn(out, F.transform(tokens, lambda w: F.xxhash64(w)))
    for width in (1, 2, 4):
        df = df.withColumn(out, F.zip_with(out, F.slice(out, width + 1, F.size(out)), lambda a, b: F.xxhash64(a, b)))
    full = F.greatest(F.size(tokens) - WINDOW + 1, F.lit(0))
    return df.withColumn(out, F.slice(out, 1, full))


def _repeated(hashes: Column) -> Column:
    """Words inside a window of eight that the text has twice or more.

    Most texts repeat none, which a distinct count shows; only the others sort.
    """
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(ordered: Column) -> Column:
        def twin(k: Column, other: Column) -> Column:
            return F.coalesce(F.get(ordered, k)["h"] == F.get(ordered, other)["h"], F.lit(False))

        spots = F.sequence(F.lit(0), F.size(ordered) - 1)
        twins = F.filter(spots, lambda k: twin(k, k - 1) | twin(k, k + 1))
        return F.array_sort(F.transform(twins, lambda k: F.get(ordered, k)["i"]))

    # A start covers eight words, or as many as lie between the one before and itself.
    nothing = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(-WINDOW).alias("last"))
    # The one-element array gives the sorted windows a name, so that they are made once.
    covered = F.aggregate(
        F.flatten(F.transform(F.array(placed), starts)),
        nothing,
        lambda acc, i: F.struct((acc["sum"] + F.least(F.lit(WINDOW), i - acc["last"])).cast("bigint").alias("sum"), i.alias("last")),
        lambda acc: acc["sum"],
    )
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(covered)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the figures that rules can use."""
    tokens, lines, hashes = (unused(docs, n) for n in ("quality_words", "quality_lines", "quality_hashes"))
    full_lines = F.filter(F.split(whole(text), "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    df = docs.withColumns({tokens: words(whole(text)), lines: full_lines})
    return (
        _with_window_hashes(df, tokens, hashes)
        .withColumns(
            {
                "n_words": F.size(tokens).cast("bigint"),
                "word_chars": F.length(F.array_join(tokens, "")).cast("bigint"),
                "n_symbols": F.regexp_count(whole(text), F.lit(SYMBOLS)).cast("bigint"),
                "n_lines": F.size(lines).cast("bigint"),
                "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
                "n_repeat_words": _repeated(F.col(hashes)),
                "n_stop_words": F.size(F.filter(tokens, lambda w: w.isin(*dict.fromkeys(STOP_WORDS)))).cast("bigint"),
            }
        )
        .drop(tokens, lines, hashes)
    )


def judged(figures: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The figures with ``base_failed``, ``failed_rules`` and ``kept``."""
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    failed = F.array_compact(F.array(*[F.when(~rule.holds(), F.lit(rule.name)) for rule in rules]))
    return figures.withColumns({"base_failed": base, "failed_rules": failed}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)
    )
