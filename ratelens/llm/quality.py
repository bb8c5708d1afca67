"""Quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once per document.  The ledger keeps the
measurements and one bit per failed rule; policies are versioned bit masks
that are applied afterwards, and ablations ("what would rule *k* alone
drop?") are bitwise aggregations over the ledger, so neither reads a text
again.  Nothing is shuffled to build the ledger: all measurements are
expressions over one row.

Defined results for odd rows: a null text counts as empty (0 everywhere,
fails the minimum length); repeated rows are judged alike, each on its own;
an empty table gives an empty ledger; other columns pass through, and a
column whose name the ledger also makes is replaced by the ledger's.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, let, word_array

SYMBOLS = "#*$%&|<>"

_NON_SPACE = r"[^\x20\x09-\x0D]"
_LETTER = r"\p{L}"
#: Two upper-case letters at least and no lower-case one.
_SHOUTED = r"^\P{Ll}*\p{Lu}\P{Ll}*\p{Lu}\P{Ll}*$"

#: Measurements of the ledger, in column order.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_alpha_words", "n_upper_words")

#: Distinct repeated windows up to this many are looked up one by one; texts
#: with more are ordered by window instead (same result, other cost).
_FEW = 24


@dataclass(frozen=True)
class Rule:
    """One rule: ``fails(thresholds)`` over the measurement columns."""

    bit: int
    name: str
    fails: Column | None = None


def rules() -> tuple[Rule, ...]:
    """The rules in bit order.  Ratios are compared by integer products, so
    the verdicts are exact."""
    c = F.col
    return (
        Rule(0, "too_few_words", c("n_words") < 50),
        Rule(1, "repeated_windows", 100 * c("n_repeat_words") > 50 * c("n_words")),
        Rule(2, "short_words", c("word_chars") < 2 * c("n_words")),
        Rule(3, "long_words", c("word_chars") > 15 * c("n_words")),
        Rule(4, "symbols", 10 * c("n_symbols") > c("n_words")),
        Rule(5, "duplicate_lines", 100 * c("n_dup_lines") > 50 * c("n_lines")),
        Rule(6, "few_letter_words", 100 * c("n_alpha_words") < 80 * c("n_words")),
        Rule(7, "shouting", 100 * c("n_upper_words") > 50 * c("n_words")),
    )


#: Version -> mask of the rules that a policy enforces.
POLICIES: Mapping[str, int] = {
    "base": 0b0000_0011,
    "v1": 0b0011_1111,
    "v2": 0b1111_1111,
}


def _repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found at least twice in the text."""

    def covered(at: Column) -> Column:  # ascending window starts
        return let(at, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(
                F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
            F.lit(0), lambda a, x: a + x))

    def few(h: Column, d: Column) -> Column:
        at = F.transform(h, lambda x, i: F.when(F.array_contains(d, x), i))
        return covered(F.filter(at, lambda i: i.isNotNull()))

    def many(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return let(pairs, lambda z: covered(F.sort_array(F.transform(
            F.filter(z, lambda x, k: ((k > 0) & (F.get(z, k - 1)["h"] == x["h"]))
                     | F.coalesce(F.get(z, k + 1)["h"] == x["h"], F.lit(False))),
            lambda x: x["i"]))))

    def of(h: Column) -> Column:
        twice = let(F.sort_array(h), lambda s: F.array_distinct(F.filter(
            s, lambda x, k: (k > 0) & (F.get(s, k - 1) == x))))
        return let(twice, lambda d: F.when(F.size(d) == 0, 0)
                   .when(F.size(d) <= _FEW, few(h, d)).otherwise(many(h)))

    windows = let(words, lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
    return F.when(F.size(words) < 4, 0).otherwise(let(windows, of)).cast("long")


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurement columns of every whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    kept = [c for c in df.columns if c not in MEASURES]
    n = F.size("_words")
    step = df.select(*kept, word_array(F.col(text)).alias("_words"),
                     F.filter(F.split(t, "\n", -1),
                              lambda x: x.rlike(_NON_SPACE)).alias("_lines"))
    return step.select(
        *kept,
        n.cast("long").alias("n_words"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_words")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_words", lambda w: w.rlike(_LETTER))).cast("long")
        .alias("n_alpha_words"),
        F.size(F.filter("_words", lambda w: w.rlike(_SHOUTED))).cast("long")
        .alias("n_upper_words"),
    )


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """Measurements plus ``fail_bits``: bit *k* is set if rule *k* fails."""
    bits = F.lit(0).cast("long")
    for r in rules():
        bits = bits.bitwiseOR(F.when(r.fails, F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return measure(df.drop("fail_bits"), text).withColumn("fail_bits", bits)


def apply_policy(entries: DataFrame, version: str, out: str = "kept") -> DataFrame:
    """Verdict of one policy version from stored bits alone."""
    mask = F.lit(POLICIES[version]).cast("long")
    return entries.withColumn(out, F.col("fail_bits").bitwiseAND(mask) == 0)


def ablations(entries: DataFrame, version: str) -> DataFrame:
    """Per rule of a policy: how many rows fail it, and how many fail only it.

    The ledger is first counted by bit pattern (one partial aggregate, at
    most 2^rules rows); each rule is then a bitwise test on the patterns.
    Returns ``rule, bit, n_failed, n_only``; an empty ledger gives zeros.
    """
    mask = POLICIES[version]
    patterns = entries.groupBy(
        F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"))
    names = {r.bit: r.name for r in rules() if mask >> r.bit & 1}
    sums = []
    for b in names:
        one = F.lit(1 << b).cast("long")
        hit = F.col("_p").bitwiseAND(one) != 0
        sums.append(F.struct(
            F.lit(names[b]).alias("rule"), F.lit(b).alias("bit"),
            F.coalesce(F.sum(F.when(hit, F.col("_n"))), F.lit(0)).alias("n_failed"),
            F.coalesce(F.sum(F.when(F.col("_p") == one, F.col("_n"))), F.lit(0)).alias("n_only")))
    return patterns.agg(F.array(*sums).alias("_r")).select(F.inline("_r"))
