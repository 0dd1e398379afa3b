"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every measurement and rule is evaluated once per document. The ledger keeps the measurements and
one bit per failed rule; versioned policies and ablations then work on the bits alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "[ \\t\\n\\x0B\\f\\r]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_letters", "n_upper", "n_marks",
]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once even where a lambda reads it many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def repeat_words(words: Column) -> Column:
    """How many words lie in windows of five words that occur twice or more, first ones included.

    Hashes settle the documents without a repeat; the others compare whole windows.
    """
    starts = lambda w: F.sequence(F.lit(0), F.size(w) - WINDOW)
    part = lambda w, i: F.slice(w, i + 1, F.lit(WINDOW))

    def exact(w: Column) -> Column:
        windows = F.transform(
            starts(w), lambda i: F.struct(F.array_join(part(w, i), " ").alias("w"), i.alias("i"))
        )
        repeated = bound(F.sort_array(windows), lambda s: F.filter(s, lambda x, i: F.coalesce(
            F.get(s, i - 1)["w"] == x["w"], F.lit(False))
            | F.coalesce(F.get(s, i + 1)["w"] == x["w"], F.lit(False))))
        positions = F.sort_array(F.transform(repeated, lambda x: x["i"]))
        return bound(positions, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
            F.lit(0).cast("long"), lambda total, x: total + x))

    def counted(w: Column) -> Column:
        hashes = F.transform(starts(w), lambda i: F.xxhash64(part(w, i)))
        unrepeated = bound(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
        return F.when((F.size(w) <= WINDOW) | unrepeated, F.lit(0).cast("long")).otherwise(exact(w))

    return bound(words, counted)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its id and MEASURES, all long, over the whole text.

    Null and empty texts measure 0 throughout. Repeated rows and null ids are measured like any
    others; other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    slim = docs.select(F.col(id_col), text.alias("__t"))
    # The words are made in a projection of their own, so that they are split once.
    cut = slim.select(
        "*",
        F.filter(F.split("__t", SPACE, -1), lambda w: w != "").alias("__w"),
        F.filter(F.split("__t", "\n", -1), lambda line: F.btrim(line, F.lit(" \t\x0b\f\r")) != "").alias("__l"),
    )
    letters = F.regexp_replace("__t", "[^\\p{L}]+", "")
    without = lambda chars: F.length("__t") - F.length(F.translate("__t", chars, ""))
    columns = {
        "n_words": F.size("__w"),
        "word_chars": F.length(F.array_join("__w", "")),
        "n_symbols": without(SYMBOLS),
        "n_lines": F.size("__l"),
        "n_dup_lines": F.size("__l") - F.size(F.array_distinct("__l")),
        "n_repeat_words": repeat_words(F.col("__w")),
        "n_letters": F.length(letters),
        "n_upper": F.length(F.regexp_replace("__t", "[^\\p{Lu}]+", "")),
        "n_marks": without("!?"),
    }
    return cut.select(F.col(id_col), *[c.cast("long").alias(name) for name, c in columns.items()])


@dataclass(frozen=True)
class Rule:
    """A rule's bit stays the same for ever; a changed rule takes a new bit."""

    bit: int
    name: str
    fails: Callable[[], Column]


def over(part: str, share: float, whole: str) -> Callable[[], Column]:
    """Whether part is more than a share (a whole number of hundredths) of whole."""
    percent = round(share * 100)
    return lambda: F.col(part) * 100 > F.col(whole) * percent


RULES = [
    Rule(0, "few_words", lambda: F.col("n_words") < 10),
    Rule(1, "repeated_words", over("n_repeat_words", 0.20, "n_words")),
    Rule(2, "symbols", over("n_symbols", 0.20, "n_words")),
    Rule(3, "repeated_lines", over("n_dup_lines", 0.50, "n_lines")),
    Rule(4, "upper_case", over("n_upper", 0.50, "n_letters")),
    Rule(5, "long_words", lambda: F.col("word_chars") > F.col("n_words") * 30),
    Rule(6, "exclamation", over("n_marks", 0.50, "n_words")),
    Rule(7, "few_letters", lambda: F.col("n_letters") * 100 < F.col("word_chars") * 25),
]

# The rules that each version of the policy applies. Old versions stay, so old runs can be repeated.
POLICIES = {
    "base": ["few_words", "repeated_words"],
    "v1": [r.name for r in RULES],
}


def mask(names: list[str], rules: list[Rule] = RULES) -> int:
    known = {r.name: 1 << r.bit for r in rules}
    return sum({known[n] for n in names})


def ledger(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] = RULES
) -> DataFrame:
    """The measurements with `failures long`: the bits of the rules that a document fails.

    An empty or null text fails few_words alone, since no share of nothing is exceeded.
    """
    bits = [F.when(r.fails(), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long") for r in rules]
    failures = bits[0]
    for b in bits[1:]:
        failures = failures.bitwiseOR(b)
    return measured(docs, id_col, text_col).withColumn("failures", failures)


def passes(policy: str, failures: str = "failures") -> Column:
    """Whether a ledger row passes a version of the policy."""
    return F.col(failures).bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def passing(docs: DataFrame, policy: str, text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, whose texts pass a version of the policy."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col(text_col).alias("__text"))
    return ledger(rows, "__row", "__text").where(passes(policy)).select("__row.*")


def ablation(rows: DataFrame, policy: str, rules: list[Rule] = RULES) -> DataFrame:
    """Per rule of a policy: how many documents fail it, how many fail no other rule of the policy
    (they would be kept without it), and how many are kept with all rules and without this one.

    Documents are first counted per bitmask, of which there are at most 2 ** rules. An empty ledger
    gives the rules with zeros.
    """
    wanted = [r for r in rules if r.name in POLICIES[policy]]
    kept_bits = F.lit(mask([r.name for r in wanted], rules)).cast("long")
    counts = rows.groupBy(F.col("failures").bitwiseAND(kept_bits).alias("bits")).agg(F.count("*").alias("n"))
    sums = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).cast("long")
    bit = lambda r: F.lit(1 << r.bit).cast("long")
    per_rule = F.array(*[
        F.struct(
            F.lit(r.name).alias("rule"),
            sums(F.col("bits").bitwiseAND(bit(r)) != 0).alias("n_failed"),
            sums(F.col("bits") == bit(r)).alias("n_failed_only"),
            sums(F.col("bits") == 0).alias("n_kept"),
            sums(F.col("bits").bitwiseAND(F.bitwise_not(bit(r))) == 0).alias("n_kept_without"),
        )
        for r in wanted
    ])
    return counts.agg(per_rule.alias("rules")).select(F.inline("rules"))
