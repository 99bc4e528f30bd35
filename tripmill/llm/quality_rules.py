"""Quality rules as a ledger of failure bits, judged later by versioned policies.

Every rule is evaluated once. The ledger keeps what was measured and one bit for each rule that
failed, so a new policy is a new mask over stored bits, and its ablation a bitwise aggregation.

Defined results: a null text counts as an empty one; an empty or blank text has no words and fails
``few_words``; repeated rows and repeated ids are judged row by row; other columns pass through the
ledger unless one has a ledger column's name, which is then replaced. An empty table gives an empty
ledger.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import split_words, whole_text

WINDOW = 5

# Name -> test that is true when the document fails. The position is the bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > 4 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "long_words": "word_chars > 20 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "capitals": "100 * n_upper > 50 * word_chars",
}
BASE = ("few_words", "repeated_words")
# Version -> rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "symbols", "duplicate_lines", "long_words", "capitals"),
}
CURRENT = "v1"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words")


def mask(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in rules)


def _covered(positions: Column) -> Column:
    """Words covered by windows that start at the given ascending positions."""
    steps = F.transform(
        positions,
        lambda p, i: F.when(i + 1 < F.size(positions), F.least(F.lit(WINDOW), F.get(positions, i + 1) - p)).otherwise(WINDOW),
    )
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements; one narrow stage of built-in functions.

    Windows of words are compared by 64-bit hashes within one document. Positions are looked at
    only where a document repeats a window at all.
    """
    kept = [c for c in docs.columns if c not in MEASURES]
    body, words, lines, hashes = "__text", "__words", "__lines", "__hashes"
    rows = docs.select(*(F.col(f"`{c}`") for c in kept), whole_text(F.col(f"`{text}`")).alias(body))
    rows = rows.withColumns(
        {
            words: split_words(F.col(body)),
            lines: F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^ \t\n\x0B\f\r]")),
        }
    )
    word = lambda i: F.get(F.col(words), i)
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*(word(i + k) for k in range(WINDOW))),
    )
    rows = rows.withColumn(hashes, F.when(F.size(words) >= WINDOW, windows).otherwise(F.array().cast("array<bigint>")))
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("__repeats", F.size(F.array_distinct(hashes)) < F.size(hashes))
    rows = rows.withColumn("__placed", F.when(F.col("__repeats"), placed))
    near = lambda i: F.get(F.col("__placed"), i)["h"]
    twice = F.filter(
        "__placed",
        lambda x, i: (F.coalesce(near(i + 1) == x["h"], F.lit(False)))
        | (F.when(i > 0, near(i - 1) == x["h"]).otherwise(False)),
    )
    rows = rows.withColumn("__starts", F.when(F.col("__repeats"), F.array_sort(F.transform(twice, lambda x: x["i"]))))
    found = [
        F.size(words),
        F.length(F.translate(body, " \t\n\x0b\f\r", "")),
        F.regexp_count(body, F.lit(r"[#*$%&|<>]")),
        F.regexp_count(body, F.lit(r"\p{Lu}")),
        F.size(lines),
        F.size(lines) - F.size(F.array_distinct(lines)),
        F.coalesce(F.when(F.col("__repeats"), _covered(F.col("__starts"))), F.lit(0)),
    ]
    # A generator, so that a filter on measurements is not pushed below it, where every use of a
    # measurement would be computed anew.
    return rows.select(*(F.col(f"`{c}`") for c in kept), F.stack(F.lit(1), *(x.cast("long") for x in found)).alias(*MEASURES))


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Measurements and ``failed_bits``, bit k set when rule k failed."""
    bits = [F.when(F.expr(test), F.lit(1 << k)).otherwise(F.lit(0)) for k, test in enumerate(RULES.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs, text).withColumn("failed_bits", failed.cast("long"))


def judge(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Add ``base_failed`` and ``kept`` for one policy; nothing is measured again."""
    failed = F.col("failed_bits")
    return rows.withColumns(
        {
            "base_failed": failed.bitwiseAND(F.lit(mask(BASE))) != 0,
            "kept": failed.bitwiseAND(F.lit(mask(BASE) | mask(POLICIES[policy]))) == 0,
        }
    )


def ablations(rows: DataFrame, policies: Mapping[str, tuple[str, ...]] = POLICIES) -> DataFrame:
    """Per policy and rule: documents it rejects, and those only this rule rejects.

    The ledger is first counted per distinct bit pattern, of which there are at most 2 ** rules.
    """
    patterns = rows.groupBy("failed_bits").agg(F.count("*").alias("n"))
    lines = [(name, rule, mask((rule,)), mask(rules)) for name, rules in policies.items() for rule in rules]
    grid = rows.sparkSession.createDataFrame(lines, "policy string, rule string, rule_bit long, policy_bits long")
    hit = F.col("failed_bits").bitwiseAND(F.col("policy_bits"))
    return (
        patterns.join(F.broadcast(grid), hit != 0, "right")
        .groupBy("policy", "rule")
        .agg(
            F.coalesce(F.sum(F.when(hit.bitwiseAND(F.col("rule_bit")) != 0, F.col("n"))), F.lit(0)).alias("n_failed"),
            F.coalesce(F.sum(F.when(hit == F.col("rule_bit"), F.col("n"))), F.lit(0)).alias("n_only_this"),
        )
    )
