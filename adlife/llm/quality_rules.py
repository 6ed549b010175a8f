"""Quality rules: a threshold table compiled into one Spark projection.

Each :class:`Rule` bounds a ratio of two counts of :mod:`adlife.llm.textstats`
(length, symbol, stop-word and line ratios). :func:`compile_rules` turns the
table into Column expressions: one boolean per rule, the list of failed rules
and the verdict. No user functions, no shuffle; whole texts.

Defined cases: a null text counts as empty; an empty text has all counts 0 and
fails the length rule; a ratio with denominator 0 is 0; repeated rows are
scored one by one; extra columns pass through :func:`apply_rules` untouched,
and output columns whose name is taken are prefixed with ``_``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlife.llm.common import fresh
from adlife.llm.textstats import with_counts


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; ``denominator`` None means 1."""

    name: str
    numerator: str
    denominator: str | None = None
    low: float | None = None
    high: float | None = None


#: Production table. Bounds are wide: ordinary prose of any of the four languages passes.
RULES = (
    Rule("length", "n_words", None, 50, None),
    Rule("word_length", "word_chars", "n_words", 2.0, 14.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.1),
    Rule("stop_words", "n_stop_words", "n_words", 0.04, None),
    Rule("dup_lines", "n_dup_lines", "n_lines", None, 0.5),
    Rule("repeats", "n_repeat_words", "n_words", None, 0.5),
)


def ratio(rule: Rule, counts: dict[str, str]) -> Column:
    top = F.col(counts[rule.numerator]).cast("double")
    if rule.denominator is None:
        return top
    bottom = F.col(counts[rule.denominator])
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def compile_rules(rules: Sequence[Rule], counts: dict[str, str]) -> tuple[Column, Column]:
    """(array of the names of failed rules in table order, verdict)."""
    passes = []
    for r in rules:
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & (ratio(r, counts) >= F.lit(float(r.low)))
        if r.high is not None:
            ok = ok & (ratio(r, counts) <= F.lit(float(r.high)))
        passes.append((r.name, ok))
    verdict = F.lit(True)
    for _, ok in passes:
        verdict = verdict & ok
    failed = F.array_compact(F.array(*[F.when(~ok, F.lit(n)) for n, ok in passes], F.lit(None).cast("string")))
    return failed, verdict


def apply_rules(df: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """``df`` without its text, plus the counts, ``failed_rules`` and ``passes``."""
    keep = [c for c in df.columns if c != text_col]
    counted, counts = with_counts(df, text_col)
    failed, verdict = compile_rules(rules, counts)
    new = [(n, F.col(p)) for n, p in counts.items()] + [("failed_rules", failed), ("passes", verdict)]
    taken = list(keep)
    out = [F.col(f"`{c}`") for c in keep]
    for name, col in new:
        name = fresh(name, taken)
        taken.append(name)
        out.append(col.alias(name))
    return counted.select(*out)


def quality_rules_query(docs: DataFrame) -> DataFrame:
    scored = apply_rules(docs.select("doc_id", "text"))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base.alias("base_failed"), (~base & F.col("passes")).alias("kept"),
                         F.array_join("failed_rules", ",").alias("failed_rules"))
