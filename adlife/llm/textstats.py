"""Per-text counts as built-in Spark expressions (no Python workers).

Words are runs of characters other than blank, tab, LF, VT, FF and CR. A
null text counts as an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlife.llm.common import fresh

# FIXED VALUES: white space of the word rule, symbol characters, and frequent
# function words of English, German, French and Spanish.
SPACE = r"[\x09-\x0D\x20]+"
NOT_SPACE = r"[^\x09-\x0D\x20]"
SYMBOLS = r"[#*$%&|<>]"
STOP_WORDS = (
    "a an and are as at be but by for from had has have he her his i in is it its my not of on or our "
    "she that the their they this to was we were which with you "
    "aber als am auch auf aus bei das dass dem den der des die durch ein eine einem einen einer es für "
    "hat ich im ist mit nach nicht noch nur oder sich sie sind so und von vor war wie wird zu zum zur über "
    "au aux avec ce ces cette dans de du elle en est et il ils je la le les leur mais ne nous on ont ou où "
    "par pas plus pour qu que qui sa se ses son sont sur un une vous "
    "al como con del el ella ellos era esta este fue ha hay la las lo los más muy o para pero por porque "
    "se ser si sin sobre su sus también una uno y ya"
).split()


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def repeat_words(sorted_windows: Column) -> Column:
    """Positions lying in a 3-word window that occurs twice or more.

    ``sorted_windows``: array of structs (a, b, c, i) in natural order, so
    equal windows are neighbours and their starts ascend.
    """
    def same(x: Column, y: Column) -> Column:
        return (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    repeated = F.filter(sorted_windows, lambda x, j: F.coalesce(
        same(x, F.get(sorted_windows, j + 1)), F.lit(False)) | F.coalesce(
        same(x, F.get(sorted_windows, F.when(j > 0, j - 1))), F.lit(False)))
    starts = F.array_sort(F.transform(repeated, lambda x: x["i"]))
    seed = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("at"))
    return F.aggregate(starts, seed, lambda acc, i: F.struct(
        (acc["n"] + F.least(F.lit(3).cast("long"), i - acc["at"])).alias("n"),
        i.cast("long").alias("at")), lambda acc: acc["n"])


def with_counts(df: DataFrame, text_col: str = "text", repeats: bool = True,
                stop_words: bool = True) -> tuple[DataFrame, dict[str, str]]:
    """``df`` plus one struct column of counts; returns (frame, {count name: column path}).

    Counts: n_words, word_chars, n_symbols, n_lines, n_dup_lines, and on demand
    n_stop_words and n_repeat_words.
    """
    out = fresh("counts", df.columns)
    cols = [F.col(f"`{c}`") for c in df.columns]
    t, w, v, s = (fresh(x, [*df.columns, out]) for x in ("t_", "w_", "v_", "s_"))
    step = df.select(*cols, F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias(t))
    lines = F.filter(F.split(F.col(t), "\n"), lambda x: x.rlike(NOT_SPACE))
    step = step.select(*cols, words(F.col(t)).alias(w), lines.alias(v), F.col(t))
    word, line = F.col(w), F.col(v)
    fields = [
        F.size(word).cast("long").alias("n_words"),
        F.length(F.array_join(word, "")).cast("long").alias("word_chars"),
        F.regexp_count(F.col(t), F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size(line).cast("long").alias("n_lines"),
        (F.size(line) - F.size(F.array_distinct(line))).cast("long").alias("n_dup_lines"),
    ]
    if stop_words:
        fields.append(F.size(F.filter(word, lambda x: F.lower(x).isin(STOP_WORDS))).cast("long").alias("n_stop_words"))
    if repeats:
        windows = F.transform(F.slice(word, 1, F.greatest(F.size(word) - 2, F.lit(0))), lambda x, i: F.struct(
            x.alias("a"), F.get(word, i + 1).alias("b"), F.get(word, i + 2).alias("c"), i.alias("i")))
        step = step.select(*cols, F.struct(*fields).alias(out), F.sort_array(windows).alias(s))
        step = step.select(*cols, F.col(out).withField("n_repeat_words", repeat_words(F.col(s))).alias(out))
    else:
        step = step.select(*cols, F.struct(*fields).alias(out))
    names = [f.name for f in step.schema[out].dataType.fields]
    return step, {n: f"`{out}`.{n}" for n in names}
