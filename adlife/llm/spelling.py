"""Spelling variants: one-edit pairs of the vocabulary by finite-state composition.

With A the minimal acceptor of the vocabulary and T the transducer that
inserts, deletes or replaces exactly one character, the pairs accepted by the
composition A o T o A are the pairs of near words. Before its edit T copies, so both
copies of A are in one state p, reached by a common prefix x. After its edit by
a, b (or a alone) they go on from two states q, r with the same characters y: the words
are x a y and x b y (or x y). For each state p the edits with a common rest y are found
once, by walking q and r together (they are often one state, as A is minimal),
and serve every prefix x that leads to p.

*Partitions.* A is never built whole. Let m be the shorter length of a pair and
k = m // 2. Either the pair shares its first k characters, or its last m - k: so
every word is put, for m = its length and its length - 1, under its
first k characters (reached state of A after k steps) and under its
last m - k (the same for the acceptor of reversed words). Each group is an
acceptor of remainders that starts in that state; a pair is reported by
its front group if it shares k characters in front, else by its back group, so it
is reported once. A task streams its sorted groups, one in memory at a time.

*Large groups.* A group of more than ``GROUP_WORDS`` words is not built: its
words are joined on what is left without one character at each place behind the shared
ones (built-in expressions, at most alphabet + 1 words a key), which gives the
same pairs.

Defined cases: a null text has no words; a null id is an empty text in the
hash; rows that share an id are hashed alike and all counted; runs are whole,
however long; extra columns are ignored; no rows give no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlife.llm.common import materialized, ship_package

MIN_CHARS, MIN_COUNT, FORM_RATIO, DAMAGE_OF = 6, 5, 5, 199
LETTERS = r"[a-z\x{00C0}-\x{00FF}]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words of a group that one task holds as an acceptor.
GROUP_WORDS = 50_000


# -- vocabulary ---------------------------------------------------------------

def vocabulary(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the damaged runs of all texts; counted before they are shuffled."""
    # a run gets no longer by the damage, so shorter runs need not leave the text
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(LETTERS + f"{{{MIN_CHARS},}}"), F.lit(0))
    run = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    run = run.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DAMAGE_OF == 0, cut).otherwise(F.col("run"))
    return (run.select(word.alias("word")).where(F.length("word") >= MIN_CHARS)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


# -- the acceptor of one group ------------------------------------------------

class Acceptor:
    """Minimal acyclic acceptor of sorted distinct words; state 0 is the start.

    ``arcs[p]``: character -> state; ``final[p]``; ``sizes[p]``: least and greatest length of a rest.
    """

    def __init__(self, words: list[str]):
        self.arcs, self.final, self.sizes = [{}], [False], [(0, 0)]
        same: dict[tuple, int] = {}
        open_: list[tuple[int, str, int]] = []     # (state, character, next) of the last word's unmerged tail
        last = ""

        def close(down_to: int) -> None:
            while len(open_) > down_to:
                p, c, q = open_.pop()
                key = (self.final[q], tuple(self.arcs[q].items()))
                q = self.arcs[p][c] = same.setdefault(key, q)
                self._measure(q)

        for word in words:
            common = 0
            while common < min(len(word), len(last)) and word[common] == last[common]:
                common += 1
            close(common)
            p = open_[-1][2] if open_ else 0
            for c in word[common:]:
                self.arcs.append({})
                self.final.append(False)
                self.sizes.append((0, 0))
                q = self.arcs[p][c] = len(self.arcs) - 1
                open_.append((p, c, q))
                p = q
            self.final[p] = True
            last = word
        close(0)
        self._measure(0)
        self._edits: dict[int, list] = {}
        self._rests: dict[tuple[int, int], list[str]] = {}

    def _measure(self, p: int) -> None:
        sizes = [self.sizes[q] for q in self.arcs[p].values()]
        low = 0 if self.final[p] else min((a for a, _ in sizes), default=-1) + 1
        self.sizes[p] = (low, max((b for _, b in sizes), default=-1) + 1)

    def rests(self, q: int, r: int) -> list[str]:
        """The texts accepted from both states, in order."""
        key = (q, r) if q < r else (r, q)
        if key not in self._rests:
            out, todo = [], [(*key, "")]
            while todo:
                q, r, y = todo.pop()
                (a, b), (c, d) = self.sizes[q], self.sizes[r]
                if b < c or d < a:                 # no length in common
                    continue
                if self.final[q] and self.final[r]:
                    out.append(y)
                mine, other = self.arcs[q], self.arcs[r]
                if len(mine) > len(other):
                    mine, other = other, mine
                todo.extend((mine[ch], other[ch], y + ch) for ch in mine if ch in other)
            self._rests[key] = out
        return self._rests[key]

    def edits(self, p: int) -> list[tuple[str, str, str]]:
        """(a, b, y) so that x a y and x b y are accepted for every x that leads to ``p``; b may be empty,
        then y does not begin with a (the edit stands as far back as it can)."""
        if p not in self._edits:
            out, arcs = [], list(self.arcs[p].items())
            for i, (a, q) in enumerate(arcs):
                for b, r in arcs[i + 1:]:
                    out.extend((a, b, y) for y in self.rests(q, r))
                out.extend((a, "", y) for y in self.rests(q, p) if not y.startswith(a))
            self._edits[p] = out
        return self._edits[p]

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Every pair of accepted words that differ by one edit, once."""
        path: list[str] = []
        todo: list[tuple[int, int, str]] = [(0, 0, "")]
        while todo:
            depth, p, c = todo.pop()
            del path[max(depth - 1, 0):]
            if depth:
                path.append(c)
            found = self.edits(p)
            if found:
                x = "".join(path)
                for a, b, y in found:
                    yield x + a + y, x + b + y
            todo.extend((depth + 1, q, ch) for ch, q in self.arcs[p].items())


def _shared(u: str, v: str) -> int:
    n = 0
    for a, b in zip(u, v):
        if a != b:
            break
        n += 1
    return n


def group_pairs(back: bool, m: int, part: str, words: list[tuple[str, int]]) -> Iterator[tuple[str, str]]:
    """The pairs that the group has to report. ``words``: (remainder, n); reversed if ``back``."""
    k = m // 2
    for u, v in Acceptor([w for w, _ in words]).pairs():
        # the shorter word has m characters (a pair of longer ones belongs to the next group)
        if min(len(u), len(v)) + len(part) == m:
            if not back:
                yield u, v
            elif _shared((part + u)[::-1], (part + v)[::-1]) < k:
                yield u, v


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (back, m, part, rest, n) sorted by them -> (word, n_near, n, near): per word and group the count of
    its near words and the most frequent of them (the least among equals)."""

    def best(key: tuple, words: list[tuple[str, int]]) -> Iterator[tuple]:
        back, m, part = key
        counts = dict(words)
        found: dict[str, list] = {}
        for pair in group_pairs(back, m, part, words):
            for u, v in (pair, pair[::-1]):
                near = (part + v)[::-1] if back else part + v
                mine = found.setdefault(u, [0, 0, ""])
                mine[0] += 1
                if (-counts[v], near) < (-mine[1], mine[2]):
                    mine[1:] = counts[v], near
        for u, (n_near, n, near) in found.items():
            yield ((part + u)[::-1] if back else part + u), n_near, n, near

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
            pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["word", "n_near", "n", "near"])

    key, words, out = None, [], []
    for batch in batches:
        for *now, rest, n in zip(*[c.to_pylist() for c in batch.columns]):
            if now != key:
                if len(words) > 1:
                    out.extend(best(tuple(key), words))
                    if len(out) > 20_000:
                        yield table(out)
                        out = []
                key, words = now, []
            words.append((rest, n))
    if len(words) > 1:
        out.extend(best(tuple(key), words))
    if out:
        yield table(out)


# -- all groups -----------------------------------------------------------------

def _groups(words: DataFrame) -> DataFrame:
    """(back, m, part, rest, n): each word under its front and its back part, for both lengths m."""
    size = F.length("word")
    both = words.select("word", "n", size.alias("size"), F.explode(F.array(
        F.struct(F.lit(False).alias("back"), size.alias("m")), F.struct(F.lit(True).alias("back"), size.alias("m")),
        F.struct(F.lit(False).alias("back"), (size - 1).alias("m")),
        F.struct(F.lit(True).alias("back"), (size - 1).alias("m")))).alias("g")).where(F.col("g.m") >= MIN_CHARS)
    back, m = F.col("g.back"), F.col("g.m")
    k = F.floor(m / 2).cast("int")
    cut = F.when(back, m - k).otherwise(k)
    read = F.when(back, F.reverse("word")).otherwise(F.col("word"))
    return both.select(back.alias("back"), m.alias("m"), F.substring(read, F.lit(1), cut).alias("part"),
                       F.substring(read, cut + 1, F.col("size")).alias("rest"), "n")


def _word(part: Column, rest: Column) -> Column:
    return F.when(F.col("back"), F.reverse(F.concat(part, rest))).otherwise(F.concat(part, rest))


def _near_of_large(groups: DataFrame) -> DataFrame:
    """(word, n_near, n, near) of groups too large for one acceptor: joined on what is left without one character."""
    size = F.length("rest")
    own = groups.select("back", "m", "part", "rest", "n", F.explode(F.sequence(F.lit(0), size)).alias("i"))
    # place 0 stands for the whole rest (as the shorter word of a pair), i > 0 for the rest without character i
    left = F.concat(F.substring("rest", F.lit(1), F.col("i") - 1), F.substring("rest", F.col("i") + 1, size))
    own = own.where((F.col("i") > 0) | (size + F.length("part") == F.col("m")))
    own = own.select("back", "m", "part", "rest", "n", "i", F.when(F.col("i") == 0, F.col("rest")).otherwise(left).alias("left"))
    u = own.select("back", "m", "part", "left", F.col("rest").alias("u"), F.col("n").alias("un"), F.col("i").alias("ui"))
    v = own.select("back", "m", "part", "left", F.col("rest").alias("v"), F.col("n").alias("vn"), F.col("i").alias("vi"))
    pairs = u.join(v, ["back", "m", "part", "left"]).where(
        (F.col("u") != F.col("v")) & ((F.col("ui") == F.col("vi")) | (F.col("ui") == 0) | (F.col("vi") == 0))
        & (F.least(F.length("u"), F.length("v")) + F.length("part") == F.col("m")))
    pairs = pairs.select("back", "m", "part", "u", "un", "v", "vn").distinct()
    first = F.substring(_word(F.col("part"), F.col("u")), F.lit(1), F.floor(F.col("m") / 2).cast("int"))
    other = F.substring(_word(F.col("part"), F.col("v")), F.lit(1), F.floor(F.col("m") / 2).cast("int"))
    pairs = pairs.where(~F.col("back") | (first != other))
    return pairs.select(_word(F.col("part"), F.col("u")).alias("word"), F.lit(1).cast("long").alias("n_near"),
                        F.col("vn").alias("n"), _word(F.col("part"), F.col("v")).alias("near"))


def near_words(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n_near, n, near) of all words (word, n) with near words: their count, the most frequent one and its n."""
    ship_package(words.sparkSession)
    groups = _groups(words)
    key = ["back", "m", "part"]
    large = materialized(groups.groupBy(*key).agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > group_words).drop("size"),
                         "large-groups")
    some = not large.isEmpty()
    small = groups.join(large, key, "left_anti") if some else groups
    small = small.repartition(*key).sortWithinPartitions(*key, "rest")
    found = small.mapInArrow(_near, "word string, n_near long, n long, near string")
    if some:
        found = found.unionByName(_near_of_large(groups.join(large, key, "left_semi")))
    most = F.min(F.struct((-F.col("n")).alias("less"), F.col("near").alias("near")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), most.alias("most")).select(
        "word", "n_near", (-F.col("most.less")).alias("n"), F.col("most.near").alias("near"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of all words (word, form): forms are followed to the last, twice as far in each round.

    The count of a form is ``FORM_RATIO`` times its word's, so chains are short and have no circle.
    """
    now = materialized(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = materialized(now.join(ahead, "root", "left"), "roots")
        if step.where(F.col("next").isNotNull()).isEmpty():
            return now
        now = step.select("word", F.coalesce("next", "root").alias("root"))


def spelling_variants(docs: DataFrame, min_count: int = MIN_COUNT, group_words: int = GROUP_WORDS) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of the vocabulary of ``docs`` (doc_id, text)."""
    words = materialized(vocabulary(docs, min_count), "words")
    near = near_words(words, group_words).withColumnRenamed("n", "near_n")
    held = F.col("near_n") >= FORM_RATIO * F.col("n")
    rows = materialized(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(held, F.col("near")).alias("form"), F.when(held, F.col("near_n")).alias("form_n")), "forms")
    roots = _roots(rows.where(F.col("form").isNotNull()))
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_query(docs: DataFrame) -> DataFrame:
    return spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n")
