"""URL filter: many wildcard rules at once, by a bit-parallel automaton.

A URL is judged in its canonical form: a dot, the host (text after the first
``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased) and the path (from
there up to ``?``, ``#`` or the end). Rules are globs over that form:

* ``*`` any run without ``/``, ``**`` any run, ``?`` one character but ``/``,
  ``\\x`` the character x; everything else stands for itself. A glob must fit the
  whole form.

All globs are packed into one Shift-And automaton. A glob with m single
characters gets m + 1 neighbouring bits, bit j meaning "the first j characters
have been read"; a wildcard behind character j lets bit j stay. With D the set
of live bits, reading a character of class c is

    D = ((D << 1) & STEP[c]) | (D & STAY[c])

over as many 64-bit words as the globs need (the shift carries between words).
One step moves every glob for every URL of an Arrow batch. Globs are packed in
the order of their priority, so the lowest final bit alive at the end is the
rule that decides.

Host rules (host, path) fit a host, its subdomains and every path that starts
with the rule's; the longest of them wins, and they come before all globs. A
URL that no rule fits is allowed if it has a host and blocked if not.

Defined cases: a null URL, or one without ``://``, has an empty host and path; a
host without a path fits no rule whose path starts with ``/``; ports and user
names stay part of the host; repeated rows are judged each; extra columns pass
through under their names, new columns get underscores where they clash; no
rows give no rows. A URL is read whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlife.llm.common import fresh, ship_package

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"

# FIXED VALUES: the host rules of the query.
HOST_RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)

#: Hosts of gambling, pharmacy and tracking pages, and paths that hold no prose; an
#: exception comes before the rule that it narrows.
GLOBS = (
    (ALLOW, "**/casino-architecture/**"),
    (BLOCK, "*casino*"), (BLOCK, "*casino*/**"),
    (BLOCK, "*.free-bets.*"), (BLOCK, "*.free-bets.*/**"),
    (BLOCK, "*.cheap-pills.*"), (BLOCK, "*.cheap-pills.*/**"),
    (BLOCK, "*.ads-*.*"), (BLOCK, "*.ads-*.*/**"),
    (BLOCK, "**/login"), (BLOCK, "**/login/**"),
    (BLOCK, "**/cart/**"),
    (BLOCK, "**.exe"), (BLOCK, "**.zip"),
    (BLOCK, "**/tag/**/page/**"),
)

#: Bytes of automaton state held at once.
STATE_BYTES = 1 << 23


@dataclass(frozen=True)
class Rule:
    verdict: str
    glob: str
    name: str | None = None            # of a host rule: host and path


def host_rule(verdict: str, host: str, path: str) -> Rule:
    quoted = "".join("\\" + c if c in "*?\\" else c for c in host + path)
    return Rule(verdict, f"*.{quoted}**", host + path)


def rule_table(hosts: Sequence[tuple] = HOST_RULES, globs: Sequence[tuple] = GLOBS) -> list[Rule]:
    """All rules, the deciding one first: host rules by falling length, then the globs in their order."""
    first = sorted((host_rule(*h) for h in hosts), key=lambda r: (-len(r.name), r.name))
    return [*first, *(Rule(v, g) for v, g in globs)]


def tokens(glob: str) -> list[tuple[str, str]]:
    """(kind, character) of each element; kinds: char, one (``?``), segment (``*``), any (``**``)."""
    out, i = [], 0
    while i < len(glob):
        if glob[i] == "\\" and i + 1 < len(glob):
            out.append(("char", glob[i + 1]))
            i += 2
        elif glob.startswith("**", i):
            out.append(("any", ""))
            i += 2
        else:
            out.append({"*": ("segment", ""), "?": ("one", "")}.get(glob[i], ("char", glob[i])))
            i += 1
    return out


class ShiftAnd:
    """The packed automaton of ``globs``; the first glob has the highest priority."""

    def __init__(self, globs: Sequence[str]):
        parsed = [tokens(g) for g in globs]
        singles = sorted({c for p in parsed for kind, c in p if kind == "char"} | {"/"})
        n_bits = sum(1 + sum(kind in ("char", "one") for kind, _ in p) for p in parsed)
        self.words = max(1, -(-n_bits // 64))
        # class 0 is every character that no glob names
        self.classes = np.zeros(0x110000, np.uint32)
        for k, c in enumerate(singles, 1):
            self.classes[ord(c)] = k
        slash = singles.index("/") + 1
        step = np.zeros((len(singles) + 1, self.words * 64), bool)
        stay, start, final = np.zeros_like(step), np.zeros(self.words * 64, bool), np.zeros(self.words * 64, bool)
        not_slash = np.arange(len(step)) != slash
        self.owner = np.full(self.words * 64, -1, np.int32)
        bit = 0
        for rule, p in enumerate(parsed):
            start[bit] = True
            for kind, c in p:
                if kind == "any":
                    stay[:, bit] = True
                elif kind == "segment":
                    stay[not_slash, bit] = True
                else:
                    bit += 1
                    if kind == "char":
                        step[self.classes[ord(c)], bit] = True
                    else:
                        step[not_slash, bit] = True
            final[bit] = True
            self.owner[bit] = rule
            bit += 1
        self.step, self.stay = self._packed(step), self._packed(stay)
        self.start, self.final = self._packed(start[None])[0], self._packed(final[None])[0]

    @staticmethod
    def _packed(bits: np.ndarray) -> np.ndarray:
        weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
        return (bits.reshape(len(bits), -1, 64) * weights).sum(axis=2, dtype=np.uint64)

    def first(self, texts: Sequence[str]) -> np.ndarray:
        """Of each text the first glob that fits it whole, or -1."""
        out = np.full(len(texts), -1, np.int32)
        rows = max(1, STATE_BYTES // (8 * self.words))
        for at in range(0, len(texts), rows):
            out[at:at + rows] = self._first(texts[at:at + rows])
        return out

    def _first(self, texts: Sequence[str]) -> np.ndarray:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-lengths, kind="stable")         # longest first: texts that have ended are behind
        codes = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        starts = (np.cumsum(lengths) - lengths)[order]
        alive = len(texts) - np.searchsorted(np.sort(lengths), np.arange(int(lengths.max(initial=0))), side="right")
        live = np.tile(self.start, (len(texts), 1))
        for i, n in enumerate(alive.tolist()):
            kind = self.classes[codes[starts[:n] + i]]
            now = live[:n]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            live[:n] = (moved & self.step[kind]) | (now & self.stay[kind])
        ended = live & self.final
        word = (ended != 0).argmax(axis=1)
        value = ended[np.arange(len(texts)), word]
        lowest = value & (~value + np.uint64(1))
        bit = np.frexp(lowest.astype(np.float64))[1] - 1     # of a power of two, so exact
        out = np.empty(len(texts), np.int32)
        out[order] = np.where(value != 0, self.owner[word * 64 + np.maximum(bit, 0)], -1)
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The two parts of the canonical form; empty texts for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def judge_urls(df: DataFrame, url_col: str = "url", hosts: Sequence[tuple] = HOST_RULES,
               globs: Sequence[tuple] = GLOBS) -> DataFrame:
    """``df`` with the columns host, path, rule (of the deciding host rule, else null), verdict and
    glob (the deciding glob, else null). No shuffle: each batch of rows is judged where it lies."""
    names: list[str] = []
    for n in ("host", "path", "rule", "verdict", "glob"):
        names.append(fresh(n, [*df.columns, *names]))
    host, path = host_and_path(F.col(f"`{url_col}`"))
    step = df.select(*[F.col(f"`{c}`") for c in df.columns], host.alias(names[0]), path.alias(names[1]))
    schema = T.StructType([*step.schema.fields, *[T.StructField(n, T.StringType()) for n in names[2:]]])
    rules = rule_table(hosts, globs)
    ship_package(df.sparkSession)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ShiftAnd([r.glob for r in rules])
        for batch in batches:
            columns = list(batch.columns)
            forms = [f".{h}{p}" for h, p in zip(columns[-2].to_pylist(), columns[-1].to_pylist())]
            hit = automaton.first(forms).tolist()
            rule = [rules[k].name if k >= 0 else None for k in hit]
            verdict = [rules[k].verdict if k >= 0 else BLOCK if len(f) == 1 or f[1] == "/" else ALLOW
                       for k, f in zip(hit, forms)]
            glob = [rules[k].glob if k >= 0 and rules[k].name is None else None for k in hit]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(x, pa.string()) for x in (rule, verdict, glob)]],
                                             names=[f.name for f in schema.fields])

    return step.mapInArrow(judged, schema)


def url_rules_query(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and glob of every page."""
    return judge_urls(pages.select("page_id", "url")).drop("url")
