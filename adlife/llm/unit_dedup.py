"""Substring dedup by hashing text units (lines, and the sentences within them).

A text is cut at line ends, after sentence marks and before capitalised words;
what is still longer than ``LONG`` words is cut before the words whose hash is
the least of some ``WINDOW`` neighbouring ones, so that equal passages are cut
alike wherever they stand. Units are normalised (lower case, single blanks, outer punctuation off) and
hashed to 128 bits. Digests are grouped over the whole corpus; the document of
the least id that holds a unit keeps its first occurrence, every other
occurrence is a repeat. A run of consecutive repeats is extended left and right,
over the borders of its units, as far as the words equal those beside the kept
occurrence of one of its units (up to ``AROUND`` words; a longer match has whole
units there). Extended runs of ``MIN_WORDS`` words or more are removed, and so is
every whole line of ``LINE_WORDS`` words or more that an earlier place has as a line
or unit; shorter ones are ordinary phrases and stay. A repeated passage of 50 blank-separated
words holds a whole unit. Offsets are those of the original text, in characters.

Plan: one pass emits each document's distinct digests (24 bytes each, written
once); a ``groupBy`` with map-side combining finds each digest's keeper, so a
line that a third of all documents share sends one row per task; the keepers are
read again for the words beside their shared units; a bitmap of the shared digests
spares the join back most digests that one document alone has; that join is a plain
equi-join that Spark can split at a hot digest; only digests kept elsewhere reach
the document, which is cut. Both passes over the texts read one shuffle of them by id.

Defined cases: a null text stays null without units; an empty text has none; a
unit without letters or digits never counts as a repeat; rows that share an id
are one document; a null id ranks last; extra columns pass through
:func:`remove_repeats`, and a clashing output name is prefixed with ``_``.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator, Mapping
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructField, StructType

from adlife.llm.common import fresh, materialized, ship_package, worker_cache

MIN_WORDS = 20
LINE_WORDS = 3
#: Units of more words are cut again, before the least word of each window of so many words.
LONG, WINDOW = 24, 12
#: Words compared on each side of a unit, at most so many characters away; shorter units are too common to tell.
AROUND, REACH, TELLING = 24, 400, 3
NO_ID = (1 << 63) - 1
#: Bits of the bitmap of shared digests: so many a digest, of all at most (32 MB).
BITS_A_DIGEST, MOST_BITS = 16, 1 << 28

_CUT = re.compile(r"\s*\n\s*|(?<=[.!?…])[^\S\n]+|[^\S\n]+(?=[A-ZÀ-ÖØ-Þ])|(?<=[。！？])")
#: The same cuts where none of the last kind is: it starts with a blank, so the search skips what is none.
_BLANK_CUT = re.compile(r"\s(?:(?<=\n)\s*|(?<=[.!?…]\s)(?:[^\S\n]*\n\s*|[^\S\n]*)|(?![a-z])(?:[^\S\n]*\n\s*|[^\S\n]*(?=[A-ZÀ-ÖØ-Þ])))")
_OUTER = " \t\r\f\v.,;:!?…\"'()[]{}<>|#*$%&-–—_"


_WORD = re.compile(r"\S+")
_LINE = re.compile(r"[^\s](?:[^\n]*[^\s])?")


def tidy(text: str) -> bool:
    """Whether blanks stand alone, within lines, and but for line ends are the only white space: no unit has other or outer blanks."""
    return (text.replace("\n", "").isprintable() and "  " not in text and " \n" not in text and "\n " not in text
            and text[:1] != " " and text[-1:] != " " and not ("。" in text or "！" in text or "？" in text))


def units(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the units of ``text``, ascending."""
    at = 0
    plain = tidy(text)                           # a unit has one word more than blanks
    wide = "。" in text or "！" in text or "？" in text
    for m in (_CUT if wide else _BLANK_CUT).finditer(text):
        start, end = m.span()
        if start - at > 2 * LONG and not (plain and text.count(" ", at, start) < LONG):
            yield from _pieces(text, at, start)
        elif start > at:
            yield at, start
        at = end
    if at < len(text):
        yield from _pieces(text, at, len(text))


def _pieces(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """The stretch, cut at words that its content chooses if it has more than ``LONG`` words."""
    stretch = text[start:end]
    if len(stretch.split(None, LONG)) > LONG:
        h = [crc32(w.encode("utf-8", "surrogatepass")) for w in stretch.lower().split()]
        places = [m.span() for m in _WORD.finditer(text, start, end)]
        least, at = -1, start
        for k, new_hash in enumerate(h[WINDOW - 1:]):
            if least < k:
                new = h.index(min(h[k:k + WINDOW]), k)
            elif new_hash < h[least]:
                new = k + WINDOW - 1
            else:
                continue
            if new != least:
                least = new
                if places[new][0] > at:
                    yield at, places[new - 1][1]
                    at = places[new][0]
        start = at
    yield start, end


def _plain(word: str) -> str:
    return word.lower().strip(_OUTER) or word


def words_before(text: str, at: int) -> list[str]:
    """The words that end before ``at``, nearest first."""
    low = max(0, at - REACH)
    found = text[low:at].rsplit(None, AROUND)
    if found and 0 < low and not text[low].isspace() and not text[low - 1].isspace():
        del found[0]
    return found[:-AROUND - 1:-1]


def words_after(text: str, at: int) -> list[str]:
    """The words that start from ``at`` on, nearest first."""
    high = min(len(text), at + REACH)
    found = text[at:high].split(None, AROUND)
    if found and high < len(text) and not text[high - 1].isspace() and not text[high].isspace():
        del found[-1]
    return found[:AROUND]


def beside(text: str, start: int, end: int) -> tuple[str, str]:
    """The words before and after a unit, nearest first, one a line."""
    return "\n".join(map(_plain, words_before(text, start))), "\n".join(map(_plain, words_after(text, end)))


def line_digests(text: str, known: Mapping[tuple[int, int], tuple[bytes | None, int]] | None = None) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, digest) of the lines of ``LINE_WORDS`` words or more, without outer blanks; ``known``: of units."""
    known = known or {}
    for m in _LINE.finditer(text):
        span = m.span()
        digest, words = known.get(span) or unit_digest(m.group())
        if words >= LINE_WORDS and digest is not None:
            yield *span, digest


def text_digests(text: str) -> set[bytes]:
    """The digests of the units and of the lines of ``text``."""
    plain = tidy(text)
    known = {(a, b): unit_digest(text[a:b], plain) for a, b in units(text)}
    return ({d for d, _ in known.values()} | {d for _, _, d in line_digests(text, known)}) - {None}


def _reach(text: str, at: int, here: list[str], there: str, far: bool, none: int) -> int:
    """The far end of the words of ``here``, beside ``at``, that equal those of ``there``; ``none`` if none does."""
    end = at
    if not here or not there.startswith(_plain(here[0])):
        return none
    for word, other in zip(here, there.split("\n")):
        if _plain(word) != other:
            break
        end = text.index(word, end) + len(word) if far else text.rindex(word, 0, end)      # only blanks are between
        none = end
    return none


def unit_digest(unit: str, plain: bool = False) -> tuple[bytes | None, int]:
    """(digest or None, number of words); ``plain``: the unit is of a tidy text."""
    if plain and unit:
        low = unit.lower()
        norm, words = low.strip(_OUTER), low.count(" ") + 1
    else:
        parts = unit.lower().split()
        norm, words = " ".join(parts).strip(_OUTER), len(parts)
    if not norm[:1].isalnum() and not any(c.isalnum() for c in norm):
        return None, words
    return xxhash.xxh3_128_digest(norm.encode("utf-8", "surrogatepass")), words


def repeated_spans(text: str, elsewhere: Collection[bytes], min_words: int,
                   around: Mapping[bytes, list[tuple[str, str]]] | None = None) -> tuple[list[tuple[int, int]], int]:
    """Spans of ``text`` to remove, given the digests that another document keeps; and the number of units.

    ``around``: the words beside kept occurrences of units, as of :func:`beside`.
    """
    around, spans, seen, run, n, known_units = around or {}, [], {}, [], 0, {}
    plain = tidy(text)

    def extended() -> tuple[int, int]:
        start, end = first, last = run[0][0], run[-1][1]
        for ways, far in ((run, False), (run[::-1], True)):
            passed = 0
            for a, b, words, digest in ways:
                if passed >= AROUND:
                    break
                passed += words
                if words < TELLING:
                    continue
                known = around.get(digest, ()) if digest in elsewhere else (beside(text, *seen[digest]),)
                here = (words_after(text, b) if far else words_before(text, a)) if known else ()
                for left, right in known:
                    if far:
                        end = max(end, _reach(text, b, here, right, True, last))
                    else:
                        start = min(start, _reach(text, a, here, left, False, first))
        return start, end

    def close() -> None:
        if run:
            start, end = extended()
            words = sum(w for _, _, w, _ in run) + len(text[start:run[0][0]].split()) + len(text[run[-1][1]:end].split())
            if words >= min_words:
                if spans and start <= spans[-1][1]:
                    start, end = spans[-1][0], max(end, spans.pop()[1])
                spans.append((start, end))
        run.clear()

    for start, end in units(text):
        n += 1
        digest, words = known_units[start, end] = unit_digest(text[start:end], plain)
        if digest is None:
            if run:
                run.append((start, end, 0, None))
            continue
        if digest in elsewhere or digest in seen:
            run.append((start, end, words, digest))
        else:
            close()
            seen[digest] = start, end
    close()
    lines, earlier = [], set()
    for start, end, digest in line_digests(text, known_units):
        if digest in elsewhere or digest in earlier:
            lines.append((start, end))
        earlier.add(digest)
    return merged(spans, lines) if lines else spans, n


def merged(*parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that cover the same characters, ascending, none touching another."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(x for part in parts for x in part):
        if out and start <= out[-1][1]:
            start, end = out[-1][0], max(end, out.pop()[1])
        out.append((start, end))
    return out


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without ``spans`` and the white space that follows each."""
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:start])
        while end < len(text) and text[end].isspace():
            end += 1
        at = end
    out.append(text[at:])
    kept = "".join(out)
    return kept.rstrip() if spans and spans[-1][1] >= len(text.rstrip()) else kept


def document_digests(docs: DataFrame) -> DataFrame:
    """(id, d1, d2): the distinct unit and line digests of each row of ``docs`` (id, t)."""
    ship_package(docs.sparkSession)
    out = pa.schema([("id", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("unit_dedup")
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, digests = [], []
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = text_digests(text or "")
                    ids += [i] * len(found)
                    digests += found
                d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1])], schema=out)

    return docs.mapInArrow(run, from_arrow_schema(out))


def listed_digests(column: pa.ListArray) -> Iterator[list[tuple]]:
    """Per row (digest, further fields ...) of its structs (d1, d2, further fields ...); none for null."""
    d1, d2, *others = column.flatten().flatten()
    raw = np.stack([d1.to_numpy(zero_copy_only=False), d2.to_numpy(zero_copy_only=False)], axis=1).astype("<i8").tobytes()
    entries = list(zip((raw[at:at + 16] for at in range(0, len(raw), 16)), *[c.to_pylist() for c in others]))
    at = 0
    for n in column.value_lengths().to_pylist():
        yield entries[at:at + (n or 0)]
        at += n or 0


def kept_words(docs: DataFrame, keepers: DataFrame, ident: str = "id", text_col: str = "t") -> DataFrame:
    """(d1, d2, left, right): the words beside the first occurrence of each unit of ``keepers`` (d1, d2, keeper)
    in the rows of its keeper. All columns of ``docs`` pass, so that another join with the same ``docs`` by
    ``ident`` can read the same shuffle."""
    asked_col = fresh("asked", docs.columns)
    asked = keepers.groupBy(F.col("keeper").alias(ident)).agg(F.collect_list(F.struct("d1", "d2")).alias(asked_col))
    text_at = docs.columns.index(text_col)
    out = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("left", pa.string()), ("right", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("unit_dedup")
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                digests, sides = [], []
                for text, wanted in zip(part.column(text_at).to_pylist(), listed_digests(part.column(part.num_columns - 1))):
                    left = {d for d, in wanted}
                    plain = tidy(text or "")
                    for a, b in units(text or ""):
                        digest, words = unit_digest(text[a:b], plain)
                        if digest in left:
                            left.remove(digest)
                            if words >= TELLING:
                                digests.append(digest)
                                sides.append(beside(text, a, b))
                d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(d[:, 0]), pa.array(d[:, 1]), *[
                    pa.array([s[k].encode("utf-8", "replace").decode() for s in sides], pa.string()) for k in (0, 1)]], schema=out)

    both = docs.join(asked, ident).select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"`{asked_col}`"))
    return both.mapInArrow(run, from_arrow_schema(out))


def perhaps_shared(held: DataFrame, keepers: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """``held`` without most of the rows whose digest is not in ``keepers``: those that miss the bitmap of its digests.
    No row with a digest of ``keepers`` goes; the fuller the bitmap, the more others stay."""
    bits = max(1 << 15, min(most_bits, BITS_A_DIGEST * keepers.count()))
    number = F.pmod(F.xxhash64("d1"), F.lit(bits)) + 1              # bitmap functions count from 1
    bucket, bit = F.bitmap_bucket_number(number), F.bitmap_bit_position(number)
    maps = keepers.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("map"))
    byte = F.conv(F.hex(F.substring("map", F.floor(F.col("bit") / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    return (held.withColumn("bucket", bucket).withColumn("bit", bit).join(F.broadcast(maps), "bucket")
            .where(F.getbit(byte, F.pmod(F.col("bit"), F.lit(8)).cast("int")) == 1).select(*held.columns))


def kept_elsewhere(docs: DataFrame, ident: str = "id", text_col: str = "t") -> DataFrame:
    """(id, elsewhere): per document the digests whose first occurrence is in another document, and the words beside that."""
    held = materialized(document_digests(docs.select(F.col(f"`{ident}`").alias("id"), F.col(f"`{text_col}`").alias("t"))), "unit-digests")
    keepers = materialized(held.groupBy("d1", "d2").agg(F.min("id").alias("keeper"), F.max("id").alias("last")).where(
        "keeper < last").select("d1", "d2", "keeper"), "unit-keepers")
    known = keepers.join(kept_words(docs, keepers, ident, text_col), ["d1", "d2"], "left")
    moved = perhaps_shared(held, keepers).join(known, ["d1", "d2"]).where("id != keeper")
    return moved.groupBy("id").agg(F.collect_set(F.struct("d1", "d2", "left", "right")).alias("elsewhere"))


def remove_repeats(docs: DataFrame, key: str = "doc_id", text_col: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeats cut from the text, plus ``removed`` (array of start, end) and ``n_units``."""
    ship_package(docs.sparkSession)
    names = docs.columns
    ident = F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(NO_ID))
    e, i = fresh("elsewhere", names), fresh("id", names)
    whole = docs.withColumn(i, ident)
    elsewhere = kept_elsewhere(whole, i, text_col)
    # no column is left out before the join: what is dealt by id is then the same as in kept_words, and is dealt once
    both = whole.join(elsewhere.select(F.col("id").alias(i), F.col("elsewhere").alias(e)), i, "left").select(
        *[F.col(f"`{c}`") for c in names], F.col(f"`{i}`"), e)
    removed = fresh("removed", names)
    count = fresh("n_units", [*names, removed])
    added = StructType.fromDDL("removed array<struct<start:bigint,end:bigint>>, n_units bigint")
    schema = StructType([*docs.schema.fields, *[StructField(n, f.dataType) for n, f in zip((removed, count), added)]])
    out = to_arrow_schema(schema)
    text_at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("unit_dedup")
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts, spans, counts = [], [], []
                for text, far in zip(part.column(text_at).to_pylist(), listed_digests(part.column(len(names) + 1))):
                    around = {}
                    for digest, left, right in far:
                        known = around.setdefault(digest, [])
                        if left is not None:
                            known.append((left, right))
                    found, n = repeated_spans(text or "", around.keys(), min_words, around)
                    texts.append(text if text is None else cut(text, found) if found else text)
                    spans.append([{"start": a, "end": b} for a, b in found])
                    counts.append(n)
                cols = [part.column(k).cast(out.field(k).type) for k in range(len(names))]
                cols[text_at] = pa.array(texts, out.field(text_at).type)
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(spans, out.field(removed).type), pa.array(counts, pa.int64())], schema=out)

    return both.mapInArrow(run, schema)


def unit_dedup_query(docs: DataFrame) -> DataFrame:
    done = remove_repeats(docs.select("doc_id", "text"))
    chars = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return done.select("doc_id", "n_units", "removed", chars.alias("removed_chars"), "text")
