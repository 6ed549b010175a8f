"""Token-id output: plane-shuffled, zstandard-compressed id chunks with an index.

:func:`write_ids` encodes texts with a public tokenizer, appends an end id to
each document and writes the ids in ascending key order. The rows of the file
are *chunks* of whole documents (at least ``CHUNK_IDS`` ids, the last of a
shard fewer). The ids of a chunk are cut into blocks of ``BLOCK_IDS``; each
block of 32-bit little-endian ids is transposed into byte planes (or bit
planes), and each plane is compressed on its own. Columns of a chunk:

=============  ==================================================================
shard, chunk   place of the chunk: shards ascend by key, chunks within a shard
n_ids          ids in the chunk
keys, lengths  key and number of ids (end id included) of each document
plane_bits     8 (byte planes) or 1 (bit planes)
blocks         index: per block its ids, its offset in ``payload``, plane sizes
payload        the compressed planes, one after another
=============  ==================================================================

The chunks are Parquet rows, so Spark's committer publishes them: a lost
executor leaves no half-written file. :func:`read_ids` decodes chunk by chunk;
chunks hold whole documents, so no shuffle is needed.

Defined cases: a null text is empty, so only the end id is stored; equal keys
are ordered by text; null keys come first; an empty table gives no chunk; a
very long text makes one larger chunk and is decoded block by block.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import chain, count, islice, pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from adlife.llm.common import ship_package, worker_cache

BLOCK_IDS = 1 << 16
CHUNK_IDS = 1 << 18
#: Bytes of remembered parts, and of a part besides its text and its ids.
CACHED_BYTES = 128 << 20
ENTRY_BYTES = 190
ZSTD_LEVEL = 3

CHUNK_SCHEMA = ("shard int, chunk int, n_ids long, keys array<bigint>, lengths array<bigint>, plane_bits int, "
                "blocks array<struct<n:int,offset:bigint,sizes:array<int>>>, payload binary")

#: Characters that are certainly not white space.
_SOLID = "!-~¡-ɏ"
#: A blank between two solid characters always starts a new pre-token of a byte-level BPE, so what
#: stands between such blanks can be encoded one by one (and remembered).
_PART = re.compile(rf"(?<=[{_SOLID}]) (?=[{_SOLID}])")
_ENDS = re.compile(rf"[{_SOLID}](?:.*[{_SOLID}])?", re.DOTALL)
#: So does ASCII punctuation after a letter or a digit.
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: One pre-token of a byte-level BPE, as is ASCII punctuation behind it.
_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+|[0-9]+")
#: Byte-level BPE's signs for a blank and a line end, and for each byte.
_BLANK, _LINE_END = "\u0120", "\u010a"
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_SIGNS = {b: b for b in _PRINTED} | {b: 256 + k for k, b in enumerate(sorted({*range(256)} - _PRINTED))}
_BYTE_SIGNS |= {ord(c): c for c in " \n"}         # these stand between pieces


class Encoder:
    """Whole-text encoding with the tokenizers library, remembering the ids of parts.

    A text is cut at its blanks and before its line ends (one between two solid characters is a pre-token
    of its own). Each part has a number; ``starts`` and ``lengths`` say where its ids stand in ``store``. ``spaced`` numbers
    the parts with a blank (or a line end, which they then start with) before them, ``bare`` those without, ``last`` text
    ends that may be white space. When ``CACHED_BYTES`` are held, the half of the parts that was met in the most calls
    stays, so memory is bounded by bytes, however long the parts are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [a.content for a in self.tokenizer.get_added_tokens_decoder().values()]
        #: The same model for pre-tokens that are known as such: byte signs between blanks.
        self.pieces = Tokenizer(self.tokenizer.model)
        self.pieces.pre_tokenizer = CharDelimiterSplit(" ")
        cut = self.tokenizer.pre_tokenizer
        self.plain = self.tokenizer.normalizer is None and isinstance(cut, ByteLevel) and cut.use_regex and not cut.add_prefix_space
        vocabulary = self.tokenizer.get_vocab()
        self.end_of_line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.first = np.zeros(1 + max(vocabulary.values()), bool)         # ids that start a part
        self.first[[i for token, i in vocabulary.items() if token.startswith(_BLANK)]] = True
        self.kind = np.dtype("<u2" if len(self.first) <= 1 << 16 else "<u4")
        self._anew([], np.zeros(0, np.int64))

    def _anew(self, parts: list[str], numbers: np.ndarray) -> None:
        """Holds just ``parts``, which had these numbers so far."""
        if parts:
            lengths, self.uses = self.lengths[numbers], self.uses[numbers] // 2
            self.store, self.used = self._gathered(numbers), int(lengths.sum())
        else:
            lengths, self.uses = np.zeros(0, np.int64), np.zeros(0, np.int64)
            self.store, self.used = np.zeros(0, self.kind), 0
        self.starts, self.lengths = np.cumsum(lengths) - lengths, lengths
        number = count().__next__
        self.spaced, self.bare, self.last = (defaultdict(number) for _ in range(3))
        self.spaced.update((p, number()) for p in parts)
        self.held = sum(map(len, parts)) + self._bytes(self.used) + ENTRY_BYTES * len(parts)    # about

    def _forget(self) -> None:
        parts, numbers = list(self.spaced), np.fromiter(self.spaced.values(), np.int64, len(self.spaced))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        best = np.lexsort((sizes, -self.uses[numbers]))[:len(parts) // 2]
        best = best[self.lengths[numbers[best]] >= 0]
        self._anew([parts[i] for i in best.tolist()], numbers[best])

    def _room(self) -> None:
        """Every part that has a number gets its place."""
        more = sum(map(len, (self.spaced, self.bare, self.last))) - len(self.lengths)
        if more > 0:
            none = np.full(more, -1)
            self.starts, self.lengths = np.append(self.starts, none), np.append(self.lengths, none)
            self.uses = np.append(self.uses, none + 1)

    def _bytes(self, ids: int) -> int:
        return self.kind.itemsize * ids

    def _gathered(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of the parts, one behind the other."""
        found = [self.store[:0]]
        for at in range(0, len(numbers), 1 << 16):               # places take more space than ids
            some = numbers[at:at + (1 << 16)]
            lengths = self.lengths[some]
            ends = np.cumsum(lengths)
            found.append(self.store[np.repeat(self.starts[some] - ends + lengths, lengths) + np.arange(ends[-1])])
        return np.concatenate(found)

    def _hold(self, ids: np.ndarray) -> int:
        """Appends to the store; the place of the first."""
        at, self.used = self.used, self.used + len(ids)
        if self.used > len(self.store):
            self.store = np.concatenate((self.store[:at], np.zeros(max(at, len(ids)), self.kind)))
        self.store[at:self.used] = ids
        return at

    def _results(self, numbers: np.ndarray, counts: np.ndarray) -> list:
        """What :meth:`encode` gives for texts of so many parts."""
        ids = self._gathered(numbers).astype("<u4")
        ends = np.cumsum(self.lengths[numbers])[np.cumsum(counts) - 1]
        return [ids[a:b].tobytes() for a, b in pairwise([0, *ends.tolist()])]

    def encode(self, texts: list[str]) -> list:
        """Little-endian 32-bit ids of each text."""
        if not texts:
            return []
        if self.held > CACHED_BYTES:
            self._forget()
        # a special token's string is one token wherever it stands: such texts are not cut
        parts = [[t] if any(s in t for s in self.special) else t.replace("\n", " \n").split(" ") for t in texts]
        heads = [ps.pop(0) for ps in parts]
        numbers, counts = self._numbers(heads, parts)
        risky = np.logical_or.reduceat(self.lengths[numbers] < 0, np.cumsum(counts) - counts)
        risky |= [len(ps) > 0 and not _ENDS.fullmatch(h) for h, ps in zip(heads, parts)]
        if not risky.any():
            return self._results(numbers, counts)
        careful = np.flatnonzero(risky).tolist()                  # not every blank is safe here
        ends = {}
        for i in careful:
            heads[i], *parts[i] = _PART.split(texts[i])
            if parts[i] and not _ENDS.fullmatch(parts[i][-1]):
                ends[i] = parts[i].pop()
        again, n = self._numbers([heads[i] for i in careful], [parts[i] for i in careful], [ends.get(i) for i in careful])
        plain = ~risky
        out = iter(self._results(numbers[np.repeat(plain, counts)], counts[plain]) if plain.any() else ())
        late = iter(self._results(again, n))
        return [next(late if r else out) for r in risky.tolist()]

    def _numbers(self, heads: list[str], parts: list[list[str]], ends: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all parts, text by text, and how many each text has; the new ones are learned."""
        inner = np.fromiter(map(len, parts), np.int64, len(parts))
        known = [len(d) for d in (self.bare, self.spaced, self.last)]
        head = np.fromiter(map(self.bare.__getitem__, heads), np.int64, len(heads))
        flat = np.fromiter(map(self.spaced.__getitem__, chain.from_iterable(parts)), np.int64, int(inner.sum()))
        closed = np.array([e is not None for e in ends or heads] if ends else [False] * len(heads))
        tail = np.array([self.last[e] for e in ends or () if e is not None], np.int64)
        counts = 1 + inner + closed
        stop = np.cumsum(counts)
        numbers, body = np.empty(int(stop[-1]), np.int64), np.ones(int(stop[-1]), bool)
        body[stop - counts] = False
        body[stop[closed] - 1] = False
        numbers[body], numbers[stop - counts], numbers[stop[closed] - 1] = flat, head, tail
        self._room()
        self.uses[flat] += 1
        # the bare ones first: they may be the punctuation behind spaced ones
        for d, n, learn in zip((self.bare, self.spaced, self.last), known, (self._learn_bare, self._learn_spaced, self._learn_last)):
            if len(d) > n:
                learn(self._new(d, n))
        return numbers, counts

    def _new(self, numbered: dict[str, int], known: int) -> dict[str, int]:
        """The parts behind the first ``known`` ones."""
        new = dict(islice(reversed(numbered.items()), len(numbered) - known))
        self.held += sum(map(len, new)) + ENTRY_BYTES * len(new)
        return new

    def _keep(self, numbers: list[int], ids: list[int] | np.ndarray, starts, ends) -> None:
        """The ids of the parts are stretches of ``ids``."""
        at, starts = self._hold(np.asarray(ids, self.kind)), np.asarray(starts, np.int64)
        self.starts[numbers], self.lengths[numbers] = at + starts, ends - starts
        self.held += self._bytes(len(ids))

    def _learn(self, new: dict[str, int], before: str = "", first: Sequence[int] = ()) -> None:
        """The ids of each text behind ``before``, the ids ``first`` in front."""
        parts = list(new)
        for at in range(0, len(parts), 20_000):
            group = parts[at:at + 20_000]
            found = [[*first, *e.ids] for e in self.tokenizer.encode_batch_fast([before + p for p in group], add_special_tokens=False)]
            ends = np.cumsum(list(map(len, found)))
            self._keep([new[p] for p in group], list(chain.from_iterable(found)), np.append(0, ends[:-1]), ends)

    def _learn_last(self, new: dict[str, int]) -> None:
        self._learn(new, " ")

    def _learn_bare(self, new: dict[str, int]) -> None:
        self._learn(new)

    def _learn_spaced(self, new: dict[str, int]) -> None:
        """The ids of each part behind a blank; of one that starts with a line end, as it stands. Open ones
        (their outer characters may be white space) keep the length -1."""
        words, accented, lines, tailed, others, other_lines = {}, {}, {}, [], {}, {}
        get = self.spaced.get if self.plain else None
        for p, n in new.items():
            if get and p.isalpha() and p.isascii():
                words[p] = n
                continue
            line = p[:1] == "\n"
            inner = p[1:] if line else p
            word = inner.rstrip(_PUNCTUATION)
            if get and _WORD.fullmatch(word):
                if len(word) == len(inner):
                    (lines if line else words if p.isascii() else accented)[word] = n
                    continue
                tail = inner[len(word):]
                stem = None if line else get(word)
                if stem is None:
                    (lines if line else words if p.isascii() else accented)[f"{word} {tail}"] = n
                else:
                    tailed.append((n, stem, tail))
            elif _ENDS.fullmatch(inner):
                (other_lines if line else others)[inner] = n
        self._learn_joined(words, self.pieces, _BLANK, " ", others)
        self._learn_joined(accented, self.pieces, _BLANK, " ", others)
        self._learn_joined(lines, self.pieces, _LINE_END + " ", "\n", other_lines)
        single = {p: others.pop(p) for p in [p for p in others if " " in p]}
        self._learn_joined(others, self.tokenizer, " ", " ", single)
        self._learn(single, " ")
        self._learn(other_lines, first=self.end_of_line)
        if tailed:
            self._learn_tailed(*zip(*tailed))

    def _learn_tailed(self, numbers: tuple[int], stems: tuple[int], tails: tuple[str]) -> None:
        """Known words with punctuation behind them are put together."""
        known = len(self.bare)
        tail = [self.bare[t] for t in tails]
        if len(self.bare) > known:
            self._room()
            self._learn_bare(self._new(self.bare, known))
        both = np.array([stems, tail]).T.ravel()
        ends = np.cumsum(self.lengths[both])[1::2]
        self._keep(list(numbers), self._gathered(both), np.append(0, ends[:-1]), ends)

    def _learn_joined(self, new: dict[str, int], tokenizer, before: str, sign: str, others: dict[str, int]) -> None:
        """Many parts are encoded as one text, ``before`` in front of each: its first token starts with a blank, or
        is a line end. Those that are not told apart so go to ``others``."""
        parts, pieces = list(new), tokenizer is self.pieces
        for at in range(0, len(parts), 10_000):
            group = parts[at:at + 10_000]
            numbers = [new[p] for p in group]
            text = ("\n" if pieces else before).join(group)
            if pieces and not text.isascii():
                text = text.encode().decode("latin-1").translate(_BYTE_SIGNS)
            text = before + text.replace("\n", f" {before}") if pieces else before + text
            found = [] if not pieces and any(s in text for s in self.special) else (
                tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)
            ids = np.array(found, self.kind)
            starts = np.flatnonzero(self.first[ids] if sign == " " else ids == self.end_of_line[0])
            if len(starts) == len(group):
                self._keep(numbers, ids, starts, np.append(starts[1:], len(ids)))
            else:
                others.update((p.replace(" ", "") if pieces else p, n) for p, n in zip(group, numbers))


class TokenCounter(Encoder):
    """The same for the number of ids alone: the ids are not stored."""

    def _bytes(self, ids: int) -> int:
        return 0

    def _gathered(self, numbers: np.ndarray) -> np.ndarray:
        return self.store

    def _hold(self, ids: np.ndarray) -> int:
        return 0

    def _results(self, numbers: np.ndarray, counts: np.ndarray) -> list[int]:
        return np.add.reduceat(self.lengths[numbers], np.cumsum(counts) - counts).tolist()


def token_counter(path: str) -> TokenCounter:
    """One counter per worker process, until a task of another operator runs there."""
    return worker_cache(f"token counter {path}", lambda: TokenCounter(path))


def encoder(path: str) -> Encoder:
    """One encoder per worker process, until a task of another operator runs there."""
    return worker_cache(f"encoder {path}", lambda: Encoder(path))


def to_planes(ids: np.ndarray, plane_bits: int) -> list[bytes]:
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if plane_bits == 8:
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, plane_bits: int) -> np.ndarray:
    if plane_bits == 8:
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in planes], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).reshape(-1).view("<u4")


def _chunk_row(shard: int, chunk: int, keys: list, lengths: list, data: bytes, plane_bits: int) -> dict:
    pack = zstandard.ZstdCompressor(level=ZSTD_LEVEL)
    ids = np.frombuffer(data, "<u4")
    blocks, payload, offset = [], [], 0
    for at in range(0, len(ids), BLOCK_IDS):
        block = ids[at:at + BLOCK_IDS]
        packed = [pack.compress(p) for p in to_planes(block, plane_bits)]
        blocks.append({"n": len(block), "offset": offset, "sizes": [len(p) for p in packed]})
        payload += packed
        offset += sum(map(len, packed))
    return {"shard": shard, "chunk": chunk, "n_ids": len(ids), "keys": keys, "lengths": lengths,
            "plane_bits": plane_bits, "blocks": blocks, "payload": b"".join(payload)}


def _schemas(ddl: str):
    schema = StructType.fromDDL(ddl)
    return schema, to_arrow_schema(schema)


def write_ids(docs: DataFrame, path: str, tokenizer_file: str, key: str = "doc_id", text_col: str = "text",
              end_id: int = 0, plane_bits: int = 8) -> None:
    """Encode every whole text of ``docs`` and write the chunk files to ``path``."""
    ship_package(docs.sparkSession)
    schema, out = _schemas(CHUNK_SCHEMA)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, chunk = encoder(tokenizer_file), TaskContext.get().partitionId(), 0
        keys, lengths, data, size = [], [], [], 0

        def flush():
            row = _chunk_row(shard, chunk, keys, lengths, b"".join(data), plane_bits)
            return pa.RecordBatch.from_pylist([row], schema=out)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for k, ids in zip(part.column(0).to_pylist(), enc.encode(texts)):
                    keys.append(k)
                    lengths.append(len(ids) // 4 + 1)
                    data += (ids, end)
                    size += lengths[-1]
                    if size >= CHUNK_IDS:
                        yield flush()
                        keys, lengths, data, size = [], [], [], 0
                        chunk += 1
        if keys:
            yield flush()

    ordered = (docs.select(F.col(f"`{key}`").cast("long").alias("k"), F.col(f"`{text_col}`").alias("t"))
               .repartitionByRange("k").sortWithinPartitions("k", "t"))
    ordered.mapInArrow(run, schema).write.option("parquet.block.size", 16 << 20).parquet(path)


def chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CHUNK_SCHEMA).parquet(path)


def chunk_starts(index: DataFrame) -> DataFrame:
    """(shard, chunk, before): ids of all earlier chunks. Cumulated within shards, then over one row per shard."""
    shards = index.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return (index.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
            .join(shards, "shard").select("shard", "chunk", (F.col("base") + F.col("inside")).alias("before")))


def decode_blocks(row: dict) -> Iterator[bytes]:
    """The raw little-endian ids of a chunk, block by block."""
    unpack = zstandard.ZstdDecompressor()
    for block in row["blocks"]:
        at, planes = block["offset"], []
        for size in block["sizes"]:
            planes.append(unpack.decompress(row["payload"][at:at + size]))
            at += size
        yield from_planes(planes, block["n"], row["plane_bits"]).tobytes()


def decode_documents(row: dict) -> Iterator[tuple]:
    """(key, start in the chunk, number of ids, crc32 of the id bytes) of a chunk's documents."""
    todo = iter(zip(row["keys"], row["lengths"]))
    key, left = next(todo)
    length, crc, start = left, 0, 0
    for raw in decode_blocks(row):
        at = 0
        while at < len(raw):
            take = min(left * 4, len(raw) - at)
            crc = zlib.crc32(raw[at:at + take], crc)
            at += take
            left -= take // 4
            if not left:
                yield key, start, length, crc
                start += length
                key, left = next(todo, (None, 0))
                length, crc = left, 0


def read_ids(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every stored document, decoded from the files."""
    ship_package(spark)
    schema, out = _schemas("shard int, chunk int, k bigint, at bigint, n_tokens bigint, ids_crc32 bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                found = list(zip(*decode_documents(row)))
                n = len(found[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * n, pa.int32()), pa.array([row["chunk"]] * n, pa.int32()),
                     *[pa.array(c, pa.int64()) for c in found]], schema=out)

    stored = chunks(spark, path)
    rows = stored.mapInArrow(run, schema)
    return rows.join(chunk_starts(stored.select("shard", "chunk", "n_ids")), ["shard", "chunk"]).select(
        F.col("k").alias(key), (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
