"""Near-duplicate texts: BagMinHash signatures, banding, exact multiset overlap.

A text is the multiset of its runs of five lower-cased words (split at ASCII
white space; a text of one to four words is one run). Two texts are linked when
the multiset Jaccard similarity of their runs is at least ``SIMILARITY``.

Signatures. For every run a Poisson process over (time, weight, component) is
defined by hashes of the run alone. The weight axis is cut into the levels
(0, 1], (1, 2], (2, 4], (4, 8], ...; a run that occurs w times sees the points
below w: whole levels, and in the level that holds w the points whose successive
halvings fall below w. A component keeps its earliest point, so two signatures
agree there with probability equal to the weighted Jaccard similarity. Points
are generated in time order up to a limit at which all components are filled
but for a small rest, whose limit is doubled; no later point can win.

Candidates. ``BANDS`` bands of ``ROWS`` components; at similarity 0.8 a pair
shares no band with probability 3e-6. Equal texts are merged first. In each
bucket all members are compared with one leader only; texts that these links
have already joined need no further comparison. Rounds follow: a bucket that still holds
several components picks a few other members by a hash of the round, its members of other
components are compared with those, and what is alike is joined, so a large group
shrinks to one component by comparisons in proportion to its size. When few pairs are
left, or a round joins nothing, members of a bucket that are in
different components are paired, once per pair (in the least bucket
they share). Rounds and pairs leave out what a finer sketch rules out: ``FINE`` components of
two bits, whose mismatches exceed what similarity 0.8 gives by ``SIGMAS``
standard deviations (a chance of 3e-6 at exactly 0.8, less above). So each shared
bucket ends with its members compared, joined or ruled out. Every comparison is
the exact multiset overlap of the whole texts.

Defined cases: a null, empty or blank text has no runs and stays alone; rows
with equal words (however spaced) share a class; rows are told apart by their
text, so repeated ids are fine; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from adlife.llm.common import fresh, materialized, portions, ship_package, worker_cache
from adlife.llm.components import stars

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5
FINE, SIGMAS = 1024, 4.5
#: Members that speak for a bucket in a round; pairs a member (that pass the sketch) up to which pairs are made
#: without (more) rounds; what share of pairs a round may leave for another to follow.
SPEAKERS, PAIRS_A_MEMBER, SHRINK = 4, 4, 0.8
PIECE_BYTES = 1 << 18

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)            # odd: invertible modulo 2**64
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, elementwise."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _new_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE, dtype=np.uint64)
    down = np.full(n, _BASE_INVERSE, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base; those for a common piece are kept, more (for one very long text) are not."""
    if n > 2 * PIECE_BYTES:
        return _new_powers(n)
    return worker_cache("bagminhash", lambda: _new_powers(2 * PIECE_BYTES))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(document index, hash) of every word, in text order."""
    raw = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    ends_at = np.cumsum([len(r) + 1 for r in raw])
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(np.concatenate(([True], blank)).astype(np.int8))
    first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)   # [first, last)
    up, down = _powers(len(data) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + _U(1)) * up[:len(data)])))
    h = mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    return np.searchsorted(ends_at, first, side="right"), h


def bags(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """(document index, run hash, count) of the distinct runs, sorted by both; and a digest per document."""
    doc, h = word_hashes(texts)
    n = np.bincount(doc, minlength=len(texts))
    at = np.concatenate(([0], np.cumsum(n)))
    digests = [xxhash.xxh3_128_digest(h[at[i]:at[i + 1]].tobytes()) if n[i] else None for i in range(len(texts))]
    run = h.copy()
    size = len(h) - SHINGLE + 1
    if size > 0:
        run = run[:size]
        for k in range(1, SHINGLE):
            run = mix(run * _BASE + h[k:k + size])
        whole = doc[:size] == doc[SHINGLE - 1:]
        rdoc, run = doc[:size][whole], run[whole]
    else:
        rdoc, run = doc[:0], run[:0]
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        extra = np.array([xxhash.xxh3_64_intdigest(h[at[i]:at[i + 1]].tobytes()) for i in short], dtype=np.uint64)
        rdoc, run = np.concatenate((rdoc, short)), np.concatenate((run, extra))
    order = np.lexsort((run, rdoc))
    rdoc, run = rdoc[order], run[order]
    new = np.ones(len(run), bool)
    new[1:] = (run[1:] != run[:-1]) | (rdoc[1:] != rdoc[:-1])
    starts = np.flatnonzero(new)
    return rdoc[starts], run[starts], np.diff(np.append(starts, len(run))), digests


def signatures(doc: np.ndarray, run: np.ndarray, count: np.ndarray, docs: int, m: int) -> np.ndarray:
    """(docs, m) BagMinHash signatures as 64-bit point names; rows of documents without runs are 0."""
    weight = np.bincount(doc, count, docs)
    # one row per (run, weight level that its count reaches)
    levels = np.where(count > 1, np.ceil(np.log2(count)).astype(np.int64), 0) + 1
    at = np.repeat(np.arange(len(run)), levels)
    level = np.arange(len(at)) - np.repeat(np.cumsum(levels) - levels, levels)
    below = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)          # the level starts here
    width = np.where(level > 0, below, 1)
    seed = mix(run[at] + mix(level.astype(np.uint64) + _U(1)))
    e_doc, e_count = doc[at], count[at]
    out = np.zeros((docs, m), np.uint64)
    todo, span = weight > 0, np.log(m) + 2.5
    while todo.any():
        limit = np.where(todo, span / np.maximum(weight, 1), -1.0)
        names, times, cells = [], [], []
        active = np.flatnonzero(todo[e_doc])
        size_class = np.log2(weight[e_doc[active]]).astype(int)
        for c in np.unique(size_class):
            rows = active[size_class == c]
            step = max(1, int(m * span / 2.0 ** c))                        # points a run at a time
            x0, k = np.zeros(len(rows)), 0
            while len(rows):
                part = np.arange(k + 1, k + step + 1, dtype=np.uint64)
                u = mix(seed[rows][:, None] + part[None, :] * _BASE)
                gaps = -np.log(((u >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / (m * width[rows][:, None])
                x = x0[:, None] + np.cumsum(gaps, axis=1)
                early = x <= limit[e_doc[rows]][:, None]
                r, j = np.nonzero(early)
                v = mix(u[r, j] ^ _BASE)
                # halving the level again and again: the binary digits of the position
                spot = below[rows][r] + (((v & _U(0xFFFFFFFF)) * width[rows][r].astype(np.uint64)) >> _U(32)).astype(np.int64)
                seen = spot < e_count[rows][r]
                r, j, v = r[seen], j[seen], v[seen]
                names.append(v)
                times.append(x[r, j])
                cells.append(e_doc[rows][r] * m + (((v >> _U(32)) * _U(m)) >> _U(32)).astype(np.int64))
                on = early[:, -1]
                rows, x0, k = rows[on], x[on, -1], k + step
        name, time, cell = (np.concatenate(a) if a else np.zeros(0, t) for a, t in (
            (names, np.uint64), (times, np.float64), (cells, np.int64)))
        order = np.argsort(-time, kind="stable")                           # the earliest point is written last
        filled = np.zeros(docs * m, bool)
        filled[cell] = True
        flat = out.reshape(-1)
        flat[cell[order]] = name[order]
        todo = todo & ~filled.reshape(docs, m).all(axis=1)
        span *= 2
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.repeat(mix(np.arange(1, bands + 1, dtype=np.uint64))[None, :], len(sig), axis=0)
    parts = sig.reshape(len(sig), bands, rows)
    for k in range(rows):
        keys = mix(keys * _BASE + parts[:, :, k])
    return keys.view(np.int64)


def fine_sketches(sig: np.ndarray) -> np.ndarray:
    """Two bits of every component, 32 components a 64-bit number."""
    bits = mix(sig) & _U(3)
    return (bits.reshape(len(sig), -1, 32) << (_U(2) * np.arange(32, dtype=np.uint64))).sum(axis=2, dtype=np.uint64).view(np.int64)


def mismatches(a: Column, b: Column) -> Column:
    """Components in which two fine sketches differ."""
    def differ(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        return F.bit_count(z.bitwiseOR(F.shiftrightunsigned(z, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return F.aggregate(F.zip_with(a, b, differ), F.lit(0), lambda n, x: n + x)


def most_mismatches(similarity: float) -> int:
    """Of texts at ``similarity``: the mean plus ``SIGMAS`` standard deviations (two bits agree by chance in 1 of 4)."""
    p = (1 - similarity) * 0.75
    return int(FINE * p + SIGMAS * (FINE * p * (1 - p)) ** 0.5)


def sketched(texts: DataFrame) -> DataFrame:
    """(digest, fine) of written texts (digest, t)."""
    ship_package(texts.sparkSession)
    schema = StructType.fromDDL("digest binary, fine array<bigint>")
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            wanted, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in pieces(texts, PIECE_BYTES * BANDS * ROWS // FINE):       # as many points at a time as in signed()
                doc, runs, count, digests = bags(texts[part])
                fine = fine_sketches(signatures(doc, runs, count, len(digests), FINE))
                same = [i for i, d in enumerate(digests) if d == wanted[part.start + i]]
                if same:
                    yield pa.RecordBatch.from_arrays([pa.array([digests[i] for i in same], pa.binary()), pa.array(
                        [fine[i] for i in same], pa.list_(pa.int64()))], schema=out)

    return texts.select("digest", "t").mapInArrow(run, schema)


def pieces(texts: list, most: int = PIECE_BYTES) -> Iterator[slice]:
    """Consecutive slices of about ``most`` characters; a longer text stands alone."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t or "") > most:
            yield slice(start, i)
            start, size = i, 0
        size += len(t or "")
    if texts:
        yield slice(start, len(texts))


def signed(docs: DataFrame, key: str, text_col: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, raw, digest, n, bands): digests of the text and of its words, number of runs and band keys of every whole text."""
    ship_package(docs.sparkSession)
    schema = StructType.fromDDL("id bigint, raw binary, digest binary, n bigint, bands array<bigint>")
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            ids, texts, raw = batch.column(0), batch.column(1).to_pylist(), batch.column(2)
            for part in pieces(texts):
                doc, runs, count, digests = bags(texts[part])
                n = np.bincount(doc, count, len(digests)).astype(np.int64)
                keys = band_keys(signatures(doc, runs, count, len(digests), bands * rows), bands, rows)
                keys = [k if d else [] for k, d in zip(keys, digests)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(part.start, len(digests)).cast(pa.int64()), raw.slice(part.start, len(digests)), pa.array(digests, pa.binary()),
                     pa.array(n), pa.array(keys, pa.list_(pa.int64()))], schema=out)

    return docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("t"),
                       raw_digest(F.col(f"`{text_col}`")).alias("raw")).mapInArrow(run, schema)


def verified(pairs: DataFrame, least: float) -> DataFrame:
    """The (a, b) of ``pairs`` (a, b, text_a, text_b) whose multiset similarity is ``least`` or more."""
    ship_package(pairs.sparkSession)
    schema = StructType.fromDDL("a binary, b binary, similarity double")
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = [t for pair in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()) for t in pair]
            found = []
            for part in pieces(texts):
                lo, hi = part.start + part.start % 2, part.stop + part.stop % 2    # whole pairs
                doc, runs, count, digests = bags(texts[lo:hi])
                at = np.searchsorted(doc, np.arange(len(digests) + 1))
                for i in range(0, len(digests), 2):
                    k = (lo + i) // 2
                    if digests[i] != a[k] or digests[i + 1] != b[k]:        # another text under this id
                        continue
                    x, y = slice(at[i], at[i + 1]), slice(at[i + 1], at[i + 2])
                    _, p, q = np.intersect1d(runs[x], runs[y], assume_unique=True, return_indices=True)
                    shared = int(np.minimum(count[x][p], count[y][q]).sum())
                    total = int(count[x].sum() + count[y].sum()) - shared
                    if shared >= least * total - 1e-9:
                        found.append((a[k], b[k], shared / total))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*found), (pa.binary(), pa.binary(), pa.float64()))], schema=out)

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(run, schema)


def node_texts(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Written (digest, t) of the nodes in ``wanted`` (digest): one pass over the documents."""
    ids = nodes.join(wanted, "digest").select("digest", F.col("at.id").alias("wanted_id"), F.col("at.raw").alias("wanted"))
    # by id and text, so that many texts under one id (or none) meet only their own
    rows = docs.withColumn("raw", raw_digest(F.col("t")))
    found = rows.join(ids, (F.col("raw") == F.col("wanted")) & F.col("id").eqNullSafe(F.col("wanted_id")))
    return materialized(found.dropDuplicates(["digest"]).select("digest", "t"), "texts")


def with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with both texts."""
    a = texts.select(F.col("digest").alias("a"), F.col("t").alias("text_a"))
    b = texts.select(F.col("digest").alias("b"), F.col("t").alias("text_b"))
    return pairs.join(b, "b").join(a, "a")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY) -> DataFrame:
    """(``key``, class_id, n_shingles): class_id is the least id of the row's class."""
    rows, by_text = _classes(docs, key, text_col, similarity)
    return rows.select("id", "digest", "n").join(by_text, "digest", "left").select(
        F.col("id").alias(key), F.coalesce("class_id", "id").alias("class_id"), F.col("n").alias("n_shingles"))


def one_per_class(docs: DataFrame, key: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay when one row of every class does: the one of the least id (null ids last),
    then of the least digest of its text. Rows are told apart by id and text, so rows that share an id, or have none,
    are judged each by its own class; rows equal in both are one. Rows without runs stay."""
    rows, by_text = _classes(docs, key, text_col, similarity)
    who = F.struct(F.col("id").isNull().alias("none"), "id", "raw")
    kept = rows.join(by_text, "digest").groupBy("root").agg(F.min(who).alias("who")).select("who.id", "who.raw")
    alone = rows.where(F.col("digest").isNull()).select("id", "raw")
    names = [fresh(c, docs.columns) for c in ("id_", "raw_")]
    kept = kept.unionByName(alone).distinct().toDF(*names)
    raw = fresh("raw", [*docs.columns, *names])
    whole = docs.withColumn(raw, raw_digest(F.col(f"`{text_col}`")))
    same = F.col(f"`{key}`").cast("long").eqNullSafe(F.col(names[0])) & F.col(raw).eqNullSafe(F.col(names[1]))
    return whole.join(kept, same, "left_semi").dropDuplicates([key, raw]).drop(raw)


def raw_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _edges(joined: DataFrame) -> DataFrame:
    """What joins the texts so far, as edges (a, b): each with the least of its component."""
    return joined.select(F.col("root").alias("a"), F.col("node").alias("b"))


def _classes(docs: DataFrame, key: str, text_col: str, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Written rows (id, raw, digest, n, bands), and (digest, root, class_id) of the texts that have runs."""
    texts = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("t"))
    rows = materialized(signed(docs, key, text_col), "signatures")
    some = rows.where(F.col("digest").isNotNull())
    # of every text one row to read it from: its least id, with the digest of that very text
    nodes = materialized(some.groupBy("digest").agg(
        F.min("id").alias("least_id"), F.min(F.struct("id", "raw")).alias("at"),
        F.any_value("n").alias("n"), F.any_value("bands").alias("bands")), "nodes")

    # buckets of two or more different texts, each member with its bucket's leader
    member = nodes.select(F.explode("bands").alias("bucket"), "digest", "n")
    led = member.groupBy("bucket").agg(F.min("digest").alias("leader"), F.min_by("n", "digest").alias("leader_n"),
                                       F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
    shared = materialized(member.join(led, "bucket"), "buckets")

    def alike(x: str, y: str):
        """The similarity is at most the ratio of the sizes."""
        return F.least(x, y) >= F.lit(similarity) * F.greatest(x, y) - 1e-9

    first = materialized(shared.where((F.col("digest") != F.col("leader")) & alike("n", "leader_n")).select(
        F.col("leader").alias("a"), F.col("digest").alias("b")).distinct(), "pairs")
    ends = first.select(F.col("a").alias("digest")).unionByName(first.select(F.col("b").alias("digest"))).distinct()
    links = materialized(verified(with_texts(first, node_texts(ends, nodes, texts)), similarity), "links")
    joined = stars(links.select("a", "b"))

    # what is left: members of one bucket that no link has joined yet, but for pairs already compared
    rest = (shared.where(F.col("digest") != F.col("leader")).join(joined, F.col("digest") == F.col("node"), "left")
            .select("bucket", "digest", "n", F.coalesce("root", "digest").alias("root")))
    split = rest.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
    rest = materialized(rest.join(split.select("bucket"), "bucket"), "rest")
    left = node_texts(rest.select("digest").distinct(), nodes, texts)
    detail = sketched(left).join(nodes.select("digest", "bands"), "digest")
    rest = materialized(rest.join(detail, "digest"), "rest")
    fine_enough = mismatches(F.col("fine_a"), F.col("fine_b")) <= most_mismatches(similarity)
    compared, turn, before = first, 0, float("inf")
    while True:
        # pairs of members in different components: rounds are for when they would be many
        apart = rest.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("bucket").agg(
            F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("same"))
        members, pairs = apart.agg(F.sum("c"), F.sum((F.col("c") * F.col("c") - F.col("same")) / 2)).first()
        if not pairs or pairs <= PAIRS_A_MEMBER * members or pairs > SHRINK * before:
            break
        before = pairs
        # the members with the least hashes speak for their bucket; two roots tell that there is something to join
        who = F.struct("digest", "n", "fine", "root")
        spoken = rest.groupBy("bucket").agg(
            F.array(*[F.min_by(who, F.xxhash64("digest", F.lit(turn * SPEAKERS + k))) for k in range(SPEAKERS)]).alias("s"),
            F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select(
            "bucket", F.explode(F.array_distinct("s")).alias("s")).select(
            "bucket", *[F.col(f"s.{c}").alias(f"{c}_b") for c in ("digest", "n", "fine", "root")])
        found = rest.withColumnRenamed("fine", "fine_a").join(spoken, "bucket").where(
            (F.col("root") != F.col("root_b")) & alike("n", "n_b") & fine_enough)
        found = materialized(found.select(F.least("digest", "digest_b").alias("a"), F.greatest("digest", "digest_b").alias("b")), "pairs")
        turn += 1
        # the share of speakers' pairs that the sketch lets pass tells how many of all pairs it would
        if pairs * found.count() <= PAIRS_A_MEMBER * members * SPEAKERS * members:
            break
        found = materialized(found.distinct().join(compared, ["a", "b"], "left_anti"), "pairs")
        new = materialized(verified(with_texts(found, left), similarity), "links").select("a", "b")
        if new.isEmpty():
            break
        compared = compared.unionByName(found)
        joined = stars(_edges(joined).unionByName(new))
        rest = materialized(rest.drop("root").join(joined, F.col("digest") == F.col("node"), "left").select(
            "bucket", "digest", "n", "fine", "bands", F.coalesce("root", "digest").alias("root")), "rest")
    x = rest.select("bucket", *[F.col(c).alias(f"{c}_a") for c in ("digest", "n", "root", "fine", "bands")])
    y = rest.select("bucket", *[F.col(c).alias(f"{c}_b") for c in ("digest", "n", "root", "fine", "bands")])
    second = x.join(y, "bucket").where(
        (F.col("digest_a") < F.col("digest_b")) & (F.col("root_a") != F.col("root_b")) & alike("n_a", "n_b") & fine_enough
        & (F.array_min(F.array_intersect("bands_a", "bands_b")) == F.col("bucket")))
    second = second.select(F.col("digest_a").alias("a"), F.col("digest_b").alias("b"))
    second = materialized(second.join(compared, ["a", "b"], "left_anti"), "pairs")
    if not second.isEmpty():
        more = materialized(verified(with_texts(second, left), similarity), "links")
        joined = stars(_edges(joined).unionByName(more.select("a", "b")))

    named = nodes.select("digest", "least_id").join(joined, F.col("digest") == F.col("node"), "left").select(
        "digest", "least_id", F.coalesce("root", "digest").alias("root"))
    classes = named.groupBy("root").agg(F.min("least_id").alias("class_id"))
    return rows, named.join(classes, "root").select("digest", "root", "class_id")
