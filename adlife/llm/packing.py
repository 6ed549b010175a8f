"""Packing: optimal length buckets and token-budget batches.

Texts are cut into segments of at most ``MAX_LENGTH`` tokens (nothing is
dropped). The global histogram of segment lengths (at most ``MAX_LENGTH`` rows)
goes to the driver, where dynamic programming chooses the bucket boundaries
that minimise the padding when every segment is padded to its bucket's
boundary. Inside a bucket of length b a batch holds ``TOKEN_BUDGET // b``
segments, so only the last batch of a bucket can be part-filled.

Places in a bucket need no single sorted pass: rows are dealt by a hash into
shards of about ``SHARD_ROWS``, numbered inside each (bucket, shard), and offset
by the counts of the earlier shards.

Defined cases: a null or empty text has no tokens and one row with segment 0,
no bucket and no batch; repeated rows each get their own places; an empty table
gives an empty result; with fewer distinct lengths than buckets every length is
a bucket and padding is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from adlife.llm.common import materialized, ship_package
from adlife.llm.token_planes import token_counter

MAX_LENGTH = 2048
BUCKETS = 16
TOKEN_BUDGET = 1 << 16
SHARD_ROWS = 20_000


def token_counts(docs: DataFrame, tokenizer_file: str, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table (id, n_tokens) of every whole text, counted with a public tokenizer."""
    ship_package(docs.sparkSession)
    out = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = token_counter(tokenizer_file)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                counts = counter.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(counts, pa.int64())], schema=out)

    rows = docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text_col}`"))
    return materialized(rows.mapInArrow(run, from_arrow_schema(out)), "token-counts")


def segments(lengths: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """(id, segment, start, n_tokens) from (id, n_tokens); a text without tokens keeps one row."""
    last = F.greatest(F.ceil(F.col("n_tokens") / max_length) - 1, F.lit(0))
    cut = lengths.select("id", F.col("n_tokens").alias("all"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("segment"))
    start = F.col("segment") * max_length
    return cut.select("id", "segment", start.alias("start"), F.least(F.col("all") - start, F.lit(max_length)).alias("n_tokens"))


def best_boundaries(histogram: dict[int, int], buckets: int = BUCKETS) -> tuple[list[int], int]:
    """(ascending boundaries, total padding): the least padding with at most ``buckets`` boundaries."""
    lengths = np.array(sorted(histogram), dtype=np.int64)
    if not len(lengths):
        return [], 0
    counts = np.array([histogram[x] for x in lengths.tolist()], dtype=np.int64)
    rows = np.concatenate(([0], np.cumsum(counts)))
    n, k = len(lengths), min(buckets, len(lengths))
    cost = lengths * rows[1:]                       # one bucket up to and with length j: padded tokens
    ways = [np.zeros(n, np.int64)]
    for _ in range(1, k):
        # bucket (i, j] after the best split of the first i + 1 lengths
        new, way = cost.copy(), np.full(n, -1)
        for j in range(1, n):
            options = cost[:j] + lengths[j] * (rows[j + 1] - rows[1:j + 1])
            i = int(options.argmin())
            if options[i] < new[j]:
                new[j], way[j] = options[i], i
        cost = new
        ways.append(way)
    out, j = [], n - 1
    for way in reversed(ways[1:]):
        out.append(int(lengths[j]))
        if way[j] < 0:
            # no further split helps: fewer buckets are as good
            j = -1
            break
        j = int(way[j])
    if j >= 0:
        out.append(int(lengths[j]))
    return out[::-1], int(cost[-1] - (lengths * counts).sum())


def pack(lengths: DataFrame, max_length: int = MAX_LENGTH, buckets: int = BUCKETS,
         token_budget: int = TOKEN_BUDGET, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(id, segment, start, n_tokens, bucket_length, batch, slot) from (id, n_tokens)."""
    cut = segments(lengths, max_length)
    histogram = {r["n_tokens"]: r["n"] for r in cut.where("n_tokens > 0").groupBy("n_tokens").agg(
        F.count(F.lit(1)).alias("n")).collect()}            # at most max_length rows
    bounds, _ = best_boundaries(histogram, buckets)
    shards = max(1, -(-sum(histogram.values()) // shard_rows))
    bucket = F.lit(None).cast("long")
    for b in reversed(bounds):
        bucket = F.when(F.col("n_tokens") <= b, F.lit(b).cast("long")).otherwise(bucket)
    cut = cut.withColumn("bucket_length", F.when(F.col("n_tokens") > 0, bucket)).withColumn(
        "shard", F.pmod(F.xxhash64("id", "segment"), F.lit(shards)))
    full, none = cut.where("n_tokens > 0"), cut.where("n_tokens = 0")
    earlier = Window.partitionBy("bucket_length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = full.groupBy("bucket_length", "shard").agg(F.count(F.lit(1)).alias("n")).select(
        "bucket_length", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket_length", "shard").orderBy("id", "segment", "n_tokens")
    place = F.col("before") + F.row_number().over(inside) - 1
    room = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.col("bucket_length")))
    placed = full.join(offsets, ["bucket_length", "shard"]).withColumn("place", place).select(
        "id", "segment", "start", "n_tokens", "bucket_length", F.floor(F.col("place") / room).alias("batch"),
        F.pmod(F.col("place"), room).alias("slot"))
    empty = F.lit(None).cast("long")
    return placed.unionByName(none.select("id", "segment", "start", "n_tokens", "bucket_length",
                                          empty.alias("batch"), empty.alias("slot")))


def packing_query(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    return pack(token_counts(docs, tokenizer_file)).withColumnRenamed("id", "doc_id")
