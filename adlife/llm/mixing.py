"""Mixing domains to target weights, with soft membership.

1. A softmax classifier is trained on a bounded sample of a labelled table
   (``PER_DOMAIN`` rows a domain, chosen by a hash; hashed byte-pair
   frequencies). Each document gets posteriors: the mean over its pieces of
   ``PIECE`` bytes, so a text in two languages belongs to both in part.
2. Nonnegative rates r of the documents (expected copies) are fitted by least
   squares: minimise sum over domains of (S_k - T_k)^2 / T_k, where
   S_k = sum of rate * tokens * posterior_k and T_k is the target token total,
   by projected gradient steps from r = 1. In the metric of the tokens the gradient at
   a document is the product of its posterior with a vector of the domains, so a
   step is r = clip(r + p . d, low, high) with one d for all documents, and a rate
   is computed where its document is by going through the steps: rates are never stored.
   A step needs the S_k only, one aggregation of the written posterior table; it tries
   ``len(TRIES)`` lengths along the gradient and along the gradient scaled by the inverse
   Gram matrix of the rows that are not held at a bound, and takes the best. Steps go on until every
   S_k is within ``CLOSE`` of its target, or until steps no longer lower the sum:
   then the bounds and posteriors do not allow the targets, ``Rates.met`` is False and
   a warning names the domains.

Tokens are runs of non-blank characters. ``copies`` realises the rate: its
integer part, plus one with the probability of its fraction by a hash of the id.

Defined cases: a null or empty text has 0 tokens and equal posteriors; without
labelled rows the posteriors are equal; a target domain without documents stays
short of its target; an empty table gives an empty result; equal rows get equal
rates; extra columns pass through :func:`apply_rates`.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

from adlife.llm.common import fresh, give_back, materialized, ship_package, worker_cache
from adlife.llm.langid import crc, sample_counts

PAIRS = 1 << 10
PIECE = 1 << 10
PER_DOMAIN = 1500
#: Largest miss of a domain's target, as a share of the target.
CLOSE = 1e-5
#: Step lengths tried in one pass, as multiples of the safe one; damping of the Gram matrix.
TRIES, RIDGE = (64.0, 16.0, 4.0, 2.0, 1.0, 0.5, 0.25, 1 / 16, 1 / 64, 1 / 1024), 1e-10
#: Share of tokens beyond the least total.
SLACK = 0.02
#: Steps in a row that lower the sum by less than this share end the fit.
IDLE_STEPS, GAIN = 4, 0.02


@dataclass
class Classifier:
    domains: list[str]
    weights: np.ndarray           # (PAIRS + 1, domains)


@dataclass
class Rates:
    low: float = 0.0
    high: float = 1e9
    steps: np.ndarray | None = None   # (steps, domains)
    met: bool = True

    def of(self, p: np.ndarray) -> np.ndarray:
        """The rates of documents with posteriors ``p``: the projected steps from 1."""
        r = np.clip(np.ones(len(p)), self.low, self.high)
        for d in self.steps if self.steps is not None else ():
            r = np.clip(r + p @ d, self.low, self.high)
        return r


def _pairs(data: np.ndarray) -> np.ndarray:
    b = data.astype(np.int64)
    return (b[:-1] * 167 + b[1:]) % PAIRS


def pair_counts(text: str) -> np.ndarray:
    return np.bincount(_pairs(np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)), minlength=PAIRS)


def _design(counts: np.ndarray) -> np.ndarray:
    """Square roots of frequencies (length-one rows) and a constant."""
    x = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))
    return np.hstack([x, np.ones((len(x), 1))])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_classifier(labels: list, counts: np.ndarray, domains: list[str], penalty: float = 1e-4, steps: int = 150) -> Classifier:
    """Softmax regression with a ridge penalty, by accelerated gradient steps."""
    w = v = np.zeros((PAIRS + 1, len(domains)))
    if labels:
        x = _design(counts)
        y = np.array(labels)[:, None] == np.array(domains)[None, :]
        for k in range(steps):
            g = x.T @ (_softmax(x @ v) - y) / len(x) + penalty * v
            u = v - g
            w, v = u, u + k / (k + 3) * (u - w)
    return Classifier(domains, w)


def memberships(model: Classifier, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, posteriors) of each text; posteriors are means over pieces, by their share of bytes."""
    tokens = np.zeros(len(texts), np.int64)
    p = np.full((len(texts), len(model.domains)), 1 / max(len(model.domains), 1))
    for i, text in enumerate(texts):
        data = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8)
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        tokens[i] = int((~blank & np.concatenate(([True], blank[:-1]))).sum()) if len(data) else 0
        total = np.zeros(len(model.domains))
        for at in range(0, len(data) - 1, PIECE * 256):                    # bounded slices of long texts
            pair = _pairs(data[at:at + PIECE * 256 + 1])
            n = -(-len(pair) // PIECE)
            counts = np.bincount(np.arange(len(pair)) // PIECE * PAIRS + pair, minlength=n * PAIRS).reshape(n, PAIRS)
            total += counts.sum(axis=1) @ _softmax(_design(counts) @ model.weights)
        if total.sum() > 0:
            p[i] = total / total.sum()
    return tokens, p


def membership_table(docs: DataFrame, model: Classifier, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Written table (id, tokens, p) of every whole text."""
    ship_package(docs.sparkSession)
    out = pa.schema([("id", pa.int64()), ("tokens", pa.int64()), ("p", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("mixing")
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                tokens, p = memberships(model, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(tokens),
                                                  pa.array(list(p), pa.list_(pa.float64()))], schema=out)

    rows = docs.select(F.col(f"`{key}`").cast("long"), F.col(f"`{text_col}`"))
    return materialized(rows.mapInArrow(run, from_arrow_schema(out)), "memberships")


def _posteriors(column: pa.Array, domains: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, domains)


def sums_of(p: np.ndarray, t: np.ndarray, rates: Rates, tries: np.ndarray) -> np.ndarray:
    """Per try of a next step: sums of rate * tokens * p_k, and of tokens * p_k * p_l over rows that it does not
    press against a bound."""
    out, now = [], rates.of(p)
    for d in tries:
        u = p @ d
        r = np.clip(now + u, rates.low, rates.high)
        free = t * ~(((r <= rates.low) & (u < 0)) | ((r >= rates.high) & (u > 0)))
        out.append(np.concatenate(((r * t) @ p, ((p * free[:, None]).T @ p).reshape(-1))))
    return np.stack(out)


def domain_sums(table: DataFrame, rates: Rates, tries: np.ndarray) -> np.ndarray:
    """:func:`sums_of` the whole table. Each task sends one array."""
    k, domains = tries.shape
    size = k * (domains + domains * domains)
    out = pa.schema([("at", pa.int32()), ("x", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("mixing")
        x = np.zeros(size)
        for batch in batches:
            t = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
            x += sums_of(_posteriors(batch.column(1), domains), t, rates, tries).reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(x)], schema=out)

    sums = np.zeros(size)
    rows = table.select("tokens", "p").mapInArrow(run, from_arrow_schema(out)).groupBy("at").agg(F.sum("x").alias("x"))
    for r in rows.collect():                               # tries x (domains + domains^2) numbers
        sums[r["at"]] = r["x"]
    return sums.reshape(k, -1)


def solve(sums, target: np.ndarray, rates: Rates) -> tuple[Rates, np.ndarray]:
    """The fitted rates and their S, given ``sums(rates, rows of next steps)`` as of :func:`sums_of`."""
    k = len(target)
    steps, idle = [], 0
    now = sums(rates, np.zeros((1, k)))[0]
    scale = 1 / np.sqrt(target)
    while True:
        miss = now[:k] - target
        if (np.abs(miss) <= CLOSE * target).all():
            return replace(rates, met=True), now[:k]
        if idle >= IDLE_STEPS:
            return replace(rates, met=False), now[:k]
        gram = now[k:].reshape(k, k) * scale[:, None] * scale[None, :]
        g = miss * scale
        safe = 1 / max(float(np.linalg.eigvalsh(gram).max()), 1e-300)      # no longer step is needed without bounds
        damp = [RIDGE, 1e-3]
        directions = [safe * g, *[np.linalg.solve(gram + x * np.trace(gram) * np.eye(k) / k + 1e-300 * np.eye(k), g) for x in damp]]
        tries = [-scale * d * length for d in directions for length in TRIES]
        if steps:                                          # momentum: the last step again, alone and behind a safe step
            tries += [steps[-1] * length - scale * d for length in (0.5, 0.9, 2.0, 8.0) for d in (0.0, *directions)]
        tries = np.stack(tries)
        tries = tries[np.isfinite(tries).all(axis=1)]
        got = sums(rates, tries)
        values = (((got[:, :k] - target) * scale) ** 2).sum(axis=1)
        best, before = int(np.argmin(values)), float((g ** 2).sum())
        idle = idle + 1 if not values[best] < (1 - GAIN) * before else 0
        if values[best] >= before:
            return replace(rates, met=False), now[:k]
        steps.append(tries[best])
        rates, now = replace(rates, steps=np.stack(steps)), got[best]


def fit_rates(table: DataFrame, domains: list[str], weights: Mapping[str, float], total: float | None = None,
              low: float = 0.0, high: float = 1e9) -> tuple[Rates, dict]:
    """Rates whose expected token totals match ``weights``; ``total`` tokens in all.

    ``total`` None: the least total at which no domain has to shrink, and ``SLACK`` more, as a document that
    belongs to a scarce domain in part adds to the others too. Returns
    the rates and a report (domain -> tokens before, target, expected).
    """
    share = np.array([max(float(weights.get(d, 0.0)), 1e-9) for d in domains])
    share = share / share.sum()
    rates, k = Rates(low=low, high=high), len(domains)
    have = domain_sums(table, Rates(), np.zeros((1, k)))[0][:k]
    if have.sum() <= 0:
        return rates, {}
    target = share * ((1 + SLACK) * float((have / share)[share > 1e-6].max()) if total is None else float(total))
    rates, got = solve(lambda now, tries: domain_sums(table, now, tries), target, rates)
    report = {d: (float(a), float(b), float(c)) for d, a, b, c in zip(domains, have, target, got)}
    if not rates.met:
        short = {d: f"{c:.0f} of {b:.0f}" for d, (_, b, c) in report.items() if abs(c - b) > CLOSE * b}
        warnings.warn(f"mixing targets cannot be met, tokens expected: {short}", stacklevel=2)
    return rates, report


def _copies(rate, ident):
    u = F.pmod(F.xxhash64(F.lit("copies"), ident), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def rated(table: DataFrame, domains: list[str], rates: Rates) -> DataFrame:
    """``table`` plus ``rate`` and ``copies``."""
    schema = StructType([*table.schema.fields, *StructType.fromDDL("rate double").fields])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("mixing")
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates.of(_posteriors(
                batch.column(2), len(domains))))], schema=out)

    return table.mapInArrow(run, schema).withColumn("copies", _copies(F.col("rate"), F.col("id")))


def apply_rates(docs: DataFrame, model: Classifier, rates: Rates, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each row repeated ``copies`` times; memberships are computed where the row is.

    A text without tokens moves no target and gets the rate nearest to 1.
    """
    ship_package(docs.sparkSession)
    name = fresh("rate", docs.columns)
    schema = StructType([*docs.schema.fields, *StructType.fromDDL(f"{name} double").fields])
    out, text_at = to_arrow_schema(schema), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("mixing")
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                tokens, p = memberships(model, part.column(text_at).to_pylist())
                rate = np.where(tokens > 0, rates.of(p), rates.of(np.zeros_like(p)))
                cols = [c.cast(out.field(i).type) for i, c in enumerate(part.columns)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(rate)], schema=out)

    copies = F.explode(F.array_repeat(F.lit(0), _copies(F.col(name), F.col(f"`{key}`"))))
    rows = docs.mapInArrow(run, schema)
    return rows.withColumn(fresh("copy", rows.columns), copies).select(*[F.col(f"`{c}`") for c in docs.columns])


def trained(labelled: DataFrame, domains: list[str], key: str = "doc_id", label: str = "lang", text_col: str = "text") -> Classifier:
    """The classifier of a labelled table, for the given domains."""
    known = labelled.where(F.col(label).isin(domains))
    pick = F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30))
    model = fit_classifier(*sample_counts(known, label, text_col, PER_DOMAIN, pick, pair_counts, PAIRS), domains)
    give_back()
    return model


#: Target shares of tokens by domain (here the language).
WEIGHTS = {"de": 0.2, "en": 0.4, "es": 0.2, "fr": 0.2}


def mixing_query(docs: DataFrame) -> DataFrame:
    domains = sorted(WEIGHTS)
    model = trained(docs.select("doc_id", "text", "lang").where(crc("doc_id") % 5 != 0), domains)
    table = membership_table(docs, model)
    tokens = table.agg(F.sum("tokens")).first()[0] or 0
    rates, _ = fit_rates(table, domains, WEIGHTS, total=float(tokens))
    done = rated(table, domains, rates)
    return done.select(F.col("id").alias("doc_id"), F.col("tokens").alias("n_tokens"),
                       *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(domains)], "rate", "copies")
