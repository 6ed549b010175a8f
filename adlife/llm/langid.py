"""Language identification: nearest of several TF-IDF centroids per language, by cosine.

A text becomes a vector of hashed character n-grams (two and three characters
of the lower-cased text, blanks for anything but letters): 1 + log of the
count, times the inverse document frequency, scaled to length one. Per language
a few centroids are clustered (spherical k-means); the prediction is the
language of the nearest centroid. ``score`` is the cosine to that centroid
(n-gram vectors are never negative, so it lies between 0 and 1). A text is
*rejected* when it has no letter, or its distance to the nearest centroid is
larger than that centroid's bound for the text's number of distinct n-grams,
learned from the training texts' distances plus a margin.

The model is fitted on a bounded, hash-chosen sample of the labelled rows
(``PER_LANGUAGE`` a language); vectors are made on the executors and only they
are collected. Prediction covers every whole text, in slices of bounded size.

Defined cases: a null text, or one without a letter: ``und``, score 0, rejected;
no labelled rows: every text is ``und``; equal texts get equal answers; ties go
to the first language in sorted order; extra columns pass through
:func:`identify`, and a clashing output name is prefixed with ``_``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from adlife.llm.common import fresh, give_back, ship_package, worker_cache

DIMS = 1 << 12
SLICE = 1 << 20
PER_LANGUAGE = 1500
CENTROIDS = 3
#: Rows that are weighted at a time.
UNIT_ROWS = 256
ROUNDS = 12
#: Texts are put into classes by the logarithm of their distinct n-grams; a class's bound
#: is its largest training distance plus this share of the way to distance 1.
MARGIN = 0.5
SIZES = 8
#: A class with fewer training texts takes the bound of all training texts; from fewer in all no bound can be learned,
#: and then only texts without letters are rejected.
BOUND_ROWS = 30
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]          # of each centroid
    centroids: np.ndarray         # (k, DIMS), rows of length one
    idf: np.ndarray               # (DIMS,)
    bounds: np.ndarray            # (SIZES,) largest accepted distance by size class


def grams(text: str) -> np.ndarray:
    """Counts of the hashed n-grams of a text; all 0 without letters."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    kinds, where = np.unique(code, return_inverse=True)
    letter = np.array([chr(c).isalpha() if c < 0xD800 or c > 0xDFFF else False for c in kinds.tolist()], bool)
    code = np.where(letter[where], code, 32) if len(code) else code
    if not (code != 32).any():
        return np.zeros(DIMS, np.float32)
    code = np.concatenate(([32], code, [32]))
    code = code[np.concatenate(([True], (code[1:] != 32) | (code[:-1] != 32)))]
    out = np.zeros(DIMS, np.int64)
    for at in range(0, len(code) - 1, SLICE):              # bounded work space for long texts
        part = code[at:at + SLICE + 2].astype(np.uint64)
        two = part[:-1][:SLICE] * np.uint64(0x1F35B9) + part[1:][:SLICE]
        three = two[:len(part) - 2] * np.uint64(0x1F35B9) + part[2:] + np.uint64(1)
        h = np.concatenate((two, three)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(52)
        out += np.bincount(h.astype(np.int64), minlength=DIMS)
    return out.astype(np.float32)


def count_rows(texts: list[str | None]) -> np.ndarray:
    return np.stack([grams(t or "") for t in texts])


def unit_rows(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = np.zeros(counts.shape, np.result_type(counts, idf))
    for at in range(0, len(counts), UNIT_ROWS):             # bounded work space besides the result
        part = counts[at:at + UNIT_ROWS]
        v = np.where(part > 0, 1 + np.log(np.maximum(part, 1)), 0) * idf
        out[at:at + UNIT_ROWS] = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    return out


def size_class(counts: np.ndarray) -> np.ndarray:
    """0 for up to 16 distinct n-grams, one more for each doubling."""
    return np.clip(np.log2(np.maximum((counts > 0).sum(axis=1), 1)).astype(int) - 3, 0, SIZES - 1)


def cluster(v: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means; starts from rows spread along the distance to the mean."""
    k = min(k, len(v))
    mean = v.mean(axis=0)
    order = np.argsort(v @ mean, kind="stable")
    c = v[order[np.linspace(0, len(v) - 1, 2 * k + 1).astype(int)[1::2]]]
    for _ in range(rounds):
        own = np.argmax(v @ c.T, axis=1)
        sums = np.stack([v[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c


def sample_counts(docs: DataFrame, label: str, text_col: str, per_label: int, pick: Column,
                  count: Callable[[str], np.ndarray] = grams, dims: int = DIMS) -> tuple[list, np.ndarray]:
    """(labels, feature counts) of about ``per_label`` rows a label, chosen by the hash ``pick`` (0 to 2**30)."""
    ship_package(docs.sparkSession)
    known = docs.where(F.col(label).isNotNull() & F.col(text_col).isNotNull())
    n = {r[label]: r["n"] for r in known.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n:
        return [], np.zeros((0, dims), np.float32)
    share = F.lit(0)
    for name, rows in n.items():
        share = F.when(F.col(label) == name, F.lit(int((1 << 30) * min(1.0, per_label / rows)))).otherwise(share)
    schema = StructType.fromDDL("label string, at array<int>, n array<int>")
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("langid")
        for batch in batches:
            rows = [np.asarray(count(t)) for t in batch.column(1).to_pylist()]
            at = [np.flatnonzero(r) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.list_(pa.int32())), pa.array(
                [r[i].astype(np.int32) for r, i in zip(rows, at)], pa.list_(pa.int32()))], schema=out)

    got = known.where(pick < share).select(F.col(label).cast("string"), text_col).mapInArrow(run, schema).toArrow()
    got = got.combine_chunks()

    def rows_of(name: str) -> list[np.ndarray]:
        if not got.num_rows:
            return []
        lists = got.column(name).chunk(0)
        ends = lists.offsets.to_numpy()
        return np.split(lists.values.to_numpy(), ends[1:-1]) if ends[0] == 0 else [lists[i].values.to_numpy() for i in range(len(lists))]

    rows = [r for r in zip(got.column("label").to_pylist(), rows_of("at"), rows_of("n")) if len(r[1])]
    rows.sort(key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes()))            # the same model whatever order rows come in
    counts = np.zeros((len(rows), dims), np.float32)
    for i, (_, at, n) in enumerate(rows):
        counts[i, at] = n
    return [r[0] for r in rows], counts


def fit(labels: list, counts: np.ndarray) -> Model | None:
    if not labels:
        return None
    idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    names = np.array(labels)
    languages, centroids = [], []
    for name in sorted(set(labels)):
        c = cluster(unit_rows(counts[names == name], idf), CENTROIDS)       # the rows of one language at a time
        languages += [name] * len(c)
        centroids.append(c)
    centroids = np.concatenate(centroids).astype(np.float32)
    far, sizes = np.concatenate([1 - (unit_rows(counts[at:at + UNIT_ROWS], idf) @ centroids.T).max(axis=1)
                                 for at in range(0, len(counts), UNIT_ROWS)]), size_class(counts)
    every = far.max() if len(far) >= BOUND_ROWS else 1.0
    most = np.array([far[sizes == s].max() if (sizes == s).sum() >= BOUND_ROWS else every for s in range(SIZES)])
    return Model(languages, centroids, idf, most + MARGIN * (1 - most))


def predict(model: Model | None, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, rejected) of each text."""
    counts = count_rows(texts)
    none = counts.sum(axis=1) == 0
    if model is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    cos = unit_rows(counts, model.idf) @ model.centroids.T
    best = cos.argmax(axis=1)
    score = np.where(none, 0.0, np.clip(cos[np.arange(len(best)), best].astype(float), 0, 1))
    names = [UNKNOWN if e else model.languages[b] for e, b in zip(none, best)]
    return names, score, none | (1 - score > model.bounds[size_class(counts)])


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` plus ``lang_pred``, ``score`` and ``rejected``."""
    ship_package(docs.sparkSession)
    names = docs.columns
    lang = fresh("lang_pred", names)
    score = fresh("score", [*names, lang])
    rejected = fresh("rejected", [*names, lang, score])
    keep = [i for i, c in enumerate(names) if keep_text or c != text_col]
    added = StructType.fromDDL("lang_pred string, score double, rejected boolean")
    schema = StructType([*[docs.schema.fields[i] for i in keep],
                         *[StructField(n, f.dataType) for n, f in zip((lang, score, rejected), added)]])
    out, text_at = to_arrow_schema(schema), names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("langid")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = predict(model, part.column(text_at).to_pylist())
                cols = [part.column(i).cast(out.field(j).type) for j, i in enumerate(keep)]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(found[0]), pa.array(found[1]), pa.array(found[2])], schema=out)

    return docs.mapInArrow(run, schema)


def crc(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def learned(docs: DataFrame) -> Model | None:
    """The model of the ``lang`` labels, without the held-out fifth of the ids."""
    train = docs.select("doc_id", "text", "lang").where(crc("doc_id") % 5 != 0)
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    model = fit(*sample_counts(train, "lang", "text", PER_LANGUAGE, pick))
    give_back()                                             # the driver goes on for long
    return model


def langid_query(docs: DataFrame) -> DataFrame:
    held = F.coalesce(crc("doc_id") % 5 == 0, F.lit(False)).alias("held_out")
    return identify(docs.select("doc_id", held, "text"), learned(docs), keep_text=False)
