"""The corpus pipeline: five stages over ``documents``, each calling one operator of :mod:`adlife.llm`.

language ID -> MinHash near-dedup -> substring dedup -> mixing -> packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``; all but the last
return the columns of ``documents`` (extra columns pass through). ``n_chars`` is
kept equal to the length of the text it belongs to.

Defined cases: a null or empty text has no language and is rejected by the first
stage; rows that share an id, or have none, are told apart by their texts in the second; an
empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlife.llm import bagminhash, langid, mixing, packing, queries, unit_dedup
from adlife.llm.common import documents, materialized, scratch_path, scratch_scope

#: Target shares of tokens by language in the mixture.
WEIGHTS = {"de": 0.18, "en": 0.52, "es": 0.12, "fr": 0.18}


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that language identification rejects (no letter, or far from every centroid)."""
    found = langid.identify(docs, langid.learned(docs))
    rejected = found.columns[-1]
    return found.where(~F.col(f"`{rejected}`")).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of every class of near duplicates, that of the least id; a repeated row once."""
    return bagminhash.one_per_class(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that an earlier document has; documents of which nothing is left go."""
    done = unit_dedup.remove_repeats(docs)
    removed = F.col(f"`{done.columns[-2]}`")
    done = done.where((F.size(removed) == 0) | (F.length(F.trim("text")) > 0))
    return done.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`")
                         for c in docs.columns])


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that language shares meet ``WEIGHTS``; the total is the least that drops none."""
    domains = sorted(WEIGHTS)
    model = mixing.trained(docs, domains)
    table = mixing.membership_table(docs, model)
    rates, _ = mixing.fit_rates(table, domains, WEIGHTS, low=1.0)
    return mixing.apply_rates(docs, model, rates)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per segment with its bucket, batch and slot."""
    return packing.packing_query(docs, queries.tokenizer_file())


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("mixing sources to target weights", mix_domains),
    ("packing", pack_batches),
]

#: Clustering, hashing and numeric fitting have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        out = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        with scratch_scope(spark):                   # a stage's own tables go when its result is written
            docs = materialized(stage(spark, docs, sf_dir), name, out)
    return STAGES[-1][1](spark, docs, sf_dir)
