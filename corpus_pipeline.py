"""Stages of corpus cleaning, each an operator of ``outcomelab.llm``.

Every stage takes what its predecessor kept.  All but the last return the columns of
``documents``; the last returns the manifest of the mix, one row per document kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelab.llm import catalog, fm_index, minhash, mixing, secrets, toxicity
from outcomelab.llm.tables import held, table


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a change of texts."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def _apart(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but ``used`` under names no operator has, and the way back."""
    names = {c: c if c in used else f"__own_{k}" for k, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), \
        lambda df: df.select(*[F.col(n).alias(c) for c, n in names.items()])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score ``toxicity.THRESHOLD`` or more go."""
    labels = table(spark, sf_dir, "labels").where(~catalog.held_out())
    plain, back = _apart(docs, "doc_id", "text")
    scored = toxicity.score(plain, toxicity.fit(plain, labels), out="toxicity")
    return back(scored.where(F.col("toxicity") < toxicity.THRESHOLD))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that share four fifths of their shingles, the one with the smallest id stays.

    Documents are told apart by id and text: unrelated texts with one id all stay.
    """
    found = held(minhash.near_duplicates(docs, num=8, den=10), "components")
    return minhash.keep_one(docs, found)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document goes if no word of it is left."""
    plain, back = _apart(docs, "doc_id", "text")
    found = fm_index.contaminated_spans(plain, table(spark, sf_dir, "benchmark"))
    left = F.col("n_words") > F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["first"])
    kept = found.where((F.size("spans") == 0) | left)
    return _sized(back(fm_index.without_spans(kept)))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Credentials are replaced; copied examples get a mark of their own."""
    return _sized(secrets.redact_secrets(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document."""
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", cut_benchmark),
    ("secrets", redact_secrets),
    ("mixing", mix),
]

#: Model training, iterated graph steps and the knapsack have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = held(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
