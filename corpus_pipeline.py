"""A training corpus from ``documents``: stages of claimweave.llm, each written and read again.

Each stage takes (spark, docs, sf_dir) and returns documents; the last returns the documents that the
mix takes words from, with the words it takes as their text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm.decontaminate import decontaminate
from claimweave.llm.language_id import held_out, keep_identified, train
from claimweave.llm.mixing import Mix, spanned_text
from claimweave.llm.ngram_join import keep_first
from claimweave.llm.pii import pseudonymise
from claimweave.llm.tables import Scratch, table

#: Key of the pseudonyms; a real run takes its own from a secret store.
PII_KEY = "registered query"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; learned from the labelled ones outside the held-out fold."""
    model = train(docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()), "text", "lang", "doc_id")
    return keep_identified(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8, the smallest id."""
    return keep_first(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; ``n_chars`` follows the text."""
    return _measured(docs, decontaminate(docs, table(spark, sf_dir, "benchmark")))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in place of personal data."""
    return _measured(docs, pseudonymise(docs, PII_KEY).select(*docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix. ``text`` holds the words that are taken, each once; ``n_chars`` follows it.

    Documents that give nothing go. ``taken`` counts words with their repeats; ``spans`` are the ranges of
    words taken, counted in the document as it came (``size`` words).
    """
    kept = tuple(c for c in docs.columns if c not in ("doc_id", "source"))
    mixed = Mix(docs, keep=kept).taken(spans=True).where("taken > 0")
    text = spanned_text(F.col("kept_text"), F.col("spans"), F.col("size"))
    columns = [text.alias(c) if c == "text" else F.col(f"kept_{c}").alias(c) for c in kept]
    return _measured(docs, mixed.select("doc_id", *columns, "source", "size", "source_size", "target", "taken", "spans"))


def _measured(before: DataFrame, after: DataFrame) -> DataFrame:
    """``n_chars`` counted anew, where the documents have it."""
    if "n_chars" not in before.columns:
        return after
    kind = before.schema["n_chars"].dataType
    return after.select(*(F.coalesce(F.length("text"), F.lit(0)).cast(kind).alias(c) if c == "n_chars" else F.col(c) for c in after.columns))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", remove_benchmark),
    ("pii_pseudonyms", hide_personal_data),
    ("mixing", mix_sources),
]

#: Classifier, similarity join and keyed permutations have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "corpus-pipeline")
    for _, stage in STAGES[:-1]:
        docs = scratch.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
