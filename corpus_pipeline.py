"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run`
writes it as Parquet into shared storage and rereads it as the next stage's
``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import warnings

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronflow.llm import langid, mixing, neardup, packing, pii
from patronflow.llm.common import free_name, store, table
from patronflow.llm.oracle import ORACLE
from patronflow.llm.queries import QUERIES, SURROGATE_KEY, weight, with_domain

#: Setting that names the secret key of the surrogates.
KEY_SETTING = "spark.patronflow.surrogateKey"
#: Share of the tokens that the mix keeps at most.
MIX_SHARE = 0.9


def surrogate_key(spark: SparkSession) -> bytes:
    """The key of :data:`KEY_SETTING`. Without it the key of the tests is used, with a
    warning: anyone who has it can repeat the surrogates of a guessed entity."""
    key = spark.conf.get(KEY_SETTING, None)
    if key is None:
        warnings.warn(f"{KEY_SETTING} is not set: surrogates use the public test key", stacklevel=2)
        return SURROGATE_KEY
    return key.encode()


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the labelled languages go; a missing ``lang`` becomes the
    one found, so that the mix can weigh it."""
    return langid.keep_known(docs, key=[c for c in ("doc_id",) if c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five-word shingles,
    similarity 0.8)."""
    return neardup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by surrogates; ``n_chars``, where
    the table has it, follows the new text."""
    out = pii.pseudonymize(docs, surrogate_key(spark))
    if "n_chars" in out.columns:
        kind = out.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(kind)))
    return out


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Languages and sources approach their target weights; one epoch, so that
    no document is repeated."""
    domain = free_name(docs, "domain")
    out = mixing.mix(with_domain(docs, domain), [domain, "lang", "source"], weight, MIX_SHARE,
                     seed=9, epochs=1)
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their place in the sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language ID", language), ("MinHash near-dedup", near_duplicates), ("PII", personal_data),
          ("mixing sources to target weights", mixture), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir))
    return docs


# SQL can express neither the tokenizer nor the language model; the tests hold
# every stage against a brute-force version.
ORACLE_SQL = None

LLM_QUERIES = {**QUERIES, "pipeline": run}
LLM_ORACLE = dict(ORACLE)
