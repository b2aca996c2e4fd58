"""One registered query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (brown, langid, mixing, neardup, negatives, packing, pii, quality, runs, tokencount,
               urlfilter, warc, winnow)
from .common import table

SURROGATE_KEY = b"change this key"
MIX_LEVELS = ["domain", "lang", "source"]
# Target weights of the mix; anything else weighs 1 among its siblings.
DOMAIN_WEIGHTS = {"long": 0.6, "short": 0.4}
LANGUAGE_WEIGHTS = {"en": 0.4, "de": 0.25, "fr": 0.2, "es": 0.15}
LONG_TEXT = 2000


def op1_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, folder, "documents"), width=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, folder, "pages"))


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


def op4_class_model(spark: SparkSession, folder: str) -> DataFrame:
    return brown.score(table(spark, folder, "documents"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


def op6_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnow.fingerprints(table(spark, folder, "documents"))


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"),
                                  public_tokenizers.path("word_bpe_49k.json"))


def op8_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, SURROGATE_KEY, count="n_entities")


def weight(path: tuple) -> float:
    if len(path) == 1:
        return DOMAIN_WEIGHTS.get(path[0], 1.0)
    return LANGUAGE_WEIGHTS.get(path[1], 0.0 if path[1] is None else 1.0) if len(path) == 2 else 1.0


def with_domain(docs: DataFrame, name: str = "domain") -> DataFrame:
    """The table has no domain, so long and short texts stand for two."""
    return docs.withColumn(name, F.when(F.coalesce(F.length("text"), F.lit(0)) >= LONG_TEXT, "long")
                           .otherwise("short"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_domain(table(spark, folder, "documents"))
    return mixing.mix(docs, MIX_LEVELS, weight, 0.5, seed=9, epochs=2).select(
        "doc_id", *MIX_LEVELS, "epoch")


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, folder, "documents"),
                                   public_tokenizers.path("piece_bpe_32k.model"))


# (host, start of the path, verdict)
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


def op11_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.range(1).select(F.inline(F.array(*[F.struct(
        F.lit(host).alias("host"), F.lit(path).alias("path"), F.lit(verdict).alias("verdict"))
        for host, path, verdict in URL_RULES])))
    return urlfilter.judge(table(spark, folder, "pages"), rules)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: where crc32 of the id ends in 0, the words from ``a`` on
    repeat the ``p`` words that start there."""
    blanks, h = F.lit(" \t\n\x0b\x0c\r"), F.crc32(F.col("doc_id").cast("string"))
    trimmed = F.btrim("text", blanks)
    split = docs.select("doc_id", "text", F.when((h % 10 == 0) & (trimmed != ""), F.split(
        trimmed, "[\\x20\\x09-\\x0D]+")).alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words")
    dealt = split.select("doc_id", "text", "words", (F.col("g") % F.greatest(n, F.lit(1))).cast("int").alias("a"),
                         "g")
    dealt = dealt.select("doc_id", "text", "words", "a", (
        F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8))).cast("int").alias("p"))
    again = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("words", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return dealt.select("doc_id", F.when(F.col("words").isNull(), F.col("text")).otherwise(
        F.array_join(again, " ")).alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.periodic_runs(with_planted_runs(table(spark, folder, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = found.select("doc_id", "runs", "collapsed", longest.alias("best"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"),
        F.col("best.n").alias("length"), (-F.col("best.q")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.n") / -F.col("best.q")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.whole_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding", noisy)
    return negatives.mine(rows, rows.filter(F.col("vec_id") % 100 == 0))


QUERIES = {f.__name__: f for f in (
    op1_near_duplicates, op2_warc_round_trip, op3_language, op4_class_model, op5_quality_rules,
    op6_winnowing, op7_packing, op8_surrogates, op9_mixing, op10_token_counts,
    op11_url_rules, op12_periodic_runs, op13_hard_negatives)}
