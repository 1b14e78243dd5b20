"""Registered queries of this subpackage, one per operator, and their SQL.

Each query applies its operator with production parameters to the whole
table and returns the columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstats.llm import alignment, decontam, lm, mixing, negatives, oracle, pii, secrets, simhash, spotsigs, suffixes, tokens, toxicity, urls
from trendstats.llm.common import read_table, spare


def _counts(spans: Column, kinds: tuple[str, ...]) -> list[Column]:
    """``n_<kind>`` columns of an array of numbered spans."""
    numbers = F.transform(spans, lambda x: x["k"])
    return [
        (F.size(numbers) - F.size(F.array_remove(numbers, k))).cast("long").alias(f"n_{kind}")
        for k, kind in enumerate(kinds)
    ]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    into = spare(docs, "__pii")
    found = pii.find(docs, into, pii.fit(docs))
    spans = F.col(into)["base"]
    counts = _counts(spans, pii.KINDS)
    return found.select(
        "doc_id", *counts, F.sha2(pii.listed(spans), 256).alias("base_sha256"),
        pii.listed(F.col(into)["spans"]).alias("spans"),
    )


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm.score(read_table(spark, sf_dir, "documents"), leave_out=True)
    mean = F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words"))
    return found.select(
        "doc_id", "n_words", "n_seen", F.round("score", 3).alias("score"), F.round(mean, 3).alias("score_per_word")
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    into = spare(docs, "__hits")
    found = decontam.annotate(docs, read_table(spark, sf_dir, "benchmark"), into)
    hits = decontam.n_hit(F.col(into))
    return found.select(
        "doc_id",
        F.col(into)["n_words"].alias("n_words"),
        hits.alias("n_hit"),
        F.size(F.col(into)["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.col(into)["items"], ","), 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokens.token_counts(read_table(spark, sf_dir, "documents"), tokens.read_ranks())
    return found.select("doc_id", "n_tokens")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    into = spare(docs, "__secrets")
    found = secrets.find(docs, into)
    spans = F.col(into)["base"]
    return found.select(
        "doc_id", *_counts(spans, secrets.KINDS), F.sha2(secrets.listed(spans), 256).alias("base_sha256"),
        secrets.listed(F.col(into)["spans"]).alias("spans"),
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def quality_weight(labels: DataFrame) -> DataFrame:
    """``(doc_id, weight)``: 1.5 for documents labelled good, 0.5 for bad."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    return known.groupBy("doc_id").agg((F.avg("quality") + F.lit(0.5)).alias("weight"))


def mixed(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The mix of ``documents`` with quality weights from the labels."""
    weights = quality_weight(labels)
    name = spare(docs, "__weight")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    joined = sized.join(weights.withColumnRenamed("weight", name), "doc_id", "left")
    return mixing.mix(joined, size=F.col("size"), weight=F.coalesce(F.col(name), F.lit(1.0)))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixed(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return found.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", "source")


# The rules of the url query (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = urls.judge(read_table(spark, sf_dir, "pages"), urls.rules_table(spark, URL_RULES))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    into = spare(docs, "__score")
    found = toxicity.scored(docs, read_table(spark, sf_dir, "labels"), into)
    return found.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        F.col(into).alias("score"),
        (F.col(into) >= 0.5).cast("int").alias("predicted"),
    )


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spotsigs.with_next(read_table(spark, sf_dir, "documents"))
    pairs = pairs.withColumn("edited", spotsigs.edited(F.col("text"), F.col("next_text")))
    pairs = spotsigs.with_signatures(pairs, "edited_sigs", F.col("edited"))
    return pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        spotsigs.text_of(F.col("sigs")).alias("fingerprint"),
        spotsigs.text_of(F.col("edited_sigs")).alias("edited_fingerprint"),
        spotsigs.likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        spotsigs.likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = alignment.read_file(alignment.A_FILE), alignment.read_file(alignment.B_FILE)
    found, _ = alignment.align(read_table(spark, sf_dir, "documents"), a, b, digest=True)
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256")
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = [
        F.col("id").alias("doc_id"),
        F.col("n_bytes"),
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    ]
    return suffixes.without_repeats(read_table(spark, sf_dir, "documents"), derive=lambda found: found.select(*digest))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_lm_scores": op2_lm_scores,
    "op3_decontamination": op3_decontamination,
    "op4_token_counts": op4_token_counts,
    "op5_secrets": op5_secrets,
    "op6_simhash": op6_simhash,
    "op7_mix_sources": op7_mix_sources,
    "op8_url_filter": op8_url_filter,
    "op9_toxicity": op9_toxicity,
    "op10_spotsigs": op10_spotsigs,
    "op11_token_alignment": op11_token_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_suffix_dedup": op13_suffix_dedup,
}

# The others hold hashes, tokens or learned models, which SQL cannot express;
# they are tested against plain versions.
ORACLE: dict[str, str] = {
    "op2_lm_scores": oracle.LM_SCORES,
    "op3_decontamination": oracle.DECONTAMINATION,
    "op7_mix_sources": oracle.MIX,
    "op8_url_filter": oracle.url_filter(URL_RULES),
    "op12_hard_negatives": oracle.HARD_NEGATIVES,
}
