"""One query per operator over the whole of its table, with production parameters."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstats.llm import (
    archive,
    decontamination,
    language,
    near_duplicates,
    negatives,
    packing,
    quality_model,
    quality_rules,
    quotations,
    spelling,
    substrings,
    token_files,
    toxicity,
)
from tripstats.llm.common import fold, stored, table
from tripstats.workspace import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

QUALITY_FOLDS = 5
LANGUAGE_FOLDS = 4
KEEP_SCORE = 0.3


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_decontamination(spark, folder):
    """Every document that holds a benchmark item, with the item and the share it holds."""
    return decontamination.leaks(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


@query
def op2_quality_rules(spark, folder):
    """Counts, ratios and the verdict of the threshold table for every document."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    judged = quality_rules.judge(documents)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    base_failed = (F.col("n_words") < 20) | (
        100 * F.col("n_repeat_words") > 30 * F.col("n_words")
    )
    return judged.select(
        "doc_id",
        *counts,
        "n_stop_words",
        "n_marks",
        "n_lines",
        base_failed.alias("base_failed"),
        (~base_failed & F.col("kept")).alias("kept"),
    )


@query
def op3_quality_classifier(spark, folder):
    """Quality score of every document, learned from the folds that are not held out."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = fold("doc_id", QUALITY_FOLDS) == 0
    model = quality_model.fit(documents.where(~held_out), table(spark, folder, "labels"))
    scored = quality_model.score(documents, model)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"),
    )


@query
def op4_quotation_linking(spark, folder):
    """Every message without its quotes, linked to what it answers."""
    return quotations.link_quotes(table(spark, folder, "conversations"))


@query
def op5_token_files(spark, folder):
    """Ids of every document written to files and read back."""
    path = scratch_path(spark, "token-files")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_files(table(spark, folder, "documents"), path, tokenizer)
    return token_files.read_files(spark, path)


@query
def op6_packing(spark, folder):
    """Every piece of every document with its sequence and offset."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, folder, "documents"), tokenizer)


@query
def op7_near_duplicates(spark, folder):
    """Every document with the component of its near copies."""
    settings = near_duplicates.Settings(words=3, percent=85)
    return near_duplicates.near_duplicates(table(spark, folder, "documents"), settings)


@query
def op8_archive(spark, folder):
    """Every page written to an archive, from there to WARC files, and read back from these."""
    path = scratch_path(spark, "archive")
    archive.write_archive(table(spark, folder, "pages"), path)
    archive.export_warc(spark, path, f"{path}/warc")
    # Read once, and stored without the payloads.
    records = stored(archive.read_warc(spark, f"{path}/warc", with_payload=False), "warc-records")
    return archive.full_payloads(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op9_toxicity(spark, folder):
    """Expected severity of every document."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, table(spark, folder, "labels"))
    graded = toxicity.grade(documents, model)
    return graded.select(
        "doc_id", "severity", "grade", "toxic", (~F.col("toxic")).alias("kept")
    )


@query
def op10_language_compression(spark, folder):
    """Language of every document, learned from the folds that are not held out."""
    documents = table(spark, folder, "documents")
    held_out = fold("doc_id", LANGUAGE_FOLDS) == 2
    model = language.fit(documents.where(~held_out))
    predicted = language.predict(documents.select("doc_id", "text"), model)
    return predicted.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected"
    )


@query
def op11_hard_negatives(spark, folder):
    """The hardest negatives of the positives of every hundredth vector."""
    vectors = table(spark, folder, "embeddings")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(
        vectors.withColumn("label", changed), is_anchor=F.col("vec_id") % 100 == 0
    )


@query
def op12_substring_dedup(spark, folder):
    """Every document without the passages of 35 words that start anywhere else."""
    cut = substrings.remove_repeats(table(spark, folder, "documents"), length=35)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op13_spelling_variants(spark, folder):
    """Every word with its form and root."""
    found = spelling.variants(table(spark, folder, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
