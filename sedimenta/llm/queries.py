"""A query per operator, over the given tables; the pipeline is in ``corpus_pipeline.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .ann import nearest
from .common import read_table
from .conversations import COUNTS, repair_report
from .decontaminate import contained_items
from .huffman import read_token_file, write_token_file
from .main_text import main_text
from .packing import packed
from .pii import KINDS, find_personal_data, span_list
from .repeats import without_repeats
from .resample import drawn
from .simhash import near_duplicates
from .sketches import sketch_duplicates
from .tokens import vocabulary
from .toxicity import toxicity
from .url_rules import ALLOW, BLOCK, HostRule, PatternRule, judge_urls

HOST_RULES = (
    HostRule(ALLOW, "com", "/"),
    HostRule(BLOCK, "example.com", "/en/"),
    HostRule(ALLOW, "www.example.com", "/en/"),
    HostRule(BLOCK, "net", "/es/"),
    HostRule(BLOCK, "net", "/fr/"),
)

PATTERN_RULES = (
    PatternRule(BLOCK, "||adult-x."),
    PatternRule(BLOCK, "||casino-win."),
    PatternRule(BLOCK, "||cheap-pills."),
    PatternRule(BLOCK, "||free-bets."),
    PatternRule(BLOCK, "||ads-track."),
    PatternRule(BLOCK, "||spam-farm."),
    PatternRule(BLOCK, "/banner/*/img^"),
    PatternRule(BLOCK, "/wp-login.php^"),
    PatternRule(BLOCK, "?sessionid="),
    PatternRule(BLOCK, "||example.org^*?*utm_source=feed|"),
    PatternRule(BLOCK, "*.exe|"),
    PatternRule(ALLOW, "||spam-farm.*/en/*.html|"),
    PatternRule(ALLOW, "||blog.*?utm_source=feed|"),
)


def op1_repeats(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    spans = F.col("spans")
    return without_repeats(docs).select(
        "row.doc_id", "n_bytes",
        F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]).alias(
            "n_removed"
        ),
        F.size(spans).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    digits = F.lower(F.lpad(F.hex("f0"), 16, "0"))
    return near_duplicates(docs).select("doc_id", digits.alias("fingerprint"), "component_id")


def op3_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = find_personal_data(docs)

    def count(kind: str):
        of_kind = F.filter("base", lambda s: s["kind"] == kind)
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    base = span_list(F.col("base"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[count(k) for k in KINDS],
        F.sha2(base, 256).alias("base_sha256"),
        span_list(F.concat("base", "terms")).alias("spans"),
    )


def op4_benchmark_items(spark: SparkSession, folder: str) -> DataFrame:
    return contained_items(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity(docs, read_table(spark, folder, "labels"))
    return scored.select("doc_id", "p_poor", "p_toxic", "is_toxic")


def op5_nearest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op6_token_file(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    path = scratch_path(spark, "token-file")
    write_token_file(docs, path, vocabulary("byte_bpe_50k.json"))
    return read_token_file(spark, path).select(
        "doc_id", "start",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = main_text(read_table(spark, folder, "pages"))
    return found.select(
        "row.page_id", "row.url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return packed(docs, vocabulary("word_bpe_49k.json"))


def op7_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages").select("page_id", "url")
    judged = judge_urls(pages, "url", HOST_RULES, PATTERN_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "pattern")


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults, by a hash of conversation and turn; NULLs are one space."""
    space = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    turns = turns.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"), (F.crc32(name) % 20).alias("fault"),
    )
    fault = F.col("fault")
    text = (
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    times = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.where(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), F.explode(times).alias("_time"),
    ).drop("_time")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = read_table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    report = repair_report(damaged(turns)).withColumnRenamed("conv_id", "_conv")
    found = turns.select("conv_id").distinct().join(
        report, F.col("conv_id").eqNullSafe(F.col("_conv")), "left"
    )
    # Conversations of which no turn is left are in no report.
    return found.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_resample(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return drawn(docs, read_table(spark, folder, "benchmark")).select(
        "row.doc_id", "n_features", "weight", "score", "rank"
    )


def op13_sketch_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return sketch_duplicates(docs).select("row.doc_id", "n_shingles", "component_id", "kept")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeats": op1_repeats,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_personal_data": op3_personal_data,
    "op4_benchmark_items": op4_benchmark_items,
    "op8_toxicity": op8_toxicity,
    "op5_nearest": op5_nearest,
    "op6_token_file": op6_token_file,
    "op9_main_text": op9_main_text,
    "op10_packing": op10_packing,
    "op7_url_rules": op7_url_rules,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_resample": op12_resample,
    "op13_sketch_duplicates": op13_sketch_duplicates,
}
