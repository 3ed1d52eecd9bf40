"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    align,
    decontaminate,
    exact,
    licences,
    lm_bloom,
    mixing,
    neighbours,
    packing,
    quality,
    simhash,
    spelling,
    token_counts,
    url_lists,
)

SOURCE_WEIGHTS = [1.0, 2.0, 3.0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"], shingle=4, distance=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its perplexity, its threshold and whether it is kept."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = quality.classify(docs, labels, ["doc_id", "lang"])
    return found.select("doc_id", "lang", "n_tokens", "perplexity", "threshold", "keep")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), SOURCE_WEIGHTS)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_matches(table(spark, sf_dir, "documents"))


def op5_licence_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same templates against every run of words, whatever the lines."""
    return licences.licence_passages(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after three edits of each, whose places
    and lengths follow from the identifier."""
    docs = table(spark, sf_dir, "documents")
    state = token_counts.build_state(docs, ["doc_id", "source", "lang"])
    ident, size = F.coalesce(F.col("row.doc_id"), F.lit(0)), F.length("text")
    new = F.concat_ws(" ", F.lit("in"), F.col("row.source"), F.col("row.lang"))
    edits = F.array(
        *[
            F.struct(
                F.pmod(ident * (7919 + 104729 * i), size + 1).alias("start"),
                F.pmod(ident * 31 + i, F.lit(40)).alias("length"),
                (new if i % 2 else F.lit("")).alias("replacement"),
            )
            for i in range(3)
        ]
    )
    before = F.element_at("tokens", 2)
    state = state.withColumn("edits", edits).withColumn("row", F.struct("row.doc_id", before.alias("tokens_before")))
    edited = token_counts.apply_edits(state, F.col("edits"))
    return edited.select("row.*", F.col("n_tokens").alias("tokens_after"), F.length("text").alias("chars_after"), "encoded_chars")


def op7_rotated_codes_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def url_list(pages: DataFrame) -> DataFrame:
    """Dated list entries from the hosts of ``pages``: a third of the hosts are blocked,
    allowed again and blocked again; the language folders of another third are blocked;
    the top two labels of every eleventh host are blocked late."""
    host = url_lists.host_of(F.col("url"))
    hosts = pages.select(host.alias("host")).filter("host != ''").distinct()
    number = F.conv(F.substring(F.md5("host"), 1, 7), 16, 10).cast("long")
    first = F.lit("2024-01-01").cast("date")

    def entry(key, day, action):
        return F.struct(key.alias("key"), F.date_add(first, day.cast("int")).alias("day"), F.lit(action).alias("action"))

    start = F.pmod(F.col("n"), F.lit(300))
    top = F.substring_index("host", ".", -2)
    return (
        hosts.withColumn("n", number)
        .select(
            F.explode(
                F.when(
                    F.pmod("n", F.lit(3)) == 0,
                    F.array(
                        entry(F.col("host"), start, "block"),
                        entry(F.col("host"), start + 60, "allow"),
                        entry(F.col("host"), start + 200, "block"),
                    ),
                )
                .when(F.pmod("n", F.lit(3)) == 1, F.array(entry(F.concat("host", F.lit("/en")), start, "block")))
                .when(F.pmod("n", F.lit(11)) == 2, F.array(entry(top, start + 300, "block")))
            ).alias("e")
        )
        .select("e.*")
    )


def op9_dated_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a capture of a day that follows from its identifier, against the
    list of ``url_list``."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(730)).cast("int"))
    captures = pages.withColumn("fetched_on", day)
    return url_lists.filter_urls(captures, url_list(pages), ["page_id", "fetched_on"], "url", "fetched_on")


def op10_bloom_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", lm_bloom.held_out(F.col("doc_id")))
    return lm_bloom.score(docs, ~F.col("held_out"), ["doc_id", "held_out"])


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, items, ["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align.alignment(table(spark, sf_dir, "documents"), ["doc_id"], digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), modulus=97)
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_quality_classifier,
        op3_source_mix,
        op4_best_fit_packing,
        op5_licence_scan,
        op5_licence_passages,
        op6_token_counts,
        op7_rotated_codes_search,
        op8_exact_dedup,
        op9_dated_url_lists,
        op10_bloom_lm_scores,
        op11_benchmark_decontamination,
        op12_tokenizer_alignment,
        op13_spelling_variants,
    )
}
