"""The registered queries of the corpus operators, with production
parameters, and their DuckDB oracles where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import langid, rules, urls, warc
from tessera.llm.alignment import aligned_documents
from tessera.llm.common import crc_of_id, table
from tessera.llm.ctw import lm_scores
from tessera.llm.decontam import contaminated
from tessera.llm.exact import exact_groups
from tessera.llm.mixing import mix
from tessera.llm.neardup import near_duplicates
from tessera.llm.packing import pack_documents
from tessera.llm.periods import periodic_runs
from tessera.llm.quality import judged

#: Weights by order of the sources, repeating. Fixed values.
SOURCE_WEIGHTS = [3.0, 1.0, 2.0]

#: Rules for urls. Fixed values.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public vocabulary (the default is used for packing), installed on
    every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn(
        "held_out", F.coalesce(crc_of_id() % 4 == 2, F.lit(False)))
    model = langid.train(docs.where(~F.col("held_out")))
    return langid.predict(docs, model, ["doc_id", "held_out"])


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' urls end in the id of the document they show, whose quality
    label is the label of the url."""
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    shown = pages.select("page_id", F.regexp_extract(urls.path_of(), r"/(\d{1,18})(?:\.\w+)?/?$", 1).try_cast("long").alias("doc_id"))
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    return urls.judge(pages, URL_RULES, shown.join(labels, "doc_id").select("page_id", (F.col("quality") == 0).alias("bad")))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text")).drop("row_id", "first")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents", "doc_id", "text", "lang"),
                        table(spark, sf_dir, "labels", "doc_id", "quality"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents", "doc_id", "text", "lang"),
                  table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")).drop("row_id")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents", "doc_id", "text")).drop("row_id")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages", "page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"), SOURCE_WEIGHTS).drop("row_id", "copies")


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_path())


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = F.coalesce(crc_of_id() % 10 == 0, F.lit(False))
    return (lm_scores(docs.withColumn("train", ~held_out)).withColumn("held_out", ~F.col("train"))
            .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Makes the tail of every tenth document (by the crc32 of its id)
    periodic: from word a on, with period p."""
    crc = crc_of_id()
    words = docs.withColumn("h", crc).withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))))
    g, n = F.floor(F.col("h") / 10), F.size("w")
    planned = (words.withColumn("a", F.when(n > 0, g % n).cast("int"))
               .withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int")))
    tail = F.transform(F.sequence(F.col("a"), n - 1), lambda i: F.col("w")[F.col("a") + (i - F.col("a")) % F.col("p")])
    return planned.withColumn("text", F.when(F.col("a").isNotNull(), F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " "))
                              .otherwise(F.col("text"))).select("doc_id", "text")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_planted_periods(table(spark, sf_dir, "documents", "doc_id", "text")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.element_at(F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))), 1)
    size = -F.col("best.less")
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), size.alias("length"),
        F.col("best.period").alias("period"), F.floor(1000 * size / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_documents(table(spark, sf_dir, "documents", "doc_id", "text"),
                             tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language,
    "op2_url_filter": op2_url_filter,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_quality_rules": op4_quality_rules,
    "op5_quality": op5_quality,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_warc": op7_warc,
    "op8_mix_sources": op8_mix_sources,
    "op9_pack": op9_pack,
    "op10_lm_score": op10_lm_score,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_alignment": op12_token_alignment,
    "op13_contamination": op13_contamination,
}

ORACLES: dict[str, str] = {
    "op7_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
             g AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest,
                          max(page_id) OVER (PARTITION BY b) AS best FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes < 1000 OR best = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND best <> page_id THEN best END AS refers_to FROM g""",
    "op6_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
             g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)""",
}
