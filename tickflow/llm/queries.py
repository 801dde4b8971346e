"""The text operators as queries over the given tables, with SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.llm.bpe_backtrack import encoded
from tickflow.llm.common import WORD, documents
from tickflow.llm.crf_toxicity import toxicity
from tickflow.llm.exact_dedup import exact_groups
from tickflow.llm.html_layout import rendered
from tickflow.llm.importance_resampling import resampled
from tickflow.llm.license_scan import license_matches
from tickflow.llm.line_frequency import line_verdicts
from tickflow.llm.periodic_runs import periodic_runs
from tickflow.llm.sentencepiece_backtrack import piece_ids
from tickflow.llm.simhash_golay import simhash_groups
from tickflow.llm.slack_packing import packed
from tickflow.llm.suffix_dedup import repeated_spans
from tickflow.llm.warc_derivatives import derivatives, responses


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


def held_out() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0


def op2_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out())
    scores = toxicity(documents(spark, sf_dir), labels)
    return scores.select("doc_id", held_out().alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans"))


def op3_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(documents(spark, sf_dir)).drop("spans")


def op6_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packed(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)
    return rows.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(documents(spark, sf_dir))


def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derivatives(responses(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    digest = F.sha2("record", 256).alias("record_sha256")
    return rows.select("page_id", "record_type", "record_id", "refers_to", "block_digest", "payload_digest", digest)


def op7_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rendered(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return rows.select("page_id", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def op8_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return line_verdicts(documents(spark, sf_dir)).select(*columns, "base_failed", "kept", "left_words")


def op10_bpe_backtrack(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encoded(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    digests = [F.sha2(column, 256).alias(f"{column}_sha256") for column in ("ids", "decoded")]
    return rows.select("doc_id", "n_tokens", *digests)


def echoing(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the texts, chosen by id, repeat a stretch of their words from some word on."""
    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.pmod(number, F.lit(10)) == 0
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), chosen.alias("chosen"))
    rows = rows.withColumn("g", F.floor(number / 10))
    rows = rows.withColumn("words", F.when(F.col("chosen"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0))))
    rows = rows.withColumn("n", F.coalesce(F.size("words"), F.lit(0)))
    rows = rows.withColumn("first", F.when(F.col("n") > 0, F.pmod("g", "n")))
    rows = rows.withColumn("period", 1 + F.floor((F.col("n") - F.col("first")) / (3 + F.pmod("g", F.lit(8)))))

    def word(i: Column) -> Column:
        at = F.when(i < F.col("first"), i).otherwise(F.col("first") + F.pmod(i - F.col("first"), F.col("period")))
        return F.get("words", at.cast("int"))

    echo = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), word), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, echo).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(echoing(documents(spark, sf_dir)))

    def better(best: Column, run: Column) -> Column:
        """Exponents compared as fractions; runs come by start and period, so the first of equal ones stays."""
        greater = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | greater, run).otherwise(best)

    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), better)
    line = lambda run: F.concat_ws(",", run["start"], run["length"], run["period"])
    lines = F.transform("runs", lambda run: F.concat(line(run), F.lit("\n")))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        "best.*",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def op12_sentencepiece_backtrack(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = piece_ids(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    digests = [F.sha2(column, 256).alias(f"{column}_sha256") for column in ("ids", "decoded")]
    return rows.select("doc_id", "n_tokens", *digests)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resampled(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op5_warc_derivatives": op5_warc_derivatives,
    "op7_html_layout": op7_html_layout,
    "op2_crf_toxicity": op2_crf_toxicity,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op6_slack_packing": op6_slack_packing,
    "op10_bpe_backtrack": op10_bpe_backtrack,
    "op3_simhash_golay": op3_simhash_golay,
    "op8_line_frequency": op8_line_frequency,
    "op9_exact_dedup": op9_exact_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_sentencepiece_backtrack": op12_sentencepiece_backtrack,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLES = {
    "op8_line_frequency": r"""
        WITH d AS (
            SELECT doc_id, source AS host, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ),
        windows AS (
            SELECT doc_id, pos, words[pos] || ' ' || words[pos + 1] || ' ' || words[pos + 2] AS w
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS pos FROM d)
        ),
        repeated AS (
            SELECT doc_id, pos FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1
        ),
        repeats AS (
            SELECT doc_id, count(DISTINCT word) AS n_repeat_words
            FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS word FROM repeated) GROUP BY doc_id
        ),
        worded AS (
            SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
        ),
        duplicates AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY doc_id),
        base AS (
            SELECT doc_id, host, CAST(len(words) AS BIGINT) AS n_words,
                   CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
                   CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
                   coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
            FROM d LEFT JOIN duplicates USING (doc_id) LEFT JOIN repeats USING (doc_id)
        ),
        lines AS (
            SELECT doc_id, host, text, md5(n) AS h, length(n) - length(replace(n, ' ', '')) + 1 AS line_words
            FROM (
                SELECT doc_id, host, text,
                       trim(regexp_replace(lower(line), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), ' ') AS n
                FROM worded JOIN d USING (doc_id)
            )
        ),
        seen AS (SELECT host, h, count(DISTINCT md5(text)) AS n_documents FROM lines GROUP BY host, h),
        hosts AS (SELECT host, count(DISTINCT md5(text)) AS host_documents FROM d GROUP BY host),
        frequent AS (
            SELECT host, h FROM seen JOIN hosts USING (host)
            WHERE n_documents > 20 AND 100 * n_documents > 1 * host_documents
        ),
        removed AS (
            SELECT doc_id, sum(line_words) AS removed_words FROM lines JOIN frequent USING (host, h) GROUP BY doc_id
        ),
        verdict AS (
            SELECT base.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                   n_words - CAST(coalesce(removed_words, 0) AS BIGINT) AS left_words
            FROM base LEFT JOIN removed USING (doc_id)
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND left_words >= 20 AND 100 * left_words >= 30 * n_words AS kept, left_words
        FROM verdict
    """,
    "op9_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents
        )
        SELECT DISTINCT doc_id, min(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY text) AS kept, sha256(text) AS text_sha256
        FROM t
    """,
}
