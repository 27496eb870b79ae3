"""The registered queries over the shared tables: ``opN_<name>`` per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ledgermill.llm import (
    ann,
    collocations,
    jaccard,
    licenses,
    manifest,
    mixing,
    packing,
    pii,
    quality,
    rules,
    simhash,
    substrings,
    urls,
)
from ledgermill.llm.common import table
from ledgermill.llm.oracle import OP11_SQL, OP12_SQL


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans and those that the labelers add."""
    found, _ = pii.find_personal_data(table(spark, sf_dir, "documents"))
    return pii.span_digest(found)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as pieces of at most 1024 tokens, packed into sequences."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document that occur earlier, and the document that keeps each."""
    found = substrings.removed_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "end", "kept_doc_id")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    judged, _ = urls.judge_urls(table(spark, sf_dir, "pages"))
    return judged.withColumnRenamed("row", "page_id")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed as evenly as no source is read more than four times, every document read."""
    mixture, _ = mixing.mix(table(spark, sf_dir, "documents"), repetition=4.0)
    return mixture.select(
        F.col("row").alias("doc_id"), "source", "tokens", "pass", "block", "position"
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed licence families of every document, and its notices of unknown families."""
    scanned, _ = licenses.scan(table(spark, sf_dir, "documents"))
    sure = F.filter("notices", lambda n: n["confirmed"])
    return scanned.select(
        F.col("row").alias("doc_id"),
        F.array_join(
            F.array_sort(F.array_distinct(F.transform(sure, lambda n: n["family"]))), ","
        ).alias("licenses"),
        F.array_join(
            F.transform(sure, lambda n: F.concat_ws(":", n["line"], n["family"])), ","
        ).alias("notices"),
        F.size(F.filter("notices", lambda n: n["notice"] & ~n["confirmed"])).cast("long").alias("n_unknown"),
    )


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's shingle set, and its component of links."""
    found = jaccard.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", F.col("first.doc_id").alias("component_id"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten nearest found for every vector whose id is divisible by 100."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairwise-ranked quality of every document."""
    scored, _ = quality.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )
    return scored


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule ledger of every document, its base measurements and the verdict of policy v1."""
    ledger = rules.rule_ledger(table(spark, sf_dir, "documents"))
    base_failed = ~rules.passes("base")
    return ledger.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        (~base_failed & rules.passes("v1")).alias("kept"),
        "failed_rules",
    )


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents")).drop("k")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proof of every document, folded with some of the texts given without their line breaks."""
    altered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    given = F.when(altered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return manifest.prove(manifest.build(table(spark, sf_dir, "documents"), given={"text": given}))


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, and its component of fingerprints at four or fewer differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


OP10_SQL = r"""
WITH split AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^ \t-\r]')) AS ls
  FROM documents),
windows AS (
  SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS win
  FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 7)) AS i FROM split WHERE len(w) >= 8)),
twins AS (SELECT rid, i FROM windows
          QUALIFY count(*) OVER (PARTITION BY rid, win) > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM twins, generate_series(0, 7) AS g(k)
            GROUP BY rid),
measured AS (
  SELECT s.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutters,
    length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_upper,
    length(t) - length(replace(t, '!', '')) AS n_exclamations
  FROM split s LEFT JOIN covered c USING (rid)),
judged AS (
  SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN n_lines >= 5 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN 10 * n_stutters > 3 * n_words THEN 16 ELSE 0 END
    + CASE WHEN n_words > 0 AND 2 * n_upper > word_chars THEN 32 ELSE 0 END
    + CASE WHEN 2 * n_exclamations > n_words THEN 64 ELSE 0 END
    + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)
           THEN 128 ELSE 0 END AS bits
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       bits & 3 <> 0 AS base_failed, bits = 0 AS kept, bits::BIGINT AS failed_rules
FROM judged
"""


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_mixing": op5_mixing,
    "op6_license_scan": op6_license_scan,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_quality_rules": op10_quality_rules,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_simhash_dedup": op13_simhash_dedup,
    "pipeline": corpus_pipeline.run,
}

# The others are tested against brute force, or held-out accuracy, in tests/llm.
LLM_ORACLE: dict[str, str] = {
    "op10_quality_rules": OP10_SQL,
    "op11_phrase_collocations": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
