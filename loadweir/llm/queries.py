"""The registered queries of this package, with production parameters over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadweir.llm import (
    byte_bpe,
    chat,
    class_lm,
    decontaminate,
    html_text,
    jaccard,
    quality,
    ranked,
    sharding,
    simhash,
    spelling,
    substring,
    warc,
)
from loadweir.llm.common import staged


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return chat.read_back(chat.format_windows(turns.unionByName(planted), budget=1024, history=2))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = html_text.extract(pages, html_text.train(pages))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    # the table has no time of capture: a second for each id
    index = warc.archive_and_index(pages, F.timestamp_seconds(F.col("page_id") + 1_704_067_200))
    return index.select(
        F.expr("cast(nullif(record_id, '') as bigint)").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.expr("cast(nullif(refers_to, '') as bigint)").alias("refers_to"),
        "url_key",
        "captured",
        "range",
        "position",
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    cut = substring.cut_repeats(docs, width=35)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = simhash.near_duplicates(docs, width=4, radius=4)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards=24)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return byte_bpe.round_trip(docs, "doc_id").drop("same")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source", "text")
    judged = quality.judge(staged(quality.measure(docs).drop("text"), "measured"))
    return judged.select("doc_id", *quality.BASE, "base_failed", "kept")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = decontaminate.find_matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), width=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return spelling.variants(spelling.word_counts(docs))


def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard.similar_groups(docs, width=3, percent=90)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return ranked.search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=10)


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_html_text": op2_html_text,
    "op3_class_lm": op3_class_lm,
    "op4_warc": op4_warc,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_simhash": op6_simhash,
    "op7_sharding": op7_sharding,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_quality_rules": op9_quality_rules,
    "op10_decontaminate": op10_decontaminate,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_ngram_jaccard": op12_ngram_jaccard,
    "op13_ranked_search": op13_ranked_search,
}
_BLANK = r"[ \t\n\x0b\f\r]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RUNS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: SQL for the operators whose results it can express; the others are held against brute force.
ORACLE = {
    "op12_ngram_jaccard": rf"""
        WITH RECURSIVE d AS (
            SELECT doc_id, list_filter(string_split_regex({_LOWER}, '{_BLANK}'), lambda x: x <> '') AS w FROM documents
        ),
        grams AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)
        ),
        sizes AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS k FROM grams GROUP BY doc_id),
        firsts AS (SELECT k, min(doc_id) AS doc_id, any_value(n) AS n FROM sizes GROUP BY k),
        shared AS (SELECT g, doc_id, n FROM grams JOIN firsts USING (doc_id)),
        pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM shared a JOIN shared b ON a.g = b.g AND a.doc_id <> b.doc_id AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
        ),
        reached AS (
            SELECT doc_id AS a, doc_id AS b FROM firsts
            UNION SELECT r.a, p.b FROM reached r JOIN pairs p ON p.a = r.b
        ),
        roots AS (SELECT a AS doc_id, min(b) AS root FROM reached GROUP BY a)
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(r.root, d.doc_id) AS component_id
        FROM d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN firsts f ON f.k = s.k LEFT JOIN roots r ON r.doc_id = f.doc_id""",
    "op13_ranked_search": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS w FROM documents),
        b AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark
        ),
        whole AS (SELECT count(*) FILTER (len(w) > 0) AS n, sum(len(w)) AS l FROM d),
        tfs AS (
            SELECT doc_id, term, any_value(size) AS size, count(*) AS tf
            FROM (SELECT doc_id, len(w) AS size, unnest(w) AS term FROM d) GROUP BY doc_id, term
        ),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS weight
            FROM tfs, whole WHERE term IN (SELECT term FROM b) GROUP BY term, n
        ),
        scores AS (
            SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * n) // l)))) AS BIGINT) AS score
            FROM b JOIN weights USING (term) JOIN tfs USING (term), whole GROUP BY item_id, doc_id
        )
        SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM scores WHERE score > 0
        WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY rank <= 10""",
    "op5_substring_dedup": rf"""
        WITH d AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{_BLANK}'), lambda x: x <> '') AS w
            FROM documents
        ),
        starts AS (
            SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS k
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
        ),
        repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY k) AS c FROM starts) WHERE c > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM repeated),
        each AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
        cut AS (
            SELECT doc_id, count(gone.p) AS n, string_agg(x, ' ' ORDER BY p) FILTER (gone.p IS NULL) AS kept
            FROM each LEFT JOIN gone USING (doc_id, p) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN cut USING (doc_id)""",
    "op10_decontaminate": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_RUNS}') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_RUNS}') AS w FROM benchmark),
        tests AS (
            SELECT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k
            FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
                  FROM b WHERE len(w) > 0)
        ),
        sizes AS (SELECT DISTINCT n FROM tests),
        starts AS (
            SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
            FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
        ),
        met AS (SELECT DISTINCT doc_id, n, i, item_id FROM starts JOIN tests USING (n, k)),
        hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM met) GROUP BY doc_id),
        named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)""",
}
