"""The corpus operators as registered queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from tidewire.llm import block_dedup, chat_collapse, decontam, html_extract, langid, line_dedup, omh, ranked_search, sp_backtrack, suffix_buckets, warc, wavelet, whiten
from tidewire.llm._common import read_table


def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.write_warc(read_table(spark, sf_dir, "pages"))
    found = warc.read_warc(spark, folder, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_block_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_dedup.exact_groups(read_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op4_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_collapse.render_conversations(read_table(spark, sf_dir, "conversations"))


def op5_sentencepiece_backtrack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(read_table(spark, sf_dir, "documents"))


def token_digests(docs: DataFrame) -> DataFrame:
    """The digests of the ids and decoded texts of ``documents``."""
    encoded = sp_backtrack.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op7_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    folder = wavelet.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return wavelet.read_tokens(spark, folder, with_ids=False)


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return omh.classes(read_table(spark, sf_dir, "documents")).drop("n_links")


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_buckets.repeated_spans(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = ranked_search.build_index(read_table(spark, sf_dir, "documents"))
    return ranked_search.search(index, read_table(spark, sf_dir, "benchmark"), k=10)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_bloom_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.drop_repeated_lines(read_table(spark, sf_dir, "documents"), min_docs=10, keep="none", min_chars=1)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


QUERIES = {
    "op1_warc_round_trip": op1_warc_round_trip,
    "op2_block_exact_dedup": op2_block_exact_dedup,
    "op3_language_id": op3_language_id,
    "op4_chat_snapshots": op4_chat_snapshots,
    "op5_sentencepiece_backtrack": op5_sentencepiece_backtrack,
    "op6_html_main_text": op6_html_main_text,
    "op7_wavelet_tokens": op7_wavelet_tokens,
    "op8_order_minhash": op8_order_minhash,
    "op9_benchmark_leaks": op9_benchmark_leaks,
    "op10_repeated_spans": op10_repeated_spans,
    "op11_ranked_search": op11_ranked_search,
    "op12_whitening": op12_whitening,
    "op13_bloom_line_dedup": op13_bloom_line_dedup,
}

ORACLES = {
    "op1_warc_round_trip": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h,
                   row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST) AS place,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top
            FROM pages
        )
        SELECT page_id, strlen(t) AS payload_bytes,
               array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0],
                   lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                                    CAST((('0x' || substr(h, i * 5 + 1, 5))::BIGINT >> s) & 31 AS BIGINT) + 1, 1)), '')), '') AS payload_digest,
               CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN place > 1 THEN top END AS refers_to
        FROM p
    """,
    "op2_block_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM d
    """,
    "op4_chat_snapshots": """
        WITH t AS (
            SELECT conv_id, turn,
                   sha256((CASE WHEN role IS NULL THEN '-' ELSE length(role) || ':' || role END)
                          || (CASE WHEN text IS NULL THEN '-' ELSE length(text) || ':' || text END)) AS sha,
                   '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS shown,
                   (CASE WHEN role IS NULL THEN '-' ELSE length(role) || ':' || role END)
                   || (CASE WHEN text IS NULL THEN '-' ELSE length(text) || ':' || text END) AS exact
            FROM conversations WHERE conv_id IS NOT NULL
        ), p AS (
            SELECT conv_id,
                   row_number() OVER w AS k,
                   count(*) OVER (PARTITION BY conv_id) AS n,
                   string_agg(shown, '') OVER w AS shown,
                   string_agg(exact, '') OVER w AS exact
            FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, sha ROWS UNBOUNDED PRECEDING)
        ), whole AS (
            SELECT exact, k AS n_turns, max(conv_id) AS conv_id, count(*) AS n_copies, any_value(shown) AS text
            FROM p WHERE k = n GROUP BY exact, k
        )
        SELECT conv_id, n_turns, n_copies, text FROM whole w
        WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.k < p.n AND p.k = w.n_turns AND p.exact = w.exact)
    """,
    "op9_benchmark_leaks": r"""
        WITH dw AS (
            SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
        ), iw AS (
            SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark
        ), s AS (
            SELECT DISTINCT item_id, least(5, len(w)) AS k,
                   unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2),
                                         lambda i: array_to_string(w[i : i + least(5, len(w)) - 1], ' '))) AS shingle
            FROM iw WHERE len(w) > 0
        ), d AS (
            SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2),
                                              lambda i: array_to_string(w[i : i + k - 1], ' '))) AS shingle
            FROM dw, (SELECT DISTINCT k FROM s) WHERE len(w) >= k
        ), total AS (
            SELECT item_id, count(*) AS n_shingles FROM s GROUP BY item_id
        )
        SELECT doc_id, item_id, count(*) AS n_found, n_shingles, round(count(*) / n_shingles, 6) AS containment
        FROM d JOIN s USING (k, shingle) JOIN total USING (item_id)
        GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= 0.8 * n_shingles
    """,
    "op11_ranked_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ), i AS (
            SELECT row_number() OVER () AS item, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM benchmark
        ), tf AS (
            SELECT row, doc_id, term, count(*) AS tf
            FROM (SELECT row, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d)
            GROUP BY row, doc_id, term
        ), n AS (
            SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row
        ), total AS (
            SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM n
        ), m AS (
            SELECT row, 100 - 90 + (90 * n * docs) // len AS m FROM n, total
        ), w AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
            FROM tf, total GROUP BY term
        ), q AS (
            SELECT DISTINCT item, item_id, term
            FROM (SELECT item, item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i)
        ), s AS (
            SELECT item, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
            FROM q JOIN tf USING (term) JOIN m USING (row) JOIN w USING (term)
            GROUP BY item, item_id, row, doc_id
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
        FROM s WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) <= 10
    """,
    "op13_bloom_line_dedup": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
        ), l AS (
            SELECT row, doc_id, line_no, lines[line_no] AS line,
                   translate(regexp_replace(lines[line_no], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT *, unnest(range(1, len(lines) + 1)) AS line_no FROM d)
        ), common AS (
            SELECT key FROM l WHERE key <> '' GROUP BY key HAVING count(DISTINCT row) >= 10
        )
        SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
        FROM l LEFT JOIN common c ON l.key = c.key
        GROUP BY row, doc_id
    """,
}
