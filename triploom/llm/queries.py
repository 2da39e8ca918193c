"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triploom.llm import align, byte_bpe, decontaminate, fill_in_middle, hnsw, huffman, mixing, packing, quality, simhash_dups, suffix_dups, token_cache, warc
from triploom.llm.storage import reach_workers, shared_folder, stored

DOMAINS = "concat('quality', quality, ' toxic', toxic)"
WEIGHTS = {"quality1 toxic0": 0.97, "quality1 toxic1": 0.01, "quality0 toxic0": 0.015, "quality0 toxic1": 0.005}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents."""
    found = decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumn("similarity", F.round("similarity", 9))


def op2_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op3_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents for the target weights of the domains."""
    rated = mixing.with_rates(_table(spark, sf_dir, "documents").drop("lang", "source", "n_chars"), _table(spark, sf_dir, "labels"), DOMAINS, WEIGHTS)
    return rated.drop("text")


def op4_cached_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents through a new cache."""
    cache = shared_folder(spark, "token-cache")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_cache.token_counts(docs, cache, public_tokenizers.path("piece_bpe_32k.model"), 4096)


def op5_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th."""
    return hnsw.nearest(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "id % 20 = 0", 20)


def op6_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents written to files and read back."""
    return huffman.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and decision for every document."""
    docs = stored(quality_scores(_table(spark, sf_dir, "documents")), "scores")
    return docs.withColumn("accepted", F.col("quality_score") >= 0.5)


def quality_scores(docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "text")
    model, _ = quality.fit_quality(docs)
    return quality.with_quality(docs, model).drop("text")


def op8_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    placed = packing.sharded(_table(spark, sf_dir, "documents").select("doc_id", "text"), 24)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op9_simhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash_dups.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that occur in two documents or more."""
    return suffix_dups.repeated_passages(_table(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents and the bytes that they stand for, as digests."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = byte_bpe.decoded(byte_bpe.encoded(_table(spark, sf_dir, "documents"), ranks), ranks)
    n_tokens = F.shiftright(F.octet_length("ids"), 2).cast("long")
    return rows.select("doc_id", n_tokens.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of all documents."""
    return fill_in_middle.digests(_table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of the tokens of two vocabularies in all documents."""
    docs = _table(spark, sf_dir, "documents")
    return align.aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_benchmark_decontamination,
        op2_warc_archives,
        op3_soft_mixing,
        op4_cached_token_counts,
        op5_hnsw_search,
        op6_huffman_ids,
        op7_weak_label_quality,
        op8_best_fit_shards,
        op9_simhash_near_dups,
        op10_repeated_passages,
        op11_byte_bpe,
        op12_fill_in_middle,
        op13_token_alignment,
    )
}

WORDS = "list_filter(regexp_split_to_array({text}, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')"

ORACLES = {
    "op1_benchmark_decontamination": f"""
WITH items AS (SELECT item_id, {WORDS.format(text="lower(text)")} AS words FROM benchmark),
item_shingles AS (
    SELECT item_id, least(5, len(words)) AS k, len(words) - least(5, len(words)) + 1 AS m, o,
           array_to_string(words[o + 1 : o + least(5, len(words))], ' ') AS shingle
    FROM (SELECT *, unnest(range(len(words) - least(5, len(words)) + 1)) AS o FROM items WHERE len(words) > 0)
),
docs AS (SELECT doc_id, {WORDS.format(text="lower(text)")} AS words FROM documents WHERE doc_id IS NOT NULL),
doc_shingles AS (
    SELECT doc_id, k, len(words) - k + 1 AS n, pos, array_to_string(words[pos + 1 : pos + k], ' ') AS shingle
    FROM (SELECT *, unnest(range(len(words) - k + 1)) AS pos
          FROM docs, (SELECT DISTINCT k FROM item_shingles) WHERE len(words) >= k)
),
windows AS (
    SELECT DISTINCT doc_id, k, m, n, unnest(range(greatest(0, least(pos - m + 1, n - m)), greatest(0, least(pos, n - m)) + 1)) AS start
    FROM (SELECT DISTINCT doc_id, k, m, n, pos FROM doc_shingles JOIN item_shingles USING (k, shingle))
),
window_counts AS (
    SELECT w.doc_id, w.k, w.m, w.n, w.start, shingle, count(*) AS c
    FROM windows w JOIN doc_shingles d ON w.doc_id = d.doc_id AND w.k = d.k AND pos >= start AND pos < start + m
    GROUP BY ALL
),
item_counts AS (SELECT item_id, k, m, shingle, count(*) AS c FROM item_shingles GROUP BY ALL),
shared AS (
    SELECT doc_id, item_id, start, m, least(m, n) AS size, sum(least(w.c, i.c))::DOUBLE AS s
    FROM window_counts w JOIN item_counts i USING (k, m, shingle)
    GROUP BY ALL
),
scored AS (SELECT *, s / (size + m - s) AS similarity FROM shared)
SELECT doc_id, item_id, round(similarity, 9) AS similarity, start::INTEGER AS window_start, size::INTEGER AS window_shingles
FROM scored WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
""",
    "op2_warc_archives": """
WITH payloads AS (
    SELECT page_id, url, coalesce(html, '') AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first,
           unhex(sha1(coalesce(html, '')))::BIT::VARCHAR AS bits
    FROM pages
)
SELECT page_id, url, strlen(payload) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
           + 16 * substr(bits, (5 * i + 1)::INTEGER, 1)::INTEGER + 8 * substr(bits, (5 * i + 2)::INTEGER, 1)::INTEGER
           + 4 * substr(bits, (5 * i + 3)::INTEGER, 1)::INTEGER + 2 * substr(bits, (5 * i + 4)::INTEGER, 1)::INTEGER
           + substr(bits, (5 * i + 5)::INTEGER, 1)::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN page_id = first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM payloads
""",
    "op10_repeated_passages": f"""
WITH docs AS (SELECT DISTINCT doc_id, md5(text) AS nth, {WORDS.format(text="text")} AS words FROM documents WHERE doc_id IS NOT NULL),
windows AS (
    SELECT doc_id, nth, start, md5(array_to_string(words[start + 1 : start + 50], ' ')) AS content
    FROM (SELECT *, unnest(range(len(words) - 49)) AS start FROM docs WHERE len(words) >= 50)
),
found AS (
    SELECT DISTINCT doc_id, nth, start
    FROM windows JOIN (SELECT content FROM windows GROUP BY content HAVING min(doc_id) < max(doc_id)) USING (content)
),
marked AS (SELECT *, coalesce((start > lag(start) OVER w + 50)::INTEGER, 1) AS fresh FROM found WINDOW w AS (PARTITION BY doc_id, nth ORDER BY start)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, nth ORDER BY start) AS passage FROM marked)
SELECT doc_id, min(start)::INTEGER AS start_word, (max(start) - min(start) + 50)::INTEGER AS n_words
FROM numbered GROUP BY doc_id, nth, passage
""",
    "op12_fill_in_middle": r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
    FROM documents
),
drawn AS (
    SELECT *, len(units) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS one, ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS two,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
                WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM cut
),
parts AS (
    SELECT *, array_to_string(units[1 : least(one, two)], '') AS prefix,
           array_to_string(units[least(one, two) + 1 : greatest(one, two)], '') AS middle,
           array_to_string(units[greatest(one, two) + 1 : n], '') AS suffix
    FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""",
}
