"""The registered queries of the operators, over whole tables, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebars.llm.ann import nearest_neighbours
from tidebars.llm.chat_windows import format_windows, read_back
from tidebars.llm.collocations import collocations
from tidebars.llm.decontamination import leaked_items
from tidebars.llm.html_text import extract_text
from tidebars.llm.packing import pack_documents
from tidebars.llm.simhash_gray import simhash_components
from tidebars.llm.spelling import spelling_variants
from tidebars.llm.substring_dedup import dedup_substrings
from tidebars.llm.token_files import token_files
from tidebars.llm.tokens import default_tokenizer
from tidebars.llm.toxicity import score_toxicity
from tidebars.llm.vector_links import vector_links
from tidebars.llm.warc import read_warc, write_warc
from tidebars.session import stage


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_substrings(docs, "text", 35).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM docs)
), marked AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY h) > 1 AS again FROM windows
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM marked WHERE again
), words AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs
), kept AS (
  SELECT words.doc_id, count(gone.i) AS n_removed, string_agg(word, ' ' ORDER BY words.i) FILTER (gone.i IS NULL) AS text
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.i = words.i GROUP BY words.doc_id
)
SELECT docs.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept ON kept.doc_id = docs.doc_id
"""


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest_neighbours(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_text(pages).withColumnRenamed("id", "page_id")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs, default_tokenizer(), size=4096, end=2).withColumnRenamed("id", "doc_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return score_toxicity(docs, labels, threshold=0.7).select(
        F.col("id").alias("doc_id"), "held_out", "score", "predicted")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    windows = stage(format_windows(turns.unionByName(extra), default_tokenizer()))
    return read_back(windows).withColumnRenamed("id", "conv_id")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return leaked_items(docs, benchmark).withColumnRenamed("id", "doc_id")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return simhash_components(docs, "doc_id", "text", shingle=3, bits=3).select(
        F.col("id").alias("doc_id"), "fingerprint", "component_id")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return read_warc(write_warc(pages, min_bytes=0), payloads=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Base32 digits from the hex digest: digit i has bits 5 i to 5 i + 4, which lie in two hex digits.
_DIGITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((strpos('0123456789abcdef', substr(hex, {i * 5 // 4 + 1}, 1)) - 1) * 16"
    f" + (strpos('0123456789abcdef', substr(hex, {i * 5 // 4 + 2}, 1)) - 1)) >> {3 - i * 5 % 4}) % 32, 1)"
    for i in range(32)
)
OP9_SQL = f"""
WITH digests AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), tops AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS top FROM digests
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {_DIGITS} AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM tops
"""


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return token_files(docs, default_tokenizer(), end=1).withColumnRenamed("id", "doc_id")


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    return vector_links(vectors, 0.98).withColumnRenamed("id", "vec_id")


OP11_SQL = """
WITH RECURSIVE fit AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT a AS vec_id, a AS other FROM links
  UNION
  SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.other
), roots AS (
  SELECT vec_id, min(other) AS root FROM reach GROUP BY vec_id
), degrees AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, coalesce(r.root, e.vec_id) AS component_id,
       coalesce(r.root, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN degrees d ON d.vec_id = e.vec_id LEFT JOIN roots r ON r.vec_id = e.vec_id
"""


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang")
    return collocations(docs, longest=5, least=100, top=2000, share=100)


OP12_SQL = r"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(part, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS part FROM documents)
), spots AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), sizes AS (
  SELECT unnest([1, 2, 3, 4, 5]) AS size
), counts AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM spots, sizes WHERE i + size - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100
), totals AS (
  SELECT lang, count(*) AS n FROM spots GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, f AS a FROM counts WHERE size > 1
), subsumed AS (
  SELECT DISTINCT p.lang, p.phrase FROM candidates p JOIN candidates q ON p.lang = q.lang AND q.size > p.size
  AND q.a * 100 >= p.a * 100 AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' ')
), cuts AS (
  SELECT lang, size, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k
  FROM candidates ANTI JOIN subsumed USING (lang, phrase)
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, t.n,
         (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:c.size], ' ')
), weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest
)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return spelling_variants(docs, every=199, least_length=6, least=5, times=5)


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_nearest_neighbours": op2_nearest_neighbours,
    "op3_html_extraction": op3_html_extraction,
    "op4_packing": op4_packing,
    "op5_toxicity": op5_toxicity,
    "op6_chat_formatting": op6_chat_formatting,
    "op7_decontamination": op7_decontamination,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_warc": op9_warc,
    "op10_token_files": op10_token_files,
    "op11_embedding_near_dedup": op11_embedding_near_dedup,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES = {
    "op1_substring_dedup": OP1_SQL,
    "op9_warc": OP9_SQL,
    "op11_embedding_near_dedup": OP11_SQL,
    "op12_phrase_collocations": OP12_SQL,
}
