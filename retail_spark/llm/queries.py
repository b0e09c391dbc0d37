"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from retail_spark.llm import (
    bitsliced, htmltext, language, manifest, minhash, mixing, packing, passages, pii, quality, rabitq, resampling, toxicity,
)
from retail_spark.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced."""
    return pii.deidentify(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return htmltext.main_text(pages, htmltext.learn(pages))


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that documents repeat, with the document that has them first."""
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op7_bitsliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op10_rabitq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rabitq.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_pii": op2_pii,
    "op3_packing": op3_packing,
    "op4_html": op4_html,
    "op5_passages": op5_passages,
    "op6_language": op6_language,
    "op7_bitsliced": op7_bitsliced,
    "op8_mixing": op8_mixing,
    "op9_minhash": op9_minhash,
    "op10_rabitq": op10_rabitq,
    "op11_quality": op11_quality,
    "op12_manifest": op12_manifest,
    "op13_resampling": op13_resampling,
}

#: Whole shingle sets and every pair that shares a shingle, then reachability: for the small tables only.
OP9_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w]
           ELSE list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]]) END) AS s FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM shingles a JOIN shingles b USING (s)
           WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM common JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
          WHERE 100 * c >= 80 * (x.n + y.n - c)),
sym AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.v FROM reach r JOIN sym l ON l.u = r.b),
roots AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN roots USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

OP7_SQL = """
WITH whole AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
           FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

#: crc32 from a table of 256 values; nodes level by level, then each leaf's own way up through its group and the groups.
OP12_SQL = """WITH RECURSIVE crcs AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM range(256) AS bytes(b)),
parts AS (
  SELECT doc_id, lang, n_chars,
         coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
         || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail,
         coalesce(xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
                                  lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 7 = 0, false) AS hit
  FROM documents, crcs),
leaves AS (
  SELECT doc_id, lang, hit, sha256(head || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || coalesce(length(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) AS tampered FROM parts),
placed AS (
  SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST, doc_id NULLS FIRST, leaf) AS row,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM leaves),
nodes AS (
  SELECT g, 0 AS lvl, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT g, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY g, lvl, pos // 2, n),
subroots AS (SELECT g AS pos, h, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, pos, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY lvl, pos // 2, n),
inner_fold AS (
  SELECT row, g, 0 AS lvl, pos, n, CASE WHEN hit THEN tampered ELSE leaf END AS h, '' AS proof FROM placed
  UNION ALL
  SELECT f.row, f.g, f.lvl + 1, f.pos // 2, (f.n + 1) // 2,
         sha256(CASE WHEN f.pos % 2 = 0 THEN f.h || coalesce(s.h, '') ELSE s.h || f.h END), f.proof || coalesce(s.h, '')
  FROM inner_fold f LEFT JOIN nodes s ON s.g = f.g AND s.lvl = f.lvl AND s.pos = xor(f.pos, 1) WHERE f.n > 1),
outer_fold AS (
  SELECT row, 0 AS lvl, f.g AS pos, s.n, f.h, proof FROM inner_fold f JOIN subroots s ON s.pos = f.g WHERE f.n = 1
  UNION ALL
  SELECT f.row, f.lvl + 1, f.pos // 2, (f.n + 1) // 2,
         sha256(CASE WHEN f.pos % 2 = 0 THEN f.h || coalesce(s.h, '') ELSE s.h || f.h END), f.proof || coalesce(s.h, '')
  FROM outer_fold f LEFT JOIN tops s ON s.lvl = f.lvl AND s.pos = xor(f.pos, 1) WHERE f.n > 1)
SELECT p.doc_id, p.leaf, s.h AS subroot, r.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM placed p JOIN subroots s ON s.pos = p.g JOIN outer_fold f ON f.row = p.row AND f.n = 1, (SELECT h FROM tops WHERE n = 1) r
"""

#: Every feature of every text as a row; crc32 as above.
OP13_SQL = r"""WITH crcs AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM range(256) AS bytes(b)),
texts AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
split AS (
  SELECT r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
  UNION ALL
  SELECT NULL, NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
features AS (
  SELECT r, f, count(*) AS n FROM (
    SELECT r, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM split) GROUP BY ALL),
hexes AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM features)),
buckets AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
                            lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM hexes, crcs),
counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (r IS NOT NULL), 0) AS s, coalesce(sum(n) FILTER (r IS NULL), 0) AS t
  FROM features JOIN buckets USING (f) GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM counts),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (all_s + 10000) AS DOUBLE) / CAST((s + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM counts, totals),
weights AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight
  FROM features JOIN buckets USING (f) JOIN gains USING (bucket) WHERE r IS NOT NULL GROUP BY r),
scored AS (
  SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 8) AS BIGINT) + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
  FROM split LEFT JOIN weights USING (r) WHERE r IS NOT NULL),
able AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, weight DESC, n_features DESC) AS place, count(*) OVER () AS n
  FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN able USING (r)
"""

ORACLE_SQL: dict[str, str] = {"op7_bitsliced": OP7_SQL, "op9_minhash": OP9_SQL, "op12_manifest": OP12_SQL, "op13_resampling": OP13_SQL}
