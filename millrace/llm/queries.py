"""The numbered queries over the whole test tables, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import archives, contamination, debruijn, forest, language, lexical, linequality, mixing, pii, suffix, toxicity, whitening
from millrace.llm.frames import table
from millrace.llm.minhash import near_duplicates

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query("op10_minhash_near_dedup", rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_SPACED}) AS l FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, unnest(CASE WHEN len(l) >= 5 THEN list_transform(range(1, len(l) - 3), lambda i: array_to_string(l[i:i + 4], ' '))
                             WHEN len(l) > 0 THEN [array_to_string(l, ' ')] ELSE [] END) AS s FROM w)),
size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id
           GROUP BY x.doc_id, y.doc_id),
link AS (SELECT a, b FROM shared JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
         WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(size.n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(low.b, w.doc_id)) AS component_id,
       w.doc_id = least(w.doc_id, coalesce(low.b, w.doc_id)) AS kept
FROM w LEFT JOIN size ON size.doc_id = w.doc_id LEFT JOIN low ON low.a = w.doc_id
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85).drop("text_hash")


@query("op3_suffix_array_dedup", r"""
WITH b AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
e AS (SELECT doc_id, i, substr(x, 2 * i + 1, 2) AS byte,
             CASE WHEN 2 * (i + 200) <= length(x) THEN md5(substr(x, 2 * i + 1, 400)) END AS g
      FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2)) AS i FROM b)),
c AS (SELECT g FROM e WHERE g IS NOT NULL GROUP BY g HAVING count(*) > 1),
m AS (SELECT e.doc_id, e.i, e.byte, max(CASE WHEN c.g IS NULL THEN 0 ELSE 1 END) OVER (
        PARTITION BY e.doc_id ORDER BY e.i ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS gone
      FROM e LEFT JOIN c ON e.g = c.g),
r AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM m),
a AS (SELECT doc_id, sum(gone) AS n_removed, sum(CASE WHEN gone = 1 AND before = 0 THEN 1 ELSE 0 END) AS n_spans,
             string_agg(byte, '' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM r GROUP BY doc_id)
SELECT b.doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM b LEFT JOIN a ON a.doc_id = b.doc_id
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_substring_dedup", rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACED}) AS l FROM documents),
e AS (SELECT doc_id, i, l[i] AS word, CASE WHEN i + 34 <= len(l) THEN md5(array_to_string(l[i:i + 34], ' ')) END AS g
      FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM w)),
c AS (SELECT g FROM e WHERE g IS NOT NULL GROUP BY g HAVING count(*) > 1),
m AS (SELECT e.doc_id, e.i, e.word, max(CASE WHEN c.g IS NULL THEN 0 ELSE 1 END) OVER (
        PARTITION BY e.doc_id ORDER BY e.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
      FROM e LEFT JOIN c ON e.g = c.g),
a AS (SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept
      FROM m GROUP BY doc_id)
SELECT w.doc_id, len(l)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN a ON a.doc_id = w.doc_id
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    return debruijn.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", gone.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


@query("op1_benchmark_decontamination", rf"""
WITH w AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS l FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS l FROM benchmark WHERE item_id IS NOT NULL),
s AS (SELECT item_id, least(len(l), 10) AS k, array_to_string(l[i:i + least(len(l), 10) - 1], ' ') AS g
      FROM (SELECT item_id, l, unnest(range(1, greatest(len(l) - 10, 0) + 2)) AS i FROM b WHERE len(l) > 0)),
k AS (SELECT DISTINCT k FROM s),
d AS (SELECT doc_id, i, k, array_to_string(l[i:i + k - 1], ' ') AS g FROM (
        SELECT doc_id, l, k, unnest(range(1, len(l) - k + 2)) AS i FROM w, k WHERE len(l) >= k)),
o AS (SELECT DISTINCT d.doc_id, d.i, d.k, s.item_id FROM d JOIN s ON s.k = d.k AND s.g = d.g),
h AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT doc_id, i, unnest(range(0, k)) AS j FROM o) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM o) GROUP BY doc_id)
SELECT w.doc_id, len(l)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
       sha256(coalesce(t.items, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM w LEFT JOIN h ON h.doc_id = w.doc_id LEFT JOIN t ON t.doc_id = w.doc_id
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    names = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


@query("op7_mixing_sources", rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_SPACED}))::BIGINT AS size,
                  (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'text ' || md5(coalesce(text, '')))), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS w FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (
          ORDER BY source_size / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) /
        (sum(w) OVER () - coalesce(sum(w) OVER (
          ORDER BY source_size / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level FROM w),
f AS (SELECT *, first_value(CASE WHEN level * w <= 2.0::DOUBLE * source_size THEN level END IGNORE NULLS) OVER (
          ORDER BY source_size / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv FROM l),
t AS (SELECT source, source_size, coalesce(lv * w, 2.0::DOUBLE * source_size) AS target FROM f),
g AS (SELECT source, sum(size * floor(sqrt(size))) AS weighty FROM d GROUP BY source),
r AS (SELECT d.doc_id, d.size, d.u, t.source, t.source_size, t.target, g.weighty,
             CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
             CASE WHEN source_size > 0 THEN target / source_size - floor(target / source_size) ELSE 0.0 END AS part
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source JOIN g ON d.source IS NOT DISTINCT FROM g.source),
p AS (SELECT *, round(part * source_size, 6) AS rest,
             CASE WHEN weighty > 0 THEN part * floor(sqrt(size)) * source_size / weighty ELSE 0.0 END AS p FROM r),
o AS (SELECT *, CASE WHEN p >= 1 THEN 0.0::DOUBLE WHEN p > 0 THEN u / (1 - u) * ((1 - p) / p) END AS odds FROM p),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY odds NULLS LAST, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS run FROM o)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN run < rest AND 2 * run + size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM c
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def _remainder(divisor: int):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % divisor


def toxicity_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labels that may be learned from."""
    return table(spark, sf_dir, "labels").where(_remainder(4) != 2).select("doc_id", F.col("toxic").alias("label"))


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, toxicity_labels(spark, sf_dir))
    return toxicity.score(docs, model).select(
        "doc_id", (_remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"))


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(_remainder(5) != 0))
    return language.predict(docs, model).select("doc_id", (_remainder(5) == 0).alias("held_out"), "lang_pred", "score")


@query("op8_ann_forest")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return forest.nearest(rows, rows.where(F.col("vec_id") % 100 == 0))


@query("op9_warc_zip", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS payload_digest FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM g
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = archives.write_archives(table(spark, sf_dir, "pages"))
    return archives.read_archives(manifest, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op2_pii_candidates")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    count = lambda i: F.size(F.filter("base_spans", lambda x: x["kind"] == i)).cast("long")
    return found.select("doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)),
                        F.sha2(pii.listed(F.col("base_spans")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return whitening.whiten(rows, whitening.fit(rows))


@query("op13_quality_lines")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(_remainder(5) != 0).select("doc_id", F.col("quality").alias("label"))
    return linequality.score(docs, linequality.fit(docs, labels)).select(
        "doc_id", (_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_lines")


_TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"


@query("op11_lexical_strata", rf"""
WITH w AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_LOWER}, {_TERMS}) AS l FROM documents),
d AS (SELECT k, doc_id, len(l)::BIGINT AS n FROM w WHERE len(l) > 0),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM d),
t AS (SELECT k, term, count(*)::BIGINT AS tf FROM (SELECT k, unnest(l) AS term FROM w) GROUP BY k, term),
f AS (SELECT term, count(*)::BIGINT AS df FROM t GROUP BY term),
q AS (SELECT item_id, term, count(*)::BIGINT AS n FROM (
        SELECT item_id, unnest(regexp_extract_all({_LOWER}, {_TERMS})) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL)) GROUP BY item_id, term),
g AS (SELECT item_id, q.term, q.n * floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM q JOIN f ON f.term = q.term, c),
s AS (SELECT item_id, t.k, d.doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * d.n * docs) // total))))::BIGINT AS score
      FROM g JOIN t ON t.term = g.term JOIN d ON d.k = t.k, c GROUP BY item_id, t.k, d.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 10
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))
