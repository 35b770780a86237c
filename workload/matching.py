"""Entity matching and text annotation."""

from pyspark.sql import Window, functions as F

from millrace.operators.annotate import annotation_entities, detect_annotations
from millrace.operators.match import MatchModel, fit_supervised, match_pairs, match_results, predict_supervised
from workload.mapping import table
from workload.registry import query


def _parts(spark, sf):
    """Targets: all parts under composed names. Sources: the same names respelled."""
    key = F.col("p_partkey").cast("string")
    dashed = F.concat_ws("-", "p_brand", F.regexp_replace("p_name", " ", "-"), key)
    parts = table(spark, sf, "part")
    targets = parts.select(F.col("p_partkey").alias("id"), dashed.alias("name"))
    respelled = F.concat_ws("_", F.lower("p_brand"), F.upper(F.regexp_replace("p_name", " ", "_")), key, F.lit("x"))
    sources = parts.select(F.col("p_partkey").alias("id"), respelled.alias("name"))
    return sources, targets


def _cosine(weight: str) -> str:
    """All pairs that share a token, scored and ranked: brute force."""
    return f"""WITH t AS (SELECT p_partkey AS id, lower(p_brand || '-' || replace(p_name, ' ', '-') || '-' || p_partkey) AS name FROM part),
s AS (SELECT id, name || '-x' AS name FROM t),
tt AS (SELECT id, token, count(*) AS c FROM (SELECT id, unnest(regexp_extract_all(name, '[a-z]+|[0-9]+')) AS token FROM t) GROUP BY ALL),
st AS (SELECT id, token, count(*) AS c FROM (SELECT id, unnest(regexp_extract_all(name, '[a-z]+|[0-9]+')) AS token FROM s) GROUP BY ALL),
tn AS (SELECT id, sqrt(sum(c * c)) AS n FROM tt GROUP BY id), sn AS (SELECT id, sqrt(sum(c * c)) AS n FROM st GROUP BY id),
pairs AS (SELECT st.id AS source_id, tt.id AS target_id, sum(st.c * tt.c) AS dot FROM st JOIN tt USING (token) GROUP BY ALL),
scored AS (SELECT source_id, target_id, round(dot / (sn.n * tn.n), 6) AS score FROM pairs JOIN sn ON sn.id = source_id JOIN tn ON tn.id = target_id)
SELECT source_id, target_id, score, row_number() OVER (PARTITION BY source_id ORDER BY score DESC, target_id) AS rank
FROM scored QUALIFY rank <= {weight}"""


@query("entity_match_topk", _cosine("2"))
def entity_match_topk(spark, sf):
    sources, targets = _parts(spark, sf)
    pairs = match_pairs(sources, targets, MatchModel(("name",), ("name",), "insensitive"), num_matches=2)
    return pairs.select("source_id", "target_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


@query("entity_match_results", """
SELECT p_partkey AS source_id, p_partkey AS best_target, CAST(1 AS BIGINT) AS n FROM part""")
def entity_match_results(spark, sf):
    sources, targets = _parts(spark, sf)
    pairs = match_pairs(sources, targets, MatchModel(("name",), ("name",), "bigramextratokenizers"), score_threshold=0.5)
    results = match_results(sources, pairs)
    return results.select("source_id", F.get("matches", F.lit(0))["target_id"].alias("best_target"),
                          F.size("matches").cast("long").alias("n"))


@query("entity_match_supervised")
def entity_match_supervised(spark, sf):
    sources, targets = _parts(spark, sf)
    truth = sources.select(F.col("id").alias("source_id"), F.col("id").alias("target_id")).where("source_id % 10 = 0")
    model = MatchModel(("name",), ("name",))
    fitted = fit_supervised(sources, targets, truth, model)
    return predict_supervised(fitted, sources, targets, model)


def _entities(spark, sf):
    """Every sentence of every benchmark text as a searchable name, of two to dozens of words."""
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("entity_id"), F.explode(F.split("text", "[.!?\n]")).alias("name"))


_TOKENS = r"(\p{L}+|\p{N}+)"
_FOLDED = f"list_transform(regexp_extract_all(%s, '{_TOKENS}'), lambda x: lower(x))"
_NAMES = f"""ent AS (
  SELECT item_id AS entity_id, {_FOLDED % 's'} AS toks
  FROM (SELECT item_id, unnest(regexp_split_to_array(text, '[.!?\n]')) AS s FROM benchmark)),
names AS (SELECT DISTINCT toks, array_to_string(toks, ' ') AS name_key, len(toks) AS n FROM ent WHERE len(toks) >= 2),
doc AS (SELECT row_number() OVER () AS d, doc_id, text, {_FOLDED % 'text'} AS l FROM documents),
place AS (SELECT d, l, unnest(range(1, len(l))) AS i FROM doc),
spot AS (SELECT d, i, l[i] || ' ' || l[i + 1] AS pair FROM place)"""
_HITS = f"""WITH {_NAMES},
hit AS (SELECT doc_id, text, i, name_key, n, regexp_extract_all(text, '{_TOKENS}') AS t, regexp_split_to_array(text, '{_TOKENS}') AS g
        FROM spot JOIN names ON pair = toks[1] || ' ' || toks[2] JOIN doc USING (d) WHERE l[i:i + n - 1] = toks),
placed AS (SELECT *, coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
                   + coalesce(list_sum(list_transform(t[1:i - 1], lambda x: length(x))), 0) AS start,
                  list_sum(list_transform(t[i:i + n - 1], lambda x: length(x)))
                   + list_sum(list_transform(g[i + 1:i + n - 1], lambda x: length(x))) AS span FROM hit)
"""


@query("annotate_text", _HITS + """
SELECT doc_id, CAST(start AS BIGINT) AS start, CAST(start + span AS BIGINT) AS stop,
       substring(text, CAST(start AS BIGINT) + 1, CAST(span AS BIGINT)) AS text, name_key FROM placed""")
def annotate_text(spark, sf):
    hits = detect_annotations(table(spark, sf, "documents"), _entities(spark, sf), "name")
    return hits.select("doc_id", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), "text", "name_key")


@query("annotate_entities", _HITS + """
SELECT e.entity_id, count(*) AS hits, count(DISTINCT doc_id) AS documents FROM placed p JOIN ent e ON array_to_string(e.toks, ' ') = p.name_key GROUP BY 1""")
def annotate_entities(spark, sf):
    entities = _entities(spark, sf)
    hits = detect_annotations(table(spark, sf, "documents"), entities, "name")
    return annotation_entities(hits, entities, "name").groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("hits"), F.countDistinct("doc_id").alias("documents"))


@query("annotate_partial", f"""WITH {_NAMES},
size AS (SELECT *, unnest(range(2, n)) AS m FROM names),
part AS (SELECT *, unnest(range(1, n - m + 2)) AS k FROM size),
run AS (SELECT DISTINCT name_key, n, m, toks[k:k + m - 1] AS r FROM part),
single AS (SELECT r, any_value(m) AS m, any_value(name_key) AS name_key, any_value(n) AS n FROM run GROUP BY r HAVING count(*) = 1),
searched AS (SELECT toks AS r, n AS m, name_key, 1.0::DOUBLE AS confidence FROM names
  UNION ALL SELECT r, m, name_key, m / n FROM single WHERE r NOT IN (SELECT toks FROM names)),
found AS (SELECT d, doc_id, i, i + m AS stop, name_key, confidence
  FROM spot JOIN searched ON pair = r[1] || ' ' || r[2] JOIN doc USING (d) WHERE l[i:i + m - 1] = r)
SELECT doc_id, name_key, round(confidence, 6) AS confidence, count(*) AS n FROM (
  SELECT *, max(stop) OVER (PARTITION BY d, name_key ORDER BY i, stop DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM found)
WHERE reach IS NULL OR stop > reach GROUP BY ALL""")
def annotate_partial(spark, sf):
    hits = detect_annotations(table(spark, sf, "documents"), _entities(spark, sf), "name", partial_match=True)
    return hits.groupBy("doc_id", "name_key", F.round("confidence", 6).alias("confidence")).agg(F.count(F.lit(1)).alias("n"))


@query("entity_match_supervised_best", """
SELECT p_partkey AS source_id, p_partkey AS target_id FROM part""")
def entity_match_supervised_best(spark, sf):
    """The best target of every source; the planted answer is the part of the same key."""
    predicted = entity_match_supervised(spark, sf)
    order = Window.partitionBy("source_id").orderBy(F.desc("score"), "target_id")
    return predicted.withColumn("n", F.row_number().over(order)).where("n = 1").select("source_id", "target_id")
