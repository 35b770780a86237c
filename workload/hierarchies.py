"""Hierarchies: integrity, cycles, components, order, properties, synchronisation."""

from pyspark.sql import functions as F

from millrace.lineage import materialize
from millrace.operators.hierarchy import (
    apply_sync, ascend, asset_properties, change_counts, child_counts, children, components, cycle_members, cycles,
    delete_assets, diff, root_names, subtree, sync_plan, topological_rank, violation_report, violations,
)
from workload.mapping import ASSETS, FAULTY, assets, faulty_assets, map_text, table
from workload.registry import query

# Upwards reachability over distinct ids, blank parents cut.
_UP = f"""WITH RECURSIVE {FAULTY},
edge AS (SELECT external_id AS id, max(CASE WHEN trim(coalesce(parent_external_id, '')) <> '' THEN parent_external_id END) AS parent
         FROM faulty WHERE external_id IS NOT NULL GROUP BY 1),
step AS (SELECT e.id, e.parent FROM edge e JOIN edge p ON e.parent = p.id),
up AS (SELECT id, parent AS anc FROM step UNION SELECT u.id, s.parent FROM up u JOIN step s ON u.anc = s.id),
ring AS (SELECT id FROM up WHERE id = anc)
"""
_VIOLATIONS = _UP + """, found AS (
SELECT 'missing_external_id' AS rule, external_id FROM faulty WHERE external_id IS NULL
UNION ALL SELECT 'duplicate', external_id FROM faulty WHERE external_id IS NOT NULL GROUP BY external_id HAVING count(*) > 1
UNION ALL SELECT DISTINCT 'self_reference', external_id FROM faulty WHERE external_id = parent_external_id
UNION ALL SELECT 'cycle', id FROM ring
UNION ALL SELECT DISTINCT 'root_count', external_id FROM faulty WHERE external_id IS NOT NULL AND trim(coalesce(parent_external_id, '')) = ''
UNION ALL SELECT DISTINCT 'missing_parent', external_id FROM faulty
  WHERE external_id IS NOT NULL AND trim(coalesce(parent_external_id, '')) <> ''
    AND parent_external_id NOT IN (SELECT external_id FROM faulty WHERE external_id IS NOT NULL))
"""


@query("hierarchy_violations", _VIOLATIONS + "SELECT rule, external_id FROM found")
def hierarchy_violations(spark, sf):
    return violations(faulty_assets(spark, sf))


@query("hierarchy_violation_report", _VIOLATIONS + """
SELECT rule, count(*) AS violations, least(count(external_id), 5) AS listed, min(external_id) AS first_id FROM found GROUP BY rule""")
def hierarchy_violation_report(spark, sf):
    report = violation_report(violations(faulty_assets(spark, sf)), samples=5)
    return report.select("rule", "violations", F.size("samples").cast("long").alias("listed"),
                         F.get("samples", F.lit(0)).alias("first_id"))


@query("hierarchy_cycles", _UP + "SELECT id AS external_id FROM ring")
def hierarchy_cycles(spark, sf):
    return cycle_members(ascend(faulty_assets(spark, sf)))


@query("hierarchy_components", _UP + """
, ends AS (SELECT e.id, e.id AS top FROM edge e WHERE e.id NOT IN (SELECT id FROM step)
  UNION ALL SELECT u.id, u.anc FROM up u WHERE u.anc NOT IN (SELECT id FROM step)),
rings AS (SELECT u.id, min(u.anc) AS top FROM up u WHERE u.anc IN (SELECT id FROM ring) GROUP BY u.id)
SELECT id AS external_id, top AS component FROM ends UNION ALL SELECT id, top FROM rings""")
def hierarchy_components(spark, sf):
    return components(faulty_assets(spark, sf))


_DOWN = f"""WITH RECURSIVE {ASSETS},
walk AS (SELECT external_id, external_id AS root_external_id, CAST(0 AS BIGINT) AS depth, external_id AS path FROM assets WHERE parent_external_id IS NULL
         UNION ALL SELECT a.external_id, w.root_external_id, w.depth + 1, w.path || '/' || a.external_id
         FROM assets a JOIN walk w ON a.parent_external_id = w.external_id)
"""


@query("hierarchy_rank", _DOWN + "SELECT external_id, depth AS order_rank FROM walk")
def hierarchy_rank(spark, sf):
    return topological_rank(assets(spark, sf)).select("external_id", "order_rank")


@query("hierarchy_props", _DOWN + """
SELECT w.*, (SELECT count(*) FROM assets c WHERE c.parent_external_id = w.external_id) AS child_count FROM walk w""")
def hierarchy_props(spark, sf):
    return asset_properties(assets(spark, sf)).withColumn("path", F.array_join("path", "/"))


@query("hierarchy_root_names", f"WITH {ASSETS} SELECT external_id, 'ROOT' AS root_external_id, 'world' AS root_name FROM assets")
def hierarchy_root_names(spark, sf):
    return root_names(assets(spark, sf)).select("external_id", "root_external_id", "root_name")


@query("hierarchy_children", f"""WITH {FAULTY}
SELECT f.parent_external_id, f.external_id FROM faulty f
WHERE f.parent_external_id IN (SELECT external_id FROM faulty WHERE external_id IS NOT NULL)""")
def hierarchy_children(spark, sf):
    return children(faulty_assets(spark, sf))


@query("child_counts", f"""WITH {ASSETS}
SELECT parent_external_id AS external_id, count(*) AS child_count FROM assets WHERE parent_external_id IS NOT NULL GROUP BY 1""")
def child_count(spark, sf):
    return child_counts(assets(spark, sf))


@query("subtree_members", f"""WITH RECURSIVE {ASSETS},
sub AS (SELECT external_id FROM assets WHERE external_id IN ('R2', 'N3', 'C5')
        UNION SELECT a.external_id FROM assets a JOIN sub s ON a.parent_external_id = s.external_id)
SELECT external_id FROM sub""")
def subtree_members(spark, sf):
    return subtree(assets(spark, sf), ["R2", "N3", "C5"]).select("external_id")


@query("assets_delete_recursive", f"""WITH RECURSIVE {ASSETS},
sub AS (SELECT external_id FROM assets WHERE external_id IN ('R2', 'N3', 'C5')
        UNION SELECT a.external_id FROM assets a JOIN sub s ON a.parent_external_id = s.external_id)
SELECT external_id, name FROM assets WHERE external_id NOT IN (SELECT external_id FROM sub)""")
def assets_delete_recursive(spark, sf):
    gone = assets(spark, sf).where(F.col("external_id").isin("R2", "N3", "C5"))
    return delete_assets(assets(spark, sf), gone, recursive=True).select("external_id", "name")


# -------------------------------------------------------------- synchronisation

def _incoming(spark, sf):
    """The hierarchy without every 7th customer, every 5th renamed, and new children for every 11th."""
    base = assets(spark, sf)
    k = F.when(F.col("source") == "customer", F.col("id") - 10000)
    kept = base.where(k.isNull() | (k % 7 != 0)).withColumn(
        "name", F.when(k % 5 == 0, F.concat("name", F.lit(" *"))).otherwise(F.col("name")))
    added = base.where((k % 11 == 0) & (k % 7 != 0)).select(
        (F.col("id") + 500_000_000).alias("id"), F.concat("external_id", F.lit("-new")).alias("external_id"),
        F.col("external_id").alias("parent_external_id"), F.lit("new part").alias("name"), "description",
        F.lit("part").alias("source"), "metadata", "labels", "data_set_id")
    return kept.unionByName(added)


_PLAN = f"""WITH {ASSETS},
cust AS (SELECT *, id - 10000 AS k FROM assets WHERE source = 'customer'),
plan AS (
  SELECT external_id, 'unchanged' AS change, CASE source WHEN 'world' THEN 0 WHEN 'region' THEN 1 ELSE 2 END AS order_rank
  FROM assets WHERE source <> 'customer'
  UNION ALL SELECT external_id, CASE WHEN k % 7 = 0 THEN 'deleted' WHEN k % 5 = 0 THEN 'changed' ELSE 'unchanged' END,
                   CASE WHEN k % 7 = 0 THEN -3 ELSE 3 END FROM cust
  UNION ALL SELECT external_id || '-new', 'new', 4 FROM cust WHERE k % 11 = 0 AND k % 7 <> 0)
"""


@query("sync_plan", _PLAN + "SELECT external_id, 'ROOT' AS component, change, CAST(order_rank AS BIGINT) AS order_rank FROM plan")
def plan(spark, sf):
    return sync_plan(_incoming(spark, sf), assets(spark, sf))


@query("sync_change_counts", _PLAN + "SELECT change, count(*) AS n FROM plan GROUP BY 1")
def counts(spark, sf):
    return change_counts(sync_plan(_incoming(spark, sf), assets(spark, sf), verify=False, many=True))


@query("sync_applied", _PLAN + """
SELECT p.external_id, CASE WHEN p.change = 'new' THEN 'new part' WHEN p.change = 'changed' THEN a.name || ' *' ELSE a.name END AS name,
       'size=' || coalesce(a.size, c.size) AS metadata
FROM plan p LEFT JOIN assets a ON p.external_id = a.external_id
LEFT JOIN cust c ON p.external_id = c.external_id || '-new' WHERE p.change <> 'deleted'""")
def applied(spark, sf):
    existing, incoming = assets(spark, sf), _incoming(spark, sf)
    after = apply_sync(incoming, existing, materialize(sync_plan(incoming, existing, verify=False), "plan"))
    return after.select("external_id", "name", map_text(F.col("metadata")).alias("metadata"))


@query("change_detection", _PLAN + "SELECT external_id, change FROM plan")
def change_detection(spark, sf):
    return diff(_incoming(spark, sf), assets(spark, sf))


@query("sync_several_roots", f"""WITH {ASSETS},
cust AS (SELECT *, id - 10000 AS k FROM assets WHERE source = 'customer')
SELECT external_id, CASE WHEN k % 7 = 0 THEN 'deleted' WHEN k % 4 = 1 THEN 'changed' ELSE 'unchanged' END AS change FROM cust
UNION ALL SELECT external_id, CASE WHEN source = 'region' THEN 'changed' ELSE 'unchanged' END FROM assets WHERE source NOT IN ('customer', 'world')""")
def sync_several_roots(spark, sf):
    """Five hierarchies at once, one per region: customers vanish, and some move to the nation of another region."""
    base = assets(spark, sf).where("source <> 'world'")
    k = F.when(F.col("source") == "customer", F.col("id") - 10000)
    cut = base.withColumn("parent_external_id", F.when(F.col("source") != "region", F.col("parent_external_id")))
    other = F.when(F.col("parent_external_id") == "N0", "N1").otherwise("N0")
    incoming = cut.where(k.isNull() | (k % 7 != 0)).withColumn(
        "parent_external_id", F.when(k % 4 == 1, other).otherwise(F.col("parent_external_id"))).withColumn(
        "name", F.when(F.col("source") == "region", F.concat("name", F.lit(" *"))).otherwise(F.col("name")))
    return sync_plan(incoming, cut, many=True).select("external_id", "change")


_PARENTS = """n AS (SELECT c_custkey AS k FROM customer), top AS (SELECT max(k) AS m FROM n),
e AS (SELECT k AS id, k // 2 AS parent FROM n WHERE k % 2 = 0
      UNION SELECT k, k + 1 FROM n, top WHERE k % 16 = 0 AND k < m
      UNION SELECT k, 4 * k FROM n, top WHERE k % 50 = 25 AND 4 * k <= m
      UNION SELECT k, 2 * k FROM n, top WHERE k % 30 = 0 AND 2 * k <= m),
up AS (SELECT id AS a, parent AS b FROM e UNION SELECT up.a, e.parent FROM up JOIN e ON e.id = up.b),
ring AS (SELECT DISTINCT a AS k FROM up WHERE a = b)"""


def _several(spark, sf):
    """Binary trees over the customers; some ids have a second parent in another tree, some one below themselves."""
    k = F.col("c_custkey")
    ids = table(spark, sf, "customer").select("c_custkey")
    most = ids.agg(F.max("c_custkey")).first()[0]
    parents = F.array_compact(F.array(
        F.when(k % 2 == 0, F.floor(k / 2)), F.when((k % 16 == 0) & (k < most), k + 1),
        F.when((k % 50 == 25) & (4 * k <= most), 4 * k), F.when((k % 30 == 0) & (2 * k <= most), 2 * k)))
    return ids.select(k.cast("string").alias("external_id"), F.explode_outer(parents.cast("array<string>")).alias("parent_external_id"))


@query("hierarchy_several_parents", f"""WITH RECURSIVE {_PARENTS},
und AS (SELECT id AS a, parent AS b FROM e UNION SELECT parent, id FROM e),
reach AS (SELECT k AS a, k AS b FROM n UNION SELECT r.a, u.b FROM reach r JOIN und u ON u.a = r.b)
SELECT CAST(a AS VARCHAR) AS external_id, coalesce(
         min(CASE WHEN b NOT IN (SELECT id FROM e) THEN CAST(b AS VARCHAR) END),
         min(CASE WHEN b IN (SELECT k FROM ring) THEN CAST(b AS VARCHAR) END)) AS component FROM reach GROUP BY a""")
def hierarchy_several_parents(spark, sf):
    return components(_several(spark, sf))


@query("hierarchy_several_parents_cycles", f"WITH RECURSIVE {_PARENTS} SELECT CAST(k AS VARCHAR) AS external_id FROM ring")
def hierarchy_several_parents_cycles(spark, sf):
    return cycles(_several(spark, sf))
