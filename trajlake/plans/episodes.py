"""Queries on episodes, their parts, and work in progress."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.functions import text as X
from trajlake.operators import assembly as A
from trajlake.operators import trajectory as T
from trajlake.plans.catalog import query, table
from trajlake.sources.testbed import STEPS, steps

_PARTS = """cand AS (SELECT o_orderkey AS traj, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_custkey AS BIGINT) END AS goal, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderkey % 5 END AS start, CASE o_orderkey % 2 WHEN 0 THEN 'fine' ELSE 'coarse' END AS split_type FROM orders),
li AS (SELECT l_orderkey AS traj, count(*) AS n, count(*) FILTER (WHERE l_linenumber < 6) AS few FROM lineitem GROUP BY l_orderkey),
fine AS (SELECT o_orderkey AS traj, 'f' || o_orderpriority AS t FROM orders WHERE o_orderkey % 7 <> 0),
coarse AS (SELECT c_custkey AS goal, 'c' || c_mktsegment AS t FROM customer WHERE c_custkey % 9 <> 0),
a AS (SELECT cand.*, li.n AS n_actions, CASE WHEN cand.traj % 11 <> 0 THEN li.n END AS n_path, CASE WHEN cand.traj % 13 <> 0 THEN li.few END AS n_rgb, li.few AS n_depth,
  CASE split_type WHEN 'fine' THEN fine.t ELSE coarse.t END AS instruction, cand.traj % 3 = 0 AS marked
  FROM cand LEFT JOIN li USING (traj) LEFT JOIN fine USING (traj) LEFT JOIN coarse USING (goal)),
assembled AS (SELECT *, CASE WHEN goal IS NULL OR start IS NULL THEN 'malformed_name' WHEN n_actions IS NULL THEN 'missing_actions' WHEN n_path IS NULL THEN 'missing_path' WHEN n_rgb IS NULL OR n_depth IS NULL THEN 'missing_frames'
  WHEN n_actions <> n_path OR n_path <> n_rgb OR n_rgb <> n_depth THEN 'length_mismatch' WHEN n_path < 2 THEN 'too_short' WHEN instruction IS NULL THEN 'missing_' || split_type END AS reason FROM a)"""


def _assembled(spark, sf_dir):
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    k = F.col("o_orderkey")
    named = F.when(k % 17 != 0, F.lit(True))
    cand = o.select(k.alias("traj"), F.when(named, F.col("o_custkey")).alias("goal"), F.when(named, k % 5).alias("start"), F.when(k % 2 == 0, "fine").otherwise("coarse").alias("split_type"))
    n = li.groupBy(F.col("l_orderkey").alias("traj")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_linenumber") < 6).alias("few"))
    frames = n.select("traj", F.when(F.col("traj") % 13 != 0, F.col("few")).alias("n_rgb"), F.col("few").alias("n_depth"))
    fine = o.where(k % 7 != 0).select(k.alias("traj"), F.concat(F.lit("f"), "o_orderpriority").alias("fine_text"))
    coarse = table(spark, sf_dir, "customer").where("c_custkey % 9 <> 0").select(F.col("c_custkey").alias("goal"), F.concat(F.lit("c"), "c_mktsegment").alias("coarse_text"))
    return A.assemble(cand, n.select("traj", F.col("n").alias("n_actions")), n.where("traj % 11 <> 0").select("traj", F.col("n").alias("n_path")), frames, fine, coarse, o.where(k % 3 == 0).select(k.alias("traj")))


@query("episodes", f"WITH {_PARTS} SELECT traj, goal, start, split_type, n_path AS n_steps, instruction, CASE WHEN marked THEN 'success' ELSE 'unknown' END AS finish_status, CASE WHEN NOT marked THEN 'unknown' END AS fail_reason FROM assembled WHERE reason IS NULL")
def episodes(spark, sf_dir):
    return A.split_quarantine(_assembled(spark, sf_dir))[0]


@query("quarantine", f"WITH {_PARTS} SELECT traj, goal, start, reason FROM assembled WHERE reason IS NOT NULL")
def quarantine(spark, sf_dir):
    return A.split_quarantine(_assembled(spark, sf_dir))[1]


@query("manifest", f"""WITH {_PARTS} SELECT 'scene_' || goal || '_' || start AS episode_id, '{{"instruction_text":"' || instruction || '","steps":' || n_path || '}}' AS doc FROM assembled WHERE reason IS NULL""")
def manifest(spark, sf_dir):
    """Episodes as JSON documents."""
    e = A.split_quarantine(_assembled(spark, sf_dir))[0]
    return e.select(X.episode_id(F.lit("scene"), F.col("goal"), F.col("start")).alias("episode_id"), F.to_json(F.struct(F.col("instruction").alias("instruction_text"), F.col("n_steps").alias("steps"))).alias("doc"))


@query(
    "episode_rows",
    f"""WITH {STEPS} SELECT traj, x AS camera_x, y AS camera_y, round(coalesce(step / nullif(count(*) OVER (PARTITION BY traj) - 1, 0), 0), 6) AS progress, step AS "observation_step", CAST(action AS BIGINT) AS "observation_action", step AS frame_index, dense_rank() OVER (ORDER BY traj) - 1 AS episode_index FROM steps""",
)
def episode_rows(spark, sf_dir):
    """The columns of the final step table. Episodes are numbered over the distinct trajectories, a narrow table."""
    from pyspark.sql import Window

    s = T.progress(steps(spark, sf_dir))
    ids = s.select("traj").distinct().withColumn("episode_index", (F.row_number().over(Window.orderBy("traj")) - 1).cast("long"))
    return s.join(ids, "traj").select("traj", F.col("x").alias("camera_x"), F.col("y").alias("camera_y"), F.round("progress", 6).alias("progress"), F.col("step").alias("observation_step"), F.col("action").cast("long").alias("observation_action"), F.col("step").alias("frame_index"), "episode_index")


@query("depth_normalised", "WITH v AS (SELECT event_id, user_id, CASE event_id % 50 WHEN 0 THEN 10.0::DOUBLE WHEN 1 THEN 10.0 WHEN 2 THEN 0.0 ELSE CASE WHEN user_id % 2 = 0 THEN value ELSE value % 1 END END AS d FROM events), t AS (SELECT *, max(d) OVER (PARTITION BY user_id) AS top FROM v) SELECT event_id, round(CASE WHEN top > 1 THEN d / 100 ELSE d END, 6) AS depth, CAST(floor(greatest(least(d, 10), 0) / 10 * 255) AS INTEGER) AS byte FROM t")
def depth_normalised(spark, sf_dir):
    e, k = table(spark, sf_dir, "events"), F.col("event_id") % 50
    v = F.when(k == 0, float("nan")).when(k == 1, float("inf")).when(k == 2, float("-inf")).otherwise(F.when(F.col("user_id") % 2 == 0, F.col("value")).otherwise(F.col("value") % 1))
    e = e.select("event_id", "user_id", v.alias("depth"), F.when(k < 2, 10.0).when(k == 2, 0.0).otherwise(v).alias("d"))
    return A.normalise_depth(e, "user_id").select("event_id", F.round("depth", 6).alias("depth"), A.depth_to_byte(F.col("d")).alias("byte"))


@query("image_quality", "SELECT user_id, round(avg(value % 256), 4) AS mean, round(stddev_pop(value % 256), 4) AS std, stddev_pop(value % 256) < 70 OR avg(value % 256) > 245 AS problematic FROM events GROUP BY user_id")
def image_quality(spark, sf_dir):
    p = table(spark, sf_dir, "events").select("user_id", (F.col("value") % 256).alias("v"))
    q = A.image_quality(p, "user_id", least_std=70.0)
    return q.select("user_id", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "problematic")


_STATE = """state AS (SELECT c_custkey AS task, CASE WHEN c_custkey % 4 = 0 THEN 'done' ELSE 'open' END AS status, CAST(c_custkey % 7 AS INTEGER) AS attempts FROM customer WHERE c_custkey % 3 <> 0)"""


def _state(spark, sf_dir):
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").where(k % 3 != 0).select(k.alias("task"), F.when(k % 4 == 0, "done").otherwise("open").alias("status"), (k % 7).cast("int").alias("attempts"))


@query("pending_tasks", f"WITH {_STATE} SELECT c_custkey AS task, coalesce(attempts, 0) AS attempts FROM customer LEFT JOIN state ON task = c_custkey WHERE coalesce(status, '') <> 'done' AND coalesce(attempts, 0) < 5")
def pending_tasks(spark, sf_dir):
    return A.pending(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("task")), _state(spark, sf_dir), "task")


@query(
    "task_states",
    f"""WITH {_STATE}, o AS (SELECT c_custkey AS task, CASE c_custkey % 4 WHEN 0 THEN 'done' WHEN 1 THEN 'error' WHEN 2 THEN 'timeout' ELSE 'missing' END AS outcome FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 5 = 0)
SELECT coalesce(s.task, o.task) AS task, CASE WHEN outcome = 'done' THEN 'done' ELSE coalesce(status, 'open') END AS status,
  CAST(CASE WHEN outcome = 'timeout' THEN 999 WHEN outcome IN ('error', 'missing') THEN coalesce(attempts, 0) + 1 ELSE coalesce(attempts, 0) END AS INTEGER) AS attempts FROM state s FULL JOIN o ON s.task = o.task""",
)
def task_states(spark, sf_dir):
    k = F.col("c_custkey")
    o = table(spark, sf_dir, "customer").where((k % 2 == 0) | (k % 5 == 0)).select(k.alias("task"), F.when(k % 4 == 0, "done").when(k % 4 == 1, "error").when(k % 4 == 2, "timeout").otherwise("missing").alias("outcome"))
    return A.advance(_state(spark, sf_dir), o, "task")


@query(
    "upserted",
    """WITH o AS (SELECT doc_id AS id, lang AS v FROM documents WHERE doc_id % 3 <> 0), n AS (SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'q' || quality END AS v FROM labels)
SELECT coalesce(o.id, n.id) AS id, coalesce(n.v, o.v) AS v FROM o FULL JOIN n ON o.id = n.id""",
)
def upserted(spark, sf_dir):
    """Old entries under new ones, complete ones first."""
    o = table(spark, sf_dir, "documents").where("doc_id % 3 <> 0").select(F.col("doc_id").alias("id"), F.col("lang").alias("v"))
    n = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "q1").alias("v"))
    return A.upsert(o, n, "id", ["v"], F.col("v").isNotNull())


@query("resume_anti", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_anti(spark, sf_dir):
    """What has no output yet."""
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti")


@query("trainval_only", "SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey % 3 = 0")
def trainval_only(spark, sf_dir):
    """Rows of the scenes of one split."""
    split = table(spark, sf_dir, "customer").where("c_nationkey % 3 = 0").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf_dir, "orders").join(split, "o_custkey", "left_semi").select("o_orderkey")


@query("instruction_override", "WITH keys AS (SELECT DISTINCT conv_id FROM conversations WHERE role = 'assistant') SELECT conv_id, 'file' AS origin FROM keys UNION ALL SELECT DISTINCT user_id, 'listing' FROM events WHERE NOT EXISTS (SELECT 1 FROM keys)")
def instruction_override(spark, sf_dir):
    """Candidates come from the instruction file if there is one, else from the listing."""
    keys = table(spark, sf_dir, "conversations").where("role = 'assistant'").select("conv_id").distinct()
    some = keys.limit(1).select(F.lit(1).alias("one"))
    listing = table(spark, sf_dir, "events").select(F.col("user_id").alias("conv_id")).distinct().join(some, how="left_anti")
    return keys.select("conv_id", F.lit("file").alias("origin")).unionByName(listing.select("conv_id", F.lit("listing").alias("origin")))


@query("typed_fields", "SELECT count(*) FILTER (WHERE text IS NOT NULL AND length(text) > 0 AND lang IS NOT NULL) AS complete, count(*) AS n FROM documents")
def typed_fields(spark, sf_dir):
    ok = F.col("text").isNotNull() & (F.length("text") > 0) & F.col("lang").isNotNull()
    return table(spark, sf_dir, "documents").agg(F.count_if(ok).alias("complete"), F.count(F.lit(1)).alias("n"))
