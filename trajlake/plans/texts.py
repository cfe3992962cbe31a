"""Queries on names, identifiers, sentences and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajlake.functions import text as X
from trajlake.operators import instructions as I
from trajlake.operators import sampling as S
from trajlake.operators.ranking import places
from trajlake.plans.catalog import ORACLES, query, table
from trajlake.sources.testbed import OBJECTS, objects

_NAMES = "SELECT p_partkey AS k, replace(p_name, ' ', '_') || '_' || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') || '/m' AS id FROM part"


def _names(spark, sf_dir):
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(k.alias("k"), F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_"), F.lpad((k % 10000).cast("string"), 4, "0"), F.lit("/m")).alias("id"))


@query(
    "names",
    f"""WITH n AS ({_NAMES}) SELECT k, regexp_replace(id, '_[0-9]+/m$', '') || CASE WHEN regexp_matches(id, '_[0-9]+$') THEN '' ELSE '_' || split_part(id, '_', 3) END AS object_type,
  replace(regexp_extract(id, '^([a-zA-Z_]+)(_[0-9]+)?(/.*)?', 1), '_', ' ') AS raw_name, split_part(id, '_', 1) AS coarse,
  CASE WHEN length(left(id, -2)) > 5 AND left(right(left(id, -2), 5), 1) = '_' THEN left(left(id, -2), -5) ELSE left(id, -2) END AS bare FROM n""",
)
def names(spark, sf_dir):
    """Parts of object ids by each of the rules."""
    n = _names(spark, sf_dir)
    no_mesh = F.left("id", F.length("id") - 2)
    raw = F.translate(F.regexp_extract("id", r"^([a-zA-Z_]+)(_\d+)?(/.*)?", 1), "_", " ")
    return n.select("k", X.object_type(F.col("id")).alias("object_type"), raw.alias("raw_name"), F.split_part("id", F.lit("_"), F.lit(1)).alias("coarse"), X.strip_number(no_mesh).alias("bare"))


@query("object_names", f"WITH n AS ({_NAMES}) SELECT k, trim(replace(regexp_extract(id, '^([a-zA-Z_]+)(_[0-9]+)?(/.*)?', 1), '_', ' ')) AS name FROM n")
def object_names(spark, sf_dir):
    return _names(spark, sf_dir).select("k", X.object_name(F.col("id")).alias("name"))


@query("clean_names", f"WITH n AS ({_NAMES}) SELECT k, replace(replace(replace(replace(replace(lower(id), '_0000', ''), '_000', ''), '_00', ''), '_0', ''), '_', ' ') AS name FROM n")
def clean_names(spark, sf_dir):
    return _names(spark, sf_dir).select("k", X.clean_name(F.col("id")).alias("name"))


@query(
    "natural_sort",
    "WITH n AS (SELECT event_id, 'rgb_' || CAST(event_id % 1000 AS VARCHAR) || '_' || CAST(user_id AS VARCHAR) || '.png' AS name FROM events) SELECT event_id, row_number() OVER (ORDER BY event_id % 1000, CAST(split_part(split_part(name, '_', 3), '.', 1) AS BIGINT), event_id) AS place FROM n",
)
def natural_sort(spark, sf_dir):
    """All frames in natural order of their names."""
    n = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("rgb_"), (F.col("event_id") % 1000).cast("string"), F.lit("_"), F.col("user_id").cast("string"), F.lit(".png")).alias("name"))
    return places(n.select("event_id", X.natural_key(F.col("name")).alias("k")), ["k", "event_id"]).select("event_id", "place")


_PATHS = """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'path_' || event_id || '_x' WHEN 1 THEN 'path_1_2_' || event_id ELSE 'path_' || (event_id % 40) || '_' || user_id END AS name FROM events"""


def _paths(spark, sf_dir):
    e, u = F.col("event_id"), F.col("user_id").cast("string")
    name = F.when(e % 5 == 0, F.concat(F.lit("path_"), e.cast("string"), F.lit("_x"))).when(e % 5 == 1, F.concat(F.lit("path_1_2_"), e.cast("string"))).otherwise(F.concat(F.lit("path_"), (e % 40).cast("string"), F.lit("_"), u))
    return table(spark, sf_dir, "events").select("event_id", name.alias("name"))


@query(
    "path_ids",
    f"""WITH p AS ({_PATHS}), s AS (SELECT *, string_split(name, '_') AS a FROM p), c AS (SELECT *, TRY_CAST(a[2] AS INTEGER) AS g, TRY_CAST(a[3] AS INTEGER) AS t FROM s)
SELECT event_id, CASE WHEN len(a) = 3 AND g IS NOT NULL AND t IS NOT NULL THEN g END AS goal, CASE WHEN len(a) = 3 AND g IS NOT NULL AND t IS NOT NULL THEN t END AS start,
  coalesce(TRY_CAST(regexp_extract(name, '^.*?_([0-9]+)_([0-9]+)', 1) AS INTEGER), -1) AS loose_goal FROM c""",
)
def path_ids(spark, sf_dir):
    """Goal and start of path names, strictly and loosely."""
    p = _paths(spark, sf_dir).select("event_id", X.path_ids(F.col("name")).alias("p"), X.goal_of(F.col("name")).alias("loose_goal"))
    return p.select("event_id", "p.goal", "p.start", "loose_goal")


@query(
    "relation_words",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, CASE WHEN l_returnflag = 'A' THEN 'near' ELSE split_part(l_returnflag || '/' || l_linestatus, '/', 1) END AS word FROM lineitem GROUP BY ALL",
)
def relation_words(spark, sf_dir):
    rel = F.when(F.col("l_returnflag") == "A", "out of").otherwise(F.concat_ws("/", "l_returnflag", "l_linestatus"))
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n")).withColumn("word", X.relation_word(rel))


@query("scope_rooms", f"WITH {OBJECTS} SELECT CASE WHEN lower(split_part(scope, '_', 1)) IN ('unknown', 'wall', 'other') THEN NULL ELSE split_part(scope, '_', 1) END AS room_type, count(*) AS n FROM objects GROUP BY 1")
def scope_rooms(spark, sf_dir):
    return objects(spark, sf_dir).groupBy(X.room_of(F.col("scope")).alias("room_type")).agg(F.count(F.lit(1)).alias("n"))


@query("json_props", """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, '{"event_id":' || event_id || ',"user_id":' || user_id || '}' AS doc, coalesce(CAST(json_extract(props, '$.k') AS INTEGER) IS NOT NULL, false) AS complete FROM events""")
def json_props(spark, sf_dir):
    """JSON decoded by a schema, encoded again, and checked for its keys."""
    e = table(spark, sf_dir, "events").withColumn("p", F.from_json("props", "k int"))
    return e.select("event_id", "p.k", F.to_json(F.struct("event_id", "user_id")).alias("doc"), F.coalesce(F.col("p.k").isNotNull(), F.lit(False)).alias("complete"))


VERBS = {"bolt": ["pick up", "bring me", "tighten", "inspect"], "gear": ["turn on", "spin", "talk to", "grease"], "widget": ["play with", "move", "sit on", "lift up"], "person": ["talk to", "wave at", "greet", "follow"]}
_VOCAB = "words AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', [{', '.join(repr(x) for x in v)}])" for k, v in VERBS.items()) + ") v(noun, verbs))"
_TEMPLATES = "templates AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{t}')" for i, t in enumerate(I.TEMPLATES)) + ") t(idx, template))"
_INSEPARABLE = ", ".join(repr(x) for x in I.INSEPARABLE)


@query(
    "goal_instructions",
    f"""WITH {_VOCAB}, {_TEMPLATES},
goals AS (SELECT p_partkey AS goal_id, split_part(p_name, ' ', 2) AS noun, split_part(p_name, ' ', 1) AS reference, CASE p_partkey % 3 WHEN 0 THEN 'contain' WHEN 1 THEN 'near' ELSE 'above' END AS relation, p_type AS room FROM part),
v AS (SELECT g.*, coalesce(verbs[CAST(('0x' || left(md5('42|' || goal_id), 8))::BIGINT % len(verbs) AS INTEGER) + 1], 'interact with') AS verb FROM goals g LEFT JOIN words USING (noun)),
s AS (SELECT *, verb || ' the ' || noun AS do_it, CASE WHEN noun = 'person' THEN 'them' ELSE 'it' END AS pro,
  CASE relation WHEN 'contain' THEN 'contains' ELSE 'is ' || relation END AS rel_verb, CASE relation WHEN 'contain' THEN 'containing' ELSE relation END AS rel_part FROM v),
f AS (SELECT *, CASE WHEN verb = 'bring me' THEN 'bring ' || pro || ' to me' WHEN verb IN ({_INSEPARABLE}) THEN verb || ' ' || pro
  WHEN len(string_split(verb, ' ')) = 2 THEN split_part(verb, ' ', 1) || ' ' || pro || ' ' || split_part(verb, ' ', 2) ELSE verb || ' ' || pro END AS do_pronoun FROM s)
SELECT goal_id, idx, replace(replace(replace(replace(replace(replace(replace(replace(template, '{{Begin}}', upper(left(do_it, 1)) || lower(substr(do_it, 2))), '{{do_it}}', do_it), '{{do_pronoun}}', do_pronoun),
  '{{target}}', noun), '{{reference}}', reference), '{{room}}', room), '{{rel_verb}}', rel_verb), '{{rel_part}}', rel_part) AS instruction FROM f, templates""",
)
def goal_instructions(spark, sf_dir):
    """Ten sentences for each goal."""
    k = F.col("p_partkey")
    goals = table(spark, sf_dir, "part").select(k.alias("goal_id"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("target"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("reference"), F.when(k % 3 == 0, "contain").when(k % 3 == 1, "near").otherwise("above").alias("relation"), F.col("p_type").alias("room"))
    return I.instructions(goals, I.vocabulary(spark, VERBS))


@query("one_instruction", ORACLES["goal_instructions"] + " WHERE idx = CAST(('0x' || left(md5('42t|' || goal_id), 8))::BIGINT % 10 AS INTEGER)")
def one_instruction(spark, sf_dir):
    """One drawn sentence for each goal."""
    k = F.col("p_partkey")
    goals = table(spark, sf_dir, "part").select(k.alias("goal_id"), F.split_part("p_name", F.lit(" "), F.lit(2)).alias("target"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("reference"), F.when(k % 3 == 0, "contain").when(k % 3 == 1, "near").otherwise("above").alias("relation"), F.col("p_type").alias("room"))
    return I.one_instruction(goals, I.vocabulary(spark, VERBS))


_VERBS = ("contain", "carry", "touch", "face", "lie", "near", "Next to", "play", "fix", "see", "hold")
_RELS = f"r AS (SELECT event_id, [{', '.join(repr(v) for v in _VERBS)}][event_id % {len(_VERBS)} + 1] AS rel FROM events)"


@query(
    "relation_phrases",
    f"""WITH {_RELS} SELECT event_id, CASE WHEN lower(rel) IN ('near', 'next to') THEN 'is ' || rel ELSE CASE rel WHEN 'contain' THEN 'contains' WHEN 'carry' THEN 'carries' WHEN 'touch' THEN 'touches' WHEN 'face' THEN 'faces' WHEN 'lie' THEN 'lies' WHEN 'play' THEN 'plays' WHEN 'fix' THEN 'fixes' WHEN 'see' THEN 'sees' ELSE 'holds' END END AS verb,
  CASE WHEN lower(rel) IN ('near', 'next to') THEN rel ELSE CASE rel WHEN 'face' THEN 'facing' WHEN 'lie' THEN 'lying' ELSE rel || 'ing' END END AS part FROM r""",
)
def relation_phrases(spark, sf_dir):
    """Prepositions and inflected verbs."""
    rel = F.get(F.array(*(F.lit(v) for v in _VERBS)), (F.col("event_id") % len(_VERBS)).cast("int"))
    verb, part = I.relation_phrases(F.col("rel"))
    return table(spark, sf_dir, "events").select("event_id", rel.alias("rel")).select("event_id", verb.alias("verb"), part.alias("part"))


@query("segmented_names", "SELECT p_partkey, p_name AS name FROM part")
def segmented_names(spark, sf_dir):
    """Names whose words were run together, cut again by a dictionary of the words that names have."""
    p = table(spark, sf_dir, "part")
    words = [r["w"] for r in p.select(F.explode(F.split("p_name", " ")).alias("w")).distinct().collect()]
    return p.select("p_partkey", X.clean_name(F.replace("p_name", F.lit(" "), F.lit("")), X.segmenter(words)).alias("name"))


@query(
    "file_names",
    """WITH f AS (SELECT event_id, '/data/s' || user_id || '/npy/path_' || event_id || '_2.npy' AS p FROM events)
SELECT event_id, replace(replace(replace(p, '/npy/', '/actions/'), '.npy', '.json'), 'path', 'actions') AS actions, replace(replace(p, '/npy/', '/actions/'), '.npy', '.json') AS other, regexp_replace(p, '/[^/]*$', '') || '/ref/goal_' || event_id || '.png' AS image FROM f""",
)
def file_names(spark, sf_dir):
    """Files that belong to path files, by their names."""
    e = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("/data/s"), F.col("user_id").cast("string"), F.lit("/npy/path_"), F.col("event_id").cast("string"), F.lit("_2.npy")).alias("p"))
    one, other = X.action_file(F.col("p"))
    return e.select("event_id", one.alias("actions"), other.alias("other"), X.goal_image(F.col("p"), F.col("event_id")).alias("image"))


@query("prompts", "SELECT conv_id, 'Lines:' || chr(10) || string_agg(role, chr(10) ORDER BY turn) || chr(10) || 'Caption: c' || conv_id AS prompt FROM conversations GROUP BY conv_id")
def prompts(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("t"))
    return c.select("conv_id", I.prompt(F.transform("t", lambda x: x["role"]), F.concat(F.lit("c"), F.col("conv_id").cast("string")), "Lines:\n{lines}\nCaption: {caption}").alias("prompt"))


@query(
    "half_split",
    "SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY md5('42|' || event_id), event_id) <= count(*) OVER (PARTITION BY user_id) // 2 THEN 'fine' ELSE 'coarse' END AS split_type FROM events",
)
def half_split(spark, sf_dir):
    return S.half_split(table(spark, sf_dir, "events"), "user_id", "event_id", "42").select("event_id", "split_type")


@query(
    "coverage_sample",
    """WITH p AS (SELECT event_id, user_id % 7 AS scene, CAST(user_id AS BIGINT) // 7 AS goal FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY scene, goal ORDER BY md5('1024|' || event_id), event_id) AS own FROM p),
o AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY CASE WHEN own = 1 THEN 0 ELSE 1 END, CASE WHEN own = 1 THEN md5('1024g|' || goal) ELSE md5('1024|' || event_id) END, event_id) AS n FROM r)
SELECT event_id, scene, goal FROM o WHERE n <= 50""",
)
def coverage_sample(spark, sf_dir):
    p = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 7).alias("scene"), F.floor(F.col("user_id") / 7).alias("goal"))
    return S.coverage_sample(p, "scene", "goal", "event_id", 50, "1024")


@query(
    "uniform_frames",
    """WITH n AS (SELECT user_id, CAST(count(*) AS INTEGER) AS n FROM events GROUP BY user_id)
SELECT DISTINCT user_id, CAST(CASE WHEN n <= 30 THEN i ELSE floor(i * (n - 1) / 29) END AS INTEGER) AS frame FROM n, range(0, 30) r(i) WHERE n > 30 OR i < n""",
)
def uniform_frames(spark, sf_dir):
    n = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).cast("int").alias("n"))
    return n.select("user_id", F.explode(S.uniform_indices(F.col("n"), 30)).alias("frame"))


@query(
    "first_successes",
    """WITH t AS (SELECT user_id, event_id, event_type IN ('purchase', 'signup') AS ok, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS try_no FROM events),
s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS success_no FROM t WHERE try_no <= 51 AND ok) SELECT user_id, event_id, try_no, success_no FROM s WHERE success_no <= 5""",
)
def first_successes(spark, sf_dir):
    """At most 5 successes among the first 51 tries of each goal."""
    t = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").isin("purchase", "signup").alias("ok"))
    return S.first_successes(t, "user_id", "event_id", "ok", 51, 5).select("user_id", "event_id", F.col("try_no").cast("long").alias("try_no"), F.col("success_no").cast("long").alias("success_no"))


@query("vocabulary_differences", "SELECT 'only_here' AS side, x AS noun FROM (SELECT DISTINCT split_part(p_name, ' ', 2) AS x FROM part EXCEPT SELECT * FROM (VALUES ('bolt'), ('gear'), ('widget'), ('person'))) UNION ALL SELECT 'only_there', x FROM (SELECT * FROM (VALUES ('bolt'), ('gear'), ('widget'), ('person')) v(x) EXCEPT SELECT DISTINCT split_part(p_name, ' ', 2) FROM part)")
def vocabulary_differences(spark, sf_dir):
    """Nouns that the corpus has and the vocabulary lacks, and the reverse."""
    here = table(spark, sf_dir, "part").select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("noun"))
    there = I.vocabulary(spark, VERBS).select("noun")
    return here.subtract(there).select(F.lit("only_here").alias("side"), "noun").unionByName(there.subtract(here).select(F.lit("only_there").alias("side"), "noun"))


@query("type_counts", f"WITH {OBJECTS} SELECT category, count(*) AS n, count(DISTINCT room) AS n_rooms FROM objects GROUP BY category")
def type_counts(spark, sf_dir):
    return objects(spark, sf_dir).groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("room").alias("n_rooms"))
