"""The query catalogue over the driver's tables, and the SQL that each query must equal.

The tables hold no robot data, so roles are bound here: an episode is ``user_id % 10``, a topic (and camera) an event type,
the content of a frame its value's tens; an 8 x 8 signature is an embedding, its segment the label; episodes with
findings are orders, frames their line items.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgrid.functions import arrays, clock, text
from loomgrid.functions.signal import sampled_sine
from loomgrid.operators import inventory, islands, reports, resample, schema_checks, segments, selection, severity, signatures, source_quality
from loomgrid.streaming import live

TOPICS = ["click", "error", "purchase", "signup", "view"]
PERIOD = Fraction(1, 600)
#: Thresholds that fit the signatures of the tables.
EMBEDDED = signatures.AnalysisConfig(duplicate_threshold=0.13, jump_percentile=10.0, jump_min_score=0.1, freeze_min_seconds=1.0, flat_frame_std_threshold=0.118, temporal_discontinuity_threshold=0.2, artifact_block_threshold=0.1, artifact_max_duration_frames=2)
STEPPED = signatures.AnalysisConfig(duplicate_threshold=0.1, freeze_min_seconds=1.0, repeat_threshold=0.1, repeat_min_cycles=2, repeat_max_period_seconds=1.25, jump_min_score=0.1)

CATALOGUE: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        CATALOGUE[f.__name__] = (f, sql)
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = clock.epoch_ns(F.col("ts"))
    return read(spark, sf_dir, "events").select(
        (F.col("user_id") % 10).cast("int").alias("episode_index"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("topic"),
        stamp.alias("bag_stamp_ns"),
        (stamp - (F.col("event_id") % 7) * F.lit(60 * clock.NANOS)).alias("source_stamp_ns"),
        F.floor(F.col("value") / 10).cast("string").alias("fingerprint"),
        "value",
    )


MESSAGES = """
messages AS (
  SELECT CAST(user_id % 10 AS INTEGER) AS episode_index, event_id AS seq, event_type AS topic, epoch_us(ts) * 1000 AS bag_stamp_ns,
         epoch_us(ts) * 1000 - (event_id % 7) * 60000000000 AS source_stamp_ns, CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR) AS fingerprint, value
  FROM events
), ends AS (
  SELECT episode_index, min(bag_stamp_ns) AS origin_ns, max(bag_stamp_ns) AS final_ns FROM messages GROUP BY 1
), steps AS (
  SELECT *, lag(bag_stamp_ns) OVER w AS previous_ns, lag(source_stamp_ns) OVER w AS previous_source_ns, lag(fingerprint) OVER w AS previous_fingerprint,
         bag_stamp_ns - lag(bag_stamp_ns) OVER w AS interval_ns
  FROM messages WINDOW w AS (PARTITION BY episode_index, topic ORDER BY seq)
), stats AS (
  SELECT episode_index, topic, count(*) AS source_frames, median(interval_ns) FILTER (interval_ns > 0) AS median_ns,
         arg_max(bag_stamp_ns, seq) AS tail_ns
  FROM steps GROUP BY 1, 2
)"""


def grid_sql(period: str) -> str:
    """Frames in long form: ``held(episode_index, frame_index, tick_ns, topic, source_index, bag_stamp_ns, value)``."""
    return f"""
WITH {MESSAGES}, indexed AS (
  SELECT *, row_number() OVER (PARTITION BY episode_index, topic ORDER BY seq) - 1 AS source_index FROM messages
), firsts AS (
  SELECT episode_index, topic, min(bag_stamp_ns) AS first_ns, max(bag_stamp_ns) AS last_ns FROM messages GROUP BY 1, 2
), bounds AS (
  SELECT episode_index, max(first_ns) AS start_ns, max(last_ns) AS last_ns FROM firsts GROUP BY 1 HAVING count(*) = 5
), ticks AS (
  SELECT episode_index, k AS frame_index, start_ns + CAST(round_even({period}, 0) AS BIGINT) AS tick_ns, last_ns
  FROM bounds, LATERAL (SELECT unnest(generate_series(0, CAST((last_ns - start_ns) / ({period.replace('k * ', '1 * ')}) AS BIGINT) + 1)) AS k)
), wanted AS (
  SELECT t.episode_index, frame_index, tick_ns, topic FROM ticks t, (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) v(topic)
  WHERE tick_ns <= last_ns
), held AS (
  SELECT w.episode_index, w.frame_index, w.tick_ns, w.topic, i.source_index, i.bag_stamp_ns, i.value
  FROM wanted w ASOF JOIN indexed i ON w.episode_index = i.episode_index AND w.topic = i.topic AND w.tick_ns >= i.bag_stamp_ns
)"""


WIDE = ", ".join(f"max(source_index) FILTER (topic = '{t}') AS {t}_index, max(value) FILTER (topic = '{t}') AS {t}_value" for t in TOPICS)


def _frames(spark: SparkSession, sf_dir: str, fps: Fraction) -> DataFrame:
    return resample.resample(messages(spark, sf_dir), TOPICS, fps, payload=["value"])


def _wide(frames: DataFrame) -> DataFrame:
    return frames.select("episode_index", "frame_index", "tick_ns", *(x for t in TOPICS for x in (F.col(f"{t}.source_index").alias(f"{t}_index"), F.col(f"{t}.value").alias(f"{t}_value"))))


@query(grid_sql("k * 600000000000.0") + f"SELECT episode_index, frame_index, tick_ns, {WIDE} FROM held GROUP BY 1, 2, 3")
def zoh_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(_frames(spark, sf_dir, PERIOD))


@query(grid_sql("k * 1000000000000.0 / 3") + f"SELECT episode_index, frame_index, tick_ns, {WIDE} FROM held GROUP BY 1, 2, 3")
def zoh_resample_fractional_fps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(_frames(spark, sf_dir, Fraction(3, 1000)))


@query(
    grid_sql("k * 600000000000.0")
    + """, paired AS (SELECT *, lag(source_index) OVER (PARTITION BY episode_index, topic ORDER BY tick_ns) AS before FROM held)
SELECT episode_index, topic, count(*) AS output_frames, CAST(sum(CASE WHEN before = source_index THEN 1 ELSE 0 END) AS BIGINT) AS resampled_reuses,
       max(greatest(0, tick_ns - bag_stamp_ns)) AS max_source_age_ns FROM paired GROUP BY 1, 2"""
)
def resample_reuse_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.reuse_statistics(_frames(spark, sf_dir, PERIOD), TOPICS)


@query(f"WITH {MESSAGES} SELECT episode_index, topic, source_frames, round(median_ns / 1e6, 6) AS median_period_ms FROM stats")
def source_interval_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = source_quality.interval_statistics(messages(spark, sf_dir))
    return stats.select("episode_index", "topic", "source_frames", F.round(F.col("median_ns") / 1e6, 6).alias("median_period_ms"))


GAPS = f"""
WITH {MESSAGES}, judged AS (
  SELECT s.*, median_ns, origin_ns, greatest(1e9, median_ns * 5.0) AS gap_ns, median_ns * 2.5 AS drop_ns
  FROM steps s JOIN stats USING (episode_index, topic) JOIN ends USING (episode_index) WHERE interval_ns IS NOT NULL AND median_ns IS NOT NULL
)"""


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(
    GAPS
    + """SELECT episode_index, topic, seq, 'FAIL' AS severity, round((previous_ns - origin_ns) / 1e9, 6) AS start_s, round((bag_stamp_ns - origin_ns) / 1e9, 6) AS end_s,
round(interval_ns / 1e6, 6) AS gap_ms, round(gap_ns / 1e6, 6) AS threshold_ms, round(median_ns / 1e6, 6) AS median_period_ms FROM judged WHERE interval_ns > gap_ns"""
)
def source_gap_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = source_quality.gap_findings(messages(spark, sf_dir)).where("kind = 'camera_source_gap'")
    return _rounded(found, "start_s", "end_s", "gap_ms", "threshold_ms", "median_period_ms").drop("kind", "estimated_missing_frames")


@query(
    GAPS
    + """SELECT episode_index, topic, seq, 'WARN' AS severity, round((previous_ns - origin_ns) / 1e9, 6) AS start_s, round((bag_stamp_ns - origin_ns) / 1e9, 6) AS end_s,
round(interval_ns / 1e6, 6) AS gap_ms, round(drop_ns / 1e6, 6) AS threshold_ms, CAST(greatest(1, round_even(interval_ns / median_ns, 0) - 1) AS BIGINT) AS estimated_missing_frames
FROM judged WHERE interval_ns <= gap_ns AND interval_ns >= drop_ns"""
)
def source_drop_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = source_quality.gap_findings(messages(spark, sf_dir)).where("kind = 'camera_source_frame_drop'")
    return _rounded(found, "start_s", "end_s", "gap_ms", "threshold_ms").drop("kind", "median_period_ms")


@query(
    f"""WITH {MESSAGES}, judged AS (
  SELECT *, final_ns - tail_ns AS tail, greatest(1e9, median_ns * 5.0) AS gap_ns, median_ns * 2.5 AS drop_ns FROM stats JOIN ends USING (episode_index)
) SELECT episode_index, topic, CASE WHEN tail > gap_ns THEN 'camera_source_tail_gap' ELSE 'camera_source_tail_drop' END AS kind,
  CASE WHEN tail > gap_ns THEN 'FAIL' ELSE 'WARN' END AS severity, round(tail / 1e6, 6) AS gap_ms,
  CASE WHEN tail > gap_ns THEN NULL ELSE CAST(greatest(1, round_even(tail / median_ns, 0)) AS BIGINT) END AS estimated_missing_frames
FROM judged WHERE tail > gap_ns OR tail >= drop_ns"""
)
def tail_gap_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(source_quality.tail_findings(messages(spark, sf_dir)), "gap_ms").select("episode_index", "topic", "kind", "severity", "gap_ms", "estimated_missing_frames")


@query(
    f"""WITH {MESSAGES}, roles AS (SELECT episode_index, topic FROM ends, (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('depth')) v(topic))
SELECT episode_index, topic, 'FAIL' AS severity, coalesce(source_frames, 0) AS source_frames FROM roles LEFT JOIN stats USING (episode_index, topic)
WHERE coalesce(source_frames, 0) < 200"""
)
def insufficient_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_quality.insufficient_frames(messages(spark, sf_dir), [*TOPICS, "depth"], 200).select("episode_index", "topic", "severity", "source_frames")


@query(f"WITH {MESSAGES} SELECT episode_index, topic, seq, previous_source_ns AS previous_source_stamp_ns, source_stamp_ns AS current_source_stamp_ns FROM steps WHERE source_stamp_ns < previous_source_ns")
def stamp_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_quality.stamp_regressions(messages(spark, sf_dir)).select("episode_index", "topic", "seq", "previous_source_stamp_ns", "current_source_stamp_ns")


RUNS = f"""
WITH {MESSAGES}, marked AS (
  SELECT *, coalesce(fingerprint = previous_fingerprint, false) AS same FROM steps
), grouped AS (
  SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY episode_index, topic ORDER BY seq ROWS UNBOUNDED PRECEDING) AS run FROM marked
), runs AS (
  SELECT episode_index, topic, arg_min(previous_ns, seq) AS run_start_ns, arg_max(bag_stamp_ns, seq) AS run_end_ns, count(*) + 1 AS source_frames,
         bool_and(previous_source_ns IS NULL OR source_stamp_ns IS NULL OR source_stamp_ns > previous_source_ns) AS stamps_advanced
  FROM grouped WHERE same GROUP BY episode_index, topic, run
)"""


@query(RUNS + "SELECT * FROM runs")
def duplicate_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_quality.duplicate_runs(messages(spark, sf_dir))


@query(
    RUNS
    + """, moves AS (
  SELECT episode_index, bag_stamp_ns AS tick_ns, lag(bag_stamp_ns) OVER w AS from_ns, abs(value - lag(value) OVER w) AS motion FROM messages
  WINDOW w AS (PARTITION BY episode_index ORDER BY bag_stamp_ns)
), motion AS (
  SELECT r.episode_index, r.topic, r.run_start_ns, max(m.motion) AS motion FROM runs r JOIN moves m
  ON r.episode_index = m.episode_index AND from_ns >= run_start_ns AND tick_ns <= run_end_ns GROUP BY 1, 2, 3
), others AS (
  SELECT r.episode_index, r.topic, r.run_start_ns, count(*) AS n FROM runs r JOIN steps s
  ON r.episode_index = s.episode_index AND r.topic <> s.topic AND previous_ns >= run_start_ns AND bag_stamp_ns <= run_end_ns
  WHERE previous_ns IS NOT NULL AND fingerprint IS DISTINCT FROM previous_fingerprint GROUP BY 1, 2, 3
) SELECT r.episode_index, r.topic, r.run_start_ns, CASE WHEN stamps_advanced THEN 'WARN' ELSE 'FAIL' END AS severity, source_frames,
  round(coalesce(motion, 0), 6) AS max_state_motion, coalesce(n, 0) AS other_camera_content_changes
FROM runs r LEFT JOIN motion USING (episode_index, topic, run_start_ns) LEFT JOIN others USING (episode_index, topic, run_start_ns)"""
)
def duplicate_run_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages(spark, sf_dir)
    states = rows.select("episode_index", F.col("bag_stamp_ns").alias("tick_ns"), F.array("value").alias("state"))
    found = source_quality.duplicate_findings(rows, states)
    return _rounded(found, "max_state_motion").select("episode_index", "topic", "run_start_ns", "severity", "source_frames", "max_state_motion", "other_camera_content_changes")


@query(
    grid_sql("k * 600000000000.0")
    + """, reuse AS (SELECT episode_index, topic, count(*) AS output_frames, count(*) - count(DISTINCT source_index) AS resampled_reuses,
  max(greatest(0, tick_ns - bag_stamp_ns)) AS age FROM held GROUP BY 1, 2
), repeats AS (SELECT episode_index, topic, count(*) AS n FROM steps WHERE fingerprint = previous_fingerprint GROUP BY 1, 2)
SELECT episode_index, topic, source_frames, output_frames, resampled_reuses, coalesce(n, 0) AS duplicate_source_transitions,
  round(median_ns / 1e6, 6) AS median_source_period_ms, round(age / 1e6, 6) AS max_source_age_ms
FROM stats JOIN reuse USING (episode_index, topic) LEFT JOIN repeats USING (episode_index, topic)"""
)
def camera_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    reuse = resample.reuse_statistics(_frames(spark, sf_dir, PERIOD), TOPICS)
    return _rounded(source_quality.camera_statistics(messages(spark, sf_dir), reuse, TOPICS), "median_source_period_ms", "max_source_age_ms")


@query("SELECT event_id, CAST(user_id % 10 AS INTEGER) AS episode_index, p AS previous_value, value FROM (SELECT *, lag(value) OVER (PARTITION BY user_id % 10 ORDER BY event_id) AS p FROM events) WHERE value < p")
def order_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 10).cast("int").alias("episode_index"), "value")
    return islands.order_violations(rows, ["episode_index"], "event_id", "value").withColumnRenamed("previous_stamp_ns", "previous_value").select("event_id", "episode_index", "previous_value", "value")


#: Findings over orders: the order is the episode's item, its customer the episode.
FINDINGS = """
findings AS (
  SELECT o_custkey AS episode_index, o_orderkey AS place, o_orderpriority AS entity, 'order_' || o_orderstatus AS kind,
         CASE WHEN o_totalprice > 300000 THEN 'FAIL' WHEN o_totalprice > 150000 THEN 'WARN' ELSE 'PASS' END AS severity
  FROM orders
)"""


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.when(F.col("o_totalprice") > 300000, "FAIL").when(F.col("o_totalprice") > 150000, "WARN").otherwise("PASS")
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("episode_index"), F.col("o_orderkey").alias("place"), F.col("o_orderpriority").alias("entity"), F.concat(F.lit("order_"), "o_orderstatus").alias("kind"), level.alias("severity")
    )


@query(f"WITH {FINDINGS} SELECT episode_index, CASE max(CASE severity WHEN 'FAIL' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END) WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS severity FROM findings GROUP BY 1")
def episode_severity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return severity.rollup(findings(spark, sf_dir), ["episode_index"])


@query(f"WITH {FINDINGS} SELECT kind, count(*) FILTER (severity = 'PASS') AS n_pass, count(*) FILTER (severity = 'WARN') AS n_warn, count(*) FILTER (severity = 'FAIL') AS n_fail FROM findings GROUP BY 1")
def severity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return severity.summary(findings(spark, sf_dir), ["kind"], ("PASS", "WARN", "FAIL"))


CAPPED = f"""WITH {FINDINGS}, placed AS (SELECT *, row_number() OVER (PARTITION BY episode_index ORDER BY place) AS position FROM findings),
capped AS (SELECT episode_index, position, entity, kind, severity FROM placed WHERE position <= 5
UNION ALL SELECT episode_index, position, '*', 'findings_truncated', 'WARN' FROM placed WHERE position = 6)"""


@query(CAPPED + "SELECT * FROM capped")
def findings_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return severity.capped(findings(spark, sf_dir), ["episode_index"], ["place"], 5)


@query(
    f"""WITH {FINDINGS}, rated AS (SELECT c_custkey AS episode_index, coalesce(max(CASE severity WHEN 'FAIL' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END), 0) AS r
  FROM customer LEFT JOIN findings ON c_custkey = episode_index GROUP BY 1), kept AS (SELECT episode_index, row_number() OVER (ORDER BY episode_index) - 1 AS n FROM rated WHERE r < 2)
SELECT episode_index, CASE r WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE 'PASS' END AS severity, CASE WHEN r < 2 THEN 'converted' ELSE 'rejected' END AS status,
  CAST(n AS INTEGER) AS dataset_episode_index FROM rated LEFT JOIN kept USING (episode_index)"""
)
def policy_drop_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    episodes = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("episode_index"))
    return selection.policy_outcome(episodes, findings(spark, sf_dir), "drop", "fail")


@query(
    """WITH failed AS (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderstatus = 'F'),
kept AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM failed)),
numbers AS (SELECT l_orderkey, row_number() OVER (ORDER BY l_orderkey) - 1 AS n FROM (SELECT DISTINCT l_orderkey FROM kept))
SELECT CAST(n AS INTEGER) AS episode_index, l_linenumber AS frame_index, l_quantity AS quantity FROM kept JOIN numbers USING (l_orderkey)"""
)
def remove_failed_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("episode_index"), F.col("l_linenumber").alias("frame_index"), F.col("l_quantity").alias("quantity"))
    failed = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("episode_index"))
    return selection.without_episodes(frames, failed)


@query("SELECT DISTINCT episode_index FROM (SELECT o_custkey AS episode_index FROM orders WHERE o_totalprice > 300000 UNION ALL SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def selection_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = read(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("episode_index"))
    b = read(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("episode_index"))
    return selection.selected_episodes(a, b)


@query("SELECT DISTINCT o_custkey AS episode_index FROM orders WHERE o_custkey < 0 OR o_custkey >= 1000")
def selection_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.out_of_bounds(read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("episode_index")).distinct(), 1000)


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("label").orderBy("vec_id")
    return read(spark, sf_dir, "embeddings").select(F.col("label").cast("int").alias("label"), (F.row_number().over(w) - 1).cast("bigint").alias("frame_index"), F.col("embedding").alias("sig"))


EMBEDDED_SQL = """
frames AS (SELECT CAST(label AS INTEGER) AS label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS frame_index, CAST(embedding AS DOUBLE[]) AS sig FROM embeddings),
sized AS (SELECT *, count(*) OVER (PARTITION BY label) AS n FROM frames),
scores AS (SELECT a.label, a.frame_index AS transition, list_sum(list_transform(list_zip(a.sig, b.sig), lambda x: abs(x[1] - x[2]))) / len(a.sig) AS score
  FROM frames a JOIN frames b ON a.label = b.label AND b.frame_index = a.frame_index + 1),
limits AS (SELECT label, coalesce(greatest(quantile_cont(score, 0.1) FILTER (score > 0.13), 0.1), 0.1) AS jump_threshold, count(*) AS transitions FROM scores GROUP BY 1)"""


@query(f"WITH {EMBEDDED_SQL} SELECT label, transition, round(score, 6) AS score FROM scores")
def frame_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(signatures.frame_scores(embedded(spark, sf_dir), ["label"]), "score")


@query(f"WITH {EMBEDDED_SQL} SELECT label, round(jump_threshold, 6) AS jump_threshold, transitions FROM limits")
def jump_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(signatures.jump_thresholds(signatures.frame_scores(embedded(spark, sf_dir), ["label"]), ["label"], EMBEDDED), "jump_threshold")


def stepped(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id")
    return read(spark, sf_dir, "events").select("user_id", (F.row_number().over(w) - 1).cast("bigint").alias("frame_index"), F.array(F.floor(F.col("value") / 25).cast("float")).alias("sig"))


STEPPED_SQL = """
frames AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS frame_index, floor(value / 25) AS v FROM events),
scores AS (SELECT a.user_id, a.frame_index AS transition, abs(a.v - b.v) AS score FROM frames a JOIN frames b ON a.user_id = b.user_id AND b.frame_index = a.frame_index + 1),
limits AS (SELECT user_id, coalesce(greatest(quantile_cont(score, 0.1) FILTER (score > 0.1), 0.1), 0.1) AS jump_threshold FROM scores GROUP BY 1)"""
FREEZE_SQL = f"""WITH {STEPPED_SQL}, grouped AS (
  SELECT *, sum(CASE WHEN score <= 0.1 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY transition ROWS UNBOUNDED PRECEDING) AS run FROM scores
), runs AS (SELECT user_id, min(transition) AS a, max(transition) + 1 AS b FROM grouped WHERE score <= 0.1 GROUP BY user_id, run HAVING count(*) + 1 >= 4
), ended AS (SELECT r.user_id, a, b, s.score AS jump, jump_threshold FROM runs r JOIN limits USING (user_id) LEFT JOIN scores s ON s.user_id = r.user_id AND s.transition = r.b)
SELECT user_id, a AS start_frame, b AS end_frame, round(coalesce(jump, 0), 6) AS score, round(jump_threshold, 6) AS threshold FROM ended WHERE """


def _freezes(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    scores = signatures.frame_scores(stepped(spark, sf_dir), ["user_id"])
    found = signatures.freezes(scores, ["user_id"], 4, STEPPED).where(F.col("kind") == kind)
    return _rounded(found.select("user_id", "start_frame", "end_frame", "score", "threshold"), "score", "threshold")


@query(FREEZE_SQL + "jump >= jump_threshold")
def freeze_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _freezes(spark, sf_dir, "freeze_then_jump")


@query(FREEZE_SQL + "jump IS NULL")
def freeze_terminal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _freezes(spark, sf_dir, "freeze_at_episode_end")


CANDIDATES_SQL = f"""{STEPPED_SQL}, sized AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM frames),
compared AS (SELECT a.user_id, a.n, p, a.frame_index AS pos, abs(a.v - b.v) AS d FROM sized a, (VALUES (2), (3), (4), (5)) v(p), frames b
  WHERE b.user_id = a.user_id AND b.frame_index = a.frame_index + p AND p <= least(5, greatest(2, a.n // 2))),
grouped AS (SELECT *, sum(CASE WHEN d <= 0.1 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, p ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM compared),
runs AS (SELECT user_id, n, p, min(pos) AS a, max(pos) + 1 + p AS b FROM grouped WHERE d <= 0.1 GROUP BY user_id, n, p, run HAVING count(*) >= p),
moving AS (SELECT r.*, (SELECT max(score) FROM scores s WHERE s.user_id = r.user_id AND transition BETWEEN a AND a + p - 2) AS motion,
  (SELECT max(score) FROM scores s WHERE s.user_id = r.user_id AND transition = b - 1) AS jump FROM runs r),
candidates AS (SELECT user_id, a AS start_frame, b - 1 AS end_frame, CAST(p AS BIGINT) AS period, (b - a) // p AS cycles, b = n AS terminal
FROM moving JOIN limits USING (user_id) WHERE motion > 0.1 AND (b = n OR jump >= jump_threshold))"""


@query(f"WITH {CANDIDATES_SQL} SELECT * FROM candidates")
def repeat_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = stepped(spark, sf_dir)
    found = signatures.repeat_candidates(frames, signatures.frame_scores(frames, ["user_id"]), ["user_id"], 4, STEPPED)
    return found.select("user_id", F.col("start").alias("start_frame"), F.col("end").alias("end_frame"), "period", "cycles", "terminal")


@query(
    f"""WITH RECURSIVE {CANDIDATES_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, terminal ORDER BY period, start_frame) AS k FROM candidates),
walked AS (
  SELECT user_id, terminal, k, [{{'a': start_frame, 'b': end_frame}}] AS kept, true AS taken FROM ranked WHERE k = 1
  UNION ALL SELECT r.user_id, r.terminal, r.k,
    CASE WHEN len(list_filter(kept, lambda x: r.start_frame <= x.b AND r.end_frame >= x.a)) = 0 THEN list_append(kept, {{'a': r.start_frame, 'b': r.end_frame}}) ELSE kept END,
    len(list_filter(kept, lambda x: r.start_frame <= x.b AND r.end_frame >= x.a)) = 0
  FROM walked w JOIN ranked r ON r.user_id = w.user_id AND r.terminal = w.terminal AND r.k = w.k + 1)
SELECT r.user_id, CASE WHEN r.terminal THEN 'repeated_motion_at_episode_end' ELSE 'repeated_motion_then_jump' END AS kind, 'FAIL' AS severity, r.start_frame, r.end_frame, r.period, r.cycles
FROM ranked r JOIN walked w ON r.user_id = w.user_id AND r.terminal = w.terminal AND r.k = w.k WHERE taken"""
)
def repeated_motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each candidate is kept unless it overlaps one kept before it, which the SQL walks through by recursion."""
    frames = stepped(spark, sf_dir)
    found = signatures.repeats(signatures.repeat_candidates(frames, signatures.frame_scores(frames, ["user_id"]), ["user_id"], 4, STEPPED), ["user_id"])
    return found.select("user_id", "kind", "severity", "start_frame", "end_frame", "period", "cycles")


@query(
    f"""WITH {EMBEDDED_SQL}, spread AS (SELECT label, frame_index, sqrt(list_sum(list_transform(sig, lambda x: (x - list_avg(sig)) * (x - list_avg(sig)))) / len(sig)) AS s FROM frames),
grouped AS (SELECT *, sum(CASE WHEN s <= 0.118 THEN 0 ELSE 1 END) OVER (PARTITION BY label ORDER BY frame_index ROWS UNBOUNDED PRECEDING) AS run FROM spread)
SELECT label, min(frame_index) AS start_frame, max(frame_index) AS end_frame, round(0.118 - min(s), 6) AS score FROM grouped WHERE s <= 0.118 GROUP BY label, run"""
)
def flat_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(signatures.flat_frames(embedded(spark, sf_dir), ["label"], EMBEDDED).select("label", "start_frame", "end_frame", "score"), "score")


BLOCKS_SQL = """
pixels AS (SELECT label, frame_index, unnest(sig) AS x, unnest(range(64)) AS i FROM frames),
pairs AS (SELECT a.label, a.frame_index AS i1, b.frame_index AS i2, a.i // 16 * 4 + a.i % 8 // 2 AS block, avg(abs(a.x - b.x)) AS d
  FROM pixels a JOIN pixels b ON a.label = b.label AND a.i = b.i AND b.frame_index - a.frame_index BETWEEN 1 AND 4 GROUP BY 1, 2, 3, 4)"""


@query(f"WITH {EMBEDDED_SQL}, {BLOCKS_SQL} SELECT label, i1 AS frame_index, CAST(block AS INTEGER) AS block, round(d, 6) AS difference FROM pairs WHERE i2 = i1 + 1")
def block_mae(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("label").orderBy("frame_index")
    after = F.lead("sig").over(w)
    rows = embedded(spark, sf_dir).select("label", "frame_index", after.isNotNull().alias("has"), arrays.block_differences(F.col("sig"), after, 8).alias("d")).where("has")
    return rows.select("label", "frame_index", F.posexplode("d").alias("block", "difference")).withColumn("difference", F.round("difference", 6))


ARTIFACTS_SQL = f"""{BLOCKS_SQL},
shares AS (SELECT c.label, c.frame_index, r, avg(CASE WHEN l.d >= 0.1 AND g.d >= 0.1 AND x.d <= least(l.d, g.d) * 0.5 THEN 1.0 ELSE 0.0 END) AS share
  FROM frames c, (VALUES (1), (2)) v(r), pairs l, pairs g, pairs x
  WHERE l.label = c.label AND l.i1 = c.frame_index - r AND l.i2 = c.frame_index AND g.label = c.label AND g.i1 = c.frame_index AND g.i2 = c.frame_index + r
    AND x.label = c.label AND x.i1 = c.frame_index - r AND x.i2 = c.frame_index + r AND g.block = l.block AND x.block = l.block GROUP BY 1, 2, 3),
spread AS (SELECT label, frame_index, sqrt(list_sum(list_transform(sig, lambda x: (x - list_avg(sig)) * (x - list_avg(sig)))) / len(sig)) AS s FROM frames),
artifacts AS (SELECT s.label, s.frame_index, s.s <= 0.118 AS flat, CASE WHEN s.s <= 0.118 THEN 0.0 ELSE coalesce(max(share), 0.0) END AS artifact_score
  FROM spread s LEFT JOIN shares USING (label, frame_index) GROUP BY s.label, s.frame_index, s.s)"""


@query(
    f"""WITH {EMBEDDED_SQL}, {ARTIFACTS_SQL},
grouped AS (SELECT *, sum(CASE WHEN artifact_score >= 0.05 THEN 0 ELSE 1 END) OVER (PARTITION BY label ORDER BY frame_index ROWS UNBOUNDED PRECEDING) AS run FROM artifacts)
SELECT label, min(frame_index) AS start_frame, max(frame_index) AS end_frame, round(max(artifact_score), 6) AS score FROM grouped WHERE artifact_score >= 0.05 GROUP BY label, run"""
)
def transient_corruption(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = embedded(spark, sf_dir)
    support = frames.select("label", "frame_index", F.lit(False).alias("supported"))
    found = signatures.transient_corruption(signatures.artifact_scores(frames, ["label"], 8, EMBEDDED), support, ["label"], EMBEDDED)
    return _rounded(found.select("label", "start_frame", "end_frame", "score"), "score")


TEMPORAL_SQL = """
bends AS (SELECT b.label, b.frame_index, list_sum(list_transform(list_zip(a.sig, b.sig, c.sig), lambda x: abs(x[1] - 2 * x[2] + x[3]))) / len(b.sig) AS score
  FROM frames a JOIN frames b ON a.label = b.label AND b.frame_index = a.frame_index + 1 JOIN frames c ON c.label = b.label AND c.frame_index = b.frame_index + 1),
medians AS (SELECT label, median(score) AS m FROM bends GROUP BY 1),
robust AS (SELECT label, greatest(0.2, max(m) + 6.0 * 1.4826 * median(abs(score - m))) AS temporal_threshold FROM bends JOIN medians USING (label) GROUP BY 1)"""


@query(f"WITH {EMBEDDED_SQL}, {TEMPORAL_SQL} SELECT f.label, f.frame_index, round(coalesce(score, 0), 6) AS temporal_score FROM frames f LEFT JOIN bends b ON f.label = b.label AND f.frame_index = b.frame_index")
def temporal_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(signatures.temporal_scores(embedded(spark, sf_dir), ["label"]), "temporal_score").drop("interior")


@query(f"WITH {EMBEDDED_SQL}, {TEMPORAL_SQL} SELECT label, round(temporal_threshold, 6) AS temporal_threshold FROM robust")
def temporal_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = signatures.temporal_scores(embedded(spark, sf_dir), ["label"])
    return _rounded(signatures.robust_thresholds(scores, ["label"], "temporal_score", 0.2), "temporal_threshold")


#: Frames of one bright pixel each, so that outliers of the events stand out.
SPIKED = signatures.AnalysisConfig(flat_frame_std_threshold=0.5, artifact_block_threshold=150.0, artifact_max_duration_frames=1)


@query(
    """WITH frames AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS frame_index, value AS v FROM events),
around AS (SELECT *, lag(v) OVER w AS p, lead(v) OVER w AS q FROM frames WINDOW w AS (PARTITION BY user_id ORDER BY frame_index)),
scored AS (SELECT *, coalesce(abs(p - 2 * v + q) / 4, 0) AS score, v * sqrt(3) / 4 <= 0.5 AS flat,
  coalesce(abs(v - p) >= 150 AND abs(q - v) >= 150 AND abs(q - p) <= least(abs(v - p), abs(q - v)) * 0.5, false) AS hit FROM around),
medians AS (SELECT user_id, median(score) AS m FROM scored WHERE p IS NOT NULL AND q IS NOT NULL GROUP BY 1),
robust AS (SELECT user_id, greatest(5.0, max(m) + 6.0 * 1.4826 * median(abs(score - m))) AS t FROM scored JOIN medians USING (user_id) WHERE p IS NOT NULL AND q IS NOT NULL GROUP BY 1),
masked AS (SELECT *, max(CASE WHEN flat OR hit THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY frame_index ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS e FROM scored JOIN robust USING (user_id)),
grouped AS (SELECT *, sum(CASE WHEN score >= t AND e = 0 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY frame_index ROWS UNBOUNDED PRECEDING) AS run FROM masked)
SELECT user_id, min(frame_index) AS start_frame, max(frame_index) AS end_frame, round(max(score), 6) AS score, round(max(t), 4) AS threshold FROM grouped WHERE score >= t AND e = 0 GROUP BY user_id, run"""
)
def temporal_discontinuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id")
    dark = F.lit(0.0)
    frames = read(spark, sf_dir, "events").select("user_id", (F.row_number().over(w) - 1).cast("bigint").alias("frame_index"), F.array("value", dark, dark, dark).alias("sig"))
    support = frames.select("user_id", "frame_index", F.lit(False).alias("supported"))
    none = frames.select("user_id", F.lit(0).alias("start_frame"), F.lit(0).alias("end_frame")).limit(0)
    found = signatures.temporal_discontinuities(frames, signatures.artifact_scores(frames, ["user_id"], 2, SPIKED), support, none, ["user_id"], SPIKED)
    return _rounded(found.select("user_id", "start_frame", "end_frame", "score", "threshold"), "score").withColumn("threshold", F.round("threshold", 4))


@query(
    f"""WITH {STEPPED_SQL}, states AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS frame_index, value, count(*) OVER (PARTITION BY user_id) AS n FROM events),
scales AS (SELECT user_id, quantile_cont(value, 0.95) - quantile_cont(value, 0.05) AS scale FROM states WHERE n >= 3 GROUP BY 1),
bent AS (SELECT user_id, frame_index, coalesce(abs(lag(value) OVER w / scale - 2 * value / scale + lead(value) OVER w / scale), 0) AS bend FROM states JOIN scales USING (user_id) WHERE scale > 1.1920929e-07
  WINDOW w AS (PARTITION BY user_id ORDER BY frame_index))
SELECT f.user_id, f.frame_index, max(CASE WHEN coalesce(bend, 0) >= 1.5 THEN 1 ELSE 0 END) OVER (PARTITION BY f.user_id ORDER BY f.frame_index ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) = 1 AS supported
FROM frames f LEFT JOIN bent b ON f.user_id = b.user_id AND f.frame_index = b.frame_index"""
)
def motion_support_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id")
    states = read(spark, sf_dir, "events").select("user_id", (F.row_number().over(w) - 1).cast("bigint").alias("frame_index"), F.array("value").alias("state"))
    config = signatures.AnalysisConfig(state_motion_support_threshold=1.5, artifact_max_duration_frames=1)
    return signatures.motion_support(states, stepped(spark, sf_dir), ["user_id"], config)


def episodes_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("episode_index"), (F.col("o_custkey") % 90 + 10).alias("length"), (F.col("o_custkey") % 7).alias("chunk"), (F.col("o_orderkey") % 50).alias("file"), (F.col("o_totalprice") / 1000).alias("from"))


SEGMENTS_SQL = """segments AS (SELECT o_orderkey AS episode_index, feature, 'videos/' || feature || '/chunk-' || lpad(CAST(o_custkey % 7 AS VARCHAR), 3, '0') || '/file-' || lpad(CAST(o_orderkey % 50 AS VARCHAR), 3, '0') || '.mp4' AS video_path,
  CAST(round_even(o_totalprice / 1000 * 10, 0) AS BIGINT) AS start_frame, o_custkey % 90 + 10 AS length FROM orders, (VALUES ('front'), ('wrist')) v(feature))"""


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = {f: {"from_timestamp": F.col("from"), "chunk_index": F.col("chunk"), "file_index": F.col("file")} for f in ("front", "wrist")}
    return segments.segment_layout(episodes_of_orders(spark, sf_dir), ["front", "wrist"], 10, "videos/{video_key}/chunk-{chunk_index:03d}/file-{file_index:03d}.mp4", place)


@query(f"WITH {SEGMENTS_SQL} SELECT *, start_frame + length AS end_frame FROM segments")
def segment_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _segments(spark, sf_dir)


@query(f"WITH {SEGMENTS_SQL}, s AS (SELECT *, lag(start_frame + length) OVER (PARTITION BY video_path ORDER BY start_frame, start_frame + length) AS previous_end FROM segments) SELECT video_path, start_frame, previous_end FROM s WHERE start_frame < previous_end")
def segment_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_overlaps(_segments(spark, sf_dir)).select("video_path", "start_frame", "previous_end")


@query(f"WITH {SEGMENTS_SQL} SELECT count(DISTINCT episode_index) AS n_episodes, count(DISTINCT feature) AS n_features, CAST(sum(length) FILTER (feature = 'front') AS BIGINT) AS total_frames FROM segments")
def dataset_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.dataset_totals(_segments(spark, sf_dir), "front")


@query("SELECT CAST(user_id % 10 AS INTEGER) AS episode_index, event_type AS topic, arg_min(length(props), event_id) AS width FROM events GROUP BY 1, 2")
def schema_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_checks.inferred_schema(_described(spark, sf_dir), ["width"])


def _described(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select((F.col("user_id") % 10).cast("int").alias("episode_index"), F.col("event_id").alias("seq"), F.col("event_type").alias("topic"), F.length("props").cast("bigint").alias("width"))


@query(
    """WITH s AS (SELECT CAST(user_id % 10 AS INTEGER) AS episode_index, event_type AS topic, arg_min(length(props), event_id) AS width FROM events GROUP BY 1, 2),
f AS (SELECT topic, arg_min(width, episode_index) AS first_width FROM s GROUP BY 1) SELECT topic, episode_index, width, first_width FROM s JOIN f USING (topic) WHERE width IS DISTINCT FROM first_width"""
)
def schema_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_checks.schema_violations(schema_checks.inferred_schema(_described(spark, sf_dir), ["width"]), ["width"])


@query("SELECT u AS episode_index, t AS topic FROM (SELECT DISTINCT user_id AS u FROM events), (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('depth')) v(t) WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = u AND event_type = t)")
def required_topics_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events").select(F.col("user_id").alias("episode_index"), F.col("event_type").alias("topic"))
    return schema_checks.missing_topics([*TOPICS, "depth"], rows)


@query(
    """WITH m AS (SELECT o_orderkey AS report_id, CASE WHEN o_totalprice > 150000 THEN 'WARN' ELSE 'PASS' END AS severity,
  'Episode ' || (o_custkey % 40) || ' differs; gaps in episode(s) seen: [' || (o_orderkey % 30) || ', ' || (o_orderkey % 20) || ']' AS message FROM orders)
SELECT DISTINCT report_id, CAST(i AS INTEGER) AS episode_index FROM (
  SELECT report_id, unnest(regexp_extract_all(message, '(?i)\\bepisode\\s+(\\d+)\\b', 1)) AS i FROM m WHERE severity = 'WARN'
  UNION ALL SELECT report_id, unnest(list_transform(string_split(regexp_extract(message, '(?i)\\bepisode\\(s\\).*:\\s*\\[([0-9,\\s]+)\\]\\s*$', 1), ','), lambda x: trim(x))) FROM m WHERE severity = 'WARN')"""
)
def doctor_message_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("report_id"),
        F.when(F.col("o_totalprice") > 150000, "WARN").otherwise("PASS").alias("severity"),
        F.format_string("Episode %d differs; gaps in episode(s) seen: [%d, %d]", F.col("o_custkey") % 40, F.col("o_orderkey") % 30, F.col("o_orderkey") % 20).alias("message"),
    )
    return reports.message_selection(rows, "warn")


@query("SELECT event_id AS report_id, '$' AS path, j.key AS key, CAST(j.value AS VARCHAR) AS value FROM events, json_each(props) j")
def report_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.flatten(read(spark, sf_dir, "events").select(F.col("event_id").alias("report_id"), F.col("props").alias("report")))


@query(
    """WITH r AS (SELECT o_orderkey AS run_id, CASE o_orderstatus WHEN 'F' THEN 'FAIL' WHEN 'O' THEN 'WARN' ELSE 'PASS' END AS overall_severity, o_orderkey % 3 AS n_indices, o_custkey % 2 AS return_code FROM orders),
b AS (SELECT *, CASE WHEN n_indices > 0 AND overall_severity <> 'FAIL' THEN 'episodes selected below the threshold' WHEN overall_severity = 'FAIL' AND n_indices = 0 THEN 'threshold reached without episodes'
  WHEN return_code <> 0 AND overall_severity <> 'FAIL' THEN 'non-zero exit without findings' END AS blocker FROM r)
SELECT run_id, blocker, CASE WHEN blocker IS NOT NULL THEN 'blocked' WHEN n_indices > 0 THEN 'findings' ELSE 'pass' END AS status,
  CAST(CASE WHEN blocker IS NOT NULL THEN 20 WHEN n_indices > 0 THEN 10 ELSE 0 END AS INTEGER) AS exit_code FROM b"""
)
def evaluation_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.when(F.col("o_orderstatus") == "F", "FAIL").when(F.col("o_orderstatus") == "O", "WARN").otherwise("PASS")
    runs = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), level.alias("overall_severity"), (F.col("o_orderkey") % 3).alias("n_indices"), (F.col("o_custkey") % 2).alias("return_code"), F.lit(None).cast("string").alias("run_error"), F.lit(True).alias("has_report"))
    return reports.normalized(runs, "fail").select("run_id", "blocker", "status", "exit_code")


@query(
    """WITH l AS (SELECT l_orderkey AS k, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS s FROM lineitem WHERE l_quantity > 2 GROUP BY 1),
r AS (SELECT l_orderkey AS k, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS s FROM lineitem WHERE l_quantity < 48 GROUP BY 1)
SELECT k AS relative_path, CASE WHEN r.n IS NULL THEN 'missing' WHEN l.n IS NULL THEN 'unexpected' ELSE 'different' END AS problem FROM l FULL JOIN r USING (k) WHERE l.n IS DISTINCT FROM r.n OR l.s IS DISTINCT FROM r.s"""
)
def inventory_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "lineitem")
    listed = lambda condition: rows.where(condition).groupBy(F.col("l_orderkey").alias("relative_path")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("s"))
    return inventory.inventory_difference(listed("l_quantity > 2"), listed("l_quantity < 48"), "relative_path", ["n", "s"])


@query("SELECT CAST(coalesce(sum(p_size), 0) AS BIGINT) AS required_bytes, count(*) AS n_files FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def archive_required_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = read(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("size"))
    return inventory.required_bytes(files, read(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")), "p_partkey")


@query(
    """SELECT s_name AS path, CASE WHEN s_suppkey % 3 = 0 THEN 'full' ELSE CASE WHEN s_suppkey % 3 = 1 THEN 'base' ELSE 'default' END END AS task FROM (SELECT '/data/' || s_name AS s_name, s_suppkey FROM supplier)"""
)
def task_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = read(spark, sf_dir, "supplier")
    inputs = suppliers.select(F.concat(F.lit("/data/"), "s_name").alias("path"))
    full = suppliers.where("s_suppkey % 3 = 0").select(F.concat(F.lit("/data/"), "s_name").alias("key"), F.lit("full").alias("task"))
    base = suppliers.where("s_suppkey % 3 = 1").select(F.col("s_name").alias("key"), F.lit("base").alias("task"))
    return schema_checks.assign_tasks(inputs, full.union(base), "default")


@query("SELECT CAST(user_id AS BIGINT) AS entity, event_id, CAST(i AS INTEGER) AS axis, round(0.5 * i + (i + 1) * sin(2 * pi() * 0.25 * greatest(0, value / 10) + 0.61 * (user_id % 4) + 0.37 * i), 6) AS x FROM events, (SELECT unnest(range(7)) AS i)")
def synthetic_sine(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    wave = sampled_sine(F.col("value") / 10, F.col("user_id") % 4, [float(i + 1) for i in range(7)], [0.5 * i for i in range(7)], 0.25)
    return rows.select(F.col("user_id").alias("entity"), "event_id", F.posexplode(wave).alias("axis", "x")).withColumn("x", F.round("x", 6))


@query(
    """WITH e AS (SELECT event_id, epoch_us(ts) * 1000 - (SELECT min(epoch_us(ts)) * 1000 FROM events) AS o FROM events)
SELECT event_id, CAST(floor(o / 4500000000000) AS BIGINT) AS session FROM e WHERE o % 4500000000000 < 3600000000000"""
)
def auto_session_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages(spark, sf_dir)
    origin = rows.agg(F.min("bag_stamp_ns")).first()[0]
    return rows.select(F.col("seq").alias("event_id"), live.session_number(F.col("bag_stamp_ns"), origin, 3600, 900).alias("session")).where("session IS NOT NULL")


@query("SELECT event_type AS topic, count(*) AS messages FROM events GROUP BY 1")
def topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.topic_counts(messages(spark, sf_dir))


@query("SELECT p_partkey, 'local/' || coalesce(nullif(trim(regexp_replace(p_name || '/' || p_type, '[^A-Za-z0-9_.-]+', '-', 'g'), '-.'), ''), 'dataset') AS slug FROM part")
def repository_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", text.repository_slug(F.concat_ws("/", "p_name", "p_type")).alias("slug"))


@query("SELECT doc_id, sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS size FROM documents")
def content_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("bigint").alias("size"))


@query(
    """SELECT conv_id AS episode_index, min(turn) AS start, max(turn) + 1 AS stop, count(*) AS length FROM (
  SELECT *, sum(CASE WHEN role = 'user' THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS run FROM conversations) WHERE role = 'user' GROUP BY conv_id, run"""
)
def mask_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("episode_index"), "turn", "role")
    return islands.islands(rows, ["episode_index"], "turn", F.col("role") == "user", [])


# Reports three levels deep: a finding, a check with findings and a nested list, made of an order.
REPORT_TEXT = """'{"overall_severity": "' || CASE o_orderstatus WHEN 'F' THEN 'FAIL' WHEN 'O' THEN 'warn' ELSE 'PASS' END || '", "deletable_episode_indices": [' || (o_custkey % 5) || ', true, 1.5], "checks": [{"name": "a [{", "findings": [{"episode_index": '
  || (o_orderkey % 40) || ', "severity": "' || CASE WHEN o_custkey % 3 = 0 THEN 'fail' ELSE 'WARN' END || '"}, {"episode_index": ' || CASE WHEN o_orderkey % 4 = 0 THEN 'true' ELSE CAST(o_custkey % 9 AS VARCHAR(9)) END || ', "severity": "FAIL", "more": {"deletable_episode_indices": [77]}}]}], "non_episode_blockers": ['
  || CASE WHEN o_orderkey % 7 = 0 THEN '"stale \\"metadata\\""' ELSE '' END || ']}'"""


def report_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "FAIL").when(F.col("o_orderstatus") == "O", "warn").otherwise("PASS")
    second = F.when(F.col("o_orderkey") % 4 == 0, "true").otherwise((F.col("o_custkey") % 9).cast("string"))
    document = F.concat(
        F.lit('{"overall_severity": "'), status, F.lit('", "deletable_episode_indices": ['), F.col("o_custkey") % 5,
        F.lit(', true, 1.5], "checks": [{"name": "a [{", "findings": [{"episode_index": '), F.col("o_orderkey") % 40, F.lit(', "severity": "'),
        F.when(F.col("o_custkey") % 3 == 0, "fail").otherwise("WARN"), F.lit('"}, {"episode_index": '), second,
        F.lit(', "severity": "FAIL", "more": {"deletable_episode_indices": [77]}}]}], "non_episode_blockers": ['),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit('"stale \\"metadata\\""')).otherwise(""), F.lit("]}"),
    )
    return read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("report_id"), document.alias("report"))


SELECTED_SQL = """picked AS (
  SELECT o_orderkey AS report_id, o_custkey % 5 AS i FROM orders
  UNION SELECT o_orderkey, o_orderkey % 40 FROM orders WHERE o_custkey % 3 = 0
  UNION SELECT o_orderkey, o_custkey % 9 FROM orders WHERE o_orderkey % 4 <> 0)"""


@query(f"WITH {SELECTED_SQL} SELECT report_id, CAST(i AS INTEGER) AS episode_index FROM picked")
def report_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.episode_selection(report_documents(spark, sf_dir), "fail")


@query(
    f"""WITH docs AS (SELECT o_orderkey AS report_id, {REPORT_TEXT} AS report FROM orders), {SELECTED_SQL}
SELECT report_id, upper(report ->> '$.overall_severity') AS overall_severity, (SELECT count(*) FROM picked p WHERE p.report_id = docs.report_id) AS n_indices,
  coalesce(report ->> '$.non_episode_blockers[0]', '') AS blockers, CASE WHEN json_array_length(report, '$.non_episode_blockers') > 0 THEN 'blockers that concern no episode' END AS problem FROM docs"""
)
def report_blockers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.report_states(report_documents(spark, sf_dir), "fail").withColumn("blockers", F.array_join("blockers", "; "))


@query(
    """WITH components AS (SELECT o_custkey AS d, CASE o_orderstatus WHEN 'F' THEN 'FAIL' WHEN 'O' THEN 'WARN' END AS overall_severity, CASE WHEN o_orderkey % 11 = 0 THEN 'no report' END AS blocker, o_orderkey % 3 AS n_indices, CAST(o_orderkey % 2 AS INTEGER) AS return_code FROM orders)
SELECT d, CASE max(CASE overall_severity WHEN 'FAIL' THEN 2 WHEN 'WARN' THEN 1 END) WHEN 2 THEN 'FAIL' WHEN 1 THEN 'WARN' ELSE CASE WHEN count(blocker) > 0 THEN 'FAIL' ELSE 'PASS' END END AS overall_severity,
  count(blocker) AS n_blockers, CASE WHEN count(blocker) > 0 THEN 'blocked' WHEN max(n_indices) > 0 THEN 'findings' ELSE 'pass' END AS status, max(return_code) AS return_code FROM components GROUP BY d"""
)
def evaluations_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.when(F.col("o_orderstatus") == "F", "FAIL").when(F.col("o_orderstatus") == "O", "WARN")
    rows = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("d"), level.alias("overall_severity"), F.when(F.col("o_orderkey") % 11 == 0, "no report").alias("blocker"), (F.col("o_orderkey") % 3).alias("n_indices"), (F.col("o_orderkey") % 2).cast("int").alias("return_code"))
    return reports.combined(rows, ["d"])


COMMANDS_SQL = """commands AS (SELECT CAST(user_id % 10 AS INTEGER) AS recorder, event_id AS seq, epoch_us(ts) * 1000 AS at_ns,
  CASE event_type WHEN 'click' THEN 'start' WHEN 'view' THEN 'start' WHEN 'purchase' THEN 'stop' WHEN 'signup' THEN 'discard' ELSE 'status' END AS command FROM events WHERE event_id % 5 = 0),
kinds AS (SELECT *, CASE command WHEN 'start' THEN 'recording' WHEN 'status' THEN NULL ELSE 'idle' END AS kind FROM commands),
known AS (SELECT *, coalesce(last_value(kind IGNORE NULLS) OVER (PARTITION BY recorder ORDER BY at_ns, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'idle') AS before FROM kinds),
answered AS (SELECT recorder, seq, at_ns, command, coalesce(kind <> before, true) AS accepted, coalesce(kind, before) AS state FROM known),
numbered AS (SELECT *, count(*) FILTER (command = 'start' AND accepted) OVER (PARTITION BY recorder ORDER BY at_ns, seq ROWS UNBOUNDED PRECEDING) AS session FROM answered)"""


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    command = F.when(F.col("topic").isin("click", "view"), "start").when(F.col("topic") == "purchase", "stop").when(F.col("topic") == "signup", "discard").otherwise("status")
    return messages(spark, sf_dir).where("seq % 5 = 0").select(F.col("episode_index").alias("recorder"), "seq", F.col("bag_stamp_ns").alias("at_ns"), command.alias("command"))


@query(f"WITH {COMMANDS_SQL} SELECT * FROM numbered")
def session_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.session_control(commands(spark, sf_dir))


@query(
    f"""WITH {COMMANDS_SQL}, acts AS (SELECT *, lead(at_ns) OVER w AS to_ns, lead(command) OVER w AS closing FROM numbered WHERE accepted AND command <> 'status' WINDOW w AS (PARTITION BY recorder ORDER BY at_ns, seq)),
sessions AS (SELECT * FROM acts WHERE command = 'start' AND closing IN ('stop', 'save'))
SELECT e.event_id AS seq, s.recorder, s.session FROM events e JOIN sessions s ON e.user_id % 10 = s.recorder AND epoch_us(e.ts) * 1000 >= s.at_ns AND epoch_us(e.ts) * 1000 < s.to_ns"""
)
def session_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages(spark, sf_dir).select("seq", F.col("episode_index").alias("recorder"), "bag_stamp_ns")
    return live.with_sessions(rows, commands(spark, sf_dir)).select("seq", "recorder", "session")


@query("SELECT p_partkey, regexp_matches(p_brand, '^[A-Za-z_][A-Za-z0-9_]*$') AS entity, regexp_matches(p_type, '^[A-Za-z0-9][A-Za-z0-9_.-]*$') AS prefix, starts_with('/' || p_name, '/') AND p_name <> '' AS topic FROM part")
def name_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "part")
    return rows.select("p_partkey", text.valid_entity(F.col("p_brand")).alias("entity"), text.valid_prefix(F.col("p_type")).alias("prefix"), text.valid_topic(F.concat(F.lit("/"), "p_name")).alias("topic"))


@query(
    """WITH paths AS (SELECT '/d/' || (o_custkey % 97) || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '/' || (o_orderkey % 11) END AS path FROM orders),
distinct_paths AS (SELECT path, count(*) AS n FROM paths GROUP BY 1)
SELECT a.path AS outer_path, b.path AS inner_path FROM distinct_paths a JOIN distinct_paths b ON starts_with(b.path, a.path || '/') OR (a.path = b.path AND a.n > 1)"""
)
def path_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit("/"), F.col("o_orderkey") % 11))
    return schema_checks.nested_paths(read(spark, sf_dir, "orders").select(F.concat(F.lit("/d/"), F.col("o_custkey") % 97, tail).alias("path")))


@query("SELECT DISTINCT 'Supplier#' || lpad(CAST(p_partkey % 150 AS VARCHAR), 9, '0') AS key FROM part WHERE 'Supplier#' || lpad(CAST(p_partkey % 150 AS VARCHAR), 9, '0') NOT IN (SELECT s_name FROM supplier)")
def unknown_task_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = read(spark, sf_dir, "supplier").select(F.concat(F.lit("/data/"), "s_name").alias("path"))
    tasks = read(spark, sf_dir, "part").select(F.concat(F.lit("Supplier#"), F.lpad((F.col("p_partkey") % 150).cast("string"), 9, "0")).alias("key")).distinct()
    return schema_checks.unknown_task_keys(inputs, tasks)


@query("SELECT p_name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def repeated_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_checks.repeated_values(read(spark, sf_dir, "part"), "p_name")


@query("SELECT o_orderkey AS episode_index, o_custkey % 90 + 10 AS length FROM orders ORDER BY o_orderkey LIMIT 25")
def first_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.first_episodes(episodes_of_orders(spark, sf_dir).select("episode_index", "length"), 25)


@query("SELECT event_id, CAST(user_id * 1000000000 + event_id % 1000 AS BIGINT) AS stamp_ns, CAST(round_even(value * 29.97, 0) AS BIGINT) AS frame, strftime(ts, '%Y%m%d_%H%M%S_%f') || '_' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') AS session, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS utc FROM events")
def clock_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.col("ts").cast("timestamp")
    return read(spark, sf_dir, "events").select(
        "event_id",
        clock.stamp_ns(F.col("user_id"), F.col("event_id") % 1000).alias("stamp_ns"),
        clock.frame_number(F.col("value"), 29.97).alias("frame"),
        clock.session_name(stamp, (F.col("event_id") % 1000).cast("int")).alias("session"),
        clock.utc_iso(stamp).alias("utc"),
    )


@query(
    """SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE trim(p_brand) END AS id, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE trim(p_type) END AS value,
  '/robot/' || p_brand || '/state' AS topic, p_brand || '_' || lpad(CAST(p_size AS VARCHAR), CAST(greatest(2, length(CAST(p_size AS VARCHAR))) AS INTEGER), '0') || '_filtered' AS derived FROM part"""
)
def name_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = text.assignment(F.when(F.col("p_partkey") % 4 == 0, F.col("p_brand")).otherwise(F.concat(F.lit(" "), "p_brand", F.lit(" = "), "p_type")))
    return read(spark, sf_dir, "part").select(
        "p_partkey",
        pair["id"].alias("id"),
        pair["value"].alias("value"),
        text.topic_path(F.lit("/robot/"), F.concat(F.lit("/"), "p_brand"), F.lit("//state")).alias("topic"),
        text.stage_name(F.col("p_brand"), F.col("p_size").cast("int"), F.lit("filtered")).alias("derived"),
    )


@query(
    """SELECT event_id, [CAST(value AS DOUBLE), CAST(user_id AS DOUBLE)] AS action, ['arm' || (user_id % 3) || '.x', 'arm' || (user_id % 3) || '.y', 'grip.w'] AS axes, value <= 60 AS valid, user_id % 3 <> 0 AS names_differ FROM events"""
)
def vector_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    arm = F.concat(F.lit("arm"), F.col("user_id") % 3)
    odd = F.when(F.col("value") <= 60, F.col("value")).otherwise(F.lit(float("nan")))
    return read(spark, sf_dir, "events").select(
        "event_id",
        F.concat(F.array(F.col("value").cast("double")), F.array(F.col("user_id").cast("double"))).alias("action"),
        arrays.axis_names(F.array(arm, F.lit("grip")), F.array(F.array(F.lit("x"), F.lit("y")), F.array(F.lit("w")))).alias("axes"),
        arrays.valid_vector(F.array(odd.cast("double"), F.lit(0.0).cast("double")), 2).alias("valid"),
        arrays.unique_names(F.array(F.lit("arm0"), arm)).alias("names_differ"),
    )


@query("SELECT e.user_id % 10 AS episode_index, event_id AS seq, event_type AS topic, length(props) AS width, f.width AS frozen_width FROM events e JOIN (SELECT event_type AS topic, arg_min(length(props), event_id) AS width FROM events GROUP BY 1) f ON f.topic = event_type WHERE length(props) <> f.width")
def shape_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _described(spark, sf_dir)
    frozen = rows.groupBy("topic").agg(F.min_by("width", "seq").alias("width"))
    return schema_checks.shape_violations(rows, frozen, ["width"]).select(F.col("episode_index").cast("bigint").alias("episode_index"), "seq", "topic", "width", "frozen_width")


TIES_SQL = """WITH m AS (SELECT CAST(user_id % 10 AS INTEGER) AS episode_index, event_id AS seq, event_type AS topic, epoch_us(ts) // 3600000000 * 3600000000000 AS hour_ns FROM events),
indexed AS (SELECT *, row_number() OVER (PARTITION BY episode_index, topic ORDER BY seq) - 1 AS source_index, max(seq) OVER (PARTITION BY episode_index, topic, hour_ns) AS last_seq FROM m),
latest AS (SELECT * FROM indexed WHERE seq = last_seq),
firsts AS (SELECT episode_index, topic, min(hour_ns) AS first_ns, max(hour_ns) AS last_ns FROM m GROUP BY 1, 2),
bounds AS (SELECT episode_index, max(first_ns) AS a, max(last_ns) AS b FROM firsts GROUP BY 1 HAVING count(*) = 5),
ticks AS (SELECT episode_index, k AS frame_index, a + k * 1800000000000 AS tick_ns FROM bounds, LATERAL (SELECT unnest(generate_series(0, (b - a) // 1800000000000)) AS k)),
wanted AS (SELECT t.*, topic FROM ticks t, (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) v(topic))
SELECT w.episode_index, w.frame_index, w.topic, l.source_index FROM wanted w ASOF JOIN latest l ON w.episode_index = l.episode_index AND w.topic = l.topic AND w.tick_ns >= l.hour_ns"""


@query(TIES_SQL)
def hold_of_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of messages of one time the last one is held; many have the same hour here."""
    hour = 3600 * clock.NANOS
    rows = messages(spark, sf_dir).withColumn("bag_stamp_ns", F.floor(F.col("bag_stamp_ns") / hour).cast("bigint") * hour)
    # within a topic and episode the log is in the order of time
    order = Window.partitionBy("episode_index", "topic", "bag_stamp_ns")
    frames = resample.resample(rows.withColumn("n", F.count(F.lit(1)).over(order)), TOPICS, Fraction(1, 1800), payload=["value"])
    each = F.explode(F.array(*(F.struct(F.lit(t).alias("topic"), F.col(f"{t}.source_index").alias("source_index")) for t in TOPICS)))
    return frames.select("episode_index", "frame_index", each.alias("x")).select("episode_index", "frame_index", "x.topic", "x.source_index")


@query(
    f"""WITH {STEPPED_SQL}, grouped AS (SELECT *, sum(CASE WHEN score <= 0.1 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY transition ROWS UNBOUNDED PRECEDING) AS run FROM scores),
runs AS (SELECT user_id, min(transition) AS a, max(transition) + 1 AS b FROM grouped WHERE score <= 0.1 GROUP BY user_id, run HAVING count(*) + 1 >= 4),
ended AS (SELECT r.user_id, s.score AS jump, jump_threshold FROM runs r JOIN limits USING (user_id) LEFT JOIN scores s ON s.user_id = r.user_id AND s.transition = r.b),
frozen AS (SELECT count(*) AS n FROM ended WHERE jump IS NULL OR jump >= jump_threshold),
users AS (SELECT count(DISTINCT user_id) - 1 AS n FROM events)
SELECT CAST(0 AS INTEGER) AS position, 'metadata and boundaries' AS "check", 'PASS' AS severity, n FROM users
UNION ALL SELECT 1, 'frozen frames', CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END, n FROM frozen
UNION ALL SELECT 2, 'repeated motion', 'PASS', 0 UNION ALL SELECT 3, 'visual integrity', 'PASS', 0 UNION ALL SELECT 4, 'temporal continuity', 'PASS', 0"""
)
def check_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = signatures.frame_scores(stepped(spark, sf_dir), ["user_id"])
    found = signatures.freezes(scores, ["user_id"], 4, STEPPED)
    parts = read(spark, sf_dir, "events").select(F.col("user_id").alias("episode_index"), F.lit("front").alias("feature")).distinct()
    return signatures.check_rollup(found, parts)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, (f, _) in CATALOGUE.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in CATALOGUE.items() if sql}
