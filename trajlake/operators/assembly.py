"""Episodes from their parts, with a reason for each that fails, and the state of work in progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assemble(candidates: DataFrame, actions: DataFrame, paths: DataFrame, frames: DataFrame, fine: DataFrame, coarse: DataFrame, markers: DataFrame) -> DataFrame:
    """All candidates (traj, goal, start, split_type) with what they lack: reason is null for a whole episode.

    Counts per traj come from the part tables (traj, n_actions / n_path / n_rgb, n_depth); fine is (traj, fine_text), coarse is
    (goal, coarse_text), markers (traj). The first rule that fails names the reason. Each part is joined once, on its own key, so a part that is missing
    costs nothing; the assigned kind of instruction must be there, the other kind is no replacement.
    """
    j = candidates.join(actions, "traj", "left").join(paths, "traj", "left").join(frames, "traj", "left").join(fine, "traj", "left").join(coarse, "goal", "left")
    j = j.join(markers.select("traj", F.lit(True).alias("marked")), "traj", "left")
    text = F.when(F.col("split_type") == "fine", F.col("fine_text")).otherwise(F.col("coarse_text"))
    reason = (
        F.when(F.col("goal").isNull() | F.col("start").isNull(), "malformed_name")
        .when(F.col("n_actions").isNull(), "missing_actions")
        .when(F.col("n_path").isNull(), "missing_path")
        .when(F.col("n_rgb").isNull() | F.col("n_depth").isNull(), "missing_frames")
        .when((F.col("n_actions") != F.col("n_path")) | (F.col("n_path") != F.col("n_rgb")) | (F.col("n_rgb") != F.col("n_depth")), "length_mismatch")
        .when(F.col("n_path") < 2, "too_short")
        .when(text.isNull(), F.concat(F.lit("missing_"), "split_type"))
    )
    done = F.coalesce("marked", F.lit(False))
    return j.select("traj", "goal", "start", "split_type", F.col("n_path").alias("n_steps"), text.alias("instruction"), reason.alias("reason"), F.when(done, "success").otherwise("unknown").alias("finish_status"), F.when(done, None).otherwise("unknown").alias("fail_reason"))


def split_quarantine(assembled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole episodes, and the others with their reasons; together they are all candidates."""
    return assembled.where("reason is null").drop("reason"), assembled.where("reason is not null").select("traj", "goal", "start", "reason")


def normalise_depth(pixels: DataFrame, group: str, value: str = "depth") -> DataFrame:
    """Depth with NaN and +Inf as 10 and -Inf as 0; a group whose greatest value is above 1 is divided by 100."""
    v = F.col(value)
    flat = F.when(F.isnan(v) | (v == float("inf")), 10.0).when(v == float("-inf"), 0.0).otherwise(v)
    p = pixels.withColumn(value, flat)
    top = p.groupBy(group).agg(F.max(value).alias("__top"))
    return p.join(top, group).withColumn(value, F.when(F.col("__top") > 1, F.col(value) / 100).otherwise(F.col(value))).drop("__top")


def depth_to_byte(v: Column) -> Column:
    """0 to 10 metres as 0 to 255, the fraction cut off."""
    return F.floor(F.greatest(F.least(v, F.lit(10.0)), F.lit(0.0)) / 10 * 255).cast("int")


def image_quality(pixels: DataFrame, key: str, value: str = "v", least_std: float = 10.0, most_mean: float = 245.0) -> DataFrame:
    """key, mean, std, problematic: flat or washed-out images, and those without pixels that can be read."""
    g = pixels.groupBy(key).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))
    return g.withColumn("problematic", F.coalesce((F.col("std") < least_std) | (F.col("mean") > most_mean), F.lit(True)))


def pending(tasks: DataFrame, state: DataFrame, key: str, most: int = 5) -> DataFrame:
    """Tasks that may still run: neither done nor tried ``most`` times."""
    s = tasks.join(state, key, "left")
    return s.where((F.coalesce("status", F.lit("")) != "done") & (F.coalesce("attempts", F.lit(0)) < most)).select(*tasks.columns, F.coalesce("attempts", F.lit(0)).alias("attempts"))


def advance(state: DataFrame, outcomes: DataFrame, key: str, gave_up: int = 999) -> DataFrame:
    """The state (key, status, attempts) after outcomes (key, outcome): done ends a task, an error or a missing input counts as a try, a time-out gives up."""
    o = outcomes.select(key, "outcome")
    j = state.join(o, key, "full_outer")
    tried = F.coalesce("attempts", F.lit(0))
    return j.select(
        key,
        F.when(F.col("outcome") == "done", "done").otherwise(F.coalesce("status", F.lit("open"))).alias("status"),
        F.when(F.col("outcome") == "timeout", gave_up).when(F.col("outcome").isin("error", "missing"), tried + 1).otherwise(tried).cast("int").alias("attempts"),
    )


def upsert(old: DataFrame, new: DataFrame, key: str, columns: list[str], complete: Column) -> DataFrame:
    """All keys of either table; of two rows the complete new one wins, else a complete old one, and incomplete rows become empty."""
    o = old.select(key, F.struct(*columns).alias("o"), complete.alias("oc"))
    n = new.select(key, F.struct(*columns).alias("n"), complete.alias("nc"))
    best = F.when(F.coalesce("nc", F.lit(False)), F.col("n")).when(F.coalesce("oc", F.lit(False)), F.col("o"))
    return o.join(n, key, "full_outer").select(key, *(best[c].alias(c) for c in columns))
