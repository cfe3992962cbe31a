"""Which objects of a scene can be named by another one: counts over a source's edges, forward and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.functions.text import object_type
from trajlake.storage import materialize


def coarse(category: Column) -> Column:
    """The first part of a category."""
    return F.split_part(category, F.lit("_"), F.lit(1))


def unique_edges(edges: DataFrame, targets_before_count: Column | None = None) -> DataFrame:
    """The edges with kind: 'relational' if the source has one edge of that relation, else 'semantic' if it has one of
    that relation and coarse category, else null. A null category is never semantic.

    ``targets_before_count`` keeps some targets only, before anything is counted; the usual form counts all neighbours.
    """
    e = edges if targets_before_count is None else edges.where(targets_before_count)
    e = e.withColumn("coarse", coarse(F.col("dst_category")))
    by = lambda *c: F.count(F.lit(1)).over(Window.partitionBy("scene", "src", "rel", *c))
    kind = F.when(by() == 1, "relational").when(F.col("coarse").isNotNull() & (by("coarse") == 1), "semantic")
    return e.withColumn("kind", kind).drop("coarse")


def denied(name: Column, words: list[str]) -> Column:
    """Whether an id holds one of the words, taken as they are."""
    out = F.lit(False)
    for w in words:
        out = out | name.contains(w)
    return out


def denied_type(full_id: Column, types: list[str]) -> Column:
    """Whether an id's type, as a whole, is one of the list."""
    kind = object_type(F.split_part(full_id, F.lit("/"), F.lit(1)))
    return kind.isin(list(types)) if types else F.lit(False)


def one_way_descriptions(edges: DataFrame) -> DataFrame:
    """description: 'target relation source kind' in categories, distinct, for edges that are unique by relation or by relation and category; an edge may be both."""
    by = lambda *c: F.count(F.lit(1)).over(Window.partitionBy("scene", "src", "rel", *c))
    e = edges.withColumns({"n_rel": by(), "n_cat": by("dst_category")})
    say = lambda kind: F.concat_ws(" ", F.coalesce("dst_category", F.lit("unknown")), "rel", F.coalesce("src_category", F.lit("unknown")), F.lit(kind))
    kinds = F.filter(F.array(F.when(F.col("n_rel") == 1, say("relational")), F.when(F.col("n_cat") == 1, say("semantic"))), lambda x: x.isNotNull())
    return e.select(F.explode(kinds).alias("description")).distinct()


def type_descriptions(goals: DataFrame, deny: list[str] = ()) -> DataFrame:
    """description: mutual goals by exact type, 'type relation type relation'; a goal and its reverse are one, instances of a type collapse."""
    g = goals.where(~denied_type(F.col("object_1_id"), list(deny)) & ~denied_type(F.col("object_2_id"), list(deny)))
    kind = lambda c: object_type(F.split_part(F.col(c), F.lit("/"), F.lit(1)))
    one = F.concat_ws(" ", kind("object_1_id"), "object_1_relation_to_2", kind("object_2_id"), "object_2_relation_to_1")
    two = F.concat_ws(" ", kind("object_2_id"), "object_2_relation_to_1", kind("object_1_id"), "object_1_relation_to_2")
    return g.select(F.least(one, two).alias("description")).distinct()


def sentences(goals: DataFrame) -> DataFrame:
    """description of each mutual goal with full ids: the list form of the result."""
    return goals.select(F.format_string("%s [%s] <=> %s [%s] (%s)", "object_1_id", "object_1_relation_to_2", "object_2_id", "object_2_relation_to_1", "kind").alias("description"))


def mutual_goals(edges: DataFrame, deny_sources: list[str] = (), deny_targets: list[str] = (), seed: str = "1025", both: bool = True) -> DataFrame:
    """object_1 (the target), what it is to object_2, object_2 (the source), the reverse relation, and the forward kind.

    Unique forward and (``both``) unique in reverse; with ``both`` false, those that are unique forward only. One direction of a pair
    is kept: that whose source comes first in a seeded order of ids. ``goals.in_order`` puts those of kind relational first. Edges with back_rel
    (``relations.few_edges``) need no reverse edge beside them: one that is left out is not unique.
    """
    known = "back_rel" in edges.columns
    counted = materialize(unique_edges(edges).select("scene", "src", "dst", "rel", "kind", *(["back_rel"] if known else [])), "kinds")
    u = counted.where("kind is not null").where(~denied(F.col("src"), list(deny_sources)) & ~denied(F.col("dst"), list(deny_targets)))
    back = counted.select("scene", F.col("src").alias("dst"), F.col("dst").alias("src"), F.col("rel").alias("back_rel"), F.col("kind").alias("back_kind"))
    if known and not both:
        u, back = u.withColumnRenamed("back_rel", "known"), back.withColumn("met", F.lit(True))
        j = u.join(back, ["scene", "src", "dst"], "left").withColumn("back_rel", F.when(F.col("met"), F.col("back_rel")).otherwise(F.col("known")))
    else:
        j = u.drop("back_rel").join(back, ["scene", "src", "dst"])
    j = j.where(F.col("back_kind").isNotNull() if both else F.col("back_kind").isNull())
    rank = F.md5(F.concat(F.lit(seed + "|"), "src"))
    w = Window.partitionBy("scene", F.least("src", "dst"), F.greatest("src", "dst")).orderBy(rank, "src", "dst")
    kept = j.withColumn("n", F.row_number().over(w)).where("n = 1") if both else j
    return kept.select("scene", F.col("dst").alias("object_1_id"), F.col("rel").alias("object_1_relation_to_2"), F.col("src").alias("object_2_id"), F.col("back_rel").alias("object_2_relation_to_1"), "kind")
