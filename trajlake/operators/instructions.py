"""Goal instructions: a verb for the target, pronoun phrases, a relation phrase, ten sentences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.functions.text import clean_name, is_preposition, participle, third_person

# Verbs of two words that stay together before a pronoun.
INSEPARABLE = ("talk to", "wave at", "sit at", "sit in", "sit on", "connect to", "play with")
DEFAULT_VERB = "interact with"

#: Our own wordings; the slots are those of the columns that ``instructions`` fills in.
TEMPLATES = (
    "{Begin} over in the {room}; it {rel_verb} the {reference}.",
    "Head for the {room}, look for the {target} {rel_part} the {reference}, and {do_pronoun}.",
    "Would you go to the {room} and {do_it}? I mean the one {rel_part} the {reference}.",
    "One {target} in the {room} {rel_verb} the {reference}: your task is to {do_pronoun}.",
    "Start by walking to the {room}. The {target} {rel_part} the {reference} is yours; {do_pronoun}.",
    "Somewhere by the {reference} in the {room}, {do_it}.",
    "The {room} has a {target}. Pick out the one that {rel_verb} the {reference} and {do_pronoun}.",
    "Please help: spot the {target} {rel_part} the {reference} in the {room} and {do_pronoun}.",
    "Locate the {reference} in the {room} first, and {do_it} that {rel_verb} it.",
    "Walk to the {room} and {do_it} {rel_part} the {reference}.",
)


def vocabulary(spark: SparkSession, verbs: dict[str, list[str]]) -> DataFrame:
    """noun, verbs: a small dimension."""
    return spark.createDataFrame(list(verbs.items()), "noun string, verbs array<string>")


def choose(options: Column, seed: str, key: Column) -> Column:
    """One of an array's entries by an md5 of seed and key, so that any engine picks the same."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), key)), 1, 8), 16, 10).cast("long")
    return F.get(options, (h % F.size(options)).cast("int"))


def verb_with_pronoun(verb: Column, noun: Column) -> Column:
    pronoun = F.when(noun == "person", "them").otherwise("it")
    parts = F.split(verb, " ")
    return (
        F.when(verb == "bring me", F.concat(F.lit("bring "), pronoun, F.lit(" to me")))
        .when(verb.isin(*INSEPARABLE), F.concat(verb, F.lit(" "), pronoun))
        .when(F.size(parts) == 2, F.concat(F.get(parts, F.lit(0)), F.lit(" "), pronoun, F.lit(" "), F.get(parts, F.lit(1))))
        .otherwise(F.concat(verb, F.lit(" "), pronoun))
    )


def relation_phrases(rel: Column) -> tuple[Column, Column]:
    """A relation as a finite phrase and as a participle: 'is near' and 'near', 'contains' and 'containing'."""
    return F.when(is_preposition(rel), F.concat(F.lit("is "), rel)).otherwise(third_person(rel)), F.when(is_preposition(rel), rel).otherwise(participle(rel))


def instructions(goals: DataFrame, words: DataFrame, seed: str = "42", templates: tuple[str, ...] = TEMPLATES) -> DataFrame:
    """goal_id, idx, instruction: each goal (goal_id, target, reference, relation, room) in every template.

    A noun without verbs takes the default one. The vocabulary is a fixed dictionary of a few hundred nouns.
    """
    g = goals.withColumn("noun", clean_name(F.col("target"))).join(F.broadcast(words), "noun", "left")
    g = g.withColumn("verb", F.coalesce(choose(F.col("verbs"), seed, F.col("goal_id").cast("string")), F.lit(DEFAULT_VERB)))
    do_it = F.concat(F.col("verb"), F.lit(" the "), F.col("noun"))
    rel_verb, rel_part = relation_phrases(F.col("relation"))
    slots = {
        "Begin": F.concat(F.upper(F.left(do_it, F.lit(1))), F.lower(F.substr(do_it, F.lit(2)))),
        "do_it": do_it,
        "do_pronoun": verb_with_pronoun(F.col("verb"), F.col("noun")),
        "target": F.col("noun"),
        "reference": F.col("reference"),
        "room": F.col("room"),
        "rel_verb": rel_verb,
        "rel_part": rel_part,
    }
    g = g.select("goal_id", *(v.alias(f"s_{k}") for k, v in slots.items()))
    all_ = F.array(*(F.struct(F.lit(i).alias("idx"), F.lit(t).alias("t")) for i, t in enumerate(templates)))
    g = g.withColumn("e", F.explode(all_))
    text = F.col("e.t")
    for k in slots:
        text = F.replace(text, F.lit("{" + k + "}"), F.coalesce(F.col(f"s_{k}"), F.lit("")))
    return g.select("goal_id", F.col("e.idx").alias("idx"), text.alias("instruction"))


def one_instruction(goals: DataFrame, words: DataFrame, seed: str = "42", templates: tuple[str, ...] = TEMPLATES) -> DataFrame:
    """goal_id, idx, instruction: each goal in one template, drawn by its id: the older form, which makes a single sentence."""
    drawn = choose(F.array(*(F.lit(i) for i in range(len(templates)))), seed + "t", F.col("goal_id").cast("string"))
    return instructions(goals, words, seed, templates).where(F.col("idx") == drawn)


def prompt(parts: Column, caption: Column, frame: str) -> Column:
    """A prompt with its lines and caption in the slots {lines} and {caption}."""
    return F.replace(F.replace(F.lit(frame), F.lit("{lines}"), F.array_join(parts, "\n")), F.lit("{caption}"), caption)
