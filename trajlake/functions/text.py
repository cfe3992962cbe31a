"""Names, identifiers and sentences as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Names that the segmentation would get wrong, and what they become.
NAME_FIXES = {
    "sofachair": "sofa chair",
    "sofa_chair": "sofa chair",
    "sofa": "sofa",
    "chestofdrawers": "chest of drawers",
    "tvstand": "tv stand",
    "tv_stand": "tv stand",
    "closestool": "closestool",
    "cookware": "cookware",
    "builtin_oven": "built-in oven",
    "dish_washer": "dishwasher",
    "spot_lig": "spotlight",
    "spot_light": "spotlight",
    "night_stand": "nightstand",
    "nightstand": "nightstand",
    "doorsil": "doorsill",
    "doorsill": "doorsill",
}
# Relations that are prepositions; all others are verbs.
PREPOSITIONS = ("above", "below", "in", "near", "on", "under", "out of", "next to", "by", "in front of", "behind", "to the right of", "to the left of", "with")


def instance_id(path: Column) -> Column:
    """The last two parts of a path."""
    parts = F.split(path, "/")
    return F.concat_ws("/", F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2))


def object_type(full_id: Column) -> Column:
    """The parts between underscores before the first that is all digits; the whole id if there are none."""
    parts = F.split(full_id, "_")
    first = F.coalesce(F.array_position(F.transform(parts, lambda p: p.rlike("^[0-9]+$")), True), F.lit(0))
    return F.when(first == 0, full_id).when(first == 1, full_id).otherwise(F.array_join(F.slice(parts, F.lit(1), (first - 1).cast("int")), "_"))


def strip_number(full_id: Column) -> Column:
    """An id without a last underscore and four characters, if it has them."""
    n = F.length(full_id)
    return F.when((n > 5) & (F.substring(full_id, -5, 1) == "_"), F.left(full_id, n - 5)).otherwise(full_id)


def object_name(full_id: Column) -> Column:
    """The words before the number of an id that has a slash; 'object' without one."""
    name = F.regexp_extract(full_id, r"^([a-zA-Z_]+)(_\d+)?(/.*)?", 1)
    spaced = F.trim(F.translate(F.when(name != "", name).otherwise(F.split_part(full_id, F.lit("_"), F.lit(1))), "_", " "))
    return F.when(F.coalesce(full_id, F.lit("")).contains("/"), spaced).otherwise("object")


def clean_name(name: Column, segment=None) -> Column:
    """A name in words: fixed names first, then number tails out, underscores to spaces, and the segmentation (if one is given)."""
    low = F.lower(name)
    bare = low
    for tail in ("_0000", "_000", "_00", "_0"):
        bare = F.replace(bare, F.lit(tail), F.lit(""))
    words = F.replace(bare, F.lit("_"), F.lit(" "))
    fixes = F.create_map(*(F.lit(x) for kv in NAME_FIXES.items() for x in kv))
    return F.coalesce(fixes[low], segment(words) if segment else words)


def natural_key(name: Column, width: int = 20) -> Column:
    """A key whose order as a string is the natural one: runs of digits by value. Runs longer than ``width`` digits keep their text."""
    tokens = F.regexp_extract_all(name, F.lit(r"\d+|\D+"), F.lit(0))
    return F.array_join(F.transform(tokens, lambda t: F.when(t.rlike(r"^\d+$") & (F.length(t) <= width), F.lpad(t, width, "0")).otherwise(t)), "")


def path_ids(name: Column) -> Column:
    """Struct (goal, start) of path_<goal>_<start>: exactly three parts, both whole numbers; else nulls."""
    parts = F.split(name, "_")
    ok = F.size(parts) == 3
    get = lambda i: F.when(ok, F.get(parts, F.lit(i)).try_cast("int"))
    both = get(1).isNotNull() & get(2).isNotNull()
    return F.struct(F.when(both, get(1)).alias("goal"), F.when(both, get(2)).alias("start"))


def goal_of(name: Column) -> Column:
    """The goal of any name with _<goal>_<start> in it; -1 otherwise."""
    return F.coalesce(F.regexp_extract(name, r"^.*?_(\d+)_(\d+)", 1).try_cast("int"), F.lit(-1))


def relation_word(rel: Column) -> Column:
    """One word for a relation: 'out of' is near, and of alternatives the first."""
    return F.when(rel == "out of", "near").otherwise(F.substring_index(rel, "/", 1))


def room_of(scope: Column) -> Column:
    """The room of a scope, or null for scopes that aren't rooms."""
    room = F.split_part(scope, F.lit("_"), F.lit(1))
    return F.when(F.lower(room).isin("unknown", "wall", "other"), None).otherwise(room)


def episode_id(scene: Column, goal: Column, start: Column) -> Column:
    return F.concat_ws("_", scene, goal.cast("string"), start.cast("string"))


def is_preposition(rel: Column) -> Column:
    """Whether a relation, in any case, is one of the closed list."""
    return F.lower(rel).isin(*PREPOSITIONS)


def third_person(verb: Column) -> Column:
    """A verb's form with he, she or it, by its ending: carries, touches, holds."""
    return (
        F.when(verb.rlike("[^aeiou]y$"), F.concat(F.left(verb, F.length(verb) - 1), F.lit("ies")))
        .when(verb.rlike("(s|x|z|ch|sh|o)$"), F.concat(verb, F.lit("es")))
        .otherwise(F.concat(verb, F.lit("s")))
    )


def participle(verb: Column) -> Column:
    """A verb's form in -ing, by its ending: lying, facing, containing. Short stems that double their last letter aren't told from others."""
    return (
        F.when(verb.rlike("ie$"), F.concat(F.left(verb, F.length(verb) - 2), F.lit("ying")))
        .when(verb.rlike("[^eoy]e$"), F.concat(F.left(verb, F.length(verb) - 1), F.lit("ing")))
        .otherwise(F.concat(verb, F.lit("ing")))
    )


def segmenter(words: list[str]):
    """A function for ``clean_name``: splits each run of letters into the fewest words of a list (ties: the longer word first).

    A run that the list can't make up stays whole. The list goes to the workers with the function; it is a dictionary of some thousand words.
    """
    known, longest = frozenset(words), max(map(len, words), default=0)

    def cut(run: str) -> str:
        best: list[tuple[int, list[str]] | None] = [None] * len(run) + [(0, [])]
        for i in range(len(run) - 1, -1, -1):
            for j in range(min(len(run), i + longest), i, -1):
                rest = best[j]
                if rest is not None and run[i:j] in known and (best[i] is None or rest[0] + 1 < best[i][0]):
                    best[i] = (rest[0] + 1, [run[i:j], *rest[1]])
        return " ".join(best[0][1]) if best[0] is not None else run

    @F.pandas_udf("string")
    def split(names: pd.Series) -> pd.Series:
        return names.map(lambda t: None if t is None else " ".join(cut(w) for w in t.replace("-", " ").split()))

    return split


def action_file(path: Column) -> tuple[Column, Column]:
    """The action file of a path file, and the name to try where that isn't there."""
    other = F.replace(F.replace(path, F.lit("/npy/"), F.lit("/actions/")), F.lit(".npy"), F.lit(".json"))
    return F.replace(other, F.lit("path"), F.lit("actions")), other


def goal_image(source: Column, goal: Column) -> Column:
    """Where a goal's image lies, beside the file that names the goal."""
    return F.concat(F.regexp_replace(source, "/[^/]*$", ""), F.lit("/ref/goal_"), goal.cast("string"), F.lit(".png"))
