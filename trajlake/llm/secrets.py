"""Secret scans: candidate strings by pattern, and how many repositories and owners share each, by DataFrame functions alone.

Three kinds of base candidates are found by fixed patterns. A fourth, ``token``, is any long run of key-like characters that mixes
digits with upper- and lower-case letters. The hashes of all candidates are counted over the whole corpus by distinct repositories and
distinct owners: what many owners share is an example that people copy; what one owner alone has looks live. The method adds to the base spans
those tokens that at most ``OWNERS`` owners have and that overlap no base span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.llm.common import stage

# Fixed patterns of the base kinds, as text. Runs that are too short are dropped after matching.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: Kinds in their order among spans with one start.
KINDS = ("assign", "access", "hex", "token")
#: Most owners of a live-looking candidate, and fewest of a copied example.
OWNERS, COPIED = 1, 3


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _pieces(text: Column, found: Column, pattern: str, value: Column | None) -> Column:
    """i, skipped (characters between the match before and this one), size, value: of each match, in order.

    The text split at the pattern has what lies between the matches, so sums of lengths give the places, in code points.
    """
    between = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<i:int,skipped:int,size:int,value:string>>")
    each = F.transform(
        found,
        lambda m, i: F.struct(
            i.cast("int").alias("i"),
            F.length(F.get(between, i)).cast("int").alias("skipped"),
            F.length(m).cast("int").alias("size"),
            (m if value is None else F.get(value, i)).alias("value"),
        ),
    )
    return F.when(F.size(found) > 0, each).otherwise(none)


def scan(docs: DataFrame, key: str, text: str, repository: str, owner: str) -> DataFrame:
    """One staged row for each input row: rid, doc_id, repository, owner and the matches of each kind, without the text."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(repository).cast("string").alias("repository"), F.col(owner).cast("string").alias("owner"), t.alias("t"))
    rows = rows.select("*", _matches(F.col("t"), ASSIGN).alias("f0"), _matches(F.col("t"), ACCESS).alias("f1"), _matches(F.col("t"), HEX).alias("f2"), _matches(F.col("t"), TOKEN).alias("f3"))
    second = F.when(F.size("f0") > 0, F.regexp_extract_all(F.col("t"), F.lit(ASSIGN), F.lit(2)))
    found = rows.select(
        F.monotonically_increasing_id().alias("rid"),
        "doc_id",
        "repository",
        "owner",
        _pieces(F.col("t"), F.col("f0"), ASSIGN, second).alias("assign"),
        _pieces(F.col("t"), F.col("f1"), ACCESS, None).alias("access"),
        _pieces(F.col("t"), F.col("f2"), HEX, None).alias("hex"),
        _pieces(F.col("t"), F.col("f3"), TOKEN, None).alias("token"),
    )
    return stage(found, "secrets")


def candidates(scanned: DataFrame) -> DataFrame:
    """rid, repository, owner, kind (its place in KINDS), begin, end, hash: the candidates that count, with their places."""
    def of_kind(name: str, k: int) -> Column:
        return F.transform(name, lambda x: F.struct(F.lit(k).alias("kind"), x["i"].alias("i"), x["skipped"].alias("skipped"), x["size"].alias("size"), x["value"].alias("value")))

    each = F.explode(F.concat(*(of_kind(name, k) for k, name in enumerate(KINDS))))
    rows = scanned.select("rid", "repository", "owner", each.alias("x")).select("rid", "repository", "owner", "x.*")
    end = F.sum(F.col("skipped") + F.col("size")).over(Window.partitionBy("rid", "kind").orderBy("i"))
    rows = rows.withColumn("end", end).withColumn("begin", F.col("end") - F.col("size"))
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[a-z]")
    fit = F.when(F.col("kind") == 0, F.length("value") >= 6).when(F.col("kind") == 3, mixed).otherwise(F.lit(True))
    return rows.where(fit).select("rid", "repository", "owner", "kind", "begin", "end", F.sha2("value", 256).alias("hash"))


def ownership(found: DataFrame) -> DataFrame:
    """hash, repositories, owners: distinct ones over the corpus; nulls are no owner. Partial sums come before each exchange."""
    return found.groupBy("hash").agg(F.countDistinct("repository").alias("repositories"), F.countDistinct("owner").alias("owners"))


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", repository: str = "doc_id", owner: str = "source") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_owned (base candidates of one owner), n_copied (of many): a row for each input row.

    Spans are kind:start:end in code points, the end exclusive, by start and then kind. Null and empty texts have none.
    """
    scanned = scan(docs, key, text, repository, owner)
    found = stage(candidates(scanned), "candidates")
    placed = found.join(ownership(found), "hash")
    by = Window.partitionBy("rid").orderBy("begin", "kind", "end")
    base = F.col("kind") < 3
    before = F.max(F.when(base, F.col("end"))).over(by.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("begin"))).over(by.rowsBetween(1, Window.unboundedFollowing))
    clear = (F.coalesce(before, F.lit(0)) <= F.col("begin")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    kept = placed.withColumn("clear", clear).where(base | (F.col("clear") & (F.col("owners") <= OWNERS)))
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    item = F.struct("begin", "kind", "end", F.concat_ws(":", name, "begin", "end").alias("span"))
    said = kept.groupBy("rid").agg(
        *(F.count_if(F.col("kind") == k).alias(f"n_{KINDS[k]}") for k in range(3)),
        F.array_sort(F.collect_list(F.when(base, item))).alias("base"),
        F.array_sort(F.collect_list(item)).alias("all"),
        F.count_if(base & (F.col("owners") <= OWNERS)).alias("n_owned"),
        F.count_if(base & (F.col("owners") >= COPIED)).alias("n_copied"),
    )
    join = lambda c: F.concat_ws(",", F.transform(F.coalesce(F.col(c), F.array().cast("array<struct<begin:long,kind:int,end:long,span:string>>")), lambda x: x["span"]))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return scanned.select("rid", "doc_id").join(said, "rid", "left").select(
        "doc_id", zero("n_assign"), zero("n_access"), zero("n_hex"), F.sha2(join("base"), 256).alias("base_sha256"), join("all").alias("spans"), zero("n_owned"), zero("n_copied")
    )
