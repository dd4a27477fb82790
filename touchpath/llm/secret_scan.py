"""Secret scans by corpus-wide ownership frequency, DataFrame operations only.

Rules find candidates in every whole text: assignments to a secret's name,
access keys, hex runs, and long mixed tokens without any such context.  All
candidates are hashed and counted across the corpus by distinct repositories
and owners.  A value that several owners have, or a single one in many
repositories, is a widely copied example; any other is a live-looking
credential of its owner.  Base spans (the first three rules) stay as they are;
mixed tokens join them, as kind ``owned``, where they are live.

Defined results: null and empty texts have no spans; a null owner or repository
is a value of its own; a repeated row gets a row each time, and counts once as
repository; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchpath.llm.common import join_groups, stash
from touchpath.llm.native import matches

# --- fixed values of the rules ------------------------------------------------
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
#: kind, pattern, group of the secret, its least length, a test that a text
#: without any such span fails
BASE = [
    ("assign", ASSIGN, 2, 12, ASSIGN.replace("]+)", "]{12})")),
    ("access", ACCESS, 0, 18, "AKIA[A-Z0-9]{14}"),
    ("hex", HEX, 0, 16, "[0-9a-f]{16}"),
]
KINDS = [kind for kind, *_ in BASE] + ["owned"]
MIXED = "[A-Za-z0-9+/_-]{20,}"
#: Owners from which on a value is a copied example.
EXAMPLE_OWNERS = 2
#: Distinct repositories from which on it is one whoever owns them: a credential
#: is used in a few places of its owner, a sample in documentation in many.
EXAMPLE_REPOSITORIES = 10


def _found(text: Column, kind: str, regex: str, group: int, least: int, test: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """Spans of one rule; matches that are too short are dropped after matching."""
    spans = F.filter(matches(text, regex, group), lambda m: (F.length(m["value"]) >= least) & (keep(m["value"]) if keep else F.lit(True)))
    tagged = F.transform(spans, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end"),
                                                   F.sha2(m["value"], 256).alias("hash")))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,hash:string>>")
    return F.when(text.rlike(test), tagged).otherwise(none)


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, repository, owner) with base and mixed spans in
    place of the text, and a number ``row`` for each row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = [_found(text, *rule).alias(rule[0]) for rule in BASE]
    both = lambda v: v.rlike("[0-9]") & v.rlike("[A-Za-z]")
    mixed = _found(text, "owned", MIXED, 0, 20, MIXED, both)
    return docs.select("doc_id", "repository", "owner", *base, mixed.alias("mixed"), F.monotonically_increasing_id().alias("row"))


def apart(spans: DataFrame) -> DataFrame:
    """``spans`` (row, start, end, kind, ..) but the mixed tokens that overlap a base
    span of their row: in the order of starts, the furthest end of the base spans
    that start before a token ends passes the token's start.  One sort per row, so
    a list of any length costs in proportion."""
    owned = F.col("kind") == KINDS.index("owned")
    line = W.partitionBy("row").orderBy(F.when(owned, F.col("end")).otherwise(F.col("start")), ~owned).rowsBetween(W.unboundedPreceding, 0)
    reach = F.max(F.when(~owned, F.col("end"))).over(line)
    return spans.withColumn("reach", reach).where(~owned | F.col("reach").isNull() | (F.col("reach") <= F.col("start"))).drop("reach")


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, rows, repositories, owners) of every candidate value of ``spans``
    (row, hash, repository, owner).  Values are counted per (owner, repository)
    first, so a hot value is spread over tasks until only its owners are left to
    count."""
    once = spans.select("row", "hash", "repository", "owner").distinct()
    per = once.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("rows"))
    per = per.groupBy("hash", "owner").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("repositories"))
    return per.groupBy("hash").agg(F.sum("rows").alias("rows"), F.sum("repositories").alias("repositories"), F.count(F.lit(1)).alias("owners"))


def scan(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """For each row of ``docs`` (doc_id, text, repository, owner): base and all
    spans (array of start, kind, end, hash), and how many of the spans' values
    are one owner's in fewer than ``example_repositories`` (live) or widely
    copied (examples)."""
    found = stash(candidates(docs), "candidates")
    every = F.concat(*[kind for kind, *_ in BASE], "mixed")
    spans = found.select("row", "repository", "owner", F.explode(every).alias("s")).select("row", "repository", "owner", "s.*")
    spans = stash(apart(spans), "spans")
    owned = stash(ownership(spans), "ownership")
    total = owned.agg(F.sum("rows")).first()[0] or 0
    judged = join_groups(spans.drop("repository", "owner"), owned, "hash", "rows", total).withColumn(
        "live", (F.col("owners") < example_owners) & (F.col("repositories") < example_repositories))
    own = F.struct("start", "kind", "end", "hash")
    per = judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when((F.col("kind") == KINDS.index("owned")) & F.col("live"), own))).alias("added"),
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_examples"))
    base = F.array_sort(F.concat(*[kind for kind, *_ in BASE]))
    out = found.join(per, "row", "left")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,hash:string>>")
    return out.select("doc_id", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind, *_ in BASE], base.alias("base"),
                      F.array_sort(F.concat(base, F.coalesce("added", none))).alias("all"),
                      F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_examples", F.lit(0)).alias("n_examples"))


def written(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")
