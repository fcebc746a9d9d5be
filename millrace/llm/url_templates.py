"""URL filter by path templates.

Each host has a tree of path templates. Segments that are variable by their form (numbers,
long hexadecimal or very long names) become classes. Then, from the root to the deepest
path, the children of a node become one wildcard if they are many and evenly spread, and
those that resemble their siblings are merged: the same continuations, and label rates that
do not differ significantly. A node with one child leaves nothing to decide, so a round goes
down to the next node that branches: there are as many rounds as such nodes on one path, not
as many as segments. A template is rejected if the smoothed share of blocked pages among its
labelled ones is high. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .shared import ascii_lower, new_folder, stored

Rule = tuple[str, str, bool]  # host, path, blocked

ANY = "*"
END = "//"
# A node's children are one wildcard from this many on, if their entropy reaches this share
# of the largest possible one.
MANY = 12
SPREAD = 0.7
# Least overlap of continuations, and largest z score of label rates, of merged branches.
ALIKE = 0.5
Z = 1.96
# Weight of the parent's rate, in labelled pages, and the share from which a template goes.
PRIOR = 10.0
PURITY = 0.8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both are empty for a null url and one without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def rule_name(rule: Rule) -> str:
    return rule[0] + rule[1]


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name of the longest rule that fits and whether it blocks; nulls if none does."""
    name, blocked = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    for rule in sorted(rules, key=lambda r: (len(rule_name(r)), r)):
        fits = ((host == rule[0]) | host.endswith("." + rule[0])) & path.startswith(rule[1])
        name = F.when(fits, F.lit(rule_name(rule))).otherwise(name)
        blocked = F.when(fits, F.lit(rule[2])).otherwise(blocked)
    return name, blocked


def shape(segment: Column) -> Column:
    """A segment with what is variable by its form replaced."""
    plain = F.regexp_replace(segment, "[0-9]+", "0")
    hexadecimal = segment.rlike("^[0-9a-fA-F-]{12,}$") & segment.rlike("[0-9]")
    return F.when(hexadecimal, F.lit("{hex}")).when(F.length(segment) > 40, F.lit("{long}")).otherwise(plain)


def shapes(path: Column) -> Column:
    """The segments of a path, each with its shape; none if the path is empty."""
    return F.transform(F.slice(F.split(path, "/"), 2, 1 << 30), shape)


def extended(done: Column, segments: Column) -> Column:
    """A template followed by more segments."""
    return F.concat_ws("/", F.concat(F.array(done), segments))


def to_branches(paths: DataFrame) -> DataFrame:
    """Move every path of ``paths(host, key, rest, done, n, labelled, blocked)`` down to the
    first node below ``done`` that branches; all the way if there is none.

    The largest path of a node stands for the one all others follow, or end on, until one
    of them leaves it.
    """
    node = ["host", "done"]
    longest = paths.groupBy(*node).agg(F.max("rest").alias("along"))
    same = F.transform("rest", lambda s, i: s == F.coalesce(F.get("along", i), F.lit(END)))
    leaves = F.array_position(same, F.lit(False)) - 1
    branch = (
        paths.join(longest, node).select(*node, leaves.alias("leaves")).where("leaves >= 0")
        .groupBy(*node).agg(F.min("leaves").cast("int").alias("at"))
    )
    at = F.coalesce("at", F.size("rest"))
    return paths.join(branch, node, "left").select(
        "host", "key", extended(F.col("done"), F.slice("rest", F.lit(1), at)).alias("done"),
        F.slice("rest", at + 1, F.size("rest")).alias("rest"), "n", "labelled", "blocked",
    )


def generalised(paths: DataFrame) -> DataFrame:
    """Extend ``done`` of ``paths(host, key, rest, done, n, labelled, blocked)`` by one level;
    every path has a rest."""
    here = paths.withColumns({"seg": F.get("rest", F.lit(0)), "next": F.get("rest", F.lit(1))})
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]
    node, branch = ["host", "done"], ["host", "done", "seg"]
    edges = here.groupBy(*branch, "next").agg(*sums)
    branches = edges.groupBy(*branch).agg(*sums)
    nodes = branches.groupBy(*node).agg(
        F.sum("n").alias("all_n"), F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"),
        F.count("*").alias("children"), F.sum(F.col("n") * F.log("n")).alias("nlogn"),
    )
    following = edges.groupBy(*node, "next").agg(F.sum("n").alias("pool_n"))
    # The end of a path is a continuation too, unlike any segment.
    follow = F.coalesce("next", F.lit(END)).alias("follow")
    one = edges.select(*branch, follow, F.col("n").alias("edge_n"))
    two = following.select(*node, follow, "pool_n")
    shared = (
        one.join(two, [*node, "follow"])
        .join(branches.select(*branch, F.col("n").alias("branch_n")), branch)
        .join(nodes.select(*node, "all_n"), node)
        .groupBy(*branch)
        .agg(F.sum(F.least(F.col("edge_n") / F.col("branch_n"), F.col("pool_n") / F.col("all_n"))).alias("overlap"))
    )
    entropy = F.log("all_n") - F.col("nlogn") / F.col("all_n")
    # Rounded, so that the order of a sum decides nothing.
    variable = (F.col("children") >= MANY) & (F.round(entropy - SPREAD * F.log("children"), 9) >= 0)
    others = F.col("all_labelled") - F.col("labelled")
    pooled = F.try_divide("all_blocked", "all_labelled")
    apart = F.try_divide("blocked", "labelled") - F.try_divide(F.col("all_blocked") - F.col("blocked"), others)
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), "labelled") + F.try_divide(F.lit(1), others)))
    differs = (F.col("labelled") > 0) & (others > 0) & (F.round(F.abs(apart) - Z * error, 9) > 0)
    merged = (F.col("children") > 1) & (F.round("overlap", 9) >= ALIKE) & ~F.coalesce(differs, F.lit(False))
    names = (
        branches.join(nodes, node).join(shared, branch)
        .select(*branch, F.when(variable | merged, F.lit(ANY)).otherwise(F.col("seg")).alias("name"))
    )
    return here.join(names, branch).select(
        "host", "key", extended(F.col("done"), F.array("name")).alias("done"),
        F.slice("rest", 2, 1 << 30).alias("rest"), "n", "labelled", "blocked",
    )


def smoothed(blocked: str, labelled: str, prior: Column) -> Column:
    return (F.col(blocked) + PRIOR * prior) / (F.col(labelled) + PRIOR)


def templates(paths: DataFrame) -> DataFrame:
    """``(host, key, template, purity)`` of every shaped path ``(host, key, rest, n, labelled,
    blocked)``. A template's rate leans on its host's, that on the rate of all.

    Paths that have reached their end wait in a folder of their round; the others go on.
    """
    spark = paths.sparkSession
    folder, ends, rounds = new_folder(spark, "templates"), F.size("rest") == 0, 0
    going = stored(paths.withColumn("done", F.lit("")), "paths")
    while True:
        here = stored(to_branches(going), "tree", small=True)
        ended = here.where(ends).select("host", "key", "done", "n", "labelled", "blocked")
        ended.write.parquet(f"{folder}/round={rounds}")
        here = here.where(~ends)
        if here.isEmpty():
            break
        going, rounds = stored(generalised(here), "tree", small=True), rounds + 1
    tree = spark.read.schema(ended.schema).parquet(folder)
    blocked, labelled = tree.agg(F.sum("blocked"), F.sum("labelled")).first()
    rate = F.lit((blocked or 0) / labelled if labelled else 0.0)
    sums = [F.sum(c).alias(c) for c in ("labelled", "blocked")]
    by_template = tree.groupBy("host", "done").agg(*sums)
    hosts = by_template.groupBy("host").agg(*sums)
    by_host = hosts.select("host", smoothed("blocked", "labelled", rate).alias("host_rate"))
    rated = by_template.join(by_host, "host").select(
        "host", "done", smoothed("blocked", "labelled", F.col("host_rate")).alias("purity")
    )
    return tree.join(rated, ["host", "done"]).select("host", "key", F.col("done").alias("template"), "purity")


def judge_urls(df: DataFrame, rules: Sequence[Rule], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity``, one row per input row.

    A page with a rule has the rule's verdict, and those verdicts label the templates. Any
    other page is blocked if its template's purity reaches PURITY, else allowed. A null url
    has empty host and path. Templates reach as deep as the paths do. Repeated rows each count and each get their row; other columns
    are ignored; an empty table gives no rows.
    """
    host, path = host_and_path(F.col(url))
    pages = df.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    name, blocked = rule_of(F.col("host"), F.col("path"), rules)
    pages = pages.select("*", name.alias("rule"), blocked.alias("rule_blocks"), shapes(F.col("path")).alias("segments"))
    pages = pages.withColumn("key", extended(F.lit(""), F.col("segments")))
    paths = pages.groupBy("host", "key").agg(
        F.first("segments").alias("rest"), F.count("*").alias("n"), F.count("rule").alias("labelled"),
        F.sum(F.coalesce(F.col("rule_blocks").cast("long"), F.lit(0))).alias("blocked"),
    )
    found = stored(templates(paths), "templates")
    rows = pages.join(found, ["host", "key"])
    block = F.coalesce(F.col("rule_blocks"), F.col("purity") >= PURITY)
    verdict = F.when(block, F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "template", "purity")
