"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern, the set of sources they belong to. A flow
routes word capacity from patterns to source quotas; the first pass over a pattern costs
nothing and every further one more than the one before, so repetition is spread evenly.
Documents then supply their pattern's flow: all of them its whole passes, and those first
in a seeded order the rest. Only sums by pattern reach the driver.
"""

from __future__ import annotations

import heapq
from collections.abc import Hashable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import WORD, stored

# Cost of a word's first, second and third pass; a document is taken three times at most.
PASS_COSTS = (0, 1, 3)
# Patterns the driver takes: one small row each. More are an error, not a cut.
PATTERN_LIMIT = 100_000
# Hexadecimal digits of the seeded order that are summed before single rows are ordered, in
# steps: a step looks at the next digits inside the range that the one before has found, so
# no more than 256 sums of a pattern meet.
STEPS = (2, 4, 6)


def targets(sizes: Sequence[int], weights: Sequence[int], repeats: int) -> list[float]:
    """Shares of the total by weight, at most ``repeats`` times a source's size; what is
    above goes to the others by weight, until none is above."""
    found, rest, weight = [0.0] * len(sizes), sum(sizes), sum(weights)
    # Sources fill up in order of size by weight.
    order = sorted(range(len(sizes)), key=lambda i: (repeats * sizes[i] / weights[i], i))
    for place, i in enumerate(order):
        if repeats * sizes[i] * weight <= rest * weights[i]:
            found[i] = float(repeats * sizes[i])
            rest -= repeats * sizes[i]
            weight -= weights[i]
        else:
            for j in order[place:]:
                found[j] = rest * weights[j] / weight
            break
    return found


class Flow:
    """Min-cost flow: for each cost of a path, from the lowest on, as much as fits at once."""

    def __init__(self) -> None:
        self.ids: dict[Hashable, int] = {}
        self.out: list[list[int]] = []
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def node(self, name: Hashable) -> int:
        if name not in self.ids:
            self.ids[name] = len(self.out)
            self.out.append([])
        return self.ids[name]

    def arc(self, a: Hashable, b: Hashable, room: int, cost: int) -> int:
        at = len(self.to)
        for here, there, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[self.node(here)].append(len(self.to))
            self.to.append(self.node(there))
            self.room.append(r)
            self.cost.append(c)
        return at

    def solve(self, start: Hashable, end: Hashable) -> None:
        source, sink = self.node(start), self.node(end)
        height = [0] * len(self.out)
        while True:
            far = self.distances(source, height)
            if far[sink] == float("inf"):
                return
            # Arcs that lie on a cheapest path now cost nothing between the heights.
            height = [h + min(f, far[sink]) for h, f in zip(height, far)]
            while self.push(source, sink, height):
                pass

    def distances(self, source: int, height: list[int]) -> list[float]:
        far: list[float] = [float("inf")] * len(self.out)
        far[source], queue = 0, [(0, source)]
        while queue:
            d, v = heapq.heappop(queue)
            if d > far[v]:
                continue
            for a in self.out[v]:
                step = d + self.cost[a] + height[v] - height[self.to[a]]
                if self.room[a] and step < far[self.to[a]]:
                    far[self.to[a]] = step
                    heapq.heappush(queue, (step, self.to[a]))
        return far

    def push(self, source: int, sink: int, height: list[int]) -> bool:
        """A blocking flow over the shortest of the cheapest paths; whether there was any."""
        level = [-1] * len(self.out)
        level[source], front = 0, [source]
        while front and level[sink] < 0:
            reached = []
            for v in front:
                for a in self.out[v]:
                    w = self.to[a]
                    if level[w] < 0 and self.room[a] and self.cost[a] + height[v] == height[w]:
                        level[w] = level[v] + 1
                        reached.append(w)
            front = reached
        if level[sink] < 0:
            return False
        at, path, v = [0] * len(self.out), [], source
        while True:
            if v == sink:
                amount = min(self.room[a] for a in path)
                for a in path:
                    self.room[a] -= amount
                    self.room[a ^ 1] += amount
                full = next(n for n, a in enumerate(path) if not self.room[a])
                v = self.to[path[full] ^ 1]
                del path[full:]
                continue
            while at[v] < len(self.out[v]):
                a = self.out[v][at[v]]
                w = self.to[a]
                if self.room[a] and level[w] == level[v] + 1 and self.cost[a] + height[v] == height[w]:
                    break
                at[v] += 1
            if at[v] < len(self.out[v]):
                path.append(self.out[v][at[v]])
                v = self.to[path[-1]]
            elif path:
                v = self.to[path.pop() ^ 1]
                at[v] += 1
            else:
                return True


def routed(patterns: dict[tuple, int], quotas: dict[Hashable, int]) -> dict[tuple, int]:
    """Words to take from each pattern (sources -> words it holds) for the quotas."""
    flow, arcs = Flow(), {}
    for pattern, size in sorted(patterns.items(), key=str):
        arcs[pattern] = [flow.arc("in", ("p", pattern), size, cost) for cost in PASS_COSTS]
        for source in pattern:
            flow.arc(("p", pattern), ("s", source), size * len(PASS_COSTS), 0)
    for source, quota in quotas.items():
        flow.arc(("s", source), "out", quota, 0)
    flow.solve("in", "out")
    return {pattern: sum(flow.room[a ^ 1] for a in own) for pattern, own in arcs.items()}


def by_code_point(name: str | None) -> tuple[bool, str]:
    """Order of source names, null last."""
    return name is None, name or ""


def mix(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", sources: Column | None = None,
    weights: Sequence[int] = (1, 2, 3), seed: int = 7,
) -> DataFrame:
    """How many words of every document the mix takes.

    ``sources`` is an array of the sources a document belongs to (default: its ``source``);
    null is a source too. Weights repeat over the sources in order of code point, null
    last. Returns the input's columns and ``size, source_size, target, taken, times``: for
    a document of several sources ``source_size`` and ``target`` are their sums. A null
    text has size 0 and is taken 0 times. Rows of one id (or without one) and one size tie in
    the seeded order; where a quota ends among them, as many of them as fit are taken.
    Columns of those names are replaced. An empty table gives no rows.
    """
    made = ("size", "source_size", "target", "taken", "times")
    keep = [c for c in df.columns if c not in made]
    members = F.array(F.col("source")) if sources is None else F.array_sort(F.array_distinct(sources))
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    # The input's columns stay in a struct of their own, so their names clash with none.
    counted = df.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"), members.alias("_members"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"), size.alias("size"),
    )
    mixed = taken(counted, weights, seed)
    return mixed.select(*[F.col("_row").getField(c).alias(c) for c in keep], *made)


def taken(counted: DataFrame, weights: Sequence[int], seed: int) -> DataFrame:
    spark = counted.sparkSession
    # Order by a seeded hash of id and size, and its first digits for the sums.
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_id"), F.col("size")))
    counted = counted.select("_row", "_members", "size", mark.alias("_mark"))
    small = stored(counted.select("_members", "_mark", "size"), "sizes")
    held = small.groupBy("_members").agg(F.sum("size").alias("size")).limit(PATTERN_LIMIT + 1).collect()
    if len(held) > PATTERN_LIMIT:
        raise ValueError(f"more than {PATTERN_LIMIT} membership patterns")
    patterns = {tuple(r._members): r.size for r in held}
    names = sorted({s for p in patterns for s in p}, key=by_code_point)
    sizes = [sum(size for p, size in patterns.items() if s in p) for s in names]
    total = sum(patterns.values())
    own = [weights[i % len(weights)] for i in range(len(names))]
    wanted = dict(zip(names, scaled(targets(sizes, own, len(PASS_COSTS)), sizes, total)))
    flows = routed(patterns, {s: int(t + 0.5) for s, t in wanted.items()})
    of = dict(zip(names, sizes))
    plan = [
        (list(p), sum(of[s] for s in p), float(sum(wanted[s] for s in p)),
         flows[p] // size if size else 0, flows[p] % size if size else 0)
        for p, size in patterns.items()
    ]
    shape = "_members array<string>, source_size bigint, target double, passes bigint, rest bigint"
    plan = spark.createDataFrame(plan, shape).withColumn("_key", F.to_json("_members", {"ignoreNullFields": "false"}))

    # Where in the seeded order each pattern's rest ends: by leading digits, then by row.
    # One row for every pattern, of which there are PATTERN_LIMIT at most.
    key = F.to_json("_members", {"ignoreNullFields": "false"})
    small = small.withColumn("_key", key)
    edge = plan.select("_key", F.lit("").alias("edge"), F.lit(0).cast("long").alias("before"), "rest")
    for digits in STEPS:
        inside = small.join(F.broadcast(edge), "_key").where(F.col("_mark").startswith(F.col("edge")))
        heads = inside.groupBy("_key", F.substring("_mark", 1, digits).alias("head")).agg(
            F.sum("size").alias("size"), F.first("before").alias("before"), F.first("rest").alias("rest")
        )
        order = Window.partitionBy("_key").orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
        heads = heads.withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
        heads = heads.where("before < rest and before + size >= rest")
        edge = stored(heads.select("_key", F.col("head").alias("edge"), "before", "rest"), "edge")
    inside = small.join(F.broadcast(edge), "_key").where(F.col("_mark").startswith(F.col("edge")) & (F.col("size") > 0))
    # Rows that tie are one entry, of which a number of copies may count.
    entries = inside.groupBy("_key", "_mark").agg(
        F.count("*").alias("copies"), F.first("size").alias("size"), F.first("before").alias("before"), F.first("rest").alias("rest")
    )
    row = Window.partitionBy("_key").orderBy("_mark").rowsBetween(Window.unboundedPreceding, -1)
    entries = entries.withColumn("before", F.col("before") + F.coalesce(F.sum(F.col("copies") * F.col("size")).over(row), F.lit(0)))
    # The row across the end counts if more than half of it lies before the end.
    fit = F.least("copies", F.expr("greatest(2 * rest - 2 * before + size, 0L) div (2 * size)"))
    last = entries.withColumn("fit", fit).where("fit > 0").groupBy("_key").agg(F.max(F.struct("_mark", "fit", "copies")).alias("last"))
    ends = stored(plan.join(edge.select("_key", "edge"), "_key", "left").join(last, "_key", "left").drop("_members"), "ends")
    rows = counted.withColumn("_key", key).join(F.broadcast(ends), "_key")
    extra = (F.substring("_mark", 1, STEPS[-1]) < F.col("edge")) | (
        F.col("_mark").startswith(F.col("edge")) & (F.col("_mark") <= F.col("last._mark"))
    )
    split = F.coalesce((F.col("_mark") == F.col("last._mark")) & (F.col("last.fit") < F.col("last.copies")), F.lit(False))
    told = rows.where(~split).withColumn("_extra", F.coalesce(extra, F.lit(False)))
    if ends.where("last.fit < last.copies").limit(1).count():
        told = told.unionByName(first_copies(rows.where(split)))
    times = F.when(F.col("size") > 0, F.col("passes") + F.col("_extra").cast("long")).otherwise(0)
    return told.withColumn("times", times).withColumn("taken", F.col("size") * F.col("times"))


def first_copies(tied: DataFrame) -> DataFrame:
    """Whether a row is among the ``last.fit`` first of its pattern's tied ones, as they are
    written: numbered within each written task, tasks by sums, so no task holds them all."""
    tied = stored(tied.withColumn("_n", F.monotonically_increasing_id()), "ties").withColumn("_task", F.shiftright("_n", 33))
    tasks = tied.groupBy("_key", "_task").agg(F.count("*").alias("_held"))
    order = Window.partitionBy("_key").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("_key", "_task", F.coalesce(F.sum("_held").over(order), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_key", "_task").orderBy("_n"))
    placed = tied.withColumn("_place", place).join(tasks, ["_key", "_task"])
    placed = placed.withColumn("_extra", F.col("_before") + F.col("_place") <= F.col("last.fit"))
    return placed.drop("_n", "_task", "_place", "_before")


def scaled(wanted: list[float], sizes: list[int], total: int) -> list[float]:
    """Overlapping sources count shared words several times; their quotas share the words once."""
    whole = sum(sizes)
    return wanted if whole == total or not whole else [t * total / whole for t in wanted]
