"""Mixing overlapping sources to target weights by min-cost flow."""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from odsflow.llm.common import named, small_table, written

#: Hash positions told apart per step when the cut of a pattern is searched.
BIN_DIGITS, HASH_DIGITS = 3, 32
#: More membership patterns than this are refused: they are listed on the driver.
MAX_PATTERNS = 100_000


def word_count(text: Column) -> Column:
    """The number of `[^\\x20\\x09-\\x0D]+` in a text; 0 for NULL."""
    spaced = F.trim(F.translate(F.coalesce(text.cast("string"), F.lit("")), "\t\n\x0b\x0c\r", "     "))
    return F.when(F.length(spaced) == 0, F.lit(0)).otherwise(F.size(F.split(spaced, " +"))).cast("long")


def share_targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """`total` dealt out by weight; no share above `most` times its size, what is over is dealt out anew.

    Shares at their limit are those with the smallest limit per weight, so they are set in that
    order until the level of the rest is below the next limit.
    """
    targets = [0.0] * len(sizes)
    order = sorted((i for i in range(len(sizes)) if weights[i] > 0), key=lambda i: (most * sizes[i] / weights[i], i))
    left, weight = total, sum(weights[i] for i in order)
    for place, i in enumerate(order):
        level = left / weight
        if most * sizes[i] / weights[i] >= level:
            for j in order[place:]:
                targets[j] = level * weights[j]
            return targets
        targets[i] = float(most * sizes[i])
        left, weight = left - targets[i], weight - weights[i]
    return targets


class FlowNetwork:
    """Maximum flow that grows level by level; with costs that rise per level it is a cheapest one.

    Capacity on the arcs from the origin is added in the order of its cost, and what an earlier
    level has sent never returns to the origin. So the first levels carry all they can before a
    dearer one is used, which is the order of successive cheapest paths.
    """

    def __init__(self, nodes: int):
        self.arcs: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []

    def add(self, a: int, b: int, room: int) -> int:
        self.arcs[a].append(len(self.to))
        self.to.append(b)
        self.room.append(room)
        self.arcs[b].append(len(self.to))
        self.to.append(a)
        self.room.append(0)
        return len(self.to) - 2

    def _distances(self, origin: int) -> list[int]:
        found, queue = [-1] * len(self.arcs), deque([origin])
        found[origin] = 0
        while queue:
            a = queue.popleft()
            for e in self.arcs[a]:
                if self.room[e] > 0 and found[self.to[e]] < 0:
                    found[self.to[e]] = found[a] + 1
                    queue.append(self.to[e])
        return found

    def push(self, origin: int, end: int) -> None:
        """Sends all that still fits, over shortest paths first."""
        while (far := self._distances(origin))[end] >= 0:
            tried = [0] * len(self.arcs)
            path: list[int] = []
            a = origin
            while True:
                if a == end:
                    sent = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= sent
                        self.room[e ^ 1] += sent
                    path, a = [], origin
                    continue
                while tried[a] < len(self.arcs[a]):
                    e = self.arcs[a][tried[a]]
                    if self.room[e] > 0 and far[self.to[e]] == far[a] + 1:
                        break
                    tried[a] += 1
                if tried[a] < len(self.arcs[a]):
                    path.append(e)
                    a = self.to[e]
                elif path:
                    a = self.to[path.pop() ^ 1]
                    tried[a] += 1
                else:
                    break


def route(patterns: Sequence[tuple[frozenset, int]], quotas: dict, copies: int) -> list[tuple[int, dict]]:
    """Words taken of each membership pattern, and for which source.

    `patterns` holds the sources a document may count for and the words of all such documents. The
    k-th repetition of a document costs more than any before it (convex), so repeats are taken only
    where a quota is not to be met otherwise. The result names per pattern the words taken and
    their split over sources.
    """
    sources = sorted({s for members, _ in patterns for s in members}, key=_by_code_point)
    place = {s: 1 + len(patterns) + i for i, s in enumerate(sources)}
    end = 1 + len(patterns) + len(sources)
    net = FlowNetwork(end + 1)
    inward = [net.add(0, 1 + i, 0) for i in range(len(patterns))]
    split = [
        {s: net.add(1 + i, place[s], size * copies) for s in sorted(members, key=_by_code_point)}  # the order decides ties
        for i, (members, size) in enumerate(patterns)
    ]
    for s in sources:
        net.add(place[s], end, int(quotas.get(s, 0) + 0.5))
    for _ in range(copies):
        for arc, (_, size) in zip(inward, patterns):
            net.room[arc] += size
        net.push(0, end)
    return [
        (net.room[arc ^ 1], {s: net.room[e ^ 1] for s, e in split[i].items()})
        for i, arc in enumerate(inward)
    ]


def _by_code_point(source: str | None) -> tuple:
    return (source is None, source or "")


def cut_points(rows: DataFrame) -> DataFrame:
    """Per pattern the last hash that the mix takes once more (`cut`; empty for none).

    `rows` has `pattern_`, `hash_` (hex), `size_`, `extra` (words wanted). Words are added up per
    leading digits of the hash, which is reduced before its shuffle; only the bin that holds the cut
    is looked at more closely, some digits further, so no task ever orders a whole source. A
    document across the cut is taken if at least half of it is wanted.
    """
    # The state has a row per pattern, so at most MAX_PATTERNS; every join to it is a broadcast of that bound.
    state = rows.groupBy("pattern_").agg(F.max("extra").alias("left"))
    state = state.select("pattern_", "left", F.lit("").alias("prefix"), F.lit("").alias("cut"), F.lit(False).alias("done"))
    for digits in range(BIN_DIGITS, HASH_DIGITS + BIN_DIGITS, BIN_DIGITS):
        state = written(state, "cuts")
        if state.where("NOT done").isEmpty():
            break
        open_ones = state.where("NOT done").select(F.col("pattern_").alias("own"), "prefix", "left")
        bins = (
            rows.join(F.broadcast(open_ones), (F.col("pattern_") == F.col("own")) & F.col("hash_").startswith(F.col("prefix")))
            .groupBy("pattern_", "left", F.substring("hash_", 1, digits).alias("bin"))
            .agg(F.sum("size_").alias("size"), F.min("hash_").alias("first"), F.max("hash_").alias("last"))
        )
        so_far = F.sum("size").over(Window.partitionBy("pattern_").orderBy("bin"))
        run = bins.withColumn("rest", F.col("left") - so_far + F.col("size"))
        whole = run.where("size <= rest").groupBy(F.col("pattern_").alias("own")).agg(F.max("last").alias("whole_cut"))
        across = run.where("rest > 0 AND size > rest").select(
            F.col("pattern_").alias("at"), "bin", "rest", F.expr("first = last").alias("single"),
            F.expr("CASE WHEN first = last AND 2 * rest >= size THEN last END").alias("single_cut"),
        )
        joined = state.join(whole, F.col("pattern_") == F.col("own"), "left").join(across, F.col("pattern_") == F.col("at"), "left")
        ended = F.col("done") | F.col("bin").isNull() | F.col("single")
        state = joined.select(
            "pattern_", F.coalesce("rest", "left").alias("left"), F.coalesce("bin", "prefix").alias("prefix"),
            F.coalesce("single_cut", "whole_cut", "cut").alias("cut"), ended.alias("done"),
        )
    return state.select("pattern_", "cut")


def mix(
    docs: DataFrame, quotas: dict, copies: int = 2, seed: int = 42, members_col: str = "members", size_col: str = "size",
    id_col: str = "doc_id",
) -> DataFrame:
    """The rows of `docs` with `copies_taken` (0 to `copies`): how often the mix takes the document.

    `members` is an array of the sources a document may count for (a NULL element is the source
    NULL), `size` its words, `quotas` the words wanted per source. Documents are added up by
    membership pattern; a min-cost flow sends the patterns' words to the quotas, first copies
    before second ones; within a pattern, documents are taken in the order of an MD5 hash of the
    seed and the id until the words sent are reached, to half a document. So a rerun takes the same
    documents, and rows with one id (or with none) are taken alike. NULL members or sizes are no
    members or size 0: such documents are taken 0 times. An empty table gives no rows. Further columns, whatever
    their names, stay as they are; one named `copies_taken` is replaced.
    """
    size = F.coalesce(named(size_col).cast("long"), F.lit(0))
    members = F.array_sort(F.array_distinct(F.coalesce(named(members_col).cast("array<string>"), F.array().cast("array<string>"))))
    hashed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(named(id_col).cast("string"), F.lit(""))))
    own = {"pattern_": F.to_json(members), "members_": members, "size_": size, "hash_": hashed}
    kept = [named(c) for c in docs.columns if c != "copies_taken"]
    keyed = docs.select(F.struct(*kept).alias("row"), *[value.alias(name) for name, value in own.items()])  # names of the rows cannot clash
    rows = written(keyed.where(size > 0).select("pattern_", "members_", "size_", "hash_"), "sizes")
    by_pattern = rows.groupBy("pattern_").agg(F.first("members_").alias("members"), F.sum("size_").alias("size"))
    listed = by_pattern.limit(MAX_PATTERNS + 1).collect()
    if len(listed) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    listed.sort(key=lambda r: r["pattern_"])
    sent = route([(frozenset(r["members"]), r["size"]) for r in listed], quotas, copies)
    plan = [(r["pattern_"], *divmod(words, r["size"])) for r, (words, _) in zip(listed, sent)]
    plans = small_table(docs.sparkSession, plan, pattern=pa.string(), base=pa.int64(), extra=pa.int64())
    wanted = plans.where("extra > 0").select(F.col("pattern").alias("pattern_"), "extra")
    cuts = cut_points(rows.join(F.broadcast(wanted), "pattern_").select("pattern_", "hash_", "size_", "extra"))
    chosen = plans.join(cuts, plans["pattern"] == cuts["pattern_"], "left").select(  # at most MAX_PATTERNS rows
        F.col("pattern").alias("chosen_"), "base", F.coalesce("cut", F.lit("")).alias("cut_")
    )
    more = F.when(F.col("hash_") <= F.col("cut_"), 1).otherwise(0)
    taken = F.when(F.col("size_") > 0, F.col("base") + more).otherwise(0).cast("int")
    return keyed.join(F.broadcast(chosen), F.col("pattern_") == F.col("chosen_"), "left").select(
        "row.*", F.coalesce(taken, F.lit(0)).alias("copies_taken")
    )
