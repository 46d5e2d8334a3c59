"""Sharding by balanced label propagation, with DataFrame operations only.

Documents that share a link key are linked. They start side by side: ranked by their
first key, they fill one shard after the other, so that only groups at the end of a
shard are split. Groups of one key that start whole are settled and take no part in
the rounds. In every round each link key counts its documents by shard, each
document adds up the counts of its keys, and those that would be with more of
their neighbours elsewhere ask to move there, be it full or not. Moves are
admitted in hash order up to what swaps, rings of moves and free places allow, so
no shard ever holds more than its quota. Rounds go on while they bring neighbours
together. Documents without links fill the places that are left, which makes the
number of rows per shard differ by one at most (the law `rows`).

A full shard that nobody asks to leave is closed to others, so they ask for their
next best one: a key of more rows than a shard holds fills one after the other.

A shard's votes are columns, so a key's documents are never brought together:
a key that holds a third of all rows leaves each map task as one row of counts.
The driver sees the counts of moves by shard pair and hash step, a number fixed
by the parameters.

Defined results: null text is linked with nothing, has size 1 and no checksum;
empty texts are equal texts; repeated rows and ids stay separate rows; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents, hash_key, running_total, with_ranks

SHARDS = 16
ROUNDS = 4  # rounds in a row without gain that end the propagation
STEPS = 256


def _votes(shard: str, n: int) -> list[Column]:
    return [F.count_if(F.col(shard) == s).alias(f"_v{s}") for s in range(n)]


def _propose(
    state: DataFrame, shut: set[int], n: int, whole: int, turn: int
) -> DataFrame:
    """Adds `_want`: the shard with most neighbours among the present one and
    those that are not shut. Ties go to the first shard from a place given by the
    key and the turn. `_here` of its `_near` neighbours are in the present one."""
    ends = state.select("_uid", "_shard", "_rank", F.explode("_links").alias("_link"))
    counts = ends.groupBy("_link").agg(*_votes("_shard", n))
    sums = [F.sum(f"_v{s}").alias(f"_v{s}") for s in range(n)]
    voted = (
        ends.join(counts, "_link")
        .groupBy("_uid")
        .agg(
            F.first("_shard").alias("_shard"),
            F.first("_rank").alias("_rank"),
            F.collect_list("_link").alias("_links"),
            *sums,
        )
        .withColumn("_group", F.xxhash64(F.array_min("_links"), F.lit(turn)))
        .withColumn("_turn", F.pmod("_group", F.lit(n)))
    )
    choices = [
        F.when(
            F.lit(s not in shut) | (F.col("_shard") == s),
            F.struct(
                F.col(f"_v{s}").alias("v"),
                (-F.pmod(F.lit(s) - F.col("_turn"), F.lit(n))).alias("turn"),
                F.lit(s).alias("s"),
            ),
        )
        for s in range(n)
    ]
    # Small groups move as one; the members of a large one by themselves.
    near = sum((F.col(f"_v{s}") for s in range(n)), F.lit(0))
    by = F.when(near <= whole, F.col("_group")).otherwise(F.xxhash64("_rank", F.lit(turn)))
    step = F.pmod(F.xxhash64(by), F.lit(STEPS))
    return voted.select(
        "_uid",
        "_shard",
        "_rank",
        "_links",
        F.element_at(F.array(*[f"_v{s}" for s in range(n)]), F.col("_shard") + 1).alias("_here"),
        near.alias("_near"),
        F.greatest(*choices)["s"].alias("_want"),
        step.alias("_step"),
    )


def _unsettled(state: DataFrame) -> DataFrame:
    """The rows that can ever ask to move or be asked for: not those whose only key
    is the only one of all its rows, which are in one shard. These would always
    want to stay."""
    ends = state.select("_shard", F.size("_links").alias("n"), F.explode("_links").alias("_link"))
    split = (F.min("_shard") < F.max("_shard")) | (F.max("n") > 1)
    open_keys = ends.groupBy("_link").agg(split.alias("split")).filter("split").select("_link")
    first = state.withColumn("_link", F.element_at("_links", 1))
    single = F.size("_links") == 1
    alone = first.filter(single).join(open_keys, "_link", "left_semi")
    return alone.select(*state.columns).union(state.filter(~single))


def _ring(edges: dict[int, list[int]]) -> list[int]:
    """Shards of which each has an edge to the next, and the last to the first."""
    done: set[int] = set()

    def search(path: list[int]) -> list[int]:
        for b in edges.get(path[-1], []):
            if b in path:
                return path[path.index(b) :]
            if b not in done and (ring := search([*path, b])):
                return ring
        done.add(path[-1])
        return []

    for a in sorted(edges):
        if a not in done and (ring := search([a])):
            return ring
    return []


def _admit(
    asked: dict[tuple[int, int], dict[int, int]], load: list[int], quota: list[int]
) -> dict[tuple[int, int], int]:
    """For each pair of shards, the hash step below which its moves are admitted.

    A pair swaps as many as both directions have, in whole steps; then steps of
    equal size go round in rings of shards, and free places are given out. Steps
    admitted never hold more rows than allowed."""

    def steps(pair: tuple[int, int], allowed: int) -> tuple[int, int]:
        total = 0
        for step in range(STEPS):
            here = asked.get(pair, {}).get(step, 0)
            if total + here > allowed:
                return step, total
            total += here
        return STEPS, total

    load = list(load)
    most = {p: sum(x.values()) for p, x in asked.items()}
    admitted, passed = defaultdict(int), defaultdict(int)
    for a, b in sorted(most):
        if a > b or (b, a) not in most:
            continue
        there, back = min(most[a, b], most[b, a]), 0
        for _ in range(STEPS):  # until what is swapped fits both shards
            x, there = steps((a, b), there)
            y, back = steps((b, a), there + max(0, quota[a] - load[a]))
            if there - back <= max(0, quota[b] - load[b]):
                admitted[a, b], admitted[b, a] = x, y
                passed[a, b], passed[b, a] = there, back
                load[a] += back - there
                load[b] += there - back
                break
            there = back + max(0, quota[b] - load[b])
    left = {p: [x for x in sorted(s.items()) if x[0] >= admitted[p]] for p, s in asked.items()}
    ring = [0]
    while ring:
        for size in sorted({x[0][1] for x in left.values() if x}):
            edges = defaultdict(list)
            for a, b in sorted(p for p, x in left.items() if x and x[0][1] == size):
                edges[a].append(b)
            if ring := _ring(edges):
                break
        else:
            break
        for pair in zip(ring, [*ring[1:], ring[0]], strict=True):
            admitted[pair], passed[pair] = left[pair].pop(0)[0] + 1, passed[pair] + size
    for a, b in sorted(most, key=lambda p: (-most[p], p)):
        before = passed[a, b]
        admitted[a, b], passed[a, b] = steps((a, b), before + max(0, quota[b] - load[b]))
        load[b] += passed[a, b] - before
        load[a] -= passed[a, b] - before
    return admitted


def balanced_labels(items: DataFrame, n: int, rounds: int) -> DataFrame:
    """Adds shard (0 to n-1) to `items` (_uid, _key: a hash_key, _links: an array
    of keys shared with other rows), with row counts that differ by one at most.
    `rounds` in a row that bring no more neighbours together end the propagation;
    0 leaves all rows where they start."""
    linked_keys = (
        items.select(F.explode("_links").alias("_link"))
        .groupBy("_link")
        .count()
        .filter("count > 1")
        .select("_link")
    )
    ends = items.select("_uid", "_key", F.explode("_links").alias("_link"))
    linked = cut(
        ends.join(linked_keys, "_link")
        .groupBy("_uid")
        .agg(F.first("_key").alias("_key"), F.collect_list("_link").alias("_links"))
    )
    rows, n_linked = items.count(), linked.count()
    quota = [rows // n + (s < rows % n) for s in range(n)]
    load = [n_linked // n + (s < n_linked % n) for s in range(n)]
    first = linked.withColumn("_first", F.array_min("_links"))
    start = with_ranks(first, [], ["_first", "_key", "_uid"])
    more, size = n_linked % n, max(1, n_linked // n)  # `more` shards hold one row more
    behind = F.col("rank") - more * (size + 1)
    shard = F.when(behind < 0, F.floor(F.col("rank") / (size + 1))).otherwise(more + F.floor(behind / size))
    if n_linked < n:
        shard = F.col("rank")
    state = cut(
        start.select("_uid", "_links", F.col("rank").alias("_rank"), shard.cast("int").alias("_shard"))
    )
    start, state = state, cut(_unsettled(state))
    kept, kept_load, most = state, load, -1
    stalled, turn, closed = 0, 0, set()
    while n_linked and stalled < rounds:
        full = {s for s in range(n) if load[s] >= quota[s]}
        # A round without gain is followed by one of moves to shards with room alone.
        shut = full if stalled % 2 and len(full) < n else closed
        proposed = cut(_propose(state, shut, n, max(1, quota[0] // STEPS), turn))
        step = F.when(F.col("_want") != F.col("_shard"), F.col("_step"))
        by = proposed.groupBy("_shard", "_want", step.alias("_step"))
        asked: dict = defaultdict(dict)
        here = near = 0
        for a, b, k, count, *votes in by.agg(
            F.count("*"), F.sum("_here"), F.sum("_near")
        ).collect():
            here, near = here + votes[0], near + votes[1]
            if a != b:
                asked[a, b][k] = count
        settled = full - {a for a, _ in asked}
        if here > most:
            kept, kept_load, most, stalled, closed = state, load, here, 0, settled
        elif settled <= closed:
            stalled += 1
        else:
            closed = closed | settled
        if here == near:
            break
        turn += 1
        limit = _admit(asked, load, quota)
        load = list(load)
        for (a, b), steps in asked.items():
            moved = sum(count for k, count in steps.items() if k < limit[a, b])
            load[a], load[b] = load[a] - moved, load[b] + moved
        table = F.array(*[F.lit(limit.get((a, b), 0)) for a in range(n) for b in range(n)])
        below = F.element_at(table, (F.col("_shard") * n + F.col("_want") + 1).cast("int"))
        moved = F.when(F.col("_step") < below, F.col("_want")).otherwise(F.col("_shard"))
        state = cut(
            proposed.select("_uid", moved.cast("int").alias("_shard"), "_rank", "_links")
        )
    load = kept_load
    moved = kept.select("_uid", F.col("_shard").alias("_moved"))
    placed = start.join(moved, "_uid", "left").select(
        "_uid", F.coalesce("_moved", "_shard").alias("shard")
    )
    free = items.join(linked.select("_uid"), "_uid", "left_anti").select("_uid", "_key")
    free = running_total(free, [], ["_key", "_uid"], F.lit(1), "_rank")
    ends_at, filled = 0, F.lit(n - 1)
    bounds = []
    for s in range(n):
        ends_at += quota[s] - load[s]
        bounds.append(ends_at)
    for s in reversed(range(n)):
        filled = F.when(F.col("_rank") < bounds[s], s).otherwise(filled)
    shards = placed.union(free.select("_uid", filled.cast("int").alias("shard")))
    return items.join(shards, "_uid")


def shard_documents(
    docs: DataFrame, links: list[Column], n: int = SHARDS, rounds: int = ROUNDS
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    `links` are expressions over `docs`; rows with an equal value of one of them
    are linked. `slot` numbers a shard's rows from 0 without gaps."""
    numbered = docs.withColumn("_uid", F.monotonically_increasing_id())
    keys = [F.when(c.isNotNull(), F.xxhash64(F.lit(i), c)) for i, c in enumerate(links)]
    items = cut(
        numbered.select(
            "_uid",
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32("text").alias("text_crc32"),
            F.array_distinct(F.array_compact(F.array(*keys))).alias("_links"),
            hash_key(F.col("doc_id"), F.crc32("text")).alias("_key"),
        )
    )
    placed = cut(balanced_labels(items, n, rounds))
    slots = running_total(placed, ["shard"], ["_key", "doc_id", "_uid"], F.lit(1), "_slot")
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("_slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(documents(spark, sf_dir), [F.col("text")])
