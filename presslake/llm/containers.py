"""Problem 9: filling containers of fixed capacity.

Sizes are whole numbers up to the capacity, so the packing is worked out on counts
per size, a table bounded by the capacity whatever the number of documents:

1. Martello-Toth dominance: from the largest size down, a set of one to three items
   that provably dominates every other set with that size is fixed (a single item
   nothing fits beside; a full pair; the largest partner where nothing fits beside
   both or no pair fills more; the largest partner and the largest item beside both,
   where no other pair can do better), in multiples of the counts, again and again
   until nothing more can be fixed;
2. what remains is packed best-fit, also in multiples, in two ways of which the one with
   fewer containers counts: item by item from large to small, and set by set, the
   largest item with the set of others that fits best beside it.

The result, containers of one pattern each with a multiplicity, is mapped back:
documents are numbered within their size, and a number falls into one slot of one
pattern.  A document longer than the capacity is cut into full containers and a
rest."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presslake.llm.encoding import VOCABULARY, token_counts
from presslake.session import cut_lineage

#: Documents of one size are numbered apart in groups, at least so many and about one for so many rows,
#: so that a common size is no hot task at any number of rows.
NUMBERING_GROUPS, GROUP_ROWS = 64, 250_000


class _Counts:
    """Counts of sizes with the sorted sizes present."""

    def __init__(self, counts: dict[int, int]):
        self.n = {s: n for s, n in counts.items() if n > 0}
        self.sizes = sorted(self.n)

    def take(self, size: int, n: int) -> None:
        self.n[size] -= n
        if not self.n[size]:
            del self.n[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def give(self, size: int, n: int) -> None:
        if size not in self.n:
            insort(self.sizes, size)
        self.n[size] = self.n.get(size, 0) + n

    def largest_up_to(self, size: int) -> int | None:
        i = bisect_right(self.sizes, size)
        return self.sizes[i - 1] if i else None

    def smallest(self, k: int) -> int:
        """Sum of the k smallest items; a huge number if there are fewer."""
        total = 0
        for s in self.sizes:
            m = min(k, self.n[s])
            total += m * s
            k -= m
            if not k:
                return total
        return 1 << 60

    def best_pair(self, room: int, above: int = 0) -> int:
        """Largest sum within ``room`` of two items, each larger than ``above``; 0 if none."""
        s = np.array(self.sizes[bisect_right(self.sizes, above) : bisect_right(self.sizes, room)], np.int64)
        if not len(s):
            return 0
        at = np.searchsorted(s, room - s, side="right") - 1
        alone = np.array([self.n[int(x)] < 2 for x in s])
        at = np.where((at == np.arange(len(s))) & alone, at - 1, at)  # an item is not its own partner
        return int((s + s[at])[at >= 0].max(initial=0))


def _dominating(left: _Counts, w: int, capacity: int) -> tuple[int, ...] | None:
    """A set with an item of size ``w`` that dominates every other one with it, if it is sure."""
    left.take(w, 1)
    try:
        room = capacity - w
        a = left.largest_up_to(room)
        if a is None:
            return (w,)
        if a == room or left.smallest(2) > room:
            return (w, a)
        if left.smallest(3) > room:  # no more than two items fit beside it
            if a >= left.best_pair(room):
                return (w, a)  # whatever two items replace fits into the place of this one
            left.take(a, 1)
            b = left.largest_up_to(room - a)
            left.give(a, 1)
            if b is not None and left.best_pair(room, b) <= a:
                return (w, a, b)  # of any other two the lesser fits for b, or both for a
        return None
    finally:
        left.give(w, 1)


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Patterns fixed by dominance, with multiplicities, and the counts that remain.  A set
    fixed once stays dominating while there are items for it, as the others only get fewer."""
    left, fixed, changed = _Counts(counts), [], True
    while changed:
        changed = False
        for w in sorted(left.sizes, reverse=True):
            while w in left.n and (pattern := _dominating(left, w, capacity)):
                need = Counter(pattern)
                m = min(left.n[s] // k for s, k in need.items())
                for s, k in need.items():
                    left.take(s, m * k)
                fixed.append((pattern, m))
                changed = True
    return fixed, dict(left.n)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit from large to small on counts; patterns with multiplicities."""
    rooms: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    order: list[int] = []  # rooms in use, ascending

    def put(pattern: tuple[int, ...], room: int, m: int) -> None:
        if room not in rooms:
            rooms[room] = []
            insort(order, room)
        rooms[room].append((pattern, m))

    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n:
            i = bisect_left(order, w)
            if i < len(order):
                room = order[i]
                pattern, m = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                    order.pop(i)
            else:
                room, pattern, m = capacity, (), n
            each = room // w
            whole = min(m, n // each)
            if whole:
                put(pattern + (w,) * each, room - w * each, whole)
                n -= whole * each
            if m > whole and n and n < each:
                put(pattern + (w,) * n, room - w * n, 1)
                whole, n = whole + 1, 0
            if pattern and m > whole:
                put(pattern, room, m - whole)
    return [(p, m) for room in rooms.values() for p, m in room]


def _best_set(left: _Counts, room: int) -> tuple[int, ...]:
    """The set of items with the greatest sum within ``room``, of large ones if there is a
    choice: one or two that fill it if there are, else by the sums that sizes can reach."""
    if room in left.n:
        return (room,)
    sizes = left.sizes[: bisect_right(left.sizes, room)]
    if not sizes:
        return ()
    s = np.array(sizes, np.int64)
    at = np.searchsorted(s, room - s)
    full = (at < len(s)) & (s[np.minimum(at, len(s) - 1)] == room - s) & ((at != np.arange(len(s))) | np.array([left.n[x] > 1 for x in sizes]))
    if full.any():
        i = int(np.flatnonzero(full)[-1])
        return (sizes[i], room - sizes[i])
    mask, reach = (1 << (room + 1)) - 1, [1]  # bit x of reach[i]: the first i sizes make x
    for size in sizes:
        sums, n, step = reach[-1], min(left.n[size], room // size), 1
        while n:
            step = min(step, n)
            sums |= (sums << size * step) & mask
            n -= step
            step *= 2
        reach.append(sums)
    out, rest = [], reach[-1].bit_length() - 1
    for i in range(len(sizes), 0, -1):
        n = next(k for k in range(min(left.n[sizes[i - 1]], rest // sizes[i - 1]), -1, -1) if reach[i - 1] >> rest - k * sizes[i - 1] & 1)
        out += [sizes[i - 1]] * n
        rest -= n * sizes[i - 1]
        if not rest:
            break
    return tuple(out)


def best_fit_sets(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """The largest item with the set that fits best beside it, in multiples of what there is:
    each step leaves too few of some size, so steps are bounded by the number of sizes."""
    left, out = _Counts(counts), []
    while left.sizes:
        w = left.sizes[-1]
        left.take(w, 1)
        pattern = (w, *_best_set(left, capacity - w))
        left.give(w, 1)
        need = Counter(pattern)
        m = min(left.n[s] // k for s, k in need.items())
        for s, k in need.items():
            left.take(s, m * k)
        out.append((pattern, m))
    return out


def pack_counts(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (sizes of a container) with multiplicities for counts per size."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    used = lambda patterns: sum(m for _, m in patterns)
    plain = best_fit(rest, capacity)
    if used(plain) == -(-sum(s * n for s, n in rest.items()) // capacity):  # no packing of the remainder uses fewer
        return fixed + plain
    return fixed + min((best_fit_sets(rest, capacity), plain), key=used)


def _slots(patterns: list[tuple[tuple[int, ...], int]], first: int) -> tuple[dict[int, list[tuple[int, int]]], int]:
    """By size: (first number, first container) of every slot; and the next free container."""
    used: dict[int, int] = {}
    slots: dict[int, list[tuple[int, int]]] = {}
    for pattern, m in patterns:
        for size in pattern:
            slots.setdefault(size, []).append((used.get(size, 0), first))
            used[size] = used.get(size, 0) + m
        first += m
    return slots, first


def fill_containers(sizes: DataFrame, specs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """(container_kind, container_no, doc_id, piece_no, tokens): where each document goes.

    ``sizes`` has the id and ``tokens``; ``specs`` container_kind and capacity_tokens
    (specs without kind or with no capacity above 0 are left out; of a kind with
    several rows the largest counts).  Every document with tokens is placed once for
    each kind, in one piece (piece_no 0) unless it is longer than the capacity; then
    its pieces are numbered from 0 and all but the last fill their container.
    Documents without tokens take no room and are left out.  Containers are numbered
    from 1 per kind.  Repeated rows count as documents each.
    """
    kinds = {r[0]: int(r[1]) for r in specs.groupBy("container_kind").agg(F.max("capacity_tokens").alias("c")).where("container_kind is not null and c > 0").collect()}
    out = f"container_kind string, container_no bigint, {id_column} bigint, piece_no int, tokens int"
    spark = sizes.sparkSession
    if not kinds:
        return spark.createDataFrame([], out)
    items = cut_lineage(sizes.where("tokens > 0").select(F.col(id_column).cast("bigint").alias(id_column), F.col("tokens").cast("int").alias("tokens")))
    table = F.array(*[F.struct(F.lit(k).alias("container_kind"), F.lit(c).alias("capacity")) for k, c in kinds.items()])
    both = items.select(id_column, "tokens", F.explode(table).alias("_kind")).select(id_column, "tokens", "_kind.*")
    full, rest = F.expr("tokens div capacity").cast("int"), F.col("tokens") % F.col("capacity")
    both = both.withColumn("full", F.when(F.col("tokens") > F.col("capacity"), full).otherwise(0))
    both = both.withColumn("rest", F.when(F.col("full") == 0, F.col("tokens")).otherwise(rest))
    group = F.pmod(F.xxhash64(id_column), F.lit(max(NUMBERING_GROUPS, items.count() // GROUP_ROWS))).cast("int")
    rests = both.where("rest > 0").select("container_kind", id_column, F.col("full").alias("piece_no"), F.col("rest").alias("size"), group.alias("group"))
    cells = rests.groupBy("container_kind", "size", "group").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("container_kind", "size").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    cells = cut_lineage(cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    histogram: dict[str, dict[int, int]] = {k: {} for k in kinds}
    for kind, size, n in cells.groupBy("container_kind", "size").agg(F.sum("n").alias("n")).collect():  # at most the sum of the capacities
        histogram[kind][size] = n
    plan, next_free = {}, {}
    for kind, capacity in kinds.items():
        slots, next_free[kind] = _slots(pack_counts(histogram[kind], capacity), 1)
        plan[kind] = {s: (np.array([a for a, _ in x], np.int64), np.array([b for _, b in x], np.int64)) for s, x in slots.items()}
    shipped = spark.sparkContext.broadcast(plan)  # slots of patterns: bounded by the capacities

    def place(batches):
        plan = shipped.value
        for b in batches:
            number = b["number"].to_numpy()
            no = np.empty(len(b), np.int64)
            for (kind, size), at in b.groupby(["container_kind", "size"], sort=False).indices.items():
                starts, first = plan[kind][size]
                i = np.searchsorted(starts, number[at], side="right") - 1
                no[at] = first[i] + number[at] - starts[i]
            yield pd.DataFrame({"container_kind": b["container_kind"], "container_no": no, id_column: b[id_column], "piece_no": b["piece_no"], "tokens": b["size"]})

    within = Window.partitionBy("container_kind", "size", "group").orderBy(id_column)
    numbered = rests.withColumn("rank", F.row_number().over(within) - 1).join(cells.drop("n"), ["container_kind", "size", "group"])
    placed = numbered.select("container_kind", id_column, "piece_no", "size", (F.col("before") + F.col("rank")).alias("number")).mapInPandas(place, out)
    # Full pieces: a container each, after those of the packing.
    long = both.where("full > 0").select("container_kind", "capacity", id_column, "full")
    cell = long.withColumn("group", group).groupBy("container_kind", "group").agg(F.sum("full").alias("n"))
    start = F.create_map(*[x for k, v in next_free.items() for x in (F.lit(k), F.lit(v))])
    running = Window.partitionBy("container_kind").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    cell = cell.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0))).drop("n")
    inside = Window.partitionBy("container_kind", "group").orderBy(id_column).rowsBetween(Window.unboundedPreceding, -1)
    long = long.withColumn("group", group).withColumn("own", F.coalesce(F.sum("full").over(inside), F.lit(0))).join(cell, ["container_kind", "group"])
    pieces = long.select("container_kind", "capacity", id_column, (start[F.col("container_kind")] + F.col("before") + F.col("own")).alias("first"), F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("piece_no"))
    pieces = pieces.select("container_kind", (F.col("first") + F.col("piece_no")).alias("container_no"), id_column, "piece_no", F.col("capacity").alias("tokens"))
    return placed.unionByName(pieces)


def fill_with_documents(documents: DataFrame, specs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """:func:`fill_containers` for documents (doc_id, text) measured in tokens."""
    return fill_containers(token_counts(documents, vocabulary), specs)


def fill_summary(placed: DataFrame, specs: DataFrame) -> DataFrame:
    """Per kind: containers used, tokens in them, the least number of containers any
    packing needs by volume, and the share of the room that is filled."""
    use = placed.groupBy("container_kind").agg(F.max("container_no").alias("containers"), F.sum("tokens").alias("tokens"))
    by = use.join(specs.groupBy("container_kind").agg(F.max("capacity_tokens").alias("capacity_tokens")), "container_kind")
    room = F.col("capacity_tokens").cast("bigint")
    least = F.ceil(F.col("tokens") / room).alias("least_containers")
    return by.select("container_kind", "capacity_tokens", "containers", "tokens", least, F.round(F.col("tokens") / (F.col("containers") * room), 6).alias("filled"))
