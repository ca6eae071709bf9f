"""Operator 3: mix overlapping sources to target weights by min-cost flow.

Documents are first added up by membership pattern, the set of sources that
they belong to. Words then flow from patterns to the quotas of sources: the
first copy of a pattern's words costs less than the second, the second less
than the third, so repetition is spread before it deepens. Patterns and
sources are a small table, which the driver solves; it refuses more than
``MAX_PATTERNS``. Documents are chosen in an order seeded by their id: within a
pattern, a copy goes to all documents up to the place where its flow is used
up, found by narrowing the seeded order three times to a 256th. Only document
ids, sizes and places in that order are sorted or shuffled.

The document at that place is taken in part (``taken`` counts its words), so
the words of a source meet its target exactly wherever its documents suffice.

Defined results: a null or empty text has size 0 and is never taken; a null
source is a source of its own, the last; rows that share a ``doc_id`` have the
same place in the order and follow one another by size and text; an empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackledger.llm.bloom import fresh_names
from trackledger.session import materialize

MAX_PATTERNS = 20_000
MAX_COPIES = 2
SEED = 20
WORD = r"[^\x20\x09-\x0D]+"
STEPS = 3


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Split ``total`` by weight; what passes ``most`` times a size is shared again."""
    found = [0.0] * len(sizes)
    free, left = [k for k in range(len(sizes)) if sizes[k] > 0], float(total)
    while free:
        weight = sum(weights[k] for k in free)
        over = [k for k in free if left * weights[k] / weight > most * sizes[k]]
        for k in over or free:
            found[k] = most * sizes[k] if over else left * weights[k] / weight
        if not over:
            break
        left = max(0.0, left - sum(found[k] for k in over))
        free = [k for k in free if k not in set(over)]
    return found


@dataclass
class _Edge:
    to: int
    room: int
    cost: int
    back: int


class _Network:
    """Min-cost flow by cheapest augmenting paths over a small graph."""

    def __init__(self, nodes: int):
        self.edges: list[_Edge] = []
        self.out: list[list[int]] = [[] for _ in range(nodes)]

    def add(self, start: int, to: int, room: int, cost: int) -> int:
        number = len(self.edges)
        self.edges += [_Edge(to, room, cost, number + 1), _Edge(start, 0, -cost, number)]
        self.out[start].append(number)
        self.out[to].append(number + 1)
        return number

    def _cheapest(self, start: int) -> tuple[list[float], list[int]]:
        cost, via = [float("inf")] * len(self.out), [-1] * len(self.out)
        cost[start], queue, queued = 0.0, deque([start]), {start}
        while queue:
            node = queue.popleft()
            queued.discard(node)
            for number in self.out[node]:
                edge = self.edges[number]
                if edge.room and cost[node] + edge.cost < cost[edge.to]:
                    cost[edge.to], via[edge.to] = cost[node] + edge.cost, number
                    if edge.to not in queued:
                        queue.append(edge.to)
                        queued.add(edge.to)
        return cost, via

    def solve(self, start: int, end: int) -> None:
        while (found := self._cheapest(start))[0][end] < float("inf"):
            path, node = [], end
            while node != start:
                path.append(number := found[1][node])
                node = self.edges[self.edges[number].back].to
            room = min(self.edges[k].room for k in path)
            for k in path:
                self.edges[k].room -= room
                self.edges[self.edges[k].back].room += room


def route(patterns: Sequence[tuple[Sequence[int], int]], quotas: Sequence[int], copies: int) -> list[list[int]]:
    """Words of each pattern's copies; patterns are (source numbers, words).

    Copy k of a word costs ``k ** 2`` more than the one before: convex, so all
    patterns that can serve a quota are repeated evenly.
    """
    first = 1 + len(patterns)
    end = first + len(quotas)
    net = _Network(end + 1)
    copied = []
    for p, (sources, words) in enumerate(patterns):
        copied.append([net.add(0, 1 + p, words, (k + 1) ** 2) for k in range(copies)])
        for s in sources:
            net.add(1 + p, first + s, copies * words, 0)
    for s, quota in enumerate(quotas):
        net.add(first + s, end, quota, 0)
    net.solve(0, end)
    return [[net.edges[net.edges[k].back].room for k in numbers] for numbers in copied]


CUTS = pa.schema(
    [("k", pa.int32()), ("pattern", pa.list_(pa.string())), ("copies", pa.int32()), ("prefix", pa.int64()), ("left", pa.int64())]
)
TARGETS = pa.schema([("name", pa.string()), ("source_size", pa.int64()), ("target", pa.float64())])


def _small_table(spark: SparkSession, rows: list[tuple], schema: pa.Schema) -> DataFrame:
    """``rows`` of the driver as a local relation: made from tuples it would be an RDD, for which executors keep Python workers of their own."""
    columns = list(zip(*rows)) or [()] * len(schema)
    return spark.createDataFrame(pa.table([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema))


def _cuts(rows: DataFrame, flows: list[tuple[list, int, int]]) -> DataFrame:
    """k, pattern, copies, prefix, left: where in the seeded order each pattern's last copy ends.

    ``flows`` holds pattern, whole copies and the words of the last copy. Every
    step adds up the words of 256 parts of the part that holds the end: at most
    256 rows per pattern reach the driver.
    """
    state = [[pattern, copies, 0, words] for pattern, copies, words in flows]

    def table() -> DataFrame:
        return _small_table(rows.sparkSession, [(k, *x) for k, x in enumerate(state)], CUTS)

    for step in range(1, STEPS + 1):
        # Bounded: at most MAX_PATTERNS rows.
        sums = (
            rows.join(F.broadcast(table()), "pattern")
            .where(F.shiftright("place", 8 * (STEPS - step + 1)) == F.col("prefix"))
            .groupBy("k", F.shiftright("place", 8 * (STEPS - step)).alias("part"))
            .agg(F.sum("size").alias("words"))
        )
        parts: dict[int, list] = {}
        for row in sums.collect():
            parts.setdefault(row["k"], []).append((row["part"], row["words"]))
        for k, found in parts.items():
            for number, words in sorted(found):
                state[k][2] = number
                if words > state[k][3]:
                    break
                state[k][3] -= words
            else:  # all of it is taken
                state[k][2] = number + 1
    return table()


_OWN = ("pattern", "size", "tie", "place", "order")


def _places(docs: DataFrame, sources: Column, seed: int) -> list[Column]:
    """Pattern, size and place in the seeded order of each row, named as in ``_OWN``."""
    nowhere = F.array(F.lit(None).cast("string"))
    order = F.xxhash64(F.lit(seed), docs["doc_id"].cast("long"))
    return [
        F.array_sort(F.array_distinct(F.coalesce(sources, nowhere))),
        word_count(docs["text"]),
        F.xxhash64(docs["text"]),
        # 24 bits to narrow by; the whole number tells documents apart.
        F.shiftrightunsigned(order, 64 - 8 * STEPS),
        order,
    ]


def _plan(rows: DataFrame, quotas, copies: int) -> DataFrame:
    """Where each pattern's last copy ends; ``rows`` are a table of ``_OWN``."""
    found = rows.groupBy("pattern").agg(F.sum("size").alias("words")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    found.sort(key=lambda r: [(s is None, s or "") for s in r["pattern"]])
    names = sorted({s for r in found for s in r["pattern"]}, key=lambda s: (s is None, s or ""))
    number = {s: k for k, s in enumerate(names)}
    sizes = [sum(r["words"] for r in found if s in r["pattern"]) for s in names]
    wanted = quotas(names, sizes)
    flow = route(
        [([number[s] for s in r["pattern"]], r["words"]) for r in found], [int(w) for w in wanted], copies
    )
    flows = [
        (r["pattern"], *(divmod(sum(words), r["words"]) if r["words"] else (0, 0))) for r, words in zip(found, flow)
    ]
    return _cuts(rows, flows)


def _taken(rows: DataFrame, cuts: DataFrame, own: Sequence[str], taken: str) -> DataFrame:
    """``rows`` with the words taken of each; ``own`` are the names of the columns of ``_OWN``."""
    pattern, size, tie, place, order = own
    named = {c: f"{taken}_{c}" for c in ("k", "pattern", "copies", "prefix", "left")}
    k, match, copies, prefix, left = named.values()
    # Bounded: at most MAX_PATTERNS rows.
    at = rows.join(F.broadcast(cuts.withColumnsRenamed(named)), F.col(pattern) == F.col(match))
    # Only the documents that share the last of 2^24 parts are put in order one by one.
    earlier = Window.partitionBy(k).orderBy(order, size, tie).rowsBetween(Window.unboundedPreceding, -1)
    rest = F.col(left) - F.coalesce(F.sum(size).over(earlier), F.lit(0))
    last = F.when(F.col(place) < F.col(prefix), F.col(size)).otherwise(F.lit(0))
    others = at.where(F.col(place) != F.col(prefix)).withColumn(taken, last)
    edge = at.where(F.col(place) == F.col(prefix)).withColumn(
        taken, F.greatest(F.lit(0), F.least(F.col(size), rest))
    )
    total = (F.col(copies) * F.col(size) + F.col(taken)).cast("long")
    return others.unionByName(edge).withColumn(taken, total).drop(*named.values())


def mix(docs: DataFrame, sources: Column, quotas, copies: int = MAX_COPIES, seed: int = SEED) -> DataFrame:
    """Words taken of each row of ``docs`` (doc_id, text).

    ``sources`` is an array of strings; ``quotas(names, sizes)`` gives the words
    wanted of each source. Returns doc_id, sources, size, taken (0 to ``copies``
    times the size).
    """
    columns = [c.alias(n) for c, n in zip(_places(docs, sources, seed), _OWN)]
    rows = materialize(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *columns))
    mixed = _taken(rows, _plan(rows, quotas, copies), _OWN, "taken")
    return mixed.select("doc_id", F.col("pattern").alias("sources"), "size", "taken")


def draw(docs: DataFrame, sources: Column, quotas, copies: int = MAX_COPIES, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix takes them: whole rows, as often as they are taken, all columns.

    A document that the mix takes in part is taken whole if that is half of it
    or more. Texts don't move; only documents at a pattern's end are sorted.
    """
    *own, taken = fresh_names(docs, len(_OWN) + 1)
    places = _places(docs, sources, seed)
    rows = materialize(docs.select(*[c.alias(n) for c, n in zip(places, _OWN)]))
    whole = docs.select("*", *[c.alias(n) for c, n in zip(places, own)])
    mixed = _taken(whole, _plan(rows, quotas, copies), own, taken).where(F.col(taken) > 0)
    times = F.round(F.col(taken) / F.col(own[1])).cast("int")
    drawn = mixed.where(times > 0).withColumn(taken, F.explode(F.sequence(F.lit(1), times)))
    return drawn.select(*docs.columns)


WEIGHTS = (3, 1, 2)
SHARE = 1.5


def contract_targets(names: Sequence, sizes: Sequence[int]) -> list[float]:
    """Targets of sources that weigh 3, 1, 2, repeating, and share 150% of all words."""
    weights = [WEIGHTS[k % len(WEIGHTS)] for k in range(len(names))]
    return targets(sizes, weights, SHARE * sum(sizes), MAX_COPIES)


def mix_by_source(docs: DataFrame) -> DataFrame:
    """``mix`` where each document has one source; adds source_size and target."""
    kept = {}

    def quotas(names, sizes):
        wanted = contract_targets(names, sizes)
        kept.update(zip(names, zip(sizes, wanted)))
        return wanted

    mixed = mix(docs, F.array("source"), quotas)
    rows = [(name, size, float(target)) for name, (size, target) in kept.items()]
    table = _small_table(docs.sparkSession, rows, TARGETS)
    # Bounded as the patterns are.
    return mixed.join(F.broadcast(table), F.get("sources", F.lit(0)).eqNullSafe(F.col("name"))).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def draw_by_source(docs: DataFrame) -> DataFrame:
    """``draw`` where each document has one source."""
    return draw(docs, F.array("source"), contract_targets)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: words that the mix takes of every document."""
    return mix_by_source(spark.read.parquet(f"{sf_dir}/documents.parquet"))
