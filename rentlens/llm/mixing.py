"""Mixing sources to target weights by Pfair scheduling."""

from __future__ import annotations

import heapq
import math
from array import array
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentlens.llm.common import stage
from rentlens.operators.control import numbered

MARKS = ["mix_slot", "mix_place", "mix_epoch"]


def shares(weights: dict[str, float], slots: int) -> dict[str, int]:
    """Whole slots of each source in a cycle of ``slots``, by largest remainder; every positive weight gets one at least.

    For cycles of a fixed length. ``schedule`` does not round weights and makes no use of it.
    """
    wanted = {s: w for s, w in weights.items() if w > 0}
    if len(wanted) > slots:
        raise ValueError(f"{len(wanted)} sources need a cycle of more than {slots} slots")
    total = sum(wanted.values())
    exact = {s: w / total * slots for s, w in wanted.items()}
    out = {s: max(1, math.floor(x)) for s, x in exact.items()}
    while (rest := slots - sum(out.values())) != 0:
        step = 1 if rest > 0 else -1
        over = [s for s in out if step > 0 or out[s] > 1]
        best = max(sorted(over, key=str), key=lambda s: step * (exact[s] - out[s]))
        out[best] += step
    return out


def laid(weights: list[int], sizes: list[int], end: int | None) -> tuple[array, array, array] | None:
    """(source, turn, slot) of every filled slot, by earliest deadline first over Pfair windows of the exact weights.

    Turn k of a source with share w is released at floor(k / w) and due at ceil((k + 1) / w), in whole numbers without
    rounding. The shares add up to one, so every turn meets its window, and after any number of slots a source is less
    than one block off its share. Sources take turns up to slot ``end``, and each of the first ``sizes`` turns is due by
    then at the latest; None is returned if that cannot be met. With no ``end`` each source stops after ``sizes`` turns.
    A source of size 0 has no turns; its slots stay empty.
    """
    total = sum(weights)
    out = array("i"), array("q"), array("q")
    waiting: list[tuple[int, int, int]] = [(0, s, 0) for s, n in enumerate(sizes) if n]
    ready: list[tuple[int, int, int]] = []
    slot = 0
    while (waiting or ready) and (end is None or slot < end):
        if not ready and waiting[0][0] > slot:
            slot = waiting[0][0]
            continue
        while waiting and waiting[0][0] <= slot:
            _, s, k = heapq.heappop(waiting)
            due = -(-(k + 1) * total // weights[s])
            heapq.heappush(ready, (due if end is None or k >= sizes[s] else min(due, end), s, k))
        due, s, k = heapq.heappop(ready)
        if due <= slot:
            return None
        for column, value in zip(out, (s, k, slot)):
            column.append(value)
        slot += 1
        if end is not None or k + 1 < sizes[s]:
            heapq.heappush(waiting, ((k + 1) * total // weights[s], s, k + 1))
    return out if end is None or all(due > end for due, _, _ in ready) else None


def whole(weights: list[int], sizes: list[int]) -> tuple[array, array, array]:
    """``laid`` up to the first slots, nearly, after which every source was read whole; sources that end sooner go on."""
    total = sum(weights)
    some = [(w, n) for w, n in zip(weights, sizes) if n]
    first = max((n - 1) * total // w + 1 for w, n in some)  # the last blocks are released
    last = max(-(-n * total // w) for w, n in some)  # all are due
    more = 0
    while (end := min(last, first + more)) < last:
        if sum(max(n, end * w // total) for w, n in some) <= end and (out := laid(weights, sizes, end)):
            return out
        more = max(1, 2 * more)
    return laid(weights, sizes, last)


def cycle(quota: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, turn, slot) of one cycle of whole slots. All sources are even at its end, so the next is the same again."""
    names = sorted(quota, key=str)
    return [(names[s], k, slot) for s, k, slot in zip(*laid([quota[s] for s in names], [quota[s] for s in names], None))]


def exact(weights: dict[str, float]) -> dict[str, int]:
    """The weights as whole numbers in the same proportions, without rounding."""
    parts = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*[p.denominator for p in parts.values()])
    return {s: int(p * scale) for s, p in parts.items()}


def schedule(docs: DataFrame, weights: dict[str, float] | None = None, block: int = 16, slots: int | None = None,
             power: float = 0.9, epochs: bool = True) -> DataFrame:
    """The input rows with ``mix_slot``, ``mix_place`` and ``mix_epoch``: the order in which training reads them.

    Each source's rows are numbered by doc_id and cut into blocks of ``block`` rows. Blocks get slots by earliest deadline
    for the exact ``weights`` (by default a source's number of rows to ``power``), so that a source is less than one block
    off its share after any number of slots. ``slots`` is not used: there is no cycle whose length could round a weight.

    With ``epochs`` the mix goes on until every source was read whole, and sources that end sooner start again: rows
    repeat with a higher ``mix_epoch``, no row is lost, and every source keeps its weight until the last slot. Without,
    each row is read once, and a source's slots stay empty after its end. The last block of a source may be short.

    A null source is a source of its own. Rows of a source without a positive weight are left out, as the weights
    ask. Repeated rows are rows of their own; a null doc_id comes first; an empty table gives an empty result. The driver
    holds a count for each source and lays out one slot after the other; the slots are a table that is joined to the rows.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c not in MARKS]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").alias("id"),
                       F.concat(F.when(F.col("source").isNull(), "0").otherwise("1"),
                                F.coalesce(F.col("source").cast("string"), F.lit(""))).alias("from"))
    if weights is not None:
        weights = {("0" if s is None else f"1{s}"): w for s, w in weights.items() if w > 0}
        wanted = spark.createDataFrame([(s,) for s in weights], "from string")
        rows = rows.join(wanted, "from", "left_semi")
    count = {r["from"]: r["n"] for r in rows.groupBy("from").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not count:
        return docs.limit(0).select(*[F.col(f"`{c}`") for c in names],
                                    *[F.lit(None).cast("long").alias(c) for c in MARKS])
    share = exact(weights or {s: n ** power for s, n in count.items()})
    sources = sorted(share)
    size = [-(-count.get(s, 0) // block) for s in sources]  # blocks of each source
    parts = [share[s] for s in sources]
    taken, turn, slot = (np.asarray(x, np.int64) for x in (whole(parts, size) if epochs else laid(parts, size, None)))
    # turn t of a source is block t mod its number of blocks, read for the (t div blocks)-th time
    blocks = np.array(size)[taken]
    plan = spark.createDataFrame(pa.table({"from": pa.array(sources, pa.string()).take(pa.array(taken)),
                                           "block": turn % blocks, "mix_epoch": turn // blocks, "mix_slot": slot}))
    placed = numbered(rows, ["from"], ["id"], "number")
    placed = placed.withColumns({"block": F.expr(f"(number - 1) div {block}"),
                                 "mix_place": F.expr(f"(number - 1) % {block}")})
    return (placed.join(plan, ["from", "block"])
            .select("row.*", *[F.col(c).cast("long").alias(c) for c in MARKS]))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``schedule`` in the order of the mix, with the columns of ``docs`` only.

    The schedule is made on (doc_id, source, digest of the row), and whole rows are joined to it once. The result is
    partitioned and sorted by slot, so files written from it follow the mix.
    """
    digest = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])), 256).alias("digest")
    keys = docs.select("doc_id", "source", digest)
    order = stage(schedule(keys, **options).select("digest", "mix_slot", "mix_place"), "mix")
    rows = docs.select(digest, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    once = rows.groupBy("digest").agg(F.first("row").alias("row"))  # repeated rows are as many rows of the order
    return (once.join(order, "digest").repartitionByRange("mix_slot", "mix_place")
            .sortWithinPartitions("mix_slot", "mix_place").select("row.*"))
