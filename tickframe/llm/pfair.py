"""Mixing sources to target weights by Pfair scheduling.

Documents of a source are dealt into blocks, one block a slot. The j-th block of a source of share u must go into the slots
from floor((j - 1) / u), its release, up to ceil(j / u), its deadline; shares are taken as they are, to 2^-52.
Earliest deadline first over the released blocks meets all deadlines, so at any slot of a frame a source is less than one
block away from its target. Frames repeat: the driver works out one of ``FRAME`` slots (a shorter one where all blocks
fit), and each document finds its slot by arithmetic. A share under 1 / ``FRAME`` counts as that much; beyond the first
frame the deviation can grow by less than a block a frame.

Documents are numbered within their source without sorting a source in one task: hash buckets of about ``BUCKET``
documents are numbered each for itself and shifted by the counts of the buckets before. The order within a source is so
a fixed shuffle, by the whole row: null and repeated ids spread like others. No document is dropped: where a source has run
out, its slots stay empty, and ``on_target`` is false from the first empty slot on.

A null source is a source of its own; repeated rows take places of their own (between equal rows, either order is the
same result). Sources without a weight given are refused, sources without documents only leave their slots empty. Columns
that bear the name of a result are replaced, all others stay.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

FRAME, BLOCK, BUCKET = 1 << 20, 16, 4096
#: Parts that shares are counted in.
_WHOLE = 1 << 52
#: Sources that a mix may name; the driver holds one row for each.
MOST_SOURCES = 100_000

_OWN = ["_s", "_h", "_b", "_n", "_a", "_c", "_i", "_slots", "_before"]
_NEW = ["mix_block", "mix_slot", "mix_position", "on_target"]


def shares(weights: dict, frame: int) -> dict:
    """Blocks per frame by largest remainder, one at least; they sum up to ``frame``."""
    total = math.fsum(weights.values())
    exact = {s: w * frame / total for s, w in weights.items()}
    out = {s: max(1, math.floor(x)) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (math.floor(exact[s]) - exact[s], str(s)))
    left = frame - sum(out.values())
    for i in range(max(0, left)):
        out[order[i % len(order)]] += 1
    while left < 0:
        most = max(out, key=lambda s: (out[s] - exact[s], out[s] > 1, str(s)) if out[s] > 1 else (-math.inf, False, str(s)))
        out[most] -= 1
        left += 1
    return out


def schedule(parts: dict, length: int | None = None) -> dict:
    """The first ``length`` slots, by source, by earliest deadline first; shares are ``parts`` of their sum (which is the default)."""
    whole = sum(parts.values())
    length = whole if length is None else length
    waiting = [(0, -(-whole // a), str(s), s, 1) for s, a in parts.items()]
    heapq.heapify(waiting)
    ready: list[tuple] = []
    slots: dict = {s: [] for s in parts}
    for t in range(length):
        while waiting and waiting[0][0] <= t:
            _, deadline, tie, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, tie, j, s))
        deadline, tie, j, s = heapq.heappop(ready)
        slots[s].append(t)
        heapq.heappush(waiting, (j * whole // parts[s], -(-(j + 1) * whole // parts[s]), tie, s, j + 1))
    return slots


def _frame(target: dict, counts: dict, frame: int, block: int) -> dict:
    """Slots of one frame by source, one at least for each."""
    total = math.fsum(target.values())
    parts = shares({s: max(w / total, 1 / frame) for s, w in target.items()}, _WHOLE)
    # No longer than it takes all sources to run out.
    needed = max(-(-counts.get(s, 0) // block) * _WHOLE // a for s, a in parts.items()) + 1
    least = -(-_WHOLE // min(parts.values()))
    return schedule(parts, max(min(frame, needed), least))


def mix(
    docs: DataFrame, weights: dict | None = None, frame: int = FRAME, block: int = BLOCK, source: str = "source", doc_id: str = "doc_id"
) -> DataFrame:
    """``docs`` with ``mix_block``, ``mix_slot``, ``mix_position`` (all long) and ``on_target``.

    Ordered by ``mix_position``, the rows are the mixed corpus. Without ``weights``, a source weighs the square root
    of its documents.
    """
    spark = docs.sparkSession
    kept = [c for c in docs.columns if c not in {*_NEW, *_OWN}]
    name = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))
    told = [F.col(f"`{f.name}`") for f in docs.select(*(f"`{c}`" for c in kept)).schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    named = docs.select(*(F.col(f"`{c}`") for c in kept), name.alias("_s"), F.xxhash64(*told).alias("_h"))
    counts = {r._s: r.n for r in named.groupBy("_s").agg(F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()}
    if len(counts) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources; group them first")
    if weights is None:
        target = {s: math.sqrt(n) for s, n in counts.items()}
    else:
        target = {"null" if s is None else f"={s}": w for s, w in weights.items() if w > 0}
        if missing := counts.keys() - target.keys():
            raise ValueError(f"no weight for sources {sorted(missing)[:5]}")
    if not target:
        target = {"null": 1.0}
    slots = _frame(target, counts, max(frame, len(target)), block)
    per_frame = {s: len(own) for s, own in slots.items()}
    length = sum(per_frame.values())

    def slot(s: str, j: int) -> int:
        return j // per_frame[s] * length + slots[s][j % per_frame[s]]

    until = min(slot(s, -(-counts.get(s, 0) // block)) for s in target)
    # At most MOST_SOURCES rows and one frame of slots: bounded, so it may be broadcast.
    frames = F.broadcast(
        spark.createDataFrame(
            [(s, max(1, -(-counts.get(s, 0) // BUCKET)), per_frame[s], slots[s]) for s in sorted(target)],
            "_s string, _n long, _a long, _slots array<long>",
        )
    )
    dealt = named.join(frames.select("_s", "_n"), "_s").withColumn("_b", F.pmod("_h", "_n"))
    ahead = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        named.join(frames.select("_s", "_n"), "_s")
        .groupBy("_s", F.pmod("_h", "_n").alias("_b"))
        .agg(F.count("*").alias("_c"))
        .select("_s", "_b", F.coalesce(F.sum("_c").over(ahead), F.lit(0)).alias("_before"))
    )
    own = Window.partitionBy("_s", "_b").orderBy("_h", F.col(doc_id))
    numbered = (
        dealt.withColumn("_i", F.row_number().over(own)).join(sizes, ["_s", "_b"]).withColumn("_i", F.col("_before") + F.col("_i") - 1)
    )
    turn = F.col("mix_block") % F.col("_a")
    placed = (
        numbered.join(frames.select("_s", "_a", "_slots"), "_s")
        .withColumn("mix_block", F.expr(f"_i div {block}"))
        .withColumn("mix_slot", F.expr("mix_block div _a") * length + F.element_at("_slots", (turn + 1).cast("int")))
    )
    return placed.select(
        *kept,
        "mix_block",
        "mix_slot",
        (F.col("mix_slot") * block + F.col("_i") % block).alias("mix_position"),
        (F.col("mix_slot") < until).alias("on_target"),
    )
