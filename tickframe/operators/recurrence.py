"""Affine recurrences over long series, without a task that holds a series.

A series is cut into blocks of calendar time. One exchange deals the rows by (series, block); it serves both passes:

1. Each block is folded, in order, into the affine map it applies to the values before it: one row per block.
2. The maps of a series are chained, which gives the values before each block.
3. With those, each block is run through once more and gives the values of its rows.

Rows stream through in Arrow batches, ``block_rows`` at a time; a block needs no more memory than that, however long it is.
Several recurrences of a series, also such that build on each other, go through the same passes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

BLOCK_ROWS = 4096
#: Calendar time of a block; a series of twenty years has some 230 blocks.
BLOCK_MS = 32 * 86_400_000
_BLOCK = "_block"


@dataclass(frozen=True)
class Term:
    """y[i] = keep * y[i-1] + add + the sum of factor * z[i] over the earlier terms z in ``of``.

    The value before the first row is ``start`` of that row. Numbers that all rows share are given as floats: they are no
    columns, so both passes read the same exchange.
    """

    keep: Column | float
    add: Column | float
    start: Column | float
    of: dict[str, float] = field(default_factory=dict)


def _scan(keep: np.ndarray, add: np.ndarray, before: float) -> np.ndarray:
    """Values of y = keep * y + add, by doubling the reach of the composed maps."""
    scale, shift, reach = keep.copy(), add.copy(), 1
    while reach < len(scale):
        shift[reach:] = scale[reach:] * shift[:-reach] + shift[reach:]
        scale[reach:] = scale[reach:] * scale[:-reach]
        reach *= 2
    return scale * before + shift


class _Terms:
    """The terms by place, as tasks need them."""

    def __init__(self, terms: dict[str, Term]):
        names = list(terms)
        self.size = len(names)
        self.of = [[(names.index(other), factor) for other, factor in term.of.items()] for term in terms.values()]
        #: Per kind and term the name of a column, or the number that all rows share.
        self.cells = {
            kind: [v if isinstance(v := getattr(term, kind), float) else f"_{kind}_{i}" for i, term in enumerate(terms.values())]
            for kind in ("keep", "add", "start")
        }

    def columns(self, terms: dict[str, Term]) -> dict[str, Column]:
        return {
            name: getattr(term, kind).cast("double")
            for kind, names in self.cells.items()
            for name, term in zip(names, terms.values())
            if isinstance(name, str)
        }

    def values(self, batch: pa.RecordBatch, kind: str, i: int) -> np.ndarray:
        cell = self.cells[kind][i]
        return batch.column(cell).to_numpy(zero_copy_only=False) if isinstance(cell, str) else np.full(batch.num_rows, cell)

    def run(self, batch: pa.RecordBatch, before: np.ndarray, alone: bool = False) -> list[np.ndarray]:
        """Values of all terms over consecutive rows; ``alone`` leaves out what is added."""
        out: list[np.ndarray] = []
        for i in range(self.size):
            keep = self.values(batch, "keep", i)
            add = np.zeros(len(keep)) if alone else self.values(batch, "add", i)
            for j, factor in self.of[i]:
                add = add + factor * out[j]
            out.append(_scan(keep, add, before[i]))
        return out

    def folded(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """Matrix and shift that consecutive rows apply to the values before them."""
        ends = [[y[-1] for y in self.run(batch, one, True)] for one in np.eye(self.size)]
        return np.array(ends).T, np.array([y[-1] for y in self.run(batch, np.zeros(self.size))])


def _runs(batches, names: Sequence[str], most: int) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Runs of at most ``most`` rows with equal ``names``, and whether a run opens a new group; input comes sorted."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        opens = np.zeros(batch.num_rows, bool)
        for name in names:
            codes = batch.column(name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            opens[1:] |= codes[1:] != codes[:-1]
        first = tuple(batch.column(name)[0].as_py() for name in names)
        opens[0] = last is None or first != last
        last = tuple(batch.column(name)[-1].as_py() for name in names)
        starts = np.append(np.flatnonzero(opens | (np.arange(len(opens)) == 0)), batch.num_rows)
        for a, b in zip(starts.tolist(), starts[1:].tolist()):
            for at in range(a, b, most):
                yield bool(opens[a]) and at == a, batch.slice(at, min(most, b - at))


def _floats(values: Sequence[float]) -> pa.Array:
    return pa.array([list(values)], pa.list_(pa.float64()))


def recurrence(
    df: DataFrame, keys: Sequence[str], t: str, terms: dict[str, Term], tie: Sequence[str] = (), block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add the values of ``terms`` by name. Rows of a series are in order of ``t`` (epoch milliseconds), then of ``tie``;
    rows without ``t`` come first. Further columns travel along, so nothing has to be joined back.
    """
    keys, spec = list(keys), _Terms(terms)
    group = [*keys, _BLOCK]
    block = F.floor(F.col(t) / BLOCK_MS).cast("bigint")
    rows = df.withColumns({_BLOCK: block, **spec.columns(terms)}).repartition(*group)
    order = [*group, t, *tie]
    columns, added = df.columns, list(terms)

    def fold(batches):
        held = None
        for opens, run in _runs(batches, group, block_rows):
            if opens and held is not None:
                yield closed(*held)
            matrix, shift = spec.folded(run)
            if opens:
                held = run.slice(0, 1), matrix, shift
            else:
                held = held[0], matrix @ held[1], matrix @ held[2] + shift
        if held is not None:
            yield closed(*held)

    def closed(row, matrix, shift):
        start = [spec.values(row, "start", i)[0] for i in range(spec.size)]
        cells = [*(row.column(name) for name in group), _floats(matrix.ravel()), _floats(shift), _floats(start)]
        return pa.RecordBatch.from_arrays(cells, names=[*group, "_matrix", "_shift", "_start"])

    def chain(batches):
        before = None
        for opens, run in _runs(batches, keys, block_rows):
            cells = [run.column(name).to_pylist() for name in ("_matrix", "_shift", "_start")]
            out = []
            for i, (matrix, shift, start) in enumerate(zip(*cells)):
                before = np.array(start, float) if opens and i == 0 else before
                out.append(before.tolist())
                before = np.array(matrix).reshape(spec.size, spec.size) @ before + np.array(shift)
            cells = [*(run.column(name) for name in group), pa.array(out, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(cells, names=[*group, "_before"])

    def finish(batches):
        before = None
        for opens, run in _runs(batches, group, block_rows):
            before = np.array(run.column("_before")[0].as_py()) if opens else before
            made = spec.run(run, before)
            before = np.array([y[-1] for y in made])
            yield pa.RecordBatch.from_arrays([*(run.column(name) for name in columns), *map(pa.array, made)], names=[*columns, *added])

    numbers = ArrayType(DoubleType())
    ends = rows.select(*group).schema
    for name in ("_matrix", "_shift", "_start"):
        ends = ends.add(name, numbers)
    maps = rows.sortWithinPartitions(*order).mapInArrow(fold, ends)
    carried = maps.repartition(*keys).sortWithinPartitions(*group).mapInArrow(chain, rows.select(*group).schema.add("_before", numbers))
    carried = carried.withColumnsRenamed({name: f"_of{name}" for name in group})
    same = reduce(Column.__and__, (F.col(name).eqNullSafe(F.col(f"_of{name}")) for name in group))
    schema = StructType([*df.schema.fields, *(StructField(name, DoubleType()) for name in terms)])
    return rows.join(carried, same).select(*rows.columns, "_before").sortWithinPartitions(*order).mapInArrow(finish, schema)
