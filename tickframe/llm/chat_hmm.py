"""Chat transcripts into canonical turns by a hidden Markov model.

A line of a transcript shows a speaker marker of some style or none, and has a length, a question mark, and so on: one
observation out of ``N_OBSERVATIONS``. The hidden state says who speaks and whether the line opens a turn. Transition and
emission probabilities are counted from labelled conversations; Viterbi then recovers the states of any transcript, and
each recovered turn is rendered once, without its marker.

A conversation is cut into blocks of ``TURNS`` source turns. A block becomes a matrix of best path scores from the state
before it to its last state; the matrices are chained per conversation, one small row a block; then each block finds its
path between the states it was given. No conversation is held whole, however long it is; source turns that bear the same
number lie in one block. The parts of a turn that runs over the ends of blocks are put together from the first and last
spans of blocks alone, so the result does not depend on where blocks end. ``continued`` marks a turn that no opening line opens.

Null texts are empty; a text without lines gives one blank line. Lines are ordered by turn (null first), position, text
and, where all agree, are the same. A row without a conversation id is a conversation of its own. Empty tables give no rows.
Columns are named by the caller; others are not read, so their names can't clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickframe.llm.common import settled

ROLES = ["system", "user", "assistant"]
#: States: a role's opening line, a role's further lines.
STATES = [(role, opens) for role in ROLES for opens in (True, False)]
TURNS = 64

#: Marker words by role, as a line may open with them in any of the shapes of ``_SHAPE``.
MARKERS = {
    "system": "system|instruction|instructions|sys",
    "user": "user|human|question|q|customer|prompter",
    "assistant": "assistant|ai|bot|answer|a|agent|model|gpt",
}
_SHAPE = r"(?i)^\s*(?:#{1,4}\s*|\*\*|<\|?(?:im_start\|>)?|\[|>+\s*)?(?:WORDS)(?:\*\*)?\s*(?:\|?>|\]|:|>| -)(?:\*\*)?\s*"
_ANY = _SHAPE.replace("WORDS", "|".join(MARKERS.values()))

N_MARKERS, N_LENGTHS = len(ROLES) + 1, 4
N_OBSERVATIONS = N_MARKERS * N_LENGTHS * 2 * 2 + 1
_BLANK = N_OBSERVATIONS - 1


def observation(line: Column) -> Column:
    """Number of the observation a line is: marker, length, question mark, capital first letter; or blank."""
    marker = F.lit(0)
    for i, role in enumerate(ROLES):
        marker = F.when(line.rlike(_SHAPE.replace("WORDS", MARKERS[role])), F.lit(i + 1)).otherwise(marker)
    body = F.regexp_replace(line, _ANY, "")
    size = F.char_length(body)
    length = F.when(size < 40, 0).when(size < 120, 1).when(size < 400, 2).otherwise(3)
    code = ((marker * N_LENGTHS + length) * 2 + F.when(body.contains("?"), 1).otherwise(0)) * 2 + F.when(body.rlike("^[A-Z]"), 1).otherwise(0)
    return F.when(F.trim(line) == "", F.lit(_BLANK)).otherwise(code).cast("int")


def lines(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", text: str = "text", role: str | None = None) -> DataFrame:
    """``conv``, ``own``, ``turn``, ``pos``, ``line``, ``obs`` of every line; ``role`` too where it's known.

    ``own`` tells the rows without a conversation id apart, and is 0 for all others.
    """
    known = [F.col(role).alias("role")] if role else []
    # Told before the lines are taken apart, or each line would be a row of its own.
    told = rows.select(
        F.col(conv_id).cast("long").alias("conv"),
        F.when(F.col(conv_id).isNull(), F.monotonically_increasing_id()).otherwise(F.lit(0)).alias("own"),
        F.col(turn).cast("long").alias("turn"),
        *known,
        F.split(F.coalesce(F.col(text), F.lit("")), "\n").alias("lines"),
    )
    out = told.select(*(c for c in told.columns if c != "lines"), F.posexplode("lines").alias("pos", "line"))
    return out.withColumn("obs", observation(F.col("line")))


class Parameters:
    """Log probabilities: ``first`` of a conversation's first state, ``step`` between states, ``shown`` of observations."""

    def __init__(self, first: np.ndarray, step: np.ndarray, shown: np.ndarray):
        log = lambda counts: np.log((counts + 0.1) / (counts + 0.1).sum(axis=-1, keepdims=True))
        self.first, self.step, self.shown = log(first), log(step), log(shown)


def fit(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", text: str = "text", role: str = "role") -> Parameters:
    """Count transitions and emissions of conversations whose roles are known; only sums reach the driver."""
    index = lambda c, opens: F.array_position(F.array(*map(F.lit, ROLES)), c).cast("int") * 2 - F.lit(2 if opens else 1)
    known = rows.where(F.col(role).isin(ROLES))
    n = len(STATES)
    shown, step, first = np.zeros((n, N_OBSERVATIONS)), np.zeros((n, n)), np.zeros(n)
    of_line = lines(known, conv_id, turn, text, role).withColumn(
        "state", F.when(F.col("pos") == 0, index(F.col("role"), True)).otherwise(index(F.col("role"), False))
    )
    for r in of_line.groupBy("state", "obs").agg(F.count("*").alias("n")).collect():
        shown[r.state, r.obs] = r.n
    turns = known.select(
        F.col(conv_id).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"),
        F.size(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("n_lines"),
    )
    for r in turns.groupBy("role").agg(F.sum((F.col("n_lines") > 1).cast("long")).alias("a"), F.sum(F.greatest(F.col("n_lines") - 2, F.lit(0))).alias("b")).collect():
        s = 2 * ROLES.index(r.role)
        step[s, s + 1] += r.a
        step[s + 1, s + 1] += r.b
    after = turns.select("conv", (F.col("turn") - 1).alias("turn"), F.col("role").alias("next"))
    for r in turns.join(after, ["conv", "turn"]).groupBy("role", "next", (F.col("n_lines") > 1).alias("long")).agg(F.count("*").alias("n")).collect():
        step[2 * ROLES.index(r.role) + int(r.long), 2 * ROLES.index(r.next)] += r.n
    starts = turns.groupBy("conv").agg(F.min_by("role", "turn").alias("role")).groupBy("role").agg(F.count("*").alias("n"))
    for r in starts.collect():
        if r.role is not None:
            first[2 * ROLES.index(r.role)] = r.n
    return Parameters(first, step, shown)


_CONV = ["conv", "own"]
_BLOCK = [*_CONV, "block"]


def _blocked(of_line: DataFrame) -> DataFrame:
    block = F.expr(f"coalesce(turn, -1) div {TURNS}")
    return (
        of_line.withColumn("block", F.when(F.col("turn") < 0, F.lit(-1)).otherwise(block).cast("long"))
        .repartition(*_BLOCK)
        .sortWithinPartitions(*_BLOCK, "turn", "pos", "line")
    )


def _groups(batches, names: list[str]):
    """Runs of equal ``names`` of sorted input, each as one table."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).fill_null(-(1 << 62)).to_numpy() for c in names]
        cut = np.flatnonzero(np.logical_or.reduce([np.diff(k) != 0 for k in keys])) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), batch.num_rows]):
            part = batch.slice(a, b - a)
            if rest and any(rest[0].column(c)[0] != part.column(c)[0] for c in names):
                yield pa.Table.from_batches(rest).combine_chunks()
                rest = []
            rest.append(part)
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks()


def _matrix(p: Parameters, obs: np.ndarray) -> np.ndarray:
    """Best score of a path from the state before a block to each last state."""
    best = p.step + p.shown[:, obs[0]]
    for o in obs[1:]:
        best = (best[:, :, None] + p.step[None]).max(axis=1) + p.shown[:, o]
    return best


def _path(p: Parameters, obs: np.ndarray, before: int, last: int) -> list[int]:
    """Best states of a block's lines between the given states; before is -1 at a conversation's start."""
    score = (p.first if before < 0 else p.step[before]) + p.shown[:, obs[0]]
    back = np.zeros((len(obs), len(STATES)), np.int8)
    for t in range(1, len(obs)):
        ways = score[:, None] + p.step
        back[t] = ways.argmax(axis=0)
        score = ways.max(axis=0) + p.shown[:, obs[t]]
    state, out = int(score.argmax()) if last < 0 else last, []
    for t in range(len(obs) - 1, -1, -1):
        out.append(state)
        state = int(back[t, state])
    return out[::-1]


def _boundaries(p: Parameters, blocks: DataFrame) -> DataFrame:
    """``before`` and ``last`` state of every block on its conversation's best path."""

    def chain(batches):
        for table in _groups(batches, _CONV):
            matrices = np.frombuffer(b"".join(table["matrix"].to_pylist()), np.float64).reshape(-1, len(STATES), len(STATES))
            openings = np.frombuffer(b"".join(table["opening"].to_pylist()), np.float64).reshape(-1, len(STATES))
            score, back = openings[0], np.zeros((len(table), len(STATES)), np.int8)
            for b in range(1, len(table)):
                ways = score[:, None] + matrices[b]
                back[b], score = ways.argmax(axis=0), ways.max(axis=0)
            state, lasts = int(score.argmax()), []
            for b in range(len(table) - 1, -1, -1):
                lasts.append(state)
                state = int(back[b, state])
            lasts = lasts[::-1]
            yield pa.RecordBatch.from_arrays(
                [*(table[c].combine_chunks() for c in _BLOCK), pa.array([-1, *lasts[:-1]], pa.int32()), pa.array(lasts, pa.int32())],
                names=[*_BLOCK, "before", "last"],
            )

    ordered = blocks.repartition(*_CONV).sortWithinPartitions(*_BLOCK)
    return ordered.mapInArrow(chain, "conv long, own long, block long, before int, last int")


def roles(of_line: DataFrame, p: Parameters) -> DataFrame:
    """Turns recovered from lines: ``conv``, ``turn`` and ``pos`` of the first line, ``role``, ``n_lines``, ``continued``, ``text``."""

    def matrices(batches):
        for table in _groups(batches, _BLOCK):
            obs = table["obs"].to_numpy()
            opening = _opened(p, obs)
            yield pa.RecordBatch.from_arrays(
                [*(table[c].slice(0, 1).combine_chunks() for c in _BLOCK), pa.array([_matrix(p, obs).tobytes()], pa.binary()), pa.array([opening.tobytes()], pa.binary())],
                names=[*_BLOCK, "matrix", "opening"],
            )

    # Written once: what tells rows without an id apart must be the same in both passes.
    blocked = _blocked(settled(of_line, "lines"))
    blocks = blocked.mapInArrow(matrices, "conv long, own long, block long, matrix binary, opening binary")
    bounds = _boundaries(p, blocks).withColumnsRenamed({"conv": "c", "own": "o", "block": "b"})

    def decode(batches):
        for table in _groups(batches, _BLOCK):
            before = table["before"][0].as_py()
            states = _path(p, table["obs"].to_numpy(), before, table["last"][0].as_py())
            text, turn, pos = (table[c].to_pylist() for c in ("body", "turn", "pos"))
            opens = [0, *(i for i in range(1, len(states)) if _parts(states[i - 1], states[i]))]
            spans = list(zip(opens, [*opens[1:], len(states)]))
            n = len(spans)
            joins = before >= 0 and not _parts(before, states[0])
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array([table[c][0].as_py()] * n, pa.int64()) for c in _BLOCK),
                    pa.array(range(n), pa.int32()),
                    pa.array([joins, *[False] * (n - 1)]),
                    pa.array([*[False] * (n - 1), True]),
                    pa.array([turn[a] for a, _ in spans], pa.int64()),
                    pa.array([pos[a] for a, _ in spans], pa.int32()),
                    pa.array([STATES[states[a]][0] for a, _ in spans]),
                    pa.array([b - a for a, b in spans], pa.int64()),
                    pa.array([not STATES[states[a]][1] for a, _ in spans]),
                    pa.array(["\n".join(text[a:b]) for a, b in spans]),
                ],
                names=[*_BLOCK, "span", "joins", "ends", *_TURN],
            )

    marked = blocked.withColumn("body", F.regexp_replace("line", _ANY, ""))
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("own") == F.col("o")) & (F.col("block") == F.col("b"))
    joined = marked.join(bounds, same).drop("c", "o", "b")
    ordered = joined.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK, "turn", "pos", "line")
    spans = ordered.drop("line").mapInArrow(
        decode,
        "conv long, own long, block long, span int, joins boolean, ends boolean, "
        "turn long, pos int, role string, n_lines long, continued boolean, text string",
    )
    return _joined(settled(spans, "spans")).select("conv", *_TURN)


_TURN = ["turn", "pos", "role", "n_lines", "continued", "text"]


def _parts(one: int, other: int) -> bool:
    """Whether a line in state ``other`` begins a new turn after one in state ``one``."""
    return STATES[other][1] or other // 2 != one // 2


def _joined(spans: DataFrame) -> DataFrame:
    """Spans with those put together that ends of blocks cut; only first and last spans of blocks move."""
    cut = F.col("joins") | F.col("ends")
    order = Window.partitionBy(*_CONV).orderBy("block", "span").rowsBetween(Window.unboundedPreceding, 0)
    numbered = spans.where(cut).withColumn("piece", F.sum((~F.col("joins")).cast("long")).over(order))
    first = F.struct("block", "span", "turn", "pos", "role", "continued")
    whole = (
        numbered.groupBy(*_CONV, "piece")
        .agg(F.min(first).alias("f"), F.sum("n_lines").alias("n_lines"), F.sort_array(F.collect_list(F.struct("block", "span", "text"))).alias("texts"))
        .select(*_CONV, "f.turn", "f.pos", "f.role", "n_lines", "f.continued", F.array_join("texts.text", "\n").alias("text"))
    )
    return spans.where(~cut).select(*_CONV, *_TURN).unionByName(whole)


def _opened(p: Parameters, obs: np.ndarray) -> np.ndarray:
    """Best score of a path from a conversation's start to each last state."""
    score = p.first + p.shown[:, obs[0]]
    for o in obs[1:]:
        score = (score[:, None] + p.step).max(axis=0) + p.shown[:, o]
    return score


def rendered(turns: DataFrame) -> DataFrame:
    """Recovered turns with ``rendered``, their canonical form."""
    return turns.withColumn("rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), F.trim("text"), F.lit("\n<|end|>\n")))
