"""Repeated backward steps over a decision model that lies in blocks of states."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuriver.session import cut_lineage

#: States up to which their values, a few numbers each, are handed to every task; a larger model is joined.
MOST_STATES = 1_000_000
#: Model rows of a block, about.
BLOCK_ROWS = 500_000

Step = Callable[["Block", np.ndarray], dict[str, np.ndarray]]


class Block:
    """Model rows of some states in the order of state and action, with the place of each next state."""

    def __init__(self, columns: dict[str, np.ndarray], states: np.ndarray):
        order = np.lexsort((columns["action"], columns["state"]))
        self.columns = {n: c[order] for n, c in columns.items()}
        state, action, ahead = (self.columns[n] for n in ("state", "action", "next_state"))
        place = np.minimum(np.searchsorted(states, ahead), len(states) - 1)
        self.next = np.where(states[place] == ahead, place, len(states))  # one place past the end is worth nothing
        self.pair = np.flatnonzero((np.diff(state, prepend=state[:1] - 1) != 0) | (np.diff(action, prepend=action[:1]) != 0))
        self.state = np.flatnonzero(np.diff(state, prepend=state[:1] - 1) != 0)
        self.pairs_from = np.searchsorted(self.pair, self.state)

    def by_pair(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, self.pair)

    def by_state(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, self.state)


class StateBlocks:
    """A model (state, action, next_state, further numbers) dealt out by state, and values that steps pass on.

    Every step reads each block once and gives back the new values of its states; only these, one row a
    state, go through the driver to the next step. None of the model is shuffled again.
    """

    def __init__(self, moves: DataFrame, values: Sequence[str], states: DataFrame | None = None):
        self.values = list(values)
        self.numbers = [c for c in moves.columns if c not in ("state", "action", "next_state")]
        found = (moves if states is None else states).select(F.col("state").cast("long")).distinct().orderBy("state").toArrow()
        self.states = found.column(0).to_numpy()
        rows = moves.select(*[F.col(c).cast("long") for c in ("state", "action", "next_state")], *[F.col(c).cast("double") for c in self.numbers])
        parts = max(1, -(-moves.count() // BLOCK_ROWS))
        self.blocks = cut_lineage(rows.repartition(parts, "state"))

    def run(self, step: Step, now: np.ndarray, schema: str) -> DataFrame:
        """What ``step`` makes of every block and the values ``now`` (values x states)."""
        states, names = self.states, ["state", "action", "next_state", *self.numbers]
        ahead = np.concatenate((now, np.zeros((len(now), 1))), axis=1)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tables = [b for b in batches if b.num_rows]
            if tables:
                columns = {n: np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in tables]) for k, n in enumerate(names)}
                out = step(Block(columns, states), ahead)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out.values()], list(out))

        return self.blocks.mapInArrow(work, schema)

    def step(self, step: Step, now: np.ndarray) -> np.ndarray:
        """Values after ``step``, which gives state and one column for each value; states without rows get 0."""
        schema = ", ".join(["state long", *(f"{v} double" for v in self.values)])
        found = self.run(step, now, schema).toArrow()
        out = np.zeros((len(self.values), len(self.states)))
        out[:, np.searchsorted(self.states, found.column(0).to_numpy())] = [found.column(v).to_numpy() for v in self.values]
        return out
