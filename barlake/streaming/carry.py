"""The value that a key carries from block to block, kept by ``transformWithStateInPandas``.

This module travels with the job instead of being imported on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

_PRICED = T.StructType(
    [T.StructField("price", T.DecimalType(28, 4)), T.StructField("volume", T.LongType()), T.StructField("amount", T.DecimalType(28, 4))]
)
#: What each kind of carry is.
TYPES = {"failures": T.LongType(), "state": T.IntegerType(), "last": _PRICED}
#: The value after a block, from the value before it and the block's summary.
COMPOSE = {
    "failures": lambda value, s: int(s["failures"]) if s["has_success"] else value + int(s["failures"]),
    "state": lambda value, s: int(s["ends"][value]),
    "last": lambda value, s: (s["price"], int(s["volume"]), s["amount"]),
}


class CarryProcessor(StatefulProcessor):
    """One value a key; a batch holds one row for each block that it closes, never the rows of the blocks."""

    def __init__(self, key: str, kind: str, start: object):
        self.key, self.kind, self.start = key, kind, start

    def init(self, handle: StatefulProcessorHandle) -> None:
        kind = TYPES[self.kind]
        self.struct = isinstance(kind, T.StructType)
        self.state = handle.getValueState("carry", kind if self.struct else T.StructType([T.StructField("value", kind)]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = self.state.get() if self.state.exists() else None
        value = self.start if held is None else (tuple(held) if self.struct else held[0])
        blocks = pd.concat(list(rows)).sort_values("block")
        before = []
        for s in blocks.to_dict("records"):
            before.append(value)
            value = COMPOSE[self.kind](value, s)
        self.state.update(value if self.struct else (value,))
        out = {self.key: blocks[self.key].to_numpy(), "block": blocks["block"].to_numpy()}
        if self.struct:
            names = TYPES[self.kind].names
            yield pd.DataFrame({**out, "carry": [None if v is None else dict(zip(names, v, strict=True)) for v in before]})
        else:
            yield pd.DataFrame({**out, "carry": before})

    def close(self) -> None:
        pass
