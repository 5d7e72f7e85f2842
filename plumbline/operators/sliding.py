"""User-defined window functions that slide: a row enters the frame (step), a row leaves it (inverse), and the value is read."""

from __future__ import annotations

import bisect
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.ordering import rank_rows


class Frame(Protocol):
    """What a user-defined window function has to offer; it holds the rows of one frame."""

    def step(self, value: Any) -> None: ...

    def inverse(self, value: Any) -> None: ...

    def value(self) -> Any: ...


class TwoStacks:
    """A frame from step / merge / finalize alone, for functions that cannot take a row back (maximum, sketches, products).

    Rows that leave come off a stack of merges made backwards; when it is empty the rows that came since are turned over into it, so each row is merged
    twice whatever the frame's length.
    """

    def __init__(self, lift: Callable[[Any], Any], merge: Callable[[Any, Any], Any], finalize: Callable[[Any], Any] = lambda x: x):
        self.lift, self.merge, self.finalize = lift, merge, finalize
        self.front: list[Any] = []
        self.back: list[Any] = []
        self.sum: Any = None

    def step(self, value: Any) -> None:
        x = self.lift(value)
        self.sum = self.merge(self.sum, x) if self.back else x
        self.back.append(x)

    def inverse(self, value: Any) -> None:
        if not self.front:
            while self.back:
                x = self.back.pop()
                self.front.append(self.merge(x, self.front[-1]) if self.front else x)
            self.sum = None
        self.front.pop()

    def value(self) -> Any:
        if self.front and self.back:
            return self.finalize(self.merge(self.front[-1], self.sum))
        return self.finalize(self.front[-1] if self.front else self.sum) if self.front or self.back else None


class RunningMedian:
    """Median of the frame, NULL left out, over a sorted list."""

    def __init__(self):
        self.values: list[float] = []

    def step(self, value: float | None) -> None:
        if value is not None:
            bisect.insort(self.values, value)

    def inverse(self, value: float | None) -> None:
        if value is not None:
            del self.values[bisect.bisect_left(self.values, value)]

    def value(self) -> float | None:
        n = len(self.values)
        return (self.values[(n - 1) // 2] + self.values[n // 2]) / 2 if n else None


def sliding(df: DataFrame, by: Sequence[str], order: str, tie: str, value: str, width: int, frame: Callable[[], Frame], returns: str, name: str = "value", chunk: int = 100_000) -> DataFrame:
    """``df`` with ``name``: the user's function over the last ``width`` rows of each entity, in order.

    An entity of any size is cut into chunks of its row positions, each of which also receives the ``width - 1`` rows before it.  A task reads its chunks in order
    and lets one frame slide over each: a step for every row, and an inverse for every row that leaves, so a long frame costs no more than a short one.
    ``frame`` makes an empty frame, a :class:`Frame` of the user's or :class:`TwoStacks`; ``returns`` is the SQL type of its value.  NULLs are handed on.
    """
    if width < 1:
        raise ValueError("width is at least 1")
    chunk = max(chunk, width)
    placed = rank_rows(df, order, tie, by=by, name="__pos")
    own = F.floor((F.col("__pos") - 1) / chunk)
    ahead = (F.pmod(F.col("__pos") - 1, F.lit(chunk)) >= chunk - (width - 1)) if width > 1 else F.lit(False)
    spread = placed.withColumn("__own", own).withColumn("__chunk", F.explode(F.when(ahead, F.array(own, own + 1)).otherwise(F.array(own))))
    keys = [*by, "__chunk"]
    dealt = spread.repartition(*keys).sortWithinPartitions(*keys, "__pos")
    kept = [c for c in df.columns if c != name]
    shape = df.select(*[F.col(f"`{c}`") for c in kept]).schema.simpleString()[len("struct<") : -1]

    def slide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, state = None, deque(), None
        for batch in batches:
            groups = zip(*(batch.column(c).to_pylist() for c in keys))
            at, found = [], []
            for i, (group, home, v) in enumerate(zip(groups, batch.column("__own").to_pylist(), batch.column(value).to_pylist())):
                if state is None or group != now:
                    now, held, state = group, deque(), frame()
                state.step(v)
                held.append(v)
                if len(held) > width:
                    state.inverse(held.popleft())
                if home == group[-1]:
                    at.append(i)
                    found.append(state.value())
            own_rows = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_pydict({c: own_rows.column(c) for c in kept} | {name: pa.array(found, kinds)})

    kinds = {"double": pa.float64(), "long": pa.int64(), "bigint": pa.int64(), "string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}[returns]
    return dealt.mapInArrow(slide, f"{shape}, `{name}` {returns}").select(*kept, name)
