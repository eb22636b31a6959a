"""Table mapping with known row bounds, which decide what may be broadcast."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import keep_days

# A frame is broadcast by hint only when its row bound was measured and is at most
# this. Anything else is left to the optimizer's own size check and AQE.
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Tables(Mapping):
    """Name -> DataFrame mapping. A frame may be given as a function, which is called on
    first use, so that a query only plans the tables it touches.

    ``bounds`` holds measured upper bounds of row counts. They are facts about the
    data, so a replaced frame loses its bound unless a new one is given.
    """

    frames: dict[str, DataFrame | Callable[[], DataFrame]]
    bounds: dict[str, int] = field(default_factory=dict)
    broadcast_rows: int = BROADCAST_ROWS
    derived: dict[str, object] = field(default_factory=dict)
    ranged: dict[str, Callable] = field(default_factory=dict)
    parts: dict[str, dict[str, tuple[Callable[[], DataFrame], Column]]] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        frame = self.frames[name]
        if not isinstance(frame, DataFrame):
            frame = self.frames[name] = frame()
        return frame

    def __iter__(self) -> Iterator[str]:
        return iter(self.frames)

    def __len__(self) -> int:
        return len(self.frames)

    def once(self, name: str, make: Callable[[Tables], object]):
        """A frame or number derived from these tables, made once and reused by later queries."""
        if name not in self.derived:
            self.derived[name] = make(self)
        return self.derived[name]

    def days(self, name: str, column: str, start, end) -> DataFrame:
        """A table's rows whose ``column`` lies in a range of days; None leaves a side open.

        ``ranged`` may name a maker for a table, called with the days, whose rows include all
        of the range. It filters columns of the files, which the date is computed from, so
        that the range reaches the Parquet reader.
        """
        if name in self.ranged and not (start is None and end is None):
            return keep_days(self.ranged[name](start, end), column, start, end)
        return keep_days(self[name], column, start, end)

    def in_parts(self, name: str, text: str) -> tuple[DataFrame, Column]:
        """A table with what its column ``text`` is made of instead of that column, and the column
        as made of it. Joins that shuffle the rows carry the parts, which are shorter.

        ``parts`` may name a maker and the column for a table. One without keeps the text.
        """
        if text not in self.parts.get(name, {}):
            return self[name], F.col(text)
        make, column = self.parts[name][text]
        return self.once(f"{name} in parts of {text}", lambda _: make()), column

    def hint(self, df: DataFrame, *bounded_by: str) -> DataFrame:
        """Broadcast ``df`` if the product of these tables' row bounds is known and small."""
        rows = 1
        for name in bounded_by:
            if name not in self.bounds:
                return df
            rows *= max(self.bounds[name], 1)
        return F.broadcast(df) if rows <= self.broadcast_rows else df

    def small(self, name: str) -> DataFrame:
        return self.hint(self[name], name)

    def with_frames(self, bounds: dict[str, int] | None = None, **frames: DataFrame) -> Tables:
        kept = {n: b for n, b in self.bounds.items() if n not in frames}
        return replace(
            self,
            frames={**self.frames, **frames},
            bounds={**kept, **(bounds or {})},
            derived={},
            ranged={n: m for n, m in self.ranged.items() if n not in frames},
            parts={n: m for n, m in self.parts.items() if n not in frames},
        )

    def register_views(self, prefix: str = "") -> None:
        for name, df in self.items():
            df.createOrReplaceTempView(prefix + name)


def merge_rows(base: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """New state of a table: rows of ``changed`` replace or extend those of ``base``."""
    return base.join(changed.select(key), key, "left_anti").unionByName(changed)
