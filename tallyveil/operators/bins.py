"""Binning of numbers, dates and texts by edges."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def edge_labels(edges: Sequence) -> list[str]:
    """Edges as text with no more digits than keep them apart."""
    if isinstance(edges[0], float):
        for digits in range(2, 18):
            out = [f"{e:.{digits}f}" for e in edges]
            if len(set(out)) == len(edges):
                return out
    if isinstance(edges[0], dt.datetime):
        for spec in ("minutes", "seconds", "milliseconds", "microseconds"):
            out = [e.isoformat(sep=" ", timespec=spec) for e in edges]
            if len(set(out)) == len(edges):
                return out
    return [str(e) for e in edges]


@dataclass(frozen=True)
class Bins:
    """Bins between ascending edges.

    right: bins hold their right edge, else their left one. both: the first bin
    (or the last, when not right) holds both of its edges. nan: the bin of NaN.
    Values outside, and null, are in no bin.
    """

    edges: tuple
    names: tuple | None = None
    right: bool = True
    both: bool = True
    nan: object = None

    def __post_init__(self) -> None:
        if len(self.edges) < 2 or any(a >= b for a, b in zip(self.edges, self.edges[1:], strict=False)):
            raise ValueError("edges must be two or more, ascending")
        if self.names is not None and len(self.names) != len(self.edges) - 1:
            raise ValueError("there must be one name for each bin")

    def labels(self) -> list:
        if self.names is not None:
            return list(self.names)
        e, n = edge_labels(self.edges), len(self.edges) - 1
        out = []
        for i in range(n):
            left = "(" if self.right and not (self.both and i == 0) else "["
            right = ")" if not self.right and not (self.both and i == n - 1) else "]"
            out.append(f"{left}{e[i]}, {e[i + 1]}{right}")
        return out

    def all_bins(self) -> list:
        return list(dict.fromkeys([*self.labels(), *([self.nan] if self.nan is not None else [])]))

    def column(self, value: Column, floating: bool = False) -> Column:
        """The label of a value's bin."""
        n, out = len(self.edges) - 1, None
        for i, name in enumerate(self.labels()):
            low, high = F.lit(self.edges[i]), F.lit(self.edges[i + 1])
            above = value >= low if not self.right or self.both and i == 0 else value > low
            below = value <= high if self.right or self.both and i == n - 1 else value < high
            inside = above & below & ~F.isnan(value) if floating else above & below
            out = F.when(inside, F.lit(name)) if out is None else out.when(inside, F.lit(name))
        return F.when(F.isnan(value), F.lit(self.nan)).otherwise(out) if floating else out
