"""Streaming over rows that Spark has partitioned and sorted by a key."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd


def sorted_groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, dict[str, np.ndarray]]]:
    """(key, columns) of each run of equal keys. A group may go over several batches; one group is held at a time."""
    name, held = None, []

    def whole():
        return {c: np.concatenate([h[c] for h in held]) for c in held[0]} if len(held) > 1 else held[0]

    for pdf in batches:
        if not len(pdf):
            continue
        columns = {c: pdf[c].to_numpy() for c in pdf.columns}
        values = [columns[k] for k in keys]
        cuts = np.flatnonzero(np.logical_or.reduce([v[1:] != v[:-1] for v in values])) + 1
        for a, b in pairwise([0, *cuts.tolist(), len(pdf)]):
            key = tuple(v[a] for v in values)
            if held and key != name:
                yield name, whole()
                held = []
            name = key
            held.append({c: v[a:b] for c, v in columns.items()})
    if held:
        yield name, whole()


def gathered(parts: Iterator[tuple[list, ...]], columns: list[str], rows: int = 512) -> Iterator[pd.DataFrame]:
    """Frames of some hundred rows from the columns of small groups, so that few frames are built and few Arrow batches sent."""
    held = [[] for _ in columns]
    for part in parts:
        for h, values in zip(held, part, strict=True):
            h.extend(values)
        if len(held[0]) >= rows:
            yield pd.DataFrame(dict(zip(columns, held, strict=True)))
            held = [[] for _ in columns]
    if held[0]:
        yield pd.DataFrame(dict(zip(columns, held, strict=True)))
