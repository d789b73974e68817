"""Columns of numbers packed into one binary value, so that a row carries thousands of entries."""

from __future__ import annotations

import numpy as np

Columns = dict[str, np.ndarray]


class Layout:
    """Named columns of fixed types, stored one after the other."""

    def __init__(self, **types: str):
        self.types = {name: np.dtype(t) for name, t in types.items()}
        self.width = sum(t.itemsize for t in self.types.values())

    def empty(self) -> Columns:
        return {name: np.zeros(0, t) for name, t in self.types.items()}

    def pack(self, columns: Columns) -> bytes:
        return b"".join(columns[n].astype(t, copy=False).tobytes() for n, t in self.types.items())

    def unpack(self, blobs: list[bytes]) -> Columns:
        parts = [self._one(b) for b in blobs if b]
        if not parts:
            return self.empty()
        return {n: np.concatenate([p[n] for p in parts]) for n in self.types}

    def _one(self, blob: bytes) -> Columns:
        n, at, out = len(blob) // self.width, 0, {}
        for name, t in self.types.items():
            out[name] = np.frombuffer(blob, t, n, at)
            at += n * t.itemsize
        return out

    def by_group(self, columns: Columns, group: np.ndarray) -> tuple[list[int], list[bytes]]:
        """One packed value for each distinct group."""
        if not len(group):
            return [], []
        order = np.argsort(group, kind="stable")
        group = group[order]
        columns = {n: columns[n][order].astype(t, copy=False) for n, t in self.types.items()}
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        ends = np.append(starts[1:], len(group))
        blobs = [
            b"".join(c[a:b].tobytes() for c in columns.values())
            for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
        ]
        return group[starts].tolist(), blobs


def take(columns: Columns, which: np.ndarray) -> Columns:
    return {n: c[which] for n, c in columns.items()}


def joined(*parts: Columns) -> Columns:
    return {n: np.concatenate([p[n] for p in parts]) for n in parts[0]}


def changes(*columns: np.ndarray) -> np.ndarray:
    """True at each row that differs from the row before it in any column, and at the first."""
    out = np.zeros(len(columns[0]), bool)
    if len(out):
        out[0] = True
        for c in columns:
            out[1:] |= c[1:] != c[:-1]
    return out
