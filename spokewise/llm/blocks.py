"""Pigeonhole keys of 64-bit fingerprints: values of pairs of bit blocks."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cut(bits: list[int], parts: int) -> list[list[int]]:
    """``bits`` in so many runs of about equal length."""
    edge = [round(k * len(bits) / parts) for k in range(parts + 1)]
    return [bits[x:y] for x, y in zip(edge, edge[1:])]


def _runs(bits: list[int]) -> list[tuple[int, int]]:
    """(shift, width) of the maximal runs of neighbouring bits."""
    out: list[list[int]] = []
    for b in bits:
        if out and b == out[-1][0] + out[-1][1]:
            out[-1][1] += 1
        else:
            out.append([b, 1])
    return [(s, w) for s, w in out]


def _value(fp: Column, bits: list[int]) -> Column:
    """The given bits of ``fp`` packed into an integer."""
    value, at = F.lit(0).cast("long"), 0
    for s, w in _runs(bits):
        value = value.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, s).bitwiseAND(F.lit((1 << w) - 1)), at))
        at += w
    return value


def block_keys(fp: Column, free: list[int], parts: int) -> list[tuple[Column, list[int]]]:
    """(key, bits that it leaves free) for every pair of the blocks of ``free``."""
    blocks = _cut(free, parts)
    out = []
    for n, (i, j) in enumerate(combinations(range(parts), 2)):
        width = len(blocks[i]) + len(blocks[j])
        key = _value(fp, blocks[i] + blocks[j]).bitwiseOR(F.lit(n << width).cast("long"))
        out.append((key, [b for b in free if b not in blocks[i] and b not in blocks[j]]))
    return out
