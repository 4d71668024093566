"""BagMinHash: signatures of weighted sets whose agreement is the weighted Jaccard similarity.

Every element x of a bag runs Poisson processes over its weight axis, which is cut into the
intervals [0, 1), [1, 2), [2, 4), [4, 8), ...  The points of an interval arrive at a rate of
its length; a point falls upon one of ``m`` registers, and its place in the interval is
found by halving the interval, bit by bit of its hash.  A bag of weight w at x sees the
points below w.  Every register keeps the earliest point it sees.  As the points of an
element are the same for all bags, two bags agree in a register with probability
sum(min weights) / sum(max weights).

Only points that can matter are made: up to a time by which all registers are expected to be
taken, and once more up to twice that time for the bags where one is not.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_U = np.uint64
SPARE = 3.0  # arrivals beyond the expected time, in mean register gaps


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of 64-bit numbers."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _gap(h: np.ndarray) -> np.ndarray:
    """Exponential numbers from hashes."""
    return -np.log(((h >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53)


def _intervals(bag: np.ndarray, element: np.ndarray, weight: np.ndarray):
    """Bag, seed, length, and covered length of every interval that a weight reaches into."""
    parts, k, low = [], 0, 0
    while len(bag):
        high = 1 << k
        parts.append((bag, mix(element + _U(k)), np.full(len(bag), high - low), np.minimum(weight, high) - low))
        on = weight > high
        bag, element, weight = bag[on], element[on], weight[on]
        low, k = high, k + 1
    return [np.concatenate(p) for p in zip(*parts)] if parts else None


def signatures(bag: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """Signatures (n, m) of n bags, given by rows (bag, element, weight >= 1); 0 if empty.

    A row of a bag must be its only one of that element.
    """
    result = np.zeros((n, m), np.uint64)
    total = np.bincount(bag, weight, minlength=n)
    until = m * (np.log(m) + SPARE) / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        own = todo[bag]
        rows = _intervals(bag[own], element[own], weight[own])
        first = np.full(n * m, np.inf)
        taken = np.zeros(n * m, np.uint64)
        _race(*rows, until, m, first, taken)
        full = np.isfinite(first.reshape(n, m)).all(axis=1) & todo
        result[full] = taken.reshape(n, m)[full]
        todo &= ~full
        until = until * 2
    return result


def _race(bag, seed, length, covered, until, m, first, taken) -> None:
    time = np.zeros(len(bag))
    state = seed
    while len(bag):
        state = mix(state)
        time = time + _gap(state) / length
        on = time <= until[bag]
        bag, state, length, covered, time = bag[on], state[on], length[on], covered[on], time[on]
        point = mix(state ^ _U(0x5851F42D4C957F2D))
        seen, place = np.ones(len(bag), bool), mix(point)
        if len(bag) and (covered < length).any():
            # halving the interval bit by bit: the top bits are the point's place in it
            part = (place >> _U(32)).astype(np.float64) * 2.0**-32 * length
            seen = part < covered
        register = (place & _U(0xFFFFFFFF)) * _U(m) >> _U(32)
        at = bag[seen] * m + register[seen].astype(np.int64)
        np.minimum.at(first, at, time[seen])
        won = first[at] == time[seen]
        taken[at[won]] = point[seen][won]


def band_hashes(found: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Hashes (n, bands) of the first ``bands * rows`` registers of signatures (n, m)."""
    h = np.tile(np.arange(bands, dtype=np.uint64), (len(found), 1))
    for r in range(rows):
        h = mix(h ^ found[:, r : bands * rows : rows])
    return h
