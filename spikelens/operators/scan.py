"""Task-side helper of the self-filtering window: one ordered pass, a few doubles of state."""

from __future__ import annotations

import math
import operator
from collections import deque
from functools import reduce

import numpy as np

from spikelens.params import EngineParams

# After this many events in a row outside the window the search goes on in numpy blocks.
_PATIENCE = 48
_BLOCK = 4096
# Shorter stretches are walked event by event; longer ones in blocks that are guessed and corrected.
_SHORT = 32
_GUESSES = 8


def window_of(values, params: EngineParams) -> deque:
    """Newest first; a full window drops its oldest value by itself."""
    return deque(list(values or [])[: params.window], maxlen=params.window)


def mean(window) -> float | None:
    """Average of the finite values, summed newest first."""
    if not window:
        return None
    total, count = reduce(operator.add, window, 0.0), len(window)
    if not math.isfinite(total):
        finite = [v for v in window if math.isfinite(v)]
        if not finite:
            return None
        total, count = reduce(operator.add, finite, 0.0), len(finite)
    return total / count


def limit_of(avg: float | None, params: EngineParams) -> float:
    """The value above which an event counts as an anomaly."""
    if avg is not None and math.isfinite(avg) and avg > 0:
        return avg * params.multiplier
    return params.fallback


def _next_accepted(values, live, start: int, limit: float) -> int:
    size = _BLOCK
    while start < len(values):
        stop = start + size
        fits = ~(values[start:stop] > limit)
        if live is not None:
            fits &= live[start:stop]
        first = int(fits.argmax())
        if fits[first]:
            return start + first
        start, size = stop, size * 2
    return len(values)


def _guess_block(values, live, window: deque, params: EngineParams, averages, limits) -> int:
    """Score a block by guessing which events enter; returns how many events are surely right.

    A guess gives every event its window, and so a new guess. An event is right once all before it
    are, so each turn settles one more at least and mostly all of them. Sums run newest first, as
    in ``mean``, so the averages are equal to the last bit. 0: a sum is not finite.
    """
    size, have = params.window, len(window)
    past = np.concatenate([np.zeros(size), np.array(list(window)[::-1], np.float64)])
    enters = ~(values > limit_of(mean(window), params))
    if live is not None:
        enters &= live
    right = 0
    for _ in range(_GUESSES):
        row = np.concatenate([past, values[enters]])
        states = len(row) - len(past) + 1
        total = np.zeros(states)
        for back in range(1, size + 1):
            begin = size + have - back
            total += row[begin : begin + states]
        if not np.isfinite(total).all():
            return 0
        count = np.minimum(have + np.arange(states), size)
        average = np.divide(total, count, out=np.full(states, np.nan), where=count > 0)
        bound = np.where(average > 0, average * params.multiplier, params.fallback)
        state = np.cumsum(enters) - enters
        limit = bound[state]
        better = ~(values > limit)
        if live is not None:
            better &= live
        wrong = better != enters
        first = int(wrong.argmax())
        done = not wrong[first]
        enters, right = better, len(values) if done else first + 1
        if done:
            break
    if averages is not None:
        averages[:right] = average[state[:right]]
        limits[:right] = limit[:right]
    window.extendleft(values[:right][enters[:right]][-size:].tolist())
    return right


def _advance(values, live, window: deque, params: EngineParams, averages, limits) -> None:
    """Blocks while guesses settle well, else event by event for a stretch."""
    at, size, total = 0, _BLOCK, len(values)
    while at < total:
        stop = min(total, at + size)
        part = slice(at, stop)
        given = (
            values[part],
            None if live is None else live[part],
            window,
            params,
            None if averages is None else averages[part],
            None if limits is None else limits[part],
        )
        settled = _guess_block(*given) if stop - at >= _SHORT else 0
        if settled == 0:
            _walk(*given)
            settled = stop - at
        elif settled < min(size, stop - at) // 2:
            # A block that settles slowly: shorter ones, in the end event by event.
            size = max(_SHORT // 2, size // 4)
        else:
            size = min(_BLOCK, 2 * size)
        if size < _SHORT:
            size = 8 * _SHORT
            stretch = slice(at + settled, min(total, at + settled + size))
            _walk(
                values[stretch],
                None if live is None else live[stretch],
                window,
                params,
                None if averages is None else averages[stretch],
                None if limits is None else limits[stretch],
            )
            settled = stretch.stop - at
        at += settled


def _walk(values, live, window: deque, params: EngineParams, averages, limits) -> None:
    listed = values.tolist()
    flags = None if live is None else live.tolist()
    at, total = 0, len(listed)
    while at < total:
        avg = mean(window)
        limit = limit_of(avg, params)
        end, patience = at, min(total, at + _PATIENCE)
        if flags is None:
            while end < patience and listed[end] > limit:
                end += 1
        else:
            while end < patience and (listed[end] > limit or not flags[end]):
                end += 1
        if end == patience and end < total:
            end = _next_accepted(values, live, end, limit)
        scored = min(end + 1, total)
        if averages is not None:
            averages[at:scored] = math.nan if avg is None else avg
            limits[at:scored] = limit
        if end < total:
            window.appendleft(listed[end])
        at = scored


def advance(values, live, cuts, window: deque, params: EngineParams, averages=None, limits=None):
    """Move ``window`` over the events; note each event's average and limit if asked to.

    ``live`` marks the events allowed to enter the window (None: all). The window is emptied
    before every position in ``cuts``.
    """
    edges = [0, *cuts, len(values)]
    for number, (start, stop) in enumerate(zip(edges, edges[1:])):
        if number:
            window.clear()
        if start < stop:
            _advance(
                values[start:stop],
                None if live is None else live[start:stop],
                window,
                params,
                None if averages is None else averages[start:stop],
                None if limits is None else limits[start:stop],
            )
