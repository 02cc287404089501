"""Prefix-free parsing of bytes: rolling-hash triggers, phrases, and the runs of windows that share a trigger."""

import functools

import numpy as np

#: Bytes of the rolling window whose hash decides on a trigger, and the length of a repeat.
GRAM, LENGTH = 16, 400
#: Leading zero bits of the hashes of triggers by rank: one byte in 128 is a trigger of the first rank.
RANKS = (7, 4, 2, 1)
HALF = (LENGTH - GRAM) // 2

_rng = np.random.default_rng(400)
_BYTES = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64)
_BASES = _rng.integers(1, 2**62, 2, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_INVERSES = np.array([pow(int(b), -1, 2**64) for b in _BASES], np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


@functools.lru_cache(8)
def _all_powers(base: int, n: int) -> np.ndarray:
    power = np.full(n, base, np.uint64)
    power[0] = 1
    return np.multiply.accumulate(power, out=power)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """At least the first ``n`` powers of a base, kept from call to call."""
    return _all_powers(int(base), 1 << max(n, 1 << 16).bit_length())


class Hashes:
    """Hashes of all parts of some bytes, 64 bits each, from running sums; the two kinds are independent."""

    def __init__(self, data: np.ndarray):
        self.sums = []
        for k in range(2):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_BYTES[k][data] * _powers(_BASES[k], len(data))[:len(data)], out=sums[1:])
            self.sums.append(sums)

    def of(self, k: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        back = _powers(_INVERSES[k], len(self.sums[k]))
        return mixed((self.sums[k][end] - self.sums[k][start]) * back[start] + (end - start).astype(np.uint64)).view(np.int64)


def grams(data: np.ndarray) -> np.ndarray:
    """Rolling hashes of the ``GRAM`` bytes from each place, by doubling."""
    h, size, power = _BYTES[0][data], 1, int(_BASES[0])
    while size < GRAM:
        after = h[size:]
        h = h[:-size] * np.uint64(power)
        h += after
        power, size = power * power % 2**64, size * 2
    return mixed(h)


def _rest(h: np.ndarray, text: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs in ranges of windows without a trigger of the first rank: text, first and last window, trigger, whether there is none."""
    counts = last - first + 1
    total = int(counts.sum())
    text = np.repeat(text, counts)
    window = np.arange(total) - np.repeat(np.cumsum(counts) - counts - first, counts)
    place, left = window.copy(), np.arange(total)
    for rank in RANKS[1:]:
        triggers = np.append(np.flatnonzero(h < np.uint64(1 << 64 - rank)), 2**62)
        own = window[left]
        found = triggers[np.searchsorted(triggers, own)]
        hit = found <= own + LENGTH - GRAM
        place[left[hit]] = found[hit]
        left = left[~hit]
    alone = np.zeros(total, bool)
    alone[left] = True
    near = place - window <= HALF
    new = np.append(True, (window[1:] != window[:-1] + 1) | (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | (near[1:] != near[:-1]) | alone[1:] | alone[:-1])
    start = np.flatnonzero(new)
    return text[start], window[start], window[np.append(start[1:], total) - 1], place[start], alone[start]


def runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """The windows of ``LENGTH`` bytes of the texts in ``data``, as runs: text, first and last window, start and end of the core, end of the last window.

    A window belongs to the first trigger of the lowest rank that lies in it; in text without any, to itself. What a window belongs to is
    told by its bytes alone, so equal windows belong to equal triggers at equal distance. A run is a phrase before its
    trigger, at most half a window long: its bytes start windows that go on over the trigger. All of them hold the run's core.
    """
    stops = np.maximum(ends - LENGTH + 1, starts)
    if not (stops > starts).any():
        return tuple(np.empty(0, np.int64) for _ in range(5))
    h = grams(data)
    # Most windows have a trigger of the first rank: whole ranges of them, parted where the trigger, its nearness or the text changes.
    triggers = np.flatnonzero(h < np.uint64(1 << 64 - RANKS[0]))
    after = np.append(0, triggers + 1)
    cuts = np.unique(np.concatenate([starts, stops, after, np.maximum(triggers - HALF, after[:-1]), np.maximum(triggers - LENGTH + GRAM, after[:-1])]))
    first, last = cuts[:-1], cuts[1:] - 1
    text = np.searchsorted(starts, first, "right") - 1
    inside = (text >= 0) & (first < stops[text])
    text, first, last = text[inside], first[inside], last[inside]
    place = np.append(triggers, 2**62)[np.searchsorted(triggers, first)]
    hit = place <= first + LENGTH - GRAM
    found = [(text[hit], first[hit], last[hit], place[hit], np.zeros(int(hit.sum()), bool))]
    if not hit.all():
        found.append(_rest(h, text[~hit], first[~hit], last[~hit]))
    text, first, last, at, alone = (np.concatenate(c) for c in zip(*found, strict=True))
    near = at - last <= HALF
    core = np.where(near, at, at - HALF - 1), np.where(alone, at + LENGTH, np.where(near, at + GRAM + LENGTH - GRAM - HALF, at + GRAM))
    order = np.argsort(first, kind="stable")
    return tuple(c[order] for c in (text, first, last, *core))
