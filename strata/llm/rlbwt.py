"""Run-length Burrows-Wheeler index of a set of byte strings.

The strings are laid end to end, each with a separator behind it. The index
keeps the transform as runs (first row, symbol, how often the symbol occurs in
earlier runs), the text place of each run's first and last row (sampled run
ends), and the text. Patterns are streamed from their last byte to the first,
many at once: where the row's symbol is the next byte, one LF step extends the
match; else the match moves to the nearest run of that byte, before or after,
that keeps more of it (compared from the sampled ends), and goes on from there.
"""

from __future__ import annotations

import numpy as np

from .anchors import Bytes

_PACK = 7  # symbols of 9 bits in the first sort key


def _rank(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Dense ranks of the keys, their order, and whether all differ."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank, order, bool(new.all())


class RunLengthIndex:
    """Index of ``strings``, each with an owner; matches are measured up to ``length`` bytes."""

    def __init__(self, strings: list[bytes], owners: np.ndarray, length: int):
        self.length = length
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        ends = np.cumsum(sizes + 1)
        n = int(ends[-1])
        text = np.zeros(n, np.int64)  # separators are 0, bytes 1 to 256
        keep = np.ones(n, bool)
        keep[ends - 1] = False
        text[keep] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
        joined = np.zeros(n, np.uint8)
        joined[keep] = text[keep] - 1
        self.source = Bytes(joined)
        self.rest = np.repeat(ends, sizes + 1) - 1 - np.arange(n)  # bytes before the separator
        owner = np.repeat(owners, sizes + 1)

        # suffix order by doubling; the text ends where it ends, so all suffixes differ in the end
        padded = np.concatenate([text, np.zeros(_PACK, np.int64)])
        key = np.zeros(n, np.int64)
        for k in range(_PACK):
            key = (key << 9) | padded[k:n + k]
        rank, order, done = _rank(key)
        have = _PACK
        prefix = None  # rank by the first `have` symbols, the largest power that is not over `length`
        while not done or prefix is None:
            if prefix is None and 2 * have > length:
                prefix = rank, have
            if done:
                break
            after = np.zeros(n, np.int64)
            after[: n - have] = rank[have:] + 1
            rank, order, done = _rank(rank * (n + 1) + after)
            have *= 2
        suffixes = order

        # runs of the transform
        before = text[suffixes - 1]  # the row of suffix 0 wraps to the last separator
        first = np.ones(n, bool)
        first[1:] = before[1:] != before[:-1]
        self.run_start = np.flatnonzero(first)
        self.run_symbol = before[self.run_start]
        run_end = np.append(self.run_start[1:], n) - 1
        self.at_start, self.at_end = suffixes[self.run_start], suffixes[run_end]
        size = run_end - self.run_start + 1
        by_symbol = np.argsort(self.run_symbol, kind="stable")
        seen = np.cumsum(size[by_symbol]) - size[by_symbol]  # occurrences in earlier rows of smaller symbols and earlier runs
        self.run_target = np.empty(len(size), np.int64)  # LF of the run's first row
        self.run_target[by_symbol] = seen
        self.run_end = run_end
        self.symbol_runs = self.run_symbol[by_symbol] * (len(size) + 1) + by_symbol  # sorted

        # rows whose suffixes share their first `length` bytes, as runs with their smallest owner
        rank, have = prefix
        place = suffixes
        rest = np.minimum(place + length - have, n - 1)
        same = np.zeros(n, bool)
        same[1:] = (rank[place[1:]] == rank[place[:-1]]) & (rank[rest[1:]] == rank[rest[:-1]])
        self.group_start = np.flatnonzero(~same)
        self.group_owner = np.minimum.reduceat(owner[place], self.group_start)

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Bytes that the text has in common at places ``a`` and ``b``, up to ``most``: by halves, on hashes of
        substrings that end before the next separator."""
        most = np.minimum(most, np.minimum(self.rest[a], self.rest[b]))
        out = np.zeros(len(a), np.int64)
        step = 1 << max(int(most.max(initial=0)).bit_length() - 1, 0)
        while step:
            longer = np.flatnonzero(out + step <= most)
            x, y = a[longer] + out[longer], b[longer] + out[longer]
            out[longer[self.source.hashes(x, x + step) == self.source.hashes(y, y + step)]] += step
            step >>= 1
        return out

    def stream(self, patterns: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each place of each pattern (laid end to end): the length of the
        longest prefix of the rest that the text holds (up to ``length``), the
        smallest owner of a string with the first ``length`` bytes (or a very
        large number if the match is shorter), and the pattern's number."""
        sizes = np.fromiter(map(len, patterns), np.int64, len(patterns))
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(patterns), np.uint8).astype(np.int64) + 1
        lengths = np.zeros(len(data), np.int64)
        owners = np.full(len(data), np.iinfo(np.int64).max)
        order = np.argsort(-sizes, kind="stable")
        runs = len(self.run_start) + 1
        row = np.zeros(len(patterns), np.int64)
        place = np.full(len(patterns), self.at_start[0])
        match = np.zeros(len(patterns), np.int64)
        for step in range(int(sizes.max()) if len(sizes) else 0):
            lane = order[: int(np.searchsorted(-sizes[order], -step, "left"))]  # patterns longer than step
            at = ends[lane] - 1 - step
            symbol = data[at]
            q, p, m = row[lane], place[lane], match[lane]
            run = np.searchsorted(self.run_start, q, "right") - 1
            hit = self.run_symbol[run] == symbol
            jump = np.flatnonzero(~hit)
            if len(jump):
                want = symbol[jump] * runs
                k = np.searchsorted(self.symbol_runs, want + run[jump])
                known = (k < len(self.symbol_runs)) & (self.symbol_runs[np.minimum(k, len(self.symbol_runs) - 1)] < want + runs)
                down = np.where(known, self.symbol_runs[np.minimum(k, len(self.symbol_runs) - 1)] - want, -1)
                up = np.where((k > 0) & (self.symbol_runs[k - 1] >= want), self.symbol_runs[k - 1] - want, -1)
                kept_down = np.where(down >= 0, self._common(p[jump], self.at_start[down], np.where(down >= 0, m[jump], 0)), -1)
                kept_up = np.where(up >= 0, self._common(p[jump], self.at_end[up], np.where(up >= 0, m[jump], 0)), -1)
                go_up = kept_up > kept_down
                new = np.where(go_up, up, down)
                found = new >= 0
                q[jump] = np.where(found, np.where(go_up, self.run_end[new], self.run_start[new]), 0)
                p[jump] = np.where(found, np.where(go_up, self.at_end[new], self.at_start[new]), self.at_start[0])
                m[jump] = np.where(found, np.maximum(kept_up, kept_down), -1)
                run[jump] = np.where(found, new, 0)
            ok = m >= 0
            q = np.where(ok, self.run_target[run] + q - self.run_start[run], 0)
            p = np.where(ok, p - 1, self.at_start[0])
            m = np.where(ok, np.minimum(m + 1, self.length), 0)
            row[lane], place[lane], match[lane] = q, p, m
            lengths[at] = m
            full = m == self.length
            group = np.searchsorted(self.group_start, q[full], "right") - 1
            owners[at[full]] = self.group_owner[group]
        return lengths, owners, np.repeat(np.arange(len(patterns)), sizes)
