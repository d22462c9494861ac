"""A suffix automaton over sequences of numbers, and matching statistics of other sequences against it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence


class SuffixAutomaton:
    """All factors of the added sequences; :meth:`close` counts how often each occurs."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, link: int, moves: dict[int, int], count: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.count.append(count)
        return len(self.next) - 1

    def add(self, sequence: Sequence[int], times: int = 1) -> None:
        """Add one sequence that occurs ``times`` times; factors do not run over from the one before."""
        last = 0
        for symbol in sequence:
            last = self._extend(last, symbol)
            self.count[last] += times

    def _extend(self, last: int, symbol: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        known = nxt[last].get(symbol)
        if known is not None:  # an earlier sequence came this way
            return known if length[known] == length[last] + 1 else self._split(last, symbol, known)
        new = self._state(length[last] + 1, 0, {}, 0)
        p = last
        while p >= 0 and symbol not in nxt[p]:
            nxt[p][symbol] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][symbol]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, symbol, q)
        return new

    def _split(self, p: int, symbol: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = self._state(length[p] + 1, link[q], dict(nxt[q]), 0)
        link[q] = clone
        while p >= 0 and nxt[p].get(symbol) == q:
            nxt[p][symbol] = clone
            p = link[p]
        return clone

    def close(self) -> None:
        """Add the occurrences of every state to those of its suffixes."""
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]

    def statistics(self, sequence: Sequence[int], least: int) -> Iterator[tuple[int, int]]:
        """For each place: the length of the longest factor that ends there, and the occurrences of the factor of
        ``least`` symbols that ends there (0 where the longest is shorter)."""
        nxt, link, length, count = self.next, self.link, self.length, self.count
        state = size = 0
        for symbol in sequence:
            while state and symbol not in nxt[state]:
                state = link[state]
                size = length[state]
            if symbol in nxt[state]:
                state = nxt[state][symbol]
                size += 1
            at = state
            if size >= least:
                while length[link[at]] >= least:
                    at = link[at]
                yield size, count[at]
            else:
                yield size, 0
