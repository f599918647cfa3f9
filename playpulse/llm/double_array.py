"""A trie in two arrays: the child of state s by symbol c is BASE[s] + c, if CHECK there is s."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

ROOT = 1
FREE = 0


class DoubleArray:
    """Packed from distinct sequences of symbols 1, 2, ... in rising order."""

    def __init__(self, sequences: Sequence[tuple[int, ...]]):
        self.base, self.check, self._next = [0, 0], [FREE, ROOT], [0, 2]
        stack = [(ROOT, 0, 0, len(sequences))]
        while stack:
            state, depth, lo, hi = stack.pop()
            while lo < hi and len(sequences[lo]) == depth:  # ends here
                lo += 1
            if lo == hi:
                continue
            starts = [i for i in range(lo, hi) if i == lo or sequences[i][depth] != sequences[i - 1][depth]]
            symbols = [sequences[i][depth] for i in starts]
            base = self.base[state] = self._fit(symbols)
            for symbol, a, b in zip(symbols, starts, [*starts[1:], hi], strict=True):
                self._occupy(base + symbol, state)
                stack.append((base + symbol, depth + 1, a, b))

    def _grow(self, slot: int) -> None:
        while len(self.check) <= slot:
            self.base.append(0)
            self.check.append(FREE)
            self._next.append(len(self._next))

    def _free(self, slot: int) -> int:
        """The first free slot from ``slot`` on; the way there is shortened for the next search."""
        self._grow(slot)
        way = []
        while self._next[slot] != slot:
            way.append(slot)
            slot = self._next[slot]
            self._grow(slot)
        for s in way:
            self._next[s] = slot
        return slot

    def _fit(self, symbols: list[int]) -> int:
        """The smallest base at which all symbols fall on free slots."""
        slot = self._free(symbols[0] + 1)
        while any(self._taken(slot - symbols[0] + s) for s in symbols[1:]):
            slot = self._free(slot + 1)
        return slot - symbols[0]

    def _taken(self, slot: int) -> bool:
        return slot < len(self.check) and self.check[slot] != FREE

    def _occupy(self, slot: int, parent: int) -> None:
        self._grow(slot)
        self.check[slot], self._next[slot] = parent, slot + 1

    def child(self, state: int, symbol: int) -> int | None:
        slot = self.base[state] + symbol
        return slot if self.base[state] and slot < len(self.check) and self.check[slot] == state else None

    def walk(self, sequence: Sequence[int]) -> Iterator[int]:
        """The states of a sequence, the root left out."""
        state = ROOT
        for symbol in sequence:
            state = self.child(state, symbol)
            if state is None:
                return
            yield state
