"""Ids of strings that a Python worker has already encoded."""

from __future__ import annotations

from itertools import chain


class IdStore:
    """string -> ids, kept in flat arrays so that the ids of many strings are gathered in one step."""

    def __init__(self):
        import numpy as np

        self.known: dict[str, int] = {}  # string -> number
        self.begin, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)  # by number
        self.flat, self.used = np.zeros(1 << 18, np.uint32), 0

    @staticmethod
    def _room(array, n):
        import numpy as np

        return array if n <= len(array) else np.concatenate((array, np.zeros(max(n - len(array), len(array)), array.dtype)))

    def add(self, strings: list[str], ids: list):
        """Learn new strings and their ids, one iterable of ids each."""
        import numpy as np

        first, sizes = len(self.known), np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.uint32, sizes.sum())
        self.begin, self.size = self._room(self.begin, first + len(strings)), self._room(self.size, first + len(strings))
        self.flat = self._room(self.flat, self.used + len(flat))
        self.begin[first:first + len(strings)] = self.used + np.cumsum(sizes) - sizes
        self.size[first:first + len(strings)] = sizes
        self.flat[self.used:self.used + len(flat)] = flat
        self.used += len(flat)
        self.known.update(zip(strings, range(first, first + len(strings))))

    def numbers(self, strings: list[str], learn) -> list[int]:
        """Numbers of the strings; ``learn`` adds those not met before."""
        found = list(map(self.known.get, strings))
        if None in found:
            learn([s for s, n in zip(strings, found) if n is None])
            found = list(map(self.known.get, strings))
        return found

    def gather(self, numbers):
        """(the ids of all numbers in a row, the end of each number's ids)."""
        import numpy as np

        sizes = self.size[numbers]
        after = np.cumsum(sizes)
        at = np.repeat(self.begin[numbers] - after + sizes, sizes)
        at += np.arange(len(at))
        return self.flat[at], after
