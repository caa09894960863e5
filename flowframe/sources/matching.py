"""Many keywords and boxes at once, for ``stream_filter_many``."""

from __future__ import annotations

from collections import defaultdict

import numpy as np

#: Cell sizes of the grid in degrees, from the smallest; a box lies in the cells of the first size that is as large as it.
CELLS = tuple(360 / 2**k for k in range(16, -1, -1))


class Phrases:
    """Which texts hold all words of any phrase, as whole words in any case.

    One automaton finds the words of all phrases in a pass over a text. A phrase is looked
    at only where its rarest word (the one that fewest phrases have) was found.
    """

    def __init__(self, phrases: list[str]):
        import ahocorasick

        wanted = {tuple(sorted(set(phrase.lower().split()))) for phrase in phrases}
        shared = defaultdict(int)
        for words in wanted:
            for word in words:
                shared[word] += 1
        self.by_word: dict[str, list[tuple[str, ...]]] = defaultdict(list)
        self.always = () in wanted
        for words in sorted(wanted):
            if words:
                self.by_word[min(words, key=lambda w: (shared[w], w))].append(words)
        self.automaton = ahocorasick.Automaton()
        for word in shared:
            self.automaton.add_word(word, word)
        if shared:
            self.automaton.make_automaton()
        self.any = bool(shared)

    def fits(self, low: str | None) -> bool:
        """``low`` is a text in lower case."""
        if low is None:
            return False
        if self.always or not self.any:
            return self.always
        found, due = set(), []
        size = len(low)
        for last, word in self.automaton.iter(low):
            first = last - len(word) + 1
            if word in found or (first and _inner(low[first - 1])) or (last + 1 < size and _inner(low[last + 1])):
                continue
            found.add(word)
            for words in self.by_word.get(word, ()):
                if len(words) == 1:
                    return True
                due.append(words)
        return any(found.issuperset(words) for words in due)


def _inner(character: str) -> bool:
    return character.isalnum() or character == "_"


class Boxes:
    """Which points lie in any box, by a grid whose cell size follows the size of a box."""

    def __init__(self, boxes: list[tuple[float, float, float, float]]):
        cells: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for number, (south, west, north, east) in enumerate(boxes):
            if south > north or west > east:
                continue
            size = max(north - south, east - west)
            level = next((k for k, cell in enumerate(CELLS) if cell >= size), len(CELLS) - 1)
            low, high = self._cell(south, west, level), self._cell(north, east, level)
            for row in range(low[0], high[0] + 1):
                for column in range(low[1], high[1] + 1):
                    cells[level][self._code(row, column)].append(number)
        self.edges = np.array(boxes, dtype=float).reshape(-1, 4)
        self.levels = {}
        for level, held in cells.items():
            codes = np.array(sorted(held))
            numbers = [held[code] for code in codes.tolist()]
            ends = np.cumsum([len(one) for one in numbers])
            self.levels[level] = (codes, np.concatenate([[0], ends]), np.concatenate(numbers))

    @staticmethod
    def _cell(lat: float, lon: float, level: int) -> tuple[int, int]:
        return int(np.floor(lat / CELLS[level])), int(np.floor(lon / CELLS[level]))

    @staticmethod
    def _code(row, column):
        return (row << 32) + column

    def fit(self, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
        """Per point whether a box holds it; a point that is not finite is in none."""
        out = np.zeros(len(lat), dtype=bool)
        known = np.flatnonzero(np.isfinite(lat) & np.isfinite(lon) & (np.abs(lat) < 1e6) & (np.abs(lon) < 1e6))
        for level, (codes, begins, numbers) in self.levels.items():
            rest = known[~out[known]]
            rows, columns = (np.floor(axis[rest] / CELLS[level]).astype(np.int64) for axis in (lat, lon))
            own = self._code(rows, columns)
            at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
            hit = codes[at] == own
            rest, at = rest[hit], at[hit]
            # One candidate box of each point's cell at a time, for all points together.
            turn = begins[at]
            while len(rest):
                south, west, north, east = self.edges[numbers[turn]].T
                inside = (south <= lat[rest]) & (lat[rest] <= north) & (west <= lon[rest]) & (lon[rest] <= east)
                out[rest[inside]] = True
                turn = turn + 1
                left = ~inside & (turn < begins[at + 1])
                rest, at, turn = rest[left], at[left], turn[left]
        return out
