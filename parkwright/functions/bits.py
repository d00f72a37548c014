"""Edit distances and alignments of long sequences, a column of the table at a time in the bits of whole numbers.

Neighbours in the table of edit distances differ by -1, 0 or 1, so a column is two whole
numbers with a bit for each item of the reference, and the next column follows from it
by a few additions and shifts. Two sequences of n items cost n^2 / 64 steps of a machine
word, whatever their distance.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterator, Sequence

#: Items that occur more often have their bits made once.
_OFTEN = 64


class _Places:
    """For each item of a sequence, its places as bits."""

    def __init__(self, items: Sequence[Hashable]):
        self.places: dict[Hashable, list[int]] = {}
        for i, x in enumerate(items):
            self.places.setdefault(x, []).append(i)
        self.size, self.made = len(items), {}

    def __getitem__(self, item: Hashable) -> int:
        if item in self.made:
            return self.made[item]
        own = self.places.get(item, ())
        if len(own) <= _OFTEN:
            out = 0
            for i in own:
                out |= 1 << i
            return out
        marks = bytearray(self.size // 8 + 1)
        for i in own:
            marks[i >> 3] |= 1 << (i & 7)
        self.made[item] = int.from_bytes(marks, "little")
        return self.made[item]


def columns(reference: Sequence[Hashable], hypothesis: Sequence[Hashable]) -> Iterator[tuple[int, int, int]]:
    """For each item of ``hypothesis``: bits of where the table equals its upper left neighbour, bits of where it is above its upper neighbour by one, and the last row's change."""
    places, n = _Places(reference), len(reference)
    every, last = (1 << n) - 1, n - 1
    up, down = every, 0
    for item in hypothesis:
        same = places[item]
        level = ((((same & up) + up) ^ up) | same | down) & every
        right, left = down | (every ^ (level | up)), level & up
        change = (right >> last & 1) - (left >> last & 1) if n else 1
        right, left = (right << 1 | 1) & every, left << 1 & every
        up, down = left | (every ^ (level | right)), level & right
        yield level, up, change


def distance(reference: Sequence[Hashable], hypothesis: Sequence[Hashable]) -> int:
    """Least insertions, deletions and substitutions between two sequences."""
    start, ends = 0, (len(reference), len(hypothesis))
    while start < min(ends) and reference[start] == hypothesis[start]:
        start += 1
    a, b = ends
    while min(a, b) > start and reference[a - 1] == hypothesis[b - 1]:
        a, b = a - 1, b - 1
    # what only leaves items out, or only puts some in, costs no more than the lengths differ by; one walk over the longer one says so
    short, rest = sorted((reference[start:a], hypothesis[start:b]), key=len)
    left = iter(rest)
    if all(item in left for item in short):
        return len(rest) - len(short)
    return a - start + sum(change for _, _, change in columns(reference[start:a], hypothesis[start:b]))


def steps(reference: Sequence[Hashable], hypothesis: Sequence[Hashable]) -> list[str]:
    """The canonical alignment of least edits, as one step after the other: equal, substitute, delete or insert.

    Seen from the end, items that are equal stand together; else a substitution is
    taken if it is on a cheapest way, else a deletion, else an insertion.
    """
    i, j = len(reference), len(hypothesis)
    equal = []
    while i and j and reference[i - 1] == hypothesis[j - 1]:
        equal.append("equal")
        i, j = i - 1, j - 1
    level, above = [], []
    for same, up, _ in columns(reference[:i], hypothesis[:j]):
        level.append(same)
        above.append(up)
    out = equal
    while i and j:
        if reference[i - 1] == hypothesis[j - 1]:
            out.append("equal")
            i, j = i - 1, j - 1
        elif not level[j - 1] >> (i - 1) & 1:
            out.append("substitute")
            i, j = i - 1, j - 1
        elif above[j - 1] >> (i - 1) & 1:
            out.append("delete")
            i -= 1
        else:
            out.append("insert")
            j -= 1
    return [*["delete"] * i, *["insert"] * j, *reversed(out)]

