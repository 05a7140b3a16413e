"""Long pairs of texts cut into short parts that belong together.

The cost of comparing two texts grows faster than their length. Both sides of a long
pair are cut at anchors: runs of words (or of characters where words have no spaces)
that either side holds exactly once. Anchors in the same order on both sides divide
the pair, so parts are compared independently and in linear time over all.

Defined results
---------------
* parts cover both texts in order, without gaps;
* a pair whose longer side has at most one and a half times ``limit`` characters is
  one part, as is one without a common anchor;
* parts are cut at the anchor nearest to every ``limit`` characters of the source.
"""

from __future__ import annotations

from bisect import bisect_left

import regex

from lectern.functions.classes import NO_SPACE, python_class

LIMIT = 300
#: Units of an anchor: words, and characters of scripts without spaces.
RUN = 3
_UNIT = regex.compile(rf"[{python_class(NO_SPACE)}]|[^\W{python_class(NO_SPACE)}]+")


def _grams(text: str) -> dict[tuple, int | None]:
    """Every run of units to its place, or None where it stands more than once."""
    units = [(m[0].casefold(), m.start()) for m in _UNIT.finditer(text)]
    words = [u for u, _ in units]
    out: dict[tuple, int | None] = {}
    for k in range(len(units) - RUN + 1):
        key = tuple(words[k : k + RUN])
        out[key] = None if key in out else units[k][1]
    return out


def anchors(a: str, b: str) -> list[tuple[int, int]]:
    """Places in both texts, in order on both sides, at which the same unique run begins:
    the longest increasing chain of the common ones."""
    left, right = _grams(a), _grams(b)
    common = sorted((x, right[g]) for g, x in left.items() if x is not None and right.get(g) is not None)
    ends: list[int] = []  # smallest last place of a chain of each length
    owner: list[int] = []
    back = [-1] * len(common)
    for k, (_, y) in enumerate(common):
        at = bisect_left(ends, y)
        if at == len(ends):
            ends.append(y)
            owner.append(k)
        else:
            ends[at], owner[at] = y, k
        back[k] = owner[at - 1] if at else -1
    chain, k = [], owner[-1] if owner else -1
    while k >= 0:
        chain.append(common[k])
        k = back[k]
    return chain[::-1]


def parts(a: str, b: str, limit: int = LIMIT) -> list[tuple[tuple[int, int], tuple[int, int]]]:
    """[((start, end) in a, (start, end) in b)]."""
    if limit <= 0 or max(len(a), len(b)) <= limit * 3 // 2 or a == b:
        return [((0, len(a)), (0, len(b)))]
    places = anchors(a, b)
    out, x, y, k = [], 0, 0, 0
    while len(a) - x > limit * 3 // 2 or len(b) - y > limit * 3 // 2:
        while k < len(places) and (places[k][0] <= x or places[k][1] <= y):
            k += 1
        if k == len(places):
            break
        # the last anchor within the limit on both sides, else the first beyond it
        j = k
        while j + 1 < len(places) and places[j + 1][0] - x <= limit and places[j + 1][1] - y <= limit:
            j += 1
        out.append(((x, places[j][0]), (y, places[j][1])))
        (x, y), k = places[j], j + 1
    return [*out, ((x, len(a)), (y, len(b)))]
