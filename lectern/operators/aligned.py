"""Edits of a correction as marked text with the least context that makes them unique."""

from __future__ import annotations

import json

import regex

from lectern.functions import tokens as K
from lectern.functions.classes import GROUPS, NO_SPACE, python_class
from lectern.operators.guards import opcodes
from lectern.operators.pairing import parts

_DENSE = regex.compile(f"[{python_class(NO_SPACE)}{python_class(GROUPS['hangul'])}]")
_OPEN = set("([{<\"'“‘«‹「『《【〈（［｛")
WIDEN = {"punct": 6, "short_deletion": 10, "label": 12, "numeral": 10, "combine": 10}


def units(text: str) -> list[str]:
    out: list[str] = []
    for t in K.tokenize(text):
        out += list(t) if _DENSE.search(t) else [t]
    return out


def _render(parts: list[str], mark: tuple[int, int]) -> str:
    out, prev = "", ""
    for k, u in enumerate([*parts, None]):
        if k == mark[0]:
            gap = "" if not out or k >= len(parts) or not _space(prev, parts[k]) else " "
            out += gap + "<chg>"
        if k == mark[1]:
            out += "</chg>"
        if u is None:
            break
        if prev and _space(prev, u) and k != mark[0]:
            out += " "
        out += u
        prev = u
    return out


def _space(a: str, b: str) -> bool:
    if _DENSE.search(a[-1]) and _DENSE.search(b[0]):
        return False
    if K.is_punct(b) and b not in _OPEN or a in _OPEN:
        return False
    return True


def _index(units_: list[str]) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for k, u in enumerate(units_):
        out.setdefault(u, []).append(k)
    return out


def _needed(seq: list[str], index: dict[str, list[int]], start: int, end: int, left_most: int, right_most: int) -> list[int]:
    """For every number of units taken on the left, how many it takes on the right until
    seq[start:end] stands only once. Other places of the span are looked at once each:
    how far they agree on either side decides for all windows."""
    size = end - start
    if size:
        others = [p for p in index[seq[start]] if p != start and seq[p : p + size] == seq[start:end]]
    else:
        beside = [p + 1 for p in index[seq[start - 1]]] if left_most else []
        others = {*beside, *(index[seq[end]] if right_most else ())} - {start}
    worst = [0 if size == 0 else -1] + [-1] * left_most
    for p in others:
        left = right = 0
        while left < left_most and p - left > 0 and seq[p - left - 1] == seq[start - left - 1]:
            left += 1
        while right < right_most and p + size + right < len(seq) and seq[p + size + right] == seq[end + right]:
            right += 1
        worst[left] = max(worst[left], right)
    out, most = [0] * (left_most + 1), -1
    for left in range(left_most, -1, -1):
        most = max(most, worst[left])
        out[left] = most + 1
    return out


def _window(a, b, ia, ib, i1, i2, j1, j2) -> tuple[int, int]:
    """Shared units left and right that make both spans unique, fewest in all."""
    left_most = right_most = 0
    while left_most < min(i1, j1) and a[i1 - left_most - 1] == b[j1 - left_most - 1]:
        left_most += 1
    while right_most < min(len(a) - i2, len(b) - j2) and a[i2 + right_most] == b[j2 + right_most]:
        right_most += 1
    needs = zip(_needed(a, ia, i1, i2, left_most, right_most), _needed(b, ib, j1, j2, left_most, right_most))
    fits = [(left + max(x, y), left) for left, (x, y) in enumerate(needs) if max(x, y) <= right_most]
    if not fits:
        return left_most, right_most
    total, left = min(fits)
    return left, total - left


def _changes(source: str, target: str) -> tuple[list[str], list[str], list[tuple], int]:
    """Units of both texts, the blocks in which they differ, and how many are equal. Long
    texts are compared part by part."""
    a: list[str] = []
    b: list[str] = []
    found, same = [], 0
    for x, y in parts(source, target):
        left, right = units(source[slice(*x)]), units(target[slice(*y)])
        i, j = len(a), len(b)
        for tag, i1, i2, j1, j2 in opcodes(left, right) if left != right else [("equal", 0, len(left), 0, len(right))]:
            if tag == "equal":
                same += i2 - i1
            elif found and found[-1][1] == i + i1 and found[-1][3] == j + j1:
                found[-1] = (found[-1][0], i + i2, found[-1][2], j + j2)  # goes on across a cut
            else:
                found.append((i + i1, i + i2, j + j1, j + j2))
        a += left
        b += right
    return a, b, found, same


def _reach(old: list[str], new: list[str]) -> int:
    both = old + new
    reach = 0
    if both and all(K.is_punct(u) for u in both):
        reach = WIDEN["punct"]
    if old and not new and len(old) <= 4:
        reach = max(reach, WIDEN["short_deletion"])
    if any(":" in u or "：" in u for u in both) and any(K.label_like(u) for u in both):
        reach = max(reach, WIDEN["label"])
    if any(any(c.isdigit() for c in u) for u in both):
        reach = max(reach, WIDEN["numeral"])
    if old and new and "".join(old).casefold() == "".join(new).casefold() and len(old) != len(new):
        reach = max(reach, WIDEN["combine"])
    return reach


def edits(source: str, target: str) -> list[str]:
    if source == target:
        return []
    a, b, changes, same = _changes(source, target)
    if not changes:
        return []
    full = [f"[{_render(a, (0, len(a)))}] -> [{_render(b, (0, len(b)))}]"]
    if len(b) <= 2 and len(a) >= 8 and len(changes) >= 2 and 2 * same / (len(a) + len(b)) <= 0.15:
        return full
    ia, ib = _index(a), _index(b)
    out = []
    for i1, i2, j1, j2 in changes:
        left, right = _window(a, b, ia, ib, i1, i2, j1, j2)
        reach = _reach(a[i1:i2], b[j1:j2])
        while left < reach and left < min(i1, j1) and a[i1 - left - 1] == b[j1 - left - 1]:
            left += 1
        while right < reach and right < min(len(a) - i2, len(b) - j2) and a[i2 + right] == b[j2 + right]:
            right += 1
        x, y = a[i1 - left : i2 + right], b[j1 - left : j2 + right]
        before = _render(x, (left, left + i2 - i1)) if i2 > i1 else _render(x, (-1, -1))
        after = _render(y, (left, left + j2 - j1)) if j2 > j1 else _render(y, (-1, -1))
        out.append(f"[{before}] -> [{after}]")
    if len(out) == 1 and out[0].endswith("-> []") and target.strip():
        return full
    return out


def as_json(source: str, target: str) -> str:
    return json.dumps(edits(source, target), ensure_ascii=False)
