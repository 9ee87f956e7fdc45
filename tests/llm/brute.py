"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import re

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def alnum_words(text):
    return ALNUM.findall((text or "").translate(LOWER))


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


class Groups:
    def __init__(self, items):
        self.parent = {x: x for x in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, start=1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, start=1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def windows(items, size=13):
    """Window -> ids of the items that have it."""
    found = {}
    for item_id, text in items:
        w = alnum_words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            found.setdefault(tuple(w[i : i + size]), set()).add(item_id)
    return found


def hits(text, of_windows):
    """Hit word positions and hit items of a text."""
    w, positions, items = alnum_words(text), set(), set()
    for size in {len(x) for x in of_windows}:
        for i in range(len(w) - size + 1):
            found = of_windows.get(tuple(w[i : i + size]))
            if found:
                positions |= set(range(i, i + size))
                items |= found
    return len(w), positions, items
