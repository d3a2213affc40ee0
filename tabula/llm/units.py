"""Texts cut at white space into units that a tokenizer treats independently, and a bounded cache for them."""

from __future__ import annotations

from collections.abc import Callable, Iterable

# White space of the Unicode standard besides space and line feed; fixed values.
OTHER_SPACES = (
    "\t\x0b\x0c\r\x85\xa0            "
    "    　")
# Characters that Python takes for white space and the Unicode standard does not; fixed values.
SEPARATORS = "\x1c\x1d\x1e\x1f"


class Cache:
    """A memo of at most two generations of ``limit`` entries; the older one goes when the younger is full.

    Words of a text follow a steep law, so that even a small memo answers nearly all look-ups. An
    entry that is still in use moves to the younger generation; nothing depends on what is kept.
    """

    def __init__(self, make: Callable[[list], Iterable], limit: int):
        self.make, self.limit = make, limit
        self.young: dict = {}
        self.old: dict = {}

    def all(self, keys: list) -> list:
        """The values of ``keys``; those unknown are made together."""
        found = list(map(self.young.get, keys))
        if None not in found:
            return found
        if len(self.young) >= self.limit:
            self.old, self.young = self.young, {}
        gaps, at = [], -1
        for _ in range(found.count(None)):
            at = found.index(None, at + 1)
            gaps.append(at)
        made, fresh = {}, []
        for key in {keys[i] for i in gaps}:
            value = self.old.get(key)
            if value is None:
                fresh.append(key)
            else:
                made[key] = value
        made.update(zip(fresh, self.make(fresh) if fresh else ()))
        self.young.update(made)
        for i in gaps:
            found[i] = made[keys[i]]
        return found
