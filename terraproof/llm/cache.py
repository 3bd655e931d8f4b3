"""A bounded memory of results for worker processes."""

from __future__ import annotations

from collections.abc import Hashable


class Recent:
    """Two generations of a dict: when the young one is full it becomes the old one, and what is used again moves over.

    ``young`` is open to ``map(recent.young.get, keys)``, the fast way for many keys; ``old_or_none`` is for the rest.
    """

    __slots__ = ("young", "old", "limit")

    def __init__(self, limit: int):
        self.young: dict = {}
        self.old: dict = {}
        self.limit = limit

    def old_or_none(self, key: Hashable) -> object | None:
        value = self.old.get(key)
        if value is not None:
            self.young[key] = value
        return value

    def put(self, key: Hashable, value: object) -> None:
        self.young[key] = value

    def turn(self) -> None:
        """Called between batches of keys, so that a caller's look-ups see one young dict."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet as a translation table over Latin-1 characters.

    Visible bytes stand for themselves; the others are counted up from 256.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(256 + n) for n, b in enumerate(hidden)}
