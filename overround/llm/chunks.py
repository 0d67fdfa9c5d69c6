"""Cuts of texts that no token crosses, and a table of bounded size for what was found out about such chunks."""

from __future__ import annotations

import re
from collections.abc import Collection

_SPACED = re.compile(r" [^\S ]")
_CUT = re.compile(r"(?<=[^ ]) (?=\S)")


def chunks(text: str) -> list[str]:
    """Parts of ``text`` that, joined by one space each, give it again.

    A cut lies at a space between a character that is no space and one that is no white space. Byte-level vocabularies
    begin a run of their pattern there, and vocabularies of pieces in which the space mark only leads never merge
    across it, so the tokens of a text are those of its chunks (each but the first with its leading space).
    """
    parts = text.split(" ")
    return _CUT.split(text) if "" in parts or _SPACED.search(text) else parts


class Remembered(dict):
    """A dictionary that stays below ``limit`` bytes or so, and keeps what is asked for again.

    When it would grow past half the limit, only the keys in use stay; the others are set aside until the next time,
    and come back where they are asked for.
    """

    #: Bytes of an entry besides the contents of key and value.
    ENTRY = 200

    def __init__(self, limit: int, per_byte: int = 1) -> None:
        """Values take ``per_byte`` bytes for each byte or character of their keys."""
        super().__init__()
        self.limit, self.per_byte, self.size, self.aside = limit, per_byte, 0, {}

    def _cost(self, keys: Collection[str | bytes]) -> int:
        return self.ENTRY * len(keys) + (1 + self.per_byte) * sum(map(len, keys))

    def missing(self, wanted: set) -> set:
        """Which of the wanted keys the caller has to add now; the others are there."""
        new = wanted - self.keys()
        cost = self._cost(new)
        if self and self.size + cost > self.limit // 2:
            kept = {k: self[k] for k in wanted if k in self}
            self.aside = dict(self)
            self.clear()
            self.update(kept)
            self.size = self._cost(kept)
        self.size += cost
        back = {k: self.aside[k] for k in new & self.aside.keys()}
        self.update(back)
        return new - back.keys()

    def forget(self) -> None:
        """Let all entries go, also those set aside."""
        self.clear()
        self.size, self.aside = 0, {}
