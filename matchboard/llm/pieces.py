"""Texts as chunks that a byte-level tokenizer encodes independently.

The GPT-style pattern never matches across a step from a non-space character to a space,
so a text cut at these steps is a sequence of chunks whose tokens do not depend on each
other. A single line break between non-space characters is a match of its own. A run of
white space is never cut, as it is matched by looking ahead.

What a chunk encodes to is remembered per worker, up to ``LIMIT`` chunks; then they
become the older half of the memory, from which chunks that are met again are taken
over, and the half before it is dropped. So it stays bounded.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

LIMIT = 150_000
LONG = 64  # longer chunks are encoded each time

_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace()]
_OTHERS = [c for c in _SPACES if c not in " \n"]
_ASCII_OTHERS = [c for c in _OTHERS if c.isascii()]
# white space in runs, around a space or a line break
_RUNS = ["  ", " \n", "\n ", "\n\n"]
_RARE_RUNS = [run for c in _OTHERS for run in (c + " ", c + "\n", "\n" + c)]
_STEP = re.compile(r"(?<=\S)(?= )")
_CUT = "\0"


def chunks(text: str) -> list[str]:
    if not text:
        return []
    runs = list(_RUNS)
    if any(c in text for c in (_ASCII_OTHERS if text.isascii() else _OTHERS)):
        runs += _RARE_RUNS
    if any(run in text for run in runs):
        return _STEP.split(text)
    if _CUT in text:
        return _by_line(text)
    out = text.replace("\n", "\0\n\0").replace(" ", "\0 ").split(_CUT)
    if not out[0]:
        del out[0]
    if not out[-1]:
        out.pop()
    return out


def _by_line(text: str) -> list[str]:
    """The same for a text that holds the mark between chunks."""
    out: list[str] = []
    for line in text.split("\n"):
        parts = line.split(" ")
        if parts[0]:
            out.append(parts[0])
        out += [" " + part for part in parts[1:]]
        out.append("\n")
    out.pop()
    return out


@contextmanager
def collector_paused() -> Iterator[None]:
    """Strings in lists make no cycles, but the collector would walk through them again and again."""
    collects = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if collects:
            gc.enable()


class Memory[T]:
    """Remembers ``encode`` of chunks; new chunks of many texts are encoded together."""

    def __init__(self, encode: Callable[[list], Iterable[T]], limit: int | None = None):
        self.encode = encode
        self.limit = limit or LIMIT
        self.known: dict[str | bytes, T] = {}
        self.older: dict[str | bytes, T] = {}

    def look_up(self, texts: list[list]) -> dict[str | bytes, T]:
        """A mapping that holds every chunk of the texts."""
        if len(self.known) > self.limit:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        # Looked up one by one: a set less the keys of a mapping would go through all keys.
        distinct = set().union(*texts)
        new = [chunk for chunk in distinct if chunk not in known]
        if not new:
            return known
        fresh = []
        for chunk in new:
            if chunk in older:
                known[chunk] = older[chunk]
            else:
                fresh.append(chunk)
        found = dict(zip(fresh, self.encode(fresh), strict=True))
        long = {k for k in fresh if len(k) > LONG}
        if not long:
            known.update(found)
            return known
        known.update({k: v for k, v in found.items() if k not in long})
        return {c: found[c] if c in long else known[c] for c in distinct}
