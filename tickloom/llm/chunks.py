"""Texts as runs between blanks, and what an encoder makes of each distinct run, kept within a bound."""

from __future__ import annotations

import re
from collections.abc import Callable

#: Distinct runs that one worker remembers; beyond it starts afresh.
KEPT = 250_000
#: Longer runs are encoded each time and never kept.
LONGEST = 80


class RunCache(dict):
    """run -> value. ``fill(runs)`` gives the values of runs that aren't known yet, many at once."""

    def __init__(self, fill: Callable[[list[str]], list], kept: int = KEPT):
        super().__init__()
        self.fill, self.kept = fill, kept

    def ready(self, runs: set[str]) -> None:
        """Make all ``runs`` known. Afterwards look them up before the next call."""
        if len(self) > self.kept:
            self.clear()
        new = [r for r in runs if r not in self]
        if new:
            self.update(zip(new, self.fill(new), strict=True))

    def tidy(self) -> None:
        """Forget long runs."""
        for r in [r for r in self if len(r) > LONGEST]:
            del self[r]


#: Characters that are lower-cased one by one and composed already: up to U+024F, without U+0130.
LATIN = re.compile("[\x00-\u012f\u0131-\u024f]*")
#: Marks that follow words.
MARKS = ".,!?#$%&*|:;"


def lowered(text: str) -> str:
    """The text in lower case where that can't change how it is split; special strings keep their case."""
    return text.lower() if "<|" not in text and (text.isascii() or LATIN.fullmatch(text)) else text


def word_and_marks(run: str) -> tuple[str, str] | None:
    """A lower-case Latin word and the marks after it, if that is all of the run."""
    word = run.rstrip(MARKS)
    if len(run) <= LONGEST and word.isalpha() and word.islower() and (word.isascii() or LATIN.fullmatch(word)):
        return word, run[len(word) :]
    return None


def blank_runs(text: str) -> list[str]:
    """Pieces between single spaces and line feeds; other white space stays inside a piece."""
    return text.replace("\n", " ").split(" ")
