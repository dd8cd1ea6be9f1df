"""Run settings. Passed in as an argument; nothing here is read from globals or the clock."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Choices that shape the models.

    timezone       zone in which instants become wall-clock times
    load_interval  minutes between loads; None or 0 keeps the sentinel row's own title
    categorise     switch for the deep/shallow work label
    deep_tags      tags that mark deep work
    shallow_tags   tags that mark shallow work
    scope_word     lower-case word that puts a project into its own scope bucket; None puts all into 'rest'
    """

    timezone: str = "UTC"
    load_interval: int | None = 15
    categorise: bool = False
    deep_tags: tuple[str, ...] = ()
    shallow_tags: tuple[str, ...] = ()
    scope_word: str | None = None
