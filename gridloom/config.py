"""Settings, as values; ``from_settings`` takes them from a mapping, such as the environment."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Config:
    max_rows: int = 10_000
    max_columns: int = 1_000
    max_headers: int = 200
    min_links: int = 3
    literal_share: float = 0.60
    max_words: float = 6.0
    coverage_base: float = 0.6
    generic_types: int = 5_000
    acronym_percent: int = 70
    typo_percent: int = 70
    number_percent: int = 50
    alias_percent: int = 30
    with_context: bool = False
    acronyms: bool = True
    typos: bool = True
    numbers: bool = True
    aliases: bool = True
    seed: int = 1

    @classmethod
    def from_settings(cls, settings: Mapping[str, str]) -> Config:
        """What is missing keeps its value. A switch is on unless its text is empty, 0, false or no."""
        found: dict = {}
        for name, field in _NUMBERS.items():
            if str(settings.get(name, "")).strip():
                found[field] = int(settings[name])
        for name, field in _SWITCHES.items():
            if name in settings:
                found[field] = str(settings[name]).strip().lower() not in ("", "0", "false", "no")
        return replace(cls(), **found)


# Names of settings.
_NUMBERS = {
    "MAXLINES": "max_rows", "MAXCOLUMNS": "max_columns", "MAXHEADERS": "max_headers",
    "ADDACRONIMSPERCENT": "acronym_percent", "ADDALIASESPERCENT": "alias_percent", "ADDTYPOSPERCENT": "typo_percent", "APPROXIMATENUMBERSPERCENT": "number_percent",
}
_SWITCHES = {"ADDACRONIMS": "acronyms", "ADDALIASES": "aliases", "ADDTYPOS": "typos", "APPROXIMATENUMBERS": "numbers", "ENABLE_EXTERNAL_CONTEXT": "with_context"}

DEFAULT = Config()
