"""Settings that come as text: missing values, flags and numbers."""

from __future__ import annotations

import dataclasses
import types
import typing

# How settings are written.
MISSING = {"", "na", "null", "none", "nan"}
TRUE = {"true", "t", "yes", "y", "1", "on"}
FALSE = {"false", "f", "no", "n", "0", "off"}


def present(text: str | None) -> str | None:
    """The text, trimmed; None for the ways to write a missing value."""
    text = None if text is None else text.strip()
    return None if text is None or text.lower() in MISSING else text


def flag(text: str | None, default: bool = False) -> bool:
    """A boolean by any of its spellings; the default if it is missing, an error if it is something else."""
    word = present(text)
    if word is None:
        return default
    if word.lower() not in TRUE | FALSE:
        raise ValueError(f"neither true nor false: {text}")
    return word.lower() in TRUE


def sql_text(text: str) -> str:
    """Text as a literal of Spark SQL, for statements that take no parameters."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def apply(defaults, given: dict[str, str | None]):
    """The dataclass with the settings given as text, each by its field's type; unknown names are an error."""
    kinds = typing.get_type_hints(type(defaults))
    unknown = sorted(set(given) - set(kinds))
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    return dataclasses.replace(defaults, **{name: _typed(name, text, kinds[name]) for name, text in given.items()})


def _typed(name: str, text: str | None, kind):
    options = typing.get_args(kind) if isinstance(kind, types.UnionType) else (kind,)
    if kind is not str and present(text) is None and type(None) in options:
        return None
    kind = next(k for k in options if k is not type(None))
    if kind is bool:
        return flag(text)
    word = present(text)
    if kind is str:
        # Such as the choice 'none'.
        return None if word is None and type(None) in options else (text or "").strip()
    if word is None:
        raise ValueError(f"{name} needs a value")
    return kind(word)
