"""What is refused, and how: one error type, guards over DataFrames, and checks of identifiers and settings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARTIFACT_VERSION = "2.0"
EVENT_VERSION = "1.0"


class ContractError(ValueError):
    """Input or state that breaks a stated rule."""


def refuse_rows(bad: DataFrame, message: str) -> None:
    """Raise if there is any row; only whether there is one comes back."""
    if not bad.isEmpty():
        raise ContractError(message)


def checked(value: Column, condition: Column, message: str) -> Column:
    """value where the condition holds; elsewhere (null too) the query fails with the message when it runs."""
    return F.when(F.coalesce(condition, F.lit(False)), value).otherwise(F.raise_error(F.lit(message)))


def safe_identifier(value: str, name: str) -> str:
    """An identifier that can stand as one segment of a path."""
    if not isinstance(value, str) or value in ("", ".", "..") or "/" in value or "\0" in value:
        raise ContractError(f"{name} must be one safe path segment")
    return value


def review_cap(value: int | str) -> int | None:
    """A positive whole number, or None for "all"."""
    text = str(value).strip() if not isinstance(value, bool) else ""
    if text == "all":
        return None
    if not re.fullmatch(r"[0-9]+", text) or int(text) < 1:
        raise ContractError("review cap must be a positive integer or 'all'")
    return int(text)
