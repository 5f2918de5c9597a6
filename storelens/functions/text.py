"""Text cleaning for the staging layer, as SQL expressions."""

from __future__ import annotations


def trimmed(name: str) -> str:
    return f"trim({name}) as {name}"


def blank_to_null(name: str) -> str:
    return f"nullif(trim({name}), '') as {name}"


def lowered(name: str) -> str:
    return f"lower(trim({name})) as {name}"


def uppered(name: str) -> str:
    return f"upper(trim({name})) as {name}"


def full_name(first: str = "first_name", last: str = "last_name") -> str:
    """NULL when either part is NULL, hence || and not concat_ws."""
    return f"trim({first}) || ' ' || trim({last}) as full_name"
