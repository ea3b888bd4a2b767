"""Identifiers and paths."""

from __future__ import annotations

import re

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def identifier(value: str, what: str = "identifier") -> str:
    if not _NAME.fullmatch(value or ""):
        raise ValueError(f"{what} is not a plain name: {value!r}")
    return value


def table_name(*parts: str) -> str:
    """Quoted schema.table or catalog.schema.table; every part is a plain name."""
    if not 1 <= len(parts) <= 3:
        raise ValueError("a table has one to three parts")
    return ".".join(f"`{identifier(p)}`" for p in parts)


def quote_table(dotted: str) -> str:
    return table_name(*dotted.split("."))


def join_path(root: str, *parts: str) -> str:
    """Join with single slashes; a scheme such as s3:// is kept."""
    scheme, mark, rest = root.partition("://")
    head = rest if mark else root
    body = "/".join([head.rstrip("/"), *[p.strip("/") for p in parts if p.strip("/")]])
    return f"{scheme}://{body}" if mark else body
