"""Words of a text, as every operator of this package cuts them."""

from __future__ import annotations

WHITE_SPACE = " \t\n\x0b\x0c\r"


def encoded(text: str | None) -> bytes:
    """UTF-8 of a text; null is empty, and a lone surrogate keeps its three bytes."""
    return text.encode("utf-8", "surrogatepass") if text else b""


def words_of(raw: bytes) -> list[bytes]:
    """Runs of `[^\\x20\\x09-\\x0D]+`.

    `bytes.split` cuts at exactly these six characters, and no byte of a longer UTF-8
    sequence looks like one of them.
    """
    return raw.split()
