"""Words of whole texts: runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa

#: ``bytes.lower`` changes A-Z alone; every byte of a character beyond ASCII is at least 0x80.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

#: Bytes of text that are taken together, and documents.
BLOCK_BYTES, BLOCK_TEXTS = 1 << 20, 4096


def words_of(text: bytes | None) -> list[bytes]:
    return _WORD.findall(text.lower()) if text else []


def blocks(column: pa.Array) -> Iterator[tuple[slice, list[bytes | None]]]:
    """The texts of a column as UTF-8, in slices of about BLOCK_BYTES (a longer text alone)."""
    texts = column.cast(pa.binary())
    at = 0
    while at < len(texts):
        end, size, block = at, 0, []
        while end < len(texts) and len(block) < BLOCK_TEXTS and (not block or size < BLOCK_BYTES):
            block.append(texts[end].as_py())
            size += len(block[-1] or b"")
            end += 1
        yield slice(at, end), block
        at = end
