"""Words of UTF-8 texts, cut at the six ASCII white-space characters, a bounded piece at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator

#: Bytes of a text that are split at once; a longer text is cut at white space.
PIECE_BYTES = 1 << 20

_space = re.compile(rb"[ \t-\r]").search


def word_lists(text: bytes | None, piece_bytes: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of about ``piece_bytes`` bytes.

    ``bytes.split`` cuts at exactly these characters: space, tab, line feed, vertical tab,
    form feed and carriage return.
    """
    if not text:
        return
    at = 0
    while len(text) - at > piece_bytes and (cut := _space(text, at + piece_bytes)):
        yield text[at:cut.start()].split()
        at = cut.end()
    yield (text[at:] if at else text).split()
