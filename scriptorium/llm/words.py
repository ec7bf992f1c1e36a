"""Words of long texts in blocks: what several operators share."""

from __future__ import annotations

from collections.abc import Iterator

#: What separates words: space and \x09-\x0D, the same that ``bytes.split`` takes.
SPACES = b" \t\n\v\f\r"
BLOCK = 1 << 20


def word_blocks(data: bytes, carry: int, block: int = BLOCK) -> Iterator[list[bytes]]:
    """The words of ``data`` in lists; each but the first begins with the last ``carry`` words before it.

    A list is of about ``block`` bytes, longer only where a single word is.
    """
    at, kept = 0, []
    while at < len(data):
        end = at + block
        if end < len(data):
            # forward to the end of the word that the block would cut
            while end < len(data) and data[end] not in SPACES:
                end += 1
        words = kept + data[at:end].split()
        at = end
        if len(words) > len(kept) or at >= len(data):
            yield words
            kept = words[-carry:] if carry else []
