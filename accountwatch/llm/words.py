"""Words of whole texts as UTF-8 bytes, cut with one table look-up a byte.

Only A to Z are lower-cased and only ASCII bytes separate words, so that bytes give the
same words as characters do.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

#: Never part of a UTF-8 text.
MARK = b"\xff"


def byte_table(blank: Iterable[int] = (), mark: Iterable[int] = ()) -> bytes:
    """A table that lower-cases A to Z, turns ``blank`` into spaces and ``mark`` into the mark."""
    table = bytearray(range(256))
    for byte in range(ord("A"), ord("Z") + 1):
        table[byte] += 32
    for byte in blank:
        table[byte] = 32
    for byte in mark:
        table[byte] = MARK[0]
    return bytes(table)


#: Runs of non-blank characters, [^\x20\x09-\x0D]+.
PLAIN = byte_table()
#: Runs of letters, digits and characters beyond ASCII, [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+.
TERMS = byte_table(blank=[b for b in range(128) if not chr(b).isalnum()])
#: Runs without blanks or tabs, [^\x20\x09]+, in pieces that end at [.,;:!?\x0A-\x0D].
PIECES = byte_table(mark=b".,;:!?\n\x0b\x0c\r")


def words(text: str | None, table: bytes) -> list[bytes]:
    return text.encode("utf-8").translate(table).split() if text else []


def marked_words(text: str | None, table: bytes = PIECES) -> list[bytes]:
    """Words with a mark between pieces and one at the end."""
    if not text:
        return [MARK]
    spaced = text.encode("utf-8").translate(table).replace(MARK, b" " + MARK + b" ").split()
    spaced.append(MARK)
    return spaced


def numbering() -> defaultdict:
    """A dictionary that numbers its keys from 0 as they come."""
    numbers: defaultdict = defaultdict()
    numbers.default_factory = numbers.__len__
    return numbers


def text_slices(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of about ``most`` in size, one row at least."""
    begin = total = end = 0
    for end, size in enumerate(sizes, 1):
        total += size
        if total >= most:
            yield begin, end
            begin, total = end, 0
    if begin < end:
        yield begin, end
