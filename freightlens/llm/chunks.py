"""Splitting a text where a byte-level tokenizer must also split it.

The pre-tokenizer pattern lets white space start a token only as one leading
space, or as a run of its own. So where a single space has other characters on
both sides, a token ends before it, and what lies between two such places can be
encoded by itself. Most of these pieces recur, and a bounded memory of them
replaces most of the encoding.
"""

from __future__ import annotations

import re
from collections.abc import Callable

#: White space other than the space and the line feed; a superset of the pattern's \s.
OTHER_SPACE = (
    "\t\r\x0b\x0c\x1c\x1d\x1e\x1f",
    "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B))),
)
_BETWEEN = re.compile(r"(?<=\S)(?= \S)")

#: Pieces longer than this are not remembered.
LONGEST = 48


def parts(text: str) -> list[str]:
    """The text cut at single spaces, which are left out, into what can be encoded one by one.

    So " ".join of the parts is the text, and each but the first is to be
    encoded with a space before it.
    """
    odd = (
        "  " in text
        or " \n" in text
        or "\n " in text
        or any(c in text for c in OTHER_SPACE[0])
        or (not text.isascii() and any(c in text for c in OTHER_SPACE[1]))
    )
    if odd:
        first, *rest = _BETWEEN.split(text)
        return [first] + [x[1:] for x in rest]
    return text.split(" ")


class Memory(dict):
    """piece → encoded piece; ``encode`` gives those not yet known.

    At most twice ``size`` pieces are remembered: when ``size`` new ones have
    come, those not used since the last such moment are forgotten.
    """

    def __init__(self, encode: Callable[[str], object] | None, size: int = 400_000) -> None:
        super().__init__()
        self.encode, self.size = encode, size
        self.old: dict = {}

    def __missing__(self, piece: str) -> object:
        found = self.old.get(piece)
        return self.store(piece, self.encode(piece) if found is None else found)

    def store(self, piece: str, found: object) -> object:
        if len(piece) <= LONGEST:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[piece] = found
        return found
