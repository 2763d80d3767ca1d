"""Cuts texts where every byte-level tokenizer of this family cuts them, so that pieces can be cached."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

#: Where the quick cut would be wrong: white space beside white space or before a mark, a mark after a mark, the cut sign itself.
CROWDED = re.compile(r"\s[\s.,]|[^\w\s][.,]|_[.,]|\x00")
#: Between any two characters of which the first is no white space, and a single space before a further word.
BORDER = re.compile(r"(?<=\S)(?= \S)")


def pieces(text: str) -> list[str]:
    """Parts that join to the text, cut at spaces, line ends, full stops and commas where no pre-token can go on.

    The pre-tokenizer's pattern lets a space lead a word but never end one, takes a lone line end by itself and parts letters and
    digits from marks, so no match crosses such a border. Texts in which these stand closer together are cut at spaces only.
    """
    if not text:
        return []
    if CROWDED.search(text) or text[0] in " .,\n" or text[-1] == " ":
        return BORDER.split(text)
    cut = text.replace(".", "\0.").replace(",", "\0,").replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
    return cut if cut[-1] else cut[:-1]


class PieceCache:
    """Remembers what ``encode`` makes of a piece; forgets all of it beyond ``limit`` pieces."""

    def __init__(self, encode: Callable[[list[str]], Iterable], limit: int = 600_000) -> None:
        self.encode, self.limit, self.known = encode, limit, {}

    def __call__(self, texts: list[str]) -> list[list]:
        """For each text what its pieces become, in order."""
        if len(self.known) > self.limit:
            self.known.clear()
        cut = [pieces(x or "") for x in texts]
        out = [list(map(self.known.get, x)) for x in cut]
        short = [i for i, x in enumerate(out) if None in x]
        if short:
            new = list({p for i in short for p, v in zip(cut[i], out[i], strict=True) if v is None})
            self.known.update(zip(new, self.encode(new), strict=True))
            for i in short:
                out[i] = list(map(self.known.__getitem__, cut[i]))
        return out
