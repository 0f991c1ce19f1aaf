"""Cuts texts at places where a tokenizer's result cannot change, and keeps results of pieces.

A piece is what stands between two safe boundaries. Pieces repeat (a corpus has far fewer distinct
words than words), so a bounded table per Python worker maps each piece to its ids or its count.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

#: White space as the tokenizers' patterns understand it. Python's own \s also has U+001C to U+001F.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_SPACES = re.compile(f"[{SPACE}]+")
_CONTROL = re.compile("[\x1c-\x1f]")
_RUN = re.compile(r"\s\s|^\s|\s$")
_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
LONG_SPACE = re.compile(r"\s{5000}")


def slabs(text: str, size: int) -> Iterator[str]:
    """Cuts a long text before a single space between two non-space characters, at the first such place past each `size` characters."""
    start = 0
    while len(text) - start > size:
        m = _LONE_SPACE.search(text, start + size)
        if m is None:
            break
        yield text[start : m.start()]
        start = m.start()
    yield text[start:] if start else text


def words(text: str) -> list[str]:
    """Pieces for tokenizers that drop white space."""
    if _CONTROL.search(text):
        return [w for w in _SPACES.split(text) if w]
    return text.split()


def spaced(text: str) -> list[str]:
    """Pieces for byte-level tokenizers whose pattern takes one space in front of a word. A lone space opens
    a piece and a lone line feed is one, if neither has white space beside it. Joined, the pieces are the text."""
    if _RUN.search(text):
        parts = _LONE_SPACE.split(text)
        return [parts[0], *(" " + p for p in parts[1:])] if parts[0] else [" " + p for p in parts[1:]]
    out: list[str] = []
    for k, line in enumerate(text.split("\n")):
        if k:
            out.append("\n")
        first, *rest = line.split(" ")
        if first:
            out.append(first)
        out += map(" ".__add__, rest)
    return out


class PieceTable[V]:
    """piece -> value for at most `limit` pieces of `chars` characters together; then it starts anew, so memory stays constant. Pieces beyond LONGEST are never kept.

    Spark keeps its Python workers from one operator to the next, so only the table in use holds pieces: another one gives up its own.
    """

    LONGEST = 256
    in_use: PieceTable | None = None

    def __init__(self, compute: Callable[[list[str]], list[V]], limit: int = 500_000, chars: int = 16_000_000, batch_bytes: int = 1 << 18) -> None:
        self.compute, self.limit, self.chars, self.batch_bytes, self.known, self.size = compute, limit, chars, batch_bytes, {}, 0

    def clear(self) -> None:
        self.known.clear()
        self.size = 0

    def values(self, pieces: list[str]) -> list[V]:
        if PieceTable.in_use is not self:
            if PieceTable.in_use is not None:
                PieceTable.in_use.clear()
            PieceTable.in_use = self
        known = self.known
        found = list(map(known.get, pieces))
        if None in found:
            new = list({p for p, v in zip(pieces, found, strict=True) if v is None})
            fresh: dict[str, V] = {}
            for batch in balanced(new, self.batch_bytes):
                fresh.update(zip(batch, self.compute(batch), strict=True))
            found = [fresh[p] if v is None else v for p, v in zip(pieces, found, strict=True)]
            kept = [p for p in new if len(p) <= self.LONGEST]
            size = sum(map(len, kept))
            if len(known) + len(kept) > self.limit or self.size + size > self.chars:
                self.clear()
            known.update((p, fresh[p]) for p in kept)
            self.size += size
        return found


def n_bytes(piece: str | bytes) -> int:
    return len(piece) if isinstance(piece, bytes) or piece.isascii() else len(piece.encode("utf-8", "surrogatepass"))


def balanced(pieces: list, most: int) -> Iterator[list]:
    """Batches of about equal bytes, as few as hold `most` bytes or a little more each; a longer piece is a batch with what stands before it."""
    sizes = list(map(n_bytes, pieces))
    total = sum(sizes)
    share = total / max(1, -(-total // most))
    start = done = 0
    for i, size in enumerate(sizes, 1):
        done += size
        if done >= share:
            yield pieces[start:i]
            start, done = i, 0
    if start < len(pieces):
        yield pieces[start:]


def library(path: str) -> object:
    """A tokenizer of the tokenizers library without truncation or padding, on one thread (Spark has the others)."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t
