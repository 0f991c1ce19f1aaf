"""Byte-pair encoding as a bounded-lookahead streaming transducer, and decoding as a state machine.

A sequence of tokens is the BPE result of a string exactly if each token and each pair of neighbours
is the BPE result of its own string. Two neighbours are checked along their seam: the pair is
refused if some merge of a piece on the left edge with a piece on the right edge comes before the
merges that absorb these pieces. So the transducer goes from left to right, takes the longest token
that fits its left neighbour, and goes back where it gets stuck.

How far to the right can text change a token? A merge (u, v) depends on its right piece v, whose own
right pieces may be taken by earlier merges, and so on with ever earlier merges. The longest such
chain, in symbols, is the merge list's sufficient lookahead (`MergeList.lookahead`). Once that many
symbols (and one token) have been read past a token's end, the token is stable and is emitted; only the rest
stays in the buffer, so memory is constant however long a piece is.

Defined results: a null or empty text has no ids, and its decoded text is empty; repeated rows give
repeated results; extra columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from . import chunks
from .common import id_and_text

END = "\0"  # stands for the end-of-word suffix behind the last symbol of a word; no byte maps to it
NEVER = 1 << 60
#: Characters of a word that are turned into symbols at a time, and ids of a long piece that leave together.
STEP = 4096


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable Latin-1 bytes stand for themselves, the others are numbered from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else spare))
        spare += b not in plain
    return out


class MergeList:
    """A byte-level BPE vocabulary with its merges, checked for what the transducer needs."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        self.suffix = model.get("end_of_word_suffix") or ""
        joined_decoder = spec.get("decoder") is None
        vocab: dict[str, int] = model["vocab"]
        self.text_of = {i: t for t, i in vocab.items()}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of |= {i: t for t, i in self.specials.items()}
        self.joined_decoder = joined_decoder

        self.ids = {self._symbols(t): i for t, i in vocab.items()}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made_at: dict[int, int] = {}
        self.length = {i: len(t) - t.endswith(END) for t, i in self.ids.items()}
        for r, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            a, b, ab = vocab[left], vocab[right], vocab[left + right]
            self.rank.setdefault(a << 24 | b, r)
            if ab not in self.parts:
                self.parts[ab], self.made_at[ab] = (a, b), r
        self.longest = max(map(len, self.ids))
        self._left: dict[int, list[tuple[int, int]]] = {}
        self._right: dict[int, list[tuple[int, int]]] = {}
        self._fits: dict[int, bool] = {}
        for ab in sorted(self.made_at, key=self.made_at.__getitem__):  # tokens that no string gives are never emitted
            a, b = self.parts[ab]
            if not self._seam(a, b, self.made_at[ab]):
                self.ids.pop(self._symbols(self.text_of[ab]), None)
        self.lookahead = self._sufficient_lookahead()

    def _symbols(self, token: str) -> str:
        return token[: -len(self.suffix)] + END if self.suffix and token.endswith(self.suffix) else token

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The pieces that stand at one edge of a token while it is built, each with the rank of the merge that absorbs it."""
        memo = self._right if side else self._left
        out = memo.get(token)
        if out is None:
            out, until, t = [], NEVER, token
            while True:
                out.append((t, until))
                if t not in self.parts:
                    break
                until, t = self.made_at[t], self.parts[t][side]
            memo[token] = out
        return out

    def _seam(self, a: int, b: int, before: int = NEVER) -> bool:
        rank = self.rank
        right = self._spine(b, 0)
        for x, until_x in self._spine(a, 1):
            for y, until_y in right:
                r = rank.get(x << 24 | y)
                if r is not None and r < before and r < until_x and r <= until_y:
                    return False
        return True

    def fits(self, a: int, b: int) -> bool:
        key = a << 24 | b
        out = self._fits.get(key)
        if out is None:
            if len(self._fits) > 400_000:
                self._fits.clear()
            out = self._fits[key] = self._seam(a, b)
        return out

    def _sufficient_lookahead(self) -> int:
        """The longest chain of ever earlier merges, each of which takes a right-edge piece of the one before, in symbols."""
        ranks: dict[int, list[int]] = {}
        deepest: dict[int, list[int]] = {}
        most = 1
        for ab in sorted(self.made_at, key=self.made_at.__getitem__):
            a, b = self.parts[ab]
            r = self.made_at[ab]
            further = 0
            for q, until in self._spine(b, 1):
                if k := bisect_left(ranks.get(q, ()), min(until, r)):
                    further = max(further, deepest[q][k - 1])
            depth = self.length[b] + further
            ranks.setdefault(a, []).append(r)
            best = deepest.setdefault(a, [])
            best.append(max(depth, best[-1] if best else 0))
            most = max(most, depth)
        return most

    def tokens(self, symbols: str, before: int = -1) -> list[int]:
        """The ids of a whole string of symbols, whose left neighbour is the token `before`."""
        ids, fits, longest, n = self.ids, self.fits, self.longest, len(symbols)
        out: list[int] = []
        ends: list[int] = []
        dead: set[int] = set()
        at, last = 0, before
        end = min(n, longest)
        while True:
            t = None
            while end > at:
                t = ids.get(symbols[at:end])
                if t is not None and end not in dead and (last < 0 or fits(last, t)):
                    break
                end -= 1
            if end > at:
                out.append(t)
                ends.append(end)
                if end == n:
                    return out
                at, last = end, t
                end = min(n, at + longest)
            else:
                if not out:
                    raise ValueError("the vocabulary lacks a byte")
                dead.add(at)
                out.pop()
                ends.pop()
                end = at - 1
                at = ends[-1] if ends else 0
                last = out[-1] if out else before


class Transducer:
    """feed() takes symbols and gives the ids that have become stable; finish() gives the rest."""

    def __init__(self, merges: MergeList) -> None:
        self.merges = merges
        self.hold = merges.lookahead + merges.longest
        self.buffer, self.last = "", -1

    def feed(self, symbols: str) -> Iterator[int]:
        step = 4 * self.hold
        for k in range(0, len(symbols), step):
            self.buffer += symbols[k : k + step]
            if len(self.buffer) > 2 * self.hold:
                done, stable = 0, len(self.buffer) - self.hold
                for t in self.merges.tokens(self.buffer, self.last):
                    size = self.merges.length[t]
                    if done + size > stable:
                        break
                    done += size
                    self.last = t
                    yield t
                self.buffer = self.buffer[done:]

    def finish(self, suffix: bool) -> Iterator[int]:
        if self.buffer:
            yield from self.merges.tokens(self.buffer + (END if suffix else ""), self.last)
        self.buffer, self.last = "", -1


#: The pre-tokens of the lower-casing word vocabulary: a fixed pattern of its file.
WORD_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + chunks.SPACE + r"\p{L}\p{N}]+"


class Encoder:
    """Texts to ids for a lower-casing word vocabulary (NFC, white space dropped, end-of-word suffix)."""

    def __init__(self, merges: MergeList, limit: int = 400_000) -> None:
        self.merges = merges
        self.pieces = regex.compile(WORD_PIECES)
        self.letters = {b: c for b, c in enumerate(byte_letters())}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(merges.specials, key=len, reverse=True))) + ")") if merges.specials else None
        self.known = chunks.PieceTable(lambda batch: [self.piece(p) for p in batch], limit)
        self.limit, self.words = limit, {}
        self.stream = Transducer(merges)

    def word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            ids = array("I", self.transduce(word)).tobytes()
            if len(word) <= 64:
                if len(self.words) >= self.limit:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def transduce(self, word: str) -> Iterator[int]:
        """Ids of one word, each as soon as it is stable."""
        for k in range(0, len(word), STEP):
            part = word[k : k + STEP]
            if not (part.isascii() and part.isprintable()):
                part = part.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters)
            yield from self.stream.feed(part)
        yield from self.stream.finish(suffix=True)

    def parts(self, piece: str) -> Iterator[str | int]:
        """The words of a piece and the ids of special tokens in it."""
        for part in self.special.split(piece) if self.special and "<" in piece else (piece,):
            if part in self.merges.specials:
                yield self.merges.specials[part]
            elif part:
                yield from (m[0] for m in self.pieces.finditer(unicodedata.normalize("NFC", part).replace("\u03a3", "\u03c3").lower()))

    def piece(self, piece: str) -> bytes:
        return b"".join(p.to_bytes(4, "little") if isinstance(p, int) else self.word(p) for p in self.parts(piece))

    def emit(self, piece: str) -> Iterator[bytes]:
        """A long piece's ids in small blocks, of which none is kept."""
        block = array("I")
        for part in self.parts(piece):
            for i in (part,) if isinstance(part, int) else self.transduce(part):
                block.append(i)
                if len(block) == STEP:
                    yield block.tobytes()
                    block = array("I")
        yield block.tobytes()

    def encode(self, text: str, slab: int = 1 << 18) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids, slab by slab; a piece beyond STEP characters goes through block by block."""
        for part in chunks.slabs(text, slab):
            pieces = chunks.words(part)
            start = 0
            for i in [i for i, p in enumerate(pieces) if len(p) > STEP]:
                yield b"".join(self.known.values(pieces[start:i]))
                yield from self.emit(pieces[i])
                start = i + 1
            yield b"".join(self.known.values(pieces[start:]))


class Decoder:
    """ids to text, as a state machine. With the vocabulary's byte decoder the state is the open UTF-8
    sequence; a vocabulary without decoder has its tokens joined by one space, and the state is whether one came before."""

    def __init__(self, merges: MergeList) -> None:
        self.joined = merges.joined_decoder
        back = {c: b for b, c in enumerate(byte_letters())}
        if self.joined:
            self.bytes_of = {i: t.encode() for i, t in merges.text_of.items()}
        else:
            self.bytes_of = {i: t.encode() if i in merges.specials.values() or any(c not in back for c in t) else bytes(back[c] for c in t) for i, t in merges.text_of.items()}
        self.reset()

    def reset(self) -> None:
        self.begun = False
        self.open = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.feed_bytes(ids).decode() if self.joined else self.open.decode(self.feed_bytes(ids))

    def feed_bytes(self, ids: Iterable[int]) -> bytes:
        parts = list(map(self.bytes_of.__getitem__, ids))
        if not self.joined:
            return b"".join(parts)
        out = b" ".join(parts)
        if parts and self.begun:
            out = b" " + out
        self.begun = self.begun or bool(parts)
        return out

    def utf8(self, ids: Iterable[int]) -> bytes:
        """feed() as UTF-8."""
        return self.feed_bytes(ids) if self.joined else self.feed(ids).encode()

    def finish(self) -> str:
        out = "" if self.joined else self.open.decode(b"", final=True)
        self.reset()
        return out


@lru_cache(maxsize=2)
def _machines(path: str) -> tuple[Encoder, Decoder]:
    merges = MergeList(path)
    return Encoder(merges), Decoder(merges)


def encode_decode(docs: DataFrame, vocabulary: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each whole text; with keep_ids also ids (array) and decoded.

    A null text counts as empty. Narrow: one pass over the scan, no shuffle; a lost executor costs its own tasks only.
    """

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        encoder, decoder = _machines(vocabulary)
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for text in batch.column("text").to_pylist():
                n, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
                kept: list[int] = []
                decoded: list[bytes] = []
                for part in encoder.encode(text or ""):
                    ids_hash.update(part)
                    ids = memoryview(part).cast("I").tolist() if part else []
                    n += len(ids)
                    out = decoder.utf8(ids)
                    text_hash.update(out)
                    if keep_ids:
                        kept += ids
                        decoded.append(out)
                rest = decoder.finish().encode()
                text_hash.update(rest)
                for column, value in zip(rows, (n, ids_hash.hexdigest(), text_hash.hexdigest(), kept, (b"".join(decoded) + rest).decode()), strict=True):
                    column.append(value)
            columns = [batch.column("doc_id").cast(pa.int64()), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns += [pa.array(rows[3], pa.list_(pa.int64())), pa.array(rows[4], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<long>, decoded string" if keep_ids else "")
    return id_and_text(docs).selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, schema)
