"""Packing by power-of-two decomposition.

A document of n tokens becomes pieces of 1024 tokens while they last, and then one piece for each
binary digit of the rest, from the longest to the shortest. Each piece is a sequence of its own, so
no sequence crosses documents, nothing is padded, and sequences of equal length form one bucket
(log2 of the length; sequence_id % 16 gives it), from which equal-shaped batches are drawn.

Defined results: a null or empty text is its end id alone, one piece of length 1; repeated rows get
sequences of their own; extra columns are ignored; an empty table gives an empty result. Sequence ids come
from a row's place in the scan, which is the same when a lost task runs again.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks
from .bpe import byte_letters
from .common import byte_groups, id_and_text

LONGEST = 1024
#: The byte-level pre-tokenizer's pattern, a fixed value of the format.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
GROUP_CHARS = 1 << 20


@lru_cache(maxsize=2)
def _encoder(path: str) -> Callable[[str], bytes]:
    """text -> little-endian 32-bit ids. A byte-level vocabulary whose ids follow its merges gives the same ids
    by ranks, which is several times faster; any other goes to its own library (tests hold both together)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    tokenizer = chunks.library(path)
    by_library = lambda text: array("I", tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    split = (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and spec["pre_tokenizer"]["use_regex"] and not spec["pre_tokenizer"]["add_prefix_space"]
    letters = {c: b for b, c in enumerate(byte_letters())}
    joined = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
    if split and spec.get("normalizer") is None and [vocab[t] for t in joined] == list(range(256, 256 + len(joined))) and len(vocab) == 256 + len(joined):
        import tiktoken

        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
        names = set(special)
        bpe = tiktoken.Encoding("bytes", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=special)
        by_rank = lambda text: bpe.encode_to_numpy(text, allowed_special=names, disallowed_special=()).astype("<u4").tobytes()
        # The rank encoder's pattern goes back over white space step by step and fails on very long runs of it.
        return lambda text: by_library(text) if chunks.LONG_SPACE.search(text) else by_rank(text)
    return by_library


def decompose(n: int, longest: int = LONGEST) -> list[int]:
    """Lengths of the pieces of n tokens, longest first."""
    out = [longest] * (n // longest)
    rest, size = n % longest, longest >> 1
    while size:
        if rest & size:
            out.append(size)
        size >>= 1
    return out


def pack(docs: DataFrame, vocabulary: str, end_id: int = 0, longest: int = LONGEST, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket; with keep_ids also ids (little-endian 32-bit).

    Narrow: one pass over the scan and no shuffle. Writing with partitionBy("bucket") gives the buckets as folders.
    """
    if longest & (longest - 1) or longest > 1 << 15:
        raise ValueError("longest must be a power of two up to 32768")

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        encode = _encoder(vocabulary)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            texts = batch.column("text").to_pylist()
            keys = batch.column("doc_id").to_pylist()
            for group in byte_groups([len(t or "") for t in texts], 4 * GROUP_CHARS):
                out: list[list] = [[], [], [], [], [], []]
                for i in group:
                    text = texts[i] or ""
                    ids = b"".join(map(encode, chunks.slabs(text, GROUP_CHARS))) + end
                    total = len(ids) // 4
                    view, start = memoryview(ids), 0
                    for size in decompose(total, longest):
                        piece = view[4 * start : 4 * (start + size)]
                        for column, value in zip(out, (keys[i], start, size, zlib.crc32(piece), total, bytes(piece) if keep_ids else None), strict=True):
                            column.append(value)
                        start += size
                columns = [pa.array(c, pa.int64()) for c in out[:5]]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(out[5], pa.binary())] if keep_ids else columns, [*names, "ids"] if keep_ids else names)

    pieces = id_and_text(docs).selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids binary" if keep_ids else ""))
    bucket = F.round(F.log2("length")).cast("int")
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.monotonically_increasing_id() * 16 + bucket).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), bucket.alias("bucket"), *(["ids"] if keep_ids else []))
