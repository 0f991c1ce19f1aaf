"""Texts that are hard by their length: white space, one word, many candidates; and malformed images."""

import tracemalloc

import numpy as np
import pytest

from glyphmill.llm import bpe, chunks, media, packing, queries, secrets, tokencount

HEX = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"


@pytest.mark.parametrize("text", [" " * 400_000, "\n" * 400_000 + "x", "a b" + "\t " * 200_000 + "c", "word " * 3 + " " * 1_100_000 + "end", "x" * 400_000])
def test_packing_survives_runs(text):
    encode, lib = packing._encoder(queries.BYTE_BPE), chunks.library(queries.BYTE_BPE)
    ids = b"".join(map(encode, chunks.slabs(text, packing.GROUP_CHARS)))
    assert np.frombuffer(ids, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids


def test_long_words_leave_in_blocks():
    encoder, lib = bpe.Encoder(bpe.MergeList(queries.WORD_BPE)), chunks.library(queries.WORD_BPE)
    for text in ("abc" * 2000, "é日ab" * 1500 + " it's", "x<|endoftext|>y" * 400, "1234." * 1000):
        assert np.frombuffer(b"".join(encoder.encode(text)), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids
    text = "lorem" * 12_000
    tracemalloc.start()
    sizes = [len(block) for block in encoder.emit(text)]
    assert max(sizes) <= 4 * bpe.STEP and tracemalloc.get_traced_memory()[1] < 30 * len(text)
    tracemalloc.stop()
    assert len(encoder.known.known) < 10


def test_piece_table_is_bounded_by_bytes():
    table = chunks.PieceTable(lambda batch: [len(p) for p in batch], limit=100, chars=1000)
    for k in range(50):
        pieces = [f"{k}-{i}" * 5 for i in range(40)] + ["y" * 5000]
        assert table.values(pieces) == [len(p) for p in pieces]
        assert len(table.known) <= 100 and sum(map(len, table.known)) <= 1000 + max(sum(map(len, pieces[:40])), 0)
    batches = list(chunks.balanced(["a" * 10, "é" * 10] * 50, 400))
    assert sum(map(len, batches)) == 100 and all(390 <= sum(map(chunks.n_bytes, b)) <= 430 or b is batches[-1] for b in batches)


def test_model_texts_are_cut_where_it_is_safe(spark):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["a b  c\td 1 2.", " lead", "Ünï x ﬁ y", "w1 w2 " * 5000, "x́ y ́z"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["n_tokens"] for r in tokencount.count_tokens(df, path).orderBy("doc_id").collect()] == [len(lib.encode(t)) for t in texts]


def test_secrets_in_dense_texts(spark):
    n = 4000
    texts = [" ".join(f'token = "{HEX[i % 9:]}{HEX[: i % 9]}" id' for i in range(n)), "no secret"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = secrets.redact(df).orderBy("doc_id").collect()
    assert out[0]["text"] == " ".join([f'token = "{secrets.MASK}" id'] * n) and out[1]["text"] == "no secret"
    rows = secrets.scan(df).select("start", "length").orderBy("start").collect()
    assert [r["start"] for r in rows] == [9 + 54 * i for i in range(n)]


def test_whole_key_blocks(spark):
    keys = ["-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A1B\n\nabc/+=\n-----END RSA PRIVATE KEY-----", "-----BEGIN PGP PRIVATE KEY BLOCK-----\nVersion: x\n\nabcd\n-----END PGP PRIVATE KEY BLOCK-----", "-----BEGIN PRIVATE KEY-----\nabcd"]
    df = spark.createDataFrame(list(enumerate(f"see {k}, then" for k in keys)), "doc_id long, text string")
    assert [r["text"] for r in secrets.redact(df).orderBy("doc_id").collect()] == ["see [SECRET], then"] * 3


def test_malformed_images_are_null(spark):
    grey = media.encode_bmp(np.zeros((2, 2), np.uint8))
    small = bytearray(grey)
    small[46:50] = (1).to_bytes(4, "little")  # one colour, and samples beyond it
    small[-8:] = b"\x07" * 8
    bad = [b"P2 1 1 255 999", b"P5 99999999999 99999999999 255 a", b"P5 1 1 9 \x10", b"P3 1 1 255 1 2", b"P2 1 1 255 x", b"P1 3", b"P5", b"BM", bytes(small), grey[:40], grey[:-2], b"BM" + b"\xff" * 60, b"P2 1 1 255 -3", b""]
    for data in bad:
        with pytest.raises(ValueError):
            media.decode(data)
    df = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate([*bad, grey])], "k long, m binary")
    assert [r["k"] for r in media.decode_column(df, "k", "m").where("height is not null").collect()] == [len(bad)]


def test_only_the_piece_table_in_use_holds_pieces():
    one, other = (chunks.PieceTable(lambda batch: [len(p) for p in batch]) for _ in range(2))
    assert one.values(["a", "bb"]) == [1, 2] and other.values(["ccc"]) == [3]
    assert not one.known and not one.size and len(other.known) == 1
    assert one.values(["bb"]) == [2] and not other.known and len(one.known) == 1
