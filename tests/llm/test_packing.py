import zlib

import numpy as np
import public_tokenizers
import tokenizers

from stackroom.llm import packing
from stackroom.llm.queries import tokenizer_file


def test_ids_are_those_of_the_tokenizers_library():
    known = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.encoder(tokenizer_file()).encode
    for text in ["", "  a\n\n b ", "Größe 12 km's\t", "汉字 😀", "x<|endoftext|> y", "a" * 5000]:
        wanted = known.encode(text, add_special_tokens=False).ids
        assert encode(text, allowed_special="all") == wanted


def test_very_long_white_space():
    known = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoding = packing.encoder(tokenizer_file())
    for text in ["a" + " " * 3_000_000 + "<|endoftext|>b", "\u3000" * 1_000_000]:
        wanted = known.encode(text, add_special_tokens=False).ids
        assert encoding.encode(text, allowed_special="all") == wanted
    plain = encoding.encode("<|endoftext|>", disallowed_special=())
    long = encoding.encode_to_numpy("\u3000" * 1_000_000 + "<|endoftext|>", disallowed_special=())
    assert long[-len(plain) :].tolist() == plain


def test_pieces_and_places(spark):
    texts = [(1, "one two"), (2, None), (3, ""), (4, "long words " * 300), (1, "one two"), (None, "x")]
    docs = spark.createDataFrame([(k, t, "z") for k, t in texts], "doc_id int, text string, length string")
    pieces = packing.pieces(docs, tokenizer_file(), capacity=64)
    rows = pieces.collect()
    encode = packing.encoder(tokenizer_file()).encode
    long = [r for r in rows if r[0] == 4]
    ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in sorted(long, key=lambda r: r["piece"])])
    assert ids.tolist() == [*encode(texts[3][1]), 0]
    assert {r["length"] for r in long if r["piece"] > 0} == {64}
    assert sum(r[0] == 1 for r in rows) == 2 and sum(r[0] is None for r in rows) == 1
    assert [r["length"] for r in rows if r[0] in (2, 3)] == [1, 1]
    packed = packing.pack(pieces.selectExpr("*", "crc32(ids) AS ids_crc32").drop("ids"), capacity=64).collect()
    assert sorted(r["ids_crc32"] for r in packed) == sorted(zlib.crc32(r["ids"]) for r in rows)
    bins = {}
    for r in packed:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    assert len(bins) == -(-sum(r["length"] for r in rows) // 64)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    pieces = packing.pieces(docs, tokenizer_file()).selectExpr("*", "crc32(ids) AS ids_crc32").drop("ids")
    assert packing.pack(pieces).count() == 0
