"""Token files and piece encoding: exact round trips, the libraries' own results, a whole-text search."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from delinq.llm import piece_viterbi, token_blocks
from delinq.llm.queries import QUERIES

BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "a", " a  b\n\n c ", "x\u00a0 y \t z", "don't  stop'll 12 34", "\u2581 lit\u2581eral", "日本語 \U0001f600 ok", "<|endoftext|> a", "a <|endoftext|> b </s> x", "x<|endoftext|>y  <|endoftext|>", "b\n<|endoftext|>\n a<|endoftext|> .", "<|endoftext", "\n", "  ", "a\x1c b", "aaaaaaaa" * 50]


def random_text(rng: random.Random) -> str:
    return "".join(rng.choice(" \n\t\u00a0ab1'sé,.-\u2581日\U0001f600\x1c\u3000") for _ in range(rng.randrange(40)))


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    cases = [rng.integers(0, high, n, dtype=np.uint32) for high in (1, 2, 300, 50257, 2**32 - 1) for n in (1, 7, 4096)]
    cases.append(np.array([5] * 4000 + [2**31] * 96, np.uint32))
    for ids in cases:
        assert (token_blocks.unpack_block(b"xx" + token_blocks.pack_block(ids), 2) == ids).all()
    doc_ids, counts, ids = token_blocks.unpack_shard(token_blocks.pack_shard([3, None], [9000, 1], np.arange(9001, dtype=np.uint32)))
    assert doc_ids == [3, None] and counts.tolist() == [9000, 1] and (ids == np.arange(9001)).all()
    with pytest.raises(ValueError):
        token_blocks.unpack_shard(b"other" * 20)


def test_encoder_equals_library():
    plain = Tokenizer.from_file(BPE)
    rng = random.Random(5)
    texts = ODD + [random_text(rng) for _ in range(3000)]
    got = token_blocks.Encoder(BPE).encode(texts)
    for text, ids in zip(texts, got):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_token_files_read_back(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = {r.doc_id: r for r in QUERIES["op4_token_blocks"](spark, small).collect()}
    plain, start = Tokenizer.from_file(BPE), 0
    for d in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = [*plain.encode(d.text, add_special_tokens=False).ids, 0]
        assert rows[d.doc_id][1:] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(rows) == docs.count()


def test_token_files_edge_cases(spark):
    rows = [(2, "b", "x"), (None, "n", "x"), (2, "a", "x"), (1, None, "x"), (1, None, "x")]
    rows.append((8, "end<|endoftext|> of", "x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    manifest, folder = token_blocks.write_tokens(docs, BPE)
    out = sorted(token_blocks.read_tokens(manifest, folder).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens) for r in out] == [(None, 0, 2), (1, 2, 1), (1, 3, 1), (2, 4, 2), (2, 6, 2), (8, 8, 4)]
    assert np.frombuffer(out[-1].ids, "<u4")[1] == 50256
    manifest, folder = token_blocks.write_tokens(docs.where("doc_id > 9"), BPE)
    assert token_blocks.read_tokens(manifest, folder).count() == 0


def whole_search(pieces, text):
    """Viterbi over the whole text at once, scores of all positions kept."""
    best, back = [0.0] + [None] * len(text), [None] * (len(text) + 1)
    for at in range(len(text)):
        node, options = pieces.tree, []
        for end in range(at, len(text)):
            node = node.get(text[end])
            if node is None:
                break
            if "" in node:
                options.append((end + 1, *node[""]))
        if not any(o[0] == at + 1 for o in options):
            options.append((at + 1, -1, pieces.unknown))
        for end, i, score in options:
            if best[end] is None or best[at] + score > best[end]:
                best[end], back[end] = best[at] + score, (at, i)
    ids, end = [], len(text)
    while end:
        start, i = back[end]
        ids.append(pieces.ids_of(i, text[start:end]))
        end = start
    return [i for part in reversed(ids) for i in part]


def test_streaming_equals_whole_search():
    pieces, rng = piece_viterbi.pieces(MODEL), random.Random(7)
    words = ["the", "pen", "straßenbahn", "information", "été", "unthinkable", "aaaaaaa", "x\u2581y"]
    texts = ODD + [random_text(rng) for _ in range(400)] + [" ".join(rng.choices(words, k=12)) for _ in range(100)]
    for text in texts:
        streamed = [i for part in pieces.search(" " + text) for i in part] if text else []
        assert streamed == (whole_search(pieces, " " + text) if text else [])
        ids = np.frombuffer(pieces.encode_all([text])[0], "<i4").tolist()
        assert ids == streamed and pieces.decode(ids) == text


def test_streaming_commits_early():
    pieces = piece_viterbi.pieces(MODEL)
    parts = list(pieces.search(" " + "informationtechnology" * 40))
    assert len(parts) > 20 and max(map(len, parts)) < 60


def test_equals_library_unigram():
    """The same pieces and scores in the lattice search of the library."""
    data = bytearray(open(MODEL, "rb").read())
    at = data.rindex(b"\x06tok_v0\x18\x02")
    data[at + 8] = 1  # the model file's kind: 1 is unigram
    library, pieces = SentencePieceProcessor(model_proto=bytes(data)), piece_viterbi.pieces(MODEL)
    for word in ["the", "information", "unthinkable", "Straße", "antidisestablishment", "ereding", "heaou", "ab12,cd"]:
        assert np.frombuffer(pieces.encode_all([word])[0], "<i4").tolist() == library.nbest_encode_as_ids(word, 2)[0]


def test_query_round_trips(spark, small):
    out = QUERIES["op3_piece_viterbi"](spark, small)
    assert out.count() == spark.read.parquet(f"{small}/documents.parquet").count()
    assert out.where("not round_trip or n_ids <> size(ids)").count() == 0


def test_pieces_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 5), (None, "", 6), (3, "a b", 7), (3, "a b", 7)], "doc_id long, text string, ids int")
    out = piece_viterbi.round_trip(docs, MODEL).orderBy(F.col("doc_id").asc_nulls_first()).collect()
    assert [(r.doc_id, r.n_ids, r.round_trip) for r in out][:2] == [(None, 0, True), (1, 0, True)]
    assert out[2] == out[3] and out[2].n_ids == len(out[2].ids) > 0
    assert piece_viterbi.round_trip(docs.where("doc_id > 9"), MODEL).count() == 0
