"""BPE codec and token counts against the tokenizer library, and the round trip."""

import hashlib
import random
import struct

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scenecast.llm import bpe_codec, bytebpe, token_counts
from scenecast.llm.queries import (op1_bpe_codec, op6_token_counts, table, vocabulary_path)
from tests.conftest import SF_SMALL

PATH = vocabulary_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_strings():
    rng = random.Random(5)
    out = ["", " ", "\n\n  x", "a<|endoftext|>b<|endoftext|>", " <|endoftext|> <|endoftext", "x" * 3000,
           "ab" * 2000 + "é" * 900, "日本語 \U0001f600\U0001f600", "՘x 1՘", "\x00\x1c\x85\xa0",
           "don't 'S 's 123abc ١٢", "".join(map(chr, range(0x20, 0x3000, 7)))]
    out += ["".join(chr(c) for c in (rng.randrange(1, 0x11000) for _ in range(40))
                    if not 0xD800 <= c <= 0xDFFF) for _ in range(200)]
    out += ["".join(rng.choice(" \n\tab'sé1<|endoftext|>9!? 　") for _ in range(60))
            for _ in range(200)]
    return out


def test_encode_decode_and_counts_equal_the_library(library):
    texts = odd_strings()
    packed = bpe_codec.encode_texts(texts, PATH)
    for text, ids, n in zip(texts, packed, token_counts.count_texts(texts, PATH)):
        want = library.encode(text, add_special_tokens=False).ids
        assert bpe_codec.unpack(ids) == want
        assert n == len(want)
        assert bpe_codec.decode_ids(ids, PATH) == library.decode(want, skip_special_tokens=False)


def test_merges_side_by_side_equal_the_heap():
    vocab = bytebpe.load(PATH)
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeéthing ") for _ in range(rng.randrange(1, 22)))
             for _ in range(500)]
    for word, ids in zip(words, vocab.merge_all(words)):
        raw = word.encode()
        assert ids.tolist() == vocab._merge_long([int(vocab.byte_id[b]) for b in raw])


def test_whole_tokens_are_single(library):
    whole = token_counts.whole_tokens(PATH)
    assert len(whole) > 40_000
    for word in sorted(whole)[::997]:
        assert len(library.encode(word, add_special_tokens=False).ids) == 1


def test_memo_forgets_when_full():
    made = []
    memo = bytebpe.Memo(lambda ws: made.append(len(ws)) or [len(w) for w in ws], {"x": 1}, room=3)
    memo.learn(["aa", "b", "aa"])
    memo.learn(["cc", "dd", "x"])
    assert memo["cc"] == 2 and memo["x"] == 1 and "aa" not in memo and made == [2, 2]


def test_query_digests(spark, library):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF_SMALL, "documents").collect()}
    rows = op1_bpe_codec(spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
    counts = {r["doc_id"]: r for r in op6_token_counts(spark, SF_SMALL).collect()}
    for r in rows:
        c = counts[r["doc_id"]]
        assert c["n_tokens"] == r["n_tokens"] and c["over_limit"] == (c["n_tokens"] > 1024)
        assert c["n_bytes"] == len((texts[r["doc_id"]] or "").encode())


def test_odd_rows_and_other_columns(odd_docs, odd_texts, empty_docs, library):
    extra = odd_docs.withColumn("n_tokens", F.lit("kept out")).withColumn("decoded", F.lit(1))
    coded = bpe_codec.decode(bpe_codec.encode(extra, PATH), PATH).collect()
    assert len(coded) == len(odd_texts)
    for r in coded:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert bpe_codec.unpack(bytes(r["ids"])) == want and r["decoded"] == (r["text"] or "")
    counted = token_counts.count_tokens(extra, PATH).collect()
    assert sorted(r["n_tokens"] for r in counted) == sorted(len(r["ids"]) // 4 for r in coded)
    assert bpe_codec.encode(empty_docs, PATH).count() == 0
    assert token_counts.count_tokens(empty_docs, PATH).count() == 0
    assert bpe_codec.decode_ids(None, PATH) == ""
    with pytest.raises(ValueError, match="missing"):
        bpe_codec.encode(odd_docs, PATH, text_col="body")
