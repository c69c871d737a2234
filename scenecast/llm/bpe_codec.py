"""BPE encoding and decoding of whole texts.

Method: the contiguous rank array of :mod:`scenecast.llm.bytebpe`.  Each task
splits its texts into pre-tokens, merges every pre-token it has not met yet and
keeps the packed ids of the words it has (a bounded memo), so the cost of a
document is one dictionary look-up per pre-token.  Nothing is shuffled; a lost
task is run again from its input split.

Ids are returned packed as little-endian unsigned 32-bit integers (BINARY), the
form in which training data are stored; ``unpack`` turns them into an array.

Edge cases: a null text is encoded as the empty text (no ids, decoded to "");
null packed ids decode to ""; repeated rows are encoded each; other columns,
of any name but the output columns, pass through untouched.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenecast.llm import bytebpe
from scenecast.llm.common import require


@lru_cache(maxsize=4)
def _packer(path: str):
    vocab = bytebpe.load(path)

    def pack(words: list[str]) -> list[bytes]:
        return [ids.astype("<u4").tobytes() for ids in vocab.merge_all(words)]

    return vocab, bytebpe.Memo(pack)


def encode_texts(texts: list[str | None], path: str) -> list[bytes]:
    """Packed token ids of each text; ``GROUP`` characters of text at a time."""
    vocab, memo = _packer(path)
    out: list[bytes] = []
    for group in bytebpe.groups(texts):
        cut = [list(vocab.pieces(t)) for t in group]
        memo.learn([w for pieces in cut for words, _ in pieces for w in words])
        for pieces in cut:
            parts: list[bytes] = []
            for words, special in pieces:
                parts.extend(map(memo.__getitem__, words))
                if special is not None:
                    parts.append(special.to_bytes(4, "little"))
            out.append(b"".join(parts))
    return out


def encode_text(text: str | None, path: str) -> bytes:
    """Packed token ids of one text."""
    return encode_texts([text], path)[0]


def decode_ids(packed: bytes | None, path: str) -> str:
    """Text of packed ids; bytes that are no UTF-8 become U+FFFD."""
    parts = bytebpe.load(path).token_bytes
    ids = np.frombuffer(packed or b"", dtype="<u4").tolist()
    return b"".join(map(parts.__getitem__, ids)).decode("utf-8", "replace")


def packed_ids(text: Column, path: str) -> Column:
    """Column expression: packed ids of a text column."""
    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(encode_texts(texts.to_pylist(), path), pa.binary())
    return run(text)


def decoded_text(ids: Column, path: str) -> Column:
    """Column expression: text of a packed id column."""
    @F.arrow_udf("string")
    def run(packed: pa.Array) -> pa.Array:
        return pa.array((decode_ids(p.as_py(), path) for p in packed), pa.string())
    return run(ids)


def encode(docs: DataFrame, path: str, text_col: str = "text",
           ids_col: str = "ids") -> DataFrame:
    """Add the packed ids of every whole text as ``ids_col``."""
    require(docs, text_col)
    return docs.withColumn(ids_col, packed_ids(F.col(text_col), path))


def decode(encoded: DataFrame, path: str, ids_col: str = "ids",
           out_col: str = "decoded") -> DataFrame:
    """Add the text of every row's packed ids as ``out_col``."""
    require(encoded, ids_col)
    return encoded.withColumn(out_col, decoded_text(F.col(ids_col), path))


def n_tokens(ids_col: str = "ids") -> Column:
    """Number of tokens in a packed id column."""
    return (F.octet_length(ids_col) / 4).cast("long")


def unpack(packed: bytes) -> list[int]:
    """Packed ids as a list of integers (for readers outside Spark)."""
    return np.frombuffer(packed, dtype="<u4").tolist()
