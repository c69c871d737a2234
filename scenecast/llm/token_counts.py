"""Token counts by the whole-token shortcut.

Before any text is read, each vocabulary string is put through the merge loop
alone; those that come out as one token are *whole*: as a pre-token they count
one, whatever stands around them, since merges never cross pre-tokens.  A
text's pre-tokens are then looked up; only those that are not whole are merged,
once per task and word (a bounded memo holds their counts).

Edge cases: a null text counts as the empty text (0 bytes, 0 tokens); strings
of added special tokens inside a text count one each, as the tokenizer reads
them; repeated rows are counted each; other columns pass through.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scenecast.llm import bytebpe
from scenecast.llm.common import require


@lru_cache(maxsize=4)
def whole_tokens(path: str) -> dict[str, int]:
    """The proof: vocabulary strings that encode alone as one token, each with count 1.

    Strings that are no UTF-8 text, or that the pre-token rule would cut, can't
    be a pre-token and are left out.
    """
    vocab = bytebpe.load(path)
    texts = {}
    for i, raw in vocab.token_bytes.items():
        try:
            texts[raw.decode()] = i
        except UnicodeDecodeError:
            continue
    words = [t for t in texts if vocab.find(t) == [t]]
    return {w: 1 for w, ids in zip(words, vocab.merge_all(words)) if ids.tolist() == [texts[w]]}


@lru_cache(maxsize=4)
def _counter(path: str):
    vocab = bytebpe.load(path)
    return vocab, bytebpe.Memo(lambda words: list(map(len, vocab.merge_all(words))),
                               whole_tokens(path))


def count_texts(texts: list[str | None], path: str) -> list[int]:
    """Number of tokens of each text; ``GROUP`` characters of text at a time."""
    vocab, counts = _counter(path)
    out: list[int] = []
    for group in bytebpe.groups(texts):
        cut = [list(vocab.pieces(t)) for t in group]
        counts.learn([w for pieces in cut for words, _ in pieces for w in words])
        out.extend(sum(sum(map(counts.__getitem__, words)) + (special is not None)
                       for words, special in pieces) for pieces in cut)
    return out


def count_text(text: str | None, path: str) -> int:
    """Number of tokens of one text."""
    return count_texts([text], path)[0]


def token_count(text: Column, path: str) -> Column:
    """Column expression: tokens of a text column."""
    @F.arrow_udf("bigint")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(count_texts(texts.to_pylist(), path), pa.int64())
    return run(text)


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", limit: int = 1024
                 ) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``over_limit`` (n_tokens > limit) to every row."""
    require(docs, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.withColumns({"n_bytes": F.octet_length(text).cast("long"),
                                "n_tokens": token_count(text, path)})
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
