"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame

#: Where the vocabulary lies on every node; a parameter of every operator that measures texts.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits a text before the merges of this vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters from which a text is measured in parts cut at blanks, which bounds the memory of one call.
PART = 1_000_000


@lru_cache(maxsize=2)
def encoder(path: str):
    """The tokenizer of a rank file; built once per worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count(text: str | None, path: str = TOKENIZER) -> int:
    """Tokens of a whole text; 0 for null."""
    if not text:
        return 0
    enc, n, start = encoder(path), 0, 0
    while len(text) - start > PART:
        # A cut before a blank that follows a letter or digit is a border of tokens anyway.
        end = start + PART
        while end > start + 1 and not (text[end] == " " and text[end - 1].isalnum()):
            end -= 1
        end = end if end > start + 1 else start + PART
        n += len(enc.encode_ordinary(text[start:end]))
        start = end
    return n + len(enc.encode_ordinary(text[start:] if start else text))


def _count(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes = [count(t, path) for t in b.column(b.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(sizes, pa.int64())], names=[*b.schema.names[:-1], "n_tokens"])


def token_counts(df: DataFrame, text: Column, keep: dict[str, Column], path: str = TOKENIZER) -> DataFrame:
    """The columns ``keep`` and ``n_tokens``, the size of each whole text (0 for a null or empty one)."""
    narrow = df.select(*[c.alias(n) for n, c in keep.items()], text.cast("string").alias("__q_text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in narrow.dtypes[:-1])
    return narrow.mapInArrow(lambda it: _count(it, path), f"{schema}, n_tokens bigint")
