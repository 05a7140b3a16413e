"""Token counts with a public tokenizer. The vocabulary file is a parameter; it is
read by every worker from the folder the installation names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lectern.operators.arrow import map_columns

#: Vocabulary file (ranks of a byte-level BPE for many languages).
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how the vocabulary's makers cut text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoder(path: str = VOCABULARY):
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("lectern", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


_cached: dict = {}


def cached_encoder(path: str):
    """One encoder per worker process."""
    if path not in _cached:
        _cached[path] = encoder(path)
    return _cached[path]


def with_counts(df: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens) of every document; null texts count nothing."""

    def kernel(columns: dict) -> dict:
        enc = cached_encoder(path)
        return {
            "doc_id": columns["doc_id"],
            "source": columns["source"],
            "n_tokens": [len(enc.encode_ordinary(t)) if t else 0 for t in columns["text"]],
        }

    return map_columns(df.select("doc_id", "source", "text"), kernel, "doc_id bigint, source string, n_tokens bigint")
