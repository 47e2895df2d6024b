"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marginalis.session import spread

#: Vocabulary file; a parameter everywhere, never part of the repository.
TOKENIZER = os.environ.get("MARGINALIS_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")

# How the public byte-level vocabularies cut a text before they merge bytes.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

LONG_BLANK = regex.compile(r"\s{2000}")


def counter(content: bytes, kind: str) -> Callable[[list[str]], list[int]]:
    """Token counts of texts by a vocabulary file of kind tiktoken, json or model."""
    if kind == "tiktoken":
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        made = tiktoken.Encoding("ranks", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
        # the library's own pattern fails on long runs of white space; regex cuts them alike
        cut = regex.compile(BYTE_PATTERN)
        piecewise = lambda t: sum(len(made._encode_single_piece(p)) for p in cut.findall(t))
        return lambda texts: [piecewise(t) if LONG_BLANK.search(t) else len(made.encode_ordinary(t)) for t in texts]
    if kind == "model":
        import sentencepiece

        made = sentencepiece.SentencePieceProcessor(model_proto=content)
        return lambda texts: [len(x) for x in made.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(content.decode("utf-8"))
    made.encode_special_tokens = True
    made.no_truncation()
    return lambda texts: [len(e) for i in range(0, len(texts), 256) for e in made.encode_batch(texts[i : i + 256], add_special_tokens=False)]


def token_counts(df: DataFrame, text: str, out: str = "tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """Add ``out``, the number of tokens of ``text``; 0 for null and empty
    texts.  Texts are read whole; a column named ``out`` is replaced.  The
    file's ending tells its kind.  The driver reads the vocabulary file and
    sends it along, so executors need no copy of it."""
    with open(tokenizer, "rb") as f:
        sent = df.sparkSession.sparkContext.broadcast(f.read())
    kind = tokenizer.rsplit(".", 1)[-1]
    df = df.drop(out)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.LongType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(sent.value, kind)
        for batch in batches:
            yield batch.assign(**{out: count([t if isinstance(t, str) else "" for t in batch[text]])})

    return spread(df).mapInPandas(run, schema)
