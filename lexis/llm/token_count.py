"""Token counts (operator 5): lengths from a public tokenizer, in Arrow batches.

Texts go to the tokenizer in groups of about equal bytes, and only the lengths
come back.  Long texts are split where the tokenizer splits anyway: before a
single space between two characters that are not white space.  No special token
and no word of the byte-level vocabulary's pre-tokenizer spans such a place, so
the lengths of the pieces add up to the length of the whole.

Scale: no shuffle; memory is bounded by the group of texts in hand, and the
tokenizer is loaded once per worker from ``path`` (a parameter; the file must be
there on every executor).

Defined cases: null text counts as empty and has no tokens.  Rows without a
doc_id and repeated rows are counted like others.  Extra columns are ignored.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.session import ship_package

LIMIT = 1024
GROUP_BYTES = 1 << 20  # text handed to the tokenizer at once
SPLIT_CHARS = 1 << 15  # texts are split into pieces of about this length
# A single space between two characters that aren't white space in any script.
_SAFE = re.compile(r"(?<=[^\s]) (?=[^\s])")
_LOADED: dict = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _encoder(path: str):
    """A function from a list of texts to their numbers of tokens."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            import sentencepiece

            own = sentencepiece.SentencePieceProcessor(model_file=path)
            _LOADED[path] = lambda texts: [len(x) for x in own.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(path)
            own.no_truncation()
            own.no_padding()
            _LOADED[path] = lambda texts: [len(x) for x in own.encode_batch_fast(texts, add_special_tokens=False)]
    return _LOADED[path]


def pieces(text: str, size: int = SPLIT_CHARS) -> list:
    """``text`` cut at safe places into pieces of at least ``size`` code
    points (the last may be shorter); a text without such places is whole."""
    out, a = [], 0
    while len(text) - a > 2 * size:
        cut = _SAFE.search(text, a + size)
        if cut is None:
            break
        out.append(text[a:cut.start()])
        a = cut.start()
    out.append(text[a:])
    return out


def lengths(texts: list, path: str, split: bool) -> list:
    """Number of tokens of each text."""
    encode, out = _encoder(path), [0] * len(texts)
    group, owner, held = [], [], 0

    def flush():
        for i, n in zip(owner, encode(group)):
            out[i] += n

    for i, t in enumerate(texts):
        for piece in (pieces(t) if split else [t]) if t else []:
            group.append(piece)
            owner.append(i)
            held += len(piece.encode())
            if held >= GROUP_BYTES:
                flush()
                group, owner, held = [], [], 0
    if group:
        flush()
    return out


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens and over_limit.  Texts are split
    only for byte-level vocabularies; other kinds get each text whole."""
    ship_package(docs.sparkSession)
    path = path or default_path()
    split = os.path.basename(path).startswith("byte_bpe")

    def run(batches):
        for batch in batches:
            n = lengths(batch.column("text").to_pylist(), path, split)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", text.alias("text"),
                       F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"))
    out = rows.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
