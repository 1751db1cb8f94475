"""Byte-level BPE by a sentencepiece model made from a rank file.

A rank file lists byte strings in the order they were merged. ``model_bytes`` writes
them straight into a sentencepiece model: each byte becomes one printable character,
each token a piece scored with its negative rank, and texts are not normalised. The
model then merges the pair of lowest rank first, leftmost on ties, as the ranks ask.
Pre-tokens (matches of a pattern) are encoded one by one; decoding maps pieces back to
their bytes.

Defined results: null text is encoded like an empty one (no ids, no bytes); nulls among
ids are left out when decoding and an id outside the vocabulary is an error. Rows are
independent, so repeated rows give repeated results; a column with the name of the
result is replaced. Texts may be as long as memory for one row allows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlake.llm.common import small_batches

# A task remembers the ids of this many pre-tokens at most, short ones only.
REMEMBERED = 200_000
REMEMBERED_CHARS = 32


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file, by id."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"ranks of {path} have gaps")
    return [ranks[i] for i in range(len(ranks))]


def byte_characters() -> list[str]:
    """A printable character for each byte.

    Bytes that print in Latin-1 stand for themselves; the others take the characters
    from 256 on, in turn.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    characters = {byte: chr(byte) for byte in printable}
    for byte in range(256):
        if byte not in characters:
            characters[byte] = chr(256 + byte - sum(p < byte for p in printable))
    return [characters[byte] for byte in range(256)]


def model_bytes(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model of the tokens; ids are the ranks."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    characters = byte_characters()
    model = proto.ModelProto()
    for rank, token in enumerate(tokens):
        model.pieces.add(
            piece="".join(characters[byte] for byte in token),
            score=-float(rank),
            type=proto.ModelProto.SentencePiece.NORMAL,
        )
    # A model needs a piece for the unknown; all bytes are known, so it never occurs.
    model.pieces.add(piece="<unk>", score=0.0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    model.trainer_spec.model_type = proto.TrainerSpec.BPE
    model.trainer_spec.unk_id = len(tokens)
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.trainer_spec.vocab_size = len(model.pieces)
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encodes and decodes in one Python process."""

    def __init__(self, tokens: list[bytes], model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.tokens = tokens
        self.whole = {token: i for i, token in enumerate(tokens)}
        self.split = regex.compile(pattern).findall
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.mapped = dict(enumerate(byte_characters()))
        self.known: dict[str, list[int]] = {}

    def _encode(self, part: str) -> list[int]:
        raw = part.encode()
        whole = self.whole.get(raw)
        if whole is not None:
            return [whole]
        return self.pieces.encode(raw.decode("latin-1").translate(self.mapped))

    def encode(self, text: str | None) -> list[int]:
        known, ids = self.known, []
        for part in self.split(text or ""):
            found = known.get(part)
            if found is None:
                found = self._encode(part)
                if len(part) <= REMEMBERED_CHARS:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[part] = found
            ids += found
        return ids

    def decode(self, ids) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


class Vocabulary:
    """A rank file and its pattern, as every task of a session sees them.

    The tokens and the model are broadcast; their size is that of the vocabulary.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        tokens = read_ranks(path)
        self.shared = spark.sparkContext.broadcast((tokens, model_bytes(tokens), pattern))


def encode(df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of the whole text."""
    small_batches(df.sparkSession)
    shared = vocabulary.shared

    @F.pandas_udf("array<int>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(*shared.value)
        for batch in batches:
            yield pd.Series([codec.encode(value) for value in batch], dtype=object)

    return df.withColumn(ids, encoded(F.col(text).cast("string")))


def decode(
    df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", content: str = "content"
) -> DataFrame:
    """``df`` with the bytes that the ids stand for."""
    small_batches(df.sparkSession)
    shared = vocabulary.shared

    @F.pandas_udf("binary")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(*shared.value)
        for batch in batches:
            yield pd.Series([codec.decode(value) for value in batch], dtype=object)

    present = F.coalesce(F.array_compact(F.col(ids)), F.array().cast("array<int>"))
    return df.withColumn(content, decoded(present))


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by one space."""
    return F.array_join(ids.cast("array<string>"), " ")
