"""Byte-level BPE encoding and decoding with the tokenizers library, from a file of ranks.

The library works on characters, so each byte stands for one printable character; the merges are
all pairs of ranked tokens whose concatenation is ranked, by its rank.  Decoding reverses the byte
table: ids become bytes, and a character whose bytes are split over tokens is whole again once
they are joined.
"""
from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from . import tokens
from .common import inputs, slices


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and rank of each line of a rank file."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> tokens.Encoder:
    """The encoder of a rank file, built once in a Python worker."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    ranks, shown = read_ranks(path), tokens.byte_characters()
    name = lambda token: "".join(shown[b] for b in token)
    merges = [(rank, name(token[:i]), name(token[i:])) for token, rank in ranks.items()
              for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks]
    merges.sort()
    model = models.BPE({name(token): rank for token, rank in ranks.items()}, [(a, b) for _, a, b in merges])
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tokens.Encoder(tokenizer)


@lru_cache(maxsize=2)
def byte_table(path: str) -> dict[int, bytes]:
    """The bytes of each id."""
    return {rank: token for token, rank in read_ranks(path).items()}


def decoded(ids: bytes, table: dict[int, bytes]) -> bytes:
    """The bytes of little-endian unsigned 32-bit ids."""
    return b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def flat_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All tokens' bytes behind each other; where each id's begin; how many they are."""
    return _flat(byte_table(path))


def _flat(table: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.zeros(max(table) + 1, np.int64)
    lengths[list(table)] = list(map(len, table.values()))
    tokens_ = [table.get(i, b"") for i in range(len(lengths))]
    return np.frombuffer(b"".join(tokens_), np.uint8), np.cumsum(lengths) - lengths, lengths


#: Tokens whose bytes are looked up in one step.
LOOKED_UP = 1 << 14


def decoded_with_spans(ids: list[bytes], flat: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[list[bytes], list[np.ndarray], list[np.ndarray]]:
    """For each document's ids: the decoded bytes, the first character of each token, and the one after its last.

    Characters are code points.  A token that holds only some of a character's bytes counts as holding the character.
    """
    table, first, lengths = flat
    numbers = np.frombuffer(b"".join(ids), "<u4")
    parts, begins, ends, characters = [], [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
    for at in range(0, len(numbers), LOOKED_UP):
        part = numbers[at:at + LOOKED_UP]
        own = lengths[part]
        last = np.cumsum(own)
        data = table[np.arange(last[-1]) + np.repeat(first[part] - (last - own), own)]
        character = characters - 1 + np.cumsum(data & 0xC0 != 0x80)
        parts.append(data.tobytes())
        begins.append(character[last - own])
        ends.append(character[last - 1] + 1)
        characters = int(character[-1]) + 1
    whole, begin, end = b"".join(parts), np.concatenate(begins), np.concatenate(ends)
    counts = np.array([len(x) // 4 for x in ids], np.int64)
    places = np.concatenate(([0], np.cumsum(counts)))
    bytes_before = np.concatenate(([0], np.cumsum(lengths[numbers])))[places] if len(numbers) else np.zeros(len(ids) + 1, np.int64)
    own_first = np.repeat(begin[np.minimum(places[:-1], max(len(begin) - 1, 0))] if len(begin) else np.zeros(len(ids), np.int64), counts)
    begin, end = begin - own_first, end - own_first
    cut = lambda x: [x[a:b] for a, b in zip(places[:-1], places[1:])]
    return [whole[a:b] for a, b in zip(bytes_before[:-1], bytes_before[1:])], cut(begin), cut(end)


def offsets(ids: bytes, table: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token and the one after its last, in code points (see ``decoded_with_spans``)."""
    _, begin, end = decoded_with_spans([ids], _flat(table))
    return begin[0], end[0]


def encode(docs: DataFrame, ranks: str, pattern: str, with_offsets: bool = False, with_bytes: bool = False,
           offset_digest: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) for every row of ``docs``; ids are binary, little-endian unsigned 32-bit.

    ``ranks``: path of a rank file; ``pattern`` splits the text, and each match is merged alone.
    Without special tokens: their strings are ordinary text.  ``with_offsets`` adds ``starts``
    and ``ends``, each token's code points; ``offset_digest`` adds ``offsets_sha256``, lowercase hex of the SHA-256 of all starts and
    then all ends as unsigned 32-bit numbers, taken by the worker because offsets are twice as large as ids; ``with_bytes`` adds ``bytes``, decoded from the ids
    by the same worker.  A null text counts as empty and has no ids.  Repeated rows stay; null
    ids of documents stay null.
    """
    rows = inputs(docs, id_col, text_col)
    more = {"starts": pa.list_(pa.int64()), "ends": pa.list_(pa.int64())} if with_offsets else {}
    more |= {"offsets_sha256": pa.string()} if offset_digest else {}
    more |= {"bytes": pa.binary()} if with_bytes else {}
    shown = ",starts:array<long>,ends:array<long>" * with_offsets + ",offsets_sha256:string" * offset_digest + ",bytes:binary" * with_bytes

    @arrow_udf("struct<ids:binary" + shown + ">")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encode_texts, flat = encoder(ranks, pattern).ids, flat_table(ranks)
        for batch in batches:
            parts = []
            for part in slices(batch):  # into Arrow by and by, which is smaller than Python's objects
                ids = encode_texts(part)
                columns = {"ids": pa.array(ids, pa.binary())}
                if more:
                    data, begin, end = decoded_with_spans(ids, flat)
                if with_offsets:
                    columns |= {"starts": pa.array(begin, more["starts"]), "ends": pa.array(end, more["ends"])}
                if offset_digest:
                    columns["offsets_sha256"] = pa.array([hashlib.sha256(a.astype("<u4").tobytes() + b.astype("<u4").tobytes()).hexdigest()
                                                          for a, b in zip(begin, end)], pa.string())
                if with_bytes:
                    columns["bytes"] = pa.array(data, pa.binary())
                parts.append(pa.StructArray.from_arrays(list(columns.values()), list(columns)))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.struct({"ids": pa.binary()} | more))

    out = rows.select("doc_id", of.asNondeterministic()("text").alias("t"))
    return out.select("doc_id", *[f"t.{c}" for c in ("ids", *more)])


def decode(ids: Column, ranks: str) -> Column:
    """The bytes of ``ids``: binary, equal to the encoded text's UTF-8.

    Null stays null.  Cast it to string for the text; where ids were cut inside a character, the
    bytes are whole only with the neighbouring ids.
    """

    @arrow_udf("binary")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = byte_table(ranks)
        for batch in batches:
            yield pa.array([None if x is None else decoded(x, table) for part in slices(batch) for x in part], pa.binary())

    return of.asNondeterministic()(ids)
