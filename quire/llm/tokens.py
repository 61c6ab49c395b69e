"""Encoding whole texts inside a Spark task, with a bounded memo of the pieces between spaces.

Byte-level and word-level BPE encode the pieces of a text that single spaces separate
independently: no match of their split patterns crosses a space between two characters that are
not white space, and Unicode composition stops there too.  So a text is cut at exactly those
spaces and each distinct piece is encoded once per task.  Texts that hold the string of a special
token are encoded whole.
"""
from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores

_ODD_SPACE = re.compile(r"\s\s|^\s|\s$")
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Pieces a Python worker remembers before it starts afresh, and the longest of them in characters.
MEMO_PIECES, MEMO_CHARS = 250_000, 80
#: Pieces encoded in one call.
AT_ONCE = 4096


class Memo:
    """What a tokenizer makes of texts, put together from what it makes of their pieces.

    ``value`` of an encoding, and ``total`` of the values of a text's pieces; ``nothing`` is the
    total of none.
    """

    def __init__(self, tokenizer, specials: Iterable[str], value, total, nothing):
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self._tokenizer, self._specials = tokenizer, tuple(specials)
        self._value, self._total, self._nothing = value, total, nothing
        self._first, self._after_space = {}, {"": nothing}

    def _learn(self, memo: dict, new: set[str], before: str) -> list[str]:
        """Adds pieces to a memo; gives those that are too long to be kept."""
        pieces = list(new)
        for at in range(0, len(pieces), AT_ONCE):  # the library's results are large
            part = pieces[at:at + AT_ONCE]
            found = self._tokenizer.encode_batch_fast([before + x for x in part], add_special_tokens=False)
            memo.update(zip(part, map(self._value, found)))
        return [x for x in pieces if len(x) > MEMO_CHARS]

    def of(self, texts: list[str]) -> list:
        """The total of each text."""
        if len(self._first) > MEMO_PIECES:
            self._first = {}
        if len(self._after_space) > MEMO_PIECES:
            self._after_space = {"": self._nothing}
        heads, cut = [], []
        for text in texts:
            if any(x in text for x in self._specials):  # encoded whole, as a first piece
                pieces = [text]
            else:
                pieces = _CUT.split(text) if _ODD_SPACE.search(text) else text.split(" ")
            heads.append(pieces[0])
            pieces[0] = ""  # counts as nothing: no other piece is empty
            cut.append(pieces)
        long = [(m, x) for m, new, before in (
            (self._first, set(heads).difference(self._first), ""),
            (self._after_space, set().union(*cut).difference(self._after_space), " ")) for x in self._learn(m, new, before)]
        after, first, total = self._after_space.__getitem__, self._first, self._total
        out = [first[head] + total(map(after, pieces)) for head, pieces in zip(heads, cut)]
        for memo, x in long:
            del memo[x]
        return out


class Encoder:
    """Whole texts to their ids (little-endian unsigned 32-bit), or to how many they are."""

    def __init__(self, tokenizer, specials: Iterable[str] = ()):
        specials = list(specials)
        self.ids = Memo(tokenizer, specials, lambda x: array("I", x.ids).tobytes(), b"".join, b"").of
        self.counts = Memo(tokenizer, specials, len, sum, 0).of


@lru_cache(maxsize=4)
def from_file(path: str) -> Encoder:
    """The encoder of a tokenizer file, kept by the Python worker; special strings as its default."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return Encoder(tokenizer, [x.content for x in tokenizer.get_added_tokens_decoder().values()])


def byte_characters() -> dict[int, str]:
    """The printable character of each byte: itself where Latin-1 prints it, else from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


#: White space in a row from which on a text goes to ``tokenizers``: the pattern looks ahead after
#: white space, and ``tiktoken`` keeps a step on its stack for every character of it (700,000 still pass).
LONG_SPACE = 100_000


def has_long_space(text: str) -> bool:
    """Whether a text has LONG_SPACE white-space characters in a row; linear in the text."""
    return len(text) >= LONG_SPACE and any(m.end() - m.start() >= LONG_SPACE for m in re.finditer(r"\s+", text))


#: How byte-level pre-tokenizers split text (fixed by the file format).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteLevel:
    """The ids of a byte-level BPE file of ``tokenizers``, merged by ``tiktoken``.

    In such a file the ids rank the merges, so both libraries give the same ids (tested on every
    code point and on the corpus); this one takes a quarter of the time.  Texts that hold the string
    of a special token, or very much white space in a row, go to ``tokenizers``.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        if described["normalizer"] or described["pre_tokenizer"]["type"] != "ByteLevel" or described["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path} is not plain byte-level BPE")
        byte_of = {c: b for b, c in byte_characters().items()}
        added = {x["content"] for x in described["added_tokens"]}
        ranks = {bytes(map(byte_of.__getitem__, k)): v for k, v in described["model"]["vocab"].items() if k not in added}
        self._own = tiktoken.Encoding(path, pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        self._specials, self._tokenizer = tuple(added), Tokenizer.from_file(path)

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        return [array("I", self._tokenizer.encode(t, add_special_tokens=False).ids
                      if any(x in t for x in self._specials) or has_long_space(t) else self._own.encode_ordinary(t)).tobytes() for t in texts]


@lru_cache(maxsize=2)
def byte_level(path: str) -> ByteLevel:
    """The encoder of a byte-level BPE file, kept by the Python worker."""
    return ByteLevel(path)
