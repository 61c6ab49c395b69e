"""Quality rules from a suffix array: how much of a text repeats itself.

The words of a text are its symbols.  A suffix array (prefix doubling: ranks by the first 1, 2, 4
... symbols, sorting only what is still tied) puts equal beginnings next to each other, and the
longest common prefix of neighbours gives for every position the longest substring from there that
occurs again.  Positions whose repeat is not the tail of the one before are the occurrences of
maximal repeated substrings.  The union of their spans is the covered part of the text.

Many texts are sorted in one go: symbols and end marks are numbered per text, so no prefix is
common to two texts.  The work is n log(longest repeat) in the words, however the text repeats.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

from .common import slices

SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
#: Words sorted in one go, beyond which the texts gathered so far are worked off.
AT_ONCE = 400_000

RESULT = ("struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,"
          "base_failed:boolean,covered:long,longest:long,kept:boolean,spans:array<struct<start:long,end:long>>>")


def suffix_ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... symbols; in the last, all differ.

    A rank is the place of the first suffix of a tied group.  No two suffixes may tie up to the
    end of ``symbols``: each text ends in a mark of its own.
    """
    order = np.argsort(symbols, kind="stable")
    in_order = symbols[order]
    place = np.arange(len(symbols))
    first = np.maximum.accumulate(np.where(np.r_[True, in_order[1:] != in_order[:-1]], place, 0))
    rank = np.empty(len(symbols), np.int64)
    rank[order] = first
    levels, length = [rank], 1
    sizes = np.bincount(rank, minlength=len(rank))
    tied = np.flatnonzero(sizes[rank] > 1)
    while len(tied):
        old = levels[-1]
        key = old[tied] * len(symbols) + old[tied + length]
        order = np.argsort(key)
        key, tied = key[order], tied[order]
        group = old[tied]
        place = np.arange(len(tied))
        old_first = np.maximum.accumulate(np.where(np.r_[True, group[1:] != group[:-1]], place, 0))
        new_group = np.r_[True, key[1:] != key[:-1]]
        new_first = np.maximum.accumulate(np.where(new_group, place, 0))
        rank = old.copy()
        rank[tied] = group + new_first - old_first
        levels.append(rank)
        alone = new_group & np.r_[new_group[1:], True]
        tied = tied[~alone]
        length *= 2
    return levels


def longest_repeats(symbols: np.ndarray) -> np.ndarray:
    """For each position, the length of the longest substring from there that occurs elsewhere too."""
    levels = suffix_ranks(symbols)
    suffixes = np.empty(len(symbols), np.int64)
    suffixes[levels[-1]] = np.arange(len(symbols))
    a, b = suffixes[:-1], suffixes[1:]
    near = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[near], b[near]
    common = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        common += (levels[k][a + common] == levels[k][b + common]).astype(np.int64) << k
    best = np.zeros(len(symbols), np.int64)
    best[a] = common
    best[b] = np.maximum(best[b], common)  # a suffix is a and b of one pair each at most
    return best


def _covered(best: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie in repeats of ``least`` symbols or more."""
    at = np.flatnonzero(best >= least)
    steps = np.bincount(at, minlength=len(best) + 1) - np.bincount(at + best[at], minlength=len(best) + 1)
    return np.cumsum(steps[:-1]) > 0


def _judge(texts: list[str], min_words: int, max_covered: float, max_longest: int, with_spans: bool) -> Iterator[dict]:
    numbered, symbols, counts, results = 0, [], [], []
    for text in texts:
        data = text.encode()
        words, known = data.split(), {}
        symbols += [numbered + known.setdefault(w, len(known)) for w in words]
        numbered += len(known)
        symbols.append(numbered)  # the end mark
        numbered += 1
        counts.append(len(words) + 1)
        lines = [x for x in data.split(b"\n") if x.strip(SPACE)]
        results.append({"n_words": len(words),
                        "word_chars": len(text) - len(data) + len(data.translate(None, SPACE)),
                        "n_symbols": len(data) - len(data.translate(None, SYMBOLS)),
                        "n_dup_lines": len(lines) - len(set(lines))})
    best = longest_repeats(np.array(symbols, np.int64))
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    five = np.add.reduceat(_covered(best, 5), starts, dtype=np.int64)
    inside = _covered(best, min_words)
    covered, longest = np.add.reduceat(inside, starts, dtype=np.int64), np.maximum.reduceat(best, starts)
    for i, r in enumerate(results):
        n, r["n_repeat_words"], r["covered"], r["longest"] = r["n_words"], int(five[i]), int(covered[i]), int(longest[i])
        r["base_failed"] = n < 10 or 100 * r["n_repeat_words"] > 20 * n
        r["kept"] = not r["base_failed"] and r["covered"] <= max_covered * n and r["longest"] <= max_longest
        r["spans"] = None
        if with_spans:
            own = best[starts[i]:starts[i] + n]
            at = np.flatnonzero((own >= min_words) & (np.r_[0, own[:-1]] <= own)) if n else []
            r["spans"] = [{"start": int(x), "end": int(x + own[x])} for x in at]
        yield r


def repetition(text: Column, min_words: int = 5, max_covered: float = 0.2, max_longest: int = 50,
               with_spans: bool = False) -> Column:
    """A struct of counts and the verdict ``kept`` for a column of texts.

    Words are runs of anything but ASCII white space.  ``n_words``; ``word_chars``: code points in
    words; ``n_symbols``: characters of ``#*$%&|<>``; ``n_dup_lines``: lines with a word that equal
    an earlier line; ``n_repeat_words``: words in windows of five that occur twice or more;
    ``base_failed``: under ten words, or over a fifth of them in such windows.  ``covered``: words in
    repeated substrings of ``min_words`` words or more; ``longest``: words of the longest repeated
    substring.  ``kept``: not ``base_failed``, at most the share ``max_covered`` covered and no
    repeat longer than ``max_longest``.  ``with_spans``: the occurrences of maximal repeated
    substrings of ``min_words`` or more, as word numbers, end exclusive (else null).

    A null text has no words, and like every text under ten words isn't kept.
    """
    return _of(min_words, max_covered, max_longest, with_spans)(text)


def _of(min_words: int, max_covered: float, max_longest: int, with_spans: bool):
    @arrow_udf(RESULT)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.struct([*((n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                          ("base_failed", pa.bool_()), ("covered", pa.int64()), ("longest", pa.int64()),
                          ("kept", pa.bool_()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
        for batch in batches:
            out, held, size = [], [], 0
            for part in slices(batch):
                for x in part:
                    held.append(x or "")
                    size += len(held[-1]) // 5
                    if size > AT_ONCE:
                        out += _judge(held, min_words, max_covered, max_longest, with_spans)
                        held, size = [], 0
            if held:
                out += _judge(held, min_words, max_covered, max_longest, with_spans)
            yield pa.array(out, kind)

    return judge.asNondeterministic()  # not to be evaluated twice
