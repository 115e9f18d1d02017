"""Category sets as bit words: category number ``i`` of the vocabulary is bit ``i % 64`` of word ``i / 64``.

A basket is an ``array<bigint>`` of as many words as the vocabulary needs (or, for large
vocabularies, long rows of a word number and a word).  Sets of one basket are united by ``bit_or``, a
hash aggregate over fixed-width buffers, and two sets are compared by ``bit_count``: the counts
that the Jaccard distance needs (``functions.jaccard``) take a few machine instructions a word."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 64


def words_for(n_categories: int) -> int:
    return max(1, -(-n_categories // BITS))


def pack(indices: Iterable[int], n_words: int) -> list[int]:
    """Words (as signed 64-bit integers) of a set of category numbers."""
    words = [0] * n_words
    for i in indices:
        words[i // BITS] |= 1 << (i % BITS)
    return [w - (1 << BITS) if w >> (BITS - 1) else w for w in words]


def unpack(words: Sequence[int]) -> list[int]:
    return [BITS * k + b for k, w in enumerate(words) for b in range(BITS) if w >> b & 1]


def word_number(index: Column) -> Column:
    return F.shiftright(index, 6)


def bit_mask(index: Column) -> Column:
    """The bit of a category number within its word."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), index.bitwiseAND(F.lit(BITS - 1)).cast("int"))


def size(words: Column, n_words: int) -> Column:
    return reduce(add, [F.bit_count(F.get(words, F.lit(k))) for k in range(n_words)])


def overlap(a: Column, b: Column, n_words: int) -> Column:
    return reduce(add, [F.bit_count(F.get(a, F.lit(k)).bitwiseAND(F.get(b, F.lit(k)))) for k in range(n_words)])


def word_bits(word: Column) -> Column:
    """Numbers of the bits that are set in one word."""
    every = F.array(*[F.lit(b) for b in range(BITS)])
    return F.filter(every, lambda b: F.call_function("shiftright", word, b).bitwiseAND(F.lit(1)) == 1)


def set_bits(words: Column, n_words: int) -> Column:
    """Ascending category numbers of a set."""
    def numbers(k: int) -> Column:
        return F.transform(word_bits(F.get(words, F.lit(k))), lambda b: b + F.lit(BITS * k))
    return F.concat(*[numbers(k) for k in range(n_words)])


def names(words: Column, vocabulary: Sequence[str]) -> Column:
    """Names of a set in vocabulary order, row-local: the vocabulary is a literal of the plan, so this is for
    vocabularies that the driver holds anyway.  ``operators.encode.decode_words`` joins a table instead."""
    if not vocabulary:
        return F.array().cast("array<string>")
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(i // BITS).alias("word"), F.lit(pack([i % BITS], 1)[0]).cast("bigint").alias("mask"))
                      for i, name in enumerate(vocabulary)])
    held = F.filter(table, lambda x: F.get(words, x["word"]).bitwiseAND(x["mask"]) != 0)
    return F.transform(held, lambda x: x["name"])
