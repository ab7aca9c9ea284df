"""Name normalisation, keyword classes and string similarity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGE_SPACE = r"(?U)^\s+|\s+$"
_SPACE_RUN = r"(?U)\s+"


def normalised_name(column: Column) -> Column:
    """Lower case, without white space at the ends (no-break spaces included)."""
    return F.lower(F.regexp_replace(column, _EDGE_SPACE, ""))


def sorted_tokens(column: Column) -> Column:
    """The words of the text in alphabetical order, joined by one blank."""
    words = F.split(F.regexp_replace(column, _EDGE_SPACE, ""), _SPACE_RUN)
    return F.array_join(F.array_sort(words), " ")


def characters(column: Column) -> Column:
    return F.split(column, "")


def common_subsequence_length(left: Column, right: Column) -> Column:
    """Length of the longest common subsequence of two texts.

    One fold over the characters of ``left`` carries a row of the usual table:
    element j is the best length against the first j characters of ``right``.
    """
    right_chars = characters(right)
    zero_row = F.transform(F.concat(F.array(F.lit("")), right_chars), lambda _: F.lit(0))

    def next_row(row: Column, char: Column) -> Column:
        def extend(acc: Column, other: Column) -> Column:
            j = F.size(acc)
            best = F.when(char == other, F.get(row, j - 1) + 1).otherwise(
                F.greatest(F.element_at(acc, -1), F.get(row, j))
            )
            return F.concat(acc, F.array(best))

        return F.aggregate(right_chars, F.array(F.lit(0)), extend)

    last_row = F.aggregate(characters(left), zero_row, next_row)
    return F.when(
        (F.length(left) == 0) | (F.length(right) == 0), F.lit(0)
    ).otherwise(F.element_at(last_row, -1))


# Texts up to this length have one bit per character in a bigint, the sign left free.
BITS = 62


def letters(column: Column) -> Column:
    """The different characters of a text."""
    return F.array_distinct(characters(column))


def letter_bits(column: Column) -> Column:
    """For each of :func:`letters`, the bits of the places it stands in."""
    places = characters(column)
    positions = F.sequence(F.lit(0), F.size(places) - 1)

    def bits(letter: Column) -> Column:
        def add(mask: Column, at: Column) -> Column:
            bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at)
            return F.when(F.get(places, at) == letter, mask.bitwiseOR(bit)).otherwise(mask)

        return F.aggregate(positions, F.lit(0).cast("bigint"), add)

    return F.when(F.length(column) <= BITS, F.transform(letters(column), bits))


def letter_set(column: Column) -> Column:
    """The different characters of a text as 64 bits, several characters to a bit.

    An insertion or deletion changes at most one bit, so two texts are at least as
    far apart as the number of bits they differ in.
    """

    def add(mask: Column, letter: Column) -> Column:
        place = F.pmod(F.hash(letter), F.lit(64))
        return mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))

    return F.aggregate(letters(column), F.lit(0).cast("bigint"), add)


def short_common_subsequence_length(
    left_length: Column, left_letters: Column, left_bits: Column, right: Column
) -> Column:
    """As :func:`common_subsequence_length`, for a left text of at most 62 characters.

    The table row is a bit set: a bit turns off where the length grows by one, so a
    whole row takes a handful of integer operations.
    """
    full = F.call_function("shiftleft", F.lit(1).cast("bigint"), left_length) - 1

    def places(letter: Column) -> Column:
        at = F.array_position(left_letters, letter).cast("int") - 1
        return F.coalesce(F.get(left_bits, at), F.lit(0).cast("bigint"))

    def next_row(row: Column, mask: Column) -> Column:
        moved = row + row.bitwiseAND(mask)
        return moved.bitwiseOR(row.bitwiseAND(F.bitwise_not(mask))).bitwiseAND(full)

    row = F.aggregate(F.transform(characters(right), places), full, next_row)
    return left_length - F.bit_count(row)


def indel_distance(left: Column, right: Column) -> Column:
    """Fewest insertions and deletions that turn one text into the other."""
    return F.length(left) + F.length(right) - 2 * common_subsequence_length(left, right)


def contains_any(column: Column, keywords: Sequence[str]) -> Column:
    """True where the text holds one of the keywords.

    Plain substring search: faster than an alternation of patterns, and keywords
    need no escaping.
    """
    return reduce(or_, [F.contains(column, F.lit(keyword)) for keyword in keywords], F.lit(False))


def first_class(column: Column, classes: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """The first class one of whose keywords occurs in the text, else ``default``.

    Give a column that is lowered already: as an expression it would be computed
    again for every keyword.
    """
    chain = None
    for name, keywords in classes:
        test = contains_any(column, keywords)
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    if chain is None:
        return F.lit(default)
    return chain.otherwise(F.lit(default))
