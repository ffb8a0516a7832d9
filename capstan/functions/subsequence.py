"""Longest common subsequences of two token rows, inside Arrow UDFs.

A row of the dynamic-programming table is kept as the bits of one integer: bit
j is clear where the table grows between columns j and j+1 (the bit-vector
method of Crochemore, Iliopoulos, Pinzon and Reid, 2001). A whole row is then
updated by a few word-parallel operations, so whole texts stay affordable.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capstan.functions.slices import by_slices


def _rows(left, right):
    """Bit rows after each token of ``left``; the last one gives the length."""
    where = defaultdict(int)
    for position, token in enumerate(right):
        where[token] |= 1 << position
    full = (1 << len(right)) - 1
    row = full
    yield row
    for token in left:
        hits = row & where.get(token, 0)
        row = ((row + hits) | (row - hits)) & full
        yield row


def lcs_length(left, right) -> int:
    row = 0
    for row in _rows(left, right):
        pass
    return len(right) - row.bit_count()


def lcs_positions(reference, candidate) -> list[int]:
    """Positions in ``reference`` of one longest common subsequence.

    Walks back from the end; on a tie the walk moves up in the reference.
    """
    rows = list(_rows(reference, candidate))

    def length(i: int, j: int) -> int:
        return j - (rows[i] & ((1 << j) - 1)).bit_count()

    i, j, found = len(reference), len(candidate), []
    while i and j:
        if reference[i - 1] == candidate[j - 1]:
            found.append(i - 1)
            i, j = i - 1, j - 1
        elif length(i, j - 1) > length(i - 1, j):
            j -= 1
        else:
            i -= 1
    return found[::-1]


def summary_hits(reference_lines, candidate_lines) -> int:
    """Tokens of the union of line-wise subsequences, each side's tokens used once."""
    left_r = Counter(token for line in reference_lines for token in line)
    left_c = Counter(token for line in candidate_lines for token in line)
    having = defaultdict(set)
    for number, line in enumerate(candidate_lines):
        for token in line:
            having[token].add(number)
    hits = 0
    for line in reference_lines:
        # Lines that share no token add nothing to the union.
        sharing = set().union(*[having[token] for token in set(line) if token in having])
        union = set()
        for number in sharing:
            union.update(lcs_positions(line, candidate_lines[number]))
        for position in sorted(union):
            token = line[position]
            if left_c[token] > 0 and left_r[token] > 0:
                hits += 1
                left_c[token] -= 1
                left_r[token] -= 1
    return hits


@F.arrow_udf(T.IntegerType())
def _lcs(left: pa.Array, right: pa.Array) -> pa.Array:
    return by_slices(lambda a, b: list(map(lcs_length, a, b)), pa.int32(), left, right)


@F.arrow_udf(T.IntegerType())
def _summary(reference: pa.Array, candidate: pa.Array) -> pa.Array:
    return by_slices(lambda a, b: list(map(summary_hits, a, b)), pa.int32(), reference, candidate)


def lcs(left: Column | str, right: Column | str) -> Column:
    """Length of the longest common subsequence of two token arrays."""
    return _lcs(left, right)


def summary_lcs(reference: Column | str, candidate: Column | str) -> Column:
    """Union hits of two arrays of token lines."""
    return _summary(reference, candidate)
