"""Column functions on bases, CIGAR strings and per-base arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def reverse_complement(c: Column | str) -> Column:
    return F.reverse(F.translate(c, "ACGTN", "TGCAN"))


def pyrimidine(context: Column | str) -> Column:
    """A trinucleotide read from the strand whose middle base is C or T."""
    context = F.col(context) if isinstance(context, str) else context
    return F.when(F.substring(context, 2, 1).isin("C", "T"), context).otherwise(reverse_complement(context))


def canonical_pair(a: Column | str, b: Column | str) -> Column:
    """One barcode id if both are equal, else both in order, joined by '-'."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.when(a == b, a).otherwise(F.concat_ws("-", F.array_sort(F.array(a, b))))


def softclip(cigar: Column | str) -> Column:
    """Soft-clipped bases of a CIGAR string, both ends together; null for none."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(r"(\d+)S"), F.lit(1)), F.lit(0).cast("long"), lambda sum_, n: sum_ + n.cast("long"))


def rle_decode(pairs: Column | str) -> Column:
    """[length, value, length, value, ...] as one value for each base."""
    pairs = F.col(pairs) if isinstance(pairs, str) else pairs
    runs = F.transform(F.sequence(F.lit(0), F.floor(F.size(pairs) / 2).cast("int") - 1), lambda i: F.array_repeat(F.element_at(pairs, (2 * i + 2).cast("int")), F.element_at(pairs, (2 * i + 1).cast("int"))))
    return F.when(F.size(pairs) > 1, F.flatten(runs)).otherwise(F.slice(pairs, 1, 0))


def oriented(values: Column | str, strand: Column | str) -> Column:
    """A per-base array in reference order: reversed on the minus strand."""
    return F.when((F.col(strand) if isinstance(strand, str) else strand) == "-", F.reverse(values)).otherwise(F.col(values) if isinstance(values, str) else values)


KINDS = "MIDNSHP=X"
_KIND = np.full(256, -1, np.int8)
_KIND[list(KINDS.encode())] = range(len(KINDS))
_USES_QUERY, _USES_REFERENCE = (np.array([k in uses for k in KINDS]) for uses in ("MIS=X", "MDN=X"))


#: Kinds that pair bases of a read with bases of the reference.
ALIGNED = np.array([k in "M=X" for k in KINDS])


def steps(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, place from 0 in the row) of rows of ``size`` elements laid end to end."""
    row = np.repeat(np.arange(len(size)), size)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)


def sizes(lists: pa.Array) -> np.ndarray:
    return np.asarray(lists.value_lengths().fill_null(0), np.int64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the n + 1 offsets of its rows."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]], ends - ends[0]


_RANGE = T.StructType([T.StructField("op", T.StringType())] + [T.StructField(n, T.LongType()) for n in ("len", "q_start", "q_end", "r_start", "r_end")])


def operations(cigar: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All operations of a batch of CIGAR strings: (row, kind, length, query bases before, reference bases before); kind is a place in KINDS.

    Lengths are read digit by digit, places are running sums.
    """
    n, (raw, ends) = len(cigar), flat(cigar)
    digit = (raw >= 48) & (raw <= 57)
    known = _KIND[raw] >= 0
    known[1:] &= digit[:-1]
    known[ends[:-1][ends[:-1] < len(raw)]] = False  # no number before a string's first byte
    at = np.flatnonzero(known)
    row = np.searchsorted(ends, at, side="right") - 1
    size, more, k = np.zeros(len(at), np.int64), np.ones(len(at), bool), 0
    while True:
        more &= at - k - 1 >= ends[row]
        more[more] &= digit[at[more] - k - 1]
        if not more.any():
            break
        size[more] += (raw[at[more] - k - 1].astype(np.int64) - 48) * 10**k
        k += 1
    kind = _KIND[raw[at]]
    first = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n))))
    places = []
    for uses in (_USES_QUERY, _USES_REFERENCE):
        before = np.concatenate(([0], np.cumsum(np.where(uses[kind], size, 0))))
        places.append(before[:-1] - before[first[row]])
    return row, kind, size, *places


@F.arrow_udf(T.ArrayType(_RANGE))
def _ranges(cigar: pa.Array, start: pa.Array) -> pa.Array:
    row, kind, size, q, r = operations(cigar)
    begins = start.take(pa.array(row))
    q_used, r_used = (np.where(uses[kind], size, 0) for uses in (_USES_QUERY, _USES_REFERENCE))
    columns = [pa.array(list(KINDS)).take(pa.array(kind)), pa.array(size), pa.array(q + 1), pa.array(q + q_used), pc.add(begins, pa.array(r)), pc.add(begins, pa.array(r + r_used - 1))]
    values = pa.StructArray.from_arrays(columns, names=["op", "len", "q_start", "q_end", "r_start", "r_end"])
    first = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(cigar)))))
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), values, mask=cigar.is_null())


def cigar_ranges(cigar: Column | str, start: Column | str) -> Column:
    """Array of (op, len, q_start, q_end, r_start, r_end) of a CIGAR string aligned at ``start``; all 1-based.

    Operations that use no query bases have q_end = q_start - 1, those that use no reference bases r_end = r_start - 1.
    Null for a null string, empty where nothing is an operation.
    """
    start = F.col(start) if isinstance(start, str) else start
    return _ranges(cigar, start.cast("long"))


def at_least(values: Column | str, least: float) -> Column:
    """Array of (v, q): an array's values of at least ``least`` and their places from 1; null for a null array, NaN counts as greatest."""

    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField("v", T.DoubleType()), T.StructField("q", T.LongType())])))
    def high(values: pa.Array) -> pa.Array:
        ends = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64))))
        each = values.flatten().cast(pa.float64())
        at = np.flatnonzero(pc.fill_null(pc.or_(pc.greater_equal(each, least), pc.is_nan(each)), False).to_numpy(zero_copy_only=False))
        row = np.searchsorted(ends, at, side="right") - 1
        found = pa.StructArray.from_arrays([each.take(pa.array(at)), pa.array(at - ends[row] + 1)], names=["v", "q"])
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(at, ends).astype(np.int32)), found, mask=values.is_null())

    return high(values)


def reference_length(cigar: Column | str) -> Column:
    """Reference bases under a CIGAR string."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1)), F.lit(0).cast("long"), lambda sum_, n: sum_ + n.cast("long"))


def array_passes(x: Column | str, limit: float, mode: str) -> Column:
    """mean, all or any of an array's values >= limit; null for a null or empty array."""
    x = F.col(x) if isinstance(x, str) else x
    test = {"all": F.forall(x, lambda v: v >= limit), "any": F.exists(x, lambda v: v >= limit), "mean": F.aggregate(x, F.lit(0.0), lambda a, v: a + v) / F.size(x) >= limit}
    if mode not in test:
        raise ValueError(f"mode {mode!r} is none of mean, all, any")
    return F.when(F.size(x) > 0, test[mode])
