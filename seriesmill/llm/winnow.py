"""Document fingerprints by winnowing, from SQL functions only.

Every k-gram of code points has a rolling hash; of each window of w hashes the smallest is
selected, the rightmost on ties, with its position.  Texts that share w + k - 1 code points
share a selected hash.

The hash is a shift-xor polynomial over codes of up to four characters.  SQL has no running
state, so neighbouring sums are joined instead of updating one sum: H over 2m characters
is H over m, shifted, plus H over m of the next m characters; every hash is shared by all
grams it lies in.  k and w are powers of two; each step is one pass over the array.

Defined results
    null counts as the empty text; no characters give an empty fingerprint; a text of fewer
    than k characters is one gram; fewer than w grams are one window; hashes have 33 bits;
    positions count code points from 0 and may go up to 2^31 - 1.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

K, WINDOW = 16, 32
LAST = (1 << 31) - 1


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often the body uses it, and not copied."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda a, _: a, body)


def _later(a: Column, m: int, kind: str = "bigint") -> Column:
    """The array moved by m places to the right."""
    return F.flatten(F.array(F.array(*[F.lit(None)] * m).cast(f"array<{kind}>"), a)) if m else a


def _codes(first: int) -> Callable[[Column], Column]:
    """Hashes of ``first`` characters, at the last of them."""
    def moved(a: Column, m: int, seen: list[Column]) -> Column:
        if m:
            return bound(_later(a, m, "string"), lambda b: moved(a, m - 1, [*seen, b]))
        return F.transform(a, lambda c, i: F.xxhash64(*[F.get(b, i) for b in seen], c))
    return lambda a: moved(a, first - 1, [])


def _longer(m: int) -> Callable[[Column], Column]:
    """From hashes over m characters to hashes over 2m, at their last characters."""
    return lambda a: F.zip_with(_later(a, m), a, lambda x, y: F.shiftleft(x, m).bitwiseXOR(y))


def _wider(m: int) -> Callable[[Column], Column]:
    """From least values of m neighbours to least values of 2m, at the last one; neighbours before the start do not count."""
    return lambda a: F.zip_with(_later(a, m), a, lambda x, y: F.least(x, y))


def _packed(code: Column, position: Column) -> Column:
    """The hash above, below it the position counted from the end: the least value is rightmost."""
    return code.bitwiseOR(F.lit(LAST).cast("long")).bitwiseXOR(position)


def winnowed(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """Selected grams as packed longs, by position; see ``hashes`` and ``positions``.

    Grams and windows are found at their last characters, by joining an array with itself moved to the right:
    adding to an index, or copying an array, costs more than the hashes do.
    """
    if k & (k - 1) or window & (window - 1) or not 1 <= k <= 32:
        raise ValueError("k (32 at most) and window must be powers of two")
    whole = F.coalesce(text, F.lit(""))
    n = F.char_length(whole)
    first = min(k, 4)
    least = bound(F.split(whole, ""), _codes(first))
    m = first
    while m < k:
        least = bound(least, _longer(m))
        m *= 2
    # no gram ends before the k-th character: no position there, thus no value
    least = F.zip_with(least, _later(F.sequence(F.lit(0).cast("long"), F.greatest(n - 1, F.lit(0)).cast("long")), k - 1), _packed)
    m = 1
    while m < window:
        least = bound(least, _wider(m))
        m *= 2
    # a text with less than one full window has one, which ends with the text
    windows = F.greatest(n - (k + window - 2), F.lit(1))
    selected = F.array_distinct(F.slice(least, F.greatest(F.least(F.lit(k + window - 1), n), F.lit(1)), windows))
    return (F.when(n == 0, F.array().cast("array<bigint>"))
            .when(n < k, F.array(_packed(F.xxhash64(whole), F.lit(0).cast("long"))))
            .otherwise(selected))


def hashes(packed: Column) -> Column:
    """The selected hashes by position, repeats included: 32 bits of the 33 that were compared."""
    return F.transform(packed, lambda x: F.shiftright(x, 32).cast("int"))


def positions(packed: Column) -> Column:
    """Where each selected gram starts, in code points."""
    return F.transform(packed, lambda x: (F.lit(LAST).cast("long") - x.bitwiseAND(F.lit(LAST).cast("long"))).cast("int"))


def settled_by(length: Column, k: int = K, window: int = WINDOW) -> Column:
    """The last position whose selection depends on the first ``length`` characters alone; negative if none."""
    return length - F.lit(k + window - 1)


def amended_packed(before: Column, unchanged: Column, text: Column, k: int = K, window: int = WINDOW) -> Column:
    """Selected grams of ``text``, which begins like an earlier text whose grams are known.

    ``unchanged`` is how many first characters are the same, ``before`` the earlier text's packed grams
    at positions up to ``settled_by(unchanged)``.  They stay; only the windows that reach
    beyond the unchanged part are looked at.  Equal to ``winnowed(text)``.
    """
    last = settled_by(unchanged, k, window)
    start = F.greatest(last - (window - 2), F.lit(0))
    tail = winnowed(F.substring(text, start + 1, F.char_length(text) - start), k, window)
    later = F.filter(tail, lambda x: F.lit(LAST).cast("long") - x.bitwiseAND(F.lit(LAST).cast("long")) > last - start)
    return F.concat(before, F.transform(later, lambda x: x - start.cast("long")))  # positions count from the end


def amended(before: Column, unchanged: Column, text: Column, k: int = K, window: int = WINDOW) -> Column:
    """The hashes of ``amended_packed``, with ``before`` as hashes: equal to ``hashes(winnowed(text))``."""
    none = F.array().cast("array<bigint>")
    return F.concat(before, hashes(amended_packed(none, unchanged, text, k, window)))


def carried(packed: Column, n: Column, unchanged: Column, k: int = K, window: int = WINDOW) -> Column:
    """A fingerprint for a shuffle, in six bytes a gram instead of eight: ``h`` hashes, positions as ``near`` (16 bits)
    where all ``n`` characters have such positions, else as ``far``, and ``stay``: how many grams ``unchanged`` characters settle.
    """
    last = F.lit(LAST).cast("long")
    least = last - settled_by(unchanged, k, window).cast("long")  # positions count from the end
    return F.struct(
        hashes(packed).alias("h"), F.when(n <= 32_768, F.transform(packed, lambda x: (last - x.bitwiseAND(last)).cast("smallint"))).alias("near"),
        F.when(n > 32_768, positions(packed)).alias("far"),
        F.size(F.filter(packed, lambda x: x.bitwiseAND(last) >= least)).alias("stay"))


def places(sent: Column) -> Column:
    """The positions of a ``carried`` fingerprint."""
    return F.coalesce(sent["near"].cast("array<int>"), sent["far"])


def written(packed: Column) -> Column:
    """A fingerprint as text: ``hash:position`` of every selected gram, by position."""
    return spelled(hashes(packed), positions(packed))


def spelled(hashes: Column, positions: Column) -> Column:
    """``written`` from hashes and positions."""
    return F.array_join(F.zip_with(hashes, positions, lambda h, p: F.concat_ws(":", h, p)), " ")


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes among all hashes of two fingerprints; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)
