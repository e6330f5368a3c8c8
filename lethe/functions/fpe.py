"""Format-preserving encryption of texts and whole numbers.

A Feistel network over the characters that belong to an
alphabet, in the manner of FFX. It is not the certified FF1 mode, and short values are weak: a domain of n values hides
at most among n. Characters outside the alphabet keep their place.

Whole numbers of up to 64 bits are built-in expressions: keyed SHA-256 in the rounds, on a
rectangle that has exactly as many cells as there are numbers of the size. Texts are built-in expressions as well: two
halves of their characters, each in turn shifted modulo the alphabet by a key stream of SHA-256 slices of the other. Wide
decimals have no JVM function for their arithmetic, so they run as an Arrow UDF, with
keyed BLAKE2b; each batch computes every distinct value once.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DecimalType, IntegerType, LongType, ShortType, StringType

from lethe.functions import prf
from lethe.functions.text import let

ROUNDS = 10
#: Numbers of a key stream that one hash gives.
STREAM_PER_HASH = 3 * prf.SLICES
NUMBER_BITS = 4 * prf.SLICE_DIGITS // 3

DIGITS = "0123456789"
# The text alphabet is Latin letters of both cases with accents,
# punctuation, digits and five further signs.
LATIN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
ACCENTED = "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖŒÙÚÛÜÝŸàáâãäåæçèéêëìíîïñòóôõöœùúûüýÿ"
PUNCTUATION = " .,;:!?'\"()-_&@"
FURTHER_SIGNS = "%=+/`"
TEXT_ALPHABET = LATIN + ACCENTED + PUNCTUATION + DIGITS + FURTHER_SIGNS

_LARGEST = {ByteType: 2**7 - 1, ShortType: 2**15 - 1, IntegerType: 2**31 - 1, LongType: 2**63 - 1}


def _round_value(key: bytes, label: str, half: int, modulus: int) -> int:
    """Keyed number below the modulus, from at least 64 bits more than it needs."""
    message = label.encode() + half.to_bytes(half.bit_length() // 8 + 1)
    wanted = modulus.bit_length() // 8 + 9
    if wanted <= 64:
        return int.from_bytes(hashlib.blake2b(message, key=key, digest_size=wanted).digest()) % modulus
    blocks = [
        hashlib.blake2b(message + b"|%d" % i, key=key, digest_size=64).digest() for i in range(-(-wanted // 64))
    ]
    return int.from_bytes(b"".join(blocks)[:wanted]) % modulus


def _permute(number: int, sizes: tuple[int, int], label: str, key: bytes, forward: bool) -> int:
    """Keyed permutation of the numbers below sizes[0] * sizes[1]."""
    if sizes[0] == 1:
        shift = _round_value(key, f"{label}|shift", 0, sizes[1])
        return (number + (shift if forward else -shift)) % sizes[1]
    a, b = divmod(number, sizes[1])
    if forward:
        for i in range(ROUNDS):
            size = sizes[i & 1]
            a, b = b, (a + _round_value(key, f"{label}|{i}|", b, size)) % size
    else:
        for i in reversed(range(ROUNDS)):
            size = sizes[i & 1]
            a, b = (b - _round_value(key, f"{label}|{i}|", a, size)) % size, a
    return a * sizes[1] + b


def translate_number(number: int, largest: int, key: bytes, forward: bool) -> int:
    """Permute the whole numbers with the same sign and digit count that fit the type.

    The numbers are laid out on a rectangle hardly larger than their count; the
    permutation is repeated while its result lies outside, which keeps it one-to-one.
    """
    size, sign = (-number, -1) if number < 0 else (number, 1)
    length = len(str(size))
    lowest = 0 if length == 1 and sign > 0 else 10 ** (length - 1)
    highest = min(10**length - 1, largest + 1 if sign < 0 else largest)
    count = highest - lowest + 1
    columns = math.isqrt(count - 1) + 1 if count > 10 else count
    sizes = (-(-count // columns), columns)
    offset = size - lowest
    while True:
        offset = _permute(offset, sizes, str(length * sign), key, forward)
        if offset < count:
            return sign * (lowest + offset)


def _factors(count: int) -> tuple[int, int]:
    """Two factors of a count, as close to each other as a short search finds."""
    if count % 10 == 0:
        lead, zeros = count, 0
        while lead % 10 == 0:
            lead, zeros = lead // 10, zeros + 1
        return lead * 10 ** (zeros // 2), 10 ** (zeros - zeros // 2)
    best = 1
    for divisor in range(1, min(math.isqrt(count), 1 << 20) + 1):
        if count % divisor == 0:
            best = divisor
    return best, count // best


def number_classes(largest: int, sign: int) -> list[tuple[int, int, int]]:
    """Classes of sizes that are permuted among themselves: the lowest of each, and two factors of its count.

    A class holds the numbers of one digit count; the last one, which the type cuts off, is split
    at its last full power, so that its rests are classes of their own.
    """
    top, classes, low = largest + (sign < 0), [], 0 if sign > 0 else 1
    while low <= top:
        length = len(str(max(low, 1)))
        high = 10**length - 1
        if high <= top:
            classes.append((low, *_factors(high - low + 1)))
        else:
            unit = 10 ** (length - 1)
            full = max(top // unit * unit, low)
            if full > low:
                classes.append((low, *_factors(full - low)))
            classes.append((full, *_factors(top - full + 1)))
        low = high + 1
    return classes


def _whole_number(value: Column, largest: int, derived_key: str, forward: bool) -> Column:
    """The permutation of ``number_classes`` as expressions.

    The state of the rounds carries what they need, so that nothing is looked up in a round.
    """
    value = value.cast("bigint")

    def of(sign: int) -> Column:
        classes = number_classes(largest, sign)
        # Negative sizes are compared and shifted as they are: the least long has no absolute value.
        def numbers(values: Sequence[int]) -> Column:
            return F.expr(f"array({', '.join(f'{n}L' for n in values)})")

        starts = numbers([sign * low for low, _, _ in classes])
        place = F.size(F.filter(starts, lambda low: (value >= low) if sign > 0 else (value <= low)))

        def with_class(c: Column) -> Column:
            return F.struct(
                c.alias("place"),
                F.element_at(starts, c).alias("low"),
                *[F.element_at(numbers([row[k] for row in classes]), c).alias(f"n{k}") for k in (1, 2)],
            )

        order = range(ROUNDS) if forward else reversed(range(ROUNDS))
        rounds = F.expr(f"array({', '.join(map(str, order))})")

        def state(a: Column, b: Column, s: Column) -> Column:
            return F.struct(a.alias("a"), b.alias("b"), s["n1"].alias("n1"), s["n2"].alias("n2"), s["label"].alias("label"))

        def drawn(s: Column, i: Column, half: Column) -> Column:
            text = F.concat_ws("|", s["label"], i.cast("string"), half.cast("string"))
            return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")

        def there(s: Column, i: Column) -> Column:
            size = F.when(i % 2 == 0, s["n1"]).otherwise(s["n2"])
            return state(s["b"], (s["a"] + drawn(s, i, s["b"]) % size) % size, s)

        def back(s: Column, i: Column) -> Column:
            size = F.when(i % 2 == 0, s["n1"]).otherwise(s["n2"])
            return state((s["b"] - drawn(s, i, s["a"]) % size + size) % size, s["a"], s)

        def moved(c: Column) -> Column:
            offset = sign * (value - c["low"])
            label = F.concat_ws("|", F.lit(derived_key), F.lit(str(sign)), c["place"].cast("string"))
            first = F.struct(
                F.call_function("div", offset, c["n2"]).alias("a"), (offset % c["n2"]).alias("b"),
                c["n1"].alias("n1"), c["n2"].alias("n2"), label.alias("label"))
            done = F.aggregate(rounds, first, there if forward else back)
            return let(done, lambda s: sign * (s["a"] * s["n2"] + s["b"])) + c["low"]

        return let(let(place, with_class), moved)

    return F.when(value >= 0, of(1)).when(value < 0, of(-1))


def _distinct(batch: pd.Series, change: Callable) -> pd.Series:
    """Apply a function to the distinct values of a batch; nulls stay."""
    codes, values = pd.factorize(batch)
    changed = [change(v) for v in values] + [None]
    return pd.Series([changed[c] for c in codes], index=batch.index, dtype="object")


def _stream(seed: Column, length: Column) -> Column:
    """Numbers of 20 bits, as many as asked for and up to 11 more, from hashes of a seed: three from each slice of 60 bits, the lowest bits first."""
    last = F.call_function("div", length - 1, F.lit(STREAM_PER_HASH)).cast("int")
    # As bytes, since a slice of a text is looked for from its start.
    hashes = F.transform(F.sequence(F.lit(0), last), lambda b: F.sha2(F.concat(seed, F.lit("|"), b.cast("string")), 256).cast("binary"))
    number = lambda h, i: F.conv(F.substring(h, prf.SLICE_DIGITS * i + 1, prf.SLICE_DIGITS).cast("string"), 16, 10).cast("bigint")
    numbers = lambda h: F.array(*[number(h, i) for i in range(prf.SLICES)])
    low = (1 << NUMBER_BITS) - 1
    parts = lambda p: F.array(p.bitwiseAND(low), F.shiftright(p, NUMBER_BITS).bitwiseAND(low), F.shiftright(p, 2 * NUMBER_BITS))
    return F.flatten(F.transform(F.flatten(F.transform(hashes, numbers)), parts))


def _shifted(half: Column, seed: Column, radix: int, forward: bool) -> Column:
    """A half, each rank moved by its number of the key stream of a seed."""
    # The streams are below 2 ** 20, so this multiple of the radix keeps the difference from being negative.
    above = ((1 << NUMBER_BITS) // radix + 1) * radix
    moved = lambda x, s: ((x + s) if forward else (x - s + above)) % radix
    digits = NUMBER_BITS // 4
    starts = [prf.SLICE_DIGITS * i + digits * k + 1 for i in range(prf.SLICES) for k in (2, 1, 0)]

    def short(h: Column) -> Column:
        """One hash is enough, and only the numbers that are needed are read from it."""
        places = F.array(*[F.lit(n) for n in starts])
        number = lambda j: F.conv(F.substring(h, F.get(places, j), F.lit(digits)), 16, 10).cast("bigint")
        return F.transform(half, lambda x, j: moved(x, number(j)))

    one = let(F.sha2(F.concat(seed, F.lit("|0")), 256), short)
    # By place, since cutting the stream to the half's size costs more than reading from it.
    long = lambda stream: F.transform(half, lambda x, j: moved(x, F.get(stream, j)))
    more = let(let(seed, lambda bound: _stream(bound, F.size(half))), long)
    return F.when(F.size(half) <= STREAM_PER_HASH, one).otherwise(more)


def _rounds(ranks: Column, radix: int, derived_key: str, forward: bool) -> Column:
    """Alternating Feistel rounds over an array of ranks: even ones move the first half by the second, odd ones the other way."""
    n = F.size(ranks)
    cut = F.call_function("div", n, F.lit(2)).cast("int")
    halves = [F.slice(ranks, F.lit(1), cut), F.slice(ranks, cut + 1, n - cut)]
    order = list(range(ROUNDS)) if forward else list(reversed(range(ROUNDS)))
    turn = order[0] % 2

    def step(s: Column, i: Column) -> Column:
        """The half whose turn it is moves, and next time it is the other one's."""
        bar = F.lit("|")
        seed = F.sha2(F.concat(F.lit(f"{derived_key}|"), n.cast("string"), bar, i, bar, s["other"].cast("string")), 256)
        return F.struct(s["other"].alias("own"), _shifted(s["own"], seed, radix, forward).alias("other"))

    start = F.struct(halves[turn].alias("own"), halves[1 - turn].alias("other"))
    done = F.aggregate(F.array(*[F.lit(str(i)) for i in order]), start, step)
    # The number of rounds is even.
    return let(done, lambda s: F.concat(*[s[name] for name in (("own", "other") if turn == 0 else ("other", "own"))]))


def text_column(value: Column, alphabet: str, derived_key: str, forward: bool) -> Column:
    """Encrypt or decrypt the characters of an alphabet, leaving the others in place; the work grows linearly with the length.

    The ranks of the characters run through ``_rounds``; each character hashes a few bytes in each round, so long texts need no blocks.
    """
    letters = F.array(*[F.lit(c) for c in alphabet])
    # By code point, since looking a character up in the alphabet would compare it with each.
    place = {ord(c): i for i, c in enumerate(alphabet)}
    table = F.expr(f"array({', '.join(f'{place.get(code, -1)}L' for code in range(max(place) + 1))})")
    # A rank that no character has: marks a place that keeps its own.
    outside = 1 << len(alphabet).bit_length()

    def spelled(chars: Column, ranks: Column) -> Column:
        def merged(moved: Column) -> Column:
            # Places and ranks in one number: of the alphabet's characters and of the others, in order of place again.
            inside = F.filter(F.transform(ranks, lambda r, i: F.when(r >= 0, i).otherwise(-1)), lambda i: i >= 0)
            rest = F.filter(F.transform(ranks, lambda r, i: F.when(r < 0, i.cast("bigint") * (2 * outside) + outside).otherwise(F.lit(-1).cast("bigint"))), lambda i: i >= 0)
            back = let(inside, lambda at: F.transform(moved, lambda r, k: F.get(at, k).cast("bigint") * (2 * outside) + r))
            placed = F.sort_array(F.concat(back, rest))
            char = lambda x, i: F.coalesce(F.get(letters, (x % (2 * outside)).cast("int")), F.get(chars, i))
            return F.array_join(F.transform(placed, char), "")

        def plain(moved: Column) -> Column:
            return F.array_join(F.transform(moved, lambda r: F.get(letters, r.cast("int"))), "")

        own = F.filter(ranks, lambda r: r >= 0)
        moved = let(own, lambda r: _rounds(r, len(alphabet), derived_key, forward))
        return let(moved, lambda m: F.when(F.size(m) == F.size(ranks), plain(m)).otherwise(merged(m)))

    def of(chars: Column) -> Column:
        ranks = F.transform(chars, lambda c: F.coalesce(F.get(table, F.ascii(c)), F.lit(-1).cast("bigint")))
        return let(ranks, lambda r: spelled(chars, r))

    # What is left of no characters is the empty text. Written so that it is known to be null only where the value is: a join
    # on the ciphers asks for that, and would encrypt every value once more to find out.
    return F.when(value.isNotNull(), F.coalesce(let(F.split(value, ""), of), F.lit("")))


def number_column(value: Column, dtype: DataType, derived_key: str, forward: bool) -> Column:
    """Digits of a text, or a whole number of the same digit count and type."""
    if isinstance(dtype, StringType):
        return text_column(value, DIGITS, derived_key, forward)
    if isinstance(dtype, DecimalType) and dtype.scale == 0:
        largest = 10**dtype.precision - 1
    elif type(dtype) in _LARGEST:
        return _whole_number(value, _LARGEST[type(dtype)], derived_key, forward).cast(dtype)
    else:
        raise ValueError(f"format-preserving encryption needs text or whole numbers, not {dtype.simpleString()}")
    key = bytes.fromhex(derived_key)

    @F.pandas_udf("string")
    def run(batch: pd.Series) -> pd.Series:
        return _distinct(batch, lambda v: str(translate_number(int(v), largest, key, forward)))

    return run(value.cast("string")).cast(dtype)
