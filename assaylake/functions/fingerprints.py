"""Token counts and similarity as JVM expressions, hashed k-gram fingerprints by Arrow batches."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import md5
from math import sin
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Standard atomic weights of the counted elements.
ATOM_MASS = {
    "C": 12.011, "N": 14.007, "O": 15.999, "S": 32.06, "P": 30.974,
    "F": 18.998, "Cl": 35.45, "Br": 79.904, "I": 126.904, "B": 10.81,
}

# C and B are counted as "C or Cl" minus "Cl" because neither engine's pattern needs look-ahead then
_TOKENS = {"C": "Cl|C|c", "N": "N|n", "O": "O|o", "S": "S|s", "P": "P|p", "F": "F", "I": "I", "B": "Br|B|b"}


def token_profile(c: Column) -> Column:
    """struct of element counts, ring closures, branches, heavy atoms and their mass."""
    n_cl, n_br = F.regexp_count(c, F.lit("Cl")), F.regexp_count(c, F.lit("Br"))
    counts = {name: F.regexp_count(c, F.lit(p)) for name, p in _TOKENS.items()}
    counts["C"] = counts["C"] - n_cl
    counts["B"] = counts["B"] - n_br
    counts["Cl"], counts["Br"] = n_cl, n_br
    heavy = sum(counts.values(), F.lit(0))
    mass = sum((n * F.lit(ATOM_MASS[name]) for name, n in counts.items()), F.lit(0.0))
    return F.struct(
        *[n.cast("int").alias(f"n_{name.lower()}") for name, n in counts.items()],
        F.regexp_count(c, F.lit(r"%[0-9][0-9]|[0-9]")).cast("int").alias("n_ring_marks"),
        F.regexp_count(c, F.lit(r"\(")).cast("int").alias("n_branches"),
        heavy.cast("int").alias("n_heavy"),
        mass.alias("mass"),
    )


def grams(c: Column, k: int) -> Column:
    """All overlapping character k-grams of the whole text, in one linear pass.

    The look-ahead captures k characters at each position; a substring per position would rescan
    the text from its start every time.
    """
    return F.regexp_extract_all(c, F.lit("(?s)(?=(.{%d}))." % k), F.lit(1))


BLOCK_CHARS = 1 << 20  # texts are hashed together up to so many characters; a longer text is a block of its own
_TABLE = 1 << 24  # keys up to this are told apart by a table, others by sorting


def _distinct(key: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct key, the number of each key's distinct one) for keys below ``top``."""
    if top > _TABLE:
        _, first, at = np.unique(key, return_index=True, return_inverse=True)
        return first, at
    place = np.full(top, -1, dtype=np.int64)
    place[key] = np.arange(len(key))
    found = np.flatnonzero(place >= 0)
    number = np.empty(top, dtype=np.int64)
    number[found] = np.arange(len(found))
    return place[found], number[key]


_MD5_TURNS = [t for turns in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for t in turns * 4]
_MD5_SINES = [int(abs(sin(i + 1)) * (1 << 32)) for i in range(64)]
_MD5_CHUNK = 1 << 16  # messages hashed at once: the numbers of the rounds stay in the cache


def _md5_of_words(words: dict[int, np.ndarray], n_bytes: int) -> np.ndarray:
    """The first 32 bits of the md5 of messages of one length, up to 55 bytes, given as little-endian words with the end mark."""
    n = len(words[0])
    out = np.empty(n, dtype=np.uint32)
    chunk = -(-n // max(1, -(-n // _MD5_CHUNK)))  # no short rest: a call costs as much as thousands of numbers
    buffers = np.empty((5, chunk), dtype=np.uint32)
    for at in range(0, n, max(1, chunk)):
        some = {g: w[at:at + chunk] for g, w in words.items()} | {14: np.uint32(8 * n_bytes)}
        a, b, c, d, mixed = buffers[:, :len(some[0])]
        for x, start in zip((a, b, c, d), (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476), strict=True):
            x[:] = start
        for i in range(61):  # the last three rounds do not reach the first word
            if i < 16:
                np.bitwise_xor(c, d, out=mixed)
                mixed &= b
                mixed ^= d
                g = i
            elif i < 32:
                np.bitwise_xor(b, c, out=mixed)
                mixed &= d
                mixed ^= c
                g = (5 * i + 1) % 16
            elif i < 48:
                np.bitwise_xor(b, c, out=mixed)
                mixed ^= d
                g = (3 * i + 5) % 16
            else:
                np.invert(d, out=mixed)
                mixed |= b
                mixed ^= c
                g = 7 * i % 16
            mixed += a
            mixed += np.uint32(_MD5_SINES[i])
            if g in some:
                mixed += some[g]
            np.left_shift(mixed, np.uint32(_MD5_TURNS[i]), out=a)
            mixed >>= np.uint32(32 - _MD5_TURNS[i])
            a |= mixed
            a += b
            a, b, c, d = d, a, b, c
        np.add(b, np.uint32(0x67452301), out=out[at:at + chunk])
    return out.byteswap()


def md5_heads(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The first 32 bits of the md5 of messages of 8 bytes, given as two little-endian words each."""
    return _md5_of_words({0: low, 1: high, 2: np.full(len(low), 0x80, dtype=np.uint32)}, 8)


_KNOWN_BITS = 20  # the hashes of a million grams are kept in a process: 12 MB
_KNOWN_CHUNK = 1 << 17  # grams asked at once, so that the next ones find what these left
_known: list[np.ndarray] = []


def _known_heads(key: np.ndarray) -> np.ndarray:
    """``md5_heads`` of grams of 8 ASCII letters as numbers; those met lately are looked up."""
    if not _known:
        _known.extend((np.full(1 << _KNOWN_BITS, np.uint64(0xFFFFFFFFFFFFFFFF)), np.zeros(1 << _KNOWN_BITS, dtype=np.uint32)))
    keys, heads = _known
    out = np.empty(len(key), dtype=np.uint32)
    for at in range(0, len(key), _KNOWN_CHUNK):
        some = key[at:at + _KNOWN_CHUNK]
        slot = (some * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _KNOWN_BITS)).view(np.int64)
        found = heads[slot]
        new = np.flatnonzero(keys[slot] != some)
        fresh, first = some[new], slot[new]
        found[new] = heads[first] = md5_heads(fresh.astype(np.uint32), (fresh >> np.uint64(32)).astype(np.uint32))
        keys[first] = fresh
        out[at:at + _KNOWN_CHUNK] = found
    return out


def _hashed_grams(joined: str, at: np.ndarray, k: int) -> np.ndarray:
    """The 32 bits of the gram at each of these places; grams of 8 letters are hashed as numbers, of others each distinct one once."""
    if k != 8:
        return _hashed_once(joined, np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32), at, k)
    raw = joined.encode()
    letter = np.frombuffer(raw + bytes(40), dtype=np.uint8)
    eight = np.empty(len(raw) + 32, dtype=np.uint64)  # the 8 bytes from each on
    for j in range(8):
        eight[j::8] = letter[j:j + len(eight[j::8]) * 8].view("<u8")
    if len(raw) == len(joined):
        return _known_heads(eight[at])
    begin = np.append(np.flatnonzero((letter[:len(raw)] & 0xC0) != 0x80), len(raw))
    length = (begin[8:] - begin[:-8]).astype(np.uint8)[at]
    first = begin[at]
    out, plain = np.empty(len(at), dtype=np.uint32), length == 8
    out[plain] = _known_heads(eight[first[plain]])
    for n in (np.flatnonzero(np.bincount(length)[9:]) + 9).tolist():
        of = np.flatnonzero(length == n)
        words = {j: eight[first[of] + 4 * j].astype(np.uint32) for j in range(n // 4 + 1)}
        words[n // 4] = words[n // 4] & np.uint32((1 << 8 * (n % 4)) - 1) | np.uint32(0x80 << 8 * (n % 4))
        out[of] = _md5_of_words(words, n)
    return out


def _hashed_once(joined: str, code: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    known = np.zeros(int(code.max()) + 1, dtype=np.int64)
    known[code] = 1
    letters = int(known.sum())
    symbol = (np.cumsum(known) - 1)[code]
    key, top = np.zeros(len(at), dtype=np.int64), 1
    for j in range(k):
        if top * letters >= 1 << 62:  # numbers in place of long keys: exact for any alphabet
            first, key = _distinct(key, top)
            top = len(first)
        key, top = key * letters + symbol[at + j], top * letters
    first, which = _distinct(key, top)
    digests = b"".join(md5(joined[i:i + k].encode(), usedforsecurity=False).digest()[:4] for i in at[first].tolist())
    return np.frombuffer(digests, dtype=">u4").astype(np.uint32)[which]


def _block_bits(texts: list[str], n_bits: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of set bits of each text, the bits text by text and sorted)."""
    joined = "".join(texts)
    length = np.array([len(t) for t in texts], dtype=np.int64)
    per = np.maximum(length - k + 1, 0)
    ends = np.cumsum(per)
    at = np.arange(per.sum()) + np.repeat(np.cumsum(length) - length - (ends - per), per)
    if not len(at):
        return per, np.zeros(0, dtype=np.int32)
    bit = _hashed_grams(joined, at, k).astype(np.int64) % n_bits
    if len(texts) * n_bits <= _TABLE:
        held = np.zeros(len(texts) * n_bits, dtype=bool)
        held[np.repeat(np.arange(len(texts)), per) * n_bits + bit] = True
        packed = np.flatnonzero(held)
        return np.bincount(packed // n_bits, minlength=len(texts)), (packed % n_bits).astype(np.int32)
    bit = bit.astype(np.int32)
    for i, j in zip((ends - per).tolist(), ends.tolist(), strict=True):
        bit[i:j].sort()
    kept = np.concatenate([[True], bit[1:] != bit[:-1]])
    kept[(ends - per)[per > 0]] = True
    found = np.concatenate([[0], np.cumsum(kept)])
    return found[ends] - found[ends - per], bit[kept]


def text_bits(texts: pa.Array, n_bits: int, k: int) -> pa.Array:
    """The fingerprints of a batch of texts; each distinct k-gram of a block is hashed once."""
    sizes, bits, block, chars = [], [], [], 0

    def close() -> None:
        n, found = _block_bits(block, n_bits, k)
        sizes.append(n)
        bits.append(found)
        block.clear()

    for t in texts.cast(pa.large_binary()).to_pylist():
        block.append((t or b"").decode(errors="replace"))
        chars += len(block[-1])
        if chars >= BLOCK_CHARS:
            close()
            chars = 0
    close()
    ends = np.cumsum(np.concatenate([[0], *sizes]))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(bits)), mask=texts.is_null())


class Made(NamedTuple):
    """Sets as what they are made of and how, for operators that make them in their own pass and never move them whole."""

    of: Column
    make: Callable[[pa.Array], pa.Array]


def fingerprint_of(c: Column, n_bits: int = 1 << 31, k: int = 8) -> Made:
    """What ``fingerprint`` gives, unmade."""
    return Made(c.cast("string"), lambda texts: text_bits(texts, n_bits, k))


def fingerprint(c: Column, n_bits: int = 1 << 31, k: int = 8) -> Column:
    """Sorted distinct set bits: the first 32 bits of the md5 of each k-gram, folded into ``n_bits``."""

    def bits(texts: pa.Array) -> pa.Array:
        return text_bits(texts, n_bits, k)

    bits.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(bits, "array<int>")(c.cast("string"))


def set_bits(vector: Column) -> Column:
    """Positions of a numeric vector that hold a positive value."""
    marked = F.transform(vector, lambda x, i: F.when(x > 0, i))
    return F.array_compact(marked)


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def tanimoto(a: Column, b: Column) -> Column:
    """|a∩b| / |a∪b| of two bit sets; two empty sets have similarity 0."""
    both = overlap(a, b)
    union = F.size(a) + F.size(b) - both
    return F.when(union > 0, both.cast("double") / union.cast("double")).otherwise(0.0)
