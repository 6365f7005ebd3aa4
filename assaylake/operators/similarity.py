"""Exact Tanimoto joins of bit sets that are never written whole.

A bit set is a sorted array of bit numbers, often many times larger than what it was made of, so every pass
computes the sets again and only what the step needs leaves its place. Tasks for pairs over a threshold get
``prefixes``, dealt by bits; true maxima are found in ``tiles``, block against block. Equal sets are one set: a text
that makes up a third of the rows joins once, and the pairs among its copies are never written out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from hashlib import md5
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.functions.fingerprints import Made
from assaylake.session import materialize, small_side

SPARE = 6  # percent of a set's bits that its prefix holds beyond the least that finds all partners
PART_BITS = 3 << 20  # about so many bits are joined in a task
ORDER_ROWS = 1 << 12  # rows in the mean whose bits say which bits are rare
ORDER_SLOTS = 22  # bits of the numbers by which bits are told apart there
BANDS = 16  # of sizes
MEMBER_PARTS = 16  # tasks that members go through
CELL = 1 << 10  # sets of a cluster whose pairs are counted together
PAIRS = 1 << 21  # pairs counted at once
TILE_BITS = 1 << 21  # bits of a tile
SLICE_BITS = 1 << 22  # bits, or letters they are made of, that a pass holds at once


class Sets(NamedTuple):
    """``source``: _id and what ``fp`` is computed of, when read; ``members``: (id, set_id, size) of all rows with a bit, written."""

    source: DataFrame
    fp: Column | Made
    members: DataFrame | None = None

    def rows(self) -> DataFrame:
        return _rows(self.source, self.fp)

    def make(self) -> Callable[[pa.Array], pa.Array] | None:
        return self.fp.make if isinstance(self.fp, Made) else None


def _rows(source: DataFrame, fp: Column | Made) -> DataFrame:
    """(id, fp), or in place of the sets what they are made of."""
    return source.select(F.col("_id").alias("id"), (fp.of if isinstance(fp, Made) else fp.cast("array<int>")).alias("fp"))


def _made(batches: Iterator[pa.RecordBatch], make: Callable[[pa.Array], pa.Array] | None) -> Iterator[pa.RecordBatch]:
    """The rows with their sets, few enough at once to fit in a task whatever the size of a batch."""
    for b in batches:
        fp = b.column("fp")
        size = np.asarray(pc.fill_null(pc.binary_length(fp) if make else pc.list_value_length(fp), 0)).astype(np.int64)
        of = np.cumsum(size) // SLICE_BITS
        cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])).tolist() if len(of) else []
        for i, j in zip(cuts, cuts[1:], strict=False):
            rows = b.slice(i, j - i)
            yield rows.set_column(b.schema.get_field_index("fp"), "fp", make(rows.column("fp"))) if make else rows


def _ratio(min_sim: float) -> Fraction:
    return Fraction(min_sim).limit_denominator(1_000_000)  # 2/3 is two thirds; whole numbers are compared


def _at_least(both: Column, size_a: Column, size_b: Column, min_sim: float) -> Column:
    union = size_a + size_b - both
    t = _ratio(min_sim)
    return both.cast("bigint") * F.lit(t.denominator) >= union.cast("bigint") * F.lit(t.numerator)


def _flat(fp: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places of the rows with a bit, their sizes, their bits)."""
    size = np.asarray(pc.fill_null(pc.list_value_length(fp), 0)).astype(np.int64)
    held = np.flatnonzero(size)
    return held, size[held], np.asarray(fp.flatten()).astype(np.int32)


def _names(size: np.ndarray, bits: np.ndarray) -> list[bytes]:
    ends = np.cumsum(size)
    return [md5(bits[e - n:e].tobytes(), usedforsecurity=False).digest() for n, e in zip(size.tolist(), ends.tolist(), strict=True)]


def _named(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        held, size, bits = _flat(b.column("fp"))
        cols = {"id": b.column("id").take(pa.array(held)), "set_id": pa.array(_names(size, bits), pa.binary()), "size": pa.array(size.astype(np.int32))}
        if whole:
            cols["fp"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(bits))
        yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def _with_names(rows: DataFrame, whole: bool, make: Callable[[pa.Array], pa.Array] | None) -> DataFrame:
    schema = f"id {rows.schema['id'].dataType.simpleString()}, set_id binary, size int" + (", fp array<int>" if whole else "")
    return rows.mapInArrow(lambda it: _named(_made(it, make), whole), schema)


def distinct_sets(df: DataFrame, id_col: str, fp: str | Column | Made) -> Sets:
    """The sets of a table; of their bits only a hash and the number are written, a set is known by its hash.

    ``fp`` may be an expression, such as a fingerprint of a text: rows are then chosen before their sets are computed.
    """
    sets = _sets(df, id_col, fp)
    return sets._replace(members=materialize(_with_names(sets.rows(), False, sets.make()), "members"))


def _sets(df: DataFrame, id_col: str, fp: str | Column | Made) -> Sets:
    return Sets(df.select(F.col(id_col).alias("_id"), "*"), F.col(fp) if isinstance(fp, str) else fp)


def _mix(x: np.ndarray) -> np.ndarray:
    """Another number of 32 bits for each number: no two numbers get the same."""
    x = x ^ (x >> np.uint32(16))
    x = x * np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def _least(size: np.ndarray, t: Fraction) -> np.ndarray:
    """Bits that a set shares at least with a partner."""
    return -(-size * t.numerator // t.denominator)


def _prefix(size: np.ndarray, t: Fraction) -> np.ndarray:
    """Length of the prefix of sets of these sizes."""
    least = _least(size, t)
    return size - least + np.clip(size * SPARE // 100, 1, least)


def _slots(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mixed = _mix(bits.view(np.uint32))
    return mixed, mixed >> np.uint32(32 - ORDER_SLOTS)


def _bands(size: np.ndarray, t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """(the lowest band a set is dealt to, the highest): those of its smaller partners and its own. A band spans a factor of four.

    A pair meets in the band of its smaller set. A band has parts for its own bits only, so a short set is not torn into
    so many parts that a single shared bit is all that is due in one.
    """
    band = lambda n: (np.frexp(n.astype(np.float64))[1] - 1) // 2
    return band(_least(size, t)), band(size)


def _seen(batches: Iterator[pa.RecordBatch], t: Fraction) -> Iterator[pa.RecordBatch]:
    seen, held = np.zeros(1 << ORDER_SLOTS, dtype=np.uint8), np.zeros(BANDS, dtype=np.int64)
    for b in batches:
        _, size, bits = _flat(b.column("fp"))
        low, high = _bands(size, t)
        for band in range(BANDS):
            held[band] += _prefix(size, t)[(low <= band) & (band <= high)].sum()
        at, n = np.unique(_slots(bits)[1], return_counts=True)
        seen[at] = np.minimum(seen[at] + n, 255)
    yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (held, seen)], ["held", "seen"])


def _rarity(sides: list[Sets], t: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """(a number for each slot of bits, larger where they are common; about how many bits the prefixes of a band hold).

    Bits of all sets are put in one order, rare ones first. Any order finds all pairs, so it may come from some rows:
    it only makes prefixes of bits that few sets share. The number of bits says how many parts a band gets.
    """
    rarity, bits = np.zeros(1 << ORDER_SLOTS, dtype=np.uint16), np.zeros(BANDS)
    for s in sides:
        share = min(1.0, ORDER_ROWS / max(1, s.source.count()))
        some = s.source.sample(share, 1) if share < 1 else s.source
        tasks = min(8, s.source.sparkSession.sparkContext.defaultParallelism)
        rows, make = _rows(some.repartition(tasks), s.fp).select("fp"), s.make()
        for x in rows.mapInArrow(lambda it, make=make: _seen(_made(it, make), t), "held binary, seen binary").collect():  # a row a task
            bits += np.frombuffer(x["held"], dtype=np.int64) / share
            rarity += np.frombuffer(x["seen"], dtype=np.uint8)
    return np.minimum(rarity, 255).astype(np.uint8), bits


def _scanned(batches: Iterator[pa.RecordBatch], t: Fraction, parts: np.ndarray, side: int, sides: int, rarity: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Of each batch the members, in parts below 0, and what the prefixes of its sets hold in a part, packed: names, sizes, counts, bits.

    ``parts``: the number of parts of each band.

    Bits are ordered by ``rarity``, then by ``_mix``, and the first of a set are its prefix. In a part a bit is kept as 24 bits
    of another number: two bits that look the same there add to a count that is an upper bound anyway. Names are
    the first 8 bytes of a set's: sets with one name there share its pairs until they are verified.
    """
    offset = np.cumsum(parts) - parts
    for b in batches:
        held, size, bits = _flat(b.column("fp"))
        if not len(size):
            continue
        names = np.frombuffer(b"".join(_names(size, bits)), dtype="V16")
        ids = [b.column("id").take(pa.array(held)) if i == side else pa.nulls(len(held), b.column(f"none_{i}").type) for i in range(sides)]
        none = pa.nulls(len(held), pa.binary())
        schema = ["part", "side", *[f"id_{i}" for i in range(sides)], "set_id", "size", "names", "sizes", "counts", "bits"]
        yield pa.RecordBatch.from_arrays([pa.array(-1 - np.arange(len(held)) % MEMBER_PARTS, pa.int32()), pa.array(np.full(len(held), side), pa.int32()), *ids,
                                          pa.array(names.tolist(), pa.binary()), pa.array(size.astype(np.int32)), none, none, none, none], schema)
        mixed, slot = _slots(bits)
        order = np.repeat(np.arange(len(size), dtype=np.uint32) << np.uint32(8), size)
        order |= rarity[slot]
        order = order.astype(np.uint64) << np.uint64(32) | mixed
        order.sort()
        order = order[_spans(_prefix(size, t), np.cumsum(size) - size)]
        row, number = order >> np.uint64(40), _mix(~order.astype(np.uint32))
        packed = row << np.uint64(24) | (number & np.uint32(0xFFFFFF))
        low, high = _bands(size, t)
        dealt = []
        for below in range(int((high - low).max()) + 1):
            some = (high - below >= low)[row.view(np.int64)]
            band = (high - below)[row[some].view(np.int64)]
            part = offset[band] + (number[some].astype(np.uint64) * parts[band].astype(np.uint64) >> np.uint64(32)).view(np.int64)
            dealt.append(part.view(np.uint64) << np.uint64(44) | packed[some])
        order = np.sort(np.concatenate(dealt))
        first = np.flatnonzero(np.concatenate([[True], order[1:] >> np.uint64(24) != order[:-1] >> np.uint64(24)]))
        end = np.append(first, len(order))
        count = np.diff(end).astype(np.int32)
        of_part, of_row = (order[first] >> np.uint64(44)).astype(np.int64), (order[first] >> np.uint64(24) & np.uint64(0xFFFFF)).astype(np.int64)
        packed = order.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
        cuts = np.flatnonzero(np.concatenate([[True], of_part[1:] != of_part[:-1], [True]]))
        short = np.ascontiguousarray(names.view("V8")[::2])
        out = [[short[of_row[i:j]].tobytes(), size[of_row[i:j]].astype(np.int32).tobytes(), _narrow(count[i:j]), packed[end[i]:end[j]].tobytes()]
               for i, j in zip(cuts, cuts[1:], strict=False)]
        none = [pa.nulls(len(out), x.type) for x in ids]
        yield pa.RecordBatch.from_arrays([pa.array(of_part[cuts[:-1]], pa.int32()), pa.array(np.full(len(out), side), pa.int32()), *none, pa.nulls(len(out), pa.binary()),
                                          pa.nulls(len(out), pa.int32()), *[pa.array(c, pa.binary()) for c in zip(*out, strict=True)]], schema)


def _narrow(count: np.ndarray) -> bytes:
    return count.astype(np.uint16 if count.max() < 1 << 16 else np.uint32).tobytes()


def _spans(count: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each entry, ``count`` of them."""
    return np.arange(count.sum()) + np.repeat(first - (np.cumsum(count) - count), count)


def part_pairs(side: np.ndarray, size: np.ndarray, count: np.ndarray, bits: np.ndarray, t: Fraction, two_sided: bool) -> np.ndarray:
    """Pairs of entries (rows of two) that may be partners by what a part holds of their prefixes; entries are sorted by size.

    Let c be the set of a pair whose prefix ends first. Sets that share ``need`` bits in all share at least
    ``need − (size_c − prefix_c)`` in their prefixes. Over the parts that sum is due in proportion to the bits of c
    somewhere, so a pair is kept where its count reaches ``due = (need − rest_c)·count_c / prefix_c`` for either of
    the two as c. Of c's bits, rare ones first, all but the last half of ``due`` are asked: they hold the other half of those it shares.
    """
    num, den = t.numerator, t.denominator
    entry = np.repeat(np.arange(len(size), dtype=np.int32), count)
    # by bit, by side, by size
    key = np.sort((bits.astype(np.uint64) << np.uint64(1) | side[entry].astype(np.uint64)) << np.uint64(32) | np.arange(len(bits), dtype=np.uint64))
    cuts = np.flatnonzero(np.concatenate([[True], key[1:] >> np.uint64(33) != key[:-1] >> np.uint64(33), [True]]))
    held = np.diff(cuts).astype(np.int32)  # sets that hold a bit; that of a single one is not shared and leaves here
    key = key[np.repeat(held > 1, held)]
    held = held[held > 1]
    if not len(key):
        return np.zeros((0, 2), dtype=np.int64)
    order = key.astype(np.uint32)
    shared_bit = np.zeros(len(bits), dtype=bool)
    shared_bit[order] = True
    order = (np.cumsum(shared_bit, dtype=np.int32) - 1)[order]
    entry = entry[shared_bit]
    kept = np.bincount(entry, minlength=len(size))
    first = np.cumsum(kept) - kept
    number = np.repeat(np.arange(len(held), dtype=np.int32), held)
    posting = entry[order]
    key = (number.astype(np.uint64) << np.uint64(1) | key >> np.uint64(32) & np.uint64(1)) << np.uint64(32) | posting.astype(np.uint64)
    held_by = np.empty(len(entry), dtype=np.int32)
    held_by[order] = np.repeat(held, held)
    place = _places(entry, first, kept, held_by)
    del held_by, shared_bit
    # what c may still share behind a place, asked in the order of the lists, so that neighbours are looked up together
    whole, rest, least = _prefix(size, t), size - _prefix(size, t), _least(size, t)
    behind = kept[posting] - place[order]
    share = np.minimum(1.0, (2 * behind - 1) / count[posting])  # due of c's prefix at most where the bit is asked
    most = np.floor((rest[posting] + whole[posting] * share) * ((num + den) / num) * (1 + 1e-12) + 1e-6).astype(np.int64) - size[posting]
    high = np.minimum(size[posting] * den // num, most)
    some = np.flatnonzero(high >= least[posting])
    del behind, share, most, place
    of, lists = posting[some], number[some].astype(np.uint64) << np.uint64(1)
    lists = (lists | (1 - side[of] if two_sided else side[of]).astype(np.uint64)) << np.uint64(32)
    below = np.searchsorted(size, np.arange(int(size[-1]) + 2))  # entries smaller than a size
    at = np.searchsorted(key, lists | below[least][of].astype(np.uint64))
    n_at = np.searchsorted(key, lists | below[np.minimum(high[some], size[-1]) + 1].astype(np.uint64)) - at
    del key, lists, high
    start, n = np.zeros(len(entry), dtype=np.int32), np.zeros(len(entry), dtype=np.int32)
    start[order[some]], n[order[some]] = at, n_at
    bit_of = np.empty(len(entry), dtype=np.int32)
    bit_of[order] = number
    asked = np.flatnonzero(n)
    of, start, n = entry[asked].astype(np.int64), start[asked], n[asked]
    del order, number, some, at, n_at, asked
    # a whole number of entries at once, so that each pair is counted in one go
    per_entry = np.bincount(of, weights=n, minlength=len(size)).astype(np.int64)
    block = np.cumsum(per_entry) // PAIRS
    found, held_by = [np.zeros((0, 2), dtype=np.int64)], None
    edges = np.searchsorted(of, np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])))
    for i, j in zip(edges, [*edges[1:], len(of)], strict=True):
        pair = np.repeat(of[i:j] << 32, n[i:j]) | posting[_spans(n[i:j], start[i:j])]
        if not len(pair):
            continue
        pair.sort()
        at = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        times = np.diff(np.append(at, len(pair)))
        c, other = pair[at] >> 32, pair[at] & 0xFFFFFFFF
        need = -(-num * (size[c] + size[other]) // (num + den))
        due = -(-(need - rest[c]) * count[c] // whole[c])
        good = (2 * times >= due) & (c != other)
        c, other = c[good], other[good]
        if not len(c):
            continue
        if held_by is None:
            held_by = np.sort(entry.astype(np.int64) << 32 | bit_of)
        # all bits of c against those of the other
        for x, y in zip(np.array_split(c, 1 + int(kept[c].sum()) // PAIRS), np.array_split(other, 1 + int(kept[c].sum()) // PAIRS), strict=True):
            wanted = np.repeat(y, kept[x]) << 32 | bit_of[_spans(kept[x], first[x])]
            shared = np.bincount(np.repeat(np.arange(len(x)), kept[x]), weights=_times(held_by, wanted), minlength=len(x)).astype(np.int64)
            need = -(-num * (size[x] + size[y]) // (num + den))
            enough = shared * whole[x] >= (need - rest[x]) * count[x]
            found.append(np.column_stack([x[enough], y[enough]]))
    return np.concatenate(found)


def _places(entry: np.ndarray, first: np.ndarray, count: np.ndarray, held: np.ndarray) -> np.ndarray:
    """The place of each bit among those of its entry, rare ones first."""
    low = int(count.max()).bit_length()
    top = (1 << 63 - low - len(count).bit_length()) - 1
    base = first.astype(np.int32)[entry]
    at = np.arange(len(entry), dtype=np.int32) - base
    order = np.sort((entry.astype(np.int64) * (top + 1) + np.minimum(held.astype(np.int64), top)) << low | at)
    order &= (1 << low) - 1
    place = np.empty(len(entry), dtype=np.int32)
    place[order + base] = at  # sorted rows stay with their entry
    return place


def _times(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """How often each wanted key is among the sorted keys."""
    return np.searchsorted(keys, wanted, side="right") - np.searchsorted(keys, wanted)


def _candidates(batches: Iterator[pa.RecordBatch], t: Fraction, sides: int) -> Iterator[pa.RecordBatch]:
    """Of a part the pairs of names that may be partners; members go through as they are."""
    kept = [*[f"id_{i}" for i in range(sides)], "set_id", "size"]
    names = ["side", *kept, "name_a", "name_b"]
    cols = [[], [], [], [], []]
    for b in batches:
        if b.column("part")[0].as_py() < 0:
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("side", *kept)] + [pa.nulls(b.num_rows, pa.binary())] * 2, names)
            continue
        none = [pa.nulls(0, b.column(c).type) for c in kept]
        for side, *blobs in zip(*[b.column(c).to_pylist() for c in ("side", "names", "sizes", "counts", "bits")], strict=True):
            ids, size = np.frombuffer(blobs[0], dtype=np.int64), np.frombuffer(blobs[1], dtype=np.int32)
            count = np.frombuffer(blobs[2], dtype=np.uint16 if len(blobs[2]) == 2 * len(ids) else np.uint32)
            packed = np.zeros((len(blobs[3]) // 3, 4), dtype=np.uint8)
            packed[:, :3] = np.frombuffer(blobs[3], dtype=np.uint8).reshape(-1, 3)
            for col, x in zip(cols, (np.full(len(ids), side), ids, size.astype(np.int64), count.astype(np.int64), packed.reshape(-1).view("<u4")), strict=True):
                col.append(x)
    if not cols[0]:
        return
    side, ids, size, count, bits = (np.concatenate(c) for c in cols)
    cols.clear()
    # copies of a set have the same bits here; sets that share but a name are told apart by them
    ends = np.cumsum(count)
    total = np.add.reduceat(_mix(bits).astype(np.int64), ends - count)
    one = np.lexsort((total, count, ids, side, size))
    same = np.all([x[one][1:] == x[one][:-1] for x in (total, count, ids, side, size)], axis=0)
    one = one[np.concatenate([[True], ~same])]
    bits = bits[_spans(count[one], (ends - count)[one])]
    pairs = part_pairs(side[one].astype(np.int64), size[one], count[one], bits, t, sides == 2)
    if sides == 2:
        pairs = np.where((side[one][pairs[:, 0]] == 1)[:, None], pairs[:, ::-1], pairs)
    else:
        pairs = np.sort(pairs, axis=1)
    if len(pairs):
        pairs = np.unique(pairs[:, 0] << 32 | pairs[:, 1])
        pairs = np.column_stack([pairs >> 32, pairs & 0xFFFFFFFF])
    ends = [pa.array(ids[one][pairs[:, i]].view("V8").tolist(), pa.binary()) for i in (0, 1)]
    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), -1), pa.int32()), *[pa.nulls(len(pairs), x.type) for x in none], *ends], names)


def _asked_sets(sets: Sets, wanted: DataFrame, name: str) -> DataFrame:
    """(set_id, fp, size) of the wanted sets: only rows with the id of one of their members are computed.

    Rows are chosen ahead of the bits: behind a join of whole sets the bits of all rows would lie in its shuffle.
    """
    ids = sets.members.join(wanted, "set_id", "left_semi").groupBy("set_id").agg(F.min("id").alias("_one")).select("_one").distinct()
    ids = small_side(ids)
    chosen = sets.source.join(ids, sets.source["_id"].eqNullSafe(ids["_one"]), "left_semi")
    return materialize(_with_names(_rows(chosen, sets.fp), True, sets.make()).join(small_side(wanted), "set_id", "left_semi").groupBy("set_id").agg(
        F.any_value("fp").alias("fp"), F.any_value("size").alias("size")), name)


def set_pairs(a: DataFrame, b: DataFrame | None, min_sim: float, id_col: str, fp: str | Column | Made) -> tuple[list[Sets], DataFrame]:
    """(the sets of each table, (set_a, set_b, inter, size_a, size_b) for all pairs of distinct sets with Tanimoto ≥ min_sim).

    ``b=None`` joins ``a`` with itself and gives each pair once. Members and prefixes are made in one pass over the sets.
    """
    t = max(_ratio(min_sim), Fraction(1, 1 << 31))  # partners share a bit
    sides = [_sets(x, id_col, fp) for x in (a, b) if x is not None]
    rarity, n = _rarity(sides, t)
    parts = 1 + n.astype(np.int64) // PART_BITS
    kinds, n_sides = [s.source.schema["_id"].dataType for s in sides], len(sides)
    ids = ", ".join(f"id_{i} {k.simpleString()}" for i, k in enumerate(kinds))
    schema = f"part int, side int, {ids}, set_id binary, size int, names binary, sizes binary, counts binary, bits binary"
    none = [F.lit(None).cast(k).alias(f"none_{i}") for i, k in enumerate(kinds)]
    packed = [s.rows().select("*", *none).mapInArrow(lambda it, i=i, make=s.make(): _scanned(_made(it, make), t, parts, i, n_sides, rarity), schema) for i, s in enumerate(sides)]
    packed = packed[0] if b is None else packed[0].unionByName(packed[1])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _candidates(batches, t, n_sides)

    found = materialize(packed.groupBy("part").applyInArrow(joined, f"side int, {ids}, set_id binary, size int, name_a binary, name_b binary"), "found")
    sides = [s._replace(members=found.filter(F.col("side") == i).select(F.col(f"id_{i}").alias("id"), "set_id", "size")) for i, s in enumerate(sides)]
    named = [s.members.select("set_id").distinct().select(F.substring("set_id", 1, 8).alias(f"name_{x}"), F.col("set_id").alias(f"set_{x}"))
             for s, x in zip((sides * 2)[:2], "ab", strict=True)]
    near = found.filter("side = -1").select("name_a", "name_b").distinct()
    if b is None:  # sets of one name, too, if there are any
        near = near.unionByName(named[0].groupBy("name_a").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name_a", F.col("name_a").alias("name_b")))
    near = near.join(named[0], "name_a").join(named[1], "name_b").select("set_a", "set_b")
    if b is None:
        near = near.filter("set_a <> set_b").select(F.least("set_a", "set_b").alias("set_a"), F.greatest("set_a", "set_b").alias("set_b")).distinct()
    pairs = materialize(near, "pairs")
    verified = _shared(pairs, [_asked_sets(s, materialize(pairs.select(F.col(f"set_{x}").alias("set_id")).union(
        pairs.select("set_b") if b is None else pairs.select(f"set_{x}")).distinct(), "asked"), "sets") for s, x in zip(sides, "ab", strict=False)])
    return sides, verified.filter(_at_least(F.col("inter"), F.col("size_a"), F.col("size_b"), min_sim))


def _shared(pairs: DataFrame, sets: list[DataFrame]) -> DataFrame:
    """(set_a, set_b, inter, size_a, size_b) of the pairs.

    Pairs of one cluster are dealt to one bucket by the least partner of their ends, so a set goes to few buckets
    however many partners it has; a cluster of more than ``CELL`` sets is dealt over the cells of a grid.
    """
    known = sets[0] if len(sets) == 1 else sets[0].unionByName(sets[1]).dropDuplicates(["set_id"])
    ends = pairs.select("set_a", "set_b").unionByName(pairs.select(F.col("set_b").alias("set_a"), F.col("set_a").alias("set_b")))
    least = materialize(ends.groupBy("set_a").agg(F.least(F.min("set_a"), F.min("set_b")).alias("least")), "least")
    end = lambda x: least.select(F.col("set_a").alias(f"set_{x}"), F.col("least").alias(f"least_{x}"))
    clustered = materialize(pairs.join(end("a"), "set_a").join(end("b"), "set_b").select(
        "set_a", "set_b", F.least("least_a", "least_b").alias("cluster")), "clustered")
    members = clustered.select("cluster", "set_a").union(clustered.select("cluster", "set_b")).distinct()
    large = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CELL)
    side = F.ceil(F.coalesce("n", F.lit(1)) / F.lit(CELL)).cast("int")
    bits = sum(s.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] for s in sets)
    buckets = max(16, 2 * bits // PART_BITS)
    cell = F.xxhash64("cluster", F.pmod(F.xxhash64("set_a"), side), F.pmod(F.xxhash64("set_b"), side))
    dealt = materialize(clustered.join(large, "cluster", "left").select("set_a", "set_b", F.pmod(cell, F.lit(buckets)).alias("bucket")), "dealt")
    sent = dealt.select(F.col("set_a").alias("set_id"), "bucket").union(dealt.select("set_b", "bucket")).distinct()
    # buckets go to the sets: as a short side they are broadcast, and the bits are shuffled once, not for the join as well
    sent = known.select("set_id", "fp").join(small_side(sent), "set_id").withColumnRenamed("bucket", "sent_to")
    return materialize(dealt.groupBy("bucket").cogroup(sent.groupBy("sent_to")).applyInArrow(
        _count_shared, "set_a binary, set_b binary, inter int, size_a int, size_b int"), "shared")


def _count_shared(pairs: pa.Table, sets: pa.Table) -> pa.Table:
    fp = sets.column("fp").combine_chunks()
    ends, flat = np.asarray(fp.offsets), np.asarray(fp.values)
    at = {x: i for i, x in enumerate(sets.column("set_id").to_pylist())}
    a, b = (np.array([at[x] for x in pairs.column(c).to_pylist()], dtype=np.int64) for c in ("set_a", "set_b"))
    size = np.diff(ends)
    order, both, mark = np.argsort(a, kind="stable"), np.zeros(len(a), dtype=np.int32), np.zeros(0, dtype=np.int64)
    values, number = np.unique(flat[ends[0]:ends[-1]], return_inverse=True)
    held, start, last = np.zeros(len(values), dtype=bool), ends - ends[0], -1
    for i in order.tolist():
        if a[i] != last:
            held[mark] = False
            last = a[i]
            mark = number[start[last]:start[last + 1]]
            held[mark] = True
        both[i] = np.count_nonzero(held[number[start[b[i]]:start[b[i] + 1]]])
    return pa.table({"set_a": pairs.column("set_a"), "set_b": pairs.column("set_b"), "inter": pa.array(both),
                     "size_a": pa.array(size[a].astype(np.int32)), "size_b": pa.array(size[b].astype(np.int32))})


def _similarity(both: Column, size_a: Column, size_b: Column) -> Column:
    return both.cast("double") / (size_a + size_b - both).cast("double")


def similarity_join(a: DataFrame, b: DataFrame | None, min_sim: float, id_col: str, fp: str | Column | Made = "fp") -> DataFrame:
    """All pairs of distinct sets with Tanimoto ≥ min_sim, named by their smallest member ids.

    (rep_a, rep_b, copies_a, copies_b, sim). Copies of one set have similarity 1 to each other and the
    same partners, so the copy counts hold all the pairs there are. In the two-sided form a set that
    is in both inputs pairs with itself.
    """
    sides, pairs = set_pairs(a, b, min_sim, id_col, fp)
    name = lambda m, side: m.groupBy("set_id").agg(F.min("id").alias(f"rep_{side}"), F.count(F.lit(1)).alias(f"copies_{side}")) \
        .withColumnRenamed("set_id", f"set_{side}")
    named = pairs.join(name(sides[0].members, "a"), "set_a").join(name(sides[-1].members, "b"), "set_b")
    out = named.select("rep_a", "rep_b", "copies_a", "copies_b",
                       _similarity(F.col("inter"), F.col("size_a"), F.col("size_b")).alias("sim"))
    if b is not None:
        return out
    swap = F.col("rep_a") > F.col("rep_b")
    return out.select(
        F.when(swap, F.col("rep_b")).otherwise(F.col("rep_a")).alias("rep_a"),
        F.when(swap, F.col("rep_a")).otherwise(F.col("rep_b")).alias("rep_b"),
        F.when(swap, F.col("copies_b")).otherwise(F.col("copies_a")).alias("copies_a"),
        F.when(swap, F.col("copies_a")).otherwise(F.col("copies_b")).alias("copies_b"),
        "sim",
    )


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(set_ids, sizes, bits): the different sets of a task, about ``TILE_BITS`` bits a row; no row splits a set."""
    names: dict[bytes, int] = {}
    bits: list[np.ndarray] = []
    held = 0

    def tile() -> pa.RecordBatch:
        sizes = np.array(list(names.values()), dtype=np.int32).tobytes()
        whole = np.concatenate(bits).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (b"".join(names), sizes, whole)], ["set_ids", "sizes", "bits"])

    for b in batches:
        _, size, flat = _flat(b.column("fp"))
        for name, n, end in zip(_names(size, flat), size.tolist(), np.cumsum(size).tolist(), strict=True):
            if name in names:
                continue
            names[name] = n
            bits.append(flat[end - n:end])
            held += n
            if held >= TILE_BITS:
                yield tile()
                names, bits, held = {}, [], 0
    if names:
        yield tile()


def _postings(size: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the different bits of a tile, how many of its sets hold each, those sets bit by bit)."""
    key = np.sort(bits.astype(np.int64) << 32 | np.repeat(np.arange(len(size)), size))
    at = np.flatnonzero(np.concatenate([[True], key[1:] >> 32 != key[:-1] >> 32, [True]]))
    return (key[at[:-1]] >> 32).astype(np.int32), np.diff(at), (key & 0xFFFFFFFF).astype(np.int32)


def _best_of_tiles(batches: Iterator[pa.RecordBatch], t: Fraction) -> Iterator[pa.RecordBatch]:
    """(set_id, max_sim): the best partner of each set of a tile among those of the others it meets in a row, if it shares a bit."""
    of, held = b"", np.zeros(0)

    def answer() -> Iterator[pa.RecordBatch]:
        some = np.flatnonzero(held)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(of, dtype="V16")[some].tolist(), pa.binary()), pa.array(held[some])], ["set_id", "max_sim"])

    for b in batches:
        cols = [b.column(c) for c in ("set_ids", "sizes", "bits", "set_ids_b", "sizes_b", "bits_b")]
        for row in zip(*cols, strict=True):
            ids, size, bits, _, size_b, bits_b = (np.frombuffer(x.as_py(), dtype=d) for x, d in zip(row, ("V16", np.int32, np.int32) * 2, strict=True))
            size, size_b = size.astype(np.int64), size_b.astype(np.int64)
            if ids.tobytes() != of:
                yield from answer()
                of, held = ids.tobytes(), np.zeros(len(size))
                known, n, entry = _postings(size, bits)
            known_b, n_b, entry_b = _postings(size_b, bits_b)
            # the bits that both tiles hold, and of each set of a the list of b for each of them
            at = np.minimum(np.searchsorted(known_b, known), len(known_b) - 1)
            both = np.flatnonzero(known_b[at] == known)
            mine = entry[_spans(n[both], (np.cumsum(n) - n)[both])].astype(np.int64)
            start, count = (np.repeat(x[at[both]], n[both]) for x in (np.cumsum(n_b) - n_b, n_b))
            rows = max(1, PAIRS // len(size_b))
            for i in range(0, len(size), rows):
                some = slice(None) if rows >= len(size) else np.flatnonzero((i <= mine) & (mine < i + rows))
                own, first, times = mine[some] - i, start[some], count[some]
                block = np.cumsum(times) // PAIRS
                cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]])).tolist() if len(block) else []
                shared = np.zeros(min(rows, len(size) - i) * len(size_b), dtype=np.int64)
                for x, y in zip(cuts, cuts[1:], strict=False):
                    met = np.repeat(own[x:y] * len(size_b), times[x:y]) + entry_b[_spans(times[x:y], first[x:y])]
                    shared += np.bincount(met, minlength=len(shared))
                shared = shared.reshape(-1, len(size_b))
                union = size[i:i + rows, None] + size_b - shared
                good = shared * t.denominator >= union * t.numerator
                best = np.where(good, shared / union, 0.0).max(axis=1)
                held[i:i + rows] = np.maximum(held[i:i + rows], best)
    yield from answer()


def best_partners(a: Sets, b: Sets, min_sim: float) -> DataFrame:
    """(set_id, max_sim): for each set of ``a`` the similarity of its best partner in ``b``, if that is ≥ ``min_sim`` and not 0.

    Every set may have its best partner anywhere, so all pairs are counted: each task meets a tile of ``a`` with a tile
    of ``b`` and keeps one number a set. Disk holds the tiles once; work grows with the product of the tables.
    """
    t = _ratio(min_sim)
    schema = "set_ids binary, sizes binary, bits binary"
    tiles_a, tiles_b = (materialize(s.rows().select("fp").mapInArrow(lambda it, make=s.make(): _tiles(_made(it, make)), schema), "tiles") for s in (a, b))
    tiles_b = tiles_b.select(*[F.col(c).alias(f"{c}_b") for c in tiles_b.columns])
    met = tiles_a.join(tiles_b).mapInArrow(lambda it: _best_of_tiles(it, t), "set_id binary, max_sim double")
    return materialize(met, "met").groupBy("set_id").agg(F.max("max_sim").alias("max_sim"))


def max_similarity(a: DataFrame, previous: DataFrame, min_sim: float, id_col: str, fp: str | Column | Made = "fp") -> DataFrame:
    """(id, max_sim) for every row of ``a``: the best similarity to a previous set, 0 below min_sim; ``min_sim=0`` gives the true maximum."""
    sets_a, sets_b = distinct_sets(a, id_col, fp), distinct_sets(previous, id_col, fp)
    found = sets_a.members.join(best_partners(sets_a, sets_b, min_sim), "set_id").select(F.col("id").alias(id_col), "max_sim")
    return a.select(id_col).join(found, id_col, "left").withColumn("max_sim", F.coalesce("max_sim", F.lit(0.0)))


def approx_similarity_pairs(a: DataFrame, min_sim: float, id_col: str, vector: str, tables: int = 8,
                            seed: int = 7) -> DataFrame:
    """MinHash candidates for dense sets, each checked exactly; pairs may be missed, none is wrong."""
    from pyspark.ml.feature import MinHashLSH

    model = MinHashLSH(inputCol=vector, outputCol="_hashes", numHashTables=tables, seed=seed).fit(a)
    near = model.approxSimilarityJoin(a, a, 1.0 - min_sim + 1e-12, distCol="_dist")
    return near.select(F.col(f"datasetA.{id_col}").alias("id_a"), F.col(f"datasetB.{id_col}").alias("id_b"),
                       (F.lit(1.0) - F.col("_dist")).alias("sim")).filter("id_a < id_b")
