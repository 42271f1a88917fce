"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a run of bytes other than space and 0x09-0x0D.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text that a Python worker holds in arrays at once (one longer text: alone).
BLOCK = 4_000_000
#: Bytes from which a word is read in one piece instead of eight bytes at a time.
LONG_WORD = 512


def is_space() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return table


def is_mark() -> np.ndarray:
    """All of ASCII but letters and digits."""
    table = np.ones(256, bool)
    table[128:] = False
    for a, b in ((48, 58), (65, 91), (97, 123)):
        table[a:b] = False
    return table


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its texts; a null is empty."""
    if column.null_count:
        column = column.cast(pa.string()).fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(batches, column: str, limit: int = BLOCK) -> Iterator[pa.Table]:
    """The rows of the batches in tables of about ``limit`` bytes of text, never empty."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_bytes(batch.column(batch.schema.get_field_index(column)))
        first = 0
        while first < batch.num_rows:
            room = max(limit - size, 0)
            last = int(np.searchsorted(at, at[first] + room, side="right")) - 1
            if last <= first and not held:
                last = first + 1
            if last > first:
                held.append(batch.slice(first, last - first))
                size += int(at[last] - at[first])
                first = last
            if first < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def column_of(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def find_words(
    data: np.ndarray, at: np.ndarray, space: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the index of its first word.
    ``space`` tells for each byte whether it separates words."""
    return find_runs(~(is_space() if space is None else space)[data], at)


def find_runs(
    wanted: np.ndarray, at: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes that are ``wanted``, and for each text the index of
    its first run. No run goes over the border of two texts."""
    inside = np.zeros(len(wanted) + 2, bool)
    inside[1:-1] = wanted
    start = inside[1:] & ~inside[:-1]
    end = inside[:-1] & ~inside[1:]
    cuts = at[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(wanted))]
    joined = cuts[inside[cuts] & inside[cuts + 1]]  # two texts meet inside a run
    start[joined] = True
    end[joined] = True
    starts, ends = np.flatnonzero(start), np.flatnonzero(end)
    return starts, ends, np.searchsorted(starts, at)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, limit: int = BLOCK
) -> np.ndarray:
    """A 64-bit hash of each word, from prefix sums of its bytes times powers of a base."""
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 2**64)
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(int(np.searchsorted(ends, starts[first] + limit, side="right")), first + 1)
        origin, stop = int(starts[first]), int(ends[last - 1])
        powers = np.full(stop - origin + 1, base, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        sums = np.zeros(stop - origin + 1, np.uint64)
        np.multiply(data[origin:stop], powers[:-1], out=sums[1:], dtype=np.uint64)
        sums[1:] += powers[:-1]  # so that a zero byte counts as well
        np.add.accumulate(sums, out=sums)
        powers.fill(inverse)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        s, e = starts[first:last] - origin, ends[first:last] - origin
        out[first:last] = (sums[e] - sums[s]) * powers[s]
        first = last
    return mix(out)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number; after the end come zeros."""
    padded = np.append(data, np.zeros(8, np.uint8))
    return np.ndarray((len(data) + 1,), "<u8", buffer=padded, strides=(1,))


def _cut(eight: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The first ``left`` bytes of each number."""
    masks = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    return eight & masks[np.minimum(left, 8)]


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit key of each word. Words of equal length up to eight bytes never share one, and
    no kind of repetition makes longer ones meet."""
    sizes, view = ends - starts, eights(data)
    keys = mix(sizes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    some, done = np.flatnonzero((sizes > 0) & (sizes <= LONG_WORD)), 0
    while len(some):
        left = sizes[some] - done
        keys[some] = mix(keys[some] ^ _cut(view[starts[some] + done], left))
        some, done = some[left > 8], done + 8
    for i in np.flatnonzero(sizes > LONG_WORD).tolist():
        keys[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]])
    return keys


def same_words(
    data: np.ndarray, starts: np.ndarray, others: np.ndarray, sizes: np.ndarray,
    other: np.ndarray | None = None,
) -> np.ndarray:
    """Whether the ``sizes`` bytes from ``starts`` on in ``data`` are those from ``others`` on,
    in the same bytes or in those of ``other``."""
    same = np.ones(len(starts), bool)
    unlike = starts != others if other is None else same.copy()
    view = eights(data)
    second, view2 = (data, view) if other is None else (other, eights(other))
    some, done = np.flatnonzero(unlike & (sizes <= LONG_WORD) & (sizes > 0)), 0
    while len(some):
        a, b, left = starts[some] + done, others[some] + done, sizes[some] - done
        differ = _cut(view[a], left) != _cut(view2[b], left)
        same[some[differ]] = False
        some, done = some[~differ & (left > 8)], done + 8
    for i in np.flatnonzero(unlike & (sizes > LONG_WORD)).tolist():
        n = sizes[i]
        same[i] = np.array_equal(data[starts[i] : starts[i] + n], second[others[i] : others[i] + n])
    return same


def distinct_words(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different words: their sorted keys, a place of each, and of each word its number
    there. Words with equal keys are compared byte by byte."""
    keys, sizes = word_keys(data, starts, ends), ends - starts
    while True:
        found, some, which = np.unique(keys, return_index=True, return_inverse=True)
        first = some[which]
        odd = sizes != sizes[first]
        alike = np.flatnonzero(~odd)
        odd[alike] = ~same_words(data, starts[alike], starts[first[alike]], sizes[alike])
        if not odd.any():
            return found, some, which
        keys[odd] = mix(keys[odd] + np.uint64(1))


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` consecutive words; runs may cross texts."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(length):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += words[j : j + n]
    return mix(out)


def room_left(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For texts of words ``first[i]`` to ``first[i + 1]``: the texts of all runs of
    ``length`` words inside one text, and the runs' first words."""
    count = np.maximum(first[1:] - first[:-1] - length + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count) + first[:-1][text]
    return text, place


def joined_words(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, space: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with one space after each word, and each word's start there (one more: the end)."""
    sizes = ends - starts + 1
    place = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=place[1:])
    keep = ~(is_space() if space is None else space)[data]
    out = np.full(int(place[-1]), 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[place[1:] - 1] = False
    out[inside] = data[keep]
    return out, place
