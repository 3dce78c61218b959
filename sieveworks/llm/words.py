"""Words of many texts at once, as arrays: places, owners and 64-bit hashes, without a Python step per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 17  # bytes of text handled at once, so that what is made of them stays in a core's cache; a longer text is handled alone
LONG = 256  # bytes; longer spans are hashed one at a time
U = np.uint64


FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], U)  # masks of the first bytes of eight


def splitmix(seed: int, n: int) -> np.ndarray:
    """n well-mixed 64-bit numbers."""
    return mixed(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed * 0x632BE59BD9B4E019 % (1 << 64)))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, as many as asked for."""

    def __init__(self, seed: int):
        self.root = int(splitmix(seed, 1)[0]) | 1
        self.up = self.down = np.ones(0, U)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK)
            for name, root in (("up", self.root), ("down", pow(self.root, -1, 1 << 64))):
                x = np.full(size, root, U)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self.up[:n], self.down[:n]


def sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values[start:end], modulo 2**64 for unsigned values."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[ends] - total[starts]


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of the bytes of each span: eight bytes after eight go through a mixing that is not linear.

    Spans of different bytes share a hash by chance only, also where they are
    built of few letters; seeds give hashes that collide independently.
    """
    import xxhash

    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    sizes = ends - starts
    out = mixed(sizes.astype(U) * U(0x9E3779B97F4A7C15) + splitmix(seed, 1))
    at, left, rows = starts, np.minimum(sizes, LONG), slice(None)
    while len(at):
        part = eights[at] & FIRST[np.minimum(left, 8)]
        out[rows] = mixed(out[rows] * U(0xD6E8FEB86659FD93) ^ part)
        more = np.flatnonzero(left > 8)
        rows = more if isinstance(rows, slice) else rows[more]
        at, left = at[more] + 8, left[more] - 8
    for i in np.flatnonzero(sizes > LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), seed)
    return out


class SpanHash:
    """Hashes of spans of a sequence of well-mixed numbers, some hundred numbers at most; equal spans have equal hashes
    wherever they stand.  Bytes are no such numbers (see byte_hashes)."""

    def __init__(self, seed: int):
        self.powers = Powers(seed)

    def __call__(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = self.powers(max(len(values), 1))
        size = (ends - starts).astype(U)
        back = down[np.minimum(starts, len(down) - 1)]
        return mixed(sums(values * up[: len(values)], starts, ends) * back + size * U(0x9E3779B97F4A7C15))


def mapped(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """table[data] for bytes and a table of 256 bytes or booleans, as bytes; several times faster than by indices."""
    return np.frombuffer(data.tobytes().translate(table.tobytes()), np.uint8)


def byte_table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


SPACES = byte_table(b" \t\n\x0b\x0c\r")  # what [^\x20\x09-\x0D] leaves out


class Texts:
    """The bytes of some texts: data, and where each begins and ends."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.starts, self.ends = data, offsets[:-1], offsets[1:]

    def __len__(self) -> int:
        return len(self.starts)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def words(self, spaces: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte, end and text of every word: bytes that are not spaces, up to a space or the text's end."""
        inside = mapped(self.data, ~spaces).view(bool)
        begins = np.zeros(len(inside) + 1, bool)
        begins[self.starts] = True
        before = np.concatenate([[False], inside[:-1]])[: len(inside)]
        after = np.concatenate([inside[1:], [False]])[: len(inside)]
        starts = np.flatnonzero(inside & (~before | begins[:-1]))
        ends = np.flatnonzero(inside & (~after | begins[1:])) + 1
        return starts, ends, np.searchsorted(self.ends, starts, side="right")


def chunks(column: pa.Array) -> Iterator[tuple[int, Texts]]:
    """(number of the first text, some texts) of a string column, about CHUNK bytes at a time.  Null: empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    n = len(column)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
        yield at, Texts(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to
