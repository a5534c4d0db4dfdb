"""Arrays packed into binary columns, for operators that exchange whole blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_CODEC = "zstd"


def pack(values: np.ndarray) -> bytes:
    """Whole numbers in the narrowest type that holds them, other types as they are,
    byte by byte place (high bytes are mostly alike) and compressed."""
    if values.dtype.kind in "iu":
        top = int(values.max(initial=0))
        values = values.astype(next(t for t in ("u1", "u2", "u4", "u8") if top <= np.iinfo(t).max))
    head = values.dtype.str.encode().ljust(4) + len(values).to_bytes(8, "little")
    if not len(values):
        return head
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return head + pa.compress(np.ascontiguousarray(planes).tobytes(), codec=_CODEC, asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    kind, n = np.dtype(data[:4].strip().decode()), int.from_bytes(data[4:12], "little")
    if not n:
        return np.zeros(0, kind)
    body = pa.decompress(data[12:], decompressed_size=n * kind.itemsize, codec=_CODEC, asbytes=True)
    planes = np.frombuffer(body, np.uint8).reshape(kind.itemsize, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_rising(values: np.ndarray) -> bytes:
    """Whole numbers in ascending order, as the steps between them."""
    return pack(np.diff(values, prepend=0))


def unpack_rising(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data).astype(np.int64))


def part_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Ranges of the hash's upper half; ascends with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def mix(x: np.ndarray) -> np.ndarray:
    """A hash of whole numbers."""
    x = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def rows(schema: pa.Schema, items: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(items, schema) if items else schema.empty_table()


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'binary'}" for f in schema)
