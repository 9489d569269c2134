"""Arrays of numbers as compressed bytes."""

from __future__ import annotations


def pack(numbers) -> bytes:
    """The number of bytes, then the numbers' lowest bytes, their next ones and so on, compressed: the empty high bytes of small numbers
    take no room in rows, shuffles and written tables."""
    import numpy as np
    import pyarrow as pa

    planes = numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes, kind):
    import numpy as np
    import pyarrow as pa

    planes = pa.decompress(memoryview(data)[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def pack_bits(marks) -> bytes:
    """An array of booleans, eight in a byte."""
    import numpy as np

    return np.packbits(marks).tobytes()


def unpack_bits(data: bytes, count: int):
    import numpy as np

    return np.unpackbits(np.frombuffer(data, np.uint8), count=count).astype(bool)
