"""64-bit hashes of the words of many texts at once, with numpy."""

from __future__ import annotations

from .common import kept

_FACTOR = 0x100000001B3
BLOCK_BYTES = 1 << 20


def _powers(n: int, inverse: bool):
    """Powers of an odd number modulo 2 ** 64, or of its inverse, kept up to the longest input met."""
    import numpy as np

    powers = kept("powers", dict)
    held = powers.get(inverse)
    if held is None or len(held) < n:
        factors = np.full(max(n, 1 << 20), pow(_FACTOR, -1 if inverse else 1, 1 << 64), np.uint64)
        factors[0] = 1
        held = powers[inverse] = np.multiply.accumulate(factors)
    return held[:n]


def mix(x):
    """A bijection of 64-bit numbers that spreads every bit (the splitmix finaliser)."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes], lower: bool = True):
    """(hash of every word of all texts in a row, the end of each text in them).

    Words are runs of bytes other than space, tab, LF, VT, FF and CR; ``lower`` reads A-Z as a-z. Texts are read in blocks of
    about ``BLOCK_BYTES``: a byte needs some 40 bytes of arrays.
    """
    import numpy as np

    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    block = (np.cumsum(sizes) - sizes) // BLOCK_BYTES
    first = np.flatnonzero(np.diff(block, prepend=-1)).tolist()
    hashed, until, words = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for a, b in zip(first, [*first[1:], len(texts)]):
        some, ends = _block_hashes(texts[a:b], lower)
        hashed.append(some)
        until.append(ends + words)
        words += len(some)
    return np.concatenate(hashed), np.concatenate(until)


def _block_hashes(texts: list[bytes], lower: bool):
    import numpy as np

    joined = b"\n".join(texts) + b"\n"
    code = np.frombuffer(joined.lower() if lower else joined, np.uint8)  # bytes.lower() changes A-Z only
    word = np.ones(256, bool)
    word[[32, 9, 10, 11, 12, 13]] = False
    edge = np.flatnonzero(np.diff(word[code].view(np.int8), prepend=np.int8(0)))
    starts, ends = edge[::2], edge[1::2]  # the last byte is a line feed
    run = np.zeros(len(code) + 1, np.uint64)
    np.cumsum((code.astype(np.uint64) + np.uint64(1)) * _powers(len(code), False), out=run[1:])
    hashed = mix((run[ends] - run[starts]) * _powers(len(code), True)[starts] + (ends - starts).astype(np.uint64))
    until = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return hashed, np.searchsorted(starts, until)


def shingle_sets(texts: list[bytes], width: int = 5) -> list:
    """The sorted distinct ``width``-word shingles of each text, hashed; a text of fewer words is one shingle."""
    import numpy as np

    words, until = word_hashes(texts)
    factor = [np.uint64(f | 1) for f in range(0x9E3779B97F4A7C15, 0x9E3779B97F4A7C15 + 2 * width, 2)]
    rolled = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k, f in enumerate(factor):  # a place-dependent sum, mixed after each word
        rolled = mix(rolled * f + words[k:k + len(rolled)])
    out, begin = [], 0
    for end in until.tolist():
        n = end - begin
        if n >= width:
            out.append(np.unique(rolled[begin:end - width + 1]))
        elif n:
            h = np.array([n], np.uint64)
            for w in words[begin:end]:
                h = mix(h * factor[0] + w)
            out.append(h)
        else:
            out.append(np.zeros(0, np.uint64))
        begin = end
    return out
