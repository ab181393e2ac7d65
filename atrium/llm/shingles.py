"""Word shingles of whole texts as 64-bit hashes, and their circulant MinHash signatures."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

WORD_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
#: Seeds the first permutation.
SIGMA = np.uint64(0x5851F42D4C957F2D)
#: Shingles that are hashed together: their signatures' working set stays in cache.
CHUNK = 1 << 15


def mix64(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit integers."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class WordHashes(dict):
    """Words' 64-bit hashes, at most `keep` at a time."""

    def __init__(self, keep: int = 150_000):
        super().__init__()
        self.keep = keep

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.keep:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_lower(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8, A-Z lower-cased; words are cut at U+0020 and U+0009 to U+000D alone."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(word_hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of `width`-word shingles; of the whole sequence if it is shorter; none without words."""
    n = len(word_hashes)
    if not n:
        return word_hashes
    size = min(n, width)
    rows = n - size + 1
    total = np.zeros(rows, np.uint64)
    for i in range(size):
        total += word_hashes[i : i + rows] * WORD_FACTORS[i]
    return np.unique(mix64(total + np.uint64(size)))


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that name a set of shingles."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def permuted(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """The second permutation, of the 32-bit integers, in place."""
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B), (16, 1)):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        if factor != 1:
            np.multiply(x, np.uint32(factor), out=x)
    return x


def circulant_signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """A row per set of `coordinates` minima; sets must not be empty.

    The first permutation sends a shingle to a place on the circle of 32-bit integers. Coordinate k is the
    least value that the second permutation, shifted round the circle by k, gives to the set's places.
    """
    out = np.empty((len(sets), coordinates), np.uint32)
    sizes = np.array([len(s) for s in sets])
    first = 0
    while first < len(sets):
        last, rows = first + 1, sizes[first]
        while last < len(sets) and rows + sizes[last] <= CHUNK:
            rows += sizes[last]
            last += 1
        places = (mix64(np.concatenate(sets[first:last]) ^ SIGMA) >> np.uint64(32)).astype(np.uint32)
        for at in range(first, last):  # a set larger than a chunk goes chunk by chunk
            if sizes[at] > CHUNK:
                out[at] = np.min([_minima(places[i : i + CHUNK], np.zeros(1, np.intp), coordinates)[0] for i in range(0, len(places), CHUNK)], axis=0)
                break
        else:
            starts = np.concatenate([[0], np.cumsum(sizes[first:last])[:-1]])
            out[first:last] = _minima(places, starts, coordinates)
        first = last
    return out


def _minima(places: np.ndarray, starts: np.ndarray, coordinates: int) -> np.ndarray:
    out = np.empty((coordinates, len(starts)), np.uint32)
    x, spare = np.empty_like(places), np.empty_like(places)
    for k in range(coordinates):
        np.subtract(places, np.uint32(k), out=x)
        np.minimum.reduceat(permuted(x, spare), starts, out=out[k])
    return out.T


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key per band of `rows` coordinates; keys of different bands differ."""
    n, coordinates = signatures.shape
    bands = signatures.reshape(n, coordinates // rows, rows).astype(np.uint64)
    total = np.broadcast_to(np.arange(1, coordinates // rows + 1, dtype=np.uint64) * WORD_FACTORS[4], bands.shape[:2]).copy()
    for i in range(rows):
        total = mix64(total + bands[:, :, i] * WORD_FACTORS[i % 4])
    return total.view(np.int64)
