"""Text kernels that run inside tasks: words, shingles, n-gram features."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words whose hashes a worker keeps; past it the table starts afresh.
CACHE_WORDS = 200_000
#: Odd multipliers, one for each place in a shingle.
_PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                   0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def ascii_words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as bytes.

    ``bytes.split`` splits at exactly these six characters and
    ``bytes.lower`` changes exactly A-Z.
    """
    return text.encode("utf-8", "surrogatepass").lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    for _ in range(2):
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return x


def ordered(values: np.ndarray) -> np.ndarray:
    """The different values, sorted. ``np.unique`` keeps a hash table, which
    takes several times as long."""
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all runs of ``k`` words, repeats included; fewer
    words count as one run, no word as none. The words' hashes are random
    already, so a sum with a multiplier for each place is mixed once."""
    n = len(hashes)
    if n == 0:
        return np.empty(0, np.uint64)
    short = n < k
    runs, k = (1, n) if short else (n - k + 1, k)
    total = hashes[:runs] * _PLACE[0]
    for j in range(1, k):
        total += hashes[j : j + runs] * _PLACE[j]
    if short:
        total += np.uint64(n)
    return mix64(total)


class Lookup:
    """Places of values in a sorted key array. A bitmap over the leading bits
    turns most absent values away before the binary search."""

    def __init__(self, keys: np.ndarray, bits: int = 22):
        self.keys, self.shift = keys, np.uint64(64 - bits)
        self.map = np.zeros(1 << bits, bool)
        self.map[keys >> self.shift] = True

    def __call__(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places in values, places in keys) of the values found."""
        at = np.flatnonzero(self.map[values >> self.shift])
        if not len(at):
            return at, at
        found = np.minimum(np.searchsorted(self.keys, values[at]), len(self.keys) - 1)
        same = self.keys[found] == values[at]
        return at[same], found[same]


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text; empty without words."""
    if not text:
        return np.empty(0, np.uint64)
    return np.unique(shingle_hashes(word_hashes(ascii_words(text)), k))


def sketch(members: np.ndarray, width: int) -> bytes:
    """Counts of a set's hashes by class (the leading bits), a byte each, in
    ``width`` classes (a power of two). A count is capped at 255, which can
    only bring two sketches nearer together."""
    counts = np.bincount((members >> np.uint64(64 - width.bit_length() + 1)).astype(np.int64), minlength=width)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


class Distinct:
    """Distinct values of an index array in linear time, without sorting:
    each value's last place is stamped, and the places that kept their own
    stamp are one for each value."""

    def __init__(self, size: int):
        self.stamp = np.zeros(size, np.int32)

    def __call__(self, idx: np.ndarray) -> np.ndarray:
        at = np.arange(len(idx), dtype=np.int32)
        self.stamp[idx] = at
        return idx[self.stamp[idx] == at]


def char_ngrams(text: str, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """Hashed n-grams of the characters (code points) of the lower-cased text,
    one block for each order, repeats included."""
    raw = np.frombuffer((" " + text.lower() + " ").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    out, code, prime = [], raw, np.uint32(16777619)
    for n in range(2, max(orders) + 1):
        if len(raw) < n:
            break
        code = code[:-1] * prime + raw[n - 1 :]
        if n in orders:
            h = (code ^ np.uint32(0x9E3779B1 * n & 0xFFFFFFFF)) * np.uint32(2654435769)
            h ^= h >> np.uint32(15)
            out.append((h * np.uint32(2246822519)) >> np.uint32(32 - bits))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


_LOW16 = 0xFFFF


def _shape(word: str) -> int:
    """A word's outline in 16 bits: case, length class and closing marks."""
    if word.isalpha():
        core, tail = word, ""
    else:
        core = word.rstrip("".join(c for c in set(word) if not c.isalnum()))
        tail = word[len(core) :][:4]
    case = "U" if len(core) > 1 and core.isupper() else "T" if core[:1].isupper() else "l" if core.isalpha() else "d" if core.isdigit() else "x"
    return xxhash.xxh32_intdigest(f"{case}{min(len(core), 12) // 3}{tail}".encode("utf-8", "surrogatepass")) & _LOW16


class _WordOutlines(dict):
    """Word to hash; its low 16 bits are the word's outline."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) & ~_LOW16 | _shape(word)
        return h


_OUTLINES = _WordOutlines()


def word_and_shape_ngrams(text: str, bits: int) -> np.ndarray:
    """Hashed uni- and bigrams of words, and uni- to trigrams of word
    outlines, where a word equal to the one before it has an outline of its
    own. Repeats included."""
    words = text.split()
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint32)
    h = np.fromiter(map(_OUTLINES.__getitem__, words), np.uint64, n)
    s = h & np.uint64(_LOW16)
    s[1:][h[1:] == h[:-1]] = 1
    p = _PLACE
    grams = [h, s * p[0] + np.uint64(3)]
    if n > 1:
        grams += [h[:-1] * p[1] + h[1:] * p[2], s[:-1] * p[3] + s[1:] * p[4] + np.uint64(5)]
    if n > 2:
        grams.append(s[:-2] * p[3] + s[1:-1] * p[4] + s[2:] * p[5] + np.uint64(7))
    return (mix64(np.concatenate(grams)) >> np.uint64(64 - bits)).astype(np.uint32)
