"""Hash codes of the words of texts, for one Arrow batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_M = [np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M[0]
    h = (h ^ (h >> np.uint64(27))) * _M[1]
    return h ^ (h >> np.uint64(31))


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the lower-cased words of all texts, one after the other, and their borders."""
    lists = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    words = lists.flatten()
    real = pc.greater(pc.binary_length(words), 0)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    upto = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])[offsets]
    coded = words.filter(real).dictionary_encode()
    digest = xxhash.xxh3_64_intdigest
    known = np.array([digest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    return (known[coded.indices.to_numpy()] if len(known) else np.zeros(0, np.uint64)), upto
