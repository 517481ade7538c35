"""Hierarchical multi-length packing of token ids into training windows.

Each task tokenizes its own documents and packs them as they stream past.  A document
gives full windows of the longest tier; what is left is routed to the smallest tier
that holds it.  Tiers are packed from the longest: a window starts with one piece of
its tier, its gap takes whole pieces of shorter tiers, longest first, and what still
gapes takes a cut piece.  Windows that cannot be filled yet wait for more documents.
At the end of a task the rest, less than a few windows, is cut at powers of two, so
no window holds padding.  Windows are dealt to step groups of equal token counts.

No shuffle and no shared state: a lost task repeats its own rows only, and yields the
same pieces again.  Memory is one Arrow batch and the waiting pieces.

Edge cases: NULL and empty texts give the end token alone; NULL ids and repeated rows
are packed like others; an empty table gives no pieces.  Extra columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (4096, 2048, 1024, 512)
END = 2
GROUP_TOKENS = 8 * 4096
KNOWN_WORDS = 1_000_000
SCHEMA = ("start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long, tier int, step_group long")


class WordTokens:
    """Token ids of texts, word by word: the tokenizer drops white space and never joins
    words across it, so each distinct word needs to be encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.code: dict[str, int] = {}
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def learn(self, words: list[str]) -> np.ndarray:
        """Codes of words; encodes those not seen before."""
        new = list(dict.fromkeys(w for w in words if w not in self.code))
        if new:
            if len(self.code) + len(new) > KNOWN_WORDS:
                self.clear()
                new = list(dict.fromkeys(words))
            got = [e.ids for e in self.tok.encode_batch_fast(new, add_special_tokens=False)]
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            flat = np.fromiter((i for g in got for i in g), np.uint32, int(sizes.sum()))
            base = len(self.code)
            self.code.update(zip(new, range(base, base + len(new))))
            self.ids = np.concatenate([self.ids, flat])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        return np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with END, and the ends of texts."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        ids, size = self.words(coded.dictionary)
        first = np.cumsum(size) - size
        codes = coded.indices.to_numpy(zero_copy_only=False)
        upto = np.concatenate([[0], np.cumsum(size[codes])])
        words_upto = lists.offsets.to_numpy().astype(np.int64)
        per_doc = np.diff(upto[words_upto - words_upto[0]])
        ends = np.cumsum(per_doc + 1)
        out = np.full(int(ends[-1]) if len(ends) else 0, END, np.uint32)
        body = np.ones(len(out), bool)
        body[ends - 1] = False
        out[body] = ids[spread(first[codes], size[codes])]
        return out, ends

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and how many each has.  A word that ends in
        plain punctuation after a Latin letter or digit is split there, as the tokenizer
        does, and ASCII letters are lowered first, so that fewer strings are encoded."""
        plain = pc.invert(pc.match_substring(words, "<|"))
        low = pc.if_else(plain, pc.ascii_lower(words), words)
        parts = pc.extract_regex(low, "^(?P<body>.*[a-z0-9ß-öø-ÿ])(?P<tail>[.,!?;:%$&*#|]+)$")
        split = pc.and_(plain, pc.is_valid(parts))
        body = pc.if_else(split, pc.fill_null(pc.struct_field(parts, "body"), ""), low).dictionary_encode()
        tail = pc.if_else(split, pc.fill_null(pc.struct_field(parts, "tail"), ""), "").dictionary_encode()
        known = [d.dictionary.to_pylist() for d in (body, tail)]
        codes = self.learn([*known[0], *known[1]])
        pair = np.stack([codes[body.indices.to_numpy()], codes[len(known[0]) + tail.indices.to_numpy()]], 1).ravel()
        size = self.starts[pair + 1] - self.starts[pair]
        return self.ids[spread(self.starts[pair], size)], size.reshape(-1, 2).sum(1)


def spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, … for ``size`` places each, one after the other."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


class Packer:
    """Windows of one task.  ``flush`` fills all windows it can, or all there are."""

    def __init__(self, tiers, first_id: int):
        self.tiers = sorted(tiers, reverse=True)
        self.wait: dict[int, list] = {t: [] for t in self.tiers}
        self.next_id, self.group, self.group_fill = first_id, first_id, 0
        self.rows: list[tuple] = []

    def route(self, piece) -> None:
        """piece: (document, its ids, start, length)."""
        self.wait[min(t for t in self.tiers if t >= piece[3])].append(piece)

    def add(self, doc, ids) -> None:
        start, top = 0, self.tiers[0]
        while len(ids) - start >= top:
            self.emit([(doc, ids, start, top)], top)
            start += top
        if start < len(ids):
            self.route((doc, ids, start, len(ids) - start))

    def emit(self, window: list, tier: int) -> None:
        total = sum(p[3] for p in window)
        if self.group_fill + total > GROUP_TOKENS:
            self.group, self.group_fill = self.group + 1, 0
        self.group_fill += total
        at = 0
        for doc, ids, start, n in window:
            crc = zlib.crc32(ids[start:start + n].astype("<u4").tobytes())
            self.rows.append((doc, start, n, crc, len(ids), self.next_id, at, total, tier, self.group))
            at += n
        self.next_id += 1

    def cut(self, piece, gap: int):
        """The head of piece that fits the gap; the rest is routed anew."""
        doc, ids, start, n = piece
        if n <= gap:
            return piece
        self.route((doc, ids, start + gap, n - gap))
        return doc, ids, start, gap

    def fill(self, first, tier: int) -> list | None:
        """A full window that starts with ``first``, or None when there is too little."""
        window, gap = [first], tier - first[3]
        shorter = [t for t in self.tiers if t < tier]
        for t in shorter:  # whole pieces, longest tier first
            pile, look = self.wait[t], 0
            while gap and look < min(len(pile), 16):
                if pile[-1 - look][3] <= gap:
                    window.append(pile.pop(-1 - look))
                    gap -= window[-1][3]
                else:
                    look += 1
        for t in [*reversed(shorter), tier]:  # then a cut
            while gap and self.wait[t]:
                window.append(self.cut(self.wait[t].pop(), gap))
                gap -= window[-1][3]
        if gap:
            for p in window:
                self.route(p)
            return None
        return window

    def flush(self, last: bool = False) -> None:
        for tier in self.tiers:
            pile = self.wait[tier]
            while pile:
                window = self.fill(pile.pop(), tier)
                if window is None:
                    break
                self.emit(window, tier)
        if last:
            rest = [p for t in self.tiers for p in self.wait[t]]
            left = sum(p[3] for p in rest)
            while left:
                size = min(self.tiers[0], 1 << (left.bit_length() - 1))
                window, gap = [], size
                while gap:
                    doc, ids, start, n = rest.pop()
                    if n > gap:
                        rest.append((doc, ids, start + gap, n - gap))
                        n = gap
                    window.append((doc, ids, start, n))
                    gap -= n
                self.emit(window, min((t for t in self.tiers if t >= size)))
                left -= size
            self.wait = {t: [] for t in self.tiers}


def pack(docs: DataFrame, tokenizer_path: str, text: str = "text", key: str = "doc_id", tiers=TIERS) -> DataFrame:
    """One row per piece: the document's key and SCHEMA."""
    if any(t & (t - 1) for t in tiers):
        raise ValueError("tiers must be powers of two")
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokens(tokenizer_path)
        packer = Packer(tiers, TaskContext.get().partitionId() << 40)
        fields = [pa.field("k", pa.int64())]

        def out():
            cols = list(zip(*packer.rows)) if packer.rows else [[]] * 10
            packer.rows = []
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            kinds = [pa.int32() if c.endswith(" int") else pa.int64() for c in SCHEMA.split(", ")]
            arrays = [pa.array(cols[0], fields[0].type)] + [pa.array(c, k) for c, k in zip(cols[1:], kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=[key, *names])

        for batch in batches:
            fields[0] = batch.schema.field(0)
            for part in slices(batch):
                ids, ends = words.encode(part.column(1))
                begin = 0
                for k, end in zip(part.column(0).to_pylist(), ends.tolist()):
                    packer.add(k, ids[begin:end])
                    begin = end
                packer.flush()
                # waiting pieces keep their own ids only, not the whole batch
                for t, pile in packer.wait.items():
                    packer.wait[t] = [(d, i.copy() if i.base is not None else i, s, n) for d, i, s, n in pile]
                yield out()
        packer.flush(last=True)
        yield out()

    return rows.mapInArrow(run, f"{key} {kind}, {SCHEMA}")


def slices(batch: pa.RecordBatch, most: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    """Row ranges of a batch with about ``most`` bytes of its text (column 1) each."""
    size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(size) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
