"""Links between the tokens of two tokenizers over the same texts.

Both encode the whole text.  Where a token of each ends at the same byte, the text can
be cut into *groups*; where moreover a blank-marked token of each starts, it is cut into
*windows* of token ids, about a word long.  What a window holds depends on its ids alone,
so each distinct pair of id tuples is aligned once and remembered; a document is then a
list of window numbers.  Windows are told apart by 64-bit sums, and every window of a
batch is held against the ids of the one that stands for it.

A link is a pair of token occurrences in one group; an id pair's count is the number of
documents that hold it linked.  Documents keep each distinct pair once, with its number
of links, so counting is one grouped sum with partial sums in the tasks.  To read counts
back, the most frequent pairs, HEADS at most, go to all tasks as sorted arrays; pairs
beyond them meet their counts in a shuffled join.  No document's rows gather anywhere.

Very long texts are encoded in parts, cut at single blanks between other characters:
neither tokenizer joins anything across those, and each part starts with its blank as a
text does.  Memory is one slice of a batch and the remembered windows.

Edge cases: NULL and empty texts, and texts that one tokenizer does not give back byte by
byte, have no tokens: zeros, and an empty digest.  Rows that repeat count as documents
each; a NULL key is kept.  An empty table gives no rows.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.packing import slices, spread
from tallyframe.llm.words import mix
from tallyframe.session import materialize

MARK = "▁"
# Characters encoded at once, bytes of text worked on at once, windows remembered.
PART = 300_000
SLICE = 3_000_000
KNOWN_WINDOWS = 200_000
# Pairs whose counts are sent to every task (17 bytes each).
HEADS = 2_000_000
# Groups with more links are counted by distinct ids.
LARGE = 4096


class ByteLevel:
    """A byte-level BPE vocabulary file; special tokens are not looked for in texts."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        special = {t["content"] for t in spec["added_tokens"]}
        # bytes that print stand for themselves, the others for letters from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letter = {chr(b): b for b in shown}
        letter |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(shown))}
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = token.encode() if token in special else bytes(letter[c] for c in token)
        # Where ids follow the order of merges, they are all that a merge needs to know.
        joined = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
        if [vocab[t] for t in joined] != list(range(256, 256 + len(joined))):
            raise ValueError("a vocabulary is needed whose ids follow its merges")
        ranks = {self.bytes[i]: i for t, i in vocab.items() if t not in special}
        self.encoding = tiktoken.Encoding("byte level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        encode = self.encoding.encode_ordinary
        return [encode(" " + t) for t in texts]


class Pieces:
    """A SentencePiece model that puts a blank first and keeps all blanks."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode()
                      for i, p in enumerate(names)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def parts(text: str, most: int) -> list[str]:
    """text cut at single blanks, which go, into parts of about ``most`` characters."""
    out, a = [], 0
    while len(text) - a > most:
        n = a + most
        while True:
            n = text.find(" ", n)
            if n < 0 or (n + 1 < len(text) and not any(c.isspace() or c == MARK for c in (text[n - 1], text[n + 1]))):
                break
            n += 1
        if n < 0:
            break
        out.append(text[a:n])
        a = n + 1
    return [*out, text[a:]]


class Side:
    """One tokenizer: encodes whole texts and knows the bytes of its ids."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.bytes = tokenizer.bytes
        self.length = np.array([len(b) for b in self.bytes], np.int64)
        self.blank = np.array([b[:1] == b" " for b in self.bytes])

    def encode(self, cut: list[list[str]]) -> list[list[int]]:
        ids = iter(self.tokenizer.encode(list(chain.from_iterable(cut))))
        return [next(ids) if len(c) == 1 else list(chain.from_iterable(next(ids) for _ in c)) for c in cut]

    def gives_back(self, ids: list[int], raw: bytes) -> bool:
        return b"".join(map(self.bytes.__getitem__, ids)) == raw


def shared_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of both sides that end at the same byte."""
    marks = [np.zeros(int(a_ends[-1]) + 1, bool) for _ in "ab"]
    marks[0][a_ends], marks[1][b_ends] = True, True
    return np.flatnonzero(marks[1][a_ends]), np.flatnonzero(marks[0][b_ends])


def joined(texts: pa.Array, ends: np.ndarray, sign: str) -> pa.Array:
    """Runs of texts, given by their ends, each joined by ``sign``."""
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, texts), sign)


class Aligner:
    """Aligns windows of ids; those met before are remembered by their id tuples."""

    def __init__(self, a: Side, b: Side):
        self.a, self.b, self.width = a, b, len(b.bytes)
        self.clear()

    def clear(self) -> None:
        self.code: dict[tuple[bytes, bytes], int] = {}
        self.text = pa.array([], pa.string())
        self.groups, self.links = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def windows(self, keys: list[tuple[bytes, bytes]]) -> None:
        """Align new windows, all at once."""
        a, b = (np.frombuffer(b"".join([k[n] for k in keys]), np.int32).astype(np.int64) for n in (0, 1))
        upto = np.cumsum(np.fromiter((len(k[0]) // 4 for k in keys), np.int64, len(keys)))
        ends = [x + 1 for x in shared_ends(np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b]))]
        lo = [np.concatenate([[0], e[:-1]]) for e in ends]
        size = [e - s for e, s in zip(ends, lo)]
        upto = np.searchsorted(ends[0], upto) + 1  # ends of windows in groups
        sides = [joined(pa.array(x).cast(pa.string()), e, ",") for x, e in zip((a, b), ends)]
        self.text = pa.concat_arrays([self.text, joined(pc.binary_join_element_wise(*sides, "|"), upto, ";")])
        n_groups = np.diff(np.concatenate([[0], upto]))
        window = np.repeat(np.arange(len(keys)), n_groups)
        n_links = size[0] * size[1]
        self.groups = np.concatenate([self.groups, n_groups])
        self.links = np.concatenate([self.links, np.add.reduceat(n_links, upto - n_groups)])
        # links of plain groups one by one; those of large ones from the counts of their ids
        plain = np.flatnonzero(n_links <= LARGE)
        in_a = spread(lo[0][plain], size[0][plain])
        each = np.repeat(plain, size[0][plain])
        code = np.repeat(a[in_a] * self.width, size[1][each]) + b[spread(lo[1][each], size[1][each])]
        found = [(np.repeat(window[each], size[1][each]), code, np.ones(len(code), np.int64))]
        for g in np.flatnonzero(n_links > LARGE):
            (x, n), (y, m) = (np.unique(ids[s[g]:e[g]], return_counts=True) for ids, s, e in zip((a, b), lo, ends))
            code = (x[:, None] * self.width + y[None, :]).ravel()
            found.append((np.full(len(code), window[g]), code, (n[:, None] * m[None, :]).ravel()))
        window, code, times = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((code, window))
        window, code, times = window[order], code[order], times[order]
        new = np.flatnonzero(np.concatenate([[True], (window[1:] != window[:-1]) | (code[1:] != code[:-1])]))
        size = np.bincount(window[new], minlength=len(keys))
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(size)])
        self.pairs = np.concatenate([self.pairs, code[new]])
        self.times = np.concatenate([self.times, np.add.reduceat(times, new)])

    def learn(self, keys: list[tuple[bytes, bytes]]) -> np.ndarray:
        """Codes of windows, each given as the bytes of its two id tuples."""
        new = [k for k in keys if k not in self.code]
        if new and len(self.code) + len(new) > KNOWN_WINDOWS:
            self.clear()
            new = keys
        if new:
            self.windows(new)
            self.code.update(zip(new, range(len(self.code), len(self.code) + len(new))))
        return np.fromiter(map(self.code.__getitem__, keys), np.int64, len(keys))

    def documents(self, ids_a: list[list[int]], ids_b: list[list[int]]):
        """Of texts that both tokenizers give back: codes of their windows, first windows."""
        a, b = (np.fromiter(chain.from_iterable(x), np.int32) for x in (ids_a, ids_b))
        shared_a, shared_b = shared_ends(np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b]))
        # a window ends with its document, or where a blank-marked token of both follows
        last_a = np.cumsum(np.fromiter(map(len, ids_a), np.int64, len(ids_a))) - 1
        stop = np.zeros(len(a), bool)
        stop[last_a] = True
        follows = np.append(self.a.blank[a[1:]], False)[shared_a] & np.append(self.b.blank[b[1:]], False)[shared_b]
        ends = follows | stop[shared_a]
        hi_a, hi_b = shared_a[ends] + 1, shared_b[ends] + 1
        lo_a, lo_b = (np.concatenate([[0], h[:-1]]) for h in (hi_a, hi_b))
        first = np.concatenate([[0], np.searchsorted(hi_a, last_a + 1) + 1])
        size_a, size_b = hi_a - lo_a, hi_b - lo_b
        seed = 0
        while True:
            sums = []
            for ids, lo, size in ((a, lo_a, size_a), (b, lo_b, size_b)):
                place = np.arange(len(ids)) - np.repeat(lo, size)
                sums.append(np.add.reduceat(mix((ids.astype(np.uint64) << np.uint64(32)) + place.astype(np.uint64) + np.uint64(seed)), lo))
            _, rep, which = np.unique(mix(sums[0]) + sums[1], return_index=True, return_inverse=True)
            like = rep[which]
            # every window is equal, id by id, to the one that stands for it
            if all((size[like] == size).all() and (ids[spread(lo[like], size)] == ids).all()
                   for ids, lo, size in ((a, lo_a, size_a), (b, lo_b, size_b))):
                break
            seed += 1 << 40
        keys = [(a[p:q].tobytes(), b[r:s].tobytes()) for p, q, r, s in zip(
            lo_a[rep].tolist(), hi_a[rep].tolist(), lo_b[rep].tolist(), hi_b[rep].tolist())]
        return self.learn(keys)[which], first

    def links_of(self, codes: np.ndarray, first: np.ndarray):
        """Ends of the documents' distinct pairs, the pairs in order, their numbers of links."""
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        seen, n = np.unique((doc << 32) + codes, return_counts=True)
        doc, codes = seen >> 32, seen & 0xFFFFFFFF
        start, size = self.starts[codes], self.starts[codes + 1] - self.starts[codes]
        at = spread(start, size)
        doc, pairs, times = np.repeat(doc, size), self.pairs[at], self.times[at] * np.repeat(n, size)
        order = np.lexsort((pairs, doc))
        doc, pairs, times = doc[order], pairs[order], times[order]
        new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (pairs[1:] != pairs[:-1])]))
        ends = np.searchsorted(doc[new], np.arange(len(first)))
        return ends, pairs[new], np.add.reduceat(times, new)


@lru_cache(maxsize=2)
def sides(a_path: str, b_path: str) -> tuple[Side, Side]:
    """Both tokenizers, read once in a Python process."""
    return Side(ByteLevel(a_path)), Side(Pieces(b_path))


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", groups: bool = False) -> DataFrame:
    """One row a document: its key, ``row`` (unique), n_a, n_b, n_groups, n_links,
    groups_sha256, and its distinct linked pairs (a_id * size of B + b_id) with their
    numbers of links; with ``groups`` also the groups as text."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    a, b = sides(a_path, b_path)
    pair = (pa.int32(), "int") if len(a.bytes) * len(b.bytes) < 2**31 else (pa.int64(), "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(a_path, b_path)
        aligner = Aligner(a, b)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, SLICE):
                n, texts = part.num_rows, part.column(1).to_pylist()
                cut = {i: parts(t, PART) for i, t in enumerate(texts) if t}
                got = [dict(zip(cut, side.encode(list(cut.values())))) for side in (a, b)]
                raw = {i: (" " + texts[i]).encode() for i in cut}
                good = [i for i in cut if a.gives_back(got[0][i], raw[i]) and b.gives_back(got[1][i], raw[i])]
                del raw, cut
                counts = np.zeros((4, n), np.int64)
                digest, shown = [""] * n, [""] * n
                ends, pairs, times = np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
                if good:
                    ids = [[g[i] for i in good] for g in got]
                    codes, first = aligner.documents(*ids)
                    counts[0, good], counts[1, good] = [len(x) for x in ids[0]], [len(x) for x in ids[1]]
                    counts[2, good] = np.add.reduceat(aligner.groups[codes], first[:-1])
                    counts[3, good] = np.add.reduceat(aligner.links[codes], first[:-1])
                    for i, told in zip(good, joined(aligner.text.take(pa.array(codes)), first[1:], ";")):
                        digest[i] = hashlib.sha256(told.as_buffer()).hexdigest()
                        if groups:
                            shown[i] = told.as_py()
                    upto, pairs, times = aligner.links_of(codes, first)
                    ends[np.array(good) + 1] = np.diff(upto)
                    ends = np.cumsum(ends)
                del got
                offsets = pa.array(ends.astype(np.int32))
                cols = [part.column(0), pa.array(np.arange(row, row + n)), *map(pa.array, counts), pa.array(digest, pa.string()),
                        pa.ListArray.from_arrays(offsets, pa.array(pairs).cast(pair[0])), pa.ListArray.from_arrays(offsets, pa.array(times))]
                names = ["key", "row", *COUNTS, "groups_sha256", "pairs", "times"]
                if groups:
                    cols, names = [*cols, pa.array(shown, pa.string())], [*names, "groups"]
                row += n
                yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, row long, {', '.join(c + ' long' for c in COUNTS)}, groups_sha256 string, "
                               f"pairs array<{pair[1]}>, times array<long>" + (", groups string" if groups else ""))
    return out.withColumnRenamed("key", key) if key != "key" else out


def pair_counts(aligned: DataFrame, b_path: str) -> DataFrame:
    """(pair, a_id, b_id, documents, best): in how many documents each pair is linked, and
    whether no pair of its A id has more.  Written once."""
    import sentencepiece

    width = F.lit(sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size())
    counts = materialize(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents")))
    counts = counts.select("pair", F.expr("pair").cast("long").alias("p"), "documents")
    counts = counts.select("pair", F.floor(F.col("p") / width).cast("int").alias("a_id"), (F.col("p") % width).cast("int").alias("b_id"), "documents")
    # one row an id of A: bounded by the vocabulary
    most = counts.groupBy(F.col("a_id").alias("__a")).agg(F.max("documents").alias("__most"))
    out = counts.join(F.broadcast(most), F.col("a_id") == F.col("__a"))
    return out.select("pair", "a_id", "b_id", "documents", (F.col("documents") == F.col("__most")).alias("best"))


def heads(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """The most frequent pairs, ``most`` at most, and the rest; None when there is none."""
    size = F.floor(F.log2("documents")).cast("int")
    sizes = dict(counts.groupBy(size.alias("s")).count().collect())
    total, least = 0, 64
    for s in sorted(sizes, reverse=True):
        total += sizes[s]
        if total > most:
            break
        least = s
    if total <= most:
        return counts, None
    return counts.where(size >= least), counts.where(size < least)


def link_sums(aligned: DataFrame, counts: DataFrame, key: str = "doc_id") -> DataFrame:
    """aligned's key, counts and digest with n_best (links of best pairs) and count_sum
    (documents of each link's pair, summed).  ``aligned`` must be a written table."""
    sc = aligned.sparkSession.sparkContext
    head, tail = heads(counts, HEADS)
    got = head.select(F.col("pair").cast("long").alias("pair"), "documents", "best").toArrow()
    pair, documents, best = (got[c].to_numpy() for c in ("pair", "documents", "best"))
    order = np.argsort(pair)
    table = sc.broadcast((pair[order], documents[order].astype(np.int64), best[order].astype(np.int64)))
    kept = [key, "row", *COUNTS, "groups_sha256"]
    kind = dict(aligned.dtypes)["pairs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, documents, best = table.value
        for batch in batches:
            if not batch.num_rows:
                continue
            lists, times = batch.column(len(kept)), batch.column(len(kept) + 1)
            ends = lists.offsets.to_numpy().astype(np.int64)
            p = lists.flatten().to_numpy().astype(np.int64)
            t = times.flatten().to_numpy().astype(np.int64)
            at = np.minimum(np.searchsorted(pair, p), max(len(pair) - 1, 0))
            hit = pair[at] == p if len(pair) else np.zeros(len(p), bool)
            upto = np.concatenate([np.zeros((2, 1), np.int64), np.zeros((2, len(p)), np.int64)], axis=1)
            for n, x in enumerate((best, documents)):
                if len(pair):
                    upto[n, 1:] = np.cumsum(np.where(hit, x[at] * t, 0))
            ends -= ends[0]
            sums = upto[:, ends[1:]] - upto[:, ends[:-1]]
            left = np.concatenate([[0], np.cumsum(~hit)])[ends].astype(np.int32)
            missing = [pa.ListArray.from_arrays(pa.array(left), pa.array(x[~hit]).cast(c.type.value_type)) for c, x in ((lists, p), (times, t))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], *map(pa.array, sums), *missing],
                                             names=[*kept, "n_best", "count_sum", "pairs", "times"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.select(*kept).schema)
    out = aligned.select(*kept, "pairs", "times").mapInArrow(run, f"{schema}, n_best long, count_sum long, pairs {kind}, times array<long>")
    final = [key, *COUNTS, "n_best", "count_sum", "groups_sha256"]
    if tail is None:
        return out.select(*final)
    out = materialize(out)
    rest = out.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("t"))
    more = rest.join(tail.select("pair", "documents", "best"), "pair").groupBy("row").agg(
        F.sum(F.col("t") * F.col("best").cast("long")).alias("__best"), F.sum(F.col("t") * F.col("documents")).alias("__sum"))
    zero = F.lit(0).cast("long")
    out = out.join(more, "row", "left").withColumn("n_best", F.col("n_best") + F.coalesce("__best", zero))
    return out.withColumn("count_sum", F.col("count_sum") + F.coalesce("__sum", zero)).select(*final)


def link(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document its tokens, groups and links, read against the counts of all documents."""
    aligned = materialize(align(docs, a_path, b_path, key, text))
    return link_sums(aligned, pair_counts(aligned, b_path), key)
