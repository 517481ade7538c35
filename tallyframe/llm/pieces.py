"""SentencePiece encoding and decoding by one walk over a trie of distinct words.

A text is marked as the model does it (a blank becomes ``▁``, one ``▁`` goes first) and
cut into marked words: blanks and what follows them.  No piece crosses such a border, nor
one between two characters that no piece holds side by side; words are cut there too.
The distinct words of a batch are sorted, so they form a trie in depth-first order; the
walk keeps the forward states along the current path and computes a state only where a
word leaves its predecessor.  Two states are kept per prefix:

* *Viterbi*: the best sum of piece scores, and the last piece of the best path (the
  longer piece on a tie).  This is the encoding of unigram models.
* *Merges*: the last piece of the prefix under the model's merge order.  A piece that
  ends the prefix is the last one exactly if it and the last piece of the prefix before
  it stay apart when merged by themselves; such pairs are looked up and remembered.  This
  is the encoding of BPE models, equal to the library's.

Characters outside the vocabulary become byte pieces.  Scores are summed as integers
when they are whole, so sums are exact.

Edge cases: NULL texts give NULL, empty ones no pieces.  A ``▁`` of the text itself is
taken for a blank, as in the library.  Repeated rows are encoded each;
an empty table gives an empty result.  Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.packing import slices, spread

MARK = "▁"
WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
KNOWN_WORDS = 500_000
KNOWN_PAIRS = 300_000
PART = 4_000_000


class Model:
    """Pieces, scores and the two encodings of words."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        self.names = [sp.id_to_piece(i) for i in ids]
        special = {i for i in ids if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)}
        self.piece = {self.names[i]: i for i in ids if i not in special}
        if any(MARK in p.lstrip(MARK) for p in self.piece) or sp.encode("b  a", out_type=str)[0][:1] != MARK:
            raise ValueError("a model is needed that marks blanks, keeps them all and has none inside pieces")
        raw = [sp.get_score(i) for i in ids]
        whole = all(s == int(s) for s in raw)
        self.score = [int(s) if whole else s for s in raw]
        self.unknown = min(self.score[i] for i in self.piece.values()) - 10
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes = [b"" if i in special else p.replace(MARK, " ").encode() for i, p in enumerate(self.names)]
        for b, i in enumerate(self.byte):
            self.bytes[i] = bytes([b])
        # pieces by their characters from the last to the first; "" holds the id
        self.ending: dict = {}
        for p, i in self.piece.items():
            at = self.ending
            for c in reversed(p):
                at = at.setdefault(c, {})
            at[""] = i
        # characters that stand side by side inside some piece; elsewhere no piece crosses
        self.inside = {p[n:n + 2] for p in self.piece for n in range(len(p) - 1)}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merge(self, word: str) -> list[str]:
        """Merges of a short string: best score first, leftmost on a tie."""
        s = list(word)
        while len(s) > 1:
            best = None
            for n in range(len(s) - 1):
                i = self.piece.get(s[n] + s[n + 1])
                if i is not None and (best is None or self.score[i] > best[0]):
                    best = (self.score[i], n)
            if best is None:
                break
            n = best[1]
            s[n:n + 2] = [s[n] + s[n + 1]]
        return s

    def apart(self, a: str, b: str) -> bool:
        """Whether pieces a and b, side by side, are what merging them gives."""
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) > KNOWN_PAIRS:
                self.pairs.clear()
            got = self.pairs[a, b] = self.merge(a + b) == ([a, b] if a else [b])
        return got

    def ids(self, pieces: list[str]) -> list[int]:
        out: list[int] = []
        for p in pieces:
            i = self.piece.get(p)
            out += [i] if i is not None else [self.byte[x] for x in p.encode()]
        return out

    def words(self, words: list[str]) -> dict[str, tuple[list[int], list[int], float]]:
        """(ids by merges, ids by Viterbi, score of the Viterbi path) of each word."""
        score, apart, ending = self.score, self.apart, self.ending
        best: list = [0]
        back = [0]  # length of the last piece on the best path
        last = [""]  # last piece by merges
        before, out = "", {}
        for word in sorted(set(words)):
            same, limit = 0, min(len(before), len(word))
            while same < limit and before[same] == word[same]:
                same += 1
            del best[same + 1:], back[same + 1:], last[same + 1:]
            for i in range(same + 1, len(word) + 1):
                node, j, sizes = ending.get(word[i - 1]), i - 1, []
                top, size = None, 1
                if node is None or "" not in node:
                    top = best[j] + self.unknown
                    sizes.append(1)
                while node is not None:
                    k = node.get("")
                    if k is not None:
                        s = best[j] + score[k]
                        sizes.append(i - j)
                        if top is None or s >= top:  # the longer piece on a tie
                            top, size = s, i - j
                    j -= 1
                    if j < 0:
                        break
                    node = node.get(word[j])
                tail = next(word[i - n:i] for n in reversed(sizes) if n == 1 or apart(last[i - n], word[i - n:i]))
                best.append(top)
                back.append(size)
                last.append(tail)
            merged, path, i = [], [], len(word)
            while i:
                merged.append(last[i])
                i -= len(last[i])
            i = len(word)
            while i:
                path.append(word[i - back[i]:i])
                i -= back[i]
            out[word] = (self.ids(merged[::-1]), self.ids(path[::-1]), best[-1])
            before = word
        return out

    def gives_back(self, word: str, ids: list[int]) -> bool:
        """Whether ids read as the marked word."""
        return b"".join(map(self.bytes.__getitem__, ids)) == word.replace(MARK, " ").encode()

    def decode(self, ids) -> str:
        """The text of ids by either encoding."""
        return b"".join(map(self.bytes.__getitem__, ids))[1:].decode("utf-8", "replace")


class Encoder:
    """Encodes batches of texts; words met before are remembered."""

    def __init__(self, path: str):
        self.model = Model(path)
        self.clear()

    def clear(self) -> None:
        self.code: dict[str, int] = {}
        self.flat = [np.zeros(0, np.int32)] * 2
        self.starts = [np.zeros(1, np.int64)] * 2
        self.scores, self.lost = np.zeros(0), np.zeros(0, np.int64)

    def learn(self, words: list[str]) -> np.ndarray:
        new = [w for w in words if w not in self.code]
        if new and len(self.code) + len(new) > KNOWN_WORDS:
            self.clear()
            new = words
        got = self.model.words(new)
        self.code.update(zip(got, range(len(self.code), len(self.code) + len(got))))
        for side in (0, 1):
            size = np.fromiter((len(v[side]) for v in got.values()), np.int64, len(got))
            ids = np.fromiter((i for v in got.values() for i in v[side]), np.int32, int(size.sum()))
            self.flat[side] = np.concatenate([self.flat[side], ids])
            self.starts[side] = np.concatenate([self.starts[side], self.starts[side][-1] + np.cumsum(size)])
        self.scores = np.concatenate([self.scores, np.array([v[2] for v in got.values()], float)])
        lost = np.fromiter((not self.model.gives_back(w, v[0]) for w, v in got.items()), np.int64, len(got))
        self.lost = np.concatenate([self.lost, lost])
        return np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))

    def encode(self, words: pa.Array, offsets: np.ndarray, prefix: str):
        """Per text: ends of its ids and the ids, by merges and by Viterbi, its score, and
        whether the ids by merges give it back, which they do if they do word by word."""
        coded = words.dictionary_encode()
        index = coded.indices.to_numpy()
        # words are cut once more where no piece of the vocabulary can cross
        bits, begin, inside, known = [], [], self.model.inside, self.code
        for w in coded.dictionary.to_pylist():
            w, a = prefix + w, 0
            begin.append(len(bits))
            if w in known:  # met before, and not cut then
                bits.append(w)
                continue
            for n in range(1, len(w)):
                if w[n - 1:n + 1] not in inside:
                    bits.append(w[a:n])
                    a = n
            bits.append(w[a:])
        codes = self.learn(bits)
        total = (lambda x: np.add.reduceat(x, begin)) if begin else (lambda x: x)
        out = []
        for side in (0, 1):
            first = self.starts[side][codes]
            size = self.starts[side][codes + 1] - first
            ids, size = self.flat[side][spread(first, size)], total(size)
            first, size = (np.cumsum(size) - size)[index], size[index]
            upto = np.concatenate([[0], np.cumsum(size)])
            out.append((upto[offsets].astype(np.int32), ids[spread(first, size)]))
        sums = [np.concatenate([[0], np.cumsum(total(x[codes])[index])]) for x in (self.scores, self.lost)]
        score, lost = (x[offsets[1:]] - x[offsets[:-1]] for x in sums)
        return (*out, score, lost == 0)


def encoded(batches: Iterator[pa.RecordBatch], model_path: str):
    """(rows, merged, path, score, same) for runs of rows (key, text); merged and path are
    (ends, ids), NULL texts read as empty."""
    encoder = Encoder(model_path)
    for batch in batches:
        for part in slices(batch, PART):
            texts = pc.fill_null(part.column(1), "")
            # texts with single blanks inside need no regular expression
            odd = pc.or_(pc.match_substring_regex(texts, f"  |{MARK}|^ | $"), pc.equal(texts, ""))
            for odd_, chosen in ((False, pc.invert(odd)), (True, odd)):
                some = part.filter(chosen)
                if not some.num_rows:
                    continue
                t = pc.fill_null(some.column(1), "")
                if odd_:
                    lists = pa.array([WORD.findall(MARK + x.replace(" ", MARK)) if x else [] for x in t.to_pylist()], pa.list_(pa.string()))
                else:
                    lists = pc.split_pattern(t, " ")
                offsets = lists.offsets.to_numpy().astype(np.int64)
                yield some, *encoder.encode(lists.flatten(), offsets - offsets[0], "" if odd_ else MARK)


SCHEMA = "ids array<int>, viterbi_ids array<int>, viterbi_score double"


def encode(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, ids, viterbi_ids, viterbi_score) for each row."""
    rows = docs.select(F.col(key), F.col(text).cast("string").alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, merged, path, score, _ in encoded(batches, model_path):
            gone = pc.is_null(some.column(1))
            cols = [pa.ListArray.from_arrays(pa.array(o), pa.array(x)) for o, x in (merged, path)]
            cols = [pc.if_else(gone, pa.scalar(None, c.type), c) for c in (*cols, pa.array(score))]
            yield pa.RecordBatch.from_arrays([*some.columns, *cols], names=[key, text, "ids", "viterbi_ids", "viterbi_score"])

    kind = dict(docs.dtypes)[key]
    return rows.mapInArrow(run, f"{key} {kind}, {text} string, {SCHEMA}")


def decode(coded: DataFrame, model_path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """coded with the text of an id column; NULL ids give NULL."""
    from pyspark.sql import types as T

    rest = [c for c in coded.columns if c != name]
    df = coded.select(*rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(model_path)
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(ids))
            text = [None if x is None else model.decode(x) for x in (v.values.to_numpy() if v.is_valid else None for v in col)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(text, pa.string())], names=[*rest, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.StringType())]))


def summary(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and CRC-32 sums (of unsigned little-endian 32-bit ids) of both encodings, and
    whether the text comes back from its ids.  The ids themselves do not leave the task;
    NULL texts have NULL counts and come back."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))

    def told(ends: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
        raw = memoryview(ids.astype("<u4")).cast("B") if len(ids) else memoryview(b"")
        at = (4 * ends.astype(np.int64)).tolist()
        sums = [zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:])]
        return [np.diff(ends).astype(np.int64), np.array(sums, np.int64)]

    names = ["n_pieces", "ids_crc32", "n_viterbi", "viterbi_crc32", "viterbi_score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some, merged, path, score, same in encoded(batches, model_path):
            gone = pc.is_null(some.column(1))
            cols = [*told(*merged), *told(*path), score.astype(np.int64)]
            cols = [pc.if_else(gone, pa.scalar(None, pa.int64()), pa.array(c)) for c in cols]
            yield pa.RecordBatch.from_arrays([some.column(0), *cols, pa.array(same)], names=["key", *names, "round_trip"])

    kind = rows.schema["key"].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, {', '.join(n + ' long' for n in names)}, round_trip boolean")
    return out.withColumnRenamed("key", key)
