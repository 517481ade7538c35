"""Ranked lexical search for many items at once by two trees.

A document's coordinate at a term is what the term adds to its score, an item's is how
often it asks for the term; a score is the product of the two vectors.  Both sides get a
tree whose nodes hold the largest value of each coordinate below them, so the product of
an item node and a document node bounds every score between them.  A pair of nodes whose
bound is below the weakest k-th score of the node's items is left out with all that hangs
below it: nothing else can be among the best, so results are exact.

Documents are read once: their terms that some item asks for are written as numbers with
their counts, and document frequencies and lengths are summed from there.  Then each task
builds trees over a few thousand documents at a time and searches them for all items of a
block.  Its k-th scores start from those of a bounded sample of documents, which are true
scores and so change no result.  Tasks return k rows an item at most.

Items are worked on in blocks of BLOCK_BYTES of text, the only thing that every task gets.
Scores are 64-bit integers; bounds are integers too.

Edge cases: NULL texts, on either side, have no terms; items without terms and documents
with score 0 give no rows.  Items equal in id and text are one item; the same id with
other texts is ranked for each text.  Documents that repeat rank one by one.  NULL
document ids come last among equal scores.  With no document or no item there are no rows.
Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.packing import slices, spread
from tallyframe.session import materialize

# Characters that stand between terms; capitals become small letters.
BREAKS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
FOLD = bytes(0x20 if b in BREAKS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
BLOCK_BYTES = 1_000_000
CHUNK = 4096
LEAF = 32
ITEM_LEAF = 4
SAMPLE = 20_000
SALTS = 64


def terms(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(FOLD).split()


def weigh(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Rows:
    """Sparse rows: (term, value) runs, sorted by term within a row."""

    def __init__(self, ends: np.ndarray, term: np.ndarray, value: np.ndarray):
        self.ends, self.term, self.value = ends, term, value

    def __len__(self) -> int:
        return len(self.ends) - 1

    def take(self, rows: np.ndarray) -> Rows:
        size = self.ends[rows + 1] - self.ends[rows]
        at = spread(self.ends[rows], size)
        return Rows(np.concatenate([[0], np.cumsum(size)]), self.term[at], self.value[at])

    def tops(self, cuts: np.ndarray) -> Rows:
        """Largest value of each term in runs of rows that begin at ``cuts``."""
        node = np.repeat(np.searchsorted(cuts, np.arange(len(self)), side="right") - 1, np.diff(self.ends))
        order = np.lexsort((self.term, node))
        node, term, value = node[order], self.term[order], self.value[order]
        if not len(node):
            return Rows(np.zeros(len(cuts) + 1, np.int64), term, value)
        new = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (term[1:] != term[:-1])]))
        ends = np.searchsorted(node[new], np.arange(len(cuts) + 1))
        return Rows(ends, term[new], np.maximum.reduceat(value, new))

    def times(self, vector: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Products of some rows and a dense vector."""
        size = self.ends[rows + 1] - self.ends[rows]
        at = spread(self.ends[rows], size)
        upto = np.concatenate([[0], np.cumsum(self.value[at] * vector[self.term[at]])])
        end = np.cumsum(size)
        return upto[end] - upto[end - size]


def apart(rows: Rows, width: int) -> np.ndarray:
    """How much nearer each row is to one of two unlike rows than to the other."""
    every = np.arange(len(rows))
    size = np.diff(rows.ends)
    upto = np.concatenate([[0.0], np.cumsum(rows.value.astype(float) ** 2)])
    norm = np.sqrt(np.maximum(upto[rows.ends[1:]] - upto[rows.ends[:-1]], 1e-9))
    mean = np.bincount(rows.term, rows.value / np.repeat(norm, size), width) / len(rows)

    def like(row: int) -> np.ndarray:
        vector = np.zeros(width)
        span = slice(rows.ends[row], rows.ends[row + 1])
        vector[rows.term[span]] = rows.value[span] / norm[row]
        return rows.times(vector, every) / norm

    one = like(int((rows.times(mean, every) / norm).argmin()))
    return one - like(int(one.argmin()))


def split(rows: Rows, width: int, leaf: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(order, levels) of a tree: rows are halved by ``apart`` until ``leaf`` are left.
    A level holds the first places of its nodes."""
    order = np.arange(len(rows))
    levels = [np.zeros(1, np.int64)]
    while True:
        cuts = levels[-1]
        ends = np.append(cuts[1:], len(order))
        if (ends - cuts).max() <= leaf:
            return order, levels
        new = []
        for lo, hi in zip(cuts.tolist(), ends.tolist()):
            new.append(lo)
            if hi - lo > leaf:
                key = apart(rows.take(order[lo:hi]), width)
                order[lo:hi] = order[lo:hi][np.argsort(-key, kind="stable")]
                new.append((lo + hi) // 2)
        levels.append(np.array(new))


class Tree:
    """Rows in tree order, the node maxima of each level, and each node's children."""

    def __init__(self, rows: Rows, width: int, leaf: int):
        self.order, cuts = split(rows, width, leaf)
        self.rows = rows.take(self.order)
        cuts = [*cuts, np.arange(len(rows))]  # the last level: single rows
        self.levels = [self.rows]
        for c in reversed(cuts[:-1]):
            self.levels.insert(0, self.levels[0].tops(np.searchsorted(cuts[len(cuts) - len(self.levels)], c)))
        self.children = [np.append(np.searchsorted(b, a), len(b)) for a, b in zip(cuts, cuts[1:])]

    def below(self, level: int, nodes: np.ndarray) -> np.ndarray:
        first = self.children[level]
        return spread(first[nodes], first[nodes + 1] - first[nodes])


class Items:
    """The items of a block: their ids, terms and tree."""

    def __init__(self, rows: list[tuple[int, bytes]]):
        each = [Counter(terms(raw)) for _, raw in rows]
        self.vocabulary = {t: i for i, t in enumerate(sorted(set().union(*each)))}
        self.terms = sorted(self.vocabulary)
        pairs = [sorted((self.vocabulary[t], n) for t, n in c.items()) for c in each]
        ends = np.concatenate([[0], np.cumsum([len(p) for p in pairs])]).astype(np.int64)
        flat = np.array([x for p in pairs for x in p], np.int64).reshape(-1, 2)
        self.rows = Rows(ends, flat[:, 0], flat[:, 1])
        self.count = len(rows)
        self.tree = Tree(self.rows, len(self.terms), ITEM_LEAF) if rows else None


class Best:
    """The k best documents of each item so far; ``least`` is what a score must reach."""

    def __init__(self, k: int, floor: np.ndarray):
        self.k, self.least = k, np.maximum(floor, 1)
        self.found: list[list[tuple]] = [[] for _ in floor]

    def add(self, item: int, scores: np.ndarray, places: np.ndarray, keys: list) -> None:
        """Places are in order of the keys, NULL last, so ties go by place."""
        some = np.flatnonzero(scores >= self.least[item])
        if not len(some):
            return
        some = some[np.lexsort((places[some], -scores[some]))[:self.k]]
        new = [(-s, keys[p] is None, keys[p]) for s, p in zip(scores[some].tolist(), places[some].tolist())]
        held = sorted([*self.found[item], *new], key=lambda x: (x[0], x[1], 0 if x[2] is None else x[2]))[:self.k]
        self.found[item] = held
        if len(held) == self.k:
            self.least[item] = max(self.least[item], -held[-1][0])


def search(items: Items, docs: Rows, keys: list, best: Best) -> int:
    """Search one tree of documents for all items; returns the number of scores worked out."""
    tree = Tree(docs, len(items.terms), LEAF)
    ours = items.tree
    last_i, last_d = len(ours.levels) - 1, len(tree.levels) - 1
    vector, held = np.zeros(len(items.terms), np.int64), [np.zeros(0, np.int64)]
    weakest = {}

    def least(level: int, node: int) -> int:
        """The weakest k-th score below an item node; it only rises, so an old one is safe."""
        if (level, node) not in weakest:
            rows = np.array([node])
            for n in range(level, last_i):
                rows = ours.below(n, rows)
            weakest[level, node] = int(best.least[ours.order[rows]].min())
        return weakest[level, node]

    def loaded(level: int, node: int) -> bool:
        here = ours.levels[level]
        span = slice(here.ends[node], here.ends[node + 1])
        vector[held.pop()] = 0
        held.append(here.term[span])
        vector[held[0]] = here.value[span]
        return span.stop > span.start

    scored = 0
    # first scores: each item follows the best bound down to one leaf
    for row in range(items.count):
        loaded(last_i, row)
        nodes = np.zeros(1, np.int64)
        for depth in range(last_d - 1):
            nodes = tree.below(depth, nodes)
            nodes = nodes[[tree.levels[depth + 1].times(vector, nodes).argmax()]]
        nodes = tree.below(last_d - 1, nodes)
        scored += len(nodes)
        item = int(ours.order[row])
        kth = np.sort(tree.levels[last_d].times(vector, nodes))[-best.k:]
        if len(kth) == best.k:
            best.least[item] = max(best.least[item], int(kth[0]))
    stack = [(0, 0, 0, np.zeros(1, np.int64))]
    while stack:
        level, node, depth, nodes = stack.pop()
        if not loaded(level, node):
            continue
        bound = tree.levels[depth].times(vector, nodes)
        if level == last_i and depth == last_d:
            scored += len(nodes)
            best.add(int(ours.order[node]), bound, tree.order[nodes], keys)
            continue
        floor = int(best.least[ours.order[node]]) if level == last_i else least(level, node)
        nodes = nodes[bound >= floor]
        if not len(nodes):
            continue
        if depth < last_d:
            nodes, depth = tree.below(depth, nodes), depth + 1
        if level < last_i:
            stack += [(level + 1, int(c), depth, nodes) for c in ours.below(level, np.array([node]))]
        else:
            stack.append((level, node, depth, nodes))
    return scored


def postings(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """(key, n, term, tf): each document with a term, and its terms of the vocabulary."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = vocabulary
        for batch in batches:
            for part in slices(batch):
                n, ends, term, tf = [], [0], [], []
                for raw in part.column(1).to_pylist():
                    words = terms(raw)
                    n.append(len(words))
                    got = Counter(words)
                    some = sorted([(code[t], got[t]) for t in got.keys() & code.keys()])
                    term += [c for c, _ in some]
                    tf += [c for _, c in some]
                    ends.append(len(term))
                ends = pa.array(ends, pa.int32())
                cols = [part.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(tf, pa.int32()))]
                out = pa.RecordBatch.from_arrays(cols, names=["key", "n", "term", "tf"])
                yield out.filter(pc.greater(out.column(1), 0))

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n long, term array<int>, tf array<int>")


def coordinates(batch: pa.RecordBatch, weight: np.ndarray, documents: int, length: int) -> Rows:
    """What each term adds to a document's score, in 64-bit integers."""
    lists = batch.column(2)
    ends = lists.offsets.to_numpy().astype(np.int64)
    term = lists.flatten().to_numpy().astype(np.int64)
    tf = batch.column(3).flatten().to_numpy().astype(np.int64)
    m = 100 - 75 + 75 * batch.column(1).to_numpy() * documents // length
    value = weight[term] * (1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, np.diff(ends))))
    return Rows(ends - ends[0], term, value)


def top(found: DataFrame, by: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("key").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search_block(post: DataFrame, items: Items, ids: list, id_type, weight: np.ndarray, documents: int, length: int, k: int) -> DataFrame:
    """(item, key, score): per task the best documents of each item."""
    sc = post.sparkSession.sparkContext
    kind = post.schema["key"].dataType.simpleString()

    def searched(rows: DataFrame, floor: np.ndarray) -> DataFrame:
        shared = sc.broadcast((items, weight, floor))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items, weight, floor = shared.value
            best, schema = Best(k, floor), None

            def chunk(held: list[pa.RecordBatch]) -> None:
                t = pa.Table.from_batches(held).combine_chunks()
                t = t.take(pc.sort_indices(t["key"], null_placement="at_end")).combine_chunks()
                b = t.to_batches()[0]
                search(items, coordinates(b, weight, documents, length), b.column(0).to_pylist(), best)

            held, n = [], 0
            for batch in batches:
                schema = batch.schema
                for at in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(at, CHUNK)
                    held.append(part)
                    n += part.num_rows
                    if n >= CHUNK:
                        chunk(held)
                        held, n = [], 0
            if n:
                chunk(held)
            if schema is not None:
                rows = [(i, x[2], -x[0]) for i, got in enumerate(best.found) for x in got]
                cols = list(zip(*rows)) if rows else [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], schema.field(0).type), pa.array(cols[2], pa.int64())],
                                                 names=["item", "key", "score"])

        return rows.select("key", "n", "term", "tf").mapInArrow(run, f"item int, key {kind}, score long")

    none = np.zeros(items.count, np.int64)
    floor = none
    if documents > 2 * SAMPLE:
        # k-th scores of some documents: a lower bound of all documents' k-th scores
        share = F.pmod(F.xxhash64("key", "n"), F.lit(documents)) < SAMPLE
        some = searched(post.where(share), none)
        kth = top(some, ["item"], k).where(F.col("rank") == k).select("item", "score").collect()
        floor = none.copy()
        for r in kth:
            floor[r.item] = r.score
    found = searched(post, floor)
    found = top(found.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS))), ["item", "salt"], k)
    found = top(found, ["item"], k)
    names = post.sparkSession.createDataFrame(list(enumerate(ids)), f"__item int, item_id {id_type}")
    return found.join(F.broadcast(names), F.col("item") == F.col("__item")).select("item_id", "rank", "key", "score")


def rank(docs: DataFrame, asked: DataFrame, k: int = 10, key: str = "doc_id", item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, rank, key, score): each item's k highest-scoring documents."""
    spark = docs.sparkSession
    wanted = asked.select(F.col(f"`{item}`").alias("id"), F.col(f"`{text}`").cast("string").cast("binary").alias("raw")).where("raw IS NOT NULL").distinct()
    id_type, key_type = wanted.schema["id"].dataType.simpleString(), docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    blocks = int((wanted.agg(F.sum(F.octet_length("raw") + 16)).first()[0] or 0) // BLOCK_BYTES) + 1
    out = None
    for n in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("id", "raw"), F.lit(blocks)) == n).collect()
        rows = sorted(((r.id, bytes(r.raw)) for r in rows), key=lambda r: (r[0] is None, 0 if r[0] is None else r[0], r[1]))
        rows = [r for r in rows if terms(r[1])]
        if not rows:
            continue
        items = Items(rows)
        post = materialize(postings(docs, items.vocabulary, key, text))
        total = post.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
        if not total.n:
            continue
        df = np.zeros(len(items.terms), np.int64)
        seen = post.select(F.explode("term").alias("t")).groupBy("t").agg(F.count("*").alias("n")).toArrow()
        df[seen["t"].to_numpy()] = seen["n"].to_numpy()
        weight = np.array([weigh(total.n, x) for x in df.tolist()], np.int64)
        got = search_block(post, items, [r[0] for r in rows], id_type, weight, total.n, total.l, k)
        out = got if out is None else out.unionByName(got)
    if out is None:
        return spark.createDataFrame([], f"`{item}` {id_type}, rank int, `{key}` {key_type}, score long")
    return out.select(F.col("item_id").alias(item), "rank", F.col("key").alias(key), "score")
