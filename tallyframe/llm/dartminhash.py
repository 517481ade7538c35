"""Near duplicates by DartMinHash signatures over weighted word shingles.

A text is the weighted set of its lower-cased five-word shingles, weighted by how often
each occurs; two texts are linked when the sum of minimum weights is 0.8 or more of the
sum of maximum weights.

*Signature.*  For each shingle the plane weight × rank is tiled by dyadic cells; a
cell's hash says how many darts lie in it (Poisson by area), where, and which of the
``K`` coordinates each belongs to.  A text keeps the darts below its weights, up to the
rank where about K·(ln K + 4) are expected, and per coordinate the dart of lowest rank.
Texts agree on a coordinate with the probability of their weighted similarity, and the
work is one pass over the shingles plus the darts.  Texts with a bare coordinate look
on at twice the rank.

*Links.*  Equal texts are one node.  ``BANDS`` bands of ``K / BANDS`` coordinates make
rooms; two texts at 0.8 share one with probability 0.99997.  In a room 16-bit sketches
are compared in place and only a maximum spanning forest leaves it; those pairs are
checked exactly.  In a second round the texts that may still be linked to another
component (estimate of ``FLOOR`` or more, which loses 4 in a million of links at 0.8)
bring their whole shingle weights to the room; all pairs are compared there and again
only a forest of links leaves.  So no step emits all pairs of a group.  Rooms with more
than ``ROOM`` nodes are compared block by block, a task for each pair of blocks.

Edge cases: NULL texts are alone in their class, named by their own id.  Texts without
words are linked to equal texts only.  Texts of one to four words are one shingle.
A class is named by its smallest id; NULL ids do not name classes unless alone.
Repeated rows share a class.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyframe.llm.graph import components
from tallyframe.llm.words import mix, word_codes
from tallyframe.session import HOT_KEYS, State, materialize

SHINGLE = 5
SIMILAR = (8, 10)
K, BANDS = 80, 20
FLOOR = 0.6
ROOM = 2000
PART = 8_000_000
LOW_RANK = 2.0 ** -5
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD1342543DE82EF95, 0xC2B2AE3D27D4EB4F)]
_BITS = np.uint64(48)
_MASK = np.uint64((1 << 48) - 1)


def unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)) * 2.0 ** -53


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (document, shingle, weight) of up to 65,536 texts; shingles as 48-bit hashes."""
    h, upto = word_codes(texts)
    n = np.diff(upto)
    count = np.where(n > 0, np.maximum(n - SHINGLE + 1, 1), 0)
    doc = np.repeat(np.arange(len(n)), count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(upto[:-1], count)
    end = np.repeat(upto[1:], count)
    code = np.zeros(len(start), np.uint64)
    h = np.append(h, np.uint64(0))
    for j in range(SHINGLE):
        code = mix(code * _M[3] + np.where(start + j < end, h[np.minimum(start + j, len(h) - 1)], np.uint64(j)))
    key = np.sort((doc.astype(np.uint64) << _BITS) | (code >> np.uint64(16)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    weight = np.diff(np.append(first, len(key)))
    key = key[first]
    return (key >> _BITS).astype(np.int64), key & _MASK, weight


_CDF: dict[float, np.ndarray] = {}


def poisson(area: float) -> np.ndarray:
    """Chances of at most 0, 1, 2, … darts in a cell of this area."""
    if area not in _CDF:
        j = np.arange(int(area + 12 * np.sqrt(area) + 30))
        logs = np.concatenate([[0.0], np.cumsum(np.log(np.maximum(j[1:], 1)))])
        _CDF[area] = np.cumsum(np.exp(j * np.log(area) - area - logs))
    return _CDF[area]


def darts(elem: np.ndarray, weight: np.ndarray, limit: np.ndarray):
    """Darts under the weights and up to each element's rank limit: index of the element,
    hash, rank."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0))]
    for wl in range(int(np.ceil(np.log2(max(weight.max(), 1)))) + 1):
        low_w = 0.0 if wl == 0 else 2.0 ** (wl - 1)
        wide = 1.0 if wl == 0 else low_w
        some = np.flatnonzero(weight > low_w)
        rl = 0
        while len(some):
            low_r = 0.0 if rl == 0 else LOW_RANK * 2.0 ** (rl - 1)
            high = LOW_RANK if rl == 0 else low_r
            some = some[limit[some] > low_r]
            seed = np.uint64((wl * 1000 + rl + 1) * 0x2545F4914F6CDD1D & (1 << 64) - 1)
            h = mix(elem[some] * _M[0] + seed)
            u = unit(h)
            cdf = poisson(wide * high)
            hit = np.flatnonzero(u > cdf[0])
            n = np.searchsorted(cdf, u[hit])
            at = np.repeat(hit, n)
            nth = (np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + 1).astype(np.uint64)
            d = mix(h[at] + nth * _M[4])
            rank = low_r + unit(d) * high
            i = some[at]
            code = mix(d ^ _M[1])
            ok = (rank <= limit[i]) & (low_w + unit(code) * wide < weight[i])
            found.append((i[ok], mix(code ^ _M[2])[ok], rank[ok]))
            rl += 1
    return tuple(map(np.concatenate, zip(*found)))


def signatures(doc: np.ndarray, elem: np.ndarray, weight: np.ndarray, docs: int) -> np.ndarray:
    """One row of K dart hashes per document that has elements (others stay 0)."""
    out = np.zeros((docs, K), np.uint64)
    total = np.bincount(doc, weight, docs)
    expect = K * (np.log(K) + 4)
    todo = total > 0
    while todo.any():
        use = np.flatnonzero(todo[doc])
        d = doc[use]
        limit = expect / total[d]
        i, code, rank = darts(elem[use], weight[use].astype(float), limit)
        slot = d[i] * K + (code % np.uint64(K)).astype(np.int64)
        order = np.argsort((slot << 38) | (rank / limit[i] * (2.0 ** 38 - 1)).astype(np.int64))
        slot, code = slot[order], code[order]
        first = np.ones(len(slot), bool)
        first[1:] = slot[1:] != slot[:-1]
        got = np.zeros(docs * K, bool)
        got[slot[first]] = True
        values = np.zeros(docs * K, np.uint64)
        values[slot[first]] = code[first]
        full = got.reshape(docs, K).all(1) & todo
        out[full] = values.reshape(docs, K)[full]
        todo &= ~full
        expect *= 2
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = K // BANDS
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(sig), BANDS)).copy()
    for r in range(rows):
        key = mix(key * _M[3] + sig[:, r::rows])
    return key.view(np.int64)


def sign(texts: DataFrame) -> DataFrame:
    """(node, bands, sketch) for rows (node, text) that have words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            part = np.cumsum(size + 150) // PART
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                doc, elem, weight = shingles(batch.column(1).slice(a, b - a))
                sig = signatures(doc, elem, weight, b - a)
                some = np.unique(doc)
                sig = sig[some]
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * BANDS), pa.array(band_keys(sig).ravel()))
                sketch = pa.array([x.tobytes() for x in (sig >> np.uint64(40)).astype(np.uint16)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).take(pa.array(some)), bands, sketch],
                                                 names=["node", "bands", "sketch"])

    return texts.mapInArrow(run, "node binary, bands array<long>, sketch binary")


# ── rooms ────────────────────────────────────────────────────────────────────

def rooms(signed: DataFrame) -> DataFrame:
    """(room, node, sketch): nodes that share a band, in rooms of bounded size."""
    each = signed.select("node", F.explode("bands").alias("key"))
    sizes = materialize(each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    total = signed.count() * BANDS
    hot = sizes.where(F.col("n") * HOT_KEYS > total).select("key").collect()
    hot = signed.sparkSession.createDataFrame(hot, "key long") if hot else None
    rows = State(sizes, ["key"], stored=True).attach(each, "inner", hot=hot) if hot is not None else each.join(sizes, "key")
    rows = materialize(rows.select("node", "key", "n"))
    small = rows.where(F.col("n") <= ROOM).select(F.struct(F.col("key"), F.lit(0).cast("long").alias("key2"), F.lit(0).alias("i"), F.lit(0).alias("j")).alias("room"), "node")
    large = rows.where(F.col("n") > ROOM)
    if large.limit(1).count():
        # block by block, a task for each pair of blocks
        blocks = F.ceil(2 * F.col("n") / ROOM).cast("int")
        sub = large.withColumn("b", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), blocks - 1)))
        room = F.struct(F.col("key"), F.lit(0).cast("long").alias("key2"), F.least("b", "o").cast("int").alias("i"), F.greatest("b", "o").cast("int").alias("j"))
        small = small.unionByName(sub.select(room.alias("room"), "node"))
    return small.join(signed.select("node", "sketch"), "node")


def forest(same: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of a maximum spanning forest over similarities of FLOOR or more."""
    n = len(same)
    best, link = np.full(n, -1.0), np.zeros(n, int)
    out, left = [], np.ones(n, bool)
    for _ in range(n):
        v = int(np.argmax(np.where(left, best, -2.0)))
        if best[v] >= FLOOR:
            out.append((link[v], v))
        left[v] = False
        nearer = same[v] > best
        best[nearer], link[nearer] = same[v][nearer], v
    return out


def by_room(rows: DataFrame, columns: list[str], schema: str, work) -> DataFrame:
    """``work`` on the rows of each room, which lie together in one task; it returns a
    list of tuples for ``schema``."""
    ordered = rows.select(*columns).repartition("room").sortWithinPartitions("room", "node")
    names = StructType.fromDDL(schema).names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        kinds: list[pa.Field] = []

        def out(found):
            cols = list(zip(*found)) if found else [[] for _ in kinds]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kinds)], names=[f.name for f in kinds])

        found: list[tuple] = []
        for batch in batches:
            node = batch.schema.field("node").type
            known = {"a": node, "b": node, **{f.name: f.type for f in batch.schema}}
            kinds = [pa.field(c, known[c]) for c in names]
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and row[0] != held[-1][0]:
                    found += work(held)
                    held = []
                held.append(row)
            yield out(found)
            found = []
        if held:
            yield out(work(held))

    return ordered.mapInArrow(run, schema)


ROOM_TYPE = "struct<key:bigint,key2:bigint,i:int,j:int>"


def alike(sketches: list[bytes]) -> np.ndarray:
    """Shares of equal sketch coordinates."""
    s = np.frombuffer(b"".join(sketches), np.uint16).reshape(len(sketches), K)
    same = np.empty((len(s), len(s)), np.float32)
    for a in range(0, len(s), 64):
        same[a:a + 64] = (s[a:a + 64, None, :] == s[None, :, :]).mean(2)
    return same


def trees(placed: DataFrame) -> DataFrame:
    """(a, b): a spanning forest of each room by sketches."""

    def work(held):
        if len(held) < 2:
            return []
        pairs = forest(alike([r[2] for r in held]))
        return [tuple(sorted((held[i][1], held[j][1]))) for i, j in pairs]

    return by_room(placed, ["room", "node", "sketch"], "a binary, b binary", work).distinct()


def contenders(placed: DataFrame) -> DataFrame:
    """(room, node, label) of nodes that a sketch allows to be linked to another label."""

    def work(held):
        if len({r[3] for r in held}) == 1:
            return []
        _, code = np.unique(np.array([r[3] for r in held], dtype=object), return_inverse=True)
        near = (alike([r[2] for r in held]) >= FLOOR) & (code[:, None] != code[None, :])
        return [(held[i][0], held[i][1], held[i][3]) for i in np.flatnonzero(near.any(1))]

    return by_room(placed, ["room", "node", "sketch", "label"], f"room {ROOM_TYPE}, node binary, label binary", work)


def features(texts: DataFrame) -> DataFrame:
    """(node, feats): one 32-bit hash for each unit of weight of each shingle, so that
    shared weight is a count of equal hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2000):
                part = batch.slice(a, 2000)
                doc, elem, weight = shingles(part.column(1))
                layer = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
                code = mix(np.repeat(elem, weight) * _M[0] + layer.astype(np.uint64)).astype(np.uint32).view(np.int32)
                ends = np.concatenate([[0], np.cumsum(np.bincount(doc, weight, part.num_rows))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(code))], names=["node", "feats"])

    return texts.mapInArrow(run, "node binary, feats array<int>")


def joins(rows: DataFrame) -> DataFrame:
    """(a, b): links that connect different labels in a room, by whole weights.  All pairs
    of a room are compared as products of 0/1 matrices, and a forest of links leaves."""

    def work(held):
        m = len(held)
        size = np.array([len(r[3]) for r in held])
        values, col, count = np.unique(np.concatenate([np.asarray(r[3], np.int32) for r in held]), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(m), size)
        use = count[col] > 1
        new = np.cumsum(count > 1) - 1
        row, col = row[use], new[col[use]]
        order = np.argsort(col, kind="stable")
        row, col = row[order], col[order]
        shared = np.zeros((m, m), np.float32)
        for lo in range(0, int((count > 1).sum()), 4096):
            some = slice(*np.searchsorted(col, [lo, lo + 4096]))
            x = np.zeros((m, 4096), np.float32)
            x[row[some], col[some] - lo] = 1
            shared += x @ x.T
        union = size[:, None] + size[None, :] - shared
        up = {r[2]: r[2] for r in held}

        def top(x):
            while up[x] != x:
                x = up[x]
            return x

        out = []
        for i, j in np.argwhere(np.triu(SIMILAR[1] * shared >= SIMILAR[0] * union, 1)).tolist():
            a, b = top(held[i][2]), top(held[j][2])
            if a != b:
                up[a] = b
                out.append(tuple(sorted((held[i][1], held[j][1]))))
        return out

    return by_room(rows, ["room", "node", "label", "feats"], "a binary, b binary", work).distinct()


def linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose weighted similarity is SIMILAR or more, by their whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                n = part.num_rows
                sides = [shingles(part.column(c)) for c in (2, 3)]
                keys = [(d.astype(np.uint64) << _BITS) | e for d, e, _ in sides]
                _, i, j = np.intersect1d(*keys, assume_unique=True, return_indices=True)
                shared = np.bincount(sides[0][0][i], np.minimum(sides[0][2][i], sides[1][2][j]), n)
                union = sum(np.bincount(s[0], s[2], n) for s in sides) - shared
                keep.append((SIMILAR[1] * shared >= SIMILAR[0] * union) & (shared > 0))
            mask = pa.array(np.concatenate(keep) if keep else np.zeros(0, bool))
            yield batch.select(["a", "b"]).filter(mask)

    a = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb")
    return both.mapInArrow(run, "a binary, b binary")


def classed(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(id, node) of the rows of docs, and (id, node, label) of those that have a text."""
    base = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    base = base.withColumn("node", F.unhex(F.md5("text")))
    texts = base.where("text IS NOT NULL").select("node", "text")
    signed = materialize(sign(texts).groupBy("node").agg(F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    placed = materialize(rooms(signed))
    near = placed.select("node").distinct()
    met = materialize(texts.join(near, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")))
    links = materialize(linked(materialize(trees(placed)), met))
    labels = components(links)
    named = placed.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_ = materialize(contenders(named))
    if open_.limit(1).count():
        feats = features(met.join(open_.select("node").distinct(), "node", "left_semi"))
        more = materialize(joins(open_.join(feats, "node")))
        links = materialize(links.unionByName(linked(more, met)))
        labels = components(links)
    ids = materialize(base.select("id", "node"))
    known = State(labels.select("node", "label"), ["node"], stored=True).attach(ids.where("node IS NOT NULL"))
    return ids, known.select("id", "node", F.coalesce("label", "node").alias("label"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id, class_size): one row per row of docs."""
    ids, known = classed(docs, key, text)
    known = known.select("id", "label")
    classes = known.groupBy("label").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"))
    out = State(classes, ["label"]).attach(known).select(F.col("id").alias(key), "class_id", "class_size")
    alone = ids.where("node IS NULL").select(F.col("id").alias(key), F.col("id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return out.unionByName(alone)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one document of each class: the one that names it (of several texts under
    that id, one).  Rows without an id stay, as nothing names them, and so do different
    texts under one id; rows equal in id and text stay once, the smallest of them."""
    _, known = classed(docs, key, text)
    stays = known.where("id IS NOT NULL").groupBy("label").agg(F.min(F.struct("id", "node")).alias("m")).select(F.col("m.id").alias("__id"), F.col("m.node").alias("__of"))
    node = F.unhex(F.md5(F.col(text).cast("string")))
    rows = docs.withColumn("__node", node)
    named = rows.where(F.col(key).isNotNull() & F.col("__node").isNotNull())
    left = named.join(stays, (named[key] == stays["__id"]) & (named["__node"] == stays["__of"]), "left_semi")
    left = left.unionByName(rows.where(F.col(key).isNotNull() & F.col("__node").isNull()))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    left = left.groupBy(key, "__node").agg(F.min(row).alias("__row")).select("__row.*")
    return left.unionByName(docs.where(F.col(key).isNull()))
