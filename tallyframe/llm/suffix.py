"""Removal of long repeated byte strings through longest-previous-factor arrays.

A string of ``size`` bytes that occurs twice is found without comparing documents:

1. Each window of ``size`` bytes elects an anchor, the rightmost of its 32-byte grams
   with the smallest hash.  Equal windows elect the same gram at the same place.  A run
   of windows with one anchor is a *context*, about 560 bytes of text.
2. Contexts are counted by (anchor, content).  Copies of one context need no text.
3. Where an anchor has several different contexts, their texts (one copy each) meet in
   one task; those that share no side of the anchor with another one drop out, the rest
   is laid end to end in document order.  A suffix array over that block gives,
   through previous and next smaller positions in suffix order, the longest previous
   factor of every position; larger positions give the longest later one.  A window is
   repeated where such a factor is ``size`` bytes or longer.
4. Anchors with more than ``GROUP`` different contexts are not brought into one task:
   their windows are counted by content, with partial sums, and joined back.
5. The spans of a document are merged and cut out.

``keep="first"`` removes later copies only, in order of (key, place); ``keep="none"``
removes every copy, the first included.  Windows are judged on the input.

Edge cases: NULL texts count as empty, keep NULL and remove nothing.  Texts shorter
than ``size`` bytes remove nothing.  Rows that are equal in key and text count as copies
of each other under "none" and as one document under "first".  NULL keys are a value
of their own and sort first.  An empty table gives an empty result.  Input columns
named like a result column are replaced; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.session import HOT_KEYS, State, materialize

GRAM = 32
GROUP = 2000
BLOCK = 1_000_000
PART = 3_000_000
_PLACE = np.uint64(22)
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


# ── fingerprints of one task's documents ─────────────────────────────────────

def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD[0]
    h = (h ^ (h >> np.uint64(29))) * _ODD[1]
    return h ^ (h >> np.uint64(32))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each place, by doubling."""
    h, n = mix(data.astype(np.uint64) + np.uint64(1)), 1
    for m in _ODD:
        h = h[:-n] * m + h[n:]
        n *= 2
    return mix(h)


def elect(data: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Place of the anchor of the window at each start, and all gram hashes."""
    grams = gram_hashes(data)
    place = np.arange(len(grams), dtype=np.uint64)
    low = np.uint64((1 << int(_PLACE)) - 1)
    v = ((grams >> _PLACE) << _PLACE) | (low - place)
    span, width = size - GRAM + 1, 1
    while width * 2 <= span:
        v = np.minimum(v[:-width], v[width:])
        width *= 2
    rest = span - width
    v = np.minimum(v[:len(v) - rest], v[rest:]) if rest else v
    return (low - (v & low)).astype(np.int64), grams


def contexts(texts: Iterable[tuple[int, bytes]], size: int) -> list[np.ndarray]:
    """Runs of windows with one anchor, from (document, bytes) parts: columns document,
    start, windows, shift of the anchor, anchor hash, content hash."""
    found = []
    batch, held = [], 0

    def work():
        data = np.frombuffer(b"".join(x for _, _, x in batch), np.uint8)
        if len(data) < size:
            return
        anchor, grams = elect(data, size)
        ends = np.cumsum([len(x) for _, _, x in batch])
        begins = ends - [len(x) for _, _, x in batch]
        starts = np.concatenate([np.arange(b, e - size + 1) for b, e in zip(begins, ends)])
        owner = np.repeat(np.arange(len(batch)), ends - begins - size + 1)
        at = anchor[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(starts)))
        lo, own, at = starts[first], owner[first], at[first]
        shift = at - lo
        view = memoryview(data)
        digest = xxhash.xxh3_64_intdigest
        content = np.fromiter((digest(view[a:a + m - 1 + size], s) for a, m, s in zip(lo.tolist(), n.tolist(), shift.tolist())),
                              np.uint64, len(lo))
        doc = np.array([d for d, _, _ in batch])[own]
        base = np.array([b for _, b, _ in batch])[own]
        found.append(np.stack([doc, base + lo - begins[own], n, shift, grams[at].view(np.int64), content.view(np.int64)]))

    for doc, text in texts:
        # very long texts in parts that overlap by a window
        for a in range(0, len(text) - size + 1, PART):
            part = text[a:a + PART + size - 1]
            if batch and held + len(part) > PART:
                work()
                batch, held = [], 0
            batch.append((doc, a, part))
            held += len(part)
    if batch:
        work()
    return found


def fingerprint(docs: DataFrame, size: int) -> DataFrame:
    """(k, h, anchor, ctx, n, shift, los): each document's contexts, equal ones together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = ((i, t.as_buffer().to_pybytes()) for i, t in enumerate(batch.column(2)) if t.is_valid)
            got = contexts(texts, size)
            if not got:
                continue
            doc, lo, n, shift, anchor, ctx = np.concatenate(got, axis=1)
            order = np.lexsort((lo, ctx, anchor, doc))
            doc, lo, n, shift, anchor, ctx = (x[order] for x in (doc, lo, n, shift, anchor, ctx))
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1]) | (ctx[1:] != ctx[:-1])
            first = np.flatnonzero(new)
            los = pa.ListArray.from_arrays(pa.array(np.append(first, len(doc)), pa.int32()), pa.array(lo, pa.int32()))
            take = pa.array(doc[first])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(anchor[first]), pa.array(ctx[first]),
                 pa.array(n[first], pa.int32()), pa.array(shift[first], pa.int32()), los],
                names=["k", "h", "anchor", "ctx", "n", "shift", "los"])

    kind = dict(docs.dtypes)["k"]
    return docs.mapInArrow(run, f"k {kind}, h long, anchor long, ctx long, n int, shift int, los array<int>")


# ── suffix arrays of one block ───────────────────────────────────────────────

def suffix_array(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes by their first ``depth`` codes or more (ties by place), and
    the common prefix of each with the one before it, exact up to that depth."""
    n = len(codes)
    pad = np.zeros(3, np.int64)
    c = np.concatenate([codes.astype(np.int64), pad])
    key = (c[:n] << 27) | (c[1:n + 1] << 18) | (c[2:n + 2] << 9) | c[3:n + 3]
    ranks, h = [], 4
    while True:
        order = np.argsort(key, kind="stable" if h >= depth else None)
        s = key[order]
        step = np.zeros(n, np.int64)
        step[1:] = s[1:] != s[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step) + 1
        ranks.append((h, rank.astype(np.int32)))
        if h >= depth:
            break
        after = np.zeros(n, np.int64)
        after[:n - h] = rank[h:]
        key = rank * (n + 1) + after
        h *= 2
    a, b = order[:-1], order[1:]
    common = np.zeros(n - 1, np.int64)
    for h, rank in reversed(ranks):
        rank = np.append(rank, np.int32(0))
        x, y = np.minimum(a + common, n), np.minimum(b + common, n)
        common += h * ((rank[x] == rank[y]) & (rank[x] > 0))
    for _ in range(3):
        x, y = np.minimum(a + common, n), np.minimum(b + common, n)
        common += (c[x] == c[y]) & (c[x] > 0)
    return order, np.concatenate([[0], common])


def nearest(place: np.ndarray, lcp: np.ndarray, back: bool, smaller: bool) -> np.ndarray:
    """Common prefix of each suffix with the nearest one before (``back``) or after it in
    suffix order that starts at a smaller (else larger) place; 0 where there is none."""
    n = len(place)
    if not back:
        return nearest(place[::-1], np.concatenate([[0], lcp[1:][::-1]]), True, smaller)[::-1]
    p = np.concatenate([[-1], place if smaller else -place])
    if not smaller:
        p[0] = -(1 << 62)
    at, least = np.arange(n + 1) - 1, np.concatenate([[0], lcp])
    at[0] = 0
    live = np.arange(1, n + 1)
    while len(live := live[p[at[live]] > p[live]]):
        j = at[live]
        # all jumps read the pointers as they were before this round
        jump, low = at[j], np.minimum(least[live], least[j])
        at[live], least[live] = jump, low
    least[at == 0] = 0
    return least[1:]


def factors(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and longest next factor at each place, where ``size`` or longer
    (lengths are exact to twice ``size`` at least), else 0.  Code 0 separates texts."""
    before, after = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
    if len(codes) < 2:
        return before, after
    order, lcp = suffix_array(codes, size)
    lcp = np.where(lcp >= size, lcp, 0)
    # only suffixes with a long neighbour matter; a 0 parts the runs
    use = np.flatnonzero((lcp > 0) | (np.append(lcp[1:], 0) > 0))
    place, lcp = order[use], lcp[use]
    before[place] = np.maximum(nearest(place, lcp, True, True), nearest(place, lcp, False, True))
    after[place] = np.maximum(nearest(place, lcp, True, False), nearest(place, lcp, False, False))
    return before, after


def runs(mask: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return [{"a": a, "b": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]


PAIRS = "array<struct<a:int,b:int>>"
_PAIRS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))


def repeated_starts(rows: DataFrame, size: int) -> DataFrame:
    """rows (anchor, ctx, n, shift, body), sorted by document within an anchor and whole
    anchors in a partition: the runs of windows whose content starts before or after.

    Equal windows lie alike about their anchor and reach ``side`` bytes beyond it on one
    side at least.  A context that shares neither side with another one of its anchor
    holds no repeat and needs no suffix array."""
    side = (size - GRAM) // 2

    def sides(row) -> list:
        anchor, _, _, shift, body = row
        view, digest = memoryview(body), xxhash.xxh3_64_intdigest
        out = []
        if shift >= side:
            out.append((anchor, 0, digest(view[shift - side:shift + GRAM])))
        if len(body) - shift - GRAM >= side:
            out.append((anchor, 1, digest(view[shift:shift + GRAM + side])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows of one block
        total = 0

        def work(part):
            each = [sides(r) for r in part]
            shared = Counter(x for e in each for x in e)
            part = [r for r, e in zip(part, each) if any(shared[x] > 1 for x in e)]
            codes, ends, at = [np.zeros(0, np.int16)], [], 0
            for _, _, n, _, body in part:
                codes += [np.frombuffer(body, np.uint8).astype(np.int16) + 1, np.zeros(1, np.int16)]
                ends.append((at, n))
                at += len(body) + 1
            before, after = factors(np.concatenate(codes), size)
            return pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()),
                pa.array([runs(before[s:s + n] > 0) for s, n in ends], _PAIRS),
                pa.array([runs(after[s:s + n] > 0) for s, n in ends], _PAIRS)], names=["anchor", "ctx", "before", "after"])

        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(5)]
            for row in zip(*cols):
                if total >= BLOCK and row[0] != held[-1][0]:
                    yield work(held)
                    held, total = [], 0
                if held and row[:2] == held[-1][:2]:
                    continue  # a repeated row of the input
                held.append(row)
                total += len(row[4])
        if held:
            yield work(held)

    return rows.mapInArrow(run, f"anchor long, ctx long, before {PAIRS}, after {PAIRS}")


def repeated_windows(rows: DataFrame, size: int) -> DataFrame:
    """The same for anchors with too many contexts for one task: windows are counted by
    content (two 64-bit hashes and the anchor), and the counts joined back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for anchor, ctx, n, body, rank in zip(*[batch.column(c).to_pylist() for c in ("anchor", "ctx", "n", "body", "rank")]):
                view = memoryview(body)
                for i in range(n):
                    d = xxhash.xxh3_128_digest(view[i:i + size])
                    out.append((anchor, ctx, i, d, rank))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, (pa.int64(), pa.int64(), pa.int32(), pa.binary(), rows_rank))],
                names=["anchor", "ctx", "i", "w", "rank"])

    from pyspark.sql.pandas.types import to_arrow_type

    rows_rank = to_arrow_type(rows.schema["rank"].dataType)
    rank = rows.schema["rank"].dataType.simpleString()
    each = rows.select("anchor", "ctx", "n", "body", "rank").mapInArrow(run, f"anchor long, ctx long, i int, w binary, rank {rank}")
    seen = each.groupBy("anchor", "w").agg(F.count("*").alias("c"), F.min("rank").alias("lo"), F.max("rank").alias("hi")).where("c > 1")
    got = State(seen, ["anchor", "w"]).attach(each, how="inner")
    one = F.struct(F.col("i").alias("a"), (F.col("i") + 1).alias("b"))
    return got.groupBy("anchor", "ctx").agg(
        F.collect_list(F.when(F.col("lo") < F.col("rank"), one)).alias("before"),
        F.collect_list(F.when(F.col("hi") > F.col("rank"), one)).alias("after"))


# ── the operator ─────────────────────────────────────────────────────────────

def spans(docs: DataFrame, size: int, keep: str, group: int) -> DataFrame:
    """(k, h, spans): byte spans to remove, by document; docs has k, h and text."""
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    prints = materialize(fingerprint(docs.select("k", "h", "text"), size))
    rank = F.struct("k", "h", F.col("los")[0].alias("lo"))
    counted = materialize(prints.groupBy("anchor", "ctx", "n", "shift").agg(
        F.sum(F.size("los")).alias("total"), F.count("*").alias("docs"), F.min(rank).alias("rank")))
    several = counted.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    todo = counted.join(several, "anchor").select("anchor", "ctx", "n", "shift", "rank", "kinds")
    # one copy of the text of each context that meets others
    by_doc = todo.groupBy(F.col("rank.k").alias("k"), F.col("rank.h").alias("h")).agg(
        F.collect_list(F.struct("anchor", "ctx", "n", "shift", "kinds", F.col("rank.lo").alias("lo"))).alias("c"))
    text = docs.select(F.col("k").alias("k2"), F.col("h").alias("h2"), F.encode("text", "UTF-8").alias("data"))
    bodies = text.join(by_doc, F.col("k2").eqNullSafe(F.col("k")) & (F.col("h2") == F.col("h")))
    bodies = bodies.select("k", "h", "data", F.explode("c").alias("c")).select(
        "c.anchor", "c.ctx", "c.n", "c.shift", "c.kinds", F.struct("k", "h", "c.lo").alias("rank"),
        F.expr(f"substring(data, c.lo + 1, c.n - 1 + {size})").alias("body"))
    crowded = (several.agg(F.max("kinds")).first()[0] or 0) > group
    bodies = materialize(bodies) if crowded else bodies
    few = bodies.where(F.col("kinds") <= group).repartition("anchor").sortWithinPartitions("anchor", "rank")
    found = repeated_starts(few.select("anchor", "ctx", "n", "shift", "body"), size)
    if crowded:
        found = found.unionByName(repeated_windows(bodies.where(F.col("kinds") > group), size))
    found = materialize(found.where((F.size("before") > 0) | (F.size("after") > 0)))
    # what is known of each context that has copies or repeated windows
    known = counted.join(found, ["anchor", "ctx"], "left").where("total > 1 OR before IS NOT NULL")
    known = known.select("anchor", "ctx", "total", "rank", "before", "after")
    rows = counted.agg(F.sum("docs")).first()[0] or 0
    hot = counted.where(F.col("docs") * HOT_KEYS > rows).select("anchor", "ctx").collect()
    hot = docs.sparkSession.createDataFrame(hot, "anchor long, ctx long") if hot else None
    met = State(known, ["anchor", "ctx"], stored=True)
    got = met.attach(prints, "inner", hot=hot) if hot is not None else prints.join(known, ["anchor", "ctx"])
    each = got.select("k", "h", "n", "total", "rank", "before", "after", F.explode("los").alias("lo"))
    whole = F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b")))
    none = F.array().cast(PAIRS)
    if keep == "none":
        part = F.concat(F.coalesce("before", none), F.coalesce("after", none))
        pairs = F.when(F.col("total") > 1, whole).otherwise(part)
    else:
        first = F.col("k").eqNullSafe(F.col("rank.k")) & (F.col("h") == F.col("rank.h")) & (F.col("lo") == F.col("rank.lo"))
        pairs = F.when(first, F.coalesce("before", none)).otherwise(whole)
    out = each.select("k", "h", "lo", F.explode(pairs).alias("p")).select(
        "k", "h", F.struct((F.col("lo") + F.col("p.a")).alias("s"), (F.col("lo") + F.col("p.b") - 1 + size).alias("e")).alias("span"))
    return out.groupBy("k", "h").agg(F.collect_list("span").alias("spans"))


RESULT = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]


def cut(docs: DataFrame, text: str, whole_chars: bool) -> DataFrame:
    """docs with a column ``spans``: the text without them, and RESULT."""
    names = [c for c in docs.columns if c != "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.schema.get_field_index(text)
            texts, stats = [], []
            for t, todo in zip(batch.column(col), batch.column(batch.schema.get_field_index("spans")).to_pylist()):
                data = t.as_buffer().to_pybytes() if t.is_valid else b""
                merged: list[list[int]] = []
                for s, e in sorted((x["s"], x["e"]) for x in todo or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(e, merged[-1][1])
                    else:
                        merged.append([s, e])
                if whole_chars:  # a character is cut whole or not at all
                    for m in merged:
                        while m[0] < len(data) and data[m[0]] & 0xC0 == 0x80:
                            m[0] += 1
                        while m[1] < len(data) and data[m[1]] & 0xC0 == 0x80:
                            m[1] -= 1
                at, parts = 0, []
                for s, e in merged:
                    parts.append(data[at:s])
                    at = e
                left = b"".join([*parts, data[at:]])
                texts.append(None if not t.is_valid else left.decode("utf-8", "replace") if merged else t.as_py())
                stats.append((len(data), len(data) - len(left), len(merged), hashlib.sha256(left).hexdigest()))
            n_bytes, n_removed, n_spans, sha = zip(*stats) if stats else [[]] * 4
            cols = [pa.array(texts, pa.string()) if c == text else batch.column(batch.schema.get_field_index(c)) for c in names]
            cols += [pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, *RESULT])

    from pyspark.sql import types as T

    schema = T.StructType([f for f in docs.schema if f.name in names])
    for c, kind in zip(RESULT, (T.LongType(), T.LongType(), T.LongType(), T.StringType())):
        schema = schema.add(c, kind)
    return docs.mapInArrow(run, schema)


def remove(docs: DataFrame, size: int = 400, keep: str = "first", key: str = "doc_id", text: str = "text",
           group: int = GROUP, whole_chars: bool = True) -> DataFrame:
    """docs with repeated strings of ``size`` bytes cut from the text, and n_bytes,
    n_removed, n_spans and kept_sha256 (of the bytes left).  With ``whole_chars`` spans
    shrink to whole characters, so that the text stays valid; without, the digest is of
    exact bytes while a broken character in the text reads U+FFFD."""
    if size < 2 * GRAM:
        raise ValueError(f"size must be {2 * GRAM} or more")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in [*RESULT, "spans"]])
    docs = docs.withColumn(text, F.col(text).cast("string"))
    base = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    found = spans(base.where("text IS NOT NULL"), size, keep, group)
    found = found.select(F.col("k").alias("__k"), F.col("h").alias("__kh"), "spans")
    mine = docs.withColumn("__h", F.xxhash64(text))
    out = mine.join(found, mine[key].eqNullSafe(found["__k"]) & (mine["__h"] == found["__kh"]), "left")
    return cut(out.select(*docs.columns, "spans"), text, whole_chars)
