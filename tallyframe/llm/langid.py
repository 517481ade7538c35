"""Language of whole texts: averaged hashed subword embeddings and a linear softmax.

A text is lower-cased and everything ASCII but letters becomes a blank; its 2-, 3- and
4-byte grams are hashed to buckets, a bucket has an embedding, and the mean embedding
of all grams goes through a linear softmax.  Embeddings and weights are learned by
stochastic gradient descent in numpy on at most ``FIT_PER_LANG`` texts a language (by
hash of their id).  A fifth of these is kept back to calibrate: a temperature for the
scores, and the score below which an answer is marked as rejected (``REJECT`` of right
answers lie below).  For prediction embedding and weights fold into one score per bucket
and language, so a text costs one look-up per gram; texts go through in parts, so
length does not matter.

Edge cases: NULL texts and texts without a letter are ``und`` with score 0.0 and
rejected.  Rows without language or id are not learned from; those without id count
as held out.  Without labelled rows every text is ``und``.  With one language all texts
with letters are that.  Repeated rows are predicted each; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIT_PER_LANG = 400
MOST_LANGS = 500
BUCKETS = 1 << 16
DIM = 16
EPOCHS = 6
REJECT = 0.01
PART = 1_000_000
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[i for i in range(128) if not chr(i).isalpha()]] = 32
_ODD = [np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)]


def parts(texts: pa.Array) -> Iterator[list[tuple[int, bytes]]]:
    """(row, bytes) pieces of lower-cased texts, PART bytes or so together; long texts
    come in pieces that overlap by three bytes, so that no gram is lost; the blanks between
    pieces add a few grams for every PART bytes."""
    batch, held = [], 0
    for i, t in enumerate(pc.utf8_lower(texts)):
        data = t.as_buffer().to_pybytes() if t.is_valid else b""
        for a in range(0, max(len(data) - 3, 1), PART):
            batch.append((i, data[a:a + PART + 3]))
            held += len(batch[-1][1])
            if held >= PART:
                yield batch
                batch, held = [], 0
    if batch:
        yield batch


def grams(batch: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the grams that start at each place (one row per size), and the place
    where each piece begins.  Pieces are parted by four blanks."""
    data = _PLAIN[np.frombuffer(b"    ".join([*(x for _, x in batch), b""]), np.uint8)].astype(np.uint32)
    two = data[:-1] * _ODD[0] + data[1:] * _ODD[1]
    out, h = np.empty((3, len(data) - 3), np.uint32), two
    for n in range(3):
        g = (h ^ (h >> np.uint32(15))) * _ODD[2]
        out[n] = ((g ^ (g >> np.uint32(13))) & np.uint32(BUCKETS - 1))[:len(data) - 3]
        h = h[:-1] * _ODD[0] + data[n + 2:]
    sizes = np.array([len(x) + 4 for _, x in batch])
    return out, np.concatenate([[0], np.cumsum(sizes)[:-1]])


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    table: np.ndarray  # score of each bucket and language
    bias: np.ndarray
    temperature: float
    accept: float

    def logits(self, texts: pa.Array) -> np.ndarray:
        total, count = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for batch in parts(texts):
            g, begin = grams(batch)
            each = self.table[g[0]] + self.table[g[1]] + self.table[g[2]]
            begin = np.minimum(begin, len(each) - 1)
            row = np.array([i for i, _ in batch])
            np.add.at(total, row, np.add.reduceat(each, begin, axis=0))
            np.add.at(count, row, 3 * np.diff(np.append(begin, len(each))))
        return (total / np.maximum(count, 1)[:, None] + self.bias) / self.temperature


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def histogram(texts: Iterable[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, shares) of each text."""
    out = []
    for t in texts:
        c = np.zeros(BUCKETS)
        for batch in parts(pa.array([t], pa.string())):
            g, _ = grams(batch)
            c += np.bincount(g.ravel(), minlength=BUCKETS)
        i = np.flatnonzero(c)
        out.append((i, (c[i] / c[i].sum()).astype(np.float32)))
    return out


def train(texts: list[str], labels: np.ndarray, langs: tuple[str, ...], seed: int = 1) -> Model:
    rng = np.random.default_rng(seed)
    hists = histogram(texts)
    n, c = len(texts), len(langs)
    kept_back = np.arange(n) % 5 == 4
    learn = np.flatnonzero(~kept_back)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    w, b = np.zeros((DIM, c), np.float32), np.zeros(c, np.float32)
    w += rng.normal(0, 0.3, w.shape).astype(np.float32)
    for epoch in range(EPOCHS):
        rate = np.float32(1.0 - epoch / EPOCHS)
        order = rng.permutation(learn)
        for a in range(0, len(order), 16):
            some = order[a:a + 16]
            idx = np.concatenate([hists[i][0] for i in some])
            share = np.concatenate([hists[i][1] for i in some])
            size = np.array([len(hists[i][0]) for i in some])
            begin = np.cumsum(size) - size
            x = np.add.reduceat(emb[idx] * share[:, None], begin, axis=0)
            g = softmax(x @ w + b)
            g[np.arange(len(some)), labels[some]] -= 1
            gx = (g @ w.T).astype(np.float32)
            w -= rate * 2 * (x.T @ g / len(some)).astype(np.float32)
            b -= rate * 0.5 * g.mean(0).astype(np.float32)
            # the step of a bucket: all texts of the batch that hold it
            by = np.argsort(idx, kind="stable")
            at, first = np.unique(idx[by], return_index=True)
            step = np.add.reduceat((share[:, None] * np.repeat(gx, size, axis=0))[by], first, axis=0)
            emb[at] -= rate * 40 / len(some) * step
    table = (emb @ w).astype(np.float32)
    test = np.flatnonzero(kept_back) if kept_back.any() else learn
    z = np.stack([(table[i] * s[:, None]).sum(0) + b for i, s in (hists[j] for j in test)]).astype(float)
    y = labels[test]
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = [-np.log(softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in grid]
    t = float(grid[int(np.argmin(loss))])
    p = softmax(z / t)
    right = p.max(1)[p.argmax(1) == y]
    return Model(langs, table, b.astype(float), t, float(np.quantile(right, REJECT)) if len(right) else 1.0)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", per_lang: int = FIT_PER_LANG) -> Model | None:
    """Model from labelled rows that are not held out."""
    rows = docs.where(~held_out(F.col(key)) & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = rows.groupBy(F.col(lang).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(MOST_LANGS).collect()
    if not counts:
        return None
    mark = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(2**31))
    share = docs.sparkSession.createDataFrame([(r.lang, int(min(1.0, 1.1 * per_lang / r["count"]) * 2**31)) for r in counts], "__l string, __most long")
    some = rows.join(F.broadcast(share), F.col(lang) == F.col("__l")).where(mark <= F.col("__most"))
    got = some.select(F.col(text).alias("t"), F.col(lang).alias("l"), mark.alias("m")).limit(2 * per_lang * len(counts)).toPandas()
    got = got.sort_values(["m", "t"], kind="stable").groupby("l", sort=False).head(per_lang)
    langs = tuple(sorted(set(got["l"])))
    return train(got["t"].tolist(), np.array([langs.index(x) for x in got["l"]]), langs)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(True))


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, lang_pred, score, rejected) for each row."""
    t = F.col(text).cast("string")
    rows = docs.select(F.col(key), held_out(F.col(key)).alias("held_out"), t.alias("__t"), F.coalesce(t.rlike(r"\p{L}"), F.lit(False)).alias("__ok"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            ok = batch.column(3).to_numpy(zero_copy_only=False)
            lang, score = np.full(n, "und", object), np.zeros(n)
            if model is not None and ok.any():
                p = softmax(model.logits(batch.column(2).filter(batch.column(3))))
                lang[ok] = np.array(model.langs, object)[p.argmax(1)]
                score[ok] = p.max(1)
            rejected = ~ok | (score < model.accept) if model is not None else ~ok | True
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)],
                                             names=[key, "held_out", "lang_pred", "score", "rejected"])

    kind = dict(docs.dtypes)[key]
    return rows.mapInArrow(run, f"{key} {kind}, held_out boolean, lang_pred string, score double, rejected boolean")
