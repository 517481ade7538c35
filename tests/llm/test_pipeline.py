"""The pipeline by stages, each against its own operator or a plain reading of it."""

import random
from collections import Counter

import pytest

import corpus_pipeline as cp
from tests.llm.test_dartminhash import classes, family
from tests.llm.test_packing import verify
from tests.llm.test_suffix import brute


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root, folder = tmp_path_factory.mktemp("stages"), "/root/testdata/sf0.001"
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, f in cp.STAGES:
        f(spark, docs, folder).write.parquet(str(root / name))
        docs = spark.read.parquet(str(root / name))
        out.append(docs)
    return out


def test_documents_only_go(spark, stages):
    all_ = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    quality = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()}
    before = set(all_)
    for df in stages[:4]:
        assert df.columns == cp.COLUMNS
        now = {r.doc_id for r in df.collect()}
        assert now <= before
        before = now
    kept = {r.doc_id for r in stages[1].collect()}
    assert not [d for d, q in quality.items() if q == 0 and d in kept]
    assert len([d for d, q in quality.items() if q and d in kept]) > 0.85 * sum(quality.values())


def test_near_dedup_and_suffix_against_brute_force(stages):
    rows = sorted((r.doc_id, r.text) for r in stages[1].collect())
    want = {k for k, c, _ in classes(rows) if k == c}
    assert {r.doc_id for r in stages[2].collect()} == want
    rows = sorted((r.doc_id, r.text) for r in stages[2].collect())
    left = {r.doc_id: r for r in stages[3].collect()}
    for (k, t), (n, gone, _, _) in zip(rows, brute([t for _, t in rows], cp.PASSAGE, "first")):
        if gone < n:
            assert abs(len(left[k].text.encode()) - (n - gone)) <= 6 and left[k].n_chars == (len(left[k].text) if gone else len(t))


def test_pieces(stages):
    assert verify(stages[4].collect(), [(r.doc_id, r.text) for r in stages[3].collect()]) == 0


def test_run_and_edges(spark, tmp_path):
    rows = [(i, t, "en", "src1", len(t)) for i, t in enumerate(family(4, 6) + family(5, 3, 400))]
    rows += [(50, None, None, None, None), (51, "", "en", None, 0), (None, family(6, 1)[0], "en", "src1", 1), rows[8]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    ids = Counter(r.doc_id for r in cp.run(spark, str(tmp_path)).select("doc_id").distinct().collect())
    assert None in ids and 50 not in ids and 51 not in ids and len(ids) <= 4
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "none" / "labels.parquet"))
    assert cp.run(spark, str(tmp_path / "none")).count() == 0


def test_passages_of_fifty_to_sixty_five_words_stay_once(spark):
    rnd = random.Random(4)
    text = lambda n: " ".join("".join(rnd.choice("aeiorstnl") for _ in range(rnd.randint(2, 9))) for _ in range(n))
    passages = [text(n) for n in range(51, 66)]
    rows = [(i, f"{text(80)} {p} {text(80)}", "en", "s", 0) for i, p in enumerate([*passages, *passages, *passages])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    left = [r.text for r in cp.suffix_dedup(spark, docs, "").orderBy("doc_id").collect()]
    for i, p in enumerate(passages):
        assert p in left[i]
        for later in (left[15 + i], left[30 + i]):  # but for letters that the texts around share by chance
            assert len(p) - 3 <= len(rows[i][1]) - len(later) + abs(len(rows[i][1]) - len(left[i])) or p[5:-5] not in later
            assert p[3:-3] not in later
