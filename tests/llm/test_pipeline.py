from __future__ import annotations

import pytest

import corpus_pipeline
from tests.llm.conftest import prose
from venuelens.llm.queries import ORACLES, QUERIES
from venuelens.llm.storage import keep

NAMES = ["toxicity", "near_dedup", "decontamination", "pii", "mixing"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents, labels and benchmark with planted cases."""
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = []
    for i in range(300):
        text = ". ".join(prose(1000 * i + k, 9) for k in range(6)) + "."
        if i % 10 == 0:
            text += " you vilething of " + prose(i, 3)
        docs.append((i, text))
    docs += [(1001, docs[1][1]), (1002, docs[2][1] + " more"), (1003, docs[3][1] + " " + prose(9000, 12)), (1004, docs[4][1] + " mail to ab.c@mail.example.com now"), (1005, None), (1006, "")]
    langs = ["en", "de", "fr", "es"]
    rows = [(i, t, langs[i % 4], f"src{i % 3}", None if t is None else len(t)) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, prose(9000, 12))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_take_effect_one_after_another(spark, folder):
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    seen = [ids(docs)]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = keep(stage(spark, docs, folder))
        if k < 4:
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        seen.append(ids(docs))
    toxic = {i for i in range(300) if i % 10 == 0}
    assert seen[0] - seen[1] == toxic
    # 1003 and 1004 are no near copies in five-word shingles only if enough was added; brute force decides.
    sets = {r.doc_id: _shingles(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if r.doc_id in seen[1]}
    copies = {b for b in (1001, 1002, 1003, 1004) for a in (b - 1000,) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert {1001, 1002} <= copies and seen[1] - seen[2] == copies
    assert seen[2] - seen[3] == {1003} - copies
    assert seen[3] == seen[4]
    assert not docs.where("text like '%@mail%'").count()
    final = docs.collect()
    assert all(r.copies >= 1 and r.rate > 0 for r in final)


def _shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set()


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 11))
    assert set(ORACLES) <= set(QUERIES)
