"""Each stage of the pipeline against a plain reading of what it should do."""

import importlib
import subprocess
import sys
from collections import Counter

import pytest
import sentencepiece

import corpus_pipeline
from ledgerloom.llm import mixing, pii, queries, simhash, toxicity

from test_pii import base
from test_simhash import components, fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def test_stages_have_the_columns_of_documents(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "pii", "mixing", "sentencepiece"]
    for df in kept[1:-1]:
        assert df.columns == kept[0].columns


def test_toxic_documents_go_and_no_others(spark, kept):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(kept[0], labels.where(toxicity.remainder("doc_id", 3) != 1))
    want = {r.doc_id for r in toxicity.score(kept[0], model, keep=["doc_id"]).collect() if r.score < 0.7}
    assert sorted(map(tuple, kept[1].collect())) == sorted(tuple(r) for r in kept[0].collect() if r.doc_id in want)


def test_one_of_each_group_stays(kept):
    texts = {r.doc_id: r.text for r in kept[1].collect()}
    groups = components({i: fingerprint(t) for i, t in texts.items()})
    assert sorted(r.doc_id for r in kept[2].collect()) == sorted(set(groups.values()))


def test_personal_data_is_gone(kept):
    before = {r.doc_id: r for r in kept[2].collect()}
    after = {r.doc_id: r for r in kept[3].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert not base(r.text) and r.n_chars == len(r.text)
        spans = base(before[i].text)
        if not spans and '"' not in before[i].text:
            assert r.text == before[i].text
        assert sum(r.text.count(f"[{k.upper()}]") for k in pii.KINDS[: pii.BASE]) <= len(spans)
    assert any(base(r.text) for r in before.values())


def test_mix_repeats_and_drops(kept):
    times = Counter(r.doc_id for r in kept[4].collect())
    plan = {r.doc_id: r["__copies"] for r in mixing.mixed(kept[3]).collect()}
    assert {i: times[i] for i in plan} == plan and set(plan.values()) > {1}


def test_ids_are_the_librarys(kept):
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    texts = {r.doc_id: r.text for r in kept[4].collect()}
    rows = kept[5].collect()
    assert len(rows) == kept[4].count()
    for r in rows:
        assert r.ids == sp.encode(texts[r.doc_id], add_eos=True) and r.decoded == texts[r.doc_id] and r.n_tokens == len(r.ids)


def test_run_gives_the_last_stages_rows(spark, kept):
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, SF).collect()) == sorted(tuple(r) for r in kept[5].collect())


def test_odd_rows_pass_every_stage(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "ok " * 40_000, "en", None, None),
            (3, "mail a.b@c.org now", None, "s", 18)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            frame = corpus_pipeline.written(stage(spark, frame, SF), name)
        assert frame.columns == ["doc_id", "source", "n_tokens", "ids", "decoded"]
    assert frame.count() == 0


def test_library_without_this_package(tmp_path):
    code = ("import sys\nclass Gone:\n    def find_spec(self, name, *a):\n        if name == 'corpus_pipeline' or name.startswith('ledgerloom.llm'):\n"
            "            raise ModuleNotFoundError(name, name=name)\nsys.meta_path.insert(0, Gone())\nimport __spark_entry__ as e\n"
            "q = e.queries()\nassert q and 'pipeline' not in q and not any(n.startswith('op') for n in q)\n")
    root = importlib.import_module("__spark_entry__").__file__.rpartition("/")[0]
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root)
