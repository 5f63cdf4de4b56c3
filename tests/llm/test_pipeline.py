import collections
import hashlib

import pytest
import sentencepiece
from helpers import MODEL, documents, words
from test_documents import brute_classes, brute_cleaned

import corpus_pipeline
from quarry.llm import common

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows after each stage, each written and read again."""
    folder = str(tmp_path_factory.mktemp("stages"))
    docs = documents(spark).select(*COLUMNS)
    docs.write.parquet(f"{folder}/documents.parquet")
    found = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        found[name] = docs.collect()
    found["folder"] = folder
    return found


def test_stages(spark, stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "repeats", "mixing", "tokens"]
    for name in names[:-1]:
        assert stages[name][0].__fields__ == COLUMNS
    kept = {r.doc_id for r in stages["language_id"]}
    assert kept == {r.doc_id for r in stages["documents"] if any(c.isalpha() for c in r.text or "")}
    before = [(r.doc_id, r.text) for r in stages["language_id"]]
    assert sorted(r.doc_id for r in stages["near_duplicates"]) == sorted(i for i, (_, c) in brute_classes(before).items() if i == c)
    own = {r.doc_id: r.text for r in stages["near_duplicates"]}
    assert sorted((r.doc_id, r.text) for r in stages["repeats"]) == sorted(brute_cleaned([(r.doc_id, r.text) for r in stages["near_duplicates"]]))
    assert all(r.n_chars == len(r.text) for r in stages["repeats"]) and any(r.text != own[r.doc_id] for r in stages["repeats"])
    lib, whole = sentencepiece.SentencePieceProcessor(model_file=MODEL), {r.doc_id: r.text for r in stages["mixing"]}
    for r in stages["tokens"]:
        ids = lib.encode(whole[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    read = collections.Counter(r.doc_id for r in stages["mixing"])
    assert set(read) <= {r.doc_id for r in stages["repeats"]} and max(read.values()) <= 3
    assert collections.Counter(r.doc_id for r in stages["tokens"]) == read
    assert sum(len(words(r.text)) for r in stages["mixing"]) > 0


def test_run_is_its_stages(spark, stages):
    got = corpus_pipeline.run(spark, stages["folder"]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stages["tokens"]))


def test_stages_on_nothing(spark, tmp_path):
    documents(spark, []).select(*COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("one_task", [200_000, 30])
def test_components(spark, monkeypatch, one_task):
    import random

    monkeypatch.setattr(common, "ONE_TASK", one_task)

    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(200)] + [(1000 + rng.randrange(50), 1000 + rng.randrange(50)) for _ in range(40)] + [(5000, 5000), (None, 3), (7777, 6666)]
    got = {r.id: r.component_id for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    part = {}

    def root(x):
        while part.setdefault(x, x) != x:
            x = part[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            part[y] = x
    assert got == {x: root(x) for x in part}
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []
