import pytest

import corpus_pipeline
from tests.llm.data import docs_of, odd_texts, rows, same_rows, table, words
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_near_dedup import brute as grouped
from tests.llm.test_secret_scan import brute as secrets

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and what it returned."""
    docs, out = table(spark, "documents", SF), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        stage(spark, docs, SF).write.parquet(path)
        out.append((name, docs, docs := spark.read.parquet(path)))
    return out


def test_order_and_columns(stages):
    assert [s[0] for s in stages] == ["language_id", "near_dedup", "decontamination", "secret_scan", "merge_dropout"]
    assert all(after.schema == before.schema for _, before, after in stages[:-1])


def test_clean_documents_stay(stages):
    _, before, after = stages[0]
    assert before.count() == after.count()


def test_one_of_each_group(stages):
    _, before, after = stages[1]
    want = [i for i, _, _, kept in grouped(rows(before.select("doc_id", "text"))) if kept]
    assert sorted(r.doc_id for r in after.collect()) == sorted(want)


def test_contaminated_go(stages, spark):
    _, before, after = stages[2]
    found = contaminated(rows(before.select("doc_id", "text")), rows(table(spark, "benchmark", SF).select("item_id", "text")))
    assert sorted(r.doc_id for r in after.collect()) == sorted(r[0] for r in found if not r[5])


def test_secrets_are_gone(stages):
    _, before, after = stages[3]
    texts = {r.doc_id: r for r in after.collect()}
    assert sum(len(secrets(r.text)) for r in before.collect()) > 0 and len(texts) == before.count()
    assert all(secrets(r.text) == [] and r.n_chars == len(r.text) for r in texts.values())
    assert all(texts[r.doc_id].text == r.text for r in before.collect() if "[SECRET]" not in texts[r.doc_id].text)


def test_run_gives_the_last_stage(stages, spark):
    got = rows(corpus_pipeline.run(spark, SF).select("doc_id", "n_pieces"))
    assert same_rows(got, rows(stages[-1][2].select("doc_id", "n_pieces")))
    assert stages[-1][2].where("not lossless").count() == 0


def test_odd_and_empty_tables(spark):
    for texts in (odd_texts(), []):
        docs = docs_of(spark, texts)
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        left = {r.doc_id for r in docs.collect()}
        assert left == ({None, 4, 5, 6, 7, 11} if texts else set())


def test_rows_without_an_id_are_judged_one_by_one(spark, tmp_path):
    docs = small_benchmark(spark, tmp_path)
    stages = dict(corpus_pipeline.STAGES)
    left = stages["decontamination"](spark, docs, str(tmp_path))
    assert sorted(r.text for r in left.collect()) == ["", *sorted([CLEAN, CLEAN, CLEAN + " tail"])]
    left = stages["near_dedup"](spark, docs, str(tmp_path))
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {1, 3, None}
    texts = [r.text for r in left.collect()]
    assert sorted(texts) == sorted([BAD, BAD, "", CLEAN]) or sorted(texts) == sorted([BAD, BAD, "", CLEAN + " tail"])


ITEM = words(13, 1)
BAD, CLEAN = " ".join(words(187, 3) + ITEM), " ".join(words(3000, 4))


def small_benchmark(spark, path):
    """A benchmark of one item; a repeated id, and rows without an id: of it, exact and near copies of each other."""
    spark.createDataFrame([(7, " ".join(ITEM))], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return docs_of(spark, [(1, BAD), (1, BAD), (None, BAD), (None, CLEAN), (None, CLEAN), (None, CLEAN + " tail"), (3, "")])
