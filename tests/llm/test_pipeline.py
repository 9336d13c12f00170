from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from parcelspark.llm import packing, quality, simhash
from parcelspark.llm.common import scratch_folder
from tests.llm.data import PASSAGE, SF_DIR, documents, plain, word_list
from tests.llm.test_repeats import removed_of

OPERATORS = ["op1_simhash_near_dedup", "op2_toxicity", "op3_token_counts", "op4_best_fit_packing", "op5_lm_scores",
             "op6_html_extraction", "op7_quality_rules", "op8_nearest_neighbours", "op9_mix_sources", "op10_suffix_array_dedup",
             "op11_warc", "op12_hard_negatives", "op13_importance_resampling"]
STAGES = dict(corpus_pipeline.STAGES)


def test_all_are_registered():
    assert set(OPERATORS) | {"pipeline"} <= set(entry.queries())
    assert list(STAGES) == ["quality_rules", "simhash_near_dedup", "suffix_array_dedup", "mix_sources", "best_fit_packing"]


@pytest.mark.parametrize("name", OPERATORS)
def test_queries_run_over_the_sample(spark, name):
    rows = {"op6_html_extraction": 50, "op8_nearest_neighbours": 50, "op11_warc": 50, "op12_hard_negatives": 1}.get(name, 200)
    found = entry.queries()[name](spark, SF_DIR).count()
    assert found >= rows if name in ("op4_best_fit_packing", "op12_hard_negatives") else found == rows


@pytest.mark.parametrize("name", [n for n in STAGES if n != "best_fit_packing"])
def test_stages_take_awkward_and_empty_documents(spark, name):
    for docs in (documents(spark), documents(spark, [])):
        found = STAGES[name](spark, docs, SF_DIR)
        assert found.columns == docs.columns
        assert [f.dataType for f in found.schema] == [f.dataType for f in docs.schema]
        assert found.count() <= 3 * docs.count()


def test_quality_rules_take_effect(spark):
    docs = plain(spark, SF_DIR)
    trees = quality.train(docs, plain(spark, SF_DIR, "labels"))
    kept = {r.doc_id for r in STAGES["quality_rules"](spark, docs, SF_DIR).collect()}
    assert kept == {r.doc_id for r in quality.judge(docs, trees).collect() if r._kept}


def test_one_of_each_group_stays(spark):
    docs = plain(spark, SF_DIR)
    of = simhash.near_duplicates(docs).collect()
    kept = {r.doc_id for r in STAGES["simhash_near_dedup"](spark, docs, SF_DIR).collect()}
    assert kept == {r.component_id for r in of}


def test_repeated_strings_leave_the_texts(spark):
    docs = plain(spark, SF_DIR)
    rows = docs.collect()
    data, flags = removed_of([r.text for r in rows], 200)
    want = {}
    for r, d, f in zip(rows, data, flags):
        text = bytes(b for b, x in zip(d, f) if not x).decode("utf-8", "ignore")
        if not sum(f) or word_list(text):
            want[r.doc_id] = (text, len(text))
    assert {r.doc_id: (r.text, r.n_chars) for r in STAGES["suffix_array_dedup"](spark, docs, SF_DIR).collect()} == want


def test_a_text_of_which_only_blanks_are_left_goes(spark):
    long = (PASSAGE + " ") * 2
    docs = spark.createDataFrame([(0, long), (1, "\n" + long), (2, "own words " + long), (3, "\n")], "doc_id long, text string")
    kept = {r.doc_id: r.text for r in STAGES["suffix_array_dedup"](spark, docs, SF_DIR).collect()}
    assert set(kept) == {2, 3} and kept[2].startswith("own words")


def test_stages_that_are_done_with_leave_nothing_behind(spark):
    import os

    folder = scratch_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    corpus_pipeline.run(spark, SF_DIR).count()
    (made,) = [f for f in set(os.listdir(folder)) - before if f.startswith("pipeline-")]
    assert os.listdir(f"{folder}/{made}") == ["4-best_fit_packing"]


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(Session())


def test_run_equals_its_stages_one_after_another(spark):
    docs = plain(spark, SF_DIR)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SF_DIR)
        docs = spark.createDataFrame(found.collect(), docs.schema)
    want = Counter(packing.pack(docs).collect())
    assert Counter(corpus_pipeline.run(spark, SF_DIR).collect()) == want and want


def test_documents_is_all_that_run_reads_of_the_corpus(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    plain(spark, SF_DIR, "labels").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
