"""The pipeline's stages against what their operators report, and the registry."""

from __future__ import annotations

from collections import Counter

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from stockflow.llm import decontaminate, host_rules, mixing
from stockflow.llm.queries import ORACLE, QUERIES
from tests.compare import difference
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_the_registry_holds_every_operator_once():
    names = [name.split("_")[0] for name in QUERIES]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{n}" for n in range(1, 14)]
    assert entry.queries()["pipeline"].__wrapped__ is pipeline.run
    assert set(ORACLE) <= set(QUERIES)


def test_queries_equal_their_sql_twins(llm):
    for name, sql in ORACLE.items():
        assert difference(QUERIES[name](llm, SF), SF, sql) is None, name


def test_queries_return_their_columns(llm):
    columns = {
        "op1_elias_fano_lm": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op2_warc_salvage": "page_id payload_bytes payload_digest record_type refers_to",
        "op3_host_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op4_entropy_mix": "doc_id size source_size target taken",
        "op7_secret_owners": "doc_id n_assign n_access n_hex base_sha256 spans",
        "op9_page_text": "page_id url text n_chars",
        "op10_simhash_bk": "doc_id fingerprint component_id",
        "op11_threshold_top": "query_id rank vec_id score",
        "op12_word_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
        "op13_kronecker_negatives": "anchor_id positive_id rank negative_id positive_score negative_score",
    }
    for name, wanted in columns.items():
        found = QUERIES[name](llm, SF)
        assert set(wanted.split()) <= set(found.columns), name


def test_stages_take_effect_one_after_the_other(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    ids = lambda frame: {r["doc_id"] for r in frame.select("doc_id").collect()}
    stages = dict(pipeline.STAGES)
    assert [name for name, _ in pipeline.STAGES][0] == "quality_rules" and len(stages) == 5
    good = stages["quality_rules"](llm, docs, SF)
    assert good.columns == docs.columns
    assert ids(good) == {r["id"] for r in host_rules.judged(docs).where("kept").collect()}
    good = llm.createDataFrame(good.collect(), docs.schema)
    single = stages["simhash_dedup"](llm, good, SF)
    rows = [(r["doc_id"], r["text"]) for r in good.orderBy("doc_id").collect()]
    sets = [set(brute.shingles(text, 5)) for _, text in rows]
    near = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])
    ]
    assert ids(single) == {rows[at][0] for at in brute.components(len(rows), near)}
    single = llm.createDataFrame(single.collect(), docs.schema)
    clean = stages["decontamination"](llm, single, SF)
    leaks = decontaminate.leaks(single, llm.read.parquet(f"{SF}/benchmark.parquet"))
    assert ids(clean) == ids(single) - {r["id"] for r in leaks.collect()}
    clean = llm.createDataFrame(clean.collect(), docs.schema)
    mixed = stages["mixture"](llm, clean, SF)
    assert mixed.columns == docs.columns
    copies = {r["id"]: r["copies"] for r in mixing.mix(clean).collect() if r["copies"]}
    assert Counter(r["doc_id"] for r in mixed.collect()) == copies


def test_the_pipeline_packs_what_is_left(llm):
    found = pipeline.run(llm, SF).collect()
    assert found and all(r["n_tokens"] <= 2048 and r["cumulative"][-1] == r["n_tokens"] for r in found)
