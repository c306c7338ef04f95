"""The pipeline stage by stage against brute force; the registered queries on the smallest tables."""

import random

import corpus_pipeline
import pytest
from checks.compare import connect, differences

from __spark_entry__ import oracle_sql, queries
from riskspark.llm import jaccard

FOLDER = "/root/testdata/sf0.001"
WORDS = [f"v{i}" for i in range(500)]


def text_of(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with planted cases, among odd rows."""
    rng, path = random.Random(21), str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, text_of(rng, 120)) for i in range(200)]
    toxic = set(range(0, 200, 5))
    for i in toxic:
        words = rows[i][1].split()
        for k in rng.sample(range(120), 3):
            words[k] = rng.choice(["grubbel", "nastoid", "flurmox"])
        rows[i] = (i, " ".join(words))
    rows += [(300, rows[1][1]), (301, rows[1][1].replace(" ", "  ")), (302, rows[2][1] + " end")]
    passage = text_of(rng, 70)
    rows += [(310, f"{text_of(rng, 60)} {passage} {text_of(rng, 60)}"), (311, f"{text_of(rng, 80)} {passage} {text_of(rng, 40)}")]
    item = text_of(rng, 30)
    rows += [(320, f"{text_of(rng, 50)} {item} {text_of(rng, 50)}"), (321, text_of(rng, 100))]
    rows += [(None, "null id"), (330, None), (331, ""), (332, "twice"), (332, "twice again")]
    docs = spark.createDataFrame([(i, t, "en", None, None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item), (2, text_of(rng, 20)), (3, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, toxic


def test_stages_do_what_they_say(spark, folder):
    path, rows, toxic = folder
    docs, texts = spark.read.parquet(f"{path}/documents.parquet"), dict(rows)
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, path), name)
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
        assert name == "bpe" or docs.columns == columns
    ids = {k: set(v) for k, v in seen.items()}
    assert ids["toxicity"] == {i for i, _ in rows} - toxic
    assert ids["ngram_jaccard"] == ids["toxicity"] - {300, 301, 302}
    assert ids["substring_dedup"] == ids["ngram_jaccard"]
    cut = seen["substring_dedup"]
    changed = {i for i in cut if i is not None and i != 332 and cut[i]["text"] != texts[i]}
    assert changed == {311} and cut[311]["n_chars"] == len(cut[311]["text"]) and len(cut[311]["text"].split()) == 120
    assert ids["decontamination"] == ids["substring_dedup"] - {320}
    last = seen["bpe"]
    assert all(last[i]["text"] == (cut[i]["text"] or "") and (last[i]["n_tokens"] > 0) == bool(cut[i]["text"]) for i in last if i != 332)


def test_run_is_all_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder[0])
    assert out.columns == ["doc_id", "n_tokens", "ids", "text"] and out.count() == 165 + 12 - 3 - 1 - 5


def test_empty_tables(spark, folder, tmp_path):
    path = folder[0]
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{path}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(n for n in queries() if n.startswith("op") and n not in oracle_sql()))
def test_queries_without_sql_run(spark, name):
    out = queries()[name](spark, FOLDER)
    assert {"doc_id"} <= set(out.columns) and out.count() >= 0


@pytest.mark.parametrize("name", [n for n in sorted(oracle_sql()) if n.startswith("op")])
def test_queries_match_sql(spark, name):
    assert differences(queries()[name](spark, FOLDER).toPandas(), connect(FOLDER).execute(oracle_sql()[name]).df()) == ""


def test_contract_columns(spark):
    want = {
        "op4_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        "op5_ngram_jaccard": "doc_id n_shingles component_id",
        "op6_toxicity": "doc_id held_out score predicted",
        "op7_lm_scoring": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op8_chat_formatting": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
        "op9_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
        "op10_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    }
    for name, columns in want.items():
        assert queries()[name](spark, FOLDER).columns[: len(columns.split())] == columns.split()


def test_near_duplicates_keep_other_columns(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    assert jaccard.one_of_each(docs).schema == docs.schema
