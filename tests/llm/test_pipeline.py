import os
import subprocess
import sys
import zlib

import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from tillroll.llm import language, mixing
from tillroll.llm.oracles import ORACLES
from tillroll.llm.queries import QUERIES

FOLDER = f"{TESTDATA}/sf0.001"


def test_all_are_registered():
    names = entry_points.queries()
    assert {f"op{k}" for k in range(1, 14)} == {n.split("_")[0] for n in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(names) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_values_equal_the_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark", "conversations"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/sf0.01/{table}.parquet'")
    frame = QUERIES[name](spark, f"{TESTDATA}/sf0.01")
    expected = duck.sql(ORACLES[name])
    columns = sorted(frame.columns)
    assert columns == sorted(expected.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr)
    theirs = sorted(
        (tuple(dict(zip(expected.columns, row))[c] for c in columns) for row in expected.fetchall()), key=repr
    )
    assert ours and ours == theirs


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage over documents with further, clashing columns."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumns(
        {"row": F.lit(1), "found": F.lit("f"), "rate": F.lit(0.5), "_n": F.lit(2), "component": F.lit(None).cast("int")}
    )
    odd = docs.limit(1).drop("doc_id", "text").crossJoin(
        spark.createDataFrame([(None, "the and of that"), (9001, None), (9002, ""), (9003, "1234 !")], "doc_id long, text string")
    )
    docs = docs.unionByName(odd.select(docs.columns))
    out, kept = [], tmp_path_factory.mktemp("stages")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, docs, FOLDER)
        after.write.parquet(str(kept / f"{k}"))
        after = spark.read.parquet(str(kept / f"{k}"))
        out.append((name, docs, after))
        docs = after
    return out


def pairs(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "text").collect()), key=repr)


def test_stages_return_the_columns_of_documents(stages):
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and after.count() > 0


def test_language_stage_drops_texts_without_a_language(stages):
    _, before, after = stages[0]
    kept = pairs(after)
    assert {i for i, _ in set(pairs(before)) - set(kept)} >= {9001, 9002, 9003}
    assert len(kept) >= 0.97 * (before.count() - 3)


def test_dedup_stage_equals_brute_force(stages):
    _, before, after = stages[1]
    rows = pairs(before)
    root = brute.near_copies([r for r in rows if r[0] is not None])
    assert pairs(after) == [r for r in rows if r[0] is None or root[r[0]][1] == r[0]]


def test_decontamination_stage_equals_brute_force(spark, stages):
    _, before, after = stages[2]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    assert pairs(after) == [r for r in pairs(before) if not brute.is_contaminated(r[1], items)]


def test_mixing_stage_takes_documents_by_their_rates(spark, stages):
    _, before, after = stages[3]
    labels = mixing.label_domains(spark.read.parquet(f"{FOLDER}/labels.parquet"))
    rates = mixing.rates(before, labels, mixing.TARGETS, largest=1.0)
    wanted = rates.select("id", mixing.copies(F.col("rate"), F.col("id")).alias("n")).where("n > 0")
    got = after.groupBy("doc_id").count()
    assert got.where("count > 1").count() == 0
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, wanted.collect())))


def test_last_stage_holds_the_ids_of_what_is_left(stages):
    _, before, after = stages[4]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, wanted = 0, []
    for name, text in sorted(pairs(before), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        wanted.append((name, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((tuple(r) for r in after.collect()), key=lambda r: r[1]) == wanted


def test_run_is_the_chain_of_stages(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted(got.collect(), key=lambda r: r["start"])
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows)])[:-1].tolist()


def test_the_rest_imports_without_this_part():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('corpus_pipeline', 'tillroll.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert not any(n.startswith('op') for n in e.queries()) and 'pipeline' not in e.queries()\n"
    )
    root = os.path.dirname(corpus_pipeline.__file__)
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_language_is_learnt_from_what_the_stage_gets(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert language.fit(docs, "text", "lang").languages == ["de", "en", "es", "fr"]
