"""Every stage of the pipeline against a plain version, each on its predecessor's result."""

import re

import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as P
from retailcast.llm import dsir
from retailcast.llm.queries import SP_MODEL, table
from retailcast.session import materialize
from tests.conftest import SF0001
from tests.llm.test_line_dedup import plain
from tests.llm.test_ngram_join import brute
from tests.llm.test_scans import windows_brute


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF0001, "documents"), []
    for name, f in P.STAGES:
        before, docs = docs, materialize(f(spark, docs, SF0001), name)
        out.append((before, docs))
    return out


def rows(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def test_stages_keep_the_columns(stages):
    assert all(after.columns == before.columns and dict(after.dtypes) == dict(before.dtypes) for before, after in stages[:-1])


def test_quality_stage(spark, stages):
    before, after = stages[0]
    scored, least = dsir.resample(before, table(spark, SF0001, "labels"))
    assert set(rows(after)) == {r["doc_id"] for r in scored.collect() if r[dsir.KEY] >= least}
    quality = {r["doc_id"]: r["quality"] for r in table(spark, SF0001, "labels").collect()}
    kept = set(rows(after))
    good = [i in kept for i, q in quality.items() if q == 1]
    assert sum(good) / len(good) > 0.95


def test_line_stage(stages):
    before, after = map(rows, stages[1])
    ids = sorted(before)
    want = plain([before[i]["text"] for i in ids], keep_first=True)
    assert sorted(after) == ids
    for i, (_, dropped, kept) in zip(ids, want, strict=True):
        cut = dropped and kept.strip(" \t\n\x0b\x0c\r")
        assert after[i]["text"] == (kept if cut else before[i]["text"])
        assert after[i]["n_chars"] == (len(kept) if cut else before[i]["n_chars"])
    assert keys(before.values()) == keys(after.values())


def keys(documents):
    """The distinct lines of all texts."""
    return {line.strip(" \t\n\x0b\x0c\r").lower() for r in documents for line in (r["text"] or "").split("\n")}


def test_one_copy_of_a_large_group_keeps_its_text(spark):
    """Twelve copies share every line with ten documents or more: their text must not be lost."""
    text = "\n\n".join(f"line {k} of the copied text has words {k * 7} of its own" for k in range(6))
    docs = [(i, text) for i in range(12)] + [(20 + i, f"own words number {i} stay here\n\nshared footer") for i in range(12)] + [(40, " shared FOOTER\n")]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in docs], "doc_id long, text string, n_chars long")
    cut = P.lines(spark, docs, SF0001)
    kept = rows(P.near_duplicates(spark, materialize(cut, "lines_kept"), SF0001))
    assert {i for i in kept if i < 12} == {0} and kept[0]["text"] == text and kept[0]["n_chars"] == len(text)
    assert kept[20]["text"] == "own words number 0 stay here\n\nshared footer"
    assert all(kept[20 + i]["text"] == f"own words number {i} stay here\n" for i in range(1, 12))
    assert kept[40]["text"] == " shared FOOTER\n" and cut.count() == 25


def test_near_copies_of_a_large_group_lose_no_line(spark):
    """Twelve documents with twelve shared lines and one line of their own each."""
    shared = [f"shared line {k} with quite a few words of its own {k * 13}" for k in range(12)]
    docs = [(i, "\n".join([*shared[:i], f"own line of document {i} alone", *shared[i:]])) for i in range(12)]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in docs], "doc_id long, text string, n_chars long")
    cut = materialize(P.lines(spark, docs, SF0001), "near_lines")
    held = [line for r in cut.collect() for line in r["text"].split("\n")]
    assert sorted(held) == sorted([*shared, *[f"own line of document {i} alone" for i in range(12)]])
    end = rows(P.near_duplicates(spark, cut, SF0001))
    assert keys(end.values()) == keys(rows(docs).values()) and end[0]["text"] == rows(docs)[0]["text"]


def test_near_duplicate_stage(stages):
    before, after = map(rows, stages[2])
    assert set(after) == {c for _, _, c in brute([(i, r["text"]) for i, r in before.items()])}
    assert all(after[i] == before[i] for i in after)


def test_decontamination_stage(spark, stages):
    before, after = map(rows, stages[3])
    items = [(r["item_id"], r["text"]) for r in table(spark, SF0001, "benchmark").collect()]
    shared = {g for _, t in items for w in [t.lower().split()] for g in zip(*[w[k:] for k in range(5)], strict=False)}
    near = [(i, r["text"]) for i, r in before.items() if shared & set(zip(*[re.split(r"[\x20\x09-\x0D]+", (r["text"] or "").lower())[k:] for k in range(5)], strict=False))]
    assert set(after) == set(before) - {d for d, _ in windows_brute(near, items)}


def test_token_stage(stages):
    before, after = map(rows, stages[4])
    lib = sentencepiece.SentencePieceProcessor(model_file=SP_MODEL)
    assert set(before) == set(after)
    assert all(after[i]["ids"] == lib.encode(r["text"] or "") and after[i]["round_trip"] for i, r in before.items())


def test_odd_rows_pass_all_stages(spark, tmp_path):
    """Nulls in every column, empty and repeated rows, an extra column with a name the stages use."""
    text = " ".join(f"w{i}" for i in range(30))
    more = ("x", 1.5, "y", "z")
    docs = [(1, text, "en", "s", 1, *more), (1, text, "en", "s", 1, *more), (2, None, None, None, None, None, None, None, None), (None, text, "en", "s", 1, *more),
            (3, "", "en", "s", 0, *more), (4, "a\n\nb", "en", "s", 4, *more)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, log_weight double, n_dropped string, node string"
    labels = "doc_id long, quality int, toxic int"
    spark.createDataFrame(docs, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, None)], labels).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "zz yy xx"), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = P.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == [(False, 1), (False, 2), (False, 3), (False, 4), (True, 0)]
    stage = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, f in P.STAGES[:-1]:
        stage = f(spark, stage, str(tmp_path))
        assert stage.columns == schema.replace(",", "").split()[::2]
        assert {(r["kept"], r["log_weight"], r["n_dropped"], r["node"]) for r in stage.collect() if r["doc_id"] != 2} == {more}
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], labels).write.parquet(f"{tmp_path}/none/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert P.run(spark, f"{tmp_path}/none").filter(F.lit(True)).count() == 0
