"""The corpus pipeline, stage by stage, on awkward rows and on empty documents."""

import pytest

import corpus_pipeline

from .test_corpus_ops import SCHEMA, awkward

TABLE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("empty", [False, True])
def test_stages(spark, tmp_path, empty):
    rows, item = awkward()
    spark.createDataFrame([] if empty else [r[:5] for r in rows], TABLE).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out{i}")
        docs = spark.read.parquet(f"{tmp_path}/out{i}")
        ids = [r.doc_id for r in docs.collect()]
        if name != "token_ids":
            assert docs.columns == columns
        if empty:
            assert not ids
        elif name == "quality_rules":
            assert 9 in ids and 21 in ids and 4 not in ids and 8 not in ids
        elif name == "near_dedup":
            assert len(ids) == len(set(ids)) and None in ids and not {0, 1, 2} & set(ids) and 9 in ids
        elif name == "decontaminate":
            assert 16 in ids or 15 not in ids
            assert 15 not in ids and 9 in ids
        elif name == "token_ids":
            assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert len(SCHEMA) > len(TABLE)


def test_quality_stage_removes_common_lines(spark, tmp_path):
    body = ["\n".join([" ".join(f"w{i}_{j}" for j in range(30)), "  ", f"end {i} é"]) for i in range(55)]
    rows = [(i, ("All  rights\tRESERVED\n" if i % 2 else "") + b + "\nall rights reserved", "en", "s", 7) for i, b in enumerate(body)]
    rows += [(100, rows[0][1], "en", "s", 7), rows[3], (200, rows[4][1], "en", "other", 7), (None, None, None, None, 0)]
    spark.createDataFrame(rows, TABLE).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.quality_rules(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert got.columns == [x.split()[0] for x in TABLE.split(", ")]
    # the first holder, its copy and another host keep the line
    want = [(i, rows[0][1] if i in (0, 100) else rows[4][1] if i == 200 else body[i]) for i in [0, 1, 2, 3, 3, *range(4, 55), 100, 200]]
    assert sorted((r.doc_id, r.text) for r in got.collect()) == want


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    body = ["\n".join([" ".join(f"w{i}_{j}" for j in range(40)), "all rights reserved"]) for i in range(55)]
    names = "`a.b` string, _host string, _of string, _by string, _key long, _row string, _gone string, _d long, _t long, _c long, _copies int, _id int, `x``y` int"
    extra = ("dot", "h", "o", "b", 1, "r", "g", 2, 3, 4, 5, 6, 7)
    rows = [(i, t, "en", f"s{i % 2}", len(t), *extra) for i, t in enumerate(body)] + [(0, body[0], "en", "s0", 1, *extra), (60, body[1], "en", "s1", 1, *extra)]
    docs = spark.createDataFrame(rows, TABLE + ", " + names)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("i1", body[3])], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got and {tuple(r)[5:] for r in got} == {extra}, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(rows)
