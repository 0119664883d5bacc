import json

from pyspark.sql import functions as F

from pagelode.sources import csvio
from pagelode.sources import stages as S
from pagelode.streaming import incremental as I


def test_csv_is_written_as_spreadsheets_want_it(spark, tmp_path):
    cells = ["x,y", "=CMD()", 'he said "hi"', "+1,2", "-5", None, "a\nb", "  pad  ", "\tz"]
    df = spark.createDataFrame([(c, "k") for c in cells], "v string, k string")
    lines = [r.line for r in csvio.to_csv_lines(df, ["v", "k"]).collect()]
    assert lines == ['"x,y",k', "'=CMD(),k", '"he said ""hi""",k', "\"'+1,2\",k", "-5,k", ",k", '"a\nb",k', "  pad  ,k", "'\tz,k"]
    assert csvio.header_line(["A", "B,C"]) == 'A,"B,C"'
    csvio.write_csv(df.coalesce(1), str(tmp_path / "out"), ["v", "k"], ["V", "K"])
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert text == "V,K\n" + "".join(x + "\n" for x in lines)
    back = csvio.read_csv(spark, str(tmp_path / "out"))
    assert sorted(r.V for r in back.collect()) == sorted(["x,y", "'=CMD()", 'he said "hi"', "'+1,2", "-5", "", "a\nb", "  pad  ", "'\tz"])


def test_csv_reader_drops_lone_cells_and_marks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿A,B\n1,2\nlone\n"q ""x""",\n'.encode())
    assert [tuple(r) for r in csvio.read_csv(spark, str(tmp_path / "a.csv")).collect()] == [("1", "2"), ('q "x"', "")]
    assert csvio.read_csv(spark, str(tmp_path / "a.csv")).columns == ["A", "B"]


def test_seeds_and_inputs(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps(["https://a.test/1", {"url": "https://b.test"}, "https://www.a.test/2"]))
    assert sorted(tuple(r) for r in S.read_seeds(spark, str(tmp_path / "s.json")).collect()) == [("a.test", "https://www.a.test/2"), ("b.test", "https://b.test")]
    spark.range(1).write.parquet(str(tmp_path / "p"))
    assert [r.rows_found for r in S.check_inputs(spark, [str(tmp_path / "p"), str(tmp_path / "none")]).collect()] == [True, False]
    hits = spark.createDataFrame([("https://a.test", 200), ("https://b.test", 429), ("ftp://c.test", None)], "url string, status int")
    assert [r.url for r in S.usable_hits(hits).collect()] == ["https://a.test"]


def enrich(df):
    return df.select("k", F.upper("v").alias("v"))


def test_incremental_runs_add_up_to_one_batch(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"v{i}") for i in range(9)], "k long, v string")
    state = str(tmp_path / "state")
    I.refresh(spark, pages.filter("k < 4"), state, "k", enrich, "k long, v string", "k long")
    out = I.refresh(spark, pages, state, "k", enrich, "k long, v string", "k long")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, enrich(pages).collect()))
    again = I.refresh(spark, pages, state, "k", enrich, "k long, v string", "k long")
    assert again.count() == 9


def test_stream_gives_the_batch_result(spark, tmp_path):
    src, state = str(tmp_path / "src"), str(tmp_path / "st")
    pages = spark.createDataFrame([(i, f"v{i}") for i in range(6)], "k long, v string")
    for part in (pages.filter("k < 3"), pages.filter("k >= 2")):
        part.coalesce(1).write.mode("append").parquet(src)
        I.stream_rows(spark, src, pages.schema, state, enrich, "k").awaitTermination(60)
    assert sorted(map(tuple, spark.read.parquet(f"{state}/rows").collect())) == sorted(map(tuple, enrich(pages).collect()))


def test_a_run_that_died_between_its_writes_doubles_nothing(spark, tmp_path):
    pages = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    state = str(tmp_path / "state")
    S.append_stage(enrich(pages.filter("k = 'a'")), f"{state}/rows")  # and nothing in attempted
    for _ in range(2):
        out = I.refresh(spark, pages, state, "k", enrich, "k string, v string", "k string")
    assert sorted(tuple(r) for r in out.collect()) == [("a", "X"), ("b", "Y")]
    assert S.read_stage(spark, f"file://{state}/none", "k string").count() == 0


def test_a_cluster_without_a_shared_folder_is_refused(spark):
    from types import SimpleNamespace as N

    import pytest

    from pagelode.operators.lineage import ensure_checkpoint_dir

    scala = N(getCheckpointDir=lambda: N(isDefined=lambda: False))
    fake = N(sparkContext=N(_jsc=N(sc=lambda: scala), master="spark://x"), conf=N(get=lambda *a: None))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(fake)
