"""Values that must survive: text through CSV, missing scores, late offsets."""

import pytest
from pyspark.sql import functions as F

from patronflow import functions as fn
from patronflow import operators as op
from patronflow.sources import scan_delimited, write_report


def test_csv_round_trip(spark, tmp_path):
    texts = [' lead and trail ', 'say "hi"; x, y', 'two\nlines', "", None, '"', "Refer a Friend ", "\\"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for sep in (",", ";"):
        path = str(tmp_path / f"sep{ord(sep)}")
        write_report(df, path, sep=sep)
        back = scan_delimited(spark, path, "id long, text string", sep=sep, multi_line=True)
        assert {r.id: r.text for r in back.collect()} == dict(enumerate(texts))


def test_standard_quotes_and_bad_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;text\n1;"say ""hi""; x"\n')
    assert scan_delimited(spark, str(tmp_path / "a.csv"), "id long, text string").first().text == 'say "hi"; x'
    (tmp_path / "b.csv").write_text("id;text\nnot a number;x\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        scan_delimited(spark, str(tmp_path / "b.csv"), "id long, text string").collect()


def test_missing_score_has_no_bin(spark):
    df = spark.createDataFrame([(None,), (10,), (20,)], "x long")
    got = df.select(fn.equal_width_bin("x", F.lit(10), F.lit(20), 5).alias("b")).collect()
    assert [r.b for r in got] == [None, 1, 5]


def test_folding_covers_latin(spark):
    df = spark.createDataFrame([("ŞşĐđāễðĖė“”–éß",)], "x string")
    assert df.select(fn.fold_ascii("x").alias("y")).first().y == 'SsDdaedEe""-ess'


def test_matrix_refuses_an_offset_without_a_column(spark):
    df = spark.createDataFrame([("a", 0, 1), ("a", 90, 2)], "k string, off int, v int")
    assert op.pivot_wide(df, ["k"], "off", "v", prefix="m").columns == ["k", "m0", "m90"]
    with pytest.raises(Exception, match="value without a column: 90"):
        op.pivot_wide(df, ["k"], "off", "v", values=range(80), prefix="m").collect()
