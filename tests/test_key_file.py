from pathlib import Path

import pytest

from keytables.sources import export_key_column


def lines(path):
    return sorted(x for f in Path(path).glob("part-*") for x in f.read_text().splitlines())


def test_one_value_per_line_without_quotes(spark, tmp_path):
    df = spark.createDataFrame([('a,"b"', 1), ("c", 2)], "k string, n int")
    export_key_column(df, "k", str(tmp_path / "k"))
    assert lines(tmp_path / "k") == ['a,"b"', "c"]
    export_key_column(df, "n", str(tmp_path / "k"), mode="overwrite")
    assert lines(tmp_path / "k") == ["1", "2"]


def test_tasks_write_their_own_files(spark, tmp_path):
    export_key_column(spark.range(0, 100, 1, 4), "id", str(tmp_path / "k"))
    assert len(list((tmp_path / "k").glob("part-*"))) == 4
    assert len(lines(tmp_path / "k")) == 100


@pytest.mark.parametrize("value", [None, "a\nb", "a\rb"])
def test_values_without_a_line_of_their_own_fail(spark, tmp_path, value):
    df = spark.createDataFrame([("x",), (value,)], "k string")
    with pytest.raises(Exception, match="cannot be exported"):
        export_key_column(df, "k", str(tmp_path / "k"))


def test_no_rows(spark, tmp_path):
    export_key_column(spark.range(0), "id", str(tmp_path / "k"))
    assert lines(tmp_path / "k") == []
