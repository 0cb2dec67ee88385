"""The command line on stored tables and on catalog tables."""

from __future__ import annotations

from datetime import date

import pytest

from tradescribe import job
from tradescribe.sources import driver_tables as D, schemas as S
from tradescribe.sources.extract_csv import read_extract

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def places(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("job")
    options = []
    for name in ("trades", "counterparties", "fixflows"):
        path = str(folder / name)
        getattr(D, name)(spark, SF_DIR).write.parquet(path)
        options += [f"--{name}", path]
    return options


def test_report(spark, places, tmp_path):
    out = str(tmp_path / "out")
    job.run(spark, ["report", *places, "--out", out])
    stored = spark.read.parquet(out)
    assert stored.columns == S.REPORT_COLUMNS
    assert stored.count() == spark.read.parquet(places[1]).count()


def test_as_of_and_allow_list(spark, places, tmp_path):
    trades = spark.read.parquet(places[1]).where("THD_VALUE_DATE = DATE '1997-05-01'")
    wanted = [row["NB"] for row in trades.select("NB").limit(3).collect()]
    (tmp_path / "numbers.txt").write_text("\n".join(wanted) + "\n")
    out = str(tmp_path / "out")
    numbers = str(tmp_path / "numbers.txt")
    job.run(spark, ["report", *places, "--out", out, "--as-of", "1997-05-01", "--allow-list", numbers, "--numbers-format", "text"])
    assert sorted(row["NB"] for row in spark.read.parquet(out).collect()) == sorted(wanted)
    assert date.fromisoformat("1997-05-01") in {row[0] for row in trades.select("THD_VALUE_DATE").collect()}


def test_fields_from_views(spark, places, tmp_path):
    for name, path in zip(places[::2], places[1::2]):
        spark.read.parquet(path).createOrReplaceTempView(f"job_{name[2:]}")
    views = [part for name in places[::2] for part in (name, f"job_{name[2:]}")]
    out = str(tmp_path / "out")
    job.run(spark, ["fields", *views, "--out", out, "--fields", "CLEARED", "PACKAGE_ID"])
    assert spark.read.parquet(out).columns == ["NB", "CLEARED", "PACKAGE_ID"]


def test_extract(spark, places, tmp_path):
    out = str(tmp_path / "out")
    job.run(spark, ["extract", *places[:4], "--suspects", places[1], "--out", out])
    assert read_extract(spark, out).count() == spark.read.parquet(places[1]).count()


def test_extract_takes_its_own_csv_and_all_options(spark, places, tmp_path):
    day = "1997-05-01"
    out, again = str(tmp_path / "out"), str(tmp_path / "again")
    job.run(spark, ["extract", *places[:4], "--suspects", places[1], "--as-of", day, "--out", out])
    first = read_extract(spark, out)
    expected = spark.read.parquet(places[1]).where(f"THD_VALUE_DATE = DATE '{day}'").count()
    assert 0 < first.count() == expected
    assert {len(r.H_DVCS) for r in first.collect() if r.H_DVCS} == {50}
    suspects = ["--suspects", out, "--numbers-format", "csv", "--numbers-column", "NB"]
    job.run(spark, ["extract", *places[:4], *suspects, "--as-of", day, "--out", again])
    assert sorted(map(str, read_extract(spark, again).collect())) == sorted(map(str, first.collect()))


def test_a_line_that_is_no_number_is_an_error(spark, places, tmp_path):
    (tmp_path / "numbers.csv").write_text("1,B\n2,S\n")
    with pytest.raises(Exception, match="not a number"):
        arguments = ["--suspects", str(tmp_path / "numbers.csv"), "--numbers-format", "text"]
        job.run(spark, ["extract", *places[:4], *arguments, "--out", str(tmp_path / "out")])


@pytest.mark.parametrize("missing", [["extract"], ["report"]])
def test_missing_tables(places, missing):
    with pytest.raises(SystemExit):
        job._arguments([*missing, *places[:4], "--out", "x"])
