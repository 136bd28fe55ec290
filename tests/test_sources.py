from __future__ import annotations

import pytest

from ledgerloom.operators import quality, reports
from ledgerloom.sources import files, schemas


def write(path, text):
    path.write_text(text)
    return str(path)


HEAD = "currency,geo_id,country,region,city,created_at,updated_at\n"


def test_csv_is_matched_by_header_and_typed(spark, tmp_path):
    p = write(tmp_path / "g.csv", HEAD + 'USD,7,"A, ""B""",R,C,2024-01-01 00:00:00,2024-01-01 00:00:00\n')
    r = files.load_csv(spark, p, schemas.schema("dim_geo")).first()
    assert (r.geo_id, r.country, r.currency) == (7, 'A, "B"', "USD")


@pytest.mark.parametrize("text, message", [("geo_id,nope\n1,2\n", "unknown columns"), ("geo_id\n1\n", "missing columns")])
def test_csv_with_wrong_header_is_refused(spark, tmp_path, text, message):
    with pytest.raises(ValueError, match=message):
        files.load_csv(spark, write(tmp_path / "g.csv", text), schemas.schema("dim_geo"))


def test_empty_csv_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="empty file"):
        files.load_csv(spark, write(tmp_path / "g.csv", ""), schemas.schema("dim_geo"))


def test_bad_value_fails_the_load(spark, tmp_path):
    p = write(tmp_path / "g.csv", HEAD + "USD,seven,A,R,C,2024-01-01,2024-01-01\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|malformed"):
        files.load_csv(spark, p, schemas.schema("dim_geo")).collect()


def test_missing_file_stops_the_load(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        files.load_all(spark, str(tmp_path / "none"), str(tmp_path / "out"))


def test_written_csv_escapes_quotes(spark, tmp_path):
    df = spark.createDataFrame([('a"b', None), ("c,d", "")], "x string, y string")
    files.write_csv(df, str(tmp_path / "o"), single_file=True)
    text = next((tmp_path / "o").glob("*.csv")).read_text()
    assert text == 'x,y\n"a""b",\n"c,d",\n'


def test_scalar_and_optional_table(spark):
    assert files.scalar(spark.range(0)) is None
    assert files.scalar(spark.range(1)) == 0
    assert files.table_or_empty({}, "fact_returns", spark).count() == 0


def test_unknown_mart_is_refused(house):
    with pytest.raises(ValueError, match="unknown mart"):
        reports.mart_export(house, "users")


def test_parameters_are_bound_not_pasted(spark, house):
    df = files.read_sql(spark, "select count(*) as n from fact_orders where order_status = :s", house, ["fact_orders"], {"s": "x' or '1'='1"})
    assert files.scalar(df) == 0


def test_rules_find_each_kind_of_break(frame):
    e = frame([(1, None, "s", "BOGUS", "x" * 90)], "event_id long, event_ts timestamp, session_id string, stage string, failure_reason string")
    got = {r.rule: r.broken for r in quality.rule_violations(e, "fact_funnel_events").collect()}
    assert got["event_ts is null"] == 1 and got["failure_reason longer than 80"] == 1
    assert [v for k, v in got.items() if k.startswith("not (stage")] == [1]


def test_compressed_files_are_bounded_and_loads_can_consume_them(spark, frame, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ZIPPED_ROWS", 100)
    day = "2024-01-01 00:00:00"
    geo = frame([(i, 'a "b", c', None, "x", "USD", day, day) for i in range(250)], "geo_id long, country string, region string, city string, currency string, created_at timestamp, updated_at timestamp").coalesce(1)
    raw, house = tmp_path / "raw", str(tmp_path / "house")
    files.write_csv(geo, f"{raw}/dim_geo.csv", compression="gzip")
    parts = [p for p in (raw / "dim_geo.csv").iterdir() if p.suffix == ".gz" and not p.name.startswith(".")]
    assert len(parts) == 3
    assert files.load_all(spark, str(raw), house, ["dim_geo"]) == ["dim_geo"] and (raw / "dim_geo.csv").exists()
    assert files.load_all(spark, str(raw), house, ["dim_geo"], consume=True) == ["dim_geo"] and not (raw / "dim_geo.csv").exists()
    got = spark.read.parquet(f"{house}/dim_geo")
    assert got.count() == 250 and got.select(*geo.columns).exceptAll(geo).isEmpty()
