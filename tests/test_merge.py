import json
import os

import pytest
from barframe.sources.merge import Field, field_report, merge_landings, merged_bars, merged_fields, variant_records


def landed(folder, files):
    for name, records in files.items():
        path = os.path.join(folder, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))
    return folder


BAR = {"Date": "2020-01-02T00:00:00.000", "Open": 1.0, "High": 2.5, "Low": 0.5, "Close": 2, "Volume": 100}
FILES = {
    "AA_original.json": [BAR, {**BAR, "Dividends": 0.25}, "broken{", "", "[1, 2]", '{"a": 1, "a": 2}'],
    "AA_1.json": [{**BAR, "dividends": 1, "Note": "x", "Flag": True}, {**BAR, "Note": 7, "Deep": {"k": [1, 2]}}, {}],
    "B B_2.json": [{**BAR, "Close": "n/a", "Flag": None, "Date": "never"}, {**BAR, "Open": "1.5", "Dividends": 3, "dividends": 4}],
}


def test_report_of_all_fields(spark, tmp_dir):
    records = variant_records(spark, landed(tmp_dir, FILES))
    got = {r["field"]: (r["names"], r["n_records"], r["n_null"], r["kinds"], r["merged"], r["conflict"]) for r in field_report(records).collect()}
    assert got["dividends"] == (["Dividends", "dividends"], 4, 0, ["bigint", "double"], "double", False)
    assert got["note"] == (["Note"], 2, 0, ["bigint", "string"], "string", True)
    assert got["flag"] == (["Flag"], 2, 1, ["boolean"], "boolean", False)
    assert got["deep"] == (["Deep"], 1, 0, ["object"], "string", False)
    assert got["close"] == (["Close"], 6, 0, ["bigint", "string"], "string", True)
    assert got["high"][1:] == (6, 0, ["double"], "double", False)
    assert field_report(records.limit(0)).count() == 0


def test_no_field_is_lost(spark, tmp_dir):
    rows = merged_bars(variant_records(spark, landed(tmp_dir, FILES))).collect()
    assert rows[0].__fields__ == ["ticker", "copy_id", "date", "open", "high", "low", "close", "volume", "source", "deep", "dividends", "flag", "note", "rescued"]
    assert len(rows) == 7
    by = {(r["ticker"], r["copy_id"], r["dividends"], r["note"], r["deep"]): r for r in rows}
    assert by["AA", 0, 0.25, None, None]["rescued"] is None
    assert by["AA", 1, 1.0, "x", None]["flag"] is True
    assert by["AA", 1, None, "7", '{"k":[1,2]}']["close"] == 2.0
    odd = by["B B", 2, None, None, None]
    assert odd["date"] is None and odd["close"] is None and odd["flag"] is None
    assert json.loads(odd["rescued"]) == {"Close": "n/a", "Date": "never"}
    assert json.loads(by["B B", 2, 3.0, None, None]["rescued"]) == {"dividends": 4} and by["B B", 2, 3.0, None, None]["open"] == 1.5
    blank = by["AA", 1, None, None, None]
    assert blank["date"] is None and blank["open"] is None and blank["rescued"] is None


def test_an_earlier_schema_rescues_new_fields(spark, tmp_dir):
    records = variant_records(spark, landed(tmp_dir, FILES))
    fields = [Field("note", "bigint", ("Note",)), *(Field(c.lower(), "double", (c,)) for c in ("Open", "Close", "Volume")), Field("date", "string", ("Date",))]
    rows = {(r["ticker"], r["copy_id"], r["note"]): r for r in merged_bars(records, fields).where("open is not null").collect()}
    assert json.loads(rows["AA", 1, 7]["rescued"]) == {"High": 2.5, "Low": 0.5, "Deep": {"k": [1, 2]}}
    assert [json.loads(r["rescued"])["Note"] for r in rows.values() if r["rescued"] and "Note" in r["rescued"]] == ["x"]
    assert merged_bars(records, []).where("rescued is null").count() == 1
    with pytest.raises(ValueError, match="rescued"):
        merged_bars(records, [Field("rescued", "string", ("rescued",))])


def test_merging_keeps_records_whole(spark, tmp_dir):
    src, out = landed(f"{tmp_dir}/in", FILES), f"{tmp_dir}/out"
    merge_landings(spark, src, out)
    assert {d for d in os.listdir(out) if "=" in d} == {"ticker=AA", "ticker=B B"}
    one, two = (merged_bars(variant_records(spark, p)).drop("source") for p in (src, out))
    assert one.columns == two.columns and sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    again = f"{tmp_dir}/again"
    merge_landings(spark, out, again)
    assert sorted(map(str, merged_bars(variant_records(spark, again)).drop("source").collect())) == sorted(map(str, one.collect()))


def test_arrays_of_records(spark, tmp_dir):
    src = landed(tmp_dir, {"AA_3.json": [json.dumps([{**BAR, "Note": "a,]}{"}, 5, {**BAR, "More": 1.5}], indent=1)], "C.json": [json.dumps(BAR, indent=1)]})
    rows = merged_bars(variant_records(spark, src, multiline=True)).collect()
    assert sorted((r["ticker"], r["copy_id"], r["note"], r["more"]) for r in rows if r["note"]) == [("AA", 3, "a,]}{", None)]
    assert len(rows) == 3 and merged_fields(variant_records(spark, src, multiline=True).limit(0)) == []


def test_records_are_counted_by_shape_in_the_scan(spark, tmp_dir):
    src = landed(tmp_dir, {"AA_1.json": [{**BAR, "Close": i + 0.5} for i in range(500)]})
    report = field_report(variant_records(spark, src))
    assert {(r["field"], r["n_records"], r["merged"]) for r in report.collect()} >= {("close", 500, "double"), ("volume", 500, "bigint")}
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "SortAggregate(key=[shape" not in plan
