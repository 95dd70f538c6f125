"""Decoders, snapshots, replay, outputs, the whole run and the stream."""

import json
import logging
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from quillon import cli, http_api, pipeline, serving
from quillon.config import ConfigError, standard
from quillon.operators.rows import sums_before
from quillon.plans import profile, workforce
from quillon.runtime import Runtime, runtime
from quillon.shared import Scratch
from quillon.sources import datasource, ingest, jsonstat, settings, worldbank
from quillon.sources.contract import CurateError, Indicator, SourceContractError
from quillon.sources.files import SnapshotMeta, SnapshotStore, csv_field, csv_file, digest, lifecycle_csv
from quillon.sources.http import FetchError, fetch
from quillon.sources.store import Files
from quillon.streaming.upsert import State, current, runs, upsert

I = Indicator("x", "eurostat", "set", "M", ("EL", "IT"), {"unit": "PC"}, "release")  # noqa: E741


def cube(**more):
    dims = {"unit": ["PC"], "release": ["FIN", "FLS"], "geo": ["EL", "IT"], "time": ["2024-01", "2024-02"]}
    doc = {"id": list(dims), "size": [len(v) for v in dims.values()], "dimension": {k: {"category": {"index": {c: i for i, c in enumerate(v)}}} for k, v in dims.items()}, "value": {"0": 1.5, "7": 2}, "status": {"1": "u", "7": "p"}, "updated": "now"}
    return json.dumps(doc | more).encode()


def test_jsonstat_cells(spark):
    rows = {(r["geo"], r["period"], r["dimensions"]["release"], r["value"], r["status"]) for r in jsonstat.JsonStat().parse(spark, cube(), I).rows.collect()}
    assert rows == {("EL", "2024-01", "FIN", 1.5, None), ("EL", "2024-02", "FIN", None, "u"), ("IT", "2024-02", "FLS", 2.0, "p")}
    dense = jsonstat.JsonStat().parse(spark, cube(value=[1, None, 3, 4, 5, 6, 7, 8], status={}), I).rows
    assert dense.count() == 7


def test_cubes_of_a_million_cells_and_ten_thousand_cubes(spark):
    """Linear in cells: every cell of a large cube stands where it belongs; many cubes are decoded side by side."""
    side = 1000
    axis = lambda k: {"category": {"index": [f"{k}{i}" for i in range(side)]}}
    doc = {"id": ["a", "b"], "size": [side, side], "dimension": {"a": axis("a"), "b": axis("b")}, "value": {str(i): i for i in range(side * side)}, "status": {"7": "p"}}
    cells = jsonstat.decode_cube(jsonstat.cubes(spark.createDataFrame([(json.dumps(doc),)], "body string")))
    right = (F.col("dims")["a"] == F.concat(F.lit("a"), F.floor(F.col("flat") / side))) & (F.col("dims")["b"] == F.concat(F.lit("b"), F.col("flat") % side)) & (F.col("value") == F.col("flat"))
    r = cells.agg(F.count("*"), F.count_if(right), F.countDistinct("flat"), F.max(F.struct(F.col("status").isNotNull(), "flat"))["flat"]).first()
    assert tuple(r) == (side * side, side * side, side * side, 7)
    small = spark.range(10_000, numPartitions=8).select("id", F.format_string('{"id":["g"],"size":[2],"dimension":{"g":{"category":{"index":{"y":1,"x":0}}}},"value":[%d,null],"status":{"1":"u"}}', "id").alias("body"))
    got = jsonstat.decode_cube(jsonstat.cubes(small.withColumnRenamed("id", "k"), "k"), "k")
    assert got.filter("value = k and dims['g'] = 'x' and flat = 0").count() == got.filter("value is null and dims['g'] = 'y' and status = 'u'").count() == 10_000 and got.count() == 20_000
    odd = spark.createDataFrame([("[]",), ("{",), (None,), ("{}",)], "body string")
    assert jsonstat.decode_cube(jsonstat.cubes(odd)).count() == 0


@pytest.mark.parametrize("change, why", [({"value": {"0": "x"}}, "isn't one"), ({"value": {"8": 1}}, "no dimension has"), ({"value": [1] * 9}, "no dimension has"), ({"status": {"k": "p"}}, "no dimension has"), ({"value": "x"}, "neither"), ({"size": [1, 2, 2, 3]}, "sizes"), ({"error": "no"}, "says no"), ({"id": ["unit"], "size": [1]}, "no dimension geo"), ({"dimension": {}}, "no categories of unit")])
def test_jsonstat_refuses_other_shapes(spark, change, why):
    with pytest.raises(SourceContractError, match=why):
        jsonstat.JsonStat().parse(spark, cube(**change), I)
    for payload, said in ((b"[1]", "not an object"), (b"{", "not JSON"), (b"{}", "no id")):
        with pytest.raises(SourceContractError, match=said):
            jsonstat.JsonStat().parse(spark, payload, I)


def test_filters_are_pinned(spark):
    with pytest.raises(SourceContractError, match="unit holds"):
        jsonstat.JsonStat().parse(spark, cube(), Indicator("x", "eurostat", "set", "M", (), {"unit": "INX"}))
    with pytest.raises(SourceContractError, match="no dimension sex"):
        jsonstat.JsonStat().parse(spark, cube(), Indicator("x", "eurostat", "set", "M", (), {"sex": "T"}))
    rows = jsonstat.JsonStat().parse(spark, cube(), Indicator("x", "eurostat", "set", "M", (), {})).rows
    assert {*rows.first()["dimensions"]} == {"unit", "release"}


def test_requests_are_ordered_and_start_by_frequency():
    i = Indicator("x", "eurostat", "set", "Q", ("IT", "EL"), {"unit": "PC", "age": "Y"}, since="2019-05")
    r = jsonstat.JsonStat("http://h").request(i)
    assert r.url == "http://h/set" and r.params == [("format", "JSON"), ("lang", "EN"), ("age", "Y"), ("unit", "PC"), ("geo", "EL"), ("geo", "IT"), ("sinceTimePeriod", "2019-Q2")]
    assert [jsonstat.first_period("2019-05", f) for f in "MQA"] == ["2019-05", "2019-Q2", "2019"]
    w = worldbank.WorldBank("http://h", 2026).request(Indicator("g", "worldbank", "GDP", "A", ("ITA", "BGR"), since="2019-01"))
    assert w.url == "http://h/country/BGR;ITA/indicator/GDP" and w.params == [("format", "json"), ("date", "2019:2026"), ("per_page", "1000")]


def test_worldbank(spark):
    i = Indicator("gdp", "worldbank", "GDP", "A", ("ITA",))
    row = {"indicator": {"id": "GDP"}, "countryiso3code": "ITA", "date": "2022", "value": None, "obs_status": ""}
    wb, meta = worldbank.WorldBank(), {"pages": 1, "lastupdated": "d"}
    got = wb.parse(spark, json.dumps([meta, [row, row | {"date": "2023", "value": 1.25}]]).encode(), i)
    assert [(r["period"], r["value"], r["status"]) for r in got.rows.collect()] == [("2022", None, None), ("2023", 1.25, None)]
    assert wb.parse(spark, json.dumps([meta, None]).encode(), i).rows.count() == 0 and got.source_updated == "d"
    short = {k: v for k, v in row.items() if k != "value"}
    for bad, why in (([{"message": []}], "says"), ([meta | {"pages": 2}, []], "2 pages"), ([meta, [row | {"indicator": {"id": "Z"}}]], "rows of"), ([meta, [short]], "lacks"), ([meta, [row | {"value": "x"}]], "number"), ({}, "list"), ([1, 2, 3], "metadata"), ([meta, [row, None]], "lacks")):
        with pytest.raises(SourceContractError, match=why):
            wb.parse(spark, json.dumps(bad).encode(), i)


def test_fetch_tries_again_only_what_may_pass():
    answers = [(503, b""), (200, b"ok")]
    assert fetch(jsonstat.JsonStat().request(I), get=lambda u, t: answers.pop(0), sleep=lambda s: None) == (200, b"ok")
    for body, said in ((b"none", "none"), (b'{"error": [{"status": 404, "label": "no such set"}]}', "no such set"), (b'[{"message": [{"id": "120", "value": "bad place"}]}]', "bad place"), (b"<html><b>gone</b></html>", "gone")):
        with pytest.raises(FetchError, match=f"404: {said}"):
            fetch(jsonstat.JsonStat().request(I), get=lambda u, t: (404, body), sleep=lambda s: None)  # noqa: B023
    with pytest.raises(FetchError, match="4 tries"):
        fetch(jsonstat.JsonStat().request(I), get=lambda u, t: (503, b"busy"), sleep=lambda s: None)


def test_replay_isolates_failures(spark, tmp_path):
    store = SnapshotStore(str(tmp_path))
    meta = lambda b, i: SnapshotMeta("eurostat", i, "set", "u", [], "t", 200, digest(b), len(b), None, 2)
    assert store.write(cube(), meta(cube(), "x")) == "created" and store.write(cube(), meta(cube(), "x")) == "unchanged"
    good, bad = ingest.ingest(spark, store, (I, Indicator("y", "eurostat", "set", "M")))
    assert good.ok and good.coverage[0]["geo"] == "EL" and not bad.ok
    staged, missing = ingest.staged(spark, store, (I, Indicator("y", "eurostat", "set", "M")))
    assert staged.count() == 3 and missing == ["y"]
    (tmp_path / "eurostat" / "x.json").write_bytes(b"{}")
    assert not ingest.ingest(spark, store, (I,))[0].ok


def test_snapshots_are_a_source_of_spark(spark, tmp_path):
    """Read by format, stored payloads are what staged() gives; a partition for each series and place; checks end the read."""
    store = SnapshotStore(str(tmp_path))
    meta = lambda p, i, b: SnapshotMeta(p, i, "set", "u", [], "t", 200, digest(b), len(b), None, 2)
    row = {"indicator": {"id": "GDP"}, "countryiso3code": "ITA", "date": "2022", "value": 1.5, "obs_status": "E"}
    wb = json.dumps([{"pages": 1, "lastupdated": "d"}, [row, row | {"date": "2023", "value": None, "obs_status": ""}, row | {"countryiso3code": "GRC"}]]).encode()
    known = cube(extension={"status": {"label": {"p": "provisional"}}})
    listed = (I, Indicator("gdp", "worldbank", "GDP", "A", ("ITA",)), Indicator("dense", "eurostat", "set", "M", ("IT",), {"unit": "PC"}))
    for i, body in zip(listed, (known, wb, cube(value=[1, None, 3, 4, 5, 6, 7, 8.5], status={})), strict=True):
        store.write(body, meta(i.provider, i.id, body))
    spark.dataSource.register(datasource.Snapshots)
    read = lambda which, at=str(tmp_path), **more: spark.read.format("quillon_series").option("indicators", datasource.listed(which)).options(**more).load(at)
    want, missing = ingest.staged(spark, store, listed)
    got = read(listed)
    assert not missing and got.schema.names == want.schema.names and sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 13
    assert got.rdd.getNumPartitions() == 7 and read(listed, tmp_path.as_uri()).count() == 13
    gone = Indicator("gone", "eurostat", "set", "M")
    assert read((I, gone), missing="skip").count() == 3
    for change in (lambda: (tmp_path / "eurostat" / "x.json").write_bytes(b"{}"), lambda: store.write(b"{}", meta("eurostat", "x", b"{}"))):
        change()
        with pytest.raises(Exception, match="checksum|no id"):
            read((I,)).collect()
    for bad, why in (([{"message": []}], "says"), ([{"pages": 2}, []], "2 pages"), ([{"pages": 1}, [row | {"indicator": {"id": "Z"}}]], "rows of Z"), ([{"pages": 1}, [{}]], "lacks"), ([{"pages": 1}, [row | {"value": "x"}]], "number"), ({}, "list"), ([1, 2, 3], "metadata"), ([{"pages": 1}, "x"], "no list")):
        with pytest.raises(SourceContractError, match=why):
            worldbank.series(json.dumps(bad).encode(), listed[1])


def test_live_ingest_checks_before_it_stores(spark, tmp_path):
    store = SnapshotStore(str(tmp_path))
    (good,) = ingest.ingest(spark, store, (I,), live=True, get=lambda r: (200, cube()))
    assert good.ok and good.state == "created" and store.read("eurostat", "x")[1].observation_count == 2
    (bad,) = ingest.ingest(spark, store, (I,), live=True, get=lambda r: (200, b"{}"))
    assert not bad.ok and store.read("eurostat", "x")[0] == cube()
    with pytest.raises(ConfigError):
        ingest.sources({"elsewhere": "http://h"})


def test_a_broken_snapshot_is_put_right(tmp_path):
    store, meta = SnapshotStore(str(tmp_path)), lambda b: SnapshotMeta("p", "i", "set", "u", [], "t", 200, digest(b), len(b), None, 2)
    body, side = tmp_path / "p" / "i.json", tmp_path / "p" / "i.meta.json"
    assert store.write(b"one", meta(b"one")) == "created"
    body.write_bytes(b"two")  # as if the sidecar had not been reached
    with pytest.raises(CurateError):
        store.read("p", "i")
    assert store.write(b"two", meta(b"two")) == "updated" and store.read("p", "i") == (b"two", meta(b"two"))
    for damage in (b"", b"{}"):
        side.write_bytes(damage)
        assert store.write(b"two", meta(b"two")) == "updated" and store.read("p", "i")[0] == b"two"
    assert store.write(b"two", meta(b"two")) == "unchanged" and [*json.loads(side.read_text())][:3] == ["provider", "indicator_id", "dataset"]


def write_lifecycle(path, n=40, name="E"):
    lines = [",".join(workforce.COLUMNS)] + [f"{name}{i},GR,Sales,J,Manager,Permanent,2022-0{i % 9 + 1}-10,,,,HCM_A,2025-01-01" for i in range(n)]
    path.write_text("\n".join(lines) + "\n")


def test_lifecycle_rows_are_numbered_in_order(spark, tmp_path):
    write_lifecycle(tmp_path / "a.csv", 5)
    rows = lifecycle_csv(spark, str(tmp_path / "a.csv")).orderBy("source_row").collect()
    assert [(r["employee_id"], r["source_row"]) for r in rows] == [(f"E{i}", i + 2) for i in range(5)] and rows[0]["termination_date"] == ""
    (tmp_path / "many").mkdir()
    write_lifecycle(tmp_path / "many" / "a.csv", 3, "A")
    write_lifecycle(tmp_path / "many" / "b.csv", 3000, "B")
    write_lifecycle(tmp_path / "many" / "c.csv", 2, "C")
    want = [*[f"A{i}" for i in range(3)], *[f"B{i}" for i in range(3000)], "C0", "C1"]
    for size in ("128m", "20k"):  # blocks of files are numbered on, however they are dealt to tasks
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        got = lifecycle_csv(spark, str(tmp_path / "many")).orderBy("source_row").collect()
        assert [r["employee_id"] for r in got] == want and [r["source_row"] for r in got] == [*range(2, 3007)]
        few = lifecycle_csv(spark, str(tmp_path / "many"), most_blocks=0)  # more blocks than may be broadcast
        assert sorted(map(tuple, few.collect())) == sorted(map(tuple, got)) and "ResolvedHint" not in few._jdf.queryExecution().analyzed().toString()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(CurateError, match="employee_id"):
        lifecycle_csv(spark, str(tmp_path / "bad.csv"))


def test_csv_tells_null_from_empty_text(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "", 'a"b', True, 0.5, ["x", "y"]), (2, "a,b", "n\nl", " ", None, None, [])], "i int, a string, b string, c string, d boolean, e double, f array<string>")
    assert csv_file(df, str(tmp_path / "x.csv"), ["i"]) == 2
    assert (tmp_path / "x.csv").read_text() == 'i,a,b,c,d,e,f\n1,,"","a""b",true,0.5,x|y\n2,"a,b","n\nl", ,,,""\n'


def test_large_csv_is_the_sorted_rows_line_by_line(spark, tmp_path):
    """Many parts, ties, nulls and odd text: the file is what one pass over the sorted rows would write."""
    n = 200_000
    odd = F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 7 == 1, "").when(F.col("id") % 7 == 2, 'a,"b"').when(F.col("id") % 7 == 3, "l\nm").otherwise(F.col("id").cast("string"))
    df = spark.range(n, numPartitions=7).select(F.xxhash64("id").alias("k"), F.col("id").alias("i"), odd.alias("t"), (F.col("id") / 3e6).alias("x"), F.expr("date_add(date'2020-01-01', cast(id % 900 as int))").alias("d"), F.expr("timestamp'2020-01-01 00:00:00.5' + make_interval(0, 0, 0, 0, 0, 0, id)").alias("at"), F.array(F.col("id"), F.lit(1)).alias("l"))
    df = df.withColumn("tie", F.col("i") % 3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    for path in (str(tmp_path / "deep" / "x.csv"), (tmp_path / "y.csv").as_uri()):
        assert csv_file(df, path, ["tie", "k"]) == n
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = df.collect()
    rows.sort(key=lambda r: (r["tie"], r["k"]))
    want = "".join(",".join(map(csv_field, [*r[:5], r["at"].replace(tzinfo=None), *r[6:]])) + "\n" for r in rows)
    for path in ("deep/x.csv", "y.csv"):
        assert (tmp_path / path).read_bytes().decode() == "k,i,t,x,d,at,l,tie\n" + want
    assert sorted(p.name for p in tmp_path.rglob("*")) == ["deep", "x.csv", "y.csv"]
    assert csv_file(df.filter("i < 0"), str(tmp_path / "y.csv"), ["k"]) == 0 and (tmp_path / "y.csv").read_text() == "k,i,t,x,d,at,l,tie\n"


def test_sums_before_a_million_blocks(spark):
    """No window over all rows; the sums are those of the sorted rows."""
    scratch = Scratch(spark, "blocks")
    n = 1_000_000
    blocks = spark.range(n, numPartitions=16).select(F.format_string("f%03d", F.col("id") % 500).alias("f"), F.floor(F.col("id") / 500).alias("b"), (F.col("id") % 11).alias("n"))
    got = sums_before(blocks, ["f", "b"], "n", "o", scratch)
    assert got.filter("f = 'f000' and b = 0").first()["o"] == 0
    # of a row and the next one, the sums differ by the row's n; the last one's sum is all but its own n
    g = got.orderBy("f", "b").toPandas()
    assert len(g) == n and (g["o"].diff().iloc[1:].to_numpy() == g["n"].iloc[:-1].to_numpy()).all() and g["o"].iloc[0] == 0
    assert sums_before(blocks.filter("n > 20"), ["f", "b"], "n", "o", scratch).count() == 0
    scratch.drop()


def test_files_by_address(spark, tmp_path):
    """Snapshots, manifests and reports are kept by address as by path, replaced whole, with nothing left beside them."""
    files, at = Files(spark), tmp_path.as_uri()
    for body in (b"", b"one", bytes(range(256)) * 5000):
        files.write(f"{at}/a/b.bin", body)
        assert files.read(f"{at}/a/b.bin") == body == (tmp_path / "a" / "b.bin").read_bytes() and files.size(str(tmp_path / "a" / "b.bin")) == len(body)
    assert files.sha256([f"{at}/a/b.bin", str(tmp_path / "a" / "b.bin")]) == digest(body * 2)
    assert [p.name for p in (tmp_path / "a").iterdir()] == ["b.bin"] and files.is_folder(f"{at}/a") and not files.exists(f"{at}/c")
    for gone in (lambda: files.read(f"{at}/c"), lambda: files.read(f"{at}/a"), lambda: files.files(f"{at}/c")):
        with pytest.raises(FileNotFoundError):
            gone()
    files.join(b"0", [], f"{at}/a/c.bin")
    assert files.read(f"{at}/a/c.bin") == b"0" and [x.rsplit("/", 1)[1] for x in files.files(f"{at}/a")] == ["b.bin", "c.bin"]
    store = snapshots(spark, f"{at}/snap")
    outcomes = ingest.ingest(spark, store, ingest.STANDARD[:2])
    assert [o.ok for o in outcomes] == [True, False] and ingest.staged(spark, store, ingest.STANDARD)[0].count() == 120
    ingest.manifest(f"{at}/runs/1.json", "1", outcomes)
    assert json.loads((tmp_path / "runs" / "1.json").read_text())["indicators"][0]["state"] == "replayed"
    assert sorted(p.name for p in (tmp_path / "snap" / "eurostat").iterdir()) == ["unemployment_rate.json", "unemployment_rate.meta.json"]


def write_people(path, hired=range(1, 13)):
    """Managers and leaders of two units hired in 2022, some of whom left; clean rows."""
    lines = [",".join(workforce.COLUMNS)]
    for n, m in enumerate(hired):
        for k in range(12):
            gone = "2023-02-10,Voluntary,true" if k == 0 else "2022-12-20,Voluntary,false" if k == 1 else ",,"
            lines.append(f"P{n}-{k},{'GR' if k % 2 else 'IT'},{'Sales' if k % 3 else 'Finance'},J,{'Senior Leader' if k % 4 == 0 else 'Manager'},Permanent,2022-{m:02}-05,{gone},HCM_A,2025-01-01")
    path.write_text("\n".join(lines) + "\n")


def snapshots(spark, root, values=range(60)):
    store = SnapshotStore(str(root))
    months = [f"{2021 + i // 12}-{i % 12 + 1:02}" for i in values]
    dims = {**{k: [v] for k, v in ingest.STANDARD[0].filters.items()}, "geo": ["EL", "IT"], "time": months}
    doc = {"id": list(dims), "size": [len(v) for v in dims.values()], "dimension": {k: {"category": {"index": {c: i for i, c in enumerate(v)}}} for k, v in dims.items()}, "value": [(i * 37 % 11) + i / 100 for i in range(2 * len(months))], "updated": "now"}
    body = json.dumps(doc).encode()
    store.write(body, SnapshotMeta("eurostat", "unemployment_rate", "une_rt_m", "u", [], "t", 200, digest(body), len(body), "now", 2 * len(months)))
    return store


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("built")
    write_people(at / "a.csv")
    staged, missing = ingest.staged(spark, snapshots(spark, at / "snap"), ingest.STANDARD)
    assert len(missing) == 5
    pipeline.run(spark, lifecycle_csv(spark, str(at / "a.csv")), staged, standard(), str(at / "tables"), str(at / "reports"))
    return at


def test_requests_read_only_the_files_of_their_slice(spark, built):
    """A request for one objective, variant and grain, or one signal, opens one folder; values are never text of a statement."""
    t = serving.open_tables(spark, str(built / "tables"))
    for df, of, names in (
        (serving.measures(t["objective_measures"], "NEW_HIRE_6M", "IT"), t["objective_measures"], ("objective_id", "variant", "grain")),
        (serving.signal_series(t["signal_asof"], "unemployment_rate", ["IT"], date(2021, 1, 1)), t["signal_asof"], ("indicator_id",)),
        (serving.association_cells(t["association_cells"], "NEW_HIRE_6M", "unemployment_rate"), t["association_cells"], ("objective_id", "indicator_id")),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        pruned = plan[plan.index("PartitionFilters") :].split("]")[0]
        assert all(n in pruned for n in names) and df.count() > 0
        scans = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        assert scans.size() == 1 and len({f.rsplit("/", 1)[0] for f in df.inputFiles()}) <= len({f.rsplit("/", 1)[0] for f in of.inputFiles()})
    assert serving.measures(t["objective_measures"], "' OR '1'='1").count() == 0


def test_finished_tables_are_verified_by_other_means(spark, built, tmp_path, monkeypatch):
    """All checks agree on a whole run; a changed number is found, and ends the command with 1."""
    from shutil import copytree

    from quillon import verify

    root = str(built / "tables")
    found = verify.checks(spark, root, standard()).collect()
    kinds = {r["check"] for r in found}
    assert kinds >= {"cohort retained", "cohort hired", "turnover exits", "turnover head count", "intervals that agree", "as-of values that agree", "model persons", "model events"}
    assert [r for r in found if not r["agrees"]] == [] and len(found) > 150
    monkeypatch.setattr(cli, "session", lambda: spark)
    copytree(root, tmp_path / "t")
    call = ["verify", "--tables", str(tmp_path / "t"), "--reports", str(tmp_path / "r")]
    assert cli.main(call) == 0 and (tmp_path / "r" / "verification.csv").read_text().count("\n") == len(found) + 1
    m = spark.read.parquet(root + "/objective_measures")
    one = F.col("objective_id") == "NEW_HIRE_6M"
    m.withColumn("numerator", F.when(one & (F.col("grain") == "year") & (F.col("country_code") == "IT") & (F.col("segment_value") == "All"), F.col("numerator") + 1).otherwise(F.col("numerator"))).write.mode("overwrite").parquet(str(tmp_path / "t" / "objective_measures"))
    assert cli.main(call) == 1
    wrong = {(r["check"], r["of"]) for r in spark.read.parquet(str(tmp_path / "t" / "verification")).filter("not agrees").collect()}
    assert ("cohort retained", "NEW_HIRE_6M main 2022 IT All") in wrong and {k.split()[0] for k, _ in wrong} <= {"cohort", "intervals"}
    assert cli.main(["verify", "--tables", str(tmp_path / "none")]) == 1


def test_whole_run_repeats_byte_by_byte(spark, built):
    report = json.loads((built / "reports" / "quality_report.json").read_text())
    assert (report["workforce_rows_read"], report["employees"], report["external_values"], len(report["rules"])) == (144, 144, 120, 23)
    tables = serving.open_tables(spark, str(built / "tables"))
    assert serving.variants(tables["objective_measures"]) == {"NEW_HIRE_6M": ["main"], "REGRETTED_TURNOVER_12M": ["main", "upper_bound_unknown"], "SENIOR_HIRE_12M": ["main", "sensitivity_manager"]}
    csv_file(tables["objective_measures"], f"{built}/again.csv", ["objective_id", "variant", "grain", "country_code", F.asc_nulls_last("segment_value"), "period_start"])
    assert (built / "again.csv").read_bytes() == (built / "reports" / "objective_measures.csv").read_bytes()
    assert (built / "reports" / "association_results.csv").read_text().splitlines()[0] == "objective_id,indicator_id,model,outcome,n_obs,n_events,n_clusters,signal_sd_within,odds_ratio,ci_low,ci_high,p_value,q_value,note"


def test_service_answers_and_refuses(spark, built):
    s = serving.Service(spark, str(built / "tables"), standard())
    ask = lambda path: http_api.answer(s, path)
    assert ask("/api/health") == (200, {"status": "ok", "missing": []})
    meta = ask("/api/meta")[1]
    assert meta["segments"] == ["Finance", "Sales"] and meta["variants"]["SENIOR_HIRE_12M"] == ["main", "sensitivity_manager"]
    state, measures = ask("/api/objectives/NEW_HIRE_6M/measures?grain=year&country=GR")
    assert state == 200 and [(m["numerator"], m["denominator"]) for m in measures] == [(66, 72.0)]  # those of July and later who left in December
    assert {r["objective_id"] for r in ask("/api/status?grain=year")[1]} == {"NEW_HIRE_6M", "SENIOR_HIRE_12M", "REGRETTED_TURNOVER_12M"}
    signals = ask("/api/signals/unemployment_rate?countries=GR")[1]
    assert {r["country_code"] for r in signals} == {"GR"} and signals[0]["as_of_date"] == date(2021, 1, 1) and signals[-1]["value"] is not None
    models = ask("/api/objectives/NEW_HIRE_6M/associations")[1]
    assert [(r["model"], r["n_obs"], r["n_events"]) for r in models if r["indicator_id"] == "unemployment_rate"] == [("within_country", 144, 10), ("naive", 144, 10)]
    assert {r["note"] for r in models if r["indicator_id"] != "unemployment_rate"} == {"no events"}
    cells = ask("/api/objectives/NEW_HIRE_6M/associations/unemployment_rate/cells")[1]
    assert sum(c["n"] for c in cells) == 144 and sum(c["events"] for c in cells) == 10
    findings = ask("/api/findings")[1]
    assert {*findings} == {"cohorts", "turnover", "tests", "significance", "definitions"} and findings["tests"][0]["strongest"] == "unemployment_rate"
    trust = ask("/api/trust")[1]
    assert trust["workforce"]["employees"] == 144 and len(trust["rules"]) == 23 and trust["freshness"][0]["countries"] == 2
    refused = {"/api/objectives/NONE/measures": 404, "/api/signals/none": 404, "/api/objectives/NEW_HIRE_6M/associations/none/cells": 404, "/api/nothing": 404, "/api/status?grain=week": 422,
               "/api/objectives/NEW_HIRE_6M/measures?variant=odd": 422, "/api/status?country=XX": 422, "/api/status?segment=Odd": 422, "/api/status?colour=red": 422, "/api/signals/unemployment_rate?countries=GR,XX": 422}
    assert {p: ask(p)[0] for p in refused} == refused
    assert "month, quarter, year" in ask("/api/status?grain=week")[1]["detail"]
    none = serving.Service(spark, str(built / "no"), standard())
    assert http_api.answer(none, "/api/meta")[0] == 503 == http_api.answer(none, "/api/health")[0]
    s._tables = {"objective_measures": None}
    state, body = ask("/api/status")
    assert state == 500 and len(body["request_id"]) == 32


def test_service_over_http(spark, built):
    import threading
    from urllib.request import urlopen

    with http_api.server(serving.Service(spark, str(built / "tables"), standard()), port=0) as s:
        threading.Thread(target=s.serve_forever, daemon=True).start()
        with urlopen(f"http://127.0.0.1:{s.server_address[1]}/api/health") as r:
            assert json.loads(r.read())["status"] == "ok" and r.headers["Content-Type"] == "application/json" and r.headers["Cache-Control"] == "no-store"
        s.shutdown()


def write_settings(folder, **changes):
    folder.mkdir()
    (folder.parent / "goals.csv").write_text("objective_id,direction,target_value,unit,effective_from,effective_to\nB,at_most,0.1,proportion,2021-01-01,2024-12-31\nA,at_least,0.9,proportion,2021-01-01,2024-12-31\n")
    files = {
        "analysis": {"objectives_file": "goals.csv", "reporting_start": "2021-01", "min_sample": 5, "segment": "business_unit", "signals": [{"indicator": "u", "lag_days": 3, "release": "FIN"}],
                     "objectives": {"A": {"measure": "cohort_retention", "months": 6, "levels": None}, "B": {"measure": "trailing_regretted_turnover", "months": 12}}},
        "countries": {"countries": [{"code": "GR", "name": "Greece", "eurostat": "EL", "worldbank": "GRC", "aliases": ["EL"]}, {"code": "IT", "name": "Italy", "eurostat": "IT", "worldbank": "ITA", "aliases": []}]},
        "workforce": {"source_file": "rows.csv", "as_of_date": "2025-12-31", "allowed": {"career_level": ["Manager"], "business_unit": ["Sales"], "employment_type": ["Permanent"]}},
        "sources": {"providers": {"eurostat": {"base_url": "http://h"}}, "history_start": "2019-01", "indicators": [{"id": "u", "provider": "eurostat", "dataset": "set", "lens": "l", "title": "t", "frequency": "M", "unit": "pc", "filters": {"sex": "T"}}]},
    }
    for name, table in files.items():
        (folder / f"{name}.json").write_text(json.dumps(table | changes.get(name, {})))
    return str(folder)


def test_settings_come_from_files(tmp_path):
    d = settings.load(write_settings(tmp_path / "c"))
    s = d.settings
    assert [(o.id, o.measure, o.target, o.months) for o in s.objectives] == [("A", "cohort", 0.9, 6), ("B", "turnover", 0.1, 12)]
    assert (s.reporting_start, s.effective_to, s.as_of, s.min_sample) == (date(2021, 1, 1), date(2024, 12, 31), date(2025, 12, 31), 5)
    assert s.country_names == {"GR": "GR", "IT": "IT", "EL": "GR"} and s.geo_map == {("eurostat", "EL"): "GR", ("eurostat", "IT"): "IT"}
    (i,) = d.indicators
    assert (i.geos, i.filters, i.release_dimension, i.since) == (("EL", "IT"), {"sex": "T"}, "release", "2019-01") and d.lifecycle == str(tmp_path / "rows.csv")


@pytest.mark.parametrize("name, change, why", [
    ("analysis", {"odd": 1}, "unknown odd"), ("analysis", {"segment": "colour"}, "segment"), ("analysis", {"reporting_start": "soon"}, "no date"), ("analysis", {"signals": [{"indicator": "x", "lag_days": 1}]}, "signals of no indicator"),
    ("analysis", {"objectives": {"A": {"measure": "cohort_retention", "months": 6}}}, "only one place: B"), ("analysis", {"objectives_file": "none.csv"}, "no file"), ("workforce", {"career_level_aliases": {"x": "Nobody"}}, "Nobody"),
    ("sources", {"providers": {}}, "unknown provider"), ("countries", {"countries": [{"code": "GR", "aliases": ["X"]}, {"code": "IT", "aliases": ["X"]}]}, "two countries"),
])
def test_settings_that_cannot_hold_are_refused(tmp_path, name, change, why):
    with pytest.raises(ConfigError, match=why):
        settings.load(write_settings(tmp_path / "c", **{name: change}))


@pytest.mark.parametrize("row, why", [("A,at_least,0.9,days,,", "unit"), ("A,at_least,x,proportion,,", "target"), ("A,at_least,0.9,proportion,2022-01-01,2021-01-01", "ends"), ("A,at_least,0.9,proportion,,\nA,at_least,0.9,proportion,,", "repeats")])
def test_targets_are_checked(tmp_path, row, why):
    (tmp_path / "t.csv").write_text(f"objective_id,direction,target_value,unit,effective_from,effective_to\n{row}\n")
    with pytest.raises(ConfigError, match=why):
        settings.targets(tmp_path / "t.csv")


def test_cli_codes_gate_and_manifests(spark, tmp_path, capsys):
    at = lambda *names: [x for n in names for x in (f"--{n}", str(tmp_path / n))]
    assert cli.main(["nothing"]) == 2 == cli.main(["curate"]) == cli.main(["ingest", "--only", "none"]) == cli.main(["run", "--config", str(tmp_path / "none")])
    assert cli.main(["version"]) == 0 and capsys.readouterr().out.strip()
    assert cli.main(["health", *at("tables")]) == 1
    write_people(tmp_path / "lifecycle", [1, 2])
    folders = at("lifecycle", "snapshots", "tables", "reports")
    store = snapshots(spark, tmp_path / "snapshots")
    assert cli.main(["ingest", "--only", "unemployment_rate", *folders]) == 0 and cli.main(["ingest", *folders]) == 1
    runs = [json.loads(p.read_text()) for p in sorted((tmp_path / "reports" / "runs").iterdir())]
    assert [len(r["indicators"]) for r in runs] == [1, 6] and runs[0]["run_id"] < runs[1]["run_id"]
    assert cli.main(["curate", *folders]) == 0 and cli.main(["analyse", *folders]) == 0 and cli.main(["health", *folders]) == 0
    report = json.loads((tmp_path / "reports" / "quality_report.json").read_text())
    assert report["workforce_source"] == "lifecycle" and len(report["workforce_source_sha256"]) == 64 and len(report["missing_indicators"]) == 5
    body = store.read("eurostat", "unemployment_rate")[0].replace(b'"2021-01"', b'"2021-13"')
    store.write(body, SnapshotMeta("eurostat", "unemployment_rate", "une_rt_m", "u", [], "t", 200, digest(body), len(body), "now", 2))
    assert cli.main(["curate", *folders]) == 1  # a period that can't be read is an error
    rules = {r["rule_id"]: r["rows_affected"] for r in json.loads((tmp_path / "reports" / "quality_report.json").read_text())["rules"]}
    assert rules["EX_PERIOD_UNPARSEABLE"] == 2


def test_environment_sets_folders_limits_and_logs(spark, tmp_path, monkeypatch):
    assert runtime({"HOME": "x"}) == Runtime() and runtime({"QUILLON_DATA": ""}).folder("tables") == "tables"
    r = runtime({"QUILLON_DATA": "file:///d/", "QUILLON_CONFIG": "c", "QUILLON_HTTP_TIMEOUT": "2.5", "QUILLON_HTTP_TRIES": "2", "QUILLON_LOG_LEVEL": "debug"})
    a = cli.parser(r).parse_args(["ingest", "--reports", "mine"])
    assert (a.snapshots, a.tables, a.reports, a.config, a.log_level) == ("file:///d/snapshots", "file:///d/tables", "mine", "c", "DEBUG")
    for name, text in (("HTTP_TIMEOUT", "0"), ("HTTP_TIMEOUT", "nan"), ("HTTP_TIMEOUT", "x"), ("HTTP_TRIES", "0"), ("HTTP_TRIES", "1.5"), ("LOG_LEVEL", "loud"), ("OTHER", "1")):
        monkeypatch.setenv(f"QUILLON_{name}", text)
        assert cli.main(["version"]) == 2
        monkeypatch.delenv(f"QUILLON_{name}")
    asked = []
    monkeypatch.setattr(cli, "fetch", lambda request, tries, timeout: asked.append((tries, timeout)) or (200, cube()))
    monkeypatch.setenv("QUILLON_HTTP_TRIES", "2")
    monkeypatch.setenv("QUILLON_DATA", tmp_path.as_uri())
    assert cli.main(["ingest", "--live", "--only", "unemployment_rate"]) == 1 and asked == [(2, 30.0)]  # the payload is of another series
    assert len([*(tmp_path / "reports" / "runs").iterdir()]) == 1


def test_logs_carry_fields():
    record = logging.makeLogRecord({"name": "quillon.http", "levelname": "WARNING", "levelno": 30, "msg": "again %s", "args": ("now",), "tries": 2, "left": None})
    assert cli.TextLines("%(levelname)s %(name)s %(message)s").format(record) == "WARNING quillon.http again now tries=2"
    entry = json.loads(cli.JsonLines().format(record))
    assert entry.pop("time").endswith("+00:00") and entry == {"level": "WARNING", "logger": "quillon.http", "message": "again now", "tries": 2}
    try:
        raise ValueError("odd")
    except ValueError as e:
        record.exc_info = (ValueError, e, e.__traceback__)
    assert "ValueError: odd" in json.loads(cli.JsonLines().format(record))["raised"]
    cli.logs(True, "ERROR")
    assert logging.getLogger().level == logging.ERROR


def test_profile_is_a_step(spark, tmp_path):
    write_people(tmp_path / "rows.csv", [1, 2])
    with open(tmp_path / "rows.csv", "a") as f:
        f.write("Q1,EL|X,Sales,J,Manager,Permanent,2022-01-01,2022-06-30,Voluntary,false,HCM_A,2025-03-01\n" * 2 + "Q2,,Sales,J,Manager,Permanent,odd,,,,HCM_A,2025-01-01\n")
    assert cli.main(["profile", "--reports", str(tmp_path)]) == 2
    assert cli.main(["profile", "--lifecycle", str(tmp_path / "rows.csv"), "--reports", str(tmp_path)]) == 0
    checks = (tmp_path / "profile_checks.csv").read_text().splitlines()
    assert checks[0] == "position,check,n" and checks[1:3] == ["0,rows,27", "1,equal rows,1"] and len(checks) == 18
    details = (tmp_path / "profile_details.csv").read_text().splitlines()
    assert "boundary,days,180,1" in details and 'values,country_code,"",1' in details and "values,country_code,EL|X,1" in details and "range,first hire_date,2022-01-01,25" in details
    text = (tmp_path / "data_profile.md").read_text()
    assert "| EL\\|X | 1 |" in text and "| (blank) | 1 |" in text and "| 180 | 1 |" in text and "* record_updated_at: 2025-01-01 to 2025-03-01" in text


def test_profile_lists_the_most_frequent_of_many_values(spark):
    rows = spark.range(300).select(*[F.concat(F.lit("v"), F.least("id", F.lit(99))).alias(c) if c == "country_code" else F.col("id").cast("string").alias(c) if c == "employee_id" else F.lit("").alias(c) for c in workforce.COLUMNS])
    text = profile.report(profile.profile(rows, standard()), profile.details(rows), standard())
    assert "| v99 | 201 |" in text and "50 more values" in text and len(re.findall("^\\| v[0-9]", text, re.M)) == 50 and "hire_date: None to None" in text
    empty = rows.filter("false")
    assert "| rows | 0 |" in profile.report(profile.profile(empty, standard()), profile.details(empty), standard())


def test_stream_keeps_the_latest_version(spark, tmp_path):
    """Restarts, late rows, rows without a date, a batch that is repeated, and what a batch writes."""
    (tmp_path / "in").mkdir()
    schema, root = "employee_id string, record_updated_at string, source_row long, v string", str(tmp_path / "state")
    assert current(spark, root, schema).count() == 0
    first = [("a", "2025-01-01", 1, "old"), ("b", "2025-01-01", 2, "only"), (None, "2025-01-01", 9, "nobody"), *[(f"x{i}", "2025-01-01", 10 + i, "x") for i in range(400)]]
    batches = [first, [("a", "2025-02-01", 3, "new"), ("b", "2024-01-01", 4, "stale"), ("b", None, 99, "undated")], [("a", "2025-02-01", 5, "newer")], *[[(f"x{k}", f"2025-03-{k + 1:02}", 1000 + k, f"late {k}"), ("a", f"2024-03-{k + 1:02}", 2000 + k, "stale")] for k in range(7)]]
    want: dict = {}
    rows_of = lambda r: spark.read.parquet(f"{root}/run={r[0]}-{r[1]}").count()
    for n, rows in enumerate(batches):  # a new query for each: every batch is a restart
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        q = upsert(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), root, str(tmp_path / "ck"), fanout=3)
        q.processAllAvailable()
        q.stop()
        for i, day, row, v in rows:
            want[i] = max(want.get(i, ("", 0, "")), (day or "", row, v))
        state = State(spark, root, 3)
        assert state.last() == n and {*runs(n, 3)} <= state.stored() <= {*runs(n, 3), *runs(n - 1, 3)}
        if (n, n) in runs(n, 3):
            assert rows_of((n, n)) == len({r[0] for r in rows})  # nothing but the batch is written
    got = {r["employee_id"]: r["v"] for r in current(spark, root, schema, 3).collect()}
    assert got == {k: v[2] for k, v in want.items()} and runs(9, 3) == [(0, 8), (9, 9)] and rows_of((0, 8)) == len(want)
    state.write(9, spark.createDataFrame([("a", "2030-01-01", 5, "repeated")], schema))  # a batch that is repeated changes nothing
    assert {r["employee_id"]: r["v"] for r in current(spark, root, schema, 3).collect()} == got
    with pytest.raises(ValueError, match="another checkpoint"):
        state.write(0, spark.createDataFrame(first, schema))


def test_runs_cover_all_batches():
    for fanout in (2, 3, 8):
        for n in range(-1, 200):
            found = runs(n, fanout)
            assert [b for a, c in found for b in range(a, c + 1)] == [*range(n + 1)] and len(found) <= fanout * 8
            assert n < 0 or found[-1][1] == n and {*found[:-1]} <= {*runs(n - 1, fanout)}  # a batch writes its last run and no other
