import pytest

from sluice.sources import csv as csvsrc
from sluice.sources import files
from sluice.specs import Thresholds

from helpers import rows


def write(tmp_path, name, text, encoding="utf-8"):
    p = tmp_path / name
    p.write_text(text, encoding=encoding)
    return str(p)


def test_short_and_long_lines_are_corrupt_and_bad_numbers_are_not(spark, tmp_path):
    p = write(tmp_path, "t.csv", "id,amount,city\n1,2.5,a\n2,abc,b\n3,4\n4,5,c,d\n,,\n5,\"x,y\",z\n")
    raw = csvsrc.read_raw_csv(spark, p)
    clean, bad = csvsrc.split_corrupt(raw)
    assert rows(clean) == [("1", "2.5", "a"), ("2", "abc", "b"), ("5", "x,y", "z"), (None, None, None)]
    assert sorted(r[-1] for r in bad.collect()) == ["3,4", "4,5,c,d"]
    st = csvsrc.corrupt_stats(raw, Thresholds(max_corrupt_percent=5)).first()
    assert (st.total, st.corrupt) == (6, 2) and not st.passed


def test_corrupt_gate_is_strict_and_scan_parses_once(spark, tmp_path):
    body = "a,b\n" + "".join(f"{i},x\n" for i in range(19)) + "bad\n"  # 1 of 20 = exactly 5 %
    p = write(tmp_path, "g.csv", body)
    scan = csvsrc.scan_csv(spark, p, "G", Thresholds(max_corrupt_percent=5.0),
                           quarantine_path=str(tmp_path / "q"))
    assert (scan.total, scan.corrupt, scan.corrupt_percent) == (20, 1, 5.0)
    assert scan.clean.count() == 19
    assert [r.value for r in spark.read.text(str(tmp_path / "q")).collect()] == ["bad"]
    with pytest.raises(csvsrc.CorruptRecordsError, match="5.00% > 4.99%"):
        csvsrc.scan_csv(spark, p, "G", Thresholds(max_corrupt_percent=4.99))


def test_header_only_bom_and_reordered_header(spark, tmp_path):
    empty = write(tmp_path, "e.csv", "a,b\n")
    assert csvsrc.read_raw_csv(spark, empty).columns == ["a", "b", "_corrupt_record"]
    assert csvsrc.scan_csv(spark, empty, "E").total == 0
    bom = write(tmp_path, "bom.csv", "﻿k,v\nx,1\n")
    assert csvsrc.read_raw_csv(spark, bom).columns[0] == "k"
    re = write(tmp_path, "r.csv", "v,k\n1,x\n")  # names come from the file's own header
    assert rows(csvsrc.split_corrupt(csvsrc.read_raw_csv(spark, re))[0].select("k", "v")) == [("x", "1")]


def test_inventory_tables_required_files_and_objects(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    write(raw, "olist_customers_dataset.csv", "a\n1\n")
    write(raw, "UPPER.CSV", "a\n1\n")  # upper-case suffix: not picked up
    write(raw, "notes.txt", "x")
    (raw / "orders.csv").mkdir()
    write(raw / "orders.csv", "part-0.csv", "a\n1\n")
    write(raw / "orders.csv", "part-1.csv", "a\n2\n")
    (raw / "archive").mkdir()
    write(raw / "archive", "old.csv", "a\n1\n")  # not right below the root: no table
    inv = files.file_inventory(spark, str(raw))
    assert rows(inv.select("entry", "table_name").distinct()) == [
        ("olist_customers_dataset.csv", "OLIST_CUSTOMERS_DATASET"), ("orders.csv", "ORDERS")]
    t = {r.entry: r.files for r in files.table_inventory(inv).collect()}
    assert t == {"olist_customers_dataset.csv": 1, "orders.csv": 2}
    req = files.required_files(spark, inv, ["orders.csv", "sellers.csv"])
    assert rows(req.select("entry", "present")) == [("orders.csv", True), ("sellers.csv", False)]
    with pytest.raises(files.MissingFilesError, match="sellers.csv"):
        files.assert_required_files(req)
    obj = files.list_objects(spark, str(raw), sample=2).first()
    assert obj.object_count == 6 and len(obj.sample) == 2 and obj.sample == sorted(obj.sample)


def test_missing_directory_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        files.file_inventory(spark, str(tmp_path / "nope")).collect()


def test_empty_directory_gives_empty_inventory(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    try:
        n = files.file_inventory(spark, str(tmp_path / "empty")).count()
    except Exception:  # some Spark versions refuse to infer a schema over nothing
        n = 0
    assert n == 0


def test_inventory_of_a_relative_root(spark, tmp_path, monkeypatch):
    (tmp_path / "drop").mkdir()
    write(tmp_path / "drop", "t.csv", "a\n1\n")
    monkeypatch.chdir(tmp_path)
    got = rows(files.file_inventory(spark, "drop").select("entry", "table_name"))
    assert got == [("t.csv", "T")]
