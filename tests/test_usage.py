"""Selection, validation, rollup, publication, conversion and scanning on hand-computed cases."""

import json
import os
import random
import sqlite3
import stat

import pytest
from pyspark.sql import functions as F

from arbograph.functions.lines import lone_surrogate, sink_of
from arbograph.operators import ranked, usage
from arbograph.plans import collect, convert, publish
from arbograph.sources import inventory, tree

INV = "path string, st_size bigint, code bigint"


def folders_of(spark, rows, root):
    found = usage.subtree_rollup(usage.select_root(spark.createDataFrame(rows, INV), root), root)
    return {r.path: (r.parent_path, r.apparent_bytes, r.entries) for r in found.collect()}


def test_literal_root(spark):
    root = "/x/ali'ce%_"
    rows = [(root, 100, 0), (f"{root}/a%_file", 10, 0), (f"{root}/nested", 20, 0), (f"{root}/nested/b", 30, 0), (f"{root}/weird%_dir/file", 7, 0), ("/x/alice-other/foreign", 999, 0), (None, 1, 0)]
    rows += [(f"{root}/bulk/f-{i}", 1, 0) for i in range(4)]
    found = folders_of(spark, rows, root)
    assert found["."] == ("", 171, 9) and found["nested"] == (".", 50, 2) and found["weird%_dir"] == (".", 7, 1) and found["bulk"][1] == 4


def test_listed_folder_that_is_no_direct_parent(spark):
    rows = [("/r", 100, 0), ("/r/a", 5, 0), ("/r/a/b/c/file", 17, 0), ("/r/nested", 20, 0), ("/r/nested/b", 30, 0)]
    found = folders_of(spark, rows, "/r")
    assert found == {".": ("", 172, 5), "a": (".", 17, 1), "a/b": ("a", 17, 1), "a/b/c": ("a/b", 17, 1), "nested": (".", 50, 2)}


def model(rows, root):
    parent = lambda p: p if p == root else p.rsplit("/", 1)[0]
    parents, out = {parent(p) for p, _, _ in rows}, {}
    for p, size, _ in rows:
        at = p if p in parents else parent(p)
        while True:
            b, n = out.get(at, (0, 0))
            out[at] = (b + size, n + 1)
            if at == root:
                break
            at = at.rsplit("/", 1)[0]
    return {"." if k == root else k[len(root) + 1 :]: v for k, v in out.items()}


def test_random_inventories(spark):
    rng = random.Random(4)
    for _ in range(6):
        names = ["a", "b'", "c%", " d", "é", "a_"]
        paths = ["/r"] + ["/r/" + "/".join(rng.choice(names) for _ in range(rng.randint(1, 5))) for _ in range(60)]
        rows = [(p, rng.randint(0, 99), 0) for p in paths + paths[:5]]
        assert {k: v[1:] for k, v in folders_of(spark, rows, "/r").items()} == model(rows, "/r")


def test_validation(spark):
    bad = [("/r/a", 1, 1), ("/r/a", 1, None), ("/r/a", None, 0), ("/r/a", -1, 0), ("/r//a", 1, 0), ("/r/./a", 1, 0), ("/r/../a", 1, 0), ("/r/.", 1, 0), ("/r/..", 1, 0), ("/r/a/", 1, 0)]
    r = usage.validation_counts(usage.select_root(spark.createDataFrame([*bad, ("/r/ok", 5, 0), ("/r/shut", 5, 13)], INV), "/r")).first()
    assert (r.entries, r.unreadable_directories, r.invalid_rows) == (12, 1, 10)


def test_root_filter_is_pushed_down(spark, tmp_path):
    spark.createDataFrame([("/r/a", 1, 0)], INV).write.parquet(f"{tmp_path}/i")
    plan = usage.select_root(spark.read.parquet(f"{tmp_path}/i"), "/r")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(path,/r/)" in plan


def test_ranked(spark):
    f = spark.createDataFrame([(".", "", 30, 3), ("a", ".", 10, 1), ("b", ".", 10, 1), ("c", ".", 20, 1), ("c/d", "c", 20, 1)], "path string, parent_path string, apparent_bytes bigint, entries bigint")
    assert [r.path for r in ranked.ranked_children(f, ".", 2).collect()] == ["c", "a"]
    assert [r.path for r in ranked.depth_report(f, 1, 9).collect()] == ["c", "a", "b"]
    assert [r.path for r in ranked.longest_first(f).collect()][0] == "c/d"


@pytest.fixture
def place(tmp_path):
    os.chmod(tmp_path, 0o700)
    (tmp_path / "root").mkdir()
    return tmp_path


def published(spark, place, lines, **kw):
    source = place / "inv.jsonl"
    source.write_text("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines))
    request = publish.Request(str(source), str(place / "root"), str(place / "out" / "usage.sqlite3"), **({"completed": True, "snapshot_at": "2024-01-01T00:00:00Z"} | kw))
    return publish.publish(spark, request), place / "out" / "usage.sqlite3"


def test_publish_and_failures_keep_the_report(spark, place):
    root = str(place / "root")
    good = [{"path": root, "st_size": 13, "code": 0}, "", {"path": f"{root}/a/b/c/file", "st_size": 17, "code": 0, "more": 1}, {"path": f"{root}/shut", "st_size": 1, "code": 13}]
    code, report = published(spark, place, good)
    assert code == 0 and stat.S_IMODE(report.stat().st_mode) == 0o600
    with sqlite3.connect(report) as db:
        meta = dict(db.execute("SELECT key, value FROM metadata"))
        assert dict(db.execute("SELECT path, apparent_bytes FROM directories")) == {".": 31, "a": 17, "a/b": 17, "a/b/c": 17}
    assert (meta["status"], meta["complete_input"], meta["unreadable_directories"], meta["entries"]) == ("partial", "false", "1", "3")
    before = report.read_bytes()
    for lines, kw in [
        ([*good, "{unfinished"], {}), ([*good, '{"path":"/elsewhere\\udcff","st_size":1,"code":0}'], {}), ([{"path": root, "st_size": 1, "code": 1}], {}), ([{"path": root, "st_size": None, "code": 0}], {}), ([{"path": "/no", "st_size": 1, "code": 0}], {}),
        (good, {"completed": False}), (good, {"snapshot_at": "2026-09-20"}), (good, {"snapshot_at": "2999-01-01T00:00:00Z"}), (good, {"snapshot_at": "later"}),
    ]:
        assert published(spark, place, lines, **kw)[0] == 2 and report.read_bytes() == before


def test_usage_document_and_carry_forward(spark, place):
    lines, doc = [{"path": str(place / "root"), "st_size": 1, "code": 0}], place / "usage.json"
    doc.write_text(json.dumps({"owner_uid": os.getuid(), "used_bytes": 123, "files": 4, "limit_bytes": 1000, "observed_at": "2024-01-01T00:00:00Z"}))
    values = lambda p: dict(sqlite3.connect(p).execute("SELECT key, value FROM metadata"))
    code, report = published(spark, place, lines, fss_usage=str(doc))
    assert code == 0 and (values(report)["fss_used_bytes"], values(report)["fss_files"]) == ("123", "4")
    assert published(spark, place, lines, fss_carry_forward=True)[0] == 0
    assert values(report)["fss_used_bytes"] == "123" and "fss_lookup_failed_at" in values(report)
    doc.write_text(json.dumps({"owner_uid": os.getuid() + 1, "used_bytes": 1, "observed_at": "2024-01-01T00:00:00Z"}))
    assert published(spark, place, lines, fss_usage=str(doc))[0] == 2


def test_input_resolution(tmp_path):
    (tmp_path / "x.txt").write_text("")
    with pytest.raises(ValueError):
        inventory.inventory_files(tmp_path)
    (tmp_path / "b").mkdir()
    for n in ("b/2.parquet", "1.parquet"):
        (tmp_path / n).write_text("")
    assert [p.name for p in inventory.inventory_files(tmp_path)] == ["1.parquet", "2.parquet"]


RECORD = '"path":"/r/a","code":%s,"st_size":1,"st_atime":1.5,"st_mtime":2,"st_ctime":3}'
LINES = [
    ('{"name":"a",' + RECORD % 0, "code_0"), ('{"name":"\\u00e9",' + RECORD % 0 + "  \r", "code_0"), ('{"name":"a","path":"/r","code":13,"error":"x"}', "code_13"), ('{"name":"a","path":"/r","code":0,"st_size":"oops"}', "unparsed"), ("not json", "unparsed"),
    ('{"name":"\\udcff",' + RECORD % 0, "unparsed"), ('{"name":"\\ud83d\\ude00",' + RECORD % 0, "code_0"), ('{"name":"a",' + RECORD % -3, "code_-3"), ('{"name":"a",' + RECORD % "99999999999999999999", "unparsed"), ('{"name":"a",' + RECORD % '"0"', "unparsed"),
    ('{"name":"a",' + RECORD % "null", "unparsed"), ('{"name":"a","path":"/r"}', "unparsed"), ('{"name":"a",' + RECORD % 0 + " x", "unparsed"),
]


def test_convert(spark, tmp_path):
    source, out = tmp_path / "lines.jsonl", tmp_path / "out"
    source.write_bytes("".join(x + "\n" for x, _ in LINES).encode() + b"   \n\r\n")
    counts = convert.convert_file(spark, source, out, arrow=True)
    expected = {k: sum(s == k for _, s in LINES) for _, k in LINES}
    assert counts == expected and spark.read.parquet(f"{out}/code_0.parquet").count() == expected["code_0"]
    assert len((out / "unparsed.jsonl").read_text().splitlines()) == expected["unparsed"] and (out / "code_-3.jsonl").exists()
    import pyarrow as pa

    assert pa.ipc.open_file(out / "code_0.arrow").read_all().num_rows == expected["code_0"]
    source.write_text("")
    assert convert.convert_file(spark, source, out) == {} and not (out / "unparsed.jsonl").exists()
    lines = spark.createDataFrame(LINES, "value string, sink string").select(sink_of(F.col("value")).alias("got"), "sink", lone_surrogate(F.col("value")).alias("lone"))
    assert sum(r.lone for r in lines.collect()) == 1


def test_scan_and_collect(spark, place):
    root = place / "root"
    (root / "results" / "nested").mkdir(parents=True)
    for name, n in (("results/a.bin", 1000), ("results/nested/b.bin", 24), ("notes.txt", 5)):
        (root / name).write_bytes(b"x" * n)
    os.symlink(root / "results", root / "link")
    rows = tree.scan_tree(spark, str(root), f"{place}/levels", tasks=2).collect()
    assert len(rows) == 7 and {r.code for r in rows} == {0} and sum(r.st_size for r in rows if r.name.endswith("bin")) == 1024
    assert list(tree.list_directory(str(root / "gone"))) == []
    inventories = place / "inv"
    inventories.mkdir(mode=0o700)
    (inventories / "inventory-old.jsonl").write_text("")
    manifest = json.loads(collect.collect(spark, str(root), str(inventories), str(place / "rep" / "usage.sqlite3")).read_text())
    assert manifest["report_entries"] == "7" and not (inventories / "inventory-old.jsonl").exists() and os.path.exists(manifest["inventory"])
    with pytest.raises(publish.Refused):
        collect.collect(spark, str(root), str(inventories), str(place / "rep" / "usage.sqlite3"), publisher=lambda *_: 2)
    assert len(list(inventories.glob("inventory-*.jsonl"))) == 2


def test_large_directory_and_plan_of_direct_totals(spark):
    """A folder of 100,000 files; what is shuffled by path are rows of folders, as file rows combine by their folder first."""
    rows = spark.range(100_000).selectExpr("concat('/r/bulk/f-', id) AS path", "1L AS st_size", "0L AS code").union(spark.createDataFrame([("/r", 100, 0), ("/r/bulk", 7, 0)], INV))
    found = {r.path: (r.apparent_bytes, r.entries) for r in usage.subtree_rollup(usage.select_root(rows, "/r"), "/r").collect()}
    assert found == {".": (100_107, 100_002), "bulk": (100_007, 100_001)}


def test_many_folders(spark, place):
    root = str(place / "root")
    lines = [{"path": root, "st_size": 13, "code": 0}]
    for i in range(2_500):
        lines += [{"path": f"{root}/folder-{i}", "st_size": 3, "code": 0}, {"path": f"{root}/folder-{i}/file", "st_size": 7, "code": 0}]
    code, report = published(spark, place, lines)
    with sqlite3.connect(report) as db:
        found = {p: (b, n) for p, b, n in db.execute("SELECT path, apparent_bytes, entries FROM directories")}
    assert code == 0 and len(found) == 2_501 and found["."] == (25_013, 5_001) and found["folder-2499"] == (10, 2)


def test_parquet_inventory_is_read_below_the_root_alone(spark, place):
    root, source = place / "root", place / "inv"
    spark.createDataFrame([(str(root), 5, 0), (f"{root}/d/f", 6, 0), ("/elsewhere", None, None)], INV).write.parquet(str(source))
    target = place / "out" / "usage.sqlite3"
    assert publish.publish(spark, publish.Request(str(source), str(root), str(target), True, "2024-01-01T00:00:00Z")) == 0
    selected = inventory.inventory(spark, source).where(publish.under_root(F.col("path"), str(root)))
    plan = selected.agg(F.count_if("unreadable"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "PushedFilters: []" not in plan


def test_source_that_changes_keeps_the_report(spark, place, monkeypatch):
    lines = [{"path": str(place / "root"), "st_size": 13, "code": 0}]
    code, report = published(spark, place, lines)
    before, write, replace = report.read_bytes(), publish.write_sqlite, publish.replace_file
    more = lambda: (place / "inv.jsonl").open("a").write("\n")
    monkeypatch.setattr(publish, "write_sqlite", lambda *a: (write(*a), more()))  # after the second reading
    assert published(spark, place, lines)[0] == 2 and report.read_bytes() == before
    monkeypatch.setattr(publish, "write_sqlite", write)
    rolled = publish.rolled_up
    monkeypatch.setattr(publish, "rolled_up", lambda *a: (rolled(*a), more())[0])  # before it
    assert published(spark, place, lines)[0] == 2 and report.read_bytes() == before
    monkeypatch.setattr(publish, "rolled_up", rolled)
    monkeypatch.setattr(publish.shutil, "copyfileobj", lambda *a: (_ for _ in ()).throw(OSError("full")))
    assert published(spark, place, lines)[0] == 2 and report.read_bytes() == before
    assert [p.name for p in report.parent.iterdir()] == [report.name] and replace


def test_guards_and_links(place):
    open_to_all = place / "open"
    open_to_all.mkdir()
    os.chmod(open_to_all, 0o777)
    (place / "real").write_text("")
    (place / "link").symlink_to(place / "real")
    for target in (open_to_all / "usage.sqlite3", place / "link", place / "root"):
        with pytest.raises(publish.Refused):
            publish.guard_target(target)
    publish.guard_target(place / "real")
    (place / ".inventory-1.jsonl").symlink_to(place / "real")
    (place / ".inventory-2.jsonl").mkdir()
    (place / ".inventory-3.jsonl").write_text("")
    collect.clear(place, ".inventory-")
    assert {p.name for p in place.glob(".inventory-*")} == {".inventory-1.jsonl", ".inventory-2.jsonl"}
