"""Readers, publication and streams on files."""

import datetime as dt
import shutil
import time
import gzip
import zipfile

import pytest
from pyspark.sql import functions as F

from quern.session import ship
from quern.sources import files, publish
from quern.streaming import merge


def test_csv_json_xml_and_members(spark, tmp_path):
    ship(spark)
    (tmp_path / "a.csv").write_bytes("k;v\n1;å\n2;x\n".encode("latin-1"))
    assert [(r.k, r.v) for r in files.csv(spark, str(tmp_path / "a.csv"), ["k", "v"], sep=";", encoding="ISO-8859-1").collect()] == [("1", "å"), ("2", "x")]
    (tmp_path / "a.json").write_text('[{"k": 1, "v": "x"}, {"k": 2}]')
    assert [(r.k, r.v) for r in files.json_rows(spark, str(tmp_path / "a.json"), "k int, v string", array=True).collect()] == [(1, "x"), (2, None)]
    (tmp_path / "a.xml").write_text("<r><i><k>1</k></i><i><k>2</k></i></r>")
    assert [r.k for r in files.xml(spark, str(tmp_path / "a.xml"), "i", "k int").collect()] == [1, 2]
    box = tmp_path / "box"
    box.mkdir()
    with zipfile.ZipFile(box / "a.zip", "w") as z:
        z.writestr("x/one.json", "{}")
        z.writestr("two.txt", "t")
    (box / "three.json.gz").write_bytes(gzip.compress(b"[3]"))
    (box / "broken.zip").write_bytes(b"PK no")
    assert {(r.member, bytes(r.content)) for r in files.members(spark, str(box), ".json").collect()} == {("x/one.json", b"{}"), ("three.json", b"[3]")}
    origin = files.whole_texts(spark, str(tmp_path / "a.json")).first()
    assert origin._path.endswith("a.json") and origin._size == (tmp_path / "a.json").stat().st_size


def test_warc_xbrl_and_delegations(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>hi</p>"
    raw = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x.org/\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\nWARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(raw))
    assert {(r.type, r.uri, r.status, bytes(r.body)) for r in files.warc(spark, str(tmp_path / "a.warc.gz")).collect()} == {("response", "http://x.org/", 200, b"<p>hi</p>"), ("metadata", "", 0, b"ok")}
    xml = b'<x xmlns="http://www.xbrl.org/2003/instance" xmlns:t="t"><context id="c"><entity><identifier scheme="s">556</identifier></entity><period><startDate>2024-01-01</startDate><endDate>2024-12-31</endDate></period></context><unit id="u"><measure>iso:SEK</measure></unit><t:Revenue contextRef="c" unitRef="u">500000</t:Revenue></x>'
    assert files.xbrl_facts(xml) == [("Revenue", "c", "556", "2024-01-01", "2024-12-31", "iso:SEK", "500000")] and files.xbrl_facts(b"<x") == []
    (tmp_path / "d.txt").write_text("2|ripencc|20240101|2|||\nripencc|*|ipv4|*|1|summary\nripencc|SE|ipv4|10.0.0.0|256|20200102|allocated|x\nripencc|SE|asn|12|1|20200102|allocated|x\n")
    got = {(r.kind, r.first, r.last, r.day) for r in files.delegations(spark, str(tmp_path / "d.txt")).collect()}
    assert got == {("ipv4", 167772160, 167772415, dt.date(2020, 1, 2)), ("asn", None, None, dt.date(2020, 1, 2))}


def test_swap_keeps_the_old_table_when_a_check_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    assert publish.swap(spark.range(5), path) == 5
    with pytest.raises(publish.EmptyStage):
        publish.swap(spark.range(0), path)
    with pytest.raises(ZeroDivisionError):
        publish.swap(spark.range(9), path, check=lambda df: 1 / 0)
    assert spark.read.parquet(path).count() == 5
    assert publish.swap(spark.range(2), path) == 2 and spark.read.parquet(path).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(6).withColumn("d", F.col("id") % 3).write.partitionBy("d").parquet(path)
    publish.replace_partitions(spark.createDataFrame([(100, 1)], "id bigint, d bigint"), path, ["d"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 2, 3, 5, 100]
    with pytest.raises(publish.EmptyStage):
        publish.replace_partitions(spark.range(0).withColumn("d", F.lit(1)), path, ["d"])
    assert publish.drop_partition(spark, path, "d", "0") and sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 5, 100]


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 10), (3, None, 10)], "k int, v string, at int")
    new = spark.createDataFrame([(1, "a", 20), (2, "c", 20), (3, None, 20), (4, "d", 20)], "k int, v string, at int")
    merged = {(r.k, r.v, r.at) for r in publish.upsert(old, new, ["k"], "at").collect()}
    assert merged == {(1, "a", 10), (2, "c", 20), (3, None, 10), (4, "d", 20)}
    assert {r.k for r in publish.missing_keys(old, new, ["k"]).collect()} == {4}
    assert {r.k for r in publish.absent(old, new.where("k > 2"), ["k"]).collect()} == {1, 2}
    soft = publish.deactivate_absent(old.withColumn("active", F.lit(True)), new.where("k > 2"), ["k"], "active")
    assert {(r.k, r.active) for r in soft.collect()} == {(1, False), (2, False), (3, True)}
    window = publish.replace_window(old, new, F.col("k") >= 2)
    assert {(r.k, r.at) for r in window.collect()} == {(1, 10), (2, 20), (3, 20), (4, 20)}
    assert {(r.k, r.at) for r in publish.replace_window(window, new, F.col("k") >= 2).collect()} == {(1, 10), (2, 20), (3, 20), (4, 20)}
    kept = publish.unexpired(spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 5, 1),)], "until date"), "until", 90, F.lit("2024-05-01").cast("date"))
    assert kept.count() == 1 and [r.id for r in publish.rows(spark.range(3))] == [0, 1, 2]


def events(spark, rows):
    return spark.createDataFrame(rows, "user int, ts timestamp, kind string")


def test_merge_stream_and_replay(spark, tmp_path):
    at = lambda h: dt.datetime(2024, 1, 1, h)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = events(spark, []).schema
    events(spark, [(1, at(5), "a"), (2, at(6), "b")]).coalesce(1).write.parquet(source)
    merge.merge_stream(merge.folder_stream(spark, source, schema), target, str(tmp_path / "c1"), ["user"], "ts", "kind").awaitTermination()
    events(spark, [(1, at(3), "b"), (1, at(9), "a")]).coalesce(1).write.mode("append").parquet(source)
    merge.merge_stream(merge.folder_stream(spark, source, schema), target, str(tmp_path / "c1"), ["user"], "ts", "kind").awaitTermination()
    expected = {(1, at(3), at(9), ("a", "b")), (2, at(6), at(6), ("b",))}
    read = lambda: {(r.user, r.first_seen, r.last_seen, tuple(r.labels)) for r in spark.read.parquet(target).collect()}
    assert read() == expected
    merge.merge_stream(merge.folder_stream(spark, source, schema), target, str(tmp_path / "c2"), ["user"], "ts", "kind").awaitTermination()
    assert read() == expected


class Broken(Exception):
    pass


def breaks_after(monkeypatch, steps):
    """Renames and deletions end with an exception once `steps` of them are done."""
    left = [steps]

    def wrap(real):
        def step(*args):
            if not left[0]:
                raise Broken
            left[0] -= 1
            return real(*args)

        return step

    for name in ("_move", "_delete"):
        monkeypatch.setattr(publish, name, wrap(getattr(publish, name)))


def test_a_swap_broken_off_anywhere_loses_nothing(spark, tmp_path):
    for steps in range(9):
        path = str(tmp_path / f"t{steps}")
        publish.swap(spark.range(3), path)
        with pytest.MonkeyPatch.context() as patch:
            breaks_after(patch, steps)
            try:
                publish.swap(spark.range(7), path)
                done = True
            except Broken:
                done = False
        assert publish.current(spark, path).count() in ((7,) if done else (3, 7))
        publish.recover(spark, path)
        assert spark.read.parquet(path).count() == publish.current(spark, path).count()
        assert publish.swap(spark.range(2), path) == 2 and spark.read.parquet(path).count() == 2
    assert done


def test_a_merge_broken_off_anywhere_loses_nothing(spark, tmp_path):
    at = lambda h: dt.datetime(2024, 1, 1, h)
    schema = events(spark, []).schema
    for steps in (0, 1, 2, 3, 4, 5, 6, 8, 50):
        source, target, checkpoint = (str(tmp_path / f"{x}{steps}") for x in ("in", "out", "c"))
        run = lambda: merge.merge_stream(merge.folder_stream(spark, source, schema), target, checkpoint, ["user"], "ts", "kind", buckets=4).awaitTermination()  # noqa: B023, E731
        events(spark, [(k, at(5), "a") for k in range(6)]).coalesce(1).write.parquet(source)
        run()
        events(spark, [(k, at(3), "b") for k in range(4)]).coalesce(1).write.mode("append").parquet(source)
        with pytest.MonkeyPatch.context() as patch:
            breaks_after(patch, steps)
            try:
                run()
            except Exception:  # noqa: BLE001
                assert steps < 50
        run()
        got = {(r.user, r.first_seen, r.last_seen, tuple(r.labels)) for r in spark.read.parquet(target).collect()}
        assert got == {(k, at(3), at(5), ("a", "b")) for k in range(4)} | {(k, at(5), at(5), ("a",)) for k in (4, 5)}


def test_a_lost_state_is_no_new_one(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "c"))
    schema = events(spark, []).schema
    events(spark, [(1, dt.datetime(2024, 1, 1), "a")]).write.parquet(source)
    run = lambda: merge.merge_stream(merge.folder_stream(spark, source, schema), target, checkpoint, ["user"], "ts", "kind").awaitTermination()
    run()
    shutil.rmtree(target)
    events(spark, [(2, dt.datetime(2024, 1, 1), "a")]).write.mode("append").parquet(source)
    with pytest.raises(Exception, match="is gone"):
        run()


def test_buffered_and_refreshed(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    events(spark, [(k, dt.datetime(2024, 1, 1), "a") for k in range(10)]).coalesce(1).write.parquet(source)
    running = merge.buffered(merge.folder_stream(spark, source, events(spark, []).schema), out, str(tmp_path / "c"), rows=4, seconds=0.2)
    running.processAllAvailable()
    running.stop()
    files_ = list((tmp_path / "out").glob("batch=*/*.parquet"))
    assert len(files_) == 3 and spark.read.parquet(out).count() == 10
    made = []
    running = merge.refreshed(spark, lambda: made.append(1) or spark.range([3, 0, 5][min(len(made), 3) - 1]), str(tmp_path / "snap"), str(tmp_path / "c2"), 0.2)
    while len(made) < 4 and running.isActive:
        time.sleep(0.1)
    running.stop()
    publish.recover(spark, str(tmp_path / "snap"))
    assert spark.read.parquet(str(tmp_path / "snap")).count() == 5


def test_fan_out(spark, tmp_path):
    source = str(tmp_path / "in")
    events(spark, [(1, dt.datetime(2024, 1, 1), "a"), (2, dt.datetime(2024, 1, 1), "b")]).write.parquet(source)
    sinks = {"users": lambda df: df.select("user").distinct(), "kinds": lambda df: df.groupBy("kind").count()}
    for c in ("c1", "c2"):
        merge.fan_out(merge.folder_stream(spark, source, events(spark, []).schema), sinks, str(tmp_path / "out"), str(tmp_path / c)).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/users")).count() == 2 and spark.read.parquet(str(tmp_path / "out/kinds")).count() == 2


def test_refresh_decision():
    assert [merge.decision(*x) for x in ((True, 0, 0, 5), (False, 1, 99, 5), (False, 9, 1, 5), (False, 9, 99, 5))] == ["running", "too_fresh", "due_soon", "allow"]
