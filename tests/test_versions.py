import pytest

from scholarmart.sources import versions


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, values):
    return spark.createDataFrame(values, "k string, v int")


SCHEMA = "k string, v int"


def test_readers_see_a_commit_as_a_whole(spark, tmp_path):
    root = f"{tmp_path}/lake"
    assert versions.manifest(spark, root).version == 0 and not versions.is_versioned(spark, root)
    first = versions.replace({"a": frame(spark, [("x", 1)]), "b": frame(spark, [("y", 2)])}, root)
    schema = frame(spark, []).schema
    old = versions.scan(spark, root, first, "a", schema)
    second = versions.replace({"a": frame(spark, [("x", 5)])}, root)
    assert rows(old) == [("x", 1)] and rows(versions.scan(spark, root, second, "a", schema)) == [("x", 5)]
    assert rows(versions.scan(spark, root, second, "b", schema)) == [("y", 2)] and versions.manifest(spark, root) == second
    assert rows(versions.scan(spark, root, second, "nothing", schema)) == []


def test_two_writers_cannot_both_commit(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    base = versions.replace({"a": frame(spark, [("x", 1)])}, root)
    versions.commit(spark, root, base, run="one")
    with pytest.raises(versions.Conflict):
        versions.commit(spark, root, base, run="two")
    assert versions.manifest(spark, root).runs == ("one",)


def test_parts_are_changed_added_and_emptied(spark, tmp_path):
    root, schema = f"{tmp_path}/lake", frame(spark, []).schema
    write = lambda values: versions.write_parts(frame(spark, values).withColumnRenamed("k", "p").selectExpr("p", "p AS k", "v"), root, versions.new_folder() + "/t", "p")
    now = versions.commit(spark, root, versions.Manifest(), replaced={"t": write([("m1", 1), ("m2", 2), ("m3", 3)])})
    now = versions.commit(spark, root, now, changed={"t": {**write([("m1", 9)]), "m3": []}}, added={"u": write([("m1", 7)])})
    assert rows(versions.scan(spark, root, now, "t", schema)) == [("m1", 9), ("m2", 2)]
    scan = versions.scan(spark, root, now, "t", schema, ["m2", "m8"])
    assert rows(scan) == [("m2", 2)] and all("p=m2" in f for f in scan.inputFiles())
    now = versions.commit(spark, root, now, added={"u": write([("m1", 8)])})
    assert rows(versions.scan(spark, root, now, "u", schema)) == [("m1", 7), ("m1", 8)]


def test_vacuum_spares_what_may_be_read(spark, tmp_path):
    root, schema = f"{tmp_path}/lake", frame(spark, []).schema
    for v in range(3):
        now = versions.replace({"a": frame(spark, [("x", v)])}, root)
    versions.new_folder()
    assert versions.vacuum(spark, root) == []
    assert len(versions.vacuum(spark, root, spare_seconds=-5)) == 2
    assert versions.manifest(spark, root) == now and rows(versions.scan(spark, root, now, "a", schema)) == [("x", 2)]
