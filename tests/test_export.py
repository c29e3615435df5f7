"""File export: whole files, reported duplicates, nothing left behind by failures."""

import time

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.files import resolve
from corpusloom.sources import audio_files
from corpusloom.sources.audio_files import export_audio


def files(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*") if p.is_file() and "_export" not in str(p)}


def test_files_and_report(spark, tmp_path):
    rows = [(1, "a.wav", b"one"), (2, "b/c.wav", b"two"), (3, "a.wav", b"other"), (4, "d.wav", None), (5, "e.wav", b""),
            (6, "../up.wav", b"x"), (7, None, b"x"), (8, "b/c.wav", b"two"), (9, "n" * 300, b"x"), (10, "a.wav", None)]
    df = spark.createDataFrame([(*r, "keep") for r in rows], "i int, n string, p binary, extra string").repartition(3)
    folder = tmp_path / "audio"
    got = {r["i"]: r for r in export_audio(df, str(folder), F.col("n"), F.col("p"), ["i", "extra"]).collect()}
    first = min((b"one", b"other"), key=lambda b: __import__("hashlib").sha256(b).hexdigest())
    assert files(folder) == {"a.wav": first, "b/c.wav": b"two"}
    assert {i: r["status"] for i, r in got.items()} == {
        1: "written" if first == b"one" else "duplicate", 2: "written", 3: "written" if first == b"other" else "duplicate",
        4: "no_bytes", 5: "no_bytes", 6: "bad_name", 7: "bad_name", 8: "written", 9: "bad_name", 10: "no_bytes"}
    assert [got[i]["copies"] for i in range(1, 11)] == [2, 2, 2, 0, 0, 1, 1, 2, 1, 0]
    assert got[1]["audio_filepath"] == got[3]["audio_filepath"] == f"{folder}/a.wav" and got[4]["audio_filepath"] == "d.wav"
    assert all(r["extra"] == "keep" for r in got.values())
    left = [p for p in folder.rglob("*") if p.is_file() and "_export" in str(p)]
    assert all("/report/" in str(p) for p in left)
    again = export_audio(df.filter("i = 2"), f"file:{folder}", F.col("n"), F.col("p"), ["i"])
    assert again.first()["audio_filepath"] == f"file:{folder}/b/c.wav"
    assert export_audio(df.limit(0), str(tmp_path / "none"), F.col("n"), F.col("p"), ["i"]).count() == 0


def test_failed_task_leaves_nothing(spark, tmp_path):
    df = spark.range(40, numPartitions=4).select(F.format_string("f%d.bin", "id").alias("n"), F.lit(b"data").alias("p"), "id")
    failing = df.withColumn("p", F.when(F.col("id") == 39, F.raise_error(F.lit("on purpose")).cast("binary")).otherwise(F.col("p")))
    with pytest.raises(Exception, match="on purpose"):
        export_audio(failing, str(tmp_path / "out"), F.col("n"), F.col("p"), ["id"]).collect()
    with pytest.raises(Exception, match="on purpose"):
        rows = failing.select("id", F.col("n").alias("_name"), F.col("p").alias("_payload"), F.lit(True).alias("_own"))
        spark.dataSource.register(audio_files.FileExport)
        rows.write.format(audio_files.FORMAT).mode("append").option("path", f"{tmp_path}/out/_export-1").save()
    for _ in range(50):  # other tasks of the aborted job notice a little later
        left = [p for p in tmp_path.rglob("*") if p.is_file()]
        if not left:
            break
        time.sleep(0.1)
    assert not left


def test_publishing_can_be_repeated(spark, tmp_path):
    import pyarrow as pa

    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "0").write_bytes(b"x")
    batch = pa.RecordBatch.from_pydict({"i": [1], "_name": ["k/a"], "_staged": [f"{tmp_path}/s/0"], "status": ["written"]})
    for _ in range(2):
        out = next(audio_files._publish(str(tmp_path / "t"))([batch]))
        assert out.column("audio_filepath").to_pylist() == [f"{tmp_path}/t/k/a"] and (tmp_path / "t/k/a").read_bytes() == b"x"
    lost = batch.set_column(1, "_name", pa.array(["k/b"]))
    with pytest.raises(FileNotFoundError):
        next(audio_files._publish(str(tmp_path / "t"))([lost]))


def test_unknown_store_raises():
    with pytest.raises(Exception):
        resolve("nosuch://bucket/x")
    assert resolve("file:/a%20b")[1] == "/a b" and resolve("/x")[1] == "/x"
