"""Manifests, hygiene, audio and error rates on hand-made rows."""

import io
import random
import wave

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.numbers import coerce_duration
from corpusloom.operators import batches, errors, hygiene, manifest
from corpusloom.sources import shards, sinks
from corpusloom.sources import text as readers


def test_durations(spark):
    raw = ["1.5", "abc", "", None, "-2", "0.05", "25"]
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, r string").orderBy("i")
    assert [x[0] for x in rows.select(coerce_duration(F.col("r"))).collect()] == [1.5, 0.0, 0.0, 0.0, -2.0, 0.05, 25.0]


def test_audio_paths(spark):
    schema = "ordinal long, audio struct<bytes: binary, path: string>"
    rows = spark.createDataFrame(
        [(0, None), (1, (b"x", "a.wav")), (2, (None, "b.wav")), (3, (b"x", None)), (4, (b"", ""))], schema
    )
    got = rows.orderBy("ordinal").select(manifest.audio_path(F.col("audio"), F.col("ordinal"), "out"))
    assert [r[0] for r in got.collect()] == ["", "out/a.wav", "b.wav", "out/sample_000003.wav", "sample_000004.wav"]


def test_rejects_name_every_reason(spark):
    rows = spark.createDataFrame(
        [(1, "a", "5", "t"), (2, "a", "x", None), (3, "", "0", "t"), (4, "b", "99", "t"), (5, "c", None, "t")],
        "i int, audio_filepath string, raw_duration string, text string",
    )
    files = spark.createDataFrame([("a",), ("b",)], "audio_filepath string")
    got = {r["i"]: r["reasons"] for r in manifest.manifest_rejects(rows, files=files).collect()}
    assert got == {
        1: ["duplicate_path"], 2: ["null_text", "bad_duration", "duplicate_path"],
        3: ["missing_audio", "zero_duration"], 4: ["duration_out_of_range"],
        5: ["missing_audio", "bad_duration"],
    }


def test_manifest_round_trip_keeps_nulls_and_unicode(spark, tmp_path):
    rows = spark.createDataFrame([("p", float("nan"), "بسم"), (None, 1.0, None)], "audio_filepath string, duration double, text string")
    sinks.write_manifest(rows, f"{tmp_path}/m")
    raw = sorted(r[0] for r in spark.read.text(f"{tmp_path}/m").collect())
    assert raw == ['{"audio_filepath":"p","duration":0.0,"text":"بسم"}', '{"audio_filepath":null,"duration":1.0,"text":null}']
    lines, rejects = readers.manifest_texts(readers.read_manifest(spark, f"{tmp_path}/m"))
    assert lines.count() == 1 and rejects.count() == 1


def test_malformed_manifest_fails(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"text": "ok"}\nnot json\n')
    with pytest.raises(Exception):
        readers.read_manifest(spark, f"{tmp_path}/bad.json").collect()


def test_existing_corpus_is_kept(spark, tmp_path):
    one, two = (spark.createDataFrame([(t,)], "text string") for t in (" first ", "second"))
    sinks.write_corpus_if_absent(one, f"{tmp_path}/c")
    sinks.write_corpus_if_absent(two, f"{tmp_path}/c")
    assert [r[0] for r in readers.read_corpus(spark, f"{tmp_path}/c", "lines").collect()] == ["first"]


def test_shard_fallback_per_file(spark, tmp_path):
    for k, name in enumerate(["text_ar_simple", "text_ar_uthmani", "other"]):
        spark.createDataFrame([(f"t{k}",)], f"{name} string").write.parquet(f"{tmp_path}/train-{k:05d}.parquet")
    got = shards.text_fallback(spark, str(tmp_path))
    assert {(r["shard"], r["text"]) for r in got.collect()} == {(0, "t0"), (1, "t1")}


def test_missing_shard_stops_and_broken_shard_is_skipped(spark, tmp_path):
    for k in (0, 1, 3):
        spark.createDataFrame([(k,)], "v int").write.parquet(f"{tmp_path}/train-{k:05d}.parquet")
    (tmp_path / "train-00001.parquet" / "part-x.parquet").write_bytes(b"junk")
    assert shards.contiguous_shards(spark, str(tmp_path)) == 2
    schema = spark.createDataFrame([(1,)], "v int").schema
    assert sorted(r["v"] for r in shards.tolerant_scan(spark, str(tmp_path), schema=schema).collect()) == [0, 1]


def test_scan_reads_only_the_text(spark, tmp_path):
    rows = spark.createDataFrame([(b"x", "t")], "b binary, text string").selectExpr("struct(b AS bytes, 'p' AS path) AS audio", "text")
    rows.write.parquet(f"{tmp_path}/train-00000.parquet")
    scan = shards.scan_split(spark, str(tmp_path), columns=["text"])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in plan
    path_only = spark.read.parquet(f"{tmp_path}/train-00000.parquet").select("audio.path")
    assert "bytes" not in path_only._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def test_shards_with_equal_content_are_dropped(spark, tmp_path):
    for name, body in (("a/train-00000", b"x" * 50), ("b/train-00000", b"x" * 50), ("b/train-00001", b"x" * 49 + b"y")):
        path = tmp_path / f"{name}.parquet"
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(body)
    found = shards.find_shards(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])
    kept = sorted(r["path"].split(str(tmp_path))[1] for r in hygiene.dedup_shards(found).collect())
    assert kept == ["/a/train-00000.parquet", "/b/train-00001.parquet"]
    assert hygiene.dedup_shards(found, prefix=40, whole=False).count() == 1


def test_audio_probe(spark):
    def wav(rate, channels, width, frames):
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setparams((channels, width, rate, frames, "NONE", ""))
            w.writeframes(b"\0" * frames * channels * width)
        return out.getvalue()

    rows = spark.createDataFrame([(0, wav(16000, 1, 2, 800)), (1, wav(8000, 2, 4, 40)), (2, b"no"), (3, None)], "i int, p binary")
    got = {r["id"]: r for r in hygiene.audio_probe(rows, "i", F.col("p")).collect()}
    assert (got[0]["sample_rate"], got[0]["channels"], got[0]["sample_width"], got[0]["frames"], got[0]["rate_ok"]) == (16000, 1, 2, 800, True)
    assert (got[1]["sample_rate"], got[1]["channels"], got[1]["sample_width"], got[1]["frames"], got[1]["rate_ok"]) == (8000, 2, 4, 40, False)
    assert got[2]["frames"] is None and got[3]["duration"] is None and not got[3]["rate_ok"]


def brute_force_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_word_edits_match_brute_force():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 9))] for _ in range(2))
        s, i, d = errors.align_counts(a, b)
        assert s + i + d == brute_force_distance(a, b) and i - d == len(b) - len(a) and min(s, i, d) >= 0


def test_error_rates_of_code_points(spark):
    rows = spark.createDataFrame([("éa b", "ea b"), ("x y z", "x z")], "r string, h string")
    got = errors.error_rates(rows, "r", "h").first()
    assert (got["substitutions"], got["insertions"], got["deletions"]) == (1, 0, 1)
    assert (got["char_edits"], got["cer"], got["wer"]) == (3, round(3 / 9, 6), 0.4)


def test_step_plan_and_chunks(spark):
    rows = spark.range(33).withColumn("split", F.lit("s")).withColumn("duration", F.col("id") / 10)
    assert batches.training_step_plan(rows, "split", 16, 2).first()["max_steps"] == 6
    assert batches.training_step_plan(rows, "split", 16, 2, max_steps=5).first()["max_steps"] == 5
    total = batches.chunk_plan(rows, "id", 1).agg(F.sum("length_ms")).first()[0]
    assert [batches.chunk_ms(c) for c in batches.RIGHT_CONTEXTS] == [80, 160, 560, 1120]
    assert total == sum(100 * i for i in range(33))
    assert len(batches.bucket_edges(rows, 4)) == 3
