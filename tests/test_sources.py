"""Staged file fingerprints, WAV headers, line numbers over splits, bucket edges, manifest rejects, shard caps."""

import io
import itertools
import random
import struct
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.wav import wav_header
from corpusloom.operators import batches, hygiene
from corpusloom.sources import shards, sinks
from corpusloom.sources import text as readers


def library(payload):
    try:
        with wave.open(io.BytesIO(payload)) as w:
            return w.getframerate(), w.getnchannels(), w.getsampwidth(), w.getnframes()
    except (wave.Error, EOFError, struct.error, RuntimeError):
        return None, None, None, None


def chunk(name, body, size=None):
    return name + struct.pack("<I", len(body) if size is None else size) + body + b"\0" * (len(body) % 2)


def riff(*chunks):
    body = b"WAVE" + b"".join(chunks)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def test_wav_headers(spark):
    pcm = chunk(b"fmt ", struct.pack("<HHIIHH", 1, 2, 44100, 176400, 4, 16))
    wide = struct.pack("<HHIIHHHHI", 0xFFFE, 1, 48000, 144000, 3, 24, 22, 24, 4)
    extensible = chunk(b"fmt ", wide + bytes.fromhex("0100000000001000800000AA00389B71"))
    other = chunk(b"fmt ", wide + bytes.fromhex("0300000000001000800000AA00389B71"))
    floats = chunk(b"fmt ", struct.pack("<HHIIHH", 3, 1, 8000, 32000, 4, 32))
    data, odd = chunk(b"data", b"\1" * 40), chunk(b"JUNK", b"x" * 7)
    payloads = [
        riff(pcm, data), riff(odd, chunk(b"LIST", b"abcd"), pcm, odd, data), riff(extensible, data), riff(other, data),
        riff(floats, data), riff(pcm, chunk(b"data", b"\1" * 10, 4000)), riff(pcm), riff(data, pcm), riff(data), b"", b"RIFF",
        riff(pcm, data)[:30], riff(pcm, data)[:44], b"RIFX" + riff(pcm, data)[4:], riff(pcm, data) + b"more", riff(*[odd] * 40, pcm, data),
        riff(chunk(b"fmt ", struct.pack("<HHIIHH", 1, 0, 8000, 0, 0, 16)), data), riff(chunk(b"JUNK", b"", 2**32 - 1), pcm, data),
        riff(pcm, chunk(b"data", b"")), riff(chunk(b"fmt ", struct.pack("<HHIIHH", 1, 1, 8000, 8000, 1, 8)), data), b"no", riff(),
    ]
    df = spark.createDataFrame([(k, p) for k, p in enumerate([*payloads, None])], "i int, p binary")
    got = {r["i"]: tuple(r["h"]) for r in df.select("i", wav_header(F.col("p")).alias("h")).collect()}
    for k, payload in enumerate(payloads):
        assert got[k] == library(payload), k
    assert got[len(payloads)] == (None,) * 4
    plan = hygiene.audio_probe(df, "i", F.col("p"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_files_that_differ_late(spark, tmp_path):
    base = random.Random(1).randbytes(5000)
    bodies = {"a": base, "b": base, "c": base[:4000] + b"!" + base[4001:], "d": base[:1000], "e": base[:999] + b"?", "f": base[:1000],
              "g": b"x", "h": b"y" + base[1:], "i": base[:4999] + b"!"}
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
    listing = spark.createDataFrame([(f"{tmp_path}/{n}", len(b)) for n, b in bodies.items()], "path string, bytes long")

    def kept(**options):
        return sorted(r["path"][-1] for r in hygiene.dedup_shards(listing, **options).collect())

    assert kept(prefix=1000, range_bytes=700) == kept() == kept(prefix=1000, range_bytes=10_000) == list("acdeghi")
    assert kept(prefix=1000, whole=False) == list("adegh")
    gone = listing.unionAll(spark.createDataFrame([(f"{tmp_path}/zz", 1), (f"{tmp_path}/zy", 5000)], "path string, bytes long"))
    with pytest.raises(OSError):
        hygiene.dedup_shards(gone)
    left = [r["path"][-2:] for r in hygiene.dedup_shards(gone, keep_unreadable=True).collect()]
    assert {"zz", "zy"} <= set(left) and len(left) == 9
    assert hygiene.dedup_shards(listing.limit(0)).count() == 0


def test_records_that_differ_late(spark):
    long = "x" * (1 << 20)
    rows = [(1, long + "a"), (2, long + "b"), (3, long + "a"), (4, None), (5, None)]
    df = spark.createDataFrame(rows, "i long, t string")
    assert sorted(r["i"] for r in hygiene.dedup_records(df, "i", "t").collect()) == [1, 2, 4, 5]
    assert sorted(r["i"] for r in hygiene.keep_first_records(df, "i", "t").collect()) == [1, 2, 4, 5]


def test_line_numbers_over_many_splits(spark, tmp_path):
    rng, expected = random.Random(2), []
    paths = []
    for name in ("z", "a", "m"):
        (tmp_path / name).mkdir()
        for part in ("p0", "p1"):
            lines = [f"{name}{part} {k} " + "é" * rng.randrange(40) for k in range(rng.randrange(1, 400))]
            lines[len(lines) // 2] = ""
            (tmp_path / name / part).write_text("\n".join(lines) + ("\n" if part == "p0" else ""))
            expected += lines
        paths.append(f"{tmp_path}/{name}")
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "p").write_text("")
    paths.insert(1, f"{tmp_path}/empty")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        rows = readers.numbered_lines(spark, paths)
        assert rows.rdd.getNumPartitions() > 8
        got = sorted((r["position"], r["value"], r["file_order"]) for r in rows.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [g[1] for g in got] == expected and [g[0] for g in got] == list(range(len(expected)))
    assert [g[2] for g in got] == sorted(g[2] for g in got)


def test_union_keeps_order_and_fails_on_bad_lines(spark, tmp_path):
    for name, lines in (("b", ['{"audio_filepath":"1","duration":1.0,"text":"x"}', "", '{"text":null}']), ("a", ['{"text":"y"}'])):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    rows = readers.union_manifests(spark, f"{tmp_path}/b,{tmp_path}/a").orderBy("position").collect()
    assert [(r["position"], r["file_order"], r["text"]) for r in rows] == [(0, 0, "x"), (2, 0, None), (3, 1, "y")]
    (tmp_path / "bad").write_text("no json\n")
    with pytest.raises(Exception):
        readers.union_manifests(spark, f"{tmp_path}/bad").collect()


def test_edges_of_least_padding(spark):
    rng = np.random.default_rng(3)
    rows, longest = rng.integers(1, 50, 14).astype(float), np.sort(rng.random(14) * 30)
    for buckets in (1, 2, 3, 5, 20):
        ends = batches.least_padding(rows, longest, buckets)
        cost = sum(rows[a:b].sum() * longest[b - 1] for a, b in zip([0, *ends], ends))
        every = (sum(rows[a:b].sum() * longest[b - 1] for a, b in zip((0, *c), (*c, 14)))
                 for n in range(min(buckets, 14)) for c in itertools.combinations(range(1, 14), n))
        assert abs(cost - min(every)) < 1e-9 and ends[-1] == 14 and len(ends) <= buckets
    for values in (rng.lognormal(1, 1, 5000), rng.random(5000) * 20, np.concatenate((np.full(3000, 2.0), rng.random(999) * 30))):
        df = spark.createDataFrame([(float(v),) for v in values], "duration double")
        whole = batches.length_sketch(df)
        halves = batches.merge_sketches(batches.length_sketch(df.filter("duration < 3")), batches.length_sketch(df.filter("duration >= 3")))
        edges = batches.padding_edges(whole, 6)
        assert [r["upper"] for r in edges.collect()] == [r["upper"] for r in batches.padding_edges(halves, 6).collect()]
        quantiles = np.unique(np.quantile(values, [k / 6 for k in range(1, 6)], method="inverted_cdf"))
        bucket = np.searchsorted(quantiles, values, side="left")
        plain = sum(values[bucket == b].max() * (bucket == b).sum() for b in np.unique(bucket))
        mine = edges.agg(F.sum("padded"), F.sum("rows"), F.sum("used")).first()
        assert mine[0] <= plain + 1e-6 and mine[1] == len(values) and abs(mine[2] - values.sum()) < 1e-6
        inner = batches.inner_edges(edges)
        assert len(inner) == edges.count() - 1
        counted = np.bincount(np.searchsorted(inner, values, side="right"), minlength=len(inner) + 1)
        assert counted.tolist() == [r["rows"] for r in edges.orderBy("bucket").collect()]
    odd = spark.createDataFrame([(None,), (float("nan"),), (-1.0,), (float("inf"),)], "duration double")
    assert batches.padding_edges(batches.length_sketch(odd), 3).count() == 0


def test_durations_that_are_no_json(spark, tmp_path):
    rows = [("a", 1.5, "x"), ("b", float("nan"), "y"), ("c", float("inf"), None), ("d", float("-inf"), "z"), ("e", None, "w")]
    df = spark.createDataFrame(rows, "audio_filepath string, duration double, text string")
    sinks.write_manifest(df, f"{tmp_path}/m", rejects=f"{tmp_path}/r")
    assert sorted((r["audio_filepath"], r["duration"]) for r in readers.read_manifest(spark, f"{tmp_path}/m").collect()) == [("a", 1.5), ("e", None)]
    assert sorted(r["audio_filepath"] for r in spark.read.parquet(f"{tmp_path}/r").collect()) == ["b", "c", "d"]
    with pytest.raises(Exception, match="no JSON number"):
        sinks.write_manifest(df, f"{tmp_path}/m2")


def test_late_shards_and_unreadable_footers(spark, tmp_path):
    for k in (3, 771, 1000):
        spark.createDataFrame([(f"s{k}",)], "text_ar_simple string").coalesce(1).write.parquet(f"{tmp_path}/in/train-{k:05d}.parquet")
    assert shards.scan_split(spark, f"{tmp_path}/in").count() == 3
    assert shards.scan_split(spark, f"{tmp_path}/in", num_files=771).count() == 1
    assert shards.text_fallback(spark, f"{tmp_path}/in").count() == 3
    (tmp_path / "in" / "train-00004.parquet").write_bytes(b"PAR1 broken")
    with pytest.raises(Exception):
        shards.text_fallback(spark, f"{tmp_path}/in")
    assert shards.text_fallback(spark, f"{tmp_path}/in", tolerant=True).count() == 3
