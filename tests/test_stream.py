"""Incremental jobs: exactly once over several runs, equal to batch at the end."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from corpusloom.operators.sampling import OrderedCorpus, cap_rows, stride_sample
from corpusloom.operators.stats import marked_word_counts
from corpusloom.plans.workflow import (
    build_manifest, build_vocabulary, corpus_texts, preset_options, train_from_lines,
)
from corpusloom.streaming import ingest, ledger
from corpusloom.streaming.progress import ProgressTable


def put(spark, root, k, texts):
    spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).write.parquet(f"{root}/train-{k:05d}.parquet")


def test_new_shards_are_read_once(spark, tmp_path):
    root, out, table, reports = (f"{tmp_path}/{n}" for n in ("in", "out", "table", "reports"))
    put(spark, root, 0, [" a b ", "", "b"])
    listener = ProgressTable(spark, reports)
    spark.streams.addListener(listener)

    def run():
        rows = ingest.stream_shards(spark, root, "text string")
        watched = ingest.with_progress(rows, F.nullif(F.btrim("text"), F.lit("")))
        listener.await_reports(ingest.incremental_ingest(ingest.clean_stream(watched), out, f"{tmp_path}/c1"))
        ingest.incremental_word_counts(rows, table, f"{tmp_path}/c2").awaitTermination()
        seen = ingest.progress_counters(spark, reports).orderBy("batch").collect()
        return [(r["rows_read"], r["lines_kept"]) for r in seen]

    assert ingest.progress_counters(spark, reports).count() == 0
    assert run() == [(3, 2)]
    put(spark, root, 1, ["a", None])
    assert run() == [(3, 2), (2, 1)]
    spark.streams.removeListener(listener)
    assert sorted(r["text"] for r in spark.read.schema("text string").parquet(out).collect()) == ["a", "a b", "b"]
    batch = marked_word_counts(spark.read.parquet(f"{root}/train-*.parquet").filter("text is not null"))
    assert sorted(ingest.word_count_table(spark, table).collect()) == sorted(batch.collect())


def test_every_batch_is_reported(spark, tmp_path):
    """More micro-batches than a query remembers."""
    root, reports = tmp_path / "in", f"{tmp_path}/reports"
    root.mkdir()
    for k in range(131):
        pq.write_table(pa.table({"text": [f"line {k}"]}), root / f"train-{k:05d}.parquet")
    listener = ProgressTable(spark, reports)
    spark.streams.addListener(listener)
    rows = ingest.stream_shards(spark, str(root), "text string", files_per_batch=1)
    watched = ingest.with_progress(rows, F.col("text"))
    query = ingest.incremental_ingest(watched, f"{tmp_path}/out", f"{tmp_path}/c")
    listener.await_reports(query)
    spark.streams.removeListener(listener)
    seen = ingest.progress_counters(spark, reports)
    assert seen.count() == seen.select("batch").distinct().count() == 131
    assert seen.agg(F.sum("rows_read"), F.sum("lines_kept")).first()[:] == (131, 131)


def shards_of(folder, sizes):
    folder.mkdir()
    n = 0
    for k, size in enumerate(sizes):
        texts = [f" row {n + i} " if (n + i) % 5 else " " for i in range(size)]
        pq.write_table(pa.table({"text": texts}), folder / f"train-{k:05d}.parquet")
        n += size


def batch_result(spark, root, percent, cap):
    rows = cap_rows(OrderedCorpus(spark, f"{root}/train-*.parquet").rows(["text"]), cap)
    return sorted((r["ordinal"], r["text"].strip()) for r in stride_sample(rows, percent).collect() if r["text"].strip())


@pytest.mark.parametrize("percent,cap,files", [(40, 37, 1), (100, 0, 2), (30, None, 3), (100, 1000, 4)])
def test_cap_and_stride_over_all_files(spark, tmp_path, percent, cap, files):
    root, out, entries = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/ledger"
    shards_of(root, [7, 0, 13, 1, 20, 9, 11])

    def run():
        rows = ingest.stream_shards(spark, str(root), "text string", files_per_batch=files)
        ledger.ordinal_ingest(rows, out, entries, f"{tmp_path}/c", percent=percent, max_samples=cap).awaitTermination()

    run()
    expected = batch_result(spark, root, percent, cap)
    read = spark.read.schema("text string, ordinal long").parquet(out)
    assert sorted((r["ordinal"], r["text"]) for r in read.collect()) == expected
    # A second run with one more shard goes on where the first one ended.
    pq.write_table(pa.table({"text": [f"late {i}" for i in range(5)]}), root / "train-00007.parquet")
    run()
    read = spark.read.schema("text string, ordinal long").parquet(out)
    assert sorted((r["ordinal"], r["text"]) for r in read.collect()) == batch_result(spark, root, percent, cap)
    listed = ledger.ledger_table(spark, entries)
    assert listed.agg(F.sum("rows")).first()[0] == 66


@pytest.mark.parametrize("fail_at", ["ledger", "rows"])
def test_retry_gives_the_same_rows(spark, tmp_path, monkeypatch, fail_at):
    root, out, entries = tmp_path / "in", f"{tmp_path}/out", f"{tmp_path}/ledger"
    shards_of(root, [7, 12, 13])
    calls = []
    plain = ledger.stride_sample if fail_at == "rows" else ledger.number_files

    def failing(*given):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost on purpose")
        return plain(*given)

    monkeypatch.setattr(ledger, "stride_sample" if fail_at == "rows" else "number_files", failing)

    def run():
        rows = ingest.stream_shards(spark, str(root), "text string", files_per_batch=1)
        ledger.ordinal_ingest(rows, out, entries, f"{tmp_path}/c", percent=40, max_samples=25).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    run()
    assert len(calls) == 4
    read = spark.read.schema("text string, ordinal long").parquet(out)
    assert sorted((r["ordinal"], r["text"]) for r in read.collect()) == batch_result(spark, root, 40, 25)


def test_preset_workflow(spark, tmp_path):
    assert preset_options("runpod-full", percent=5.0)["percent"] == 100.0
    assert preset_options("local-subset", percent=5.0)["num_files"] == 10
    root = f"{tmp_path}/shards"
    for k in range(3):
        column = "text_ar_simple" if k == 1 else "text_ar_uthmani"
        spark.createDataFrame([(f"row {k} {i}",) for i in range(10)], f"{column} string").coalesce(1).write.parquet(f"{root}/train-{k:05d}.parquet")
    options = preset_options("local-subset", percent=50.0, max_samples=25)
    assert corpus_texts(spark, root, options).count() == 13
    vocab = build_vocabulary(spark, root, f"{tmp_path}/out", vocab_size=22, model_type="bpe")
    assert vocab.count() == 22
    assert spark.read.text(f"{tmp_path}/out/tokenizer_spe_bpe_v22").count() == 22


def test_manifest_workflow(spark, tmp_path):
    root, out = f"{tmp_path}/in", f"{tmp_path}/out"
    schema = "audio struct<bytes: binary, path: string>, ayah_duration_s string, text_ar_uthmani string"
    for k in range(2):
        rows = [((b"x%d" % i, f"a{k}{i}.wav") if i else None, str(i) if i != 2 else "?", f"t{k}{i}") for i in range(4)]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/train-{k:05d}.parquet")
    source = next((tmp_path / "in" / "train-00000.parquet").glob("part-*.parquet"))
    (tmp_path / "in" / "copy").mkdir()
    (tmp_path / "in" / "copy" / "train-00000.parquet").write_bytes(source.read_bytes())
    got = build_manifest(spark, [root], out, max_samples=6).collect()
    assert sorted(r["text"] for r in got) == ["t00", "t01", "t02", "t03", "t10", "t11"]
    by_text = {r["text"]: r for r in got}
    assert by_text["t00"]["audio_filepath"] == "" and by_text["t02"]["duration"] == 0.0
    assert by_text["t01"]["audio_filepath"] == f"{out}/audio/a01.wav"
    assert (tmp_path / "out" / "audio" / "a11.wav").read_bytes() == b"x1"
    assert build_manifest(spark, [root], f"{out}2", percent=50).count() == 4


def test_options_of_line_training(spark, tmp_path):
    lines = spark.createDataFrame([("Abab 12 [x] abab",), ("abab  ab",)], "value string")
    vocab = train_from_lines(
        spark, lines, str(tmp_path), "spe", 30, "bpe", user_symbols=["[x]"], control_symbols=["<c>"],
        split_digits=True, remove_extra_whitespaces=True, max_piece_length=4, pad=True,
    )
    pieces = [r["piece"] for r in vocab.orderBy("id").collect()]
    assert pieces[4:6] == ["<c>", "[x]"] and "12" not in pieces and "[" not in pieces
    assert "abab" in pieces or "▁aba" in pieces or "▁ab" in pieces
    assert max(map(len, pieces[6:])) <= 4 and not any("A" in p for p in pieces)
    assert spark.read.text(f"{tmp_path}/tokenizer_spe_bpe_v30_max_4_pad").count() == len(pieces)
    wordpiece = train_from_lines(spark, lines, str(tmp_path), vocab_size=40)
    assert "abab" in [r["piece"] for r in wordpiece.collect()]
    sampled = train_from_lines(spark, lines, str(tmp_path), "spe", 40, "char", sample_size=1)
    assert sampled.count() < 20
