"""Row numbers, strides, caps and shares over several files."""

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.numbers import head_target, run_name, shards_to_take, stride_of
from corpusloom.operators import sampling
from corpusloom.operators.joins import left_lookup


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("rows")
    for k in range(5):
        spark.range(k * 200, (k + 1) * 200, 1, 1).write.parquet(f"{root}/train-{k:05d}.parquet")
    return sampling.OrderedCorpus(spark, f"file:{root}/train-*.parquet")


def test_ordinals_are_dense_and_in_file_order(corpus):
    rows = corpus.rows().collect()
    assert sorted((r["ordinal"], r["id"]) for r in rows) == [(i, i) for i in range(1000)]


@pytest.mark.parametrize("percent,kept", [(1, 10), (10, 100), (30, 334), (40, 500), (60, 1000), (100, 1000)])
def test_stride_keeps_the_exact_rule(corpus, percent, kept):
    assert sampling.stride_sample(corpus.rows(), percent).count() == kept


@pytest.mark.parametrize("cap,kept", [(None, 1000), (0, 0), (1, 1), (450, 450), (5000, 1000)])
def test_cap_counts_rows_read(corpus, cap, kept):
    assert corpus.rows(cap=cap).count() == kept
    if cap:
        assert sampling.stride_sample(corpus.rows(cap=cap), 50).count() == -(-kept // 2)


def test_cap_reads_only_the_files_it_needs(corpus):
    assert len(corpus.rows(cap=250).inputFiles()) == 2


def test_head_percent_modes(corpus):
    assert corpus.total == 1000 and corpus.estimated_total == 1000
    assert corpus.head_percent(12.5).count() == 125
    assert corpus.head_percent(0.01, "first_shard").count() == 1


def test_offsets_join_is_broadcast(corpus):
    plan = corpus.rows()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Window" not in plan


def test_rules():
    assert [stride_of(p) for p in (1, 30, 40, 60, 100)] == [100, 3, 2, 1, 1]
    assert [shards_to_take(771, p) for p in (0, 1, 50, 100, 300)] == [1, 8, 386, 771, 771]
    assert head_target(1000, 0.01) == 1
    assert run_name("wpe", 1024) == "tokenizer_wpe_v1024"
    assert run_name("spe", 8, "bpe", 4, bos=True) == "tokenizer_spe_bpe_v8_max_4_bos"


def test_group_positions_match_a_global_window(corpus):
    rows = corpus.rows().withColumn("g", F.when(F.col("id") % 10 < 7, 0).when(F.col("id") % 3 > 0, F.col("id") % 3))
    got = sampling.group_positions(rows, ["g"], block_rows=64).collect()
    seen, expected = {}, {}
    for r in sorted(got, key=lambda r: r["ordinal"]):
        expected[r["ordinal"]] = seen.get(r["g"], 0)
        seen[r["g"]] = expected[r["ordinal"]] + 1
    assert {r["ordinal"]: r["position"] for r in got} == expected


def test_shuffles_repeat_for_a_seed(corpus):
    def order(seed, buffer=None):
        return [r["id"] for r in sampling.seeded_shuffle(corpus.rows(), ["id"], seed, buffer).collect()]

    assert order(1) == order(1) != order(2)
    assert sorted(order(1)) == list(range(1000)) != order(1)
    buffered = order(1, 100)
    assert [i // 100 for i in buffered] == [i // 100 for i in range(1000)] and buffered != list(range(1000))


def test_sample_is_stable_under_repartition(corpus):
    def pick(df):
        return {r["id"] for r in sampling.sample_sentences(df, 37, ["id"], seed=4).collect()}

    assert pick(corpus.rows()) == pick(corpus.rows().repartition(7)) and len(pick(corpus.rows())) == 37


def test_sample_size_is_exact_and_nested(corpus):
    picks = [{r["id"] for r in sampling.sample_sentences(corpus.rows(), n, ["id"], 4).collect()} for n in (1, 60, 999, 1000, 5000)]
    assert [len(p) for p in picks] == [1, 60, 999, 1000, 1000]
    assert all(a <= b for a, b in zip(picks, picks[1:]))


def test_sampling_moves_no_rows(corpus):
    plan = sampling.sample_sentences(corpus.rows(), 60, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Exchange hash" not in plan


def test_left_lookup_with_hot_and_cold_keys(spark):
    rows = spark.createDataFrame([("hot" if i % 2 else f"k{i % 30}", i) for i in range(300)] + [(None, -1)], "k string, i int")
    lookup = spark.createDataFrame([("hot", 1), ("k4", 2), ("zz", 3)], "k string, v int")
    hot = spark.createDataFrame([("hot",), ("k8",)], "k string")
    got = {(r["k"], r["i"], r["v"]) for r in left_lookup(rows, lookup, "k", hot).collect()}
    assert got == {(r["k"], r["i"], r["v"]) for r in rows.join(lookup, "k", "left").collect()}
