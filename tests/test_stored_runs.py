"""Stored tables by key: runs, merges, snapshots, and batches that break off."""

import pytest
from pyspark.sql import functions as F

from cardweave.schemas import SPENDING_TOTALS, STORED_HISTORY
from cardweave.sources import derived
from cardweave.sources.runs import KeyedTable, Store, rows_under
from cardweave.streaming.jobs import newest_totals, process_batch, published, store_of
from tests.test_streaming import make_job, records  # noqa: F401


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    """Fifty batches, some of whose keys repeat, and what every snapshot held."""
    schema = "k string, v int"
    fields = spark.createDataFrame([], schema).schema
    store = Store(spark, str(tmp_path_factory.mktemp("runs")), [
        KeyedTable("rows", fields, ("k",), buckets=8, fanout=4),
        KeyedTable("last", fields, ("k",), buckets=8, fanout=4,
                   newest=lambda df: df.groupBy("k").agg(F.max_by("v", "batch_id").alias("v"), F.max("batch_id").alias("batch_id")))])
    every, runs = [], []
    for batch in range(50):
        rows = [(f"k{batch % 7}", batch), (f"own{batch}", batch)] if batch % 10 else []
        every += [(*r, batch) for r in rows]
        df = spark.createDataFrame(rows, schema).coalesce(1)
        whole = store.add(store.snapshot(), batch, {"rows": df, "last": df})
        store.commit(whole)
        merged = store.compact(whole)
        if merged != whole:
            before = sorted(map(tuple, store.read("rows").collect())) if batch == 15 else None
            store.commit(merged)
            if before:
                assert sorted(map(tuple, store.read("rows").collect())) == before
        runs.append(len(store.snapshot().runs["rows"]))
    return store, every, runs


def test_runs_do_not_grow_with_the_batches(filled):
    store, every, runs = filled
    assert max(runs) <= 9 and max(runs[25:]) <= max(runs[:25]) + 3
    assert sorted(map(tuple, store.read("rows").collect())) == sorted(every)
    files = store.read("rows").inputFiles()
    assert len(files) <= 9 * 8
    newest = {k: v for k, v, _ in every}
    keys = store.spark.createDataFrame([("k1",), ("own3",), ("none",), (None,)], "k string")
    got = store.asked(store.snapshot(), "last").rows(keys).collect()
    assert sorted(map(tuple, got)) == sorted((k, newest[k]) for k in ("k1", "own3"))
    # merged runs of totals keep one row a key
    merged = [r for r in store.snapshot().runs["last"] if r.batch is None]
    for run in merged:
        rows = store.read("last", [run])
        assert rows.count() == rows.select("k").distinct().count()


def test_stored_rows_are_not_shuffled(spark, filled):
    store, _, _ = filled
    keys = spark.range(100).select(F.concat(F.lit("k"), "id").alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for run in store.snapshot().runs["rows"]:
            one = type(store.asked(store.snapshot(), "rows"))(store, store.tables["rows"], (run,))
            plan = plan_of(rows_under(one, keys, ["k"]))
            # the keys move, and what was found; between the scan and its join nothing does
            assert plan.count("ENSURE_REQUIREMENTS") <= 1 and plan.count("Exchange") <= 2, plan
            assert "Bucketed: true" in plan, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_writer_at_a_time(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), [KeyedTable("t", SPENDING_TOTALS, ("debit_card_id",), newest=newest_totals)])
    assert store.snapshot().batch == -1 and store.read("t").count() == 0
    empty = spark.createDataFrame([], SPENDING_TOTALS)
    one, two = store.add(store.snapshot(), 0, {"t": empty}), store.add(store.snapshot(), 0, {"t": empty})
    store.commit(one)
    with pytest.raises(RuntimeError):
        store.commit(two)
    assert store.snapshot() == one


class Broken(Exception):
    pass


def tables(spark, job):
    store = store_of(spark, job)
    out = [sorted(map(str, store.read(name).collect())) for name in ("history", "index", "totals")]
    return out + [sorted(map(str, published(spark, job, name).collect())) for name in ("events", "commands", "errors")]


def test_a_batch_that_breaks_off_anywhere_leaves_nothing(spark, folder, records, tmp_path, monkeypatch):  # noqa: F811
    few = records.where("key < 'C-105'").drop("at")
    half = few.where(F.xxhash64("value") % 2 == 0), few.where(F.xxhash64("value") % 2 != 0)
    whole = make_job(spark, folder, tmp_path / "whole")
    for n, part in enumerate(half):
        process_batch(part, n, whole)
    want = tables(spark, whole)
    assert want[0] and want[3]

    from cardweave.sources import runs, sinks
    job = make_job(spark, folder, tmp_path / "broken")
    process_batch(half[0], 0, job)
    first = tables(spark, job)
    write_run, save_batch, commit = runs.Store.write_run, sinks.save_batch, runs.Store.commit
    for step in (2, 5, 7):
        left = [step]

        def stop(act):
            def run(*args, **kwargs):
                left[0] -= 1
                if not left[0]:
                    raise Broken
                return act(*args, **kwargs)
            return run
        monkeypatch.setattr(runs.Store, "write_run", stop(write_run))
        monkeypatch.setattr(sinks, "save_batch", stop(save_batch))
        monkeypatch.setattr(runs.Store, "commit", stop(commit))
        with pytest.raises(Broken):
            process_batch(half[1], 1, job)
        monkeypatch.undo()
        assert tables(spark, job) == first
    process_batch(half[1], 1, job)
    assert tables(spark, job) == want
    assert process_batch(half[1], 1, job) is None
    assert tables(spark, job) == want


def test_a_later_round_replays_what_changed_only(spark):
    from cardweave.plans.catalog import stored_tables
    from cardweave.plans.flow import settle
    folder, folded = "/root/testdata/sf0.001", []
    results, unmatched = settle(derived.end_to_end_requests(spark, folder), stored_tables(spark, folder), folded)
    assert results.count() + unmatched.count() == folded[0]
    assert len(folded) > 3 and sum(folded) <= 2 * folded[0], folded
    assert STORED_HISTORY.names
