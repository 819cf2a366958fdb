"""Results do not depend on how a large key is cut."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardweave.operators.ordered import Running, asof_join, numbered, running
from cardweave.operators.lookups import flag_duplicates, with_node
from cardweave.operators.matching import (
    TAG_FIELDS, Unexploded, exploded_tag_sets, match, matching_index, salted_join)
from cardweave.operators.processors import process_requests, to_card_transaction, to_message_processed
from cardweave.operators.replay import history_state, replay
from cardweave.session import materialize
from cardweave.sources import derived
from cardweave.sources.derived import MESSAGE_ORDER


def same(left, right):
    right = right.select(*left.columns)
    assert left.count() == right.count()
    assert left.exceptAll(right).isEmpty()


def test_running_values_of_a_hot_key(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("k"), (F.col("id") * 37 % 501).alias("t"),
        F.col("id").alias("n"), F.when(F.col("id") % 5 == 0, F.col("id")).alias("v"))
    outputs = {"total": Running("sum", F.col("v")), "newest": Running("last", F.col("v")),
               "bits": Running("bit_or", F.col("n") % 64),
               "restart": Running("sum", F.col("n"), within=("t",))}
    for exclusive in (False, True):
        whole = running(rows, ["k"], ["t", "n"], outputs, exclusive=exclusive)
        same(whole, running(rows, ["k"], ["t", "n"], outputs, limit=50, exclusive=exclusive))


def test_copies_of_one_row_spread(spark):
    rows = spark.range(500).select(F.lit("k").alias("k"), F.lit(1).alias("t"))
    out = running(rows, ["k"], ["t"], {"n": Running("sum", F.lit(1))}, limit=40)
    assert sorted(r["n"] for r in out.collect()) == list(range(1, 501))


@pytest.mark.parametrize("strict", [False, True])
def test_asof_against_brute_force(spark, strict):
    left = spark.range(400).select(
        (F.col("id") % 2).alias("k"), (F.col("id") * 13 % 97).alias("t"), F.col("id").alias("n"))
    right = spark.range(120).select(
        (F.col("id") % 2).alias("k"), (F.col("id") * 7 % 89 + 5).alias("u"), F.col("id").alias("p"))
    reach = (F.col("u") < F.col("t")) if strict else (F.col("u") <= F.col("t"))
    pairs = left.join(right.withColumnRenamed("k", "k2"), (F.col("k") == F.col("k2")) & reach, "left")
    rank = Window.partitionBy("n").orderBy(F.col("u").desc(), F.col("p").desc())
    expected = pairs.withColumn("r", F.row_number().over(rank)).where("r = 1").select(
        "k", "t", "n", "p")
    for limit in (1_000_000, 30):
        same(expected, asof_join(left, right, ["k"], F.col("t"), F.col("u"), ["p"], strict, limit))


def test_replay_of_long_transactions(spark, folder):
    """All messages of a card as one transaction, cut into pieces of a few rows."""
    rows = derived.messages(spark, folder).drop("message").withColumn(
        "transaction_id", F.when(F.col("debit_card_id") < "C-2", "hot")
        .otherwise(F.col("debit_card_id")))
    whole = replay(rows, MESSAGE_ORDER, limit=1_000_000)
    same(whole, replay(rows, MESSAGE_ORDER, limit=150))


def test_replay_ignores_input_order(spark, folder):
    rows = derived.messages(spark, folder).drop("message")
    same(replay(rows, MESSAGE_ORDER), replay(rows.orderBy(F.rand(3)), MESSAGE_ORDER))


def test_ledger_invariants(spark, folder):
    out = replay(derived.messages(spark, folder).drop("message"), MESSAGE_ORDER).where("error is null")
    sums = out.groupBy("transaction_id").agg(
        F.sum("client_amount").alias("c"), F.sum("wirecard_amount").alias("w"),
        F.max_by("total_client_amount", F.struct(*MESSAGE_ORDER)).alias("tc"),
        F.max(F.col("outcome") == "no_change").alias("bare"))
    assert sums.where("not bare and (coalesce(c, 0) <> tc or coalesce(c, 0) + coalesce(w, 0) <> 0)"
                      ).isEmpty()


def test_replay_in_two_batches(spark, folder):
    """Stored state plus the seen messages stand in for the first batch."""
    rows = derived.messages(spark, folder).drop("message")
    cut = F.lit("1998-06-01").cast("timestamp_ntz")
    early, late = (rows.where(F.col("transaction_date_time") < cut),
                   rows.where(F.col("transaction_date_time") >= cut))
    first = materialize(replay(early, MESSAGE_ORDER))
    history = to_card_transaction(
        to_message_processed(first.withColumn("message", F.lit(None))),
        ["transaction_date_time", "type_rank", "settlement_amount", "process_id"])
    flagged = flag_duplicates(late, history).withColumnRenamed("is_duplicate", "seen_before")
    for limit in (1_000, 4):
        second = replay(flagged, MESSAGE_ORDER, start=history_state(history, MESSAGE_ORDER), limit=limit)
        same(replay(rows, MESSAGE_ORDER), first.unionByName(second))


def test_null_ids_and_ties_do_not_depend_on_size(spark, folder):
    """Null ids are errors, and deliveries that differ only in amount keep one order."""
    rows = derived.messages(spark, folder).drop("message").where("job = 'presentment'").limit(60)
    nulls = rows.withColumn("transaction_id", F.lit(None).cast("string"))
    ties = rows.withColumns({
        "transaction_id": F.lit("hot"), "process_id": F.lit("p"), "provider_message_id": F.concat(
            F.lit("m"), (F.hash("key") % 20).cast("string")),
        "transaction_date_time": F.lit("1998-01-01").cast("timestamp_ntz")})
    both = nulls.unionByName(ties)
    order = ["transaction_date_time", "type_rank", "provider_message_id", "process_id"]
    whole = replay(both, order, limit=1_000_000)
    same(whole, replay(both, order, limit=10))
    same(whole, replay(both.orderBy(F.rand(5)), order, limit=7))
    assert whole.where("transaction_id is null and not error <=> 'missing_transaction_id'").isEmpty()
    window = {"total": Running("sum", F.col("settlement_amount"))}
    by_kind = ties.select("transaction_id", "type_rank", "settlement_amount", "key")
    same(running(by_kind, ["transaction_id"], ["type_rank"], window),
         running(by_kind, ["transaction_id"], ["type_rank"], window, limit=9))


def test_many_nodes_and_none(spark):
    processed = spark.range(200).select(
        F.col("id").cast("string").alias("process_id"),
        F.when(F.col("id") % 2 == 0, F.concat(F.lit("acc"), F.col("id"))).alias("internal_account_id"))
    nodes = spark.range(12_000).select(
        F.concat(F.lit("acc"), F.col("id")).alias("account_id"), F.col("id").cast("string").alias("node_id"),
        F.lit("g").alias("gps_account_id"), F.lit("t").alias("topic"))
    placed = with_node(processed, nodes)
    assert placed.count() == 200 and placed.where("node_id is null").isEmpty()
    assert placed.where("internal_account_id is not null and concat('acc', node_id) <> internal_account_id"
                        ).isEmpty()
    same(placed, with_node(processed, nodes.orderBy(F.rand(1))))
    assert with_node(processed, nodes.limit(0)).where("topic is not null").isEmpty()


def test_numbers_follow_the_order(spark):
    rows = spark.range(300).select((F.col("id") * 37 % 300).alias("n"))
    out, count = numbered(rows, ["n"], "at", rows_per_piece=40)
    assert count == 300 and out.where("at <> n").isEmpty() and out.count() == 300


def _slow_match(requests, index):
    """Newest index row under the best tag set a request shares, looked for request by request."""
    import itertools
    from cardweave.operators.matching import exploded_tag_sets
    asked = exploded_tag_sets(requests, "process_id").collect()
    by_key = {}
    for row in index.where("tag_set is not null").collect():
        by_key.setdefault((row["card_token"], row["tag_set"], row["signature"]), []).append(
            (row["timestamp"], row["transaction_id"]))
    found = {}
    for process_id, rows in itertools.groupby(sorted(asked, key=lambda r: r["process_id"]), lambda r: r["process_id"]):
        hits = [(r["priority"], max(by_key[k])[1]) for r in rows
                if (k := (r["card_token"], r["tag_set"], r["signature"])) in by_key]
        found[process_id] = min(hits)[1] if hits else None
    return found


@pytest.mark.parametrize("limit,broadcast_asked", [(1_000_000, 1_000_000), (1_000_000, 0), (20, 1_000_000), (20, 0)])
def test_match_against_brute_force(spark, folder, limit, broadcast_asked):
    """A third of the requests ask under one key, which also has many index rows; all ways agree."""
    rows = derived.messages(spark, folder).where("debit_card_id < 'C-12'").withColumn(
        "timestamp", F.col("transaction_date_time"))
    busy = F.pmod(F.hash("process_id"), F.lit(3)) == 0
    rows = rows.withColumns({
        "card_token": F.when(busy, "TK-hot").otherwise(F.col("card_token")),
        "message": F.when(busy, F.col("message").withField("token", F.lit("TK-hot")).withField(
            "trans_link", F.lit("hot"))).otherwise(F.col("message"))})
    index = matching_index(rows.where("job = 'authorisation'").withColumnRenamed("message", "request"))
    requests = rows.where("job <> 'authorisation'").drop("transaction_id")
    out = match(requests, index, required=True, limit=limit, broadcast_asked=broadcast_asked)
    expected = _slow_match(requests, index)
    got = {r["process_id"]: r["matched_id"] for r in out.select("process_id", "matched_id").collect()}
    assert len(got) == requests.count() and sum(v is not None for v in got.values()) > 100
    assert got == {p: expected.get(p) for p in got}


def test_match_deals_a_hot_key_over_many_tasks(spark):
    """One key of a third of the rows: no part of the salted join holds more than its share."""
    asked = spark.range(3000).select(
        F.concat(F.lit("p"), F.col("id")).alias("process_id"), F.lit(0).alias("priority"),
        F.lit(7).cast("long").alias("key_hash"), F.lit(8).cast("long").alias("key_check"))
    entries = spark.createDataFrame([(7, 8, "T")], "key_hash long, key_check long, matched_id string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
                                            "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        joined = salted_join(asked, entries, 64)
        parts = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(parts) == 3000 and len(parts) > 12 and max(parts) < 600


def test_match_of_nothing(spark, folder):
    rows = derived.messages(spark, folder).withColumn("timestamp", F.col("transaction_date_time"))
    index = matching_index(rows.withColumnRenamed("message", "request"))
    requests = rows.where("job = 'presentment'").drop("transaction_id")
    assert match(requests.limit(0), index, required=True).isEmpty()
    alone = match(requests, index.limit(0), required=False)
    assert alone.count() == requests.count() and alone.where("transaction_id <> process_id").isEmpty()
    lost = match(requests.withColumn("card_token", F.lit(None).cast("string")), index, required=True)
    assert lost.where("error is null").isEmpty() and lost.count() == requests.count()


@pytest.mark.parametrize("limit", [1_000_000, 20])
def test_match_by_card_against_brute_force(spark, limit):
    """An unexploded index: all keys of a card in one task, cards above the limit by key; ids repeat or are null."""
    fields = [f"{n} string" for n in ("token", *TAG_FIELDS)]
    kind = f"struct<{', '.join(f.replace(' ', ':') for f in fields)}>"

    def message(card, n):
        return (card, f"T-{n % 7}" if n % 3 else None, f"L-{n % 5}", f"{n % 2}" if n % 4 else None, "AR", "826", "d", f"R-{n % 3}")

    cards = [None if n % 11 == 0 else "hot" if n % 2 else f"c{n % 13}" for n in range(300)]
    assert len(message("c", 1)) == len(fields)
    stored = spark.createDataFrame(
        [(None if n % 17 == 0 else f"t{n % 40}", None if n % 19 == 0 else message(cards[n], n), n % 9, f"m{n % 90}") for n in range(300)],
        f"transaction_id string, request {kind}, at int, process_id string")
    requests = spark.createDataFrame(
        [(None if n % 23 == 0 else f"p{n % 70}", cards[n], message(cards[n], n + 1)) for n in range(90)],
        f"process_id string, card_token string, message {kind}")
    recorded = ["at", "process_id"]
    index = matching_index(stored, recorded)
    newest = {}
    for r in index.where("error is null and card_token is not null").collect():
        key = r["card_token"], r["tag_set"], r["signature"]
        newest[key] = max(newest.get(key, (-1,)), (r["at"], r["process_id"], r["transaction_id"]))
    best = {}
    for r in exploded_tag_sets(requests, "process_id").collect():
        key = r["card_token"], r["tag_set"], r["signature"]
        if r["process_id"] is not None and key in newest:
            best.setdefault(r["process_id"], {}).setdefault(r["priority"], set()).add(newest[key][2])
    out = match(requests, Unexploded(stored, tuple(recorded)), required=True, recorded=recorded, limit=limit, broadcast_asked=0)
    rows = out.select("process_id", "matched_id").collect()
    assert len(rows) == 90
    for process_id, matched in rows:
        assert matched in (best[process_id][min(best[process_id])] if process_id in best else {None})
    assert len({m for _, m in rows}) > 5


def test_match_by_card_moves_a_message_once(spark, folder):
    """One exchange for all tag sets of an index of messages, and no copy of what is asked for."""
    rows = derived.messages(spark, folder)
    requests = rows.where("job = 'presentment'").drop("transaction_id")
    index = derived.stored_index(spark, folder)
    out = match(requests, index, required=False, recorded=derived.RECORDED, broadcast_asked=0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key_hash" not in plan and "ExistingRDD" not in plan
    assert plan.count("hashpartitioning(card_token") == 1


def test_history_of_a_job_is_dealt_by_its_rows(spark, folder):
    """More history, more tasks; the result stays."""
    requests = derived.external_authorisations(spark, folder).drop("message")
    history = derived.stored_history(spark, folder, "externally_authorised")
    few = process_requests("externally_authorised", requests, history, derived.RECORDED)
    many = process_requests("externally_authorised", requests, history, derived.RECORDED, task_rows=500)
    assert "REPARTITION_BY_NUM" not in few._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in many._jdf.queryExecution().executedPlan().toString()
    same(few, many)
