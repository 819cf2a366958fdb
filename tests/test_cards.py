"""A batch settled in one pass per card gives what the rounds give, without any round."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardweave.plans import flow
from cardweave.plans.catalog import stored_tables
from cardweave.sources import derived

COLUMNS = ["process_id", "transaction_id", "error", "outcome", "total_client_amount", "total_earmark_amount",
           "total_wirecard_amount", "internal_account_id"]


def rows(df):
    return sorted(map(str, df.select(*COLUMNS).collect()))


def batch(spark, folder):
    """Messages of some cards: one without a token, one sent twice, one whose process id two cards share."""
    some = derived.end_to_end_requests(spark, folder).where("pmod(xxhash64(debit_card_id), 6) = 0")
    anonymous = some.where("process_id like 'A-%'").withColumn("card_token", F.lit(None).cast("string"))
    shared = some.where("process_id like 'A-%'").limit(3).withColumn("card_token", F.lit("TK-other"))
    twice = some.where("pmod(xxhash64(process_id), 9) = 0")
    return (some.where("pmod(xxhash64(process_id), 7) <> 0").unionByName(twice).unionByName(shared)
            .unionByName(anonymous.where("pmod(xxhash64(process_id), 7) = 0"))).localCheckpoint()


def test_one_pass_gives_what_the_rounds_give(spark, folder, monkeypatch):
    requests, stored = batch(spark, folder), stored_tables(spark, folder)
    results, lost = flow.settle(requests, stored)
    want = rows(results.unionByName(lost))
    assert rows(flow.settle_by_card(requests, stored)) == want      # shared process ids go through rounds
    assert rows(flow.settle_by_card(requests, stored, limit=40)) == want


def test_usual_cards_need_no_round(spark, folder, monkeypatch):
    def no_rounds(*_):
        raise AssertionError("settled in rounds")
    monkeypatch.setattr(flow, "_settle", no_rounds)
    requests = derived.end_to_end_requests(spark, folder)
    assert flow.settle_by_card(requests, stored_tables(spark, folder)).count() == requests.count()


def test_a_slim_message_sorts_as_the_whole_one(spark, folder):
    from cardweave.operators.lookups import history_lookup
    history = derived.stored_history(spark, folder).where("transaction_id in (1, 2, 3, 5, 7, 32, 33, 34)")
    m = F.col("message")
    odd = reduce(DataFrame.unionByName, [history.where(f"type_rank = {rank}").withColumn("message", m.withField(
        name, value)).withColumn("earmark_amount", F.col("earmark_amount") + number) for number, (rank, name, value) in
        enumerate([(3, "traceid_lifecycle", F.lit(None).cast("string")), (4, "auth_code_de38", F.lit("000000")),
                   (4, "auth_code_de38", F.lit(None).cast("string")), (4, "txn_type", F.lit("A")),
                   (1, "acquirer_reference_data_031", F.lit(None).cast("string"))])])
    stored = history.unionByName(odd).localCheckpoint()
    slim = derived.with_slim_message(stored)
    assert len(slim.schema["message"].dataType.fields) < len(stored.schema["message"].dataType.fields)
    order = ["-timestamp", "-type_rank", "-process_id"]
    whole, thin = [history_lookup(stored, h, order).drop("message").collect() for h in (stored, slim)]
    assert len(whole) > 8 and sorted(map(str, whole)) == sorted(map(str, thin))


def test_usual_messages_are_not_written_out_before_they_move(spark, folder, monkeypatch):
    def early(*_):
        raise AssertionError("prepared and written before the messages moved")
    monkeypatch.setattr(flow, "prepare", early)
    requests = derived.end_to_end_requests(spark, folder).where("pmod(xxhash64(debit_card_id), 6) = 0")
    assert flow.settle_by_card(requests, stored_tables(spark, folder)).count() == requests.count()


def odd_tables(spark, folder):
    """Requests and tables with cards that are null, missing or there twice, and accounts of any time."""
    def odd(df, *names):
        row = F.pmod(F.xxhash64(*[F.col(c) for c, kind in df.dtypes if not kind.startswith("map")]), F.lit(11))
        for n, name in enumerate(names):
            df = df.withColumn(name, F.when(row != n, F.col(name)))
        return df.unionByName(df.where(row > 8)).localCheckpoint()
    stored = stored_tables(spark, folder)
    requests = derived.end_to_end_requests(spark, folder).where("pmod(xxhash64(debit_card_id), 20) = 0")
    return odd(requests, "debit_card_id", "spend_group", "transaction_date_time", "card_token", "job"), flow.replace(
        stored, settings=odd(stored.settings, "debit_card_id", "linked_account_id", "card_status"),
        balances=odd(stored.balances, "account_id", "available"),
        totals=odd(stored.totals, "debit_card_id", "total_type", "timestamp"),
        linked_accounts=odd(stored.linked_accounts, "debit_card_id", "from_timestamp", "internal_account_currency"))


def test_records_of_a_card_give_what_the_joins_give(spark, folder):
    from cardweave.operators.authorisation import card_records, from_records
    from cardweave.operators.cards import GROUP, card_group, card_name, dealt, records_by_group, survey
    requests, stored = odd_tables(spark, folder)
    joined = flow.prepare(requests, stored).drop("__row")
    rows = requests.where("job is not null").withColumn(GROUP, card_group(requests))
    found = survey(rows, F.lit(None).cast("string")).localCheckpoint()
    tables = (stored.settings, stored.balances, stored.totals, stored.linked_accounts)
    records, wide = card_records(*tables)
    assert wide is None and card_records(*tables, limit=5)[1].count() > 0
    met = dealt(rows).join(records_by_group(found, records), GROUP, "left").withColumn(
        "records", F.try_element_at("records", card_name()))
    by_card = from_records(met, flow.OPENING).select(*joined.columns)
    assert by_card.count() > rows.count()
    assert sorted(map(str, by_card.collect())) == sorted(map(str, joined.collect()))


def test_only_what_is_read_moves_through_the_lookups(spark, folder, monkeypatch):
    from cardweave.operators import authorisation
    from cardweave.plans import catalog
    seen = []
    for module in (authorisation, catalog):
        monkeypatch.setattr(module, "written", lambda df: seen.append(df.columns) or df.limit(0))
    catalog.QUERIES["presentment"](spark, folder)
    catalog.QUERIES["authorisation"](spark, folder)
    unread = {"message", "key", "card_token", "provider_transaction_id", "settings", "totals"}
    assert len(seen) == 2 and not any(unread & set(columns) for columns in seen)
