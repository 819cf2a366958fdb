"""Matching and replay of a batch in one ordered pass per card.

A message can only match, or move the position of, messages of its own card: every
match key holds the card, and a transaction belongs to the card that opened it. So
the messages of a card are one array, folded in order; what the fold carries is the
newest transaction per match key and the position of each transaction. Cards with
too many messages for an array, and cards that share a transaction, are told apart
by ``apart``; they need another way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardweave.functions.ledger import (
    NO_TRANSACTION, ORDER_RULES, Names, empty_position, failed, order_ok, position_after, process, type_bit)
from cardweave.functions.tags import tag_sets
from cardweave.operators.ordered import BROADCAST_KEYS, complete_order
from cardweave.operators.replay import history_state
from cardweave.schemas import POSITION, RESULT

CARD_ROWS = 1_000
GROUP = "__group"
# what messages of a card or a transaction mostly have in common
IN_COMMON = (
    "debit_card_id", "card_token", "__message.token", "__message.ret_ref_no_de37", "provider_transaction_id",
    "spend_group", "settlement_currency", "__message.txn_ccy", "__message.proc_code", "__message.pos_time_de12",
    "merchant", "is_balance_enquiry", "is_pin_change", "is_avs_check", "__message.mtid",
    "__message.authorised_by_gps", "type_rank", "transaction_date_time", "settlement_amount")

_STATE = (f"struct<has_history:boolean,last:{POSITION.simpleString()},types:int,seen:array<string>>")


def card_group(rows: DataFrame) -> Column:
    """What is folded together: a card; without one, a process, or the copies of a row."""
    hashable = [f.name for f in rows.schema if not isinstance(f.dataType, T.MapType)]
    return F.coalesce(F.concat(F.lit("c"), "card_token"), F.concat(F.lit("p"), "process_id"),
                      F.concat(F.lit("r"), F.xxhash64(*hashable).cast("string")))


def key_name(tag_set: Column, signature: Column) -> Column:
    """A match key within its card."""
    return F.concat(tag_set.cast("string"), F.lit(" "), signature)


def survey(rows: DataFrame, opened: Column, reached: DataFrame | None = None) -> DataFrame:
    """What has to be known of a batch before its messages move, in one pass over it.

    A row for each card of a group, (group, debit_card_id, n), and for the hash of each
    transaction that more than one group opens or has ``reached`` (group, transaction_id),
    ``__shared``.
    """
    of_group, of_transaction = F.xxhash64(GROUP), F.xxhash64(opened)
    no_text, no_hash = F.lit(None).cast("string"), F.lit(None).cast("long")
    card = F.struct(F.col(GROUP).alias(GROUP), F.col("debit_card_id").alias("debit_card_id"),
                    no_hash.alias("__shared"), no_hash.alias("h"))
    transaction = F.struct(no_text.alias(GROUP), no_text.alias("debit_card_id"),
                           F.when(opened.isNotNull(), of_transaction).alias("__shared"), of_group.alias("h"))
    facts = rows.select(F.explode(F.when(opened.isNotNull(), F.array(card, transaction)).otherwise(
        F.array(card))).alias("f")).select("f.*")
    if reached is not None:
        facts = facts.unionByName(reached.where(F.col("transaction_id").isNotNull()).select(
            no_text.alias(GROUP), no_text.alias("debit_card_id"),
            F.xxhash64("transaction_id").alias("__shared"), of_group.alias("h")))
    return facts.groupBy(GROUP, "debit_card_id", "__shared").agg(
        F.count(F.lit(1)).alias("n"), F.min("h").alias("low"), F.max("h").alias("high")).where(
        F.col(GROUP).isNotNull() | (F.col("low") < F.col("high"))).drop("low", "high")


def apart(found: DataFrame, transactions: DataFrame, limit: int = CARD_ROWS,
          wide: DataFrame | None = None) -> DataFrame:
    """Hashes of groups that the fold cannot take, as ``__apart``, from the ``survey`` of a batch.

    They have over ``limit`` rows, one of their ``transactions`` (group, transaction_id)
    belongs to other groups as well, or they have one of the ``wide`` cards. A group that
    shares its hash with such a one is only sent the other way too.
    """
    cards = found.where(F.col(GROUP).isNotNull())
    of_group = F.xxhash64(GROUP).alias("__apart")
    out = cards.groupBy(GROUP).agg(F.sum("n").alias("n")).where(F.col("n") > limit).select(of_group)
    shared = found.where(F.col("__shared").isNotNull()).select("__shared")
    count = shared.count()
    if count:
        shared = F.broadcast(shared) if count <= BROADCAST_KEYS else shared
        out = out.unionByName(transactions.where(F.col("transaction_id").isNotNull()).join(
            shared, F.xxhash64("transaction_id") == F.col("__shared"), "left_semi").select(of_group))
    if wide is not None:
        out = out.unionByName(cards.join(
            wide, cards["debit_card_id"].eqNullSafe(wide["debit_card_id"]), "left_semi").select(of_group))
    return out.distinct()


def dealt(rows: DataFrame) -> DataFrame:
    """``rows`` moved by group, once: collecting never shrinks rows, so they are moved before.

    Flat columns take less room in a shuffle than nested ones, and what rows of a card have
    in common takes less when it comes first.
    """
    nested = {f.name: f.dataType.names for f in rows.schema if isinstance(f.dataType, T.StructType)}
    flat = {c: F.col(c) for c in rows.columns if c not in nested}
    for name, fields in nested.items():
        flat[f"__{name}"] = F.col(name).isNotNull()
        flat |= {f"__{name}.{field}": F.col(name)[field] for field in fields}
    first = [c for c in (GROUP, *IN_COMMON) if c in flat]
    moved = rows.select(*[flat[c].alias(c) for c in [*first, *[c for c in flat if c not in first]]]).repartition(GROUP)
    back = {name: F.when(F.col(f"__{name}"), F.struct(*[F.col(f"`__{name}.{field}`").alias(field) for field in fields]))
            for name, fields in nested.items()}
    return moved.select(*[back.get(c, F.col(c)).alias(c) for c in rows.columns])


def card_name() -> Column:
    """The row's card as a key of its group's records; a card may be null."""
    return F.coalesce(F.concat(F.lit("c"), "debit_card_id"), F.lit("-"))


def records_by_group(found: DataFrame, records: DataFrame) -> DataFrame:
    """(group, records): a map from ``card_name`` to what is stored of each card the group has."""
    cards = found.where(F.col(GROUP).isNotNull()).select(GROUP, "debit_card_id")
    known = cards.join(records, "debit_card_id")
    # at most one row, so that no join has a key that stands for none
    unnamed = records.where(F.col("debit_card_id").isNull()).select("records")
    none = cards.where(F.col("debit_card_id").isNull()).crossJoin(F.broadcast(unnamed))
    return known.select(GROUP, "debit_card_id", "records").unionByName(none).groupBy(GROUP).agg(
        F.map_from_entries(F.collect_list(F.struct(card_name(), "records"))).alias("records"))


def start_offers(newest: DataFrame) -> DataFrame:
    """(group, offers): the stored transaction under each match key of a card."""
    return newest.where(F.col("__stored_id").isNotNull()).groupBy(
        F.concat(F.lit("c"), "card_token").alias(GROUP)).agg(F.map_from_entries(F.collect_list(
            F.struct(key_name(F.col("tag_set"), F.col("signature")), "__stored_id"))).alias("__offers"))


def start_states(rows: DataFrame, transactions: DataFrame, history: DataFrame,
                 recorded: Sequence[str]) -> DataFrame:
    """(group, states): the stored position of each transaction a group can reach.

    Of the stored message ids only those are kept that the group's own messages have.
    """
    ids = rows.select(GROUP, "provider_message_id").where(F.col("provider_message_id").isNotNull()).distinct()
    reached = transactions.where(F.col("transaction_id").isNotNull()).distinct()
    seen = history.select("transaction_id", "provider_message_id").distinct().join(
        reached, "transaction_id").join(ids, [GROUP, "provider_message_id"], "left_semi").groupBy(
        GROUP, "transaction_id").agg(F.collect_list("provider_message_id").alias("__seen"))
    found = reached.join(history_state(history, recorded), "transaction_id").join(
        seen, [GROUP, "transaction_id"], "left")
    state = F.struct("state.has_history", "state.last", "state.types", F.coalesce(
        "__seen", F.array().cast("array<string>")).alias("seen")).cast(_STATE)
    return found.groupBy(GROUP).agg(F.map_from_entries(F.collect_list(
        F.struct("transaction_id", state))).alias("__states"))


def _fold(rules: dict[str, tuple[str, ...]], without_match: Sequence[str]) -> Column:
    """Fold ``messages`` from ``__offers`` and ``__states``; a transaction and a result per message."""
    result = process(Names(
        message="m.row", last="s.last", has_history="s.has_history",
        is_duplicate="coalesce(array_contains(s.seen, m.row.provider_message_id), false)",
        order_ok=order_ok("m.row.message_type", "s.types", rules)))
    own = ", ".join(f"'{job}'" for job in without_match)
    fresh = (f"cast(named_struct('has_history', false, 'last', {empty_position()}, 'types', 0,"
             f" 'seen', array()) as {_STATE})")
    matched = """array_min(filter(transform(m.keys, k -> named_struct(
        'priority', k.priority, 'id', try_element_at(acc.offers, k.name))), h -> h.id is not null)).id"""
    transaction = f"""coalesce(if(m.row.__asks, nullif({matched}, ''), null),
        case when m.row.job in ({own}) then m.row.process_id end)"""
    after = f"""cast(named_struct(
        'has_history', true, 'last', {position_after("r")}, 'types', s.types | {type_bit("m.row.message_type")},
        'seen', if(m.row.provider_message_id is null, s.seen, array_append(s.seen, m.row.provider_message_id)))
        as {_STATE})"""
    results = f"array<struct<transaction_id:string,r:{RESULT.simpleString()}>>"
    return F.expr(f"""
        aggregate(
          messages,
          named_struct('offers', __offers, 'states', __states, 'results', cast(array() as {results})),
          (acc, m) -> element_at(transform(array({transaction}), t ->
            element_at(transform(array(coalesce(try_element_at(acc.states, t), {fresh})), s ->
              element_at(transform(array(if(t is null, {failed(NO_TRANSACTION)}, {result})), r -> named_struct(
                'offers', if(t is null or r.error is not null, acc.offers, map_concat(
                    map_filter(acc.offers, (k, v) -> not array_contains(m.names, k)),
                    map_from_arrays(m.names, transform(m.names, n -> t)))),
                'states', if(t is null or r.error is not null, acc.states, map_concat(
                    map_filter(acc.states, (k, v) -> k <> t), map(t, {after}))),
                'results', array_append(acc.results, named_struct('transaction_id', t, 'r', r)))), 1)), 1)), 1),
          acc -> acc.results)""")


def fold_cards(rows: DataFrame, order: Sequence[str], without_match: Sequence[str],
               offers: DataFrame | None = None, states: DataFrame | None = None,
               rules: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One row per message: its columns, its ``transaction_id`` and the ``RESULT`` columns.

    ``rows`` have ``__group``, by which they are ``dealt``, and ``__asks`` (false: matches
    nothing). Rows that ``order`` leaves equal follow each other by their other columns.
    """
    rules = ORDER_RULES if rules is None else rules
    passed = [c for c in rows.columns if c not in (GROUP, "__asks")]
    order = complete_order(rows, [GROUP], order)
    rest = [c for c in rows.columns if c not in (GROUP, *order)]
    groups = rows.groupBy(GROUP).agg(
        F.sort_array(F.collect_list(F.struct(*order, *rest))).alias("messages"))
    for name, found, kind in (("__offers", offers, "map<string,string>"),
                              ("__states", states, f"map<string,{_STATE}>")):
        empty = F.expr(f"cast(map() as {kind})")
        groups = (groups.withColumn(name, empty) if found is None
                  else groups.join(found, GROUP, "left").withColumn(name, F.coalesce(name, empty)))

    def keyed(m: Column) -> Column:
        whole = F.filter(tag_sets(m["message"]), lambda t: t["signature"].isNotNull() & m["card_token"].isNotNull())
        return F.struct(m.alias("row"), F.transform(whole, lambda t: F.struct(
            t["priority"].alias("priority"), key_name(t["tag_set"], t["signature"]).alias("name"))).alias("keys"))

    def named(m: Column) -> Column:
        return F.struct(m["row"].alias("row"), m["keys"].alias("keys"), m["keys"]["name"].alias("names"))

    folded = groups.withColumn("messages", F.transform(F.transform("messages", keyed), named)).select(
        "messages", _fold(rules, without_match).alias("results"))
    both = folded.select(F.explode(F.arrays_zip(
        F.col("messages").alias("m"), F.col("results").alias("r"))).alias("z"))
    return both.select(*[F.col(f"z.m.row.{c}").alias(c) for c in passed],
                       F.col("z.r.transaction_id").alias("transaction_id"),
                       *[F.col(f"z.r.r.{c}").alias(c) for c in RESULT.names])
