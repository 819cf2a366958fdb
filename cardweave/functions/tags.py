"""Tag sets that identify a transaction, and tags put on commands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Request fields of each tag set, numbered in stored order.
TAG_SETS: dict[int, tuple[str, ...]] = {
    1: ("traceid_lifecycle",),
    2: ("trans_link",),
    3: ("traceid_lifecycle", "trans_link", "auth_code_de38"),
    4: ("trans_link", "auth_code_de38"),
    5: ("traceid_lifecycle", "auth_code_de38"),
    6: ("traceid_lifecycle", "trans_link"),
    7: ("acquirer_reference_data_031", "txn_ccy", "auth_code_de38", "pos_time_de12",
        "ret_ref_no_de37"),
    8: ("acquirer_reference_data_031", "auth_code_de38", "trans_link"),
}

# which tag set wins when several match: most tags first
MATCH_PRIORITY = (7, 3, 8, 4, 5, 6, 1, 2)

# Command tag name and the request field it carries.
REQUEST_TAGS = (
    ("auth_code_de38", "auth_code_de38"),
    ("ret_ref_no_de37", "ret_ref_no_de37"),
    ("trans_link", "trans_link"),
    ("txn_id", "txn_id"),
    ("txn_type", "txn_type"),
    ("message_type_id", "mtid"),
    ("processing_code", "proc_code"),
)


def signature(message: Column, names: tuple[str, ...]) -> Column:
    """The tag values as one text, null when one is missing.

    Each value follows its own length, so no two value lists give the same text.
    """
    return F.concat(*[
        part for n in names
        for part in (F.length(message[n]).cast("string"), F.lit(":"), message[n])])


def tag_sets(message: Column) -> Column:
    """Array of (tag_set, priority, signature); explode it and drop null signatures."""
    return F.array(*[
        F.struct(F.lit(number).alias("tag_set"),
                 F.lit(MATCH_PRIORITY.index(number)).alias("priority"),
                 signature(message, names).alias("signature"))
        for number, names in TAG_SETS.items()])


def tags_of(message: Column, tag_set: Column) -> Column:
    """Map of the tags that make up one tag set."""
    out = F.lit(None).cast("map<string,string>")
    for number, names in TAG_SETS.items():
        pairs = [x for n in names for x in (F.lit(n), message[n])]
        out = F.when(tag_set == number, F.create_map(*pairs)).otherwise(out)
    return out


def accounting_tags(process_id: Column, transaction_id: Column, message_type: Column,
                    request: Column) -> Column:
    """Ordered key/value list; the type and request groups drop out when absent."""
    def pair(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))

    none = F.array().cast("array<struct<key:string,value:string>>")
    ids = F.array(pair("transaction_id", transaction_id), pair("process_id", process_id))
    kind = F.when(message_type.isNotNull(), F.array(pair("message_type", message_type))).otherwise(none)
    details = F.when(request.isNotNull(), F.array(
        *[pair(tag, request[field]) for tag, field in REQUEST_TAGS])).otherwise(none)
    return F.concat(ids, kind, details)
