"""Secret scan with an incremental ledger of content-addressed blobs.

A text's address is the SHA-256 of its bytes. The ledger, a folder, remembers
which blobs were scanned by which version of which rule, and what was found.
A scan reads only pairs of blob and rule version that the ledger does not have,
one text a blob, however many rows share it; findings are joined back to all
rows. DataFrame functions alone do the work.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cardweave.llm.store import stored


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has ``least`` characters or more.

    ``hint`` is a cheaper pattern that every text with a match matches too.
    Patterns are those of Java. A new ``version`` makes the ledger scan again.
    """

    kind: str
    pattern: str
    hint: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}/{self.version}"


#: The base rules, in the order in which spans of one start are listed. A run of
#: the characters of ``access`` or ``hex`` that is too short holds no match, so
#: their patterns ask for the least length at once.
BASE_RULES = (
    Rule("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
         r"(?i:passw(?:or)?d|secret|token|api_?key)[\"']?\x20*[:=]", group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", r"AKIA[A-Z0-9]{16}"),
    Rule("hex", r"[0-9a-f]{24,}", r"[0-9a-f]{24}"),
)

#: Further kinds whose form alone gives them away.
MORE_RULES = (
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END (?:[A-Z]+ )*PRIVATE KEY-----",
         r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}", r"xox[abeoprs]-[A-Za-z0-9-]{10}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ[A-Za-z0-9_-]{8}"),
)

RULES = BASE_RULES + MORE_RULES

_SCANNED = "blob string, rules array<string>"
_FOUND = "blob string, rule string, kind string, start long, end long"


def _address(text: str) -> Column:
    return F.sha2(F.coalesce(F.col(text), F.lit("")), 256)


def _read(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """A table of the ledger; empty before the first scan."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
    there = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(schema).parquet(f"{path}/{name}") if there else spark.createDataFrame([], schema)


def _rule_matches(rule: Rule) -> Column:
    """Lengths in code points of all matches, of the text before each, and of the group that counts."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    lengths = lambda values: F.transform(values, lambda x: F.length(x).cast("long"))
    zipped = F.arrays_zip(
        lengths(F.split(text, rule.pattern)).alias("before"),
        lengths(F.regexp_extract_all(text, pattern, F.lit(0))).alias("size"),
        lengths(F.regexp_extract_all(text, pattern, F.lit(rule.group))).alias("counted"))
    found = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.kind).alias("kind"), F.lit(rule.least).alias("least"),
                     zipped.alias("matches"))
    return F.when(F.array_contains("todo", rule.name) & text.rlike(rule.hint), found)


def _findings(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Spans of (blob, text, todo). A match starts after all that stands before it and its predecessors."""
    hints = "|".join(f"(?:{r.hint})" for r in rules)
    # The condition needs ``todo``, so no text is looked at before the ledger has been asked.
    by_rule = (texts.where(F.when(F.size("todo") > 0, F.col("text").rlike(hints)))
               .select("blob", F.explode(F.array_compact(F.array(*map(_rule_matches, rules)))).alias("r"))
               .select("blob", "r.rule", "r.kind", "r.least", F.posexplode("r.matches").alias("at", "m"))
               .where("m.size IS NOT NULL"))
    so_far = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("m.before") + F.col("m.size")).over(so_far)
    return (by_rule.withColumn("end", end).where("m.counted >= least")
            .select("blob", "rule", "kind", (F.col("end") - F.col("m.size")).alias("start"), "end"))


def update_ledger(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, *, doc_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """Scan what the ledger at ``path`` lacks of ``docs``; returns (doc_id, blob) of every row.

    Texts move once, and only those of unseen blobs, keyed by id and address, so
    that copies of a text do not meet in one task. Findings are written before
    the ledger names their blobs; a scan that broke off in between is repeated,
    and readers drop the repeats. Null and empty texts are one blob.
    """
    spark = docs.sparkSession
    versions = stored(docs.select(F.col(doc_id).cast("long").alias("doc_id"), _address(text).alias("blob")))
    seen = (_read(spark, path, "scanned", _SCANNED).groupBy("blob")
            .agg(F.flatten(F.collect_set("rules")).alias("done")))
    todo = F.array_except(F.array(*[F.lit(r.name) for r in rules]), F.coalesce("done", F.array().cast("array<string>")))
    unseen = stored(versions.groupBy("blob").agg(F.min("doc_id").alias("doc_id")).join(seen, "blob", "left")
                    .select("blob", "doc_id", todo.alias("todo")).where("size(todo) > 0"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _address(text).alias("blob"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    wanted = unseen.select(F.col("blob").alias("b"), F.col("doc_id").alias("d"), "todo")
    same = (F.col("blob") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("d"))
    texts = rows.join(wanted, same).select("blob", "text", "todo")
    # Rows that repeat an id and a text are scanned alike; the repeats go here.
    _findings(texts, rules).distinct().write.mode("append").parquet(f"{path}/found")
    unseen.select("blob", F.col("todo").alias("rules")).write.mode("append").parquet(f"{path}/scanned")
    return versions


def spans_by_row(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, spans) of all rows: arrays of (start, place of the rule, kind, end) in this order."""
    places = F.create_map(*[x for k, r in enumerate(rules) for x in (F.lit(r.name), F.lit(k))])
    found = (_read(versions.sparkSession, path, "found", _FOUND).distinct()
             .withColumn("place", places[F.col("rule")]).where("place IS NOT NULL"))
    by_blob = found.groupBy("blob").agg(
        F.array_sort(F.collect_list(F.struct("start", "place", "kind", "end"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>")
    return versions.join(by_blob, "blob", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def secret_report(spans: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts, digest of the base spans, and all spans as text, of every row.

    A row without findings has counts of zero and an empty ``spans``.
    """
    base = F.filter("spans", lambda s: s["place"] < len(BASE_RULES))
    listed = lambda values: F.array_join(
        F.transform(values, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of_place = lambda k: F.size(F.filter("spans", lambda s: s["place"] == k)).cast("long")
    counts = [of_place(k).alias(f"n_{rule.kind}") for k, rule in enumerate(rules[:len(BASE_RULES)])]
    return spans.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"))
