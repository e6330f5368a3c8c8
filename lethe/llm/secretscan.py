"""Secret scans with an incremental blob ledger, on DataFrame functions only.

Every version of a text is addressed by its SHA-256. The ledger, two tables in a shared
folder, holds which rule versions a blob was scanned with and what was found; a run scans
only the (blob, rule version) pairs it does not hold, one representative of each blob, and
findings are joined back to all paths with that content. Findings are written before the
marks, and read without repeats, so a run that dies half-way is safely run again.

A pattern's matches and the pieces between them give all positions by sums of lengths:
code points, end exclusive. No text is shuffled more than once, and only hashes
are grouped, so copies in any number are one row in each task.

Nulls and ties: a null text is the empty blob, without findings; a null id is a path like
others; repeated rows each get a result. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lethe.llm.common import stored


@dataclass(frozen=True)
class Rule:
    """A pattern; matches count if the value group has ``least`` characters. ``needs``: a text without any of these cannot match."""

    kind: str
    pattern: str
    least: int = 1
    group: int = 0
    needs: tuple[str, ...] = ()
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: The first three kinds, their order and patterns.
BASE = (
    Rule(
        "assign",
        "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        8, 2, (":", "="),
    ),
    Rule("access", "AKIA[A-Z0-9]+", 16, 0, ("AKIA",)),
    Rule("hex", "[0-9a-f]{32,}", 32),
)
EXTRA = (
    # Bounded, since the engine recurses over a repeated group: an open one overflows its stack on a text of some KB.
    Rule("private_key", "-----BEGIN (?:[A-Z]{1,20} ){0,4}PRIVATE KEY-----", needs=("PRIVATE KEY",), version=2),
    Rule("json_token", "eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}", needs=("eyJ",)),
    Rule("host_token", "gh[pousr]_[A-Za-z0-9]{36,}", needs=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("url_login", "://[^\\s:/@]+:[^\\s:/@]+@", needs=("://",)),
)
RULES = BASE + EXTRA
_FINDINGS = "sha string, rule string, kind string, start long, stop long"
_MARKS = "sha string, rules array<string>"


class Ledger:
    """The two tables under ``path``; either may not exist yet."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _read(self, name: str, schema: str) -> DataFrame:
        # A table that has not been written is an empty one.
        columns = (part.strip().split(" ", 1) for part in schema.split(","))
        empty = self.spark.range(0).select(*(F.lit(None).cast(kind).alias(column) for column, kind in columns))
        empty.write.mode("append").parquet(f"{self.path}/{name}")
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def marks(self) -> DataFrame:
        return self._read("marks", _MARKS)

    def findings(self) -> DataFrame:
        return self._read("findings", _FINDINGS).distinct()

    def append(self, name: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self.path}/{name}")


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _sha() -> Column:
    return F.sha2(_text(), 256)


def _matches(rule: Rule) -> Column:
    """An array with a row for each match: characters since the last one, its own, and those of its value."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    possible = F.lit(not rule.needs)
    for word in rule.needs:
        possible = possible | F.contains(text, F.lit(word))
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    rows = F.zip_with(
        found, F.slice(F.split(text, rule.pattern, -1), F.lit(1), F.size(found)),
        lambda m, before: F.struct(
            F.char_length(before).cast("long").alias("before"), F.char_length(m).cast("long").alias("own"),
            F.char_length(F.regexp_extract(m, rule.pattern, rule.group)).cast("long").alias("value")))
    return F.when(F.array_contains("pending", rule.key) & possible & text.rlike(rule.pattern), rows)


def _scan(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings of blobs (sha, text, pending)."""
    each = F.explode(F.array(*(
        F.struct(F.lit(r.key).alias("rule"), F.lit(r.kind).alias("kind"), F.lit(r.least).alias("least"), _matches(r).alias("found")) for r in rules)))
    matches = blobs.select("sha", each.alias("r")).where(F.size("r.found") > 0).select(
        "sha", "r.rule", "r.kind", "r.least", F.posexplode("r.found").alias("i", "m"))
    # Two rows alike in id and text are scanned twice: one finding stays.
    once = matches.repartition("sha").dropDuplicates(["sha", "rule", "i"])
    order = Window.partitionBy("sha", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("m.before") + F.col("m.own")).over(order)
    placed = once.withColumn("stop", stop).where(F.col("m.value") >= F.col("least"))
    return placed.select("sha", "rule", "kind", (F.col("stop") - F.col("m.own")).alias("start"), "stop")


def update(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> int:
    """Scan what the ledger does not hold and append it; the number of blobs that were scanned."""
    keys = F.array(*(F.lit(r.key) for r in rules))
    held = ledger.marks().groupBy("sha").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("held"))
    # Only hashes and ids are grouped; a partial minimum makes a hot blob one row in each task.
    blobs = docs.select("doc_id", _sha().alias("sha")).groupBy("sha").agg(F.min("doc_id").alias("doc_id"))
    pending = blobs.join(held, "sha", "left").withColumn(
        "pending", F.array_except(keys, F.coalesce("held", F.array().cast("array<string>")))
    ).where(F.size("pending") > 0).select("sha", "doc_id", "pending")
    # Three steps use it, and the ledger grows between them.
    todo = stored(pending, "pending")
    texts = docs.select("doc_id", _text().alias("text")).alias("d").join(
        todo.alias("t"), F.col("d.doc_id").eqNullSafe(F.col("t.doc_id"))
    ).where(F.sha2("text", 256) == F.col("sha")).select("sha", "text", "pending")
    ledger.append("findings", _scan(texts, rules))
    ledger.append("marks", todo.select("sha", F.col("pending").alias("rules")))
    return todo.count()


def findings(docs: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, sha and ``found``, the spans (start, place of the rule, stop, kind) in order, of every row."""
    number = F.create_map(*(x for k, r in enumerate(rules) for x in (F.lit(r.key), F.lit(k))))
    own = ledger.findings().where(F.col("rule").isin([r.key for r in rules]))
    spans = own.groupBy("sha").agg(F.array_sort(F.collect_list(
        F.struct("start", F.element_at(number, F.col("rule")).alias("place"), "stop", "kind"))).alias("found"))
    return docs.select("doc_id", _sha().alias("sha")).join(spans, "sha", "left").select("doc_id", "sha", "found")


def digests(found: DataFrame, base: tuple[Rule, ...] = BASE) -> DataFrame:
    """n_assign and so on, base_sha256 over the base kinds, and all spans."""
    spans = F.coalesce("found", F.array().cast("array<struct<start:bigint,place:int,stop:bigint,kind:string>>"))
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
    joined = lambda rows: F.array_join(F.transform(rows, text), ",")
    kinds = [r.kind for r in base]
    of = lambda kind: lambda s: s["kind"] == kind
    return found.select(
        "doc_id",
        *(F.size(F.filter(spans, of(k))).cast("long").alias(f"n_{k}") for k in kinds),
        F.sha2(joined(F.filter(spans, lambda s: s["kind"].isin(kinds))), 256).alias("base_sha256"),
        joined(spans).alias("spans"),
    )
