"""Secrets in texts by an incremental ledger of blobs, in DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its text, its blob. The ledger remembers which blob was scanned
under which version of which rule, and what was found. A scan looks only at pairs of blob and rule version that the
ledger lacks, each blob once whatever the number of its paths, adds them to the ledger, and joins what is known about
each blob back to all its paths.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftlake.workspace import Scratch, new_path


@dataclass(frozen=True)
class Rule:
    """What a kind of secret looks like. Matches are leftmost and do not overlap; of those, a finding has at least
    ``min_length`` characters in ``group``. ``hint`` is an expression of the column ``text`` that holds for every text
    with a match and is cheap to test."""

    kind: str
    version: int
    pattern: str
    group: int
    min_length: int
    hint: str = "true"

    @property
    def key(self) -> str:
        return f"{self.kind}:{self.version}"


# The base patterns. Runs of hexadecimal digits shorter than asked for would be dropped anyway, and so would
# short access keys: both patterns ask for the length at once.
BASE_RULES = (
    Rule(
        "assign", 1,
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", 0, 18, "contains(text, 'AKIA')"),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),
)
# Beyond the base: the first line of a private key.
RULES = (
    *BASE_RULES,
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, "contains(text, 'PRIVATE KEY')"),
)

_SPANS = "array<struct<start:int,kind_number:int,kind:string,end:int,version:int>>"
# A list that grows is copied with each match, so that matches are placed in runs of so many, and the runs after that.
RUN = 256
_FINDINGS = f"blob string, rules array<string>, spans {_SPANS}"


def _matches(rule: Rule) -> tuple[Column, Column]:
    """All matches of a rule that is due, and the lengths of the texts between them."""
    due = F.array_contains("rules", rule.key) & F.expr(rule.hint) & F.col("text").rlike(rule.pattern)
    found = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
    gaps = F.transform(F.split("text", rule.pattern, -1), lambda gap: F.length(gap))
    nothing = F.array().cast("array<string>"), F.array().cast("array<int>")
    return F.when(due, found).otherwise(nothing[0]), F.when(due, gaps).otherwise(nothing[1])


def _items(found: Column, gaps: Column, rule: Rule) -> Column:
    """For each match the text before it, its own length, and the length that the rule asks for."""
    lengths = F.transform(found, lambda match: F.length(match))
    judged = F.transform(found, lambda match: F.length(F.regexp_extract(match, rule.pattern, rule.group)))
    return F.arrays_zip(
        F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), lengths.alias("length"), judged.alias("judged")
    )


def _spans(items: Column, rule: Rule, number: int) -> Column:
    """Where the matches lie, in code points: the texts between them and the matches themselves, added up."""
    empty = F.array().cast("array<struct<start:int,end:int,judged:int>>")

    def add(state: Column, item: Column) -> Column:
        start = state["at"] + item["gap"]
        end = start + item["length"]
        span = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), item["judged"].alias("judged"))
        return F.struct(end.cast("int").alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    def follow(state: Column, length: Column) -> Column:
        begin = F.concat(state["begins"], F.array(state["at"]))
        return F.struct((state["at"] + length).cast("int").alias("at"), begin.alias("begins"))

    firsts = F.when(F.size(items) > 0, F.sequence(F.lit(1), F.size(items), F.lit(RUN))).otherwise(F.array().cast("array<int>"))
    runs = F.transform(firsts, lambda first: F.slice(items, first, F.lit(RUN)))
    taken = F.transform(runs, lambda run: F.aggregate(run, F.lit(0), lambda sum_, i: sum_ + i["gap"] + i["length"]))
    first_step = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins"))
    begins = F.aggregate(taken, first_step, follow, lambda state: state["begins"])

    def place(run: Column, begin: Column) -> Column:
        return F.aggregate(run, F.struct(begin.alias("at"), empty.alias("spans")), add, lambda state: state["spans"])

    placed = F.flatten(F.zip_with(runs, begins, place))
    kept = F.filter(placed, lambda span: span["judged"] >= rule.min_length)
    return F.transform(
        kept,
        lambda span: F.struct(
            span["start"].alias("start"), F.lit(number).alias("kind_number"), F.lit(rule.kind).alias("kind"),
            span["end"].alias("end"), F.lit(rule.version).alias("version"),
        ),
    )


def _scanned(due: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``blob, rules, spans`` under the rules that are due. Matches and items are columns of their own: what follows looks at
    them more than once."""
    found, items = {}, {}
    for number, rule in enumerate(rules):
        found[f"found_{number}"], found[f"gaps_{number}"] = _matches(rule)
        items[f"items_{number}"] = _items(F.col(f"found_{number}"), F.col(f"gaps_{number}"), rule)
    spans = [_spans(F.col(f"items_{number}"), rule, number) for number, rule in enumerate(rules)]
    placed = due.select("blob", "rules", *(c.alias(n) for n, c in found.items()))
    placed = placed.select("blob", "rules", *(c.alias(n) for n, c in items.items()))
    return placed.select("blob", "rules", F.concat(*spans).alias("spans"))


class Ledger:
    """The rows ``blob, rules, spans`` of all scans so far, below one path; each scan adds a folder of its own."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path or new_path(spark, "ledger")

    def rows(self) -> DataFrame:
        """Everything scanned so far; no rows before the first scan."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], _FINDINGS)
        return self.spark.read.schema(_FINDINGS).parquet(self.path)

    def add(self, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(self.path)


def with_blob(versions: DataFrame) -> DataFrame:
    """``versions`` with the address of its text; a null text is an empty one."""
    return versions.withColumn("blob", F.sha2(F.coalesce("text", F.lit("")), 256))


def unseen(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``blob, text, rules``: each blob that some rule version has not seen, once, and the rule versions due.

    Copies are merged within each task before anything moves.
    """
    blobs = with_blob(versions.select(F.coalesce("text", F.lit("")).alias("text"))).groupBy("blob")
    blobs = blobs.agg(F.first("text").alias("text"))
    wanted = F.array(*(F.lit(rule.key) for rule in rules))
    seen = ledger.rows().groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
    due = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", "text", due.alias("rules")).where("size(rules) > 0")


def scan(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> int:
    """Scan what the ledger has not seen and add it; how many blobs that were."""
    scratch = Scratch(versions.sparkSession, "scan")
    due = unseen(versions, ledger, rules)
    found = scratch.settle(_scanned(due, rules), "found")
    count = found.count()
    if count:
        ledger.add(found)
    scratch.close()
    return count


def findings(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``versions`` without its text, with the ``spans`` known of its blob under these rule versions, by start and then
    by rule. What an earlier version of a rule found counts no longer, and what two scans at once found counts once. Only blobs with findings are joined; copies of one blob may be very many."""
    current = F.array(*(F.lit(rule.key) for rule in rules))
    known = ledger.rows().where(F.arrays_overlap("rules", current) & (F.size("spans") > 0))
    known = known.groupBy("blob").agg(F.flatten(F.collect_set("spans")).alias("spans"))
    key = lambda span: F.concat_ws(":", span["kind"], span["version"].cast("string"))
    spans = F.filter("spans", lambda span: F.array_contains(current, key(span)))
    by_rule = F.transform(
        spans,
        lambda span: F.struct(
            span["start"].alias("start"), F.array_position(current, key(span)).cast("int").alias("kind_number"),
            span["kind"].alias("kind"), span["end"].alias("end"), span["version"].alias("version"),
        ),
    )
    known = known.withColumn("spans", F.sort_array(by_rule))
    known = known.withColumn("spans", F.filter("spans", lambda span, i: (i == 0) | (F.get("spans", i - 1) != span)))
    versions = with_blob(versions).drop("text", "spans")
    return versions.join(known, "blob", "left").withColumn("spans", F.coalesce("spans", F.array().cast(_SPANS)))


def digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of findings, the spans as ``kind:start:end`` texts."""
    base = [rule.kind for rule in BASE_RULES]

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base]
    return found.select(
        "doc_id", *counts, F.sha2(joined(of(*base)), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def scan_documents(docs: DataFrame, ledger_path: str | None = None) -> DataFrame:
    """The digest of every row of ``docs`` (``doc_id, text``; other columns are left out), by a scan of what the ledger at this path has
    not seen; a new ledger without a path.

    Null and empty texts have no finding. Rows that repeat an id or a text are reported one by one, and a text is scanned
    once. An empty table gives no rows.
    """
    versions = docs.select("doc_id", "text")
    ledger = Ledger(docs.sparkSession, ledger_path)
    scan(versions, ledger)
    return digest(findings(versions, ledger))
