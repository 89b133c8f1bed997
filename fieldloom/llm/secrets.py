"""Secret scans with an incremental ledger of blobs, in DataFrame functions only.

A blob is the SHA-256 of a version's text. The ledger holds, for each blob and scan, the rules used (name
and version) and the spans found. A scan takes only the blobs that lack some rule, runs only the lacking
rules on one version of each, appends to the ledger, and joins the findings back to every path that has
the blob. A text that is repeated a thousand times, or that a former scan has seen, is searched once.

Positions come from the pieces between the matches: a text is split by the pattern and its matches are
extracted by the same pattern, so running sums over the lengths of both give every start and end in code points. Sums,
and the cuts of masking, run over pieces of ``PIECE`` entries, so time grows with the matches and not with their square;
no pattern rescans a run of its own characters from every place in it.

Cases: NULL text is the empty blob; a NULL or repeated path is a path like any other, row by row; an empty
table gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.session import checkpoint_root

#: Copies of a blob's findings in the last join, so that a blob under very many paths is dealt to as many tasks.
SALTS = 16
#: Entries that one running sum or one cut text serves.
PIECE = 256
#: Session setting that names the ledger's folder; without it a run has a ledger of its own.
LEDGER_SETTING = "spark.fieldloom.secrets.ledger"
SPAN = "struct<start:int,rank:int,kind:string,end:int>"


def any_case(words: str) -> str:
    """``words`` with each ASCII letter in either case; the classes mean the same to every regex engine."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isascii() and c.isalpha() else c for c in words)


@dataclass(frozen=True)
class Rule:
    """``kept`` is the group whose length must reach ``least``; shorter matches are dropped after matching.

    With ``led`` the match begins with what must stand before the secret, and the secret is the group ``kept``, up to its end.
    """

    kind: str
    pattern: str
    least: int = 0
    kept: int = 0
    led: bool = False

    @property
    def version(self) -> str:
        return f"{self.kind}@{hashlib.md5(repr((self.pattern, self.least, self.kept, self.led)).encode()).hexdigest()[:12]}"


# The base kinds, in the order in which they are listed.
BASE = (
    Rule("assign", "(" + "|".join(map(any_case, ("password", "passwd", "secret", "token", "api_?key")))
         + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Kinds that this method adds; public token formats.
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"(?:^|[^A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", kept=1, led=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)


def _with(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _pieces(a: Column) -> Column:
    """The array in arrays of ``PIECE`` entries."""
    return F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(a) - 1, F.lit(0)) / PIECE).cast("int")), lambda k: F.slice(a, k * PIECE + 1, F.lit(PIECE)))


def running(a: Column, combine, levels: int = 1) -> Column:
    """For each whole number of an array what ``combine`` makes of 0 and all before it, piece by piece, and so for the pieces' totals."""
    total = lambda c: F.aggregate(c, F.lit(0), combine)

    def inside(c, start):
        begin = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
        step = lambda acc, x: F.struct(combine(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(c, begin, step, lambda acc: acc["out"])

    if not levels:
        return inside(a, F.lit(0))
    return _with(_pieces(a), lambda pieces: F.flatten(F.zip_with(pieces, running(F.transform(pieces, total), combine, levels - 1), inside)))


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """array<struct<start, rank, kind, end>> of the leftmost non-overlapping matches, positions in code points."""
    whole = F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), F.lit(1))
    kept = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.kept)) if rule.kept else whole
    rows = F.transform(F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), whole.alias("hit"), kept.alias("kept")),
                       lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), F.length(x["kept"]).alias("kept")))

    def placed(lengths):
        before = running(F.transform(lengths, lambda x: x["gap"] + F.coalesce(x["hit"], F.lit(0))), lambda a, b: a + b)
        entries = F.zip_with(lengths, before, lambda x, at: F.struct((at + x["gap"]).alias("at"), x["hit"].alias("hit"), x["kept"].alias("kept")))
        good = F.filter(entries, lambda x: x["hit"].isNotNull() & (x["kept"] >= rule.least))
        lead = (lambda x: x["hit"] - x["kept"]) if rule.led else (lambda x: F.lit(0))
        return F.transform(good, lambda x: F.struct((x["at"] + lead(x)).alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), (x["at"] + x["hit"]).alias("end")))

    return F.when(text.rlike(rule.pattern), _with(rows, placed)).otherwise(F.lit([]).cast(f"array<{SPAN}>"))


class BlobLedger:
    """Findings by blob under ``path``, one Parquet append for each scan that saw something new."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        """blob, rules scanned, spans found; a blob has one row for each scan that added to it."""
        schema = f"blob binary, rules array<string>, spans array<{SPAN}>"
        where = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        there = where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where)
        return self.spark.read.schema(schema).parquet(self.path) if there else self.spark.createDataFrame([], schema)

    def scan(self, versions: DataFrame, rules: Sequence[Rule] = BASE + ADDED) -> None:
        """Scan what is unseen of ``versions`` (path, text)."""
        names = F.array(*[F.lit(r.version) for r in rules])
        blobs = versions.select("path", blob_of("text").alias("blob"))
        seen = self.rows().groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
        lacking = (
            blobs.groupBy("blob").agg(F.min("path").alias("path")).join(seen, "blob", "left")
            .withColumn("lacking", F.array_except(names, F.coalesce("seen", F.array().cast("array<string>"))))
            .where(F.size("lacking") > 0).select("blob", F.col("path").alias("first_path"), "lacking")
        )
        texts = versions.select("path", F.coalesce("text", F.lit("")).alias("text"), blob_of("text").alias("blob"))
        one = texts.join(lacking.withColumnRenamed("blob", "b"), (F.col("blob") == F.col("b")) & F.col("path").eqNullSafe(F.col("first_path")))
        found = F.concat(*[F.when(F.array_contains("lacking", r.version), spans(F.col("text"), r, k)).otherwise(F.lit([]).cast(f"array<{SPAN}>"))
                           for k, r in enumerate(rules)])
        rows = one.select("blob", F.col("lacking").alias("rules"), found.alias("spans"))
        rows.dropDuplicates(["blob"]).write.mode("append").parquet(self.path)

    def found(self, rules: Sequence[Rule] = BASE + ADDED) -> DataFrame:
        """blob, salt, spans of ``rules`` by start, then kind as listed: each blob with findings under every salt."""
        kinds = [r.kind for r in rules]
        ordered = F.array_sort(F.flatten(F.collect_list("spans")))
        known = self.rows().where(F.size("spans") > 0).groupBy("blob").agg(ordered.alias("spans"))
        # A span that two scans have found stands twice, side by side.
        own = F.filter("spans", lambda s, i: s["kind"].isin(kinds) & ~F.coalesce(F.get("spans", i - 1) == s, F.lit(False)))
        return known.withColumn("spans", own).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))

    def findings(self, versions: DataFrame, rules: Sequence[Rule] = BASE + ADDED) -> DataFrame:
        """Every row of ``versions`` (path, text) as path, blob, spans."""
        paths = versions.select("path", blob_of("text").alias("blob"), salt_of("path").alias("salt"))
        return paths.join(self.found(rules), ["blob", "salt"], "left").select("path", "blob", F.coalesce("spans", no_spans()).alias("spans"))


def no_spans() -> Column:
    return F.lit([]).cast(f"array<{SPAN}>")


def salt_of(path: str) -> Column:
    return F.pmod(F.xxhash64(path), F.lit(SALTS)).cast("int")


def blob_of(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def scan_secrets(versions: DataFrame, ledger_path: str, rules: Sequence[Rule] = BASE + ADDED) -> DataFrame:
    """Scan ``versions`` (path, text) and return path, blob, spans for every row."""
    ledger = BlobLedger(versions.sparkSession, ledger_path)
    ledger.scan(versions, rules)
    return ledger.findings(versions, rules)


def redact(text: Column, found: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with each maximal run of overlapping spans replaced by ``mask``; ``found`` is ordered by start."""

    def cut(runs):
        """The parts of the text between the runs: of each piece of the list first the text it lies in, then its parts."""
        ends = F.concat(runs, F.array(F.struct(F.array_max(F.transform(found, lambda s: s["end"])).alias("from"), F.length(text).alias("to"))))
        region = lambda c: F.substr(text, c[0]["from"] + 1, F.element_at(c, -1)["to"] - c[0]["from"])
        parts = lambda c: _with(region(c), lambda r: F.transform(c, lambda x: F.substr(r, x["from"] - c[0]["from"] + 1, x["to"] - x["from"])))
        return F.array_join(F.flatten(F.transform(_pieces(ends), parts)), mask)

    # A run begins at a span that starts where all before it have ended; what is kept before it lies between.
    before = running(F.transform(found, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    gaps = F.zip_with(found, before, lambda s, at: F.struct(at.alias("from"), s["start"].alias("to")))
    return F.when(F.size(found) == 0, text).otherwise(_with(F.filter(gaps, lambda g: g["to"] >= g["from"]), cut))


def ledger_path(spark: SparkSession) -> str:
    """The ledger that the session names, for scans that go on from former ones; else a new one in the shared folder."""
    return spark.conf.get(LEDGER_SETTING, None) or f"{checkpoint_root(spark)}/ledger-{uuid.uuid4().hex}"


def masked(docs: DataFrame, ledger_path: str, rules: Sequence[Rule] = BASE + ADDED) -> DataFrame:
    """``docs`` with the secrets in ``text`` masked and ``n_chars``, where there is one, brought up to date; all rows stay."""
    ledger = BlobLedger(docs.sparkSession, ledger_path)
    ledger.scan(docs.select(F.col("doc_id").alias("path"), "text"), rules)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), blob_of("text").alias("blob"), salt_of("doc_id").alias("salt"))
    rows = rows.join(ledger.found(rules), ["blob", "salt"], "left")
    rows = rows.withColumn("clean", redact(F.col("row.text"), F.coalesce("spans", no_spans())))
    new = {"text": F.col("clean"), "n_chars": F.when(F.col("spans").isNull(), F.col("row.n_chars") if "n_chars" in docs.columns else F.lit(None)).otherwise(F.length("clean"))}
    return rows.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])
