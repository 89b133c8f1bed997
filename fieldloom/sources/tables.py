"""Scans with contract checks, checksums and provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fieldloom.sources.contracts import Contract, ContractError


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256, header) of every file under ``path``, each digested by the task that reads it; ``header`` is its first line.

    One file is one value here, so a raw table comes as many files, each below 2 GB.
    """
    first = F.regexp_extract(F.decode(F.substring("content", 1, 65536), "UTF-8"), r"^[^\r\n]*", 0)
    return spark.read.format("binaryFile").load(path).select(
        F.col("path"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), first.alias("header"))


def dataset_digest(digests: DataFrame) -> DataFrame:
    """(files, bytes, sha256, headers): of one file its own digest, of several the digest of theirs in ascending order; and how many first lines differ."""
    every = F.array_sort(F.collect_list("sha256"))
    return digests.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), every.alias("_all"), F.count_distinct("header").alias("headers")).select(
        "files", "bytes", F.when(F.size("_all") == 1, F.col("_all")[0]).otherwise(F.sha2(F.array_join("_all", ""), 256)).alias("sha256"), "headers")


def scan_csv(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """Typed scan; text may hold quoted line breaks and doubled quotes."""
    return (
        spark.read.schema(contract.schema).option("header", True).option("multiLine", True).option("quote", '"')
        .option("escape", '"').option("enforceSchema", True).option("mode", "FAILFAST").csv(path))


def malformed_rows(spark: SparkSession, path: str, contract: Contract, show: int = 3) -> list[str]:
    """The first rows with a cell that does not fit its type, or with too many or too few cells, as they stand in the file."""
    schema = StructType([*contract.schema.fields, StructField("_malformed", StringType())])
    reader = spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    rows = reader.option("enforceSchema", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_malformed").csv(path)
    # All columns are read, since only cells that are parsed can be found wrong.
    cells = F.struct(*[F.col(f"`{c}`") for c in contract.schema.names])
    bad = rows.select(cells.alias("cells"), "_malformed").where(F.col("_malformed").isNotNull() & (F.hash("cells").isNotNull()))
    return [r["_malformed"] for r in bad.limit(show).collect()]


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).columns


def violations(df: DataFrame, contract: Contract, columns: list[str] | None = None, digests: DataFrame | None = None) -> list[str]:
    """What is wrong, in words: checksum, row count, column names and order."""
    found = []
    if digests is not None:
        whole = dataset_digest(digests).first()
        if contract.sha256 is not None and whole["sha256"] != contract.sha256:
            found.append(f"checksum of {whole['files']} files: got {whole['sha256']}, expected {contract.sha256}")
        if whole["headers"] > 1:
            found.append(f"headers: {whole['headers']} different first lines in {whole['files']} files")
    names = columns if columns is not None else df.columns
    if tuple(names) != contract.columns:
        found.append(f"columns: got {list(names)}, expected {list(contract.columns)}")
    elif contract.n_rows is not None and (n := df.count()) != contract.n_rows:
        found.append(f"rows: got {n}, expected {contract.n_rows}")
    return found


def load_raw(spark: SparkSession, contract: Contract, path: str, verify_checksum: bool = True) -> DataFrame:
    """Scan raw CSV files; any departure from the contract raises, nothing is corrected.

    A malformed row is named in the error; the scan itself also fails on one, so a file
    that changes in between does not slip through. A file is one task (quoted line breaks), a table
    as many as it has files: reading, checking and digesting run side by side.
    """
    df = scan_csv(spark, path, contract)
    problems = violations(df, contract, csv_columns(spark, path), file_digests(spark, path) if verify_checksum else None)
    if not problems and (bad := malformed_rows(spark, path, contract)):
        problems.append(f"rows that do not fit the types: {bad}")
    if problems:
        raise ContractError(f"{path}: " + "; ".join(problems))
    return df


def column_roles(df: DataFrame, contract: Contract) -> DataFrame:
    """Role and exclusion reason of every column; a column without a role is an error."""
    rows = [(i, c, contract.role(c), contract.excluded.get(c, "")) for i, c in enumerate(df.columns)]
    unassigned = [c for _, c, role, _ in rows if role == "UNASSIGNED"]
    if unassigned:
        raise ContractError(f"{contract.key}: columns without a role: {unassigned}")
    return df.sparkSession.createDataFrame(rows, "position long, column string, role string, reason string")


def feature_frame(df: DataFrame, contract: Contract) -> DataFrame:
    """Feature columns only; an excluded column among them is an error."""
    overlap = set(contract.excluded) & set(contract.feature_columns)
    if overlap:
        raise ContractError(f"{contract.key}: excluded columns used as features: {sorted(overlap)}")
    return df.select(*[F.col(f"`{c}`") for c in contract.feature_columns])


def provenance(spark: SparkSession, contract: Contract, path: str) -> DataFrame:
    """Checksum, size and shape of all files together, measured now, with the time."""
    df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return dataset_digest(file_digests(spark, path)).select(
        F.lit(contract.key).alias("dataset"), F.lit(contract.filename).alias("file"), "files", "bytes", "sha256",
        (F.col("sha256") == F.lit(contract.sha256)).alias("sha256_matches_contract"),
        df.agg(F.count("*")).scalar().alias("rows"), F.lit(len(df.columns)).cast("long").alias("columns"),
        F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("recorded_at_utc"))


def write_provenance(spark: SparkSession, contracts: dict[str, Contract], out: str) -> None:
    """One JSON record per path -> contract pair."""
    records = None
    for path, contract in contracts.items():
        line = provenance(spark, contract, path)
        records = line if records is None else records.unionByName(line)
    records.coalesce(1).write.mode("overwrite").json(out)
