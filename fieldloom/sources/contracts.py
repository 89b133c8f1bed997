"""Dataset contracts: what a raw table must look like and what each column is for."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T


class ContractError(RuntimeError):
    """A raw table does not match its contract."""


@dataclass(frozen=True)
class Contract:
    key: str
    filename: str
    task: str
    schema: T.StructType
    n_rows: int | None = None
    sha256: str | None = None
    target: str | None = None
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    text: tuple[str, ...] = ()
    excluded: Mapping[str, str] = field(default_factory=dict)
    synthetic: bool | None = None

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.schema.names)

    @property
    def feature_columns(self) -> tuple[str, ...]:
        return self.numeric + self.categorical + self.text

    def role(self, column: str) -> str:
        if column in self.excluded:
            return "excluded"
        for name in ("numeric", "categorical", "text"):
            if column in getattr(self, name):
                return name
        return "target" if column == self.target else "UNASSIGNED"

    def typed_schema(self) -> T.StructType:
        """The schema with role and exclusion reason as column metadata."""
        return T.StructType([
            T.StructField(f.name, f.dataType, f.nullable, {"role": self.role(f.name), "reason": self.excluded.get(f.name, "")})
            for f in self.schema])


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_INT, _DOUBLE, _TEXT = T.IntegerType(), T.DoubleType(), T.StringType()

# Names, order, checksums, row counts and roles of the three datasets.
STUDENT = Contract(
    key="student_performance", filename="Student_Performance.csv", task="regression",
    schema=_schema(
        ("Hours Studied", _INT), ("Previous Scores", _INT), ("Extracurricular Activities", _TEXT), ("Sleep Hours", _INT),
        ("Sample Question Papers Practiced", _INT), ("Performance Index", _DOUBLE)),
    n_rows=10_000, sha256="93793b00d9026d0b4907df0ca9f88b3696747c7496679d35833bb0fbf9fb57cf",
    target="Performance Index",
    numeric=("Hours Studied", "Previous Scores", "Sleep Hours", "Sample Question Papers Practiced"),
    categorical=("Extracurricular Activities",), synthetic=True)

REVIEWS = Contract(
    key="restaurant_reviews", filename="Restaurant reviews.csv", task="classification",
    schema=_schema(
        ("Restaurant", _TEXT), ("Reviewer", _TEXT), ("Review", _TEXT), ("Rating", _TEXT), ("Metadata", _TEXT), ("Time", _TEXT),
        ("Pictures", _INT), ("7514", _TEXT)),
    n_rows=10_000, sha256="43a3950890537219def4af1f7a4473dc0e6fa36dafb2df7a07da723c7fb71517",
    target="Rating", text=("Review",),
    excluded={
        "Rating": "source of the label", "Restaurant": "identifies the reviewed business", "Reviewer": "personal name",
        "Metadata": "describes the reviewer, not the review", "Time": "time stamp, not content",
        "Pictures": "picture count, not content", "7514": "artefact column, almost empty"},
    synthetic=False)
REVIEW_KEY = ("Restaurant", "Reviewer", "Review")

CAFE = Contract(
    key="cafe_sales", filename="Cafe_sales_cleaned.csv", task="clustering",
    schema=_schema(
        ("Transaction ID", _TEXT), ("Item", _TEXT), ("Quantity", _DOUBLE), ("Price Per Unit", _DOUBLE), ("Total Spent", _DOUBLE),
        ("Payment Method", _TEXT), ("Location", _TEXT), ("Transaction Date", _TEXT)),
    n_rows=10_000, sha256="41e0f4a082be47049d9ebc3a4e5a05e74e9458c1d987c4502c8a26b8c5bb66a6",
    excluded={"Transaction ID": "unique identifier"}, synthetic=True)

CONTRACTS = {c.key: c for c in (STUDENT, REVIEWS, CAFE)}
