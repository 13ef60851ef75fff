"""Dataset contracts: what a file must look like, and the Spark schema that follows from it."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, fields
from pathlib import Path

from pyspark.sql import types as T

from siftwright.errors import ContractError

TYPES = ("string", "integer", "decimal", "date", "timestamp", "boolean")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]{0,127}")
#: Columns that invalid rows carry besides their own.
SUFFIX = ("error_code", "error_message", "source_file", "row_number", "raw_line")


def is_identifier(name: object) -> bool:
    return isinstance(name, str) and bool(_IDENTIFIER.fullmatch(name))


@dataclass(frozen=True)
class ColumnContract:
    """``required``: the header must have it. ``nullable``: it may be empty. The two are independent."""

    name: str
    type: str = "string"
    nullable: bool = True
    required: bool = True
    format: str | None = None
    precision: int | None = None
    scale: int | None = None

    def problems(self) -> list[str]:
        out = []
        if not is_identifier(self.name):
            out.append(f"column name {self.name!r} is not an identifier")
        if self.type not in TYPES:
            out.append(f"{self.name}: unknown type {self.type!r}")
        if self.type == "decimal":
            if not (_positive(self.precision) and _positive(self.scale)):
                out.append(f"{self.name}: decimal needs a precision and a scale above 0")
            elif self.scale > self.precision:
                out.append(f"{self.name}: scale {self.scale} is over precision {self.precision}")
        if self.type in ("date", "timestamp") and not self.format:
            out.append(f"{self.name}: {self.type} needs a format")
        return out

    @property
    def spark_type(self) -> T.DataType:
        """Decimals are wide enough for any value within the declared number of digits and the declared scale."""
        if self.type == "decimal":
            return T.DecimalType(min(38, self.precision + self.scale), self.scale)
        if self.type == "timestamp":
            return T.TimestampType() if "%z" in (self.format or "") else T.TimestampNTZType()
        return {"string": T.StringType(), "integer": T.DecimalType(38, 0), "date": T.DateType(), "boolean": T.BooleanType()}[self.type]


def _positive(x: object) -> bool:
    return isinstance(x, int) and not isinstance(x, bool) and x > 0


@dataclass(frozen=True)
class Dialect:
    delimiter: str = ","
    encoding: str = "utf-8"
    quotechar: str = '"'
    header: bool = True
    escapechar: str | None = None
    doublequote: bool = True
    lineterminator: str = "\n"
    decimal_separator: str = "."
    has_footer: bool = False

    def problems(self) -> list[str]:
        out = [f"{n} must be one character" for n in ("delimiter", "quotechar", "decimal_separator") if not isinstance(getattr(self, n), str) or len(getattr(self, n)) != 1]
        if self.escapechar is not None and len(self.escapechar) != 1:
            out.append("escapechar must be one character")
        if not self.doublequote and not self.escapechar:
            out.append("without doublequote an escapechar is needed")
        return out


@dataclass(frozen=True)
class Targets:
    valid_table: str = "valid"
    invalid_table: str = "invalid"

    def problems(self) -> list[str]:
        out = [f"table name {t!r} is not an identifier" for t in (self.valid_table, self.invalid_table) if not is_identifier(t)]
        if str(self.valid_table).lower() == str(self.invalid_table).lower():
            out.append("valid and invalid rows need different tables")
        return out


@dataclass(frozen=True)
class DatasetContract:
    dataset: str
    file_pattern: str
    columns: tuple[ColumnContract, ...]
    csv: Dialect = field(default_factory=Dialect)
    targets: Targets = field(default_factory=Targets)
    chunk_size: int = 5000

    def problems(self) -> list[str]:
        out = [] if is_identifier(self.dataset) else [f"dataset name {self.dataset!r} is not an identifier"]
        if not self.columns:
            out.append("a dataset needs a column")
        names = [c.name for c in self.columns]
        out += [f"column {n!r} is declared twice" for n in dict.fromkeys(n for n in names if names.count(n) > 1)]
        for part in (*self.columns, self.csv, self.targets):
            out += part.problems()
        if self.csv.delimiter == self.csv.decimal_separator:
            out.append("delimiter and decimal_separator are the same")
        if not _positive(self.chunk_size):
            out.append("chunk_size must be above 0")
        return out

    def checked(self) -> "DatasetContract":
        """Itself; a ContractError names all problems at once."""
        if found := self.problems():
            raise ContractError("; ".join(found), problems=found)
        return self

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def valid_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type, c.nullable, {k: v for k in ("required", "format", "precision", "scale") if (v := getattr(c, k)) is not None}) for c in self.columns])

    @property
    def invalid_schema(self) -> T.StructType:
        return T.StructType([*(T.StructField(n, T.StringType()) for n in self.names), *(T.StructField(n, T.LongType() if n == "row_number" else T.StringType()) for n in SUFFIX)])


def _made(kind: type, values: object, where: str, problems: list[str]):
    """A ``kind`` from a dict; unknown keys and wrong shapes are problems."""
    if not isinstance(values, dict):
        problems.append(f"{where} must be an object")
        return None
    known = {f.name for f in fields(kind)}
    problems += [f"{where}: unknown key {k!r}" for k in values if k not in known]
    try:
        return kind(**{k: v for k, v in values.items() if k in known})
    except TypeError as e:
        problems.append(f"{where}: {e}")
        return None


def contract_of(values: dict) -> DatasetContract:
    """A checked contract from a dict with the keys dataset, file_pattern, columns, csv, targets, processing."""
    problems: list[str] = []
    if not isinstance(values, dict):
        raise ContractError("a contract must be an object")
    problems += [f"unknown key {k!r}" for k in values if k not in ("dataset", "file_pattern", "columns", "csv", "targets", "processing")]
    problems += [f"missing key {k!r}" for k in ("dataset", "file_pattern", "columns") if k not in values]
    raw_columns = values.get("columns", [])
    if not isinstance(raw_columns, list):
        problems.append("columns must be a list")
        raw_columns = []
    columns = tuple(c for n, x in enumerate(raw_columns) if (c := _made(ColumnContract, x, f"columns[{n}]", problems)))
    csv = _made(Dialect, values.get("csv", {}), "csv", problems) or Dialect()
    targets = _made(Targets, values.get("targets", {}), "targets", problems) or Targets()
    processing = values.get("processing", {})
    if not isinstance(processing, dict) or set(processing) - {"chunk_size"}:
        problems.append("processing has the key chunk_size alone")
        processing = {}
    contract = DatasetContract(str(values.get("dataset", "")), str(values.get("file_pattern", "")), columns, csv, targets, processing.get("chunk_size", 5000))
    problems += [p for p in contract.problems() if not (p == "a dataset needs a column" and "columns" not in values)]
    if problems:
        raise ContractError("; ".join(problems), problems=problems)
    return contract


def load_contract(path: str | Path, defaults_path: str | Path | None = None) -> DatasetContract:
    """A contract from JSON. Its top-level keys replace those of the defaults whole."""
    merged: dict = {}
    for p in (defaults_path, path):
        if p is None:
            continue
        try:
            values = json.loads(Path(p).read_text(encoding="utf-8"))
        except (OSError, ValueError) as e:
            raise ContractError(f"{p}: {e}") from e
        if not isinstance(values, dict):
            raise ContractError(f"{p}: a contract must be an object")
        merged |= values
    return contract_of(merged)


def contract_path(root: str | Path, relative: str, dataset: str, known: frozenset[str] | set[str]) -> Path:
    """The contract's path below ``root``; a dataset that isn't known, an absolute path and one that leaves ``root`` are refused."""
    if dataset not in known:
        raise ContractError(f"unknown dataset {dataset!r}; known: {sorted(known)}")
    if Path(relative).is_absolute():
        raise ContractError(f"absolute path {relative!r}")
    base = Path(root).resolve()
    path = (base / relative).resolve()
    if not path.is_relative_to(base):
        raise ContractError(f"{relative!r} leaves {base}")
    return path
