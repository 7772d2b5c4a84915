"""Data contracts as frozen driver-side dataclasses.

A contract is a small document (tens of fields), so it lives on the driver. Everything that
touches rows is expressed as Spark plans built *from* the contract in the operator modules.

The accepted document shape follows the Open Data Contract Standard v3: ``servers``,
``schema[0].properties`` (the columns), ``schema[0].quality`` (table rules),
``customProperties``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Any, Iterable, Mapping

from pyspark.sql import types as T


class ContractError(Exception):
    """The contract, the table or the data do not allow the job to go on."""


# --------------------------------------------------------------------------------------
# Types
# --------------------------------------------------------------------------------------

_SIMPLE_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "text": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ltz": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "tinyint": T.ByteType(),
    "byte": T.ByteType(),
    "smallint": T.ShortType(),
    "short": T.ShortType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "bigint": T.LongType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "real": T.FloatType(),
    "double": T.DoubleType(),
    "binary": T.BinaryType(),
    "decimal": T.DecimalType(10, 0),
    "numeric": T.DecimalType(10, 0),
}
_DECIMAL = re.compile(r"^(?:decimal|numeric|dec)\((\d+),(\d+)\)$")
_DECIMAL_P = re.compile(r"^(?:decimal|numeric|dec)\((\d+)\)$")
_CHARLIKE = re.compile(r"^(?:varchar|char|character)\((\d+)\)$")


def normalise_type_text(text: str) -> str:
    """Blanks removed, lower-cased: the textual form used to compare declared types."""
    return re.sub(r"\s+", "", text or "").lower()


def parse_type(text: str) -> T.DataType:
    """Physical type name of a contract → Spark ``DataType``.

    Covers the scalar names a contract declares. ``VARCHAR(n)``/``CHAR(n)`` read back as
    ``string`` from a Parquet table, so they compare as ``StringType``.
    """
    t = normalise_type_text(text)
    if t in _SIMPLE_TYPES:
        return _SIMPLE_TYPES[t]
    m = _DECIMAL.match(t)
    if m:
        return T.DecimalType(int(m.group(1)), int(m.group(2)))
    m = _DECIMAL_P.match(t)
    if m:
        return T.DecimalType(int(m.group(1)), 0)
    if _CHARLIKE.match(t):
        return T.StringType()
    raise ContractError(f"unknown physical type {text!r}")


# --------------------------------------------------------------------------------------
# Rules and fields
# --------------------------------------------------------------------------------------

# Bound keywords of a quality rule → comparison operator applied to the metric.
BOUND_KEYS = {
    "mustBe": "=",
    "mustNotBe": "!=",
    "mustBeGreaterThan": ">",
    "mustBeGreaterOrEqualTo": ">=",
    "mustBeGreaterThanOrEqualTo": ">=",
    "mustBeLessThan": "<",
    "mustBeLessOrEqualTo": "<=",
    "mustBeLessThanOrEqualTo": "<=",
    "mustBeBetween": "between",
    "mustNotBeBetween": "not between",
}


@dataclass(frozen=True)
class Bound:
    op: str
    lo: float
    hi: float | None = None
    parts: tuple["Bound", ...] = ()  # of op "and"

    def text(self) -> str:
        if self.parts:
            return " and ".join(p.text() for p in self.parts)
        if self.op in ("between", "not between"):
            return f"{self.op} {_num(self.lo)} and {_num(self.hi)}"
        return f"{self.op} {_num(self.lo)}"

    def holds(self, metric: float | None) -> bool:
        if metric is None:
            return False
        if self.parts:
            return all(p.holds(metric) for p in self.parts)
        m, lo, hi = metric, self.lo, self.hi
        return {
            "=": m == lo,
            "!=": m != lo,
            ">": m > lo,
            ">=": m >= lo,
            "<": m < lo,
            "<=": m <= lo,
            "between": hi is not None and lo <= m <= hi,
            "not between": hi is not None and not (lo <= m <= hi),
        }[self.op]


def _num(v: float | None) -> str:
    if v is None:
        return "null"
    return str(int(v)) if float(v).is_integer() else str(v)


ZERO = Bound("=", 0.0)


def _bound_of(d: Mapping[str, Any]) -> Bound | None:
    """All bounds of a rule; several hold together."""
    found = []
    for key, op in BOUND_KEYS.items():
        if key in d:
            ends = d[key] if "between" in op else (d[key],)
            found.append(Bound(op, *(float(x) for x in ends)))
    if len(found) > 1:
        return Bound("and", 0.0, parts=tuple(found))
    return found[0] if found else None


@dataclass(frozen=True)
class Rule:
    """One declared quality rule (field or table level)."""

    name: str | None
    type: str  # library | sql | text | custom
    metric: str | None = None
    arguments: Mapping[str, Any] = field(default_factory=dict)
    query: str | None = None
    bound: Bound | None = None
    description: str | None = None
    dimension: str | None = None
    severity: str = "error"

    @staticmethod
    def from_dict(d: Mapping[str, Any]) -> "Rule":
        unit = str(d.get("unit") or "rows").lower()
        if unit not in ("rows", "row"):  # a share read as a count would pass or fail wrongly
            raise ContractError(f"rule {d.get('name')!r}: unit {unit!r} is not supported, only rows")
        return Rule(
            name=d.get("name"),
            type=str(d.get("type", "library")),
            metric=d.get("metric") or d.get("rule"),
            arguments=dict(d.get("arguments") or {}),
            query=d.get("query"),
            bound=_bound_of(d),
            description=d.get("description"),
            dimension=d.get("dimension"),
            severity=str(d.get("severity") or "error"),
        )


@dataclass(frozen=True)
class Field:
    name: str
    physical_type: str
    logical_type: str | None = None
    required: bool = False
    unique: bool = False
    primary_key_position: int | None = None
    description: str | None = None
    classification: str | None = None
    options: Mapping[str, Any] = field(default_factory=dict)
    rules: tuple[Rule, ...] = ()
    tags: tuple[str, ...] = ()
    examples: tuple[str, ...] = ()

    @property
    def data_type(self) -> T.DataType:
        return parse_type(self.physical_type)

    @property
    def is_key(self) -> bool:
        return self.primary_key_position is not None

    @staticmethod
    def from_dict(d: Mapping[str, Any]) -> "Field":
        if "physicalType" not in d:
            raise ContractError(f"property {d.get('name')!r} declares no physicalType")
        pk_pos = d.get("primaryKeyPosition")
        if d.get("primaryKey") and pk_pos is None:
            pk_pos = 1
        if not d.get("primaryKey"):
            pk_pos = None
        return Field(
            name=str(d["name"]),
            physical_type=str(d["physicalType"]),
            logical_type=d.get("logicalType"),
            required=bool(d.get("required", False)),
            unique=bool(d.get("unique", False)),
            primary_key_position=int(pk_pos) if pk_pos is not None else None,
            description=d.get("description"),
            classification=d.get("classification"),
            options=dict(d.get("logicalTypeOptions") or {}),
            rules=tuple(Rule.from_dict(q) for q in d.get("quality") or ()),
            tags=tuple(str(t) for t in d.get("tags") or ()),
            examples=tuple(str(e) for e in d.get("examples") or ()),
        )


@dataclass(frozen=True)
class Server:
    server: str
    type: str
    catalog: str | None = None
    schema: str | None = None
    format: str | None = None
    delimiter: str | None = None
    path: str | None = None

    @staticmethod
    def from_dict(d: Mapping[str, Any]) -> "Server":
        return Server(
            server=str(d.get("server") or d.get("id")),
            type=str(d.get("type", "")),
            catalog=d.get("catalog"),
            schema=d.get("schema"),
            format=d.get("format"),
            delimiter=d.get("delimiter"),
            path=d.get("path"),
        )


@dataclass(frozen=True)
class Contract:
    id: str
    model: str  # model name: the relation name SQL rules refer to
    physical_name: str
    fields: tuple[Field, ...]
    rules: tuple[Rule, ...] = ()
    servers: tuple[Server, ...] = ()
    custom: Mapping[str, Any] = field(default_factory=dict)
    version: str = "1.0.0"
    status: str | None = None
    description: str | None = None

    # -- construction ---------------------------------------------------------------
    @staticmethod
    def from_dict(doc: Mapping[str, Any]) -> "Contract":
        models = doc.get("schema") or []
        if len(models) != 1:
            raise ContractError(
                f"contract {doc.get('id')!r} must declare exactly one model, found {len(models)}"
            )
        m = models[0]
        fields = tuple(Field.from_dict(p) for p in m.get("properties") or ())
        names = [f.name for f in fields]
        if len(set(names)) != len(names):
            raise ContractError(f"contract {doc.get('id')!r} repeats a property name")
        desc = m.get("description")
        if desc is None and isinstance(doc.get("description"), Mapping):
            desc = doc["description"].get("purpose")
        return Contract(
            id=str(doc.get("id")),
            model=str(m.get("name") or m.get("physicalName")),
            physical_name=str(m.get("physicalName") or m.get("name")),
            fields=fields,
            rules=tuple(Rule.from_dict(q) for q in m.get("quality") or ()),
            servers=tuple(Server.from_dict(s) for s in doc.get("servers") or ()),
            custom={p["property"]: p.get("value") for p in doc.get("customProperties") or ()},
            version=str(doc.get("version", "1.0.0")),
            status=doc.get("status"),
            description=desc,
        )

    @staticmethod
    def from_yaml(text: str) -> "Contract":
        import yaml

        return Contract.from_dict(yaml.safe_load(text))

    @staticmethod
    def load(path: str) -> "Contract":
        with open(path, encoding="utf-8") as fh:
            return Contract.from_yaml(fh.read())

    # -- views ----------------------------------------------------------------------
    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def key(self) -> list[str]:
        keyed = sorted((f for f in self.fields if f.is_key), key=lambda f: f.primary_key_position)
        return [f.name for f in keyed]

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    def spark_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(f.name, f.data_type, not f.required) for f in self.fields]
        )

    def with_fields(self, fields: Iterable[Field]) -> "Contract":
        return Contract(
            self.id, self.model, self.physical_name, tuple(fields), self.rules, self.servers,
            self.custom, self.version, self.status, self.description,
        )

    def with_rules(self, rules: Iterable[Rule]) -> "Contract":
        return Contract(
            self.id, self.model, self.physical_name, self.fields, tuple(rules), self.servers,
            self.custom, self.version, self.status, self.description,
        )


# --------------------------------------------------------------------------------------
# Target naming
# --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Target:
    """Where a contract's table lives in one environment."""

    catalog: str
    schema: str
    table: str

    @property
    def fqn(self) -> str:
        return f"{self.catalog}.{self.schema}.{self.table}"

    def spark_name(self, spark=None) -> str:
        """Name usable by this session.

        Three parts when ``catalog`` is a configured Spark catalog; otherwise the built-in
        session catalog, which takes one namespace level, gets ``<catalog>__<schema>``.
        """
        if spark is not None and spark.conf.get(f"spark.sql.catalog.{self.catalog}", None):
            return f"`{self.catalog}`.`{self.schema}`.`{self.table}`"
        return f"`{self.namespace(spark)}`.`{self.table}`"

    def namespace(self, spark=None) -> str:
        if spark is not None and spark.conf.get(f"spark.sql.catalog.{self.catalog}", None):
            return f"`{self.catalog}`.`{self.schema}`"
        return f"{self.catalog}__{self.schema}"


def resolve_target(contract: Contract, environment: str) -> Target:
    """The table of ``environment``, if it stands where the naming convention puts it.

    The convention gives one place: catalog ``<environment>_<layer>`` (the layer is the custom
    property ``capa``), schema ``schemaLanding`` when the contract names it, else any. The
    contract's server must declare that place.
    """
    declared = {s.server: (s.catalog, s.schema) for s in reversed(contract.servers) if s.catalog is not None}
    catalog, schema = declared.get(environment, (None, None))
    layer = str(contract.custom.get("capa", "")).lower()
    place = (f"{environment}_{layer}", contract.custom.get("schemaLanding") or schema)
    if (catalog, schema) != place or not schema:
        shown = ".".join(str(x) for x in (catalog, schema) if x) or "no table"
        raise ContractError(
            f"{contract.id}: environment {environment!r} must be {place[0]}.{place[1] or '<schema>'}, found {shown}"
        )
    return Target(catalog, schema, contract.physical_name)
