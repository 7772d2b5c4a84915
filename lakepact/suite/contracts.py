"""Contracts over the driver tables, used by the registered queries and the bench."""

from __future__ import annotations

from typing import Any

from ..contract import Contract

ENV = "suite"


def _servers(schema: str) -> list[dict[str, Any]]:
    return [{"server": ENV, "type": "lakehouse", "catalog": f"{ENV}_landing", "schema": schema}]


def _doc(cid: str, model: str, props: list[dict], quality: list[dict], schema: str = "suite") -> dict:
    return {
        "id": cid,
        "version": "1.0.0",
        "customProperties": [{"property": "capa", "value": "landing"}],
        "servers": _servers(schema),
        "schema": [{"name": model, "physicalName": model, "description": f"{model} delivery",
                    "properties": props, "quality": quality}],
    }


def _p(name: str, t: str, required: bool = True, **kw) -> dict:
    d = {"name": name, "physicalType": t, "required": required, "description": f"{name} column"}
    d.update(kw)
    return d


# A delivery's files: each is written by one task.
DELIVERY_FILE_BYTES = 1 << 28

ROWS = {"type": "library", "metric": "rowCount", "mustBeGreaterThan": 0, "name": "not_empty", "description": "a delivery has rows",
        "dimension": "completeness", "severity": "error"}


def _values(name: str, values: list[str]) -> list[dict]:
    return [{"type": "library", "metric": "invalidValues", "arguments": {"validValues": values},
             "mustBe": 0, "name": name, "dimension": "conformity", "severity": "error"}]


def orders(schema: str = "suite") -> Contract:
    return Contract.from_dict(_doc("orders", "orders_delivery", [
        _p("o_orderkey", "BIGINT", primaryKey=True, primaryKeyPosition=1),
        _p("o_custkey", "BIGINT"),
        _p("o_orderstatus", "STRING", quality=_values("orderstatus_catalogo", ["F", "O", "P"])),
        _p("o_totalprice", "DECIMAL(12,2)", logicalTypeOptions={"exclusiveMinimum": 0}),
        _p("o_orderdate", "DATE"),
        _p("o_orderpriority", "STRING", logicalTypeOptions={"pattern": "^[1-5]-[A-Z ]+$"}),
    ], [ROWS, {"type": "sql", "name": "no_future_orders", "mustBe": 0, "dimension": "timeliness", "severity": "warning",
               "description": "no order is dated ahead",
               "query": "SELECT COUNT(*) FROM orders_delivery WHERE o_orderdate > DATE '2030-01-01'"}],
        schema))


def lineitem(schema: str = "suite") -> Contract:
    return Contract.from_dict(_doc("lineitem", "lineitem_delivery", [
        _p("l_orderkey", "BIGINT", primaryKey=True, primaryKeyPosition=1),
        _p("l_partkey", "BIGINT"),
        _p("l_suppkey", "BIGINT"),
        _p("l_linenumber", "INT", primaryKey=True, primaryKeyPosition=2),
        _p("l_quantity", "DECIMAL(12,2)", logicalTypeOptions={"exclusiveMinimum": 0}),
        _p("l_extendedprice", "DECIMAL(12,2)", logicalTypeOptions={"minimum": 0}),
        _p("l_discount", "DECIMAL(4,2)", logicalTypeOptions={"minimum": 0, "maximum": 0.1}),
        _p("l_tax", "DECIMAL(4,2)", logicalTypeOptions={"maximum": 0.08}),
        _p("l_returnflag", "STRING", quality=_values("returnflag_catalogo", ["A", "N", "R"])),
        _p("l_linestatus", "STRING", quality=_values("linestatus_catalogo", ["F", "O"])),
        _p("l_shipdate", "DATE"),
    ], [ROWS,
        {"type": "sql", "name": "tax_not_above_discount", "mustBe": 0,
         "query": "SELECT COUNT(*) FROM lineitem_delivery WHERE l_tax > l_discount"},
        {"type": "sql", "name": "one_flag_per_order", "mustBe": 0,
         "query": "SELECT COUNT(*) FROM (SELECT l_orderkey FROM lineitem_delivery GROUP BY l_orderkey "
                  "HAVING COUNT(DISTINCT l_returnflag) > 1)"}],
        schema))


def customer(schema: str = "suite") -> Contract:
    return Contract.from_dict(_doc("customer", "customer_delivery", [
        _p("c_custkey", "BIGINT", primaryKey=True, primaryKeyPosition=1),
        _p("c_name", "STRING", logicalTypeOptions={"pattern": "^Customer#[0-9]{9}$"}),
        _p("c_nationkey", "INT"),
        _p("c_acctbal", "DECIMAL(12,2)", logicalTypeOptions={"exclusiveMinimum": 0}),
        _p("c_mktsegment", "STRING"),
    ], [ROWS], schema))


def part(schema: str = "suite") -> Contract:
    return Contract.from_dict(_doc("part", "part_delivery", [
        _p("p_partkey", "BIGINT", primaryKey=True, primaryKeyPosition=1),
        _p("p_name", "STRING", logicalTypeOptions={"minLength": 9, "maxLength": 11}),
        _p("p_brand", "STRING", logicalTypeOptions={"pattern": "^Brand#[0-9]$"}),
        _p("p_type", "STRING"),
        _p("p_size", "INT"),
        _p("p_retailprice", "DECIMAL(12,2)"),
    ], [ROWS, {"type": "sql", "name": "one_type_per_brand", "mustBe": 0,
               "query": "SELECT COUNT(*) FROM (SELECT p_brand FROM part_delivery GROUP BY p_brand "
                        "HAVING COUNT(DISTINCT p_type) > 1)"}], schema))


def supplier(schema: str = "suite") -> Contract:
    return Contract.from_dict(_doc("supplier", "supplier", [
        _p("s_suppkey", "BIGINT", primaryKey=True, primaryKeyPosition=1),
        _p("s_name", "STRING"),
        _p("s_nationkey", "INT"),
        _p("s_acctbal", "DECIMAL(12,2)"),
    ], [ROWS], schema))


def with_custom_rule(schema: str = "suite") -> Contract:
    """The supplier contract with a rule that only another engine can run."""
    doc = _doc("supplier_custom", "supplier", [
        _p("s_suppkey", "BIGINT", primaryKey=True, primaryKeyPosition=1),
        _p("s_acctbal", "DECIMAL(12,2)"),
    ], [ROWS, {"type": "custom", "engine": "other", "name": "balance_profile", "implementation": "profile(s_acctbal)"}], schema)
    return Contract.from_dict(doc)


def nation(schema: str = "suite", with_comment: bool = False) -> Contract:
    props = [_p("n_nationkey", "INT", primaryKey=True, primaryKeyPosition=1),
             _p("n_name", "STRING"), _p("n_regionkey", "INT")]
    if with_comment:
        props.append(_p("n_comment", "STRING", required=False))
    return Contract.from_dict(_doc("nation", "nation", props, [ROWS], schema))


def events(schema: str = "suite") -> Contract:
    return Contract.from_dict(_doc("events", "events_delivery", [
        _p("event_id", "BIGINT"), _p("ts", "TIMESTAMP"), _p("user_id", "BIGINT"),
        _p("event_type", "STRING", quality=_values("event_type_catalogo", ["click", "view", "signup"])),
        _p("value", "DOUBLE"), _p("props", "STRING"),
    ], [ROWS], schema))
