"""Typing and column shape: P1 typed projection, P2 null-fill, P3 prune/reorder,
P4 align by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..contract import Contract


def _by_position(df: DataFrame, name: str) -> Column:
    # Select by position: a delivery may carry two headings that differ only in case,
    # which name resolution (case-insensitive) would call ambiguous.
    return df[df.columns.index(name)]


def typed_columns(df: DataFrame, contract: Contract) -> list[Column]:
    """The projection of P1–P3 as column expressions (contract order)."""
    present = set(df.columns)
    cols = []
    for f in contract.fields:
        dt = f.data_type
        if f.name in present:
            cols.append(_by_position(df, f.name).try_cast(dt).alias(f.name))
        else:
            cols.append(F.lit(None).cast(dt).alias(f.name))
    return cols


def type_columns(df: DataFrame, contract: Contract) -> DataFrame:
    """P1–P3 in one projection.

    Each contract column is TRY_CAST from the delivery's text (not convertible → NULL);
    a contract column absent from the delivery becomes a typed NULL (P2); columns the
    contract does not declare are dropped and the output follows contract order (P3).
    Presence is decided case-sensitively, as the contract names are exact.
    """
    return df.select(typed_columns(df, contract))


def cast_loss(df_text: DataFrame, contract: Contract) -> list[Column]:
    """Opt-in metric per column: non-NULL text that TRY_CAST turned into NULL.

    Aggregate expressions over the *text* frame; fuse them into the same pass as the checks.
    """
    present = set(df_text.columns)
    out = []
    for f in contract.fields:
        if f.name in present:
            c = _by_position(df_text, f.name)
            out.append(
                F.count_if(c.isNotNull() & c.try_cast(f.data_type).isNull()).alias(f"{f.name}:cast_loss")
            )
    return out


def surplus_columns(df_text: DataFrame, contract: Contract) -> list[str]:
    """Delivery columns the contract does not declare (dropped by P3; reported as info)."""
    declared = set(contract.names)
    return [c for c in df_text.columns if c not in declared]


def align_by_name(df: DataFrame, columns: list[str]) -> DataFrame:
    """Reorder to the target's columns before an insert (never bind by position)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"frame lacks target columns {missing}")
    return df.select([_by_position(df, c) for c in columns])
