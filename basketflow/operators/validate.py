"""Row validation, batch-conditional filters, CHECK and foreign-key splits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow import schemas
from basketflow.functions import nan_to_null, try_date, try_id, try_ts
from basketflow.operators.skew import HOT_ROWS, split_join


@dataclass(frozen=True)
class Field:
    """One field of a model; kind is id, int, number, text, timestamp or date."""

    name: str
    kind: str
    required: bool = False

    def parse(self, source_type: str) -> Column:
        c = F.col(self.name)
        if source_type in ("double", "float"):
            c = nan_to_null(c)
        if self.kind == "text":
            return c.cast("string")
        if self.kind == "timestamp":
            return try_ts(c)
        if self.kind == "date":
            return try_date(c)
        if self.kind == "number":
            return c if source_type.startswith("decimal") else c.try_cast("double")
        whole = c.try_cast("bigint") if source_type in ("int", "bigint") else try_id(c.cast("string"))
        return whole if self.kind == "id" else whole.try_cast("int")

    @property
    def numeric(self) -> bool:
        return self.kind in ("id", "int", "number")


def _fields(required: str, optional: str) -> list[Field]:
    """Fields from two lists written as ``name:kind``."""
    parts = [(spec, True) for spec in required.split()] + [(s, False) for s in optional.split()]
    return [Field(*spec.split(":"), required=must) for spec, must in parts]


MODELS = {
    "user_profile": _fields("user_id:id", "name:text email:text birth_date:date gender:text"),
    "user_device": _fields("user_id:id", "device_type:text os:text browser:text"),
    "user_location": _fields("user_id:id", "city:text country:text lat:number lon:number"),
    "event": _fields(
        "user_id:id event_type:text timestamp:timestamp",
        "session_id:text product_id:id order_id:text quantity:int "
        "cost_usd:number cost_eur:number cost_rub:number weather_temp:number "
        "weather_desc:text city:text country:text lat:number lon:number"),
    "order": _fields("order_id:text user_id:id order_ts:timestamp", "total_usd:number"),
    "order_item": _fields("order_id:text product_id:id quantity:int", "price_usd:number"),
}


def validate(df: DataFrame, model: str | Sequence[Field],
             keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Split rows into (valid, rejected).

    Each model field is parsed to its type.  A row is rejected when a required field
    is missing or a given value does not parse.  Missing optional numbers become 0.
    ``valid`` has the model's fields plus ``keep``; ``rejected`` has the input columns
    plus ``reasons``.
    """
    fields = MODELS[model] if isinstance(model, str) else list(model)
    types = dict(df.dtypes)
    reasons, parsed = [], []
    for f in fields:
        if f.name not in types:
            if f.required:
                reasons.append(F.lit(f"{f.name}: missing"))
            empty = {"id": "bigint", "int": "int", "number": "double", "text": "string",
                     "timestamp": "timestamp_ntz", "date": "date"}[f.kind]
            value = F.lit(0) if f.numeric else F.lit(None)
            parsed.append(value.cast(empty).alias(f.name))
            continue
        value = f.parse(types[f.name])
        given = F.col(f.name).isNotNull()
        if types[f.name] in ("double", "float"):
            given = given & ~F.isnan(f.name)
        if f.required:
            reasons.append(F.when(~given, F.lit(f"{f.name}: missing")))
        if f.kind != "text":
            reasons.append(F.when(given & value.isNull(), F.lit(f"{f.name}: not a valid {f.kind}")))
        if f.numeric and not f.required:
            value = F.coalesce(value, F.lit(0))
        parsed.append(value.alias(f.name))
    marked = df.withColumn("reasons", F.array_compact(F.array(*reasons)))
    bad = F.size("reasons") > 0
    names = {f.name for f in fields}
    carried = [F.col(c) for c in keep if c not in names]
    return marked.where(~bad).select(*carried, *parsed), marked.where(bad)


def not_null(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(fields))


def not_null_if(df: DataFrame, flag: Column, if_any: Sequence[str], otherwise: Sequence[str],
                batch: DataFrame | None = None) -> DataFrame:
    """Require ``if_any`` when the flag holds in any row of the batch, else ``otherwise``.

    The flag is one value for the whole batch, read through a scalar subquery.
    """
    any_row = (batch if batch is not None else df).agg(
        F.coalesce(F.bool_or(flag), F.lit(False))).scalar()

    def present(names: Sequence[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names], F.lit(True))

    return df.where(F.when(any_row, present(if_any)).otherwise(present(otherwise)))


def allow(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def check(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Split rows by the table's CHECKs; ``bad`` also lists the checks that failed."""
    failed = F.array_compact(F.array(*[
        F.when(~F.coalesce(F.expr(predicate), F.lit(True)), F.lit(name))
        for name, predicate in schemas.CHECKS.get(table, [])]))
    marked = df.withColumn("failed_checks", failed)
    bad = F.size("failed_checks") > 0
    return marked.where(~bad).drop("failed_checks"), marked.where(bad)


def fk_check(df: DataFrame, parent: DataFrame, key: str, spread_by: Sequence[str],
             parent_key: str | None = None,
             hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Split child rows into (ok, orphans) by whether the parent key exists.

    A NULL key references nothing and passes.  ``spread_by`` names columns that tell
    the rows of one hot key apart.
    """
    ids = parent.select(F.col(parent_key or key).alias(key)).where(F.col(key).isNotNull()).distinct()
    given = df.where(F.col(key).isNotNull())
    ok = split_join(given, ids, key, "left_semi", spread_by, hot_rows)
    orphans = split_join(given, ids, key, "left_anti", spread_by, hot_rows)
    return ok.unionByName(df.where(F.col(key).isNull())), orphans
