"""Row expansion."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import ship_package

FLUSH = 4096  # records handed on at a time


def explode_records(df: DataFrame, array_col: str, keep: list[str] = (), alias: str = "r",
                    fields: list[str] | None = None) -> DataFrame:
    """G1: one row per array element; null and empty arrays drop the parent row.

    With `fields`, the element struct's fields are flattened next to `keep`.
    """
    out = df.select(*keep, F.explode(array_col).alias(alias))
    if fields is not None:
        out = out.select(*keep, *[F.col(f"{alias}.{f}").alias(f) for f in fields])
    return out


def _plain(kind: pa.DataType) -> Callable[[object], bool] | None:
    """A cheap test that a value which is not None surely fits an Arrow type; None: there is none."""
    if pa.types.is_signed_integer(kind):
        least, most = -(1 << kind.bit_width - 1), (1 << kind.bit_width - 1) - 1
        return lambda v: type(v) is int and least <= v <= most
    if kind == pa.float64():
        return lambda v: type(v) is float or type(v) is int and -(1 << 53) <= v <= 1 << 53
    if kind == pa.string():
        return lambda v: type(v) is str and v.isascii()
    if kind == pa.bool_():
        return lambda v: type(v) is bool
    return None


def flat_map_records(df: DataFrame, fn: Callable[[dict], Iterable[dict]], schema: T.StructType | str,
                     source: str) -> DataFrame:
    """Typed flatMap. `fn` takes a row of `df` as a dict and yields 0..n records as dicts.

    The result has the fields of `schema` and `reason`, `record`. A row from which `fn` raises, and a
    record with a value that does not fit its field (or a field that `schema` does not have), is a dead
    letter: `reason` `failed` or `bad_record`, the row's `source` column or the record in `record`, no
    fields; what `fn` yielded before it raised is kept. Absent fields are null. For bodies that no
    built-in function expresses: each Arrow batch streams through, and nothing is gathered."""
    ship_package(df.sparkSession)
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)
    full = pa.schema([*arrow, pa.field("reason", pa.string()), pa.field("record", pa.string())])

    names = frozenset(arrow.names)
    whole = [f.name for f in arrow if pa.types.is_integer(f.type)]
    plain = {f.name: test for f in arrow if (test := _plain(f.type))}

    def surely(record: dict) -> bool:
        """Only values that are known to fit by their Python type; what is not may fit all the same."""
        for n, v in record.items():
            if v is None:
                if n not in names:
                    return False
            elif n not in plain or not plain[n](v):
                return False
        return True

    def known(record: dict) -> bool:
        """No field that the schema does not have, and for an integer neither a fraction, which Arrow would
        cut, nor a number beyond its width."""
        return record.keys() <= names and all(
            (v := record.get(n)) is None or type(v) is int and (n not in plain or plain[n](v)) for n in whole)

    def fits(record: dict) -> bool:
        if not known(record):
            return False
        try:
            pa.RecordBatch.from_pylist([record], schema=arrow)
            return True
        except (pa.ArrowException, TypeError, ValueError, OverflowError):
            return False

    def batch_of(records: list[dict], dead: list[dict]) -> pa.RecordBatch:
        good, bad = [], []
        for r in records:  # a trial conversion only where the Python types do not tell
            (good if surely(r) or fits(r) else bad).append(r)
        bad = [{"reason": "bad_record", "record": repr(r)} for r in bad]
        return pa.RecordBatch.from_pylist(good + bad + dead, schema=full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            records: list[dict] = []
            dead: list[dict] = []
            for row in b.to_pylist():
                try:
                    for record in fn(row):
                        records.append(record)
                except Exception:  # noqa: BLE001 - whatever a body does wrong is its own dead letter
                    dead.append({"reason": "failed", "record": None if row[source] is None else str(row[source])})
                if len(records) + len(dead) >= FLUSH:
                    yield batch_of(records, dead)
                    records, dead = [], []
            if records or dead:
                yield batch_of(records, dead)

    return df.mapInArrow(run, T.StructType([*fields.fields, T.StructField("reason", T.StringType()),
                                            T.StructField("record", T.StringType())]))
