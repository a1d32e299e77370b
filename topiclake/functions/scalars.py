"""Column helpers. All of them compile to built-in expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clamp(col: Column | str, lo, hi) -> Column:
    """``col`` limited to ``[lo, hi]``; null stays null."""
    c = _c(col)
    return F.when(c.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


def as_unsigned(col: Column | str, bits: int) -> Column:
    """Read a signed column as the unsigned number with the same bits."""
    c = _c(col)
    if bits == 32:
        return c.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))
    if bits == 64:
        d = c.cast("decimal(20,0)")
        return F.when(c < 0, d + F.lit(str(2**64)).cast("decimal(20,0)")).otherwise(d).cast("decimal(20,0)")
    raise ValueError("bits must be 32 or 64")


def to_epoch_ms(col: Column | str) -> Column:
    """ISO-8601 text to epoch milliseconds; null when it does not parse."""
    return F.unix_millis(F.try_to_timestamp(_c(col)))


def epoch_us(col: Column | str) -> Column:
    """Any timestamp column to epoch microseconds (UTC wall clock for NTZ)."""
    return F.unix_micros(_c(col).cast("timestamp"))


def struct_field(col: Column | str, *path: str) -> Column:
    """``a.b.c`` access that yields null when a parent is null."""
    c = _c(col)
    for name in path:
        c = c.getField(name)
    return c


def map_value(col: Column | str, key, *path: str) -> Column:
    """``map['key']`` and fields below it; null when the key is absent."""
    return struct_field(F.try_element_at(_c(col), F.lit(key)), *path)


def array_item(col: Column | str, position: int, *path: str) -> Column:
    """1-based array access; null when the array is shorter."""
    return struct_field(F.try_element_at(_c(col), F.lit(position)), *path)


def choice(branches: list[str]) -> Column:
    """Name of the first non-null branch column, null when none is set."""
    return F.coalesce(*[F.when(F.col(b).isNotNull(), F.lit(b.split(".")[-1])) for b in branches])


def classify(col: Column | str, steps: list[tuple[float | None, str]]) -> Column:
    """Threshold class: ``steps`` is ``[(None, base), (bound, name), ...]``, bounds inclusive."""
    c = _c(col)
    base = [name for bound, name in steps if bound is None]
    out = F.lit(base[0]) if base else F.lit(None).cast("string")
    for bound, name in sorted((s for s in steps if s[0] is not None), key=lambda s: s[0]):
        out = F.when(c >= bound, F.lit(name)).otherwise(out)
    return F.when(c.isNotNull(), out)


def once(expression: Column) -> Column:
    """Evaluate an expensive expression once per row.

    Later filters and projections would each repeat it, since the optimizer
    moves them past a plain projection; a generator stops that.
    """
    return F.explode(F.array(expression))


def anchored(pattern: str) -> str:
    """A label regex has to match the whole value."""
    return f"^(?:{pattern})$"


_TRANSFORM = re.compile(r"^\s*(?:(\w+)\s*\(\s*([^,()]+?)\s*(?:,\s*([^,()]+?)\s*)?\)|(\w+))\s*$")


class PartitionField:
    """One entry of a partition spec: ``month(ts)``, ``hour(ts)``, ``bucket(id, 16)`` or a column.

    Month counts from 1970-01 and hour from the epoch, both in UTC. Buckets use
    ``xxhash64``, so their numbers are not those of other table formats.
    """

    def __init__(self, text: str):
        m = _TRANSFORM.match(text)
        if not m:
            raise ValueError(f"bad partition field: {text!r}")
        self.kind = (m.group(1) or "identity").lower()
        self.column = m.group(4) or m.group(2)
        self.buckets = None
        if self.kind == "bucket":
            a, b = m.group(2), m.group(3)
            if b is None:
                raise ValueError(f"bucket needs a column and a count: {text!r}")
            self.column, count = (b, a) if a.isdigit() else (a, b)
            self.buckets = int(count)
        elif self.kind not in ("month", "hour", "identity"):
            raise ValueError(f"unknown partition transform: {self.kind}")
        elif m.group(3):
            raise ValueError(f"{self.kind} takes one column: {text!r}")

    @property
    def name(self) -> str:
        return {"identity": f"{self.column}_key"}.get(self.kind, f"{self.column}_{self.kind}")

    @property
    def sql_type(self) -> str:
        return {"identity": "string", "month": "int", "hour": "bigint", "bucket": "int"}[self.kind]

    def value(self, column: Column | None = None) -> Column:
        c = F.col(self.column) if column is None else column
        if self.kind == "bucket":
            return F.pmod(F.xxhash64(c), F.lit(self.buckets)).cast("int")
        if self.kind == "month":
            return ((F.year(c) - 1970) * 12 + F.month(c) - 1).cast("int")
        if self.kind == "hour":
            return F.floor(epoch_us(c) / F.lit(3_600_000_000)).cast("bigint")
        return c.cast("string")

    @property
    def text(self) -> str:
        if self.kind == "identity":
            return self.column
        if self.kind == "bucket":
            return f"bucket({self.column}, {self.buckets})"
        return f"{self.kind}({self.column})"


def parse_partition_by(spec: str | list[str] | None) -> list[PartitionField]:
    """``"[month(ts), bucket(id, 16)]"`` or a list of such entries."""
    if not spec:
        return []
    if isinstance(spec, str):
        body = spec.strip()
        body = body[1:-1] if body.startswith("[") else body
        spec = [p for p in re.split(r",\s*(?![^()]*\))", body) if p.strip()]
    return [PartitionField(s) for s in spec]
