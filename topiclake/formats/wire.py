"""Schema id header: byte 0, a four-byte big-endian id, then the payload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_wire_format(df: DataFrame, col: str = "value") -> DataFrame:
    """Adds ``schema_id`` and ``payload``; both are null for values without the header."""
    c = F.col(col)
    framed = (F.octet_length(c) >= 5) & (F.substring(c, 1, 1) == F.lit(b"\x00"))
    return df.withColumns(
        {
            "schema_id": F.when(framed, F.conv(F.hex(F.substring(c, 2, 4)), 16, 10).cast("int")),
            "payload": F.when(framed, F.substring(c, F.lit(6), F.octet_length(c) - 5)),
        }
    )


def join_wire_format(payload, schema_id: int):
    return F.concat(F.lit(b"\x00" + schema_id.to_bytes(4, "big")), payload)
