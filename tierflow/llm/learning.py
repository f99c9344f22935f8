"""Which rows a model may learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_GRID = 1 << 30


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows never learned from: a fixed fifth by the id's checksum.

    A null id has no checksum; its row is held out.
    """
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(True))


def bounded_sample(rows: DataFrame, most: int, key: str = "doc_id") -> DataFrame:
    """All rows while there are at most ``most``, else about that many by a hash.

    The expected size is nine tenths of the bound, which a sum of so many
    independent draws does not exceed in practice.
    """
    count = rows.count()
    if count <= most:
        return rows
    share = int(_GRID * 0.9 * most / count)
    return rows.filter(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(_GRID)) < share)
