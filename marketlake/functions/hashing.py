"""Row fingerprints and hash ids (FN-5, FN-6, FN-7, KEY-1).

Two fingerprint modes:

* ``json`` (default): md5 of the JSON object of the columns, keys sorted,
  nulls written as ``null``.  Unambiguous and null-safe.
* ``concat``: md5 of the columns' text joined with no separator, null if any
  part is null.  Kept for parity with tables fingerprinted that way; it can
  collide (``('ab','c')`` vs ``('a','bc')``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash_json(cols: list[str]) -> Column:
    """md5 of ``{"a":…,"b":…}`` over the sorted column names."""
    ordered = sorted(cols)
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in ordered]),
                           {"ignoreNullFields": "false"}))


def row_hash_concat(cols: list[str]) -> Column:
    """md5 of the unseparated concatenation; any null part → null."""
    return F.md5(F.concat(*[F.col(c).cast("string") for c in cols]))


def row_hash(cols: list[str], mode: str = "json") -> Column:
    if mode == "json":
        return row_hash_json(cols)
    if mode == "concat":
        return row_hash_concat(cols)
    raise ValueError(f"unknown hash mode {mode!r}")


def distinct_from(a, b) -> Column:
    """FN-7: SQL ``a IS DISTINCT FROM b``."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return ~a.eqNullSafe(b)


def hash_id(cols: list[str]) -> Column:
    """64-bit surrogate id from typed natural-key columns.

    ``xxhash64`` runs per row on the executors: no global sequence, no sort,
    no single task.  Nulls hash to a fixed marker, so ``(null, 'x')`` and
    ``('x', null)`` differ.  Callers check uniqueness (DQ-2) at load.
    """
    parts = []
    for c in cols:
        parts.append(F.col(c))
        parts.append(F.col(c).isNull())
    return F.xxhash64(*parts)


#: Hash bits of an id that starts with its day.
DAY_HASH_BITS = 47


def day_hash_id(cols: list[str], day, bits: int = DAY_HASH_BITS, salt: int | None = None) -> Column:
    """64-bit id of a row of one day: the day's number, then ``bits`` bits of the key's hash.

    Ids of different days (``yyyymmdd``, within 179 years) can't meet, so uniqueness is a question of one
    partition; rows of one day whose hashes meet get another ``salt`` (:func:`operators.keys.settle_ids`)."""
    parts = [] if salt is None else [F.lit(salt)]
    for c in cols:
        parts += [F.col(c), F.col(c).isNull()]
    number = F.datediff(F.to_date(day.cast("string"), "yyyyMMdd"), F.lit("1970-01-01"))
    return F.shiftleft(F.pmod(number, F.lit(1 << 16)).cast("long"), bits).bitwiseOR(F.xxhash64(*parts).bitwiseAND((1 << bits) - 1))


def key_text(cols: list[str]) -> Column:
    """A digest of a key of any length, to tell keys apart whose ids meet."""
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)
