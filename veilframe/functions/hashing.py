"""Pseudonyms and draws that depend on the value alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilframe.fixed_values import ADDRESS_PREFIX, PERSON_PREFIX
from veilframe.functions.guards import unless_missing


def _md5_tag(text: Column, salt: str | None) -> Column:
    if salt is None:
        return F.substring(F.md5(text), 1, 8)
    # 16 digits of a salted SHA-256: cannot be listed without the salt, and 64 bits
    # keep billions of names apart where 32 would not.
    return F.substring(F.sha2(F.concat(F.lit(salt), text), 256), 1, 16)


def hash_name(text: Column, salt: str | None = None) -> Column:
    return unless_missing(text, F.concat(F.lit(PERSON_PREFIX), _md5_tag(text, salt)))


def hash_address(text: Column, salt: str | None = None) -> Column:
    return unless_missing(text, F.concat(F.lit(ADDRESS_PREFIX), _md5_tag(text, salt)))


def salted_digest(text: Column, salt: str | None) -> Column:
    return F.sha2(text if salt is None else F.concat(F.lit(salt), text), 256)


def hash_ssn(text: Column, salt: str | None = None, digest: Column | None = None) -> Column:
    """Nine digits of the hash in the groups of an SSN; salted, 24 digits in three groups of
    eight, as 36 bits would give the same value to different people in a large table.
    `digest`: the `salted_digest`, where a column has it already."""
    digest = salted_digest(text, salt) if digest is None else digest
    parts = ((1, 3), (4, 2), (6, 4)) if salt is None else ((1, 8), (9, 8), (17, 8))
    groups = [F.substring(digest, at, size) for at, size in parts]
    return unless_missing(text, F.concat_ws("-", *groups))


def keyed_uuid(text: Column, salt: str, digest: Column | None = None) -> Column:
    """A UUID that follows from salt and value, so no dictionary is needed."""
    digest = salted_digest(text, salt) if digest is None else digest
    groups = [F.substring(digest, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return unless_missing(text, F.concat_ws("-", *groups))


def drawn_number(seed: str, *row_key: Column) -> Column:
    """A whole number in [0, 2^60) that follows from the seed and the row's key."""
    text = F.concat_ws("|", F.lit(seed), *[k.cast("string") for k in row_key])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
