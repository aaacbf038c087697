"""Deterministic identity: canonical hashes, name-based UUIDs, order-free fingerprints, buckets."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F


def sha256_parts(*parts: Column | str) -> Column:
    """sha256 in lower-case hex of the parts joined by a bar; a null part counts as empty."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p if isinstance(p, Column) else F.col(p), F.lit("")) for p in parts]), 256)


def stable_json_hash(*columns: str) -> Column:
    """sha256 of the columns as JSON with sorted names and nulls kept."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def uuid5(namespace: str, name: Column) -> Column:
    """The name-based UUID (version 5) of name, as the standard library makes it, without Python in the row path."""
    seed = F.sha1(F.concat(F.unhex(F.lit(uuid.UUID(namespace).hex)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(seed, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws("-", F.substring(seed, 1, 8), F.substring(seed, 9, 4), F.concat(F.lit("5"), F.substring(seed, 14, 3)), F.concat(variant, F.substring(seed, 18, 3)), F.substring(seed, 21, 12))


def multiset_hash(item: Column) -> Column:
    """Aggregate: sha256 of the sorted items joined by a bar; the order of rows does not matter, repetition does."""
    return F.sha2(F.array_join(F.array_sort(F.collect_list(item)), "|"), 256)


def fingerprint(number: Column) -> Column:
    """Aggregate: an order-free checksum, the decimal sum of whole numbers (of hashes, say) without overflow."""
    return F.sum(number.cast("decimal(38,0)"))


def bucket(key: Column, count: int) -> Column:
    """0 to count - 1 by hash of key."""
    return F.pmod(F.xxhash64(key), F.lit(count))
