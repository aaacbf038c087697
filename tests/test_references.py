"""Orphan references against brute force, with hot keys, ties and empty tables."""

import datetime as dt
import random
import uuid

import pytest

from marlstone.operators import references as R
from marlstone.operators.references import References, orphan_report, orphans, uuid_key

PARENTS = "key string, deleted boolean, since timestamp_ntz"
ROWS = "row_id bigint, ref string, t timestamp_ntz, key string, source string"


def brute(parents, rows, name):
    known = {k: (d, s) for k, d, s in parents}
    out = []
    for row_id, ref, t, *_ in rows:
        key = None if ref is None else ref.strip().strip("{}").replace("-", "").lower()
        if not key or set(key) == {"0"}:
            continue
        deleted, since = known.get(key, (None, None))
        reason = "missing" if key not in known else "deleted" if deleted else "late" if since and t and since > t else None
        if reason:
            out.append((name, row_id, t.strftime("%Y-%m") if t else None, reason))
    return sorted(out, key=str)


@pytest.mark.parametrize("per_range", [200_000, 7])
def test_against_brute_force(spark, monkeypatch, per_range):
    monkeypatch.setattr(R, "PARENTS_PER_RANGE", per_range)
    monkeypatch.setattr(R, "REFERENCES_PER_SLICE", 20)
    rng = random.Random(3)
    day = dt.datetime(2024, 1, 1)
    ids = [uuid.UUID(int=rng.getrandbits(128)) for _ in range(40)]
    parents = [(i.hex, rng.random() < 0.2, day + dt.timedelta(days=rng.randrange(300)) if rng.random() < 0.9 else None) for i in ids[:25]]
    forms = [str, lambda i: str(i).upper(), lambda i: "{%s}" % i, lambda i: i.hex, lambda i: f"  {i} "]
    rows = [(k, rng.choice(forms)(ids[0] if k % 3 == 0 else rng.choice(ids)), day + dt.timedelta(days=rng.randrange(300)) if rng.random() < 0.9 else None, "clash", "clash") for k in range(400)]
    rows += [(900, None, day, "", ""), (901, " ", day, "", ""), (902, str(uuid.UUID(int=0)), day, "", ""), (903, "not a uuid", day, "", ""), (903, "not a uuid", day, "", "")]
    found = orphans(spark.createDataFrame(parents, PARENTS), [References("refs", spark.createDataFrame(rows, ROWS), "row_id", "ref", "t")])
    assert sorted(map(tuple, found.collect()), key=str) == brute(parents, rows, "refs")
    assert orphan_report(found).count() > 0


def test_empty_tables(spark):
    rows = spark.createDataFrame([(1, str(uuid.uuid4()), None, "", "")], ROWS)
    none = spark.createDataFrame([], PARENTS)
    assert [tuple(r) for r in orphans(none, [References("refs", rows, "row_id", "ref", "t")]).collect()] == [("refs", 1, None, "missing")]
    assert orphans(none, [References("refs", rows.where("false"), "row_id", "ref", "t")]).count() == 0


def test_uuid_forms(spark):
    from pyspark.sql import functions as F

    text = "0F1E2D3C-4B5A-6978-8796-A5B4C3D2E1F0"
    forms = [text, text.lower(), f"{{{text}}}", text.replace("-", ""), f"urn:uuid:{text}", f" {text}\t"]
    keys = {r[0] for r in spark.createDataFrame([(f,) for f in forms], "t string").select(uuid_key(F.col("t"))).collect()}
    assert keys == {text.replace("-", "").lower()}
