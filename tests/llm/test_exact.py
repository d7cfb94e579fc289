import hashlib
import re

import pytest
from pyspark.sql import functions as F

from wattline.llm import exact


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), n in zip(rows, norm):
        ids = [j for (j, _), m in zip(rows, norm) if m == n]
        keep = min((j for j in ids if j is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    return out


ROWS = [
    (5, "a  b"), (3, "a\tb"), (9, "a b"), (4, " a b"), (7, None), (6, ""), (8, " "), (2, "\n"), (None, "a b"), (None, "only here"),
    (1, "É x"), (10, "É x"), (11, "long " * 5000), (12, "long\n" * 5000), (13, "same"), (13, "same"), (14, "same"),
] + [(100 + i, "hot  copy") for i in range(300)]


@pytest.mark.parametrize("digits", [32, 1, 0])
def test_groups_equal_brute_force_even_if_hashes_collide(spark, monkeypatch, digits):
    monkeypatch.setattr("wattline.llm.common.HOT_ROWS", 20)  # splits the large group
    digest = exact.content_hash if digits == 32 else lambda t: F.substring(F.md5(t), 1, digits).cast("binary")
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in ROWS], "doc_id long, text string, n int, h string")
    got = [tuple(r) for r in exact.exact_groups(df, digest).collect()]
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=order) == sorted(brute(ROWS), key=order)
    kept = exact.drop_exact_copies(df, digest)
    assert kept.columns == df.columns
    want = {(i, t) for (i, t), b in zip(ROWS, brute(ROWS)) if b[3]}
    assert sorted(kept.select("doc_id", "text").collect(), key=order) == sorted(want, key=order)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact.exact_groups(df).collect() == [] and exact.drop_exact_copies(df).collect() == []
