import random
import re

from wattline.llm import licenses


def brute_base(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in licenses.BASE.items():
        want = phrase.replace("*", "").split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(want)] == want]
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))
    )


def texts():
    rng = random.Random(7)
    parts = ["Under the MIT License.", "Apache License, Version 2.0", "CC-BY-NC", "cc by nc sa", "license", "mit", "the", "under", "\n",
             "SPDX-License-Identifier: GPL-3.0", "licensed under the BSD 3-clause license", "É", "version 2", "All rights reserved"]
    out = [" ".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(150)]
    return [None, "", "...", *out, "filler " * 3000 + "under the mit license " * 200, "CC BY NC" * 2, "cc by nc cc by nc"]


def test_base_columns_equal_brute_force(spark):
    values = texts()
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(values)], "doc_id long, text string, label string, row int")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert len(got) == len(values)
    for i, t in enumerate(values):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(t), t
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and set(r.base_labels.split(",")) - {""} <= set(labels)
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)


def labels_of(spark, text):
    return licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().labels


def test_rules_and_suppression(spark):
    assert len(licenses.rules()) > 200
    assert labels_of(spark, "SPDX-License-Identifier: GPL-3.0") == "gpl-3"  # the shorter "gpl" lies inside
    assert labels_of(spark, "Licensed under the Apache License, Version 2.0") == "apache-2"
    assert labels_of(spark, "released under the terms of the BSD 3-Clause Licence") == "bsd-3-clause"
    assert labels_of(spark, "https://creativecommons.org/licenses/CC-BY-SA/4.0") == "cc-by-sa"
    assert labels_of(spark, "Mozilla Public License Version 2.0. All rights reserved.") == "all-rights-reserved,mpl"
    assert labels_of(spark, "wir fahren mit der license plate") == ""


def test_interval_rules_equal_brute_force(spark):
    rng = random.Random(2)
    values = [t for t in texts() if t and len(t) < 2000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(values)], "doc_id long, text string")
    places = licenses._places(df, sorted({r[1] for r in licenses.rules()}))
    found = {}
    for r in licenses.detections(places, spark).collect():
        found.setdefault(r.row, []).append(r)
    assert found
    for own in found.values():
        rng.shuffle(own)
        own.sort(key=lambda r: (r.first, -r.last, r.priority))
        outer = []
        for r in own:
            hidden = any(s.first <= r.first and s.last >= r.last for s in outer)
            assert r.inside == hidden
            if not hidden:
                outer.append(r)
        for i, r in enumerate(outer):
            sides = outer[max(0, i - 1) : i] + outer[i + 1 : i + 2]
            assert r.kept == all(s.last < r.first or s.first > r.last or s.priority > r.priority for s in sides)


def test_rows_without_id_repeated_rows_and_empty_table(spark):
    rows = [(None, "cc by nc"), (1, "cc by nc"), (1, "cc by nc"), (1, "plain")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_base) for r in licenses.scan(df).collect()) == [(0, 1), (1, 0), (1, 1), (1, 1)]
    assert licenses.scan(df.limit(0)).collect() == []
