"""License scan: ordered signature rules behind a keyword gate, in DataFrame operations only.

Words are runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII. A rule has a
keyword and patterns for the words before and behind it. Texts without any keyword are done at once;
elsewhere each place of a keyword opens a stretch of REACH words to either side, and the keyword's
rules, after a look for their most telling word, are tried there. A detection contained in another
is suppressed, equal ones but for the first rule, and of two that overlap the later rule's.

The three base phrases are rules like any other; their places count whether suppressed or not, and
their labels stay. Null texts count as empty: no words, labels "" and score 0. Each row is answered
on its own, so repeated rows and rows without an id are, too. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import ascii_lower, stored, text_of

#: Words to either side of a keyword that rules may look at; no rule spans more.
REACH = 16

#: Phrases and labels of the base rules; the keyword is marked.
BASE = {"under the mit *license*": "mit", "apache *license* version 2": "apache-2", "*cc* by nc": "cc-by-nc"}

#: Labels and the words, as a pattern, by which texts name the license. More special names first.
NAMES = {
    "agpl-3": "(?:gnu )?(?:agpl|affero general public)(?: license)?(?: version| v)? ?3(?: 0)?",
    "lgpl-2.1": "(?:gnu )?(?:lgpl|lesser general public)(?: license)?(?: version| v)? ?2 1",
    "lgpl-3": "(?:gnu )?(?:lgpl|lesser general public)(?: license)?(?: version| v)? ?3(?: 0)?",
    "gpl-2": "(?:gnu )?(?:gpl|general public)(?: license)?(?: version| v)? ?2(?: 0)?",
    "gpl-3": "(?:gnu )?(?:gpl|general public)(?: license)?(?: version| v)? ?3(?: 0)?",
    "agpl": "(?:gnu )?(?:agpl|affero general public)",
    "lgpl": "(?:gnu )?(?:lgpl|lesser general public)",
    "gpl": "(?:gnu )?(?:gpl|general public)",
    "apache-2": "apache(?: license)?(?: version| v)? ?2(?: 0)?",
    "apache-1.1": "apache(?: license)?(?: version| v)? ?1 1",
    "apache": "apache(?: software)?",
    "mit-0": "mit (?:0|no attribution)",
    "mit": "(?:mit|expat)",
    "bsd-2-clause": "(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)",
    "bsd-3-clause": "(?:new bsd|modified bsd|bsd 3 clause|3 clause bsd|three clause bsd)",
    "bsd-4-clause": "(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)",
    "bsd-0-clause": "(?:zero clause bsd|0bsd)",
    "bsd": "bsd(?: style)?",
    "mpl-1.1": "(?:mozilla public|mpl)(?: license)?(?: version| v)? ?1 1",
    "mpl-2": "(?:mozilla public|mpl)(?: license)?(?: version| v)? ?2(?: 0)?",
    "mpl": "(?:mozilla public|mpl)",
    "epl-1": "(?:eclipse public|epl)(?: license)?(?: version| v)? ?1(?: 0)?",
    "epl-2": "(?:eclipse public|epl)(?: license)?(?: version| v)? ?2(?: 0)?",
    "cddl-1": "(?:common development and distribution|cddl)(?: license)?(?: version| v)? ?1(?: 0)?",
    "eupl-1.2": "(?:european union public|eupl)(?: license)?(?: version| v)? ?1 2",
    "isc": "(?:isc|internet systems consortium)",
    "zlib": "(?:zlib|zlib libpng)",
    "boost-1": "(?:boost software|bsl)(?: license)?(?: version| v)? ?1(?: 0)?",
    "artistic-2": "artistic(?: license)?(?: version| v)? ?2(?: 0)?",
    "unlicense": "unlicense",
    "wtfpl": "(?:wtfpl|do what the fuck you want to public)",
    "python-2": "(?:python software foundation|psf)(?: license)?(?: version| v)? ?2(?: 0)?",
    "ofl-1.1": "(?:sil open font|ofl)(?: license)?(?: version| v)? ?1 1",
    "odbl-1": "(?:open database|odbl)(?: license)?(?: version| v)? ?1(?: 0)?",
    "cc0-1": "(?:cc0|creative commons zero)(?: version| v)? ?(?:1(?: 0)?)?",
    "cc-by-nc-sa": "(?:cc|creative commons) (?:by nc sa|attribution noncommercial sharealike)",
    "cc-by-nc-nd": "(?:cc|creative commons) (?:by nc nd|attribution noncommercial noderivatives)",
    "cc-by-nc": "(?:cc|creative commons) (?:by nc|attribution noncommercial)",
    "cc-by-sa": "(?:cc|creative commons) (?:by sa|attribution sharealike)",
    "cc-by-nd": "(?:cc|creative commons) (?:by nd|attribution noderivatives)",
    "cc-by": "(?:cc|creative commons) (?:by|attribution)",
}
#: How texts say so: words with the keyword marked, N for the name; how sure that is.
FORMS = [
    ("*spdx* license identifier N", 0.99),
    ("*licensed* under (?:the )?(?:terms of (?:the )?)?N(?: licen[cs]e)?", 0.95),
    ("(?:released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?N *license*", 0.95),
    ("(?:released|distributed|available|published) under (?:the )?(?:terms of (?:the )?)?N *licence*", 0.95),
    ("N *license*(?: version \\d+(?: \\d+)?)?", 0.8),
    ("N *licence*(?: version \\d+(?: \\d+)?)?", 0.8),
    ("(?:creativecommons|opensource|apache|gnu) org *licenses* N", 0.9),
    ("*license* (?:type |name |is )?N", 0.6),
]
#: Texts that say something of licensing without a license's name.
OTHERS = [
    ("all rights *reserved*", "all-rights-reserved", 0.5),
    ("permission is hereby *granted* free of charge", "mit-like", 0.7),
    ("*redistribution* and use in source and binary forms", "bsd-like", 0.7),
    ("this work is in the public *domain*", "public-domain", 0.7),
    ("dedicated to the public *domain*", "public-domain", 0.7),
]
BASE_WEIGHT = 0.9


def rules() -> list[tuple[int, str, str, str, str, str, float, bool]]:
    """Priority, keyword, telling word, left pattern, right pattern, label, weight, whether base.

    Priority follows the lists: base phrases, then forms by form and name, then the others."""
    listed = [(text, label, BASE_WEIGHT, True) for text, label in BASE.items()]
    listed += [(form.replace("N", name), label, w, False) for form, w in FORMS for label, name in NAMES.items()]
    listed += [(text, label, w, False) for text, label, w in OTHERS]
    found = []
    for priority, (text, label, weight, base) in enumerate(listed):
        left, keyword, right = text.split("*")
        left, right = left.rstrip(), right.strip() if right.startswith(" ") else right
        glue = "" if text.split("*")[2][:1] != " " else " "
        # Optional words directly behind the keyword bring their own space.
        behind = f"^({glue}{right})(?: |$)" if right else ""
        before = f"(?:^| )({left})$" if left else ""
        plain = re.sub(r"\((?:[^()]|\([^()]*\))*\)\??", " ", f"{left} {right}")
        telling = max((w for w in plain.split() if w.isalpha()), key=len, default="")
        found.append((priority, keyword, telling, before, behind, label, weight, base))
    return found


RULES = "priority int, keyword string, telling string, before string, behind string, label string, weight double, base boolean"


def _words(text: str):
    """Number of words of a column of words one space apart."""
    return F.expr(f"if({text} = '', 0, length({text}) - length(replace({text}, ' ', '')) + 1)")


def _places(docs: DataFrame, keywords: list[str]) -> DataFrame:
    """row, doc_id, n_words, places (array of keyword, its index, words before, words behind)."""
    plain = F.regexp_replace(ascii_lower(text_of(docs)), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    rows = docs.select("doc_id", F.trim(plain).alias("norm")).withColumn("row", F.monotonically_increasing_id())
    rows = rows.withColumn("n_words", _words("norm").cast("long"))
    gate = F.col("norm").rlike(f"(?:^| )(?:{'|'.join(keywords)})(?: |$)")
    rows = rows.withColumn("words", F.when(gate, F.split("norm", " ")).otherwise(F.array().cast("array<string>")))
    numbered = F.transform("words", lambda w, i: F.struct(w.alias("keyword"), i.alias("at")))
    rows = rows.withColumn("hits", F.filter(numbered, lambda h: h["keyword"].isin(keywords)))

    def around(hit):
        at = hit["at"]
        low = F.greatest(F.lit(0), at - REACH)
        before = F.array_join(F.slice(F.col("words"), low + 1, at - low), " ")
        behind = F.array_join(F.slice(F.col("words"), at + 2, F.lit(REACH)), " ")
        return F.struct(hit["keyword"].alias("keyword"), at.alias("at"), before.alias("left"), F.concat(F.lit(" "), behind).alias("right"))

    return stored(rows.select("row", "doc_id", "n_words", F.transform("hits", around).alias("places")), "license-places")


def detections(places: DataFrame, spark: SparkSession) -> DataFrame:
    """row, first, last (words, included), label, weight, base, kept of everything that rules match."""
    table = spark.createDataFrame(rules(), RULES)  # a few hundred rows
    hits = places.where(F.size("places") > 0).select("row", F.explode("places").alias("p")).select("row", "p.*")
    tried = hits.join(F.broadcast(table), "keyword")
    tried = tried.where(
        F.expr("(telling = '' or contains(left, telling) or contains(right, telling))")
        & F.expr("(before = '' or left rlike before)")
        & F.expr("(behind = '' or right rlike behind)")
    )
    spans = tried.withColumn("l", F.expr("if(before = '', '', regexp_extract(left, before, 1))")).withColumn(
        "r", F.expr("trim(if(behind = '', '', regexp_extract(right, behind, 1)))")
    )
    spans = spans.select(
        "row", (F.col("at") - _words("l")).alias("first"), (F.col("at") + _words("r")).alias("last"), "priority", "label", "weight", "base"
    )
    order = Window.partitionBy("row").orderBy("first", F.desc("last"), "priority")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    inside = spans.withColumn("inside", F.coalesce(reached >= F.col("last"), F.lit(False)))
    # What is left starts and ends in one order, so overlaps show between neighbours.
    apart = Window.partitionBy("row", "inside").orderBy("first", "last")
    beaten = ((F.lag("last").over(apart) >= F.col("first")) & (F.lag("priority").over(apart) < F.col("priority"))) | (
        (F.lead("first").over(apart) <= F.col("last")) & (F.lead("priority").over(apart) < F.col("priority"))
    )
    return inside.withColumn("kept", ~F.col("inside") & ~F.coalesce(beaten, F.lit(False)))


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    places = _places(docs, sorted({r[1] for r in rules()}))
    found = detections(places, docs.sparkSession)
    base, shown = F.col("base"), F.col("base") | F.col("kept")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("label")))), ",")
    by_row = found.groupBy("row").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(shown).alias("labels"),
        (1 - F.exp(F.sum(F.when(shown, F.log(1 - F.col("weight"))).otherwise(0.0)))).alias("score"),
    )
    return places.select("row", "doc_id", "n_words").join(by_row, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
