"""Text quality without labels: overlapping heuristic labellers, weighed by expectation-maximisation,
whose posteriors train a hashed linear scorer.

Each labeller votes good, bad or nothing on a document. The votes of all documents are counted by
pattern (3 ** labellers patterns at most, whatever the input), and EM over that table estimates how
often each labeller is right in either class. A pattern's posterior is the weak label. The scorer, a
logistic regression over hashed word shapes, is trained with these on a bounded sample of documents,
those with the smallest hashed texts, and scores all documents over their whole texts.

Null texts count as empty; a text without words is bad. Rows without an id and repeated rows are
scored like any other. If the labellers agree on one class for all, its posterior is the score.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import stored, text_of

#: Documents that the scorer is trained on, hashed features, passes of the training.
SAMPLE, FEATURES, PASSES = 20_000, 1 << 14, 60
#: Change of the class share at which EM ends.
TOLERANCE = 1e-9
GOOD, BAD, NONE = 1, 0, 2
#: A labeller sees one kind of fault; it misses many bad rows but calls at most this share of good rows bad.
#: Without that bound EM may take one kind of fault for the bad class and the others for good.
WRONGS = 0.01


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(NONE)


def _measured(rows: DataFrame) -> DataFrame:
    """``text`` and what the labellers look at."""
    text, letters = F.col("text"), F.greatest(F.regexp_count("text", F.lit(r"\p{L}")), F.lit(1))
    rows = rows.withColumn("words", F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    rows = rows.withColumn("n", F.size("words")).withColumn("least", F.greatest(F.col("n"), F.lit(1)))
    lines = F.filter(F.split("text", r"\n"), lambda w: F.trim(w) != "")
    again = F.zip_with(F.slice("words", 2, F.greatest(F.col("n") - 1, F.lit(0))), F.slice("words", 1, F.greatest(F.col("n") - 1, F.lit(0))), lambda a, b: (a == b).cast("int"))
    return rows.select(
        "*",
        (F.regexp_count("text", F.lit(r"[^\p{L}\p{N}\s]")) / F.greatest(F.length(text), F.lit(1))).alias("signs"),
        (F.regexp_count("text", F.lit(r"\p{Lu}")) / letters).alias("capitals"),
        (F.size(F.array_distinct("words")) / F.col("least")).alias("distinct"),
        (F.aggregate(again, F.lit(0), lambda s, x: s + x) / F.col("least")).alias("again"),
        (F.size(F.filter("words", lambda w: w == "|")) / F.col("least")).alias("bars"),
        (F.regexp_count("text", F.lit(r"[.,;:!?](?=\s|$)")) / F.col("least")).alias("stops"),
        (F.length(text) / F.col("least")).alias("letters"),
        (1 - F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1))).alias("lines"),
    )


def labellers() -> dict[str, Column]:
    """The votes, by name; each looks at one kind of fault."""
    c = F.col
    return {
        "signs": _vote(c("signs").between(0.005, 0.05), (c("signs") > 0.08) & (c("n") >= 20)),
        "capitals": _vote(c("capitals") < 0.1, c("capitals") > 0.3),
        "distinct": _vote((c("distinct") > 0.6) & (c("n") >= 20), (c("distinct") < 0.4) & (c("n") >= 20)),
        "again": _vote((c("again") < 0.03) & (c("n") >= 20), c("again") > 0.2),
        "bars": _vote(c("bars") == 0, c("bars") > 0.1),
        "stops": _vote(c("stops").between(0.05, 0.25), ((c("stops") > 0.4) | (c("stops") < 0.01)) & (c("n") >= 20)),
        "letters": _vote(c("letters").between(4, 7.5), (c("letters") < 3) | (c("letters") > 9)),
        "lines": _vote((c("lines") < 0.1) & (c("n") >= 20), c("lines") > 0.3),
        "length": _vote(c("n") >= 30, c("n") < 2),
    }


def estimate(votes: np.ndarray, counts: np.ndarray, wrongs: float = WRONGS, most: int = 2_000) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of good for each pattern, [class, labeller, vote] probabilities, share of good.

    ``votes`` has a row for each pattern. A vote that isn't cast says nothing. EM starts from the share of good votes, which also fixes
    which class is the good one."""
    cast = (votes == GOOD).sum(axis=1) + (votes == BAD).sum(axis=1)
    posterior = ((votes == GOOD).sum(axis=1) + 0.5) / (cast + 1)
    hot = np.stack([votes == v for v in (BAD, GOOD)], axis=2).astype(float)  # pattern, labeller, vote
    share = None
    for _ in range(most):
        weight = np.stack([counts * (1 - posterior), counts * posterior])
        table = np.einsum("cp,plv->clv", weight, hot) + 1.0  # as if each vote had been seen once more
        table /= table.sum(axis=2, keepdims=True)
        table[GOOD, :, BAD] = np.minimum(table[GOOD, :, BAD], wrongs)
        table[GOOD, :, GOOD] = 1 - table[GOOD, :, BAD]
        new = (weight[1].sum() + 1) / (counts.sum() + 2)
        logs = np.einsum("plv,clv->cp", hot, np.log(table)) + np.log([[1 - new], [new]])
        posterior = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        if share is not None and abs(new - share) < TOLERANCE:
            break
        share = new
    return posterior, table, float(new)


def _features() -> Column:
    """Word shapes (capitals A, other letters a, digits 9, runs as one, signs as they are) and coarse measures."""
    shapes = F.regexp_replace("text", r"\p{Lu}+", "A")
    shapes = F.regexp_replace(F.regexp_replace(shapes, r"(?:(?!A)\p{L})+", "a"), r"\p{N}+", "9")
    words = F.filter(F.split(shapes, r"\s+"), lambda w: w != "")
    short = F.transform(words, lambda w: F.substring(w, 1, 12))
    tenth = lambda c: F.concat(F.lit(f"#{c}:"), F.floor(F.col(c) * 10).cast("string"))
    # As often as a tenth of the words, so that a long text does not drown them.
    own = F.array(*[tenth(c) for c in ("distinct", "again", "lines", "capitals", "stops")], F.concat(F.lit("#n:"), F.floor(F.log2(F.col("n") + 1)).cast("string")))
    return F.concat(short, F.flatten(F.array_repeat(own, F.greatest(F.ceil(F.col("n") / 10), F.lit(1)).cast("int"))))


def quality(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, weak_label (posterior of good), score (0 to 1), predicted (1 good), kept."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", text_of(docs).alias("text"))
    votes = labellers()
    pattern = F.concat(*[v.cast("string") for v in votes.values()]).alias("pattern")
    shaped = _measured(rows).withColumn("shapes", _features())
    hashed = HashingTF(inputCol="shapes", outputCol="counts", numFeatures=FEATURES).transform(shaped)
    marked = stored(
        Normalizer(inputCol="counts", outputCol="features").transform(hashed).select(
            "doc_id", pattern, F.xxhash64("text").alias("at"), "features"
        ),
        "quality-features",
    )
    counted = sorted((r.pattern, r["count"]) for r in marked.groupBy("pattern").count().collect())  # 3 ** labellers at most
    if not counted:
        kind = rows.schema["doc_id"].dataType.simpleString()
        return spark.createDataFrame([], f"doc_id {kind}, weak_label double, score double, predicted int, kept boolean")
    table = np.array([[int(v) for v in p] for p, _ in counted])
    posterior, _, _ = estimate(table, np.array([n for _, n in counted], dtype=float))
    weak = spark.createDataFrame([(p, float(x)) for (p, _), x in zip(counted, posterior, strict=True)], "pattern string, weak_label double")
    labelled = marked.join(F.broadcast(weak), "pattern")
    # Text hash first: the sample depends on texts alone. Copies teach once.
    some = labelled.dropDuplicates(["at"]).orderBy("at").limit(sample).select("features", "weak_label")
    both = F.explode(F.array(*[F.struct(F.lit(float(y)).alias("label"), w.alias("weight")) for y, w in ((1, F.col("weak_label")), (0, 1 - F.col("weak_label")))]))
    lessons = stored(some.select("features", both.alias("lesson")).select("features", "lesson.*").where("weight > 0"), "quality-lessons")
    if lessons.select("label").distinct().count() < 2:
        scored = labelled.withColumn("score", F.col("weak_label"))
    else:
        learner = LogisticRegression(maxIter=PASSES, regParam=1e-4, weightCol="weight")
        scored = learner.fit(lessons).transform(labelled).withColumn("score", vector_to_array("probability")[1])
    good = F.col("score") >= 0.5
    return scored.select("doc_id", "weak_label", "score", good.cast("int").alias("predicted"), good.alias("kept"))

