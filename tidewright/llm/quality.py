"""Quality score: a sparse ensemble of conjunctive rules over text statistics.

Trees are grown on labelled rows; every path from a root to a node is a rule, a conjunction of
thresholds.  A logistic regression with lasso penalty keeps few of them, and those become one
Spark column expression.  Statistics are built-in expressions over the whole text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..durable import materialise
from .support import BLANKS, text_of

#: At most so many labelled rows are used for fitting.
SAMPLE = 20_000
TREES, DEPTH, LASSO = 20, 3, 0.001
THRESHOLD = 0.3


FEATURES = (
    "log_words", "word_length", "upper_share", "digit_share", "symbol_share", "odd_word_share", "stop_share",
    "comma_share", "distinct_share", "line_words", "distinct_lines", "exclaim_share",
)

_SYMBOLS = r"[#$%&*|<>{}\[\]=_~^\\@/+]"
_ODD_WORD = r"(^|\s)[^\p{L}\p{N}\s]+(?=\s|$)"


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the statistics of the whole text; columns of the same names are replaced.

    Shares are 0 where there is nothing to take them of, so an empty or null text has 0 throughout.
    """
    whole, words, lines = F.col("_whole"), F.col("_words"), F.col("_lines")
    n_words = F.size(words)

    def share(part: Column, of: Column) -> Column:
        return F.when(of > 0, part / of).otherwise(F.lit(0.0)).cast("double")

    def count(pattern: str) -> Column:
        return F.regexp_count(whole, F.lit(pattern))

    numbers = {
        "log_words": F.log1p(n_words.cast("double")),
        "word_length": share(F.length(whole), n_words),
        "upper_share": share(count(r"\p{Lu}"), F.length(whole)),
        "digit_share": share(count("[0-9]"), F.length(whole)),
        "symbol_share": share(count(_SYMBOLS), n_words),
        "odd_word_share": share(count(_ODD_WORD), n_words),
        "stop_share": share(count(r"[.?](\s|$)"), n_words),
        "comma_share": share(count(","), n_words),
        "distinct_share": share(F.size(F.array_distinct(words)), n_words),
        "line_words": share(n_words, F.size(lines)),
        "distinct_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
        "exclaim_share": share(count("!"), n_words),
    }
    kept = docs.drop(*FEATURES)
    # Cut once: the optimiser keeps a projection whose results are used several times.
    read = kept.withColumns({
        "_whole": text_of(text),
        "_words": F.array_remove(F.split(text_of(text), BLANKS), ""),
        "_lines": F.array_remove(F.split(text_of(text), r"\s*\n\s*"), ""),
    })
    return read.select(*kept.columns, *[numbers[name].alias(name) for name in FEATURES])


# A condition is (statistic, is it at most, threshold); a rule is a conjunction of them.
Condition = tuple[str, bool, float]


@dataclass(frozen=True)
class RuleModel:
    """Weights of conjunctive rules and a constant."""

    rules: tuple[tuple[Condition, ...], ...]
    weights: tuple[float, ...]
    constant: float

    def score(self) -> Column:
        """Probability of label 1 over columns named like the statistics."""
        total = F.lit(self.constant)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def holds(rule: tuple[Condition, ...]) -> Column:
    """Do all conditions of a rule hold?"""
    out = F.lit(True)
    for name, at_most, threshold in rule:
        out = out & ((F.col(name) <= threshold) if at_most else (F.col(name) > threshold))
    return out


def tree_rules(debug: str) -> list[tuple[Condition, ...]]:
    """Paths from the roots to all nodes below them, read from the text of a tree ensemble.

    A line reads ``If (feature 3 <= 0.5)`` or ``Else (feature 3 > 0.5)``, indented by its depth.
    """
    rules, path = [], []
    for line in debug.splitlines():
        words = line.replace("(", " ").replace(")", " ").split()
        if words[:1] not in (["If"], ["Else"]):
            continue
        depth = len(line) - len(line.lstrip())
        path = [p for p in path if p[0] < depth]
        path.append((depth, (FEATURES[int(words[2])], words[3] == "<=", float(words[4]))))
        rules.append(simplest([c for _, c in path]))
    return sorted(set(rules))


def simplest(conditions: list[Condition]) -> tuple[Condition, ...]:
    """Only the tightest threshold of each statistic and side, in a fixed order."""
    tight: dict[tuple[str, bool], float] = {}
    for name, at_most, value in conditions:
        old = tight.get((name, at_most), value)
        tight[name, at_most] = min(old, value) if at_most else max(old, value)
    return tuple(sorted((n, s, v) for (n, s), v in tight.items()))


def fit(labelled: DataFrame, label: str, seed: int = 7) -> RuleModel:
    """Grow trees, take their paths as rules and weigh them.

    ``labelled`` has the statistics and a label 0 or 1, in bounded number.  With a single label, or
    none, there are no rules and the score is the share of label 1, slightly drawn to a half.
    """
    rows = materialise(
        labelled.select(F.col(label).cast("double").alias("_label"), *FEATURES).orderBy("_label", *FEATURES).coalesce(1),
        "quality-sample",
    )
    shares = {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()}
    ones, n = shares.get(1.0, 0), sum(shares.values())
    if len(shares) < 2:
        share = (ones + 0.5) / (n + 1)
        return RuleModel((), (), math.log(share / (1 - share)))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        labelCol="_label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, maxBins=64, minInstancesPerNode=5,
        subsamplingRate=0.7, featureSubsetStrategy="sqrt", seed=seed,
    )
    rules = tree_rules(forest.fit(vectors).toDebugString)
    fired = rows.select("_label", array_to_vector(F.array(*[holds(r).cast("double") for r in rules])).alias("fired"))
    lasso = LogisticRegression(labelCol="_label", featuresCol="fired", elasticNetParam=1.0, regParam=LASSO, maxIter=100)
    model = lasso.fit(fired)
    kept = [(r, float(w)) for r, w in zip(rules, model.coefficients.toArray(), strict=True) if w]
    return RuleModel(tuple(r for r, _ in kept), tuple(w for _, w in kept), float(model.intercept))


def held_out(doc_id: Column) -> Column:
    """Rows that learning never sees: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text: str = "text") -> RuleModel:
    """Fit on the ``sample`` labelled rows outside the held-out part whose ids hash lowest.

    The sample is bounded, so its ids are broadcast and only the texts of those rows are read on.
    Rows without id or label are not used; an id with both labels counts once for each.
    """
    usable = (
        labels.where(F.col(id_col).isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col(id_col)))
        .select(F.col(id_col).alias("_id"), F.col("quality").alias("_label"), F.xxhash64(id_col).alias("_hash"))
        .distinct()
    )
    # Where there are more, rows far beyond the sample's last hash never leave their tasks.
    n = usable.count()
    if n > 2 * sample:
        low = usable.where(F.col("_hash") < int((1.5 * sample / n - 0.5) * 2.0**64))
        usable = low if low.count() >= sample else usable
    chosen = usable.orderBy("_hash", "_label", "_id").limit(sample).drop("_hash")
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text).alias("text"))
    joined = texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("_label", "text")
    return fit(with_statistics(joined), "_label")


def scored(docs: DataFrame, model: RuleModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` with ``score`` and ``predicted`` (1 from ``threshold`` on) added.

    Columns named like a statistic, ``score`` or ``predicted`` are set aside while scoring and come
    back as they were, except the last two, which are replaced.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    boxed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col(text).alias("text"))
    out = with_statistics(boxed).withColumn("score", model.score())
    return out.select("_row.*", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: RuleModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``scored`` that are predicted 1.

    The prediction passes a generator, below which the optimiser pushes no filter.  Pushed down to
    the scan, the filter would compute the statistics of a text anew for every condition of a rule.
    """
    out = scored(docs, model, text, threshold)
    return out.withColumn("predicted", F.explode(F.array("predicted"))).where("predicted = 1")
