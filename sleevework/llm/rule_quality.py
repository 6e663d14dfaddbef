"""Text quality by a sparse ensemble of rules: tree paths over text statistics, lasso weights, column expressions."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sleevework.llm.shared import WORD, saved, text_of

MOST_LABELS = 20_000  # labelled rows that are learnt from, those of the smallest hashes
TREES, DEPTH, PENALTY = 24, 3, 0.0005
THRESHOLD = 0.3
BLANK_SET = r"\x20\x09-\x0D"


def _count_of(text: Column, others: str) -> Column:
    return F.char_length(F.regexp_replace(text, others, ""))


def statistics(text: Column) -> dict[str, Column]:
    """Numbers that describe a whole text without regard to its language; all are 0 for an empty one."""
    words, chars = F.regexp_count(text, F.lit(WORD)), F.char_length(text)
    distinct = F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))))
    short = F.regexp_count(text, F.lit(rf"(?<![^{BLANK_SET}])[^{BLANK_SET}]{{1,3}}(?![^{BLANK_SET}])"))
    lines = F.size(F.split(text, "\n"))

    def per(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    return {
        "words": words.cast("double"),
        "letters": per(_count_of(text, r"[^\p{L}]+"), chars),
        "capitals": per(_count_of(text, r"[^\p{Lu}]+"), chars),
        "digits": per(_count_of(text, r"[^0-9]+"), chars),
        "stops": per(_count_of(text, r"[^.,;:?]+"), words),
        "marks": per(_count_of(text, r"[^!#$%&*+<=>@^_{|}~\\/\[\]]+"), words),
        "word_length": per(chars, words),
        "short_words": per(short, words),
        "distinct_words": per(distinct, words),
        "line_words": per(words, lines),
        "distinct_lines": per(F.size(F.array_distinct(F.split(text, "\n"))), lines),
    }


Rule = tuple[tuple[str, str, float], ...]


@dataclass(frozen=True)
class RuleModel:
    """``score`` = 1 / (1 + exp(-(intercept + the weights of the rules that hold)))."""

    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self, value: Callable[[str], Column]) -> Column:
        """The score of the statistics that ``value`` gives by name."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(_holds(rule, value), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _holds(rule: Rule, value: Callable[[str], Column]) -> Column:
    out = F.lit(True)
    for name, sign, bound in rule:
        out = out & (value(name) <= bound if sign == "<=" else value(name) > bound)
    return out


def tree_paths(description: str, names: list[str]) -> list[Rule]:
    """The conditions from the root to every node, from the printed form of one or more trees."""
    found: dict[Rule, None] = {}
    path: list[tuple[int, tuple[str, str, float]]] = []  # (indentation, condition)
    for line in description.splitlines():
        indent = len(line) - len(line.lstrip())
        path = [p for p in path if p[0] < indent]
        got = re.match(r"(?:If|Else) \(feature (\d+) (<=|>) ([^)]+)\)", line.strip())
        if got:
            path.append((indent, (names[int(got[1])], got[2], float(got[3]))))
            found[_tightest([p[1] for p in path])] = None
    return list(found)


def _tightest(conditions: list[tuple[str, str, float]]) -> Rule:
    """One bound for each statistic and side."""
    best: dict[tuple[str, str], float] = {}
    for name, sign, bound in conditions:
        known = best.get((name, sign), bound)
        best[name, sign] = min(known, bound) if sign == "<=" else max(known, bound)
    return tuple((n, s, b) for (n, s), b in sorted(best.items()))


def learn(docs: DataFrame, labels: DataFrame, learnable: Column, most: int = MOST_LABELS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> RuleModel:
    """Fit the rules to the labelled documents for which ``learnable`` (over the label's ``doc_id``) holds.

    At most ``most`` labels are used, those whose ids have the smallest hashes. An id that is labelled several
    times counts once, as 1 if at least half of its labels are; null ids and null labels are left out. With a
    single class or no labels the model has no rules and its score is the share of 1 among them (0.5 if none).
    """
    known = labels.select(F.col(id_col).alias("id_"), F.col(label_col).cast("double").alias("mark_")).where("id_ is not null and mark_ is not null")
    known = known.groupBy("id_").agg((F.avg("mark_") >= 0.5).cast("double").alias("mark_"))
    chosen = known.withColumn(id_col, F.col("id_")).where(learnable).select("id_", "mark_").orderBy(F.xxhash64("id_"), "id_").limit(most)
    texts = docs.select(F.col(id_col).alias("own_"), text_of(text_col).alias("text_"))
    sample = texts.join(F.broadcast(chosen), F.col("own_") == F.col("id_"))  # no more than ``most`` rows are sent out
    made = statistics(F.col("text_"))
    names = list(made)
    rows = saved(sample.select(F.col("mark_").alias("label"), *[c.alias(n) for n, c in made.items()]), "quality-sample")
    count, ones = rows.agg(F.count("*"), F.sum("label")).first()
    share = (ones or 0.0) / count if count else 0.5
    if not count or share in (0.0, 1.0):
        bounded = min(max(share, 1e-6), 1 - 1e-6)
        return RuleModel(math.log(bounded / (1 - bounded)), ())

    vectors = rows.select("label", array_to_vector(F.array(*names)).alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=64, featureSubsetStrategy="onethird", subsamplingRate=0.7, seed=11, minInstancesPerNode=5)
    rules = tree_paths(forest.fit(vectors).toDebugString, names)
    held = F.array(*[_holds(r, F.col).cast("double") for r in rules])
    marked = saved(rows.select("label", held.alias("held")), "quality-rules").select("label", array_to_vector("held").alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=80, tol=1e-6, standardization=False)
    fitted = lasso.fit(marked)
    weights = fitted.coefficients.toArray().tolist()
    return RuleModel(float(fitted.intercept), tuple((r, w) for r, w in zip(rules, weights) if w != 0.0))


def scored(docs: DataFrame, model: RuleModel, text_col: str = "text", name: str = "quality_score") -> DataFrame:
    """``docs`` with the score of each whole text (null counts as empty); other columns stay as they are."""
    made = statistics(text_of(text_col))
    holder = F.col("statistics_of_text_")
    wide = docs.withColumn("all_statistics_", F.struct(*[c.alias(n) for n, c in made.items()]))
    # behind the one-element explode no filter on the score can be rewritten to work the statistics out for every rule
    once = wide.select(*docs.columns, F.explode(F.array("all_statistics_")).alias("statistics_of_text_"))
    return once.withColumn(name, model.score(lambda n: holder[n])).drop("statistics_of_text_")
