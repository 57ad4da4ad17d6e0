"""Engines against human labels: verdicts, combinations, confusion, containment, rates, correlations and trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratios as R
from ..functions.labels import confidence_of
from ..functions.order import running

#: What a human may have written, and what it means; anything else isn't scored.
HUMAN = {"si": True, "no": False}


def human_label(text: Column) -> Column:
    t = F.lower(F.trim(text))
    return F.when(t == "si", True).when(t == "no", False)


def flag_verdict(flag: Column, score: Column, present: Column) -> Column:
    """struct(verdict, score) of a True/False text; null for an absent row."""
    return F.when(present, F.struct((F.trim(flag) == "True").alias("verdict"), F.coalesce(score.try_cast("double"), F.lit(0.0)).alias("score")))


def count_verdict(n: Column, score: Column, present: Column) -> Column:
    """Positive for a count over 0; an empty count is 0, one that is no number gives no opinion."""
    count = F.when(F.coalesce(n, F.lit("")) == "", F.lit(0.0)).otherwise(n.try_cast("double"))
    return F.when(present & count.isNotNull(), F.struct((count.cast("bigint") > 0).alias("verdict"), F.coalesce(score.try_cast("double"), F.lit(0.0)).alias("score")))


def score_verdict(score: Column, present: Column, least: float = 0.5) -> Column:
    s = score.try_cast("double")
    return F.when(present & s.isNotNull(), F.struct((s >= least).alias("verdict"), s.alias("score")))


def tag_verdict(tags: Column, label: str, present: Column, least: float = 0.5, anchored: bool = False) -> Column:
    """From a 'label:conf|...' text. `present` says whether the row has the column, as a CSV reader makes empty texts null."""
    s = F.coalesce(confidence_of(tags, label, anchored), F.lit(0.0))
    return F.when(present, F.struct((s >= least).alias("verdict"), s.alias("score")))


def engine_scores(verdicts: DataFrame, human: DataFrame, key: str) -> DataFrame:
    """(engine, confusion metrics) from (key, engine, verdict) and (key, truth); rows without opinion or label aren't scored."""
    rows = verdicts.where("verdict is not null").join(human.where("truth is not null"), key)
    return rows.groupBy("engine").agg(*R.confusion(F.col("verdict"), F.col("truth")))


def combination_scores(wide: DataFrame, engines: list[str], truth: str) -> DataFrame:
    """(engines, rule, confusion metrics) for all subsets of two or more engines, under any and all.

    wide has one boolean column for each engine; a subset is scored on rows where all of it has an opinion. Each pattern of
    opinions is counted once, which leaves 2 * 3^E rows at most for E engines, and only these meet the subsets. Engines are bits: a subset s is
    known where s & known = s, agrees under all where s & yes = s, and under any where s & yes isn't 0.
    """
    if len(engines) > 16:
        raise ValueError("more than 16 engines have too many subsets")
    bits = lambda holds: sum((F.when(holds(F.col(e)), F.lit(1 << i)).otherwise(0) for i, e in enumerate(engines)), F.lit(0))
    known, yes = bits(lambda c: c.isNotNull()), bits(lambda c: F.coalesce(c, F.lit(False)))
    patterns = wide.where(F.col(truth).isNotNull()).groupBy(F.col(truth).alias("truth"), known.alias("known"), yes.alias("yes")).agg(F.count(F.lit(1)).alias("times"))
    subsets = F.filter(F.sequence(F.lit(0), F.lit((1 << len(engines)) - 1)), lambda s: (F.bit_count(s) > 1) & (s.bitwiseAND(F.col("known")) == s))
    each = patterns.withColumn("s", F.explode(subsets))
    shared = F.col("s").bitwiseAND(F.col("yes"))
    rules = F.array(F.struct(F.lit("any").alias("rule"), (shared != 0).alias("verdict")), F.struct(F.lit("all").alias("rule"), (shared == F.col("s")).alias("verdict")))
    each = each.select("truth", "times", "s", F.inline(rules))
    names = F.array_join(F.array_compact(F.array(*[F.when(F.col("s").bitwiseAND(1 << i) != 0, e) for i, e in enumerate(engines)])), "+")
    scored = each.groupBy("s", "rule").agg(*R.confusion(F.col("verdict"), F.col("truth"), F.col("times")))
    return scored.withColumn("engines", names).select("engines", *[c for c in scored.columns if c != "s"])


def decide(wide: DataFrame, rules: dict[str, tuple[str, list[str]]]) -> DataFrame:
    """Final signals by rule: name -> ('any' | 'all', engine columns). Without opinions there is none."""
    out = wide
    for name, (rule, engines) in rules.items():
        columns = [F.col(e) for e in engines]
        value = columns[0] if len(columns) == 1 else (F.greatest if rule == "any" else F.least)(*columns)
        out = out.withColumn(name, value)
    return out


def positive_rates(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("engine").agg(F.count("verdict").alias("n"), F.round(F.avg(F.col("verdict").cast("double")), 6).alias("rate"))


def verdict_counts(reviews: DataFrame) -> DataFrame:
    """Counts by verdict over reviews that went well."""
    return reviews.where("status = 'ok'").groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def containment(rows: DataFrame, truths: str, pred: str, targets: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Multi-label evaluation over rows whose truths meet the targets.

    Returns (precision by predicted class: the prediction lies in the truths), (strict and lenient recall by true class: rows with
    just this target, rows with it among others) and (what rows of a true class were predicted as).
    """
    target = F.array(*[F.lit(t) for t in targets])
    scored = rows.where(F.arrays_overlap(F.col(truths), target)).withColumn("true_targets", F.array_intersect(F.col(truths), target))
    hit = F.array_contains("true_targets", F.col(pred))
    precision = scored.groupBy(F.col(pred).alias("label")).agg(F.count(F.lit(1)).alias("n"), F.round(R.ratio(F.count_if(hit), F.count(F.lit(1))), 6).alias("precision"))
    each = scored.select(F.explode("true_targets").alias("label"), F.col(pred).alias("pred"), hit.alias("hit"), (F.size("true_targets") == 1).alias("only"))
    recall = each.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(R.ratio(F.count_if(F.col("pred") == F.col("label")), F.count(F.lit(1))), 6).alias("strict_recall"),
        F.round(R.ratio(F.count_if("hit"), F.count(F.lit(1))), 6).alias("lenient_recall"),
    )
    return precision, recall, each.groupBy("label", "pred").agg(F.count(F.lit(1)).alias("n"))


def average_rank(rows: DataFrame, column: str, out: str) -> DataFrame:
    """(value, average rank) for each distinct value, from counts; the values, not the rows, are ordered."""
    counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return running(counts, ["value"], F.col("n"), "before").select("value", (F.col("before") + (F.col("n") + 1) / 2).alias(out))


def correlations(rows: DataFrame, a: str, b: str) -> DataFrame:
    """One row: n, exact agreement, Pearson and Spearman of two columns."""
    both = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
    ra, rb = average_rank(both, "a", "ra"), average_rank(both, "b", "rb")
    ranked = both.join(ra.withColumnRenamed("value", "a"), "a").join(rb.withColumnRenamed("value", "b"), "b")
    return ranked.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("a") == F.col("b")).cast("double")), 6).alias("exact"),
        F.round(F.corr("a", "b"), 6).alias("pearson"), F.round(F.corr("ra", "rb"), 6).alias("spearman"),
    )


def decade_trend(rows: DataFrame, year: Column, metrics: list[str], first: int = 1900, last: int = 2029) -> DataFrame:
    """(decade, n, mean of each metric) over plausible years."""
    known = rows.withColumn("__year", year).where(F.col("__year").between(first, last))
    decade = (F.floor(F.col("__year") / 10) * 10).cast("int")
    return known.groupBy(decade.alias("decade")).agg(F.count(F.lit(1)).alias("n"), *[F.round(F.avg(m), 4).alias(m) for m in metrics])


def gap(rows: DataFrame, year: Column, metric: str, cut: int, until: int, threshold: float) -> DataFrame:
    """One row: mean before the cut, mean from it until `until`, their difference and whether it exceeds the threshold."""
    early, late = F.avg(F.when(year < cut, F.col(metric))), F.avg(F.when(year.between(cut, until), F.col(metric)))
    return rows.agg(F.round(early, 4).alias("early"), F.round(late, 4).alias("late"), F.round(early - late, 4).alias("gap"), F.coalesce(F.abs(early - late) > threshold, F.lit(False)).alias("exceeds"))


def overlap(verdicts: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """(engine, n, scored): how many of the base's ids each engine has an entry for; one without any isn't scored, and says so here.

    Ids count once. The base's ids meet the engines' distinct ids in one join.
    """
    ids = base.select(key).distinct().withColumn("__base", F.lit(True))
    rows = verdicts.select("engine", key).distinct().join(ids, key, "left")
    n = F.count_if(F.col("__base"))
    return rows.groupBy("engine").agg(n.alias("n"), (n > 0).alias("scored"))


def overlapping(verdicts: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """The entries of the engines that share an id with the base; the others are left out as a whole."""
    scored = overlap(verdicts, base, key).where("scored").select("engine")
    return verdicts.join(F.broadcast(scored), "engine", "left_semi")  # a row for each engine
