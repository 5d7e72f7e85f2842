"""Label audits over ``(row_id, data, untrustworthy_label)``: structure, confident learning, review and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.core import h32, ratio, rnd
from plumbline.operators.ordering import exact_quantiles, rank_rows, rolling

LABEL, DATA = "untrustworthy_label", "data"


# --- structural checks -----------------------------------------------------------------------------------------

def audit_nulls(df: DataFrame) -> DataFrame:
    def empty(c: str) -> Column:
        return F.count_if(F.col(c).isNull() | (F.col(c) == ""))

    return df.agg(empty(DATA).alias("null_data"), empty(LABEL).alias("null_label"))


def audit_unknown_labels(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Labels outside the list (a missing label counts as outside) with their rows."""
    known = F.coalesce(F.col(LABEL).isin(*labels), F.lit(False))
    return df.where(~known).groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"))


def audit_conflicting_duplicates(df: DataFrame) -> DataFrame:
    """Same text with more than one label; texts are compared by digest, so only 64 characters per row are shuffled."""
    g = df.where(F.col(DATA).isNotNull()).groupBy(F.sha2(DATA, 256).alias("data_sha")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(F.col(LABEL)).alias("n_distinct_labels"), F.min("row_id").alias("first_row_id"))
    return g.where("n_distinct_labels > 1")


def audit_length_fingerprint(df: DataFrame) -> DataFrame:
    n = F.length(DATA)
    return df.groupBy(LABEL).agg(rnd(F.avg(n), 1).alias("mean"), rnd(F.stddev_samp(n), 1).alias("std"), F.count(n).alias("count"))


def provenance_report(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """The structural checks as one table ``(check, n)``."""
    nulls = audit_nulls(df).select(F.inline(F.array(
        F.struct(F.lit("null or empty data").alias("check"), F.col("null_data").alias("n")),
        F.struct(F.lit("null or empty label").alias("check"), F.col("null_label").alias("n")))))
    unknown = audit_unknown_labels(df, labels).agg(F.lit("labels outside the set").alias("check"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    dup = audit_conflicting_duplicates(df).agg(F.lit("duplicate data with conflicting labels").alias("check"), F.count(F.lit(1)).alias("n"))
    return nulls.unionByName(unknown).unionByName(dup)


def drift_label_set(df: DataFrame, period: str, label: str) -> DataFrame:
    """Labels that appear or vanish from one period to the next (labels per period are few)."""
    sets = df.select(period, label).distinct().groupBy(period).agg(F.sort_array(F.collect_set(label)).alias("labels"))
    w = Window.orderBy(period)  # one row per period
    before = F.lag("labels").over(w)
    return sets.withColumn("__b", before).select(
        period, F.size("labels").alias("n_labels"),
        F.when(F.col("__b").isNotNull(), F.array_join(F.array_except("labels", "__b"), ",")).alias("appeared"),
        F.when(F.col("__b").isNotNull(), F.array_join(F.array_except("__b", "labels"), ",")).alias("vanished"))


def order_violations(df: DataFrame, source: str, row_id: str, ts: str) -> DataFrame:
    """Per source: rows whose time is before the time of the row with the next lower id."""
    pairs = rolling(df.select(source, row_id, ts), [source], row_id, row_id, 2, lambda w: {"__prev": F.first(ts).over(w)})
    return pairs.groupBy(source).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("__prev") > F.col(ts)).alias("n_out_of_order"))


# --- confident learning ----------------------------------------------------------------------------------------

def label_index(df: DataFrame, labels: Sequence[str], unknown: str = "exclude") -> DataFrame:
    """Add ``y``, the position of the given label; an unknown label is excluded or taken as the first class."""
    pos = F.array_position(F.array(*[F.lit(x) for x in labels]), F.coalesce(F.col(LABEL), F.lit(""))).cast("int") - 1
    if unknown == "first":
        return df.withColumn("y", F.greatest(pos, F.lit(0)))
    return df.withColumn("y", pos).where("y >= 0")


def _first_argmax(probs: Column) -> Column:
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def self_confidence(df: DataFrame) -> DataFrame:
    """Probability of the given label, and the model's first best class with its probability."""
    p = F.col("probs")
    return df.withColumns({"self_confidence": p[F.col("y")], "model_pred": _first_argmax(p), "model_top_prob": F.array_max(p)})


def class_thresholds(df: DataFrame, k: int) -> list[float | None]:
    """Mean probability of a class over the rows given that class (k numbers on the driver)."""
    got = {r["y"]: r["t"] for r in df.groupBy("y").agg(F.avg(F.col("probs")[F.col("y")]).alias("t")).collect()}
    return [got.get(i) for i in range(k)]


def confident_guess(df: DataFrame, thresholds: Sequence[float | None]) -> DataFrame:
    """Add ``guess``: the first most probable class among those above their threshold, NULL if none."""
    p = F.col("probs")
    kept = F.array(*[F.when(p[i] >= F.lit(t - 1e-6), p[i]) if t is not None else F.lit(None).cast("double") for i, t in enumerate(thresholds)])
    top = F.array_max(kept)
    return df.withColumn("guess", F.when(top.isNotNull(), F.array_position(kept, top).cast("int") - 1))


def confident_joint(df: DataFrame, k: int) -> DataFrame:
    """Counts of (given, guess), and the counts rescaled so that each row sums to the rows given that label."""
    cells = confident_guess(df, class_thresholds(df, k)).groupBy(F.col("y").alias("given"), "guess").agg(F.count(F.lit(1)).alias("n"))
    # one pass gives both the joint (guess present) and the rows per given label; k * (k + 1) rows from here on
    grid = df.sparkSession.createDataFrame([(a, b) for a in range(k) for b in [*range(k), None]], "given int, guess int")
    full = grid.join(cells, grid["given"].eqNullSafe(cells["given"]) & grid["guess"].eqNullSafe(cells["guess"]), "left").select(
        grid["given"], grid["guess"], F.coalesce("n", F.lit(0)).alias("seen"))
    joint = F.when(F.col("given") == F.col("guess"), F.greatest("seen", F.lit(1))).when(F.col("guess").isNotNull(), F.col("seen"))
    w = Window.partitionBy("given")
    full = full.withColumn("n", joint).withColumns({"size": F.sum("seen").over(w), "t": F.sum("n").over(w)})
    return full.where("guess is not null").select("given", "guess", "n", rnd(ratio(F.col("n") * F.col("size"), F.col("t"))).alias("calibrated"))


def find_label_issues(df: DataFrame, k: int, rows_per_bucket: int | None = None) -> DataFrame:
    """Prune by noise rate.

    Every off-diagonal cell of the calibrated joint flags that many rows of its given label, those with the
    largest margin of the other class; rows whose given label is the model's choice are not flagged.  Adds
    ``flagged`` and ``suspicion_rank``: the position by self-confidence among all rows from 0, or -1.
    """
    cells = [(r["given"], r["guess"], int(r["calibrated"] + 0.5)) for r in confident_joint(df, k).where("given <> guess").collect()]  # k * k rows
    cells = [c for c in cells if c[2] > 0]
    scored = self_confidence(df)
    ranked_all = rank_rows(scored, "self_confidence", "row_id", name="__pos", rows_per_bucket=rows_per_bucket)
    if not cells:
        return ranked_all.withColumns({"flagged": F.lit(False), "suspicion_rank": F.lit(-1).cast("long")}).drop("__pos")
    p = F.col("probs")
    options = F.array(*[F.when(F.col("y") == a, F.struct(F.lit(b).alias("other"), (p[b] - p[a]).alias("margin"), F.lit(n).alias("quota"))) for a, b, n in cells])
    margins = scored.select("row_id", "y", F.inline(F.filter(options, lambda s: s.isNotNull())))
    hits = rank_rows(margins, "margin", "row_id", by=["y", "other"], descending=True, name="__r", rows_per_bucket=rows_per_bucket)
    hits = hits.where(F.col("__r") <= F.col("quota")).select("row_id").distinct().withColumn("__hit", F.lit(True))
    flagged = F.coalesce("__hit", F.lit(False)) & (F.col("model_pred") != F.col("y"))
    return (ranked_all.join(hits, "row_id", "left").withColumn("flagged", flagged)
            .withColumn("suspicion_rank", F.when(F.col("flagged"), F.col("__pos") - 1).otherwise(F.lit(-1))).drop("__hit", "__pos"))


def high_loss_rows(df: DataFrame, share: float = 0.9) -> DataFrame:
    """Rows whose loss is in the top part of every epoch; ``df`` has ``(row_id, epoch, loss)``."""
    q = exact_quantiles(df, ["loss"], [share], by=["epoch"])  # one number per epoch
    cut = F.lit(None).cast("double")
    for key, (v,) in q.items():
        cut = F.when(F.col("epoch") == key[0], F.lit(v)).otherwise(cut)
    g = df.groupBy("row_id").agg(F.bool_and(F.col("loss") >= cut).alias("stuck"), F.avg("loss").alias("mean_loss"))
    return g.where("stuck").select("row_id", rnd(F.col("mean_loss")).alias("mean_loss"))


# --- judging and review ----------------------------------------------------------------------------------------

def judge_queue(df: DataFrame, top: int, control: int) -> DataFrame:
    """The ``top`` flagged rows of lowest self-confidence, and ``control`` unflagged rows by hash."""
    a = df.where("flagged").orderBy("self_confidence", "row_id").limit(top).select("row_id", F.lit("flagged").alias("reason"))
    b = df.where("not flagged").orderBy(h32(F.lit("control"), "row_id"), "row_id").limit(control).select("row_id", F.lit("control").alias("reason"))
    return a.unionByName(b)


def judge_prompts(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """The question for each row; its answer grammar is what ``parse_verdict`` reads."""
    head = f"Allowed labels: {', '.join(labels)}\n\nContent: "
    tail = "\n\nReply with two lines only:\nVERDICT: YES or NO\nCORRECT_LABEL: an allowed label, or SAME for YES"
    return df.withColumn("prompt", F.concat(F.lit(head), F.coalesce(DATA, F.lit("")), F.lit("\n\nLabel to check: "), F.coalesce(LABEL, F.lit("")), F.lit(tail)))


def judge_consensus(verdicts: DataFrame) -> DataFrame:
    """Rows with several verdicts: NO only when every judge says NO."""
    return verdicts.groupBy("row_id").agg(F.count(F.lit(1)).alias("n_judges"), F.bool_and(F.col("verdict") == "NO").alias("unanimous_no"))


def trust_score() -> Column:
    """Trust in the given label from the audit flag, the self-confidence and the verdict (the numbers are fixed values)."""
    v = F.coalesce("verdict", F.lit(""))
    return (F.when(~F.col("flagged"), 0.8 + 0.2 * F.col("self_confidence")).when(v == "NO", 0.05).when(v == "YES", 0.6).otherwise(0.3))


def review_action() -> Column:
    """What to do with the row; the order of the tests matters."""
    v = F.coalesce("verdict", F.lit(""))
    return (F.when((v == "NO") & F.col("corrected_label").isNotNull(), "relabel").when(v == "YES", "keep (ambiguous)")
            .when(F.col("flagged"), "needs_review").otherwise("keep"))


def final_review(audited: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Audited rows with verdict, trust score and action."""
    return audited.join(verdicts.select("row_id", "verdict", "corrected_label"), "row_id", "left").withColumns(
        {"trust_score": trust_score(), "review_action": review_action()})


def review_buckets(reviewed: DataFrame) -> DataFrame:
    return reviewed.groupBy(F.col("review_action").alias("action")).agg(F.count(F.lit(1)).alias("count"))


def review_top(reviewed: DataFrame, n: int = 25) -> DataFrame:
    """The n least trusted rows."""
    return reviewed.orderBy("trust_score", "row_id").limit(n).select("row_id", LABEL, "verdict", "corrected_label", rnd(F.col("trust_score"), 3).alias("trust_score"), "review_action")


def audit_eval(reviewed: DataFrame) -> DataFrame:
    """Precision, recall and size of each audit against the planted errors."""
    real = F.col("corruption") != "clean"
    audits = [("confident learning", F.col("flagged")), ("judge confirmed", F.col("flagged") & (F.coalesce("verdict", F.lit("")) == "NO")),
              ("combined", F.col("review_action") != "keep")]
    a = reviewed.agg(F.count_if(real).alias("real"), *[x for i, (_, f) in enumerate(audits) for x in (F.count_if(f).alias(f"n{i}"), F.count_if(f & real).alias(f"t{i}"))])
    return a.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("audit"), rnd(ratio(F.col(f"t{i}"), F.col(f"n{i}"))).alias("precision"),
                 rnd(ratio(F.col(f"t{i}"), F.col("real"))).alias("recall"), F.col(f"n{i}").alias("flagged_count")) for i, (name, _) in enumerate(audits)])))


def audit_eval_by_type(reviewed: DataFrame) -> DataFrame:
    """Recall of the flags and of the judge per kind of planted error."""
    g = reviewed.where("corruption <> 'clean'").groupBy("corruption").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("flagged").alias("caught_by_flags"), F.count_if(F.col("verdict") == "NO").alias("caught_by_judge"))
    return g.withColumns({"flag_recall": rnd(ratio(F.col("caught_by_flags"), F.col("total")), 3), "judge_recall": rnd(ratio(F.col("caught_by_judge"), F.col("total")), 3)})


def judge_agreement(reviewed: DataFrame) -> DataFrame:
    """Share of judged rows where a NO meets a flag or a YES meets none."""
    judged = reviewed.where(F.col("verdict").isin("YES", "NO"))
    return judged.agg(F.count(F.lit(1)).alias("n_judged"), rnd(F.avg(((F.col("verdict") == "NO") == F.col("flagged")).cast("int"))).alias("agreement"))


def stratified_spot_check(df: DataFrame, n: int) -> DataFrame:
    """n rows per label by hash; Spark keeps n rows per label and task before the shuffle."""
    w = Window.partitionBy(LABEL).orderBy(h32(F.lit("spot"), "row_id"), "row_id")
    return df.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def apply_relabels(reviewed: DataFrame) -> DataFrame:
    """The corrected training labels."""
    new = F.when(F.col("review_action") == "relabel", F.col("corrected_label")).otherwise(F.col(LABEL))
    return reviewed.select("row_id", new.alias("label"), (F.col("review_action") == "relabel").alias("changed"))
