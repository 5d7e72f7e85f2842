"""Chat-style training rows and the evaluation of parsed model answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.core import ratio, rnd
from plumbline.functions.text import strip_ws, yn_to_bool
from plumbline.operators.multiclass import f1_averages
from plumbline.operators.relational import lookup_longest_prefix

# Component descriptions and their classes.
COMPONENT_MAP = {
    "AIR BAGS": "airbags",
    "BRAKES": "brakes",
    "SERVICE BRAKES": "brakes",
    "PARKING BRAKE": "brakes",
    "ELECTRICAL SYSTEM": "electrical_system",
    "ENGINE AND ENGINE COOLING": "engine",
    "ENGINE": "engine",
    "EQUIPMENT": "equipment",
    "EXTERIOR LIGHTING": "lighting",
    "INTERIOR LIGHTING": "lighting",
    "FUEL/PROPULSION SYSTEM": "fuel_system",
    "FUEL SYSTEM": "fuel_system",
    "HYBRID PROPULSION SYSTEM": "fuel_system",
    "LATCHES/LOCKS/LINKAGES": "body",
    "POWER TRAIN": "powertrain",
    "SEAT BELTS": "restraints",
    "CHILD SEAT": "restraints",
    "SEATS": "body",
    "STEERING": "steering",
    "STRUCTURE": "body",
    "SUSPENSION": "suspension",
    "TIRES": "tires",
    "VEHICLE SPEED CONTROL": "powertrain",
    "VISIBILITY": "visibility",
    "WHEELS": "tires",
    "EXHAUST SYSTEM": "exhaust",
    "FORWARD COLLISION AVOIDANCE": "adas",
    "LANE DEPARTURE": "adas",
    "BACK OVER PREVENTION": "adas",
    "ELECTRONIC STABILITY CONTROL": "adas",
}

# How a template opens and closes a turn of each role.
TEMPLATE = {
    "user": ("<|user|>\n", "<|end|>\n"),
    "assistant": ("<|assistant|>\n", "<|end|>\n"),
    "system": ("<|system|>\n", "<|end|>\n"),
}


def programmatic_labels(df: DataFrame, components: dict[str, str] | None = None) -> DataFrame:
    """Targets from the structured columns of the same row.

    ``df`` has ``id, narrative, make, model, year, fire, crash, injured, compdesc`` as text.
    """
    mapped = lookup_longest_prefix(df, "compdesc", components or COMPONENT_MAP, name="component")
    return mapped.select(
        "id", strip_ws(F.col("narrative")).alias("narrative"), strip_ws(F.col("make")).alias("make"), strip_ws(F.col("year")).alias("year"),
        strip_ws(F.concat_ws(" ", "year", "make", "model")).alias("vehicle"), yn_to_bool(F.col("fire")).alias("fire"), yn_to_bool(F.col("crash")).alias("crash"),
        (F.coalesce(F.col("injured").try_cast("int"), F.lit(0)) > 0).alias("injured"), "component")


def label_distribution(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of each target column."""
    cells = [F.struct(F.lit(c).alias("target"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*cells))).groupBy("target", "value").agg(F.count(F.lit(1)).alias("n"))


def render(messages: Column, template: dict[str, tuple[str, str]] = TEMPLATE) -> Column:
    """Text of a message array under a plain template table."""
    def one(m: Column) -> Column:
        out = m["content"]
        for role, (start, stop) in template.items():
            out = F.when(m["role"] == role, F.concat(F.lit(start), m["content"], F.lit(stop))).otherwise(out)
        return out

    return F.array_join(F.transform(messages, one), "")


def format_chat_rows(df: DataFrame, prompt: Column, answer: Column, bos: str = "") -> DataFrame:
    """Add ``messages`` (user prompt, assistant answer) and ``formatted_text`` without a leading token."""
    turn = [F.struct(F.lit("user").alias("role"), prompt.alias("content")), F.struct(F.lit("assistant").alias("role"), answer.alias("content"))]
    out = df.withColumn("messages", F.array(*turn))
    return out.withColumn("formatted_text", strip_bos(F.concat(F.lit(bos), render(F.col("messages"))), bos))


def format_json_targets(columns: Sequence[str]) -> Column:
    """Compact JSON of several targets; missing ones are written as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def strip_bos(c: Column, bos: str) -> Column:
    return F.when(c.startswith(bos), F.substring(c, len(bos) + 1, 2147483647)).otherwise(c) if bos else c


def check_mask_tokens(df: DataFrame, text: str, markers: Sequence[str]) -> DataFrame:
    """Rows whose text lacks one of the markers, with the missing ones listed."""
    lost = F.filter(F.array(*[F.when(~F.col(text).contains(m), F.lit(m)) for m in markers]), lambda x: x.isNotNull())
    return df.withColumn("missing_markers", F.array_join(lost, ",")).where("missing_markers <> ''")


def conversations_to_turns(df: DataFrame, max_turns: int | None = None) -> DataFrame:
    """Ordered messages, one row per conversation (chunk 0); turns without a number come first.

    A caller that wants rows of bounded size gives ``max_turns``: turn numbers are then cut at its multiples.
    """
    chunk = (F.lit(0) if max_turns is None else F.coalesce(F.floor(F.col("turn") / max_turns), F.lit(0)).cast("int")).alias("chunk")
    g = df.groupBy("conv_id", chunk).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("__m"))
    messages = F.transform("__m", lambda m: F.struct(m["role"].alias("role"), m["text"].alias("content")))
    return g.select("conv_id", "chunk", messages.alias("messages"), F.size("__m").alias("n_turns"))


def parse_rate(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of answers that parse, per target."""
    cells = [F.struct(F.lit(c).alias("target"), F.col(c).isNotNull().cast("int").alias("ok")) for c in columns]
    return df.select(F.inline(F.array(*cells))).groupBy("target").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("ok")).alias("parse_rate"))


def eval_parsed(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Accuracy and F1 averages per target on parsed rows only, next to the parse rate.

    ``df`` has ``true_<target>`` and ``pred_<target>``; a NULL prediction is a parse failure.
    """
    cells = [F.struct(F.lit(t).alias("target"), F.col(f"true_{t}").cast("string").alias("y"), F.col(f"pred_{t}").cast("string").alias("yhat")) for t in targets]
    long = df.select(F.inline(F.array(*cells)))
    rates = long.groupBy("target").agg(F.count(F.lit(1)).alias("n"), F.count("yhat").alias("n_parsed"),
                                       rnd(F.avg(F.col("yhat").isNotNull().cast("int"))).alias("parse_rate"),
                                       rnd(F.avg(F.when(F.col("yhat").isNotNull(), (F.col("y") == F.col("yhat")).cast("int")))).alias("accuracy"))
    f1 = f1_averages(long.where("yhat is not null"), ["target"])
    return rates.join(f1, "target", "left")


def confusion_active(df: DataFrame) -> DataFrame:
    """Confusion counts over the classes that occur in the truth; other predictions are left out.

    One pass: only the counts per pair of classes reach the driver.
    """
    cells = {(r["y"], r["yhat"]): r["n"] for r in df.groupBy("y", "yhat").agg(F.count(F.lit(1)).alias("n")).collect()}
    labels = sorted({y for y, yhat in cells if y is not None and yhat is not None})
    kind = df.schema["y"].dataType.simpleString()
    return df.sparkSession.createDataFrame([(a, b, cells.get((a, b), 0)) for a in labels for b in labels], f"y {kind}, yhat {kind}, n bigint")


def _bucket(ok_a: str, ok_b: str) -> Column:
    return (F.when(F.col(ok_a) & F.col(ok_b), "kept").when(F.col(ok_a), "regressed").when(F.col(ok_b), "fixed").otherwise("still wrong"))


def transition_table(df: DataFrame, ok_a: str, ok_b: str) -> DataFrame:
    """How rows move from right/wrong before to right/wrong after, with the net change."""
    net = df.agg(F.sum(F.col(ok_b).cast("int") - F.col(ok_a).cast("int"))).scalar()
    return df.groupBy(_bucket(ok_a, ok_b).alias("bucket")).agg(F.count(F.lit(1)).alias("n")).withColumn("net_change", net)


def transition_examples(df: DataFrame, ok_a: str, ok_b: str, n: int = 8) -> DataFrame:
    """The first n rows of each bucket; Spark keeps n rows per bucket and task before the shuffle."""
    w = Window.partitionBy("bucket").orderBy("row_id")
    out = df.withColumn("bucket", _bucket(ok_a, ok_b)).withColumn("position", F.row_number().over(w))
    return out.where(F.col("position") <= n)
