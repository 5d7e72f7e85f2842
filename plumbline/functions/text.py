"""Text, JSON, time and scoring expressions.  NULL in gives NULL out everywhere."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns and answer words whose results must match.
SSN_PATTERN = r"\b\d{3}-\d{2}-\d{4}\b"
THINK_PATTERN = r"(?s)<think>.*?</think>"
JSON_PATTERN = r"\{[^}]+\}"
VERDICT_PATTERN = r"(?im)^[ \t]*VERDICT:[ \t]*(YES|NO)[ \t\r]*$"
TRUE_WORDS = ("true", "yes", "y", "1")
EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def strip_ws(c: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normalize_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def json_dig(c: Column, *keys: str) -> Column:
    """Text at a key path; nested values as JSON text; NULL on bad JSON or a missing key."""
    path = "$" + "".join(f"[{k}]" if k.isdigit() else f".{k}" for k in keys)
    return F.get_json_object(c, path)


def safe_multiply(a: Column, b: Column) -> Column:
    return a.try_cast("double") * b.try_cast("double")


def lead_score(revenue: Column, recency_days: Column, engagement: Column) -> Column:
    """Up to 40 points for revenue, 30 for recency, 30 for engagement; two decimals."""
    money = F.least(revenue.cast("double") / 10000, F.lit(1.0)) * 40
    fresh = F.greatest(1 - recency_days.cast("double") / 365, F.lit(0.0)) * 30
    active = F.least(engagement.cast("double") / 100, F.lit(1.0)) * 30
    complete = revenue.isNotNull() & recency_days.isNotNull() & engagement.isNotNull()
    return F.when(complete, F.round(money + fresh + active, 2))


def epoch_to_iso(secs: Column) -> Column:
    """UTC ISO text of epoch seconds, whatever the session time zone is."""
    moment = F.expr(EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs.cast("decimal(18,6)"))
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def iso_to_epoch(iso: Column) -> Column:
    """Epoch seconds of ISO text that carries its offset."""
    return F.unix_seconds(F.to_timestamp(iso, "yyyy-MM-dd'T'HH:mm:ssXXX"))


def contains_ssn(c: Column) -> Column:
    return F.when(c.isNotNull(), c.rlike(SSN_PATTERN).cast("int"))


def yn_to_bool(c: Column) -> Column:
    return F.upper(strip_ws(c)) == "Y"


def strip_thinking(c: Column) -> Column:
    """Drop think blocks; if nothing is left use the text after the last closing tag, else the original."""
    cleaned = strip_ws(F.regexp_replace(c, THINK_PATTERN, ""))
    tail = strip_ws(F.element_at(F.split(c, "</think>"), -1))
    return F.coalesce(F.nullif(cleaned, F.lit("")), F.nullif(tail, F.lit("")), c)


def parse_label(c: Column, labels: Sequence[str]) -> Column:
    """Index of the first label, in list order, that the cleaned answer contains; -1 if none."""
    low = F.lower(strip_thinking(c))
    out = F.when(F.lit(False), F.lit(-1))
    for i, name in enumerate(labels):
        out = out.when(low.contains(name.lower()), F.lit(i))
    return F.when(c.isNotNull(), out.otherwise(F.lit(-1)))


def _truthy(variant: Column, path: str) -> Column:
    text = F.try_variant_get(variant, path, "string")
    kind = F.schema_of_variant(F.try_variant_get(variant, path, "variant"))
    number = text.try_cast("double")
    return (F.when(text.isNull(), F.lit(None).cast("boolean"))
            .when(kind == "STRING", F.lower(text).isin(*TRUE_WORDS))
            .when(kind == "BOOLEAN", text == "true")
            .otherwise(F.coalesce(number != 0, F.lit(True))))


def parse_json_prediction(df: DataFrame, answer: str, classes: Sequence[str]) -> DataFrame:
    """Add fire, crash, component, make and year from the first JSON object of the answer; NULLs on failure.

    The answer is cleaned and parsed once per row into a variant column that the fields read.
    """
    body = df.withColumn("__clean", strip_thinking(F.col(answer))).withColumn("__body", F.regexp_extract("__clean", JSON_PATTERN, 0))
    parsed = body.withColumn("__v", F.try_parse_json("__body"))  # no object found is "", which does not parse

    def text(path: str) -> Column:
        return strip_ws(F.try_variant_get(F.col("__v"), path, "string"))

    out = parsed.withColumn("__component", F.lower(text("$.component"))).withColumns({
        "fire": _truthy(F.col("__v"), "$.fire"), "crash": _truthy(F.col("__v"), "$.crash"),
        "component": F.when(F.col("__component").isin(*classes), F.col("__component")),
        "make": F.nullif(F.upper(text("$.make")), F.lit("")), "year": F.nullif(text("$.year"), F.lit(""))})
    return out.drop("__clean", "__body", "__v", "__component")


def parse_verdict(c: Column) -> Column:
    """YES, NO or UNKNOWN: the last well-formed VERDICT line of the answer."""
    hits = F.regexp_extract_all(c, F.lit(VERDICT_PATTERN), F.lit(1))
    return F.when(c.isNotNull(), F.coalesce(F.upper(F.try_element_at(hits, F.lit(-1))), F.lit("UNKNOWN")))


def parse_corrected(c: Column, given: Column, labels: Sequence[str]) -> Column:
    """Label of the last well-formed CORRECT_LABEL line; SAME means the given label; others are ignored."""
    names = "|".join(re.escape(x) for x in labels)
    pattern = rf"(?m)^[ \t]*(?i:CORRECT_LABEL:)[ \t]*((?i:SAME)|{names})[ \t\r]*$"
    last = F.try_element_at(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), F.lit(-1))
    return F.when(F.upper(last) == "SAME", given).otherwise(last)


def logit(p: Column) -> Column:
    return F.ln(F.try_divide(p, 1 - p))


def expit(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))
