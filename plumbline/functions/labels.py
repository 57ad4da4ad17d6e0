"""Label, confidence and free-text expressions: parsing, encoding, normalizing and matching."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def relabel(label: Column, score: Column, least: float, places: int | None = 3, other: str = "uncertain") -> Column:
    """`other` below the threshold; the score is rounded before the comparison unless places is None."""
    seen = score if places is None else F.round(score, places)
    return F.when(seen < least, other).otherwise(label)


def comparable(label: Column, unsure: str = "uncertain", none: str = "none") -> Column:
    """For comparisons only: trimmed, and an unsure label counts as none."""
    return F.when(F.trim(label) == unsure, none).otherwise(F.trim(label))


def within(label: Column, values: list[str]) -> Column:
    return F.coalesce(label.isin(values), F.lit(False))


def score01(value: Column, default: float = 0.0) -> Column:
    """A text or number held to [0, 1], four places; anything else gives the default."""
    x = value.try_cast("double")
    return F.when(x.isNull() | F.isnan(x), F.lit(default)).otherwise(F.round(F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)), 4))


def whole_count(value: Column, default: int = 0) -> Column:
    """A text or number cut to a whole number of at least 0; anything else gives the default."""
    x = value.try_cast("double")
    return F.when(x.isNull() | F.isnan(x), F.lit(default)).otherwise(F.greatest(x.cast("bigint"), F.lit(0))).cast("int")


def join_list(items: Column) -> Column:
    """'a|b' of the trimmed items that aren't empty."""
    return F.array_join(F.filter(F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != ""), "|")


def encode_confidences(entries: Column) -> Column:
    """Array of struct(name, conf as text) to 'name:0.90|...'; entries without a name go, confidences that are no numbers stay as text."""
    named = F.filter(F.coalesce(entries, F.array().cast("array<struct<name:string,conf:string>>")), lambda e: F.coalesce(F.trim(e["name"]), F.lit("")) != "")
    number = lambda e: e["conf"].try_cast("double")
    return F.array_join(F.transform(named, lambda e: F.concat(F.trim(e["name"]), F.lit(":"), F.when(number(e).isNotNull(), F.format_string("%.2f", number(e))).otherwise(F.coalesce(e["conf"], F.lit(""))))), "|")


def decode_confidences(text: Column) -> Column:
    """'name:0.9|name:0.3' to array of struct(name, conf); parts without a number are left out."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), r"\|"), lambda p: F.struct(F.regexp_replace(p, ":[^:]*$", "").alias("name"), F.substring_index(p, ":", -1).try_cast("double").alias("conf")))
    return F.filter(parts, lambda p: p["conf"].isNotNull())


def confidence_of(text: Column, label: str, anchored: bool = False) -> Column:
    """The number behind the first 'label:' in the text, 0 where there is none, null for a null text.

    Unanchored, 'water' is found in 'underwater:0.9' too; anchored, a label begins at the start or after '|'.
    """
    lead = r"(?:^|\|)" if anchored else ""
    found = F.regexp_extract(text, rf"{lead}{re.escape(label)}:([\d.]+)", 1)
    return F.when(text.isNotNull(), F.coalesce(found.try_cast("double"), F.lit(0.0)))


def vocabulary_max(entries: Column, vocabulary: list[str]) -> Column:
    """Best confidence among entries (name, conf) whose lower-cased name is in the vocabulary, else 0; four places."""
    hits = F.filter(entries, lambda e: F.lower(e["name"]).isin(vocabulary))
    return F.round(F.coalesce(F.array_max(F.transform(hits, lambda e: e["conf"])), F.lit(0.0)), 4)


def top_entry(entries: Column) -> Column:
    """struct(name, conf) of the most confident named entry; the first of equal ones; ('', 0.0) where there is none."""
    named = F.filter(F.transform(entries, lambda e, i: F.struct(F.coalesce(e["conf"].try_cast("double"), F.lit(0.0)).alias("conf"), (-i).alias("minus"), F.coalesce(F.trim(e["name"]), F.lit("")).alias("name"))), lambda e: e["name"] != "")
    best = F.array_max(named)
    return F.struct(F.coalesce(best["name"], F.lit("")).alias("name"), F.round(F.greatest(F.coalesce(best["conf"], F.lit(0.0)), F.lit(0.0)), 4).alias("conf"))


def enumerated(value: Column, allowed: list[str], default: str = "uncertain") -> Column:
    v = F.lower(F.trim(value))
    return F.when(v.isin(allowed), v).otherwise(default)


def unfenced(text: Column) -> Column:
    """JSON out of a fenced code block."""
    return F.regexp_replace(F.regexp_replace(F.trim(text), r"^```(?:json)?\s*", ""), r"\s*```$", "")


def cleaned(text: Column, most: int) -> Column:
    """New lines to spaces, trimmed, at most so many characters (a field of a report, not a document)."""
    return F.substring(F.trim(F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" "))), 1, most)


def matched_phrase(found: Column, vocabulary: list[str]) -> Column:
    """The vocabulary's phrase that equals the text, else the first one that contains it or lies in it; null where there is none."""
    v = F.array(*[F.lit(x) for x in vocabulary])
    t = F.lower(F.trim(found))
    part = F.filter(v, lambda p: (t != "") & (F.contains(t, p) | F.contains(p, t)))
    return F.when(F.array_contains(v, t), t).otherwise(F.get(part, 0))


def caption(phrases: Column) -> Column:
    """'a. b.' of lower-cased, trimmed phrases."""
    return F.concat(F.array_join(F.transform(phrases, lambda p: F.lower(F.trim(p))), ". "), F.lit("."))


def caption_lookup(phrases: Column) -> Column:
    """Map from a caption's phrases back to the original ones."""
    return F.map_from_entries(F.array_distinct(F.transform(phrases, lambda p: F.struct(F.lower(F.trim(p)), p))))


def year(value: Column) -> Column:
    """'1984.0' or 1984 to 1984; null for anything else."""
    return value.try_cast("double").cast("int")
