"""JSON lines to clean, checked pairs. A line is read as it is or, failing that, with its bad backslashes doubled."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import text as T
from ..settle import pinned

_OPTIONS = {"allowSingleQuotes": "false"}


#: a member's name that no line has
_END = "\x7fend\x7f"


def json_object(line: Column) -> Column:
    """The line's object as map<string, string>, or null. Spark's parser lets trailing text pass, so the line is read as one member
    of an object whose other member must be found behind it, with nothing between."""
    whole = F.from_json(F.concat(F.lit('{"w":'), line, F.lit(f',"{_END}":{{}}}}')), "map<string,map<string,string>>", _OPTIONS)
    sound = T.strip(line).startswith("{") & (F.size(whole) == 2) & F.map_contains_key(whole, F.lit(_END))
    return F.when(F.coalesce(sound, F.lit(False)), F.try_element_at(whole, F.lit("w")))


def field(obj: Column, key: str) -> Column:
    """A member's value; of a key that repeats the last one's."""
    return F.try_element_at(F.filter(F.map_entries(obj), lambda e: e["key"] == key), F.lit(-1))["value"]


def parse(lines: DataFrame) -> DataFrame:
    """Adds obj to lines(line_no, value): the object, or null where the line is blank or can't be read; and v, the text that was
    read. Only lines that can't be read as they are are repaired."""
    d = pinned(lines, *lines.columns, F.coalesce(T.strip(F.col("value")), F.lit("")).alias("v"))
    d = pinned(d, *lines.columns, "v", json_object(F.col("v")).alias("obj"))
    repaired = F.when(F.col("obj").isNull() & (F.col("v") != ""), F.regexp_replace("v", r"""\\(?!["\\/bfnrtu])""", r"\\\\"))
    d = pinned(d, *lines.columns, F.coalesce(repaired, "v").alias("v"), "obj", (repaired != F.col("v")).alias("again"))
    return pinned(d, *lines.columns, "v", F.when(F.coalesce("again", F.lit(False)), json_object(F.col("v"))).otherwise(F.col("obj")).alias("obj"))


#: what a value that is no string may look like once it is read as one
_OTHER = r"^(?:true|false|-?[0-9].*|\[[\s\S]*|\{[\s\S]*)$"


@F.pandas_udf(StructType([StructField("instruction", StringType()), StructField("response", StringType())]))
def _as_text(lines: pd.Series) -> pd.DataFrame:
    """Both fields as str() gives them: True, 1.0, ['a']; a null is empty."""
    out = []
    for line in lines:
        try:
            obj = json.loads(line) if line else {}
        except ValueError:
            obj = {}
        out.append([x if isinstance(x, str) else "" if x is None else str(x) for x in (obj.get("instruction"), obj.get("response"))])
    return pd.DataFrame(out, columns=["instruction", "response"])


def fields(lines: DataFrame) -> DataFrame:
    """(line_no, instruction, response) of the readable lines as texts. Only lines with a value that may be none go to Python."""
    d = parse(lines).where(F.col("obj").isNotNull())
    keys = ("instruction", "response")
    d = pinned(d, "line_no", "v", *(F.coalesce(field(F.col("obj"), k), F.lit("")).alias(k) for k in keys))
    odd = F.col("instruction").rlike(_OTHER) | F.col("response").rlike(_OTHER)
    d = d.withColumn("odd", odd).withColumn("texts", _as_text(F.when(F.col("odd"), F.col("v"))))
    return pinned(d, "line_no", *(F.when(F.col("odd"), F.col(f"texts.{k}")).otherwise(F.col(k)).alias(k) for k in keys))


def checked(lines: DataFrame, min_words: int = 20) -> DataFrame:
    """(line_no, instruction, response, reason) of the readable lines; reason is null for a valid pair."""
    d = pinned(fields(lines), "line_no", *(T.clean_string(F.col(k)).alias(k) for k in ("instruction", "response")))
    return pinned(d, "line_no", "instruction", "response", T.pair_fault(F.col("instruction"), F.col("response"), min_words).alias("reason"))


def validated(lines: DataFrame, min_words: int = 20) -> DataFrame:
    """pairs(pair_id, instruction, response): the valid ones."""
    return checked(lines, min_words).where(F.col("reason").isNull()).select(F.col("line_no").alias("pair_id"), "instruction", "response")


def counts(lines: DataFrame, min_words: int = 20) -> DataFrame:
    """One row (total: all lines, blank ones too; valid)."""
    valid = checked(lines, min_words).agg(F.count_if(F.col("reason").isNull()).alias("valid"))
    return lines.agg(F.count("*").alias("total")).join(F.broadcast(valid))
