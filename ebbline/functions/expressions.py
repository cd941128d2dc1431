"""Column expressions shared by the operators. All are JVM-side; there is no Python UDF."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = datetime(1900, 1, 1)  # "no previous window"


def ts_ntz(value: str | datetime) -> Column:
    """Zone-less timestamp literal; folds to a constant, so it reaches the Parquet scan."""
    return F.expr(f"timestamp_ntz'{value}'")


def hours(count: Column | int) -> Column:
    """Exact interval of ``abs(count)`` hours."""
    count = F.lit(count) if isinstance(count, int) else count
    return F.make_dt_interval(F.lit(0), F.abs(count).cast("int"))


def days(count: Column | int) -> Column:
    count = F.lit(count) if isinstance(count, int) else count
    return F.make_dt_interval(F.abs(count).cast("int"))


def yes_no(value: Column) -> Column:
    """YES/Y/1 -> true, NO/N/0 -> false, anything else NULL."""
    word = F.upper(F.trim(value))
    return F.when(word.isin("YES", "Y", "1"), True).when(word.isin("NO", "N", "0"), False)


def like_pattern(value: Column) -> Column:
    """A selector as a lower-case LIKE pattern: ``*`` is ``%``; the whole of it, however long."""
    return F.lower(F.trim(F.replace(value, F.lit("*"), F.lit("%"))))


def like(value: Column, pattern: Column) -> Column:
    """``value LIKE pattern`` for a pattern held in a column; a backslash is an ordinary character."""
    return F.call_function("like", value, F.replace(pattern, F.lit("\\"), F.lit("\\\\")))


def name_part(name: Column, position: int) -> Column:
    """Part of a dotted name counted from the right: 1 object, 2 schema, 3 database, 4 server."""
    return F.try_element_at(F.split(name, r"\."), F.lit(-position))


def to_do(archived: Column, finished: Column, dry_run: Column, error: Column) -> Column:
    """A trigger is to do unless it is archived, finished, a dry run or in error."""
    return ~(archived | finished | dry_run | error)


HISTORY_TYPE = "array<struct<runid:string,message:string,timestamp:string>>"


def prepend_history(history: Column, run_id: Column, message: Column, at: Column) -> Column:
    """Run history as JSON with a new first entry ``{runid, message, timestamp}``."""
    entry = F.struct(
        run_id.cast("string").alias("runid"),
        message.alias("message"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
    )
    old = F.coalesce(F.from_json(history, HISTORY_TYPE), F.from_json(F.lit("[]"), HISTORY_TYPE))
    return F.to_json(F.concat(F.array(entry), old))


# --- typed JSON that keeps repeated keys -------------------------------------------
# A VARIANT refuses documents with repeated keys, but repeated keys are what the policy
# report must name. ``from_json`` to strings keeps them and only loses whether a scalar
# was quoted, so quoted tokens get a mark first and ``json_kind`` reads it back.
_MARK = "s:"


def mark_json_strings(doc: Column) -> Column:
    # Possessive and unrolled: the engine neither goes back nor recurses, whatever a string's length.
    return F.regexp_replace(doc, r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"', f'"{_MARK}$1"')


# The readers below are SQL text: they are used inside array lambdas, where one parsed
# expression is both shorter to read and cheaper to build than nested column calls.
def items_sql(text: str) -> str:
    """Items of a marked JSON array as text; NULL when it is not an array."""
    return f"from_json({text}, 'array<string>')"


def entries_sql(text: str) -> str:
    """``array<struct<key,value>>`` of a marked JSON object, repeated keys included."""
    return f"map_entries(from_json({text}, 'map<string,string>'))"


def kind_sql(text: str) -> str:
    """null, string, number, true/false, array or object."""
    return (f"CASE WHEN {text} IS NULL THEN 'null' WHEN startswith({text}, '{_MARK}') THEN 'string' "
            f"WHEN left({text}, 1) = '{{' THEN 'object' WHEN left({text}, 1) = '[' THEN 'array' "
            f"WHEN {text} IN ('true', 'false') THEN 'true/false' ELSE 'number' END")


def text_sql(text: str) -> str:
    """Scalar text without the mark, trimmed."""
    return f"trim(CASE WHEN startswith({text}, '{_MARK}') THEN substr({text}, {len(_MARK) + 1}) ELSE {text} END)"


def json_items(name: str) -> Column:
    return F.expr(items_sql(name))


def json_kind(name: str) -> Column:
    return F.expr(kind_sql(name))


def json_text(name: str) -> Column:
    return F.expr(text_sql(name))
