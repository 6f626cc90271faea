"""Column expressions that take text, JSON and time values apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.columns import as_column

# Fixed value: one word is a run of Unicode letters, numbers and underscores.
WORD_PATTERN = r"[\p{L}\p{N}_]+"


def words(c: Column | str) -> Column:
    """Lower-cased words of a text, in order."""
    return F.regexp_extract_all(F.lower(as_column(c)), F.lit(WORD_PATTERN), F.lit(0))


def extract(c: Column | str, pattern: str, group: int = 1) -> Column:
    """The regular expression's group, null where the text does not match."""
    value = as_column(c)
    return F.when(value.rlike(pattern), F.regexp_extract(value, pattern, group))


def safe_number(c: Column | str) -> Column:
    """Text as a double, null where it does not parse; ``nan`` counts as not parsed."""
    value = as_column(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def currency(c: Column | str) -> Column:
    """Amount as text with two decimals, e.g. ``$12.50``."""
    return F.format_string("$%.2f", as_column(c).cast("double"))


def json_value(c: Column | str, path: str) -> Column:
    return F.get_json_object(as_column(c), path)


def json_record(c: Column | str, schema: T.StructType | str) -> Column:
    """JSON text (or its bytes) as a struct; null fields where it does not parse."""
    return F.from_json(as_column(c).cast("string"), schema)


def avro_record(c: Column | str, schema_json: str) -> Column:
    """Avro bytes as a struct. Needs the external Avro package on the session's class path."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(as_column(c), schema_json)


def event_time(date_col: Column | str, time_col: Column | str) -> Column:
    """Timestamp from a date text and a time text, null where they do not parse."""
    text = F.concat(as_column(date_col).cast("string"), F.lit(" "), as_column(time_col))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))


def hour_of(c: Column | str) -> Column:
    """Hour of a timestamp, or of an ``HH:mm:ss`` text."""
    return F.hour(as_column(c))


def dated_folder(c: Column | str) -> Column:
    return F.date_format(as_column(c), "yyyy/MM/dd")


def stamped_name(name: Column | str, moment: Column | str) -> Column:
    """File name up to its last dot, an underscore and the moment in epoch milliseconds."""
    stem = F.regexp_replace(as_column(name), r"\.[^.]*$", "")
    return F.concat(stem, F.lit("_"), F.unix_millis(as_column(moment).cast("timestamp")).cast("string"))


def lookup_map(pairs: Column | str, key: str = "key", value: str = "value") -> Column:
    """Array of key/value structs as a map; a repeated key keeps its last value."""
    entries = F.reverse(as_column(pairs))
    keys = F.transform(entries, lambda p: p[key])
    distinct_keys = F.filter(F.array_distinct(keys), lambda k: k.isNotNull())
    return F.map_from_arrays(
        distinct_keys,
        F.transform(distinct_keys, lambda k: F.element_at(F.transform(entries, lambda p: p[value]), F.array_position(keys, k).cast("int"))),
    )
