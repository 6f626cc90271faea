"""Added columns and reshaped records."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.columns import alert_required, joined_text, severity, temperature_alert
from tallyloom.functions.parsing import json_record, lookup_map
from tallyloom.operators.quality import dead_letters
from tallyloom.session import checkpointed


def with_ingest_metadata(df: DataFrame, source: str, now: object = None, file_name: bool = False) -> DataFrame:
    """Ingest time, source label and processing date; the file's path too where rows come straight from files."""
    moment = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    added = {"ingestion_timestamp": moment, "data_source": F.lit(source), "processing_date": F.to_date(moment)}
    if file_name:
        added["file_name"] = F.col("_metadata.file_path")
    return df.withColumns(added)


def with_constants(df: DataFrame, **values: object) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def apply_markup(df: DataFrame, percent: float, amount: str = "total_amount", flag: str = "UPDATED") -> DataFrame:
    """Amounts raised by a percentage, with a flag column telling so."""
    factor = F.lit(1) + F.lit(percent).cast("decimal(9,4)") / 100
    return df.withColumns({amount: (F.col(amount) * factor).cast(df.schema[amount].dataType), "update_flag": F.lit(flag)})


def compose(df: DataFrame, out: str, cols: Sequence[str], sep: str = "-") -> DataFrame:
    """Several columns joined into one, which replaces them."""
    return df.withColumn(out, joined_text(cols, sep)).drop(*cols)


def reshape(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """New record layout: each output column from a (nested) source path or an expression."""
    return df.select(*[(F.col(source) if isinstance(source, str) else source).alias(out) for out, source in mapping.items()])


def with_properties(df: DataFrame, pairs: str, names: Mapping[str, str], as_map: str | None = None) -> DataFrame:
    """Columns looked up by key in an array of key/value structs."""
    properties = lookup_map(pairs)
    out = df.withColumns({column: F.try_element_at(properties, F.lit(key)) for column, key in names.items()})
    return out.withColumn(as_map, properties) if as_map else out


def parse_records(df: DataFrame, schema: T.StructType | str, value: str = "value", keep: Sequence[str | Column] = ()) -> DataFrame:
    """JSON text or bytes of a column as flat columns, next to the columns to keep."""
    return df.withColumn("record", json_record(value, schema)).select(*keep, "record.*")


def score_logs(df: DataFrame) -> DataFrame:
    """Hour, severity and alert flag of log records."""
    moment = F.col("timestamp")
    if not isinstance(df.schema["timestamp"].dataType, (T.TimestampType, T.TimestampNTZType)):
        moment = F.try_to_timestamp(moment.cast("string"))
    return df.withColumns(
        {"hour": F.hour(moment), "severity": severity("level"), "alert_required": alert_required("level")}
    )


def label_sensors(df: DataFrame, now: object = None) -> DataFrame:
    """Location composed of building and floor, temperature alert and processing time."""
    moment = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    located = compose(df, "sensor_location", ["building", "floor"])
    return located.withColumns({"alert_status": temperature_alert("temperature"), "processed_timestamp": moment})


def split_lines(df: DataFrame, text: str, delimiter: str = "\n", out: str = "line") -> DataFrame:
    """One row per piece of a text, numbered within the text."""
    others = [c for c in df.columns if c != text]
    pattern = F.lit(r"\Q" + delimiter + r"\E")
    return df.select(*others, F.posexplode(F.split(F.col(text), pattern)).alias("line_no", out))


def split_json_array(df: DataFrame, text: str, element: T.DataType | str, out: str = "element") -> DataFrame:
    """One row per element of a JSON array held as text."""
    others = [c for c in df.columns if c != text]
    kind = element if isinstance(element, str) else element.simpleString()
    return df.select(*others, F.explode(F.from_json(F.col(text), f"array<{kind}>")).alias(out))


def enrich_batches(
    df: DataFrame,
    make_client: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    schema: T.StructType | str,
    batch_rows: int = 1000,
) -> DataFrame:
    """Rows passed in batches to an external call; ``make_client`` runs once per partition and returns the call."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = make_client()
        for frame in frames:
            for start in range(0, len(frame), batch_rows):
                yield call(frame.iloc[start : start + batch_rows].reset_index(drop=True))

    return df.mapInPandas(run, schema)


def enrich_or_reject(
    df: DataFrame,
    make_client: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]],
    schema: T.StructType | str,
    batch_rows: int = 1000,
    attempts: int = 3,
    wait_seconds: float = 0.0,
    path: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """:func:`enrich_batches` for a call that may fail: the rows it answered, and dead letters for those it did not.

    The call must answer one row per row. A batch that fails (or answers another number of rows) is tried ``attempts`` times,
    with a doubling wait in between, then halved and tried once per part, until single rows are left; these get all
    attempts again. So every row comes out once, on one side or the other, and a bad row costs about twice the logarithm of
    the batch in calls. Dead letters have ``error_reason``, ``raw_payload`` (the row as JSON) and ``failed_at``.

    Both sides read one written table (in ``path``, by default a new place in the shared folder), so that no call is made twice
    but where a task runs again.
    """
    spark = df.sparkSession
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    names = [f.name for f in fields.fields]
    marked = T.StructType([*fields.fields, T.StructField("_reason", T.StringType()), T.StructField("_payload", T.StringType())])

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = make_client()

        def answer(batch: pd.DataFrame, tries: int) -> tuple[pd.DataFrame | None, str | None]:
            reason = None
            for attempt in range(tries):
                if attempt and wait_seconds:
                    time.sleep(wait_seconds * 2 ** (attempt - 1))
                try:
                    got = call(batch.copy())
                except Exception as error:  # whatever the call raises is the row's reason
                    reason = f"{type(error).__name__}: {error}"
                else:
                    if len(got) == len(batch):
                        return got[names].assign(_reason=None, _payload=None), None
                    reason = f"{len(got)} rows answered for {len(batch)}"
            return None, reason

        for frame in frames:
            todo = [(frame.iloc[k : k + batch_rows], attempts) for k in range(0, len(frame), batch_rows)][::-1]
            while todo:
                batch, tries = todo.pop()
                got, reason = answer(batch.reset_index(drop=True), attempts if len(batch) == 1 else tries)
                if got is not None:
                    yield got
                elif len(batch) == 1:
                    payload = batch.to_json(orient="records", lines=True, date_format="iso", default_handler=str).strip()
                    yield pd.DataFrame({**{n: [None] for n in names}, "_reason": [reason], "_payload": [payload]})
                else:
                    half = len(batch) // 2
                    todo += [(batch.iloc[half:], 1), (batch.iloc[:half], 1)]

    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in marked.fields])  # a dead letter has no values
    table = checkpointed(spark, df.mapInPandas(run, nullable), "enriched", path)
    good = table.filter(F.col("_reason").isNull()).select(*names)
    return good, dead_letters(table.filter(F.col("_reason").isNotNull()), F.col("_reason"), "_payload")
