"""Parsing and filtering of raw streams: JSON logs and change records. All of it also runs on a static frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CDC_SCHEMA = "op string, before map<string,string>, after map<string,string>, source map<string,string>, ts_ms bigint"


def parse_marked(df: DataFrame, column: str, schema: str, into: str = "doc") -> DataFrame:
    """Adds the parsed document (null where the text is none) from one parse."""
    full = T.StructType.fromDDL(f"{schema}, _corrupt_record string")
    parsed = F.from_json(column, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return df.withColumn(into, parsed).withColumn(into, F.when(F.col(f"{into}._corrupt_record").isNull(), F.col(into).dropFields("_corrupt_record")))


def parse_or_dirty(df: DataFrame, column: str, schema: str, into: str = "doc") -> tuple[DataFrame, DataFrame]:
    """(rows with a parsed document, rows whose text is not such a document)."""
    parsed = parse_marked(df, column, schema, into)
    return parsed.where(F.col(into).isNotNull()), parsed.where(F.col(into).isNull()).select(*df.columns)


def split_log(df: DataFrame, dirty: str | None = None) -> DataFrame:
    """One parsed log stream as tagged rows of kind err, start, display, action or page, from one pass.

    A row carries `common, page, displays, actions, err, start, ts`. Errors are taken from any row; a row with `start`
    is a start record only; displays and actions become one row each and keep the time of the page. The result has kind, ts and the
    parts common, page, display, action, err and start, of which a kind has its own. `dirty` names a column whose value makes a row one
    of kind dirty and nothing else; it is a part, too.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = {"common": types["common"], "page": types["page"], "display": types["displays"].elementType, "action": types["actions"].elementType, "err": types["err"], "start": types["start"]}
    if dirty:
        parts[dirty] = types[dirty]

    def tagged(kind: str, **own: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), *(own.get(name, F.lit(None)).cast(kept).alias(name) for name, kept in parts.items()))

    common, page = F.col("common"), F.col("page")
    none = F.filter(F.array(tagged("err")), lambda _: F.lit(False))
    on_page = F.col("start").isNull()
    rows = F.concat(
        F.when(F.col("err").isNotNull(), F.array(tagged("err", err=F.col("err")))).otherwise(none),
        F.when(~on_page, F.array(tagged("start", common=common, start=F.col("start")))).otherwise(none),
        F.when(on_page & F.col("displays").isNotNull(), F.transform("displays", lambda x: tagged("display", common=common, page=page, display=x))).otherwise(none),
        F.when(on_page & F.col("actions").isNotNull(), F.transform("actions", lambda x: tagged("action", common=common, page=page, action=x))).otherwise(none),
        F.when(on_page, F.array(tagged("page", common=common, page=page))).otherwise(none))
    if dirty:
        rows = F.when(F.col(dirty).isNotNull(), F.array(tagged("dirty", **{dirty: F.col(dirty)}))).otherwise(rows)
    return df.select("ts", F.explode(rows).alias("_part")).select("_part.kind", "ts", *(f"_part.{name}" for name in parts))


def cdc_envelope(df: DataFrame) -> DataFrame:
    """Change record as a flat row: id, op, db, table, before, after, ts."""
    return df.select(F.concat_ws("_", F.coalesce(F.col("after")["id"], F.col("before")["id"]), F.col("ts_ms").cast("string")).alias("id"), "op",
                     F.col("source")["db"].alias("db"), F.col("source")["table"].alias("table"), "before", "after", F.col("ts_ms").alias("ts"))


def cdc_select(df: DataFrame, table: str, ops: Sequence[str], columns: Mapping[str, str], status: Mapping[str, Sequence[str]] | None = None,
               changed: str | None = None) -> DataFrame:
    """Rows of one table with the wanted operations and values, as typed columns.

    columns: key in `after` -> "name type". status: key -> allowed values. changed: a key whose value must differ from before. With "d"
    among the operations, a delete gives its last values and `_deleted` true.
    """
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after")) if "d" in ops else F.col("after")
    cond = (F.col("source")["table"] == table) & F.col("op").isin(*ops)
    for key, values in (status or {}).items():
        cond = cond & row[key].isin(*values)
    if changed:
        cond = cond & ~F.col("before")[changed].eqNullSafe(F.col("after")[changed])
    out = []
    for key, spec in columns.items():
        name, kind = spec.split(" ", 1)
        out.append(row[key].try_cast(kind).alias(name))
    if "d" in ops:
        out.append((F.col("op") == "d").alias("_deleted"))
    return df.where(cond).select(*out, F.timestamp_millis("ts_ms").alias("event_time"))


def cdc_delta(df: DataFrame, column: str, name: str = "delta", whole: Sequence[str] = ("r",)) -> DataFrame:
    """Quantity gained by a change: all of it for a snapshot row, the increase for an update, else no row."""
    before, after = F.col("before")[column].try_cast("bigint"), F.col("after")[column].try_cast("bigint")
    gained = F.when(F.col("op").isin(*whole), after).when((F.col("op") == "u") & (after > before), after - before)
    return df.withColumn(name, gained).where(F.col(name).isNotNull())
