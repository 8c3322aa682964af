"""Every warehouse job as a query over the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.plans import parcel, raw_parcel, raw_shop, shop
from terrace.plans.warehouse import Warehouse, derived_reader
from terrace.sources import load

AS_OF = date(1998, 6, 30)


def _flat(df: DataFrame) -> DataFrame:
    """Arrays as text, so that any client can compare them."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            if isinstance(f.dataType.elementType, T.StructType):
                names = f.dataType.elementType.fieldNames()
                out[f.name] = F.array_join(F.transform(f.name, lambda x: F.concat_ws(",", *[x[n] for n in names])), ";")
            else:
                out[f.name] = F.array_join(f.name, ";")
    return df.withColumns(out) if out else df


def _run(raw, jobs, name, as_of=AS_OF):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _flat(Warehouse(derived_reader(spark, sf_dir, raw), jobs, as_of)[name])
    return query


def shop_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over the days that the orders span; only that one-row range comes to the driver."""
    derived_reader(spark, sf_dir, {})
    span = load(spark, sf_dir, "orders").agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    return shop.dim_date(spark, span[0], span[1])


QUERIES = {f"shop_{name}": _run(raw_shop.RAW, shop.JOBS, name) for name in shop.JOBS}
del QUERIES["shop_dwd_trade_trade_flow_acc_open"]
QUERIES["shop_dim_date"] = shop_dim_date
QUERIES["shop_ads_new_order_user_stats"] = _run(raw_shop.RAW, shop.JOBS, "ads_new_order_user_stats", date(1995, 1, 20))
QUERIES.update({f"parcel_{name}": _run(raw_parcel.RAW, parcel.JOBS, name) for name in parcel.JOBS})
