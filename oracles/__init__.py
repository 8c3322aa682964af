"""SQL that the queries are checked against, by query name."""


def all_oracles() -> dict[str, str]:
    from oracles import live, operators, parcel, shop, streams
    from oracles.views import duck_raw, with_needed
    from terrace.plans import raw_parcel, raw_shop

    out = dict(operators.SQL)
    for prefix, raw, views in (("shop", raw_shop.RAW, shop.VIEWS), ("parcel", raw_parcel.RAW, parcel.VIEWS)):
        known = {**duck_raw(raw), **views}
        out.update({f"{prefix}_{name}": with_needed(name, known) for name in views})
    # Nobody orders for the first time around the common day; this report is checked on an early one.
    out["shop_ads_new_order_user_stats"] = out["shop_ads_new_order_user_stats"].replace("1998-06-30", "1995-01-20")
    out["shop_dim_date"] = """SELECT strftime(d, '%Y-%m-%d') AS date_id, CAST(weekofyear(d) AS VARCHAR) AS week_id, CAST(isodow(d) AS VARCHAR) AS week_day,
        CAST(day(d) AS VARCHAR) AS day, CAST(month(d) AS VARCHAR) AS month, CAST(quarter(d) AS VARCHAR) AS quarter, CAST(year(d) AS VARCHAR) AS year,
        CAST(CAST(isodow(d) < 6 AS INTEGER) AS VARCHAR) AS is_workday, CAST(NULL AS VARCHAR) AS holiday_id
        FROM range((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders) + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d)"""
    out.update({f"stream_{name}": text for name, text in streams.SQL.items()})
    out.update({f"live_{name}": text for name, text in live.SQL.items()})
    return out
