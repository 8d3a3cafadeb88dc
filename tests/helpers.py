"""Small silver frames with known answers."""

import datetime as dt

from pumpline.schema import SILVER_COLUMNS

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)

SILVER_DDL = ("fuel_type string, product_code string, product_desc string, unit string, cnpj bigint, "
              "station_name string, city string, uf string, district string, street string, number string, "
              "zip_code string, lat double, lng double, distance_km double, price_ts timestamp_ntz, "
              "price_unit double, price_net double, price_gross double, discount double, run_id string, "
              "collected_at timestamp_ntz")


def obs(cnpj, price, hours_ago, fuel="GASOLINA", code=None, city="SALVADOR", uf="BA", name=None,
        lat=-12.97, lng=-38.5, run="r1", collected_hours_ago=None):
    ts = T0 - dt.timedelta(hours=hours_ago)
    col = T0 - dt.timedelta(hours=collected_hours_ago if collected_hours_ago is not None else 0)
    return (fuel, code or f"{fuel}-P", fuel + " DESC", "L", cnpj, name or f"POSTO {cnpj}", city, uf,
            None, None, None, None, lat, lng, None, ts, price, price, price, None, run, col)


def silver_df(spark, rows):
    return spark.createDataFrame(rows, SILVER_DDL).select(*SILVER_COLUMNS)
