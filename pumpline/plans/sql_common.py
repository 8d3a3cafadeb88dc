"""SQL twin shared by the batch and raw-layer registries."""

VALIDATE_SQL = """
, agg AS (
  SELECT fuel_type, count(*) AS rows, min(price_unit) AS min_price_unit, max(price_unit) AS max_price_unit,
    count(*) FILTER (WHERE cnpj IS NULL OR product_code IS NULL OR price_ts IS NULL) AS key_missing,
    count(*) FILTER (WHERE price_unit IS NULL) AS price_missing,
    count(*) FILTER (WHERE price_unit < 0.01 OR price_unit > 1000.0) AS price_out_of_range,
    count(*) FILTER (WHERE price_net > price_unit) AS net_above_unit,
    count(*) FILTER (WHERE price_net != price_gross) AS net_ne_gross,
    count(*) FILTER (WHERE abs(discount - (price_unit - price_net)) > 1e-6) AS discount_mismatch,
    count(*) FILTER (WHERE lat < -90 OR lat > 90) AS lat_out_of_range,
    count(*) FILTER (WHERE lng < -180 OR lng > 180) AS lng_out_of_range,
    count(*) FILTER (WHERE lat IS NULL OR lng IS NULL) AS coords_missing,
    count(*) FILTER (WHERE price_ts > collected_at) AS ts_after_collection,
    count(*) FILTER (WHERE collected_at > price_ts + INTERVAL 72 HOUR) AS lag_over_window
  FROM silver GROUP BY fuel_type)
SELECT fuel_type, rows, min_price_unit, max_price_unit, rule, failed, failed = 0 AS passed
FROM agg UNPIVOT (failed FOR rule IN (key_missing, price_missing, price_out_of_range, net_above_unit,
  net_ne_gross, discount_mismatch, lat_out_of_range, lng_out_of_range, coords_missing,
  ts_after_collection, lag_over_window))
"""
