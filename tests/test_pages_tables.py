"""Saved response pages and tables by catalog name."""

import json

import pytest
from pyspark.sql import functions as F

from pumpline.operators import runs
from pumpline.plans import medallion
from pumpline.schema import SILVER_COLUMNS, STORED_SILVER_SCHEMA
from pumpline.sinks import raw as sinks
from pumpline.sources.raw import scan_pages, scan_table

from .helpers import obs, silver_df


def _write(tmp_path, pages):
    (tmp_path / "pages.jsonl").write_text("\n".join(p if isinstance(p, str) else json.dumps(p) for p in pages))
    return str(tmp_path)


def _page(run, **response):
    return {"collected_at_utc": "2024-01-10T12:00:00+00:00", "run_id": run, "anp": "GASOLINA", "query": {"horas": 72}, "response": response}


def test_totals_of_every_kind_and_pages_without_a_list(spark, tmp_path):
    item = {"produto": {"codProduto": "x", "precoUnitario": 5.5}, "estabelecimento": {"cnpj": 7}}
    root = _write(tmp_path, [
        _page("number", totalPaginas=3, totalRegistros=60, registrosdaPagina=2, resultado=[item, item]),
        _page("text", totalPaginas="3", totalRegistros="60", registrosdaPagina="many", resultado=[item]),
        _page("missing", resultado=[]), _page("null", totalPaginas=None, resultado=None),
        _page("object", totalPaginas=4, resultado={"erro": "busy"}), '{"run_id": "cut", "response": {"total'])
    pages = scan_pages(spark, root)
    got = {r.run_id: (r.total_pages, r.total_records, r.page_records, r["items"], r.resultado_ok) for r in runs.response_check(pages).collect()}
    assert got == {"number": (3, 60, 2, 2, True), "text": (3, 60, 1, 1, True), "missing": (1, 0, 0, 0, True), "null": (1, 0, 0, 0, False),
                   "object": (4, 0, 0, 0, False), None: (1, 0, 0, 0, False)}
    rows = runs.snapshot_envelope(pages).select("run_id", "raw.produto.precoUnitario", "raw.estabelecimento.cnpj").collect()
    assert sorted(map(tuple, rows), key=str) == [("number", 5.5, 7), ("number", 5.5, 7), ("text", 5.5, 7)]
    assert [r.run_id for r in pages.filter("_corrupt_record is not null").collect()] == [None]
    with pytest.raises(Exception, match="without a list in resultado, run object"):
        scan_pages(spark, root, strict=True).collect()
    assert scan_pages(spark, root, strict=True).filter("run_id <> 'object' or run_id is null").select("run_id").count() == 5


def test_numeric_fuel_codes_stay_text(spark, tmp_path):
    rows = silver_df(spark, [obs(1, 5.0, 1, fuel="001"), obs(2, 6.0, 30, fuel="2")])
    layers = medallion.layer_paths(str(tmp_path))
    sinks.write_silver(rows, layers.silver)
    assert sorted(r.fuel_type for r in medallion.read_silver(spark, layers).collect()) == ["001", "2"]
    assert scan_table(spark, layers.silver, STORED_SILVER_SCHEMA).schema["fuel_type"].dataType.simpleString() == "string"


def test_table_by_name(spark, tmp_path):
    day = silver_df(spark, [obs(1, 5.0, 1, fuel="001"), obs(2, 6.0, 30, fuel="2")]).withColumn("obs_date", F.to_date("price_ts"))
    try:
        sinks.save_table(day, "silver_by_name", f"{tmp_path}/t", ("fuel_type", "obs_date"))
        table = scan_table(spark, "silver_by_name")
        assert table.schema["fuel_type"].dataType.simpleString() == "string"
        assert sorted(table.select(*SILVER_COLUMNS).collect()) == sorted(day.select(*SILVER_COLUMNS).collect())
        # Only the partitions given are replaced.
        again = day.filter("fuel_type = '2'").withColumn("price_unit", F.lit(9.0))
        sinks.save_table(again, "silver_by_name", f"{tmp_path}/t", ("fuel_type", "obs_date"))
        assert sorted((r.fuel_type, r.price_unit) for r in scan_table(spark, "silver_by_name").collect()) == [("001", 5.0), ("2", 9.0)]
    finally:
        spark.sql("DROP TABLE IF EXISTS silver_by_name")
