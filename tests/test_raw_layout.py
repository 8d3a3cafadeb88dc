"""Raw layer on a tree in the collector's own layout: data.jsonl beside a
pretty-printed manifest.json, an overall manifest and run logs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pumpline.operators import runs, silver
from pumpline.sources import raw as rawsrc


def _item(cnpj, code, price, ts_text, lat=-12.98, lng=-38.49, unit="L"):
    return {"produto": {"score": None, "codProduto": code, "farmaciaPopular": False, "tipoNFe": 65, "gtin": None,
                        "anp": "GASOLINA", "ncm": 27101259, "cod_nfce": str(cnpj) + code, "ncmGrupo": "X",
                        "descricao": "GASOLINA COMUM", "precoUnitario": price, "precoLiquido": price,
                        "precoBruto": price, "desconto": None, "unidade": unit, "data": ts_text,
                        "intervalo": "x", "timeSpan": 10, "foto": None},
            "estabelecimento": {"nomeEstabelecimento": f"POSTO {cnpj}", "endLogradouro": "RUA A", "endNumero": "1",
                                "cep": "40000000", "bairro": "CENTRO", "codMunicipio": 2927408,
                                "municipio": "SALVADOR", "uf": "BA", "cnpj": cnpj, "farmaciaPopular": False,
                                "telefone": None, "latitude": lat, "longitude": lng, "tentativa": 1.0,
                                "distancia": 1.0}}


QUERY = {"horas": 72, "latitude": -12.97111, "longitude": -38.51083, "raio": 100, "ordenar": "preco.asc", "pagina": 1}


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw_out")
    runs_def = {
        "run-a": ("2026-01-16T12:00:00+00:00", [(1, "P1", 5.0, "2026-01-16 10:00:00-00:00"),
                                                (2, "P1", 4.0, "2026-01-15 10:00:00-00:00")]),
        "run-b": ("2026-01-16T15:00:00+00:00", [(1, "P1", 5.0, "2026-01-16 10:00:00-00:00"),   # re-collected
                                                (1, "P1", 5.2, "2026-01-16 14:00:00-00:00"),
                                                (3, "P2", 6.0, "not a time")]),
    }
    manifests = []
    for run_id, (coll, items) in runs_def.items():
        d = root / "source=pricesite" / "anp=GASOLINA" / "dt=2026-01-16" / f"run_id={run_id}"
        d.mkdir(parents=True)
        lines = [json.dumps({"collected_at_utc": coll, "run_id": run_id, "source": "pricesite", "anp": "GASOLINA",
                             "query": QUERY, "raw": _item(*it)}) for it in items]
        (d / "data.jsonl").write_text("\n".join(lines) + "\n")
        m = {"run_id": run_id, "collected_at_utc": coll, "anp": "GASOLINA", "base_url": "u", "out_root": str(d),
             "data_file": "data.jsonl", "query": QUERY,
             "response_stats": {"totalPaginas_reported": 2, "totalRegistros_reported": 40,
                                "registrosdaPagina_reported": len(items), "rows_written": len(items)}}
        (d / "manifest.json").write_text(json.dumps(m, indent=2))
        manifests.append(m)
    (root / "overall_manifest.json").write_text(json.dumps(
        {"finished_at_utc": "2026-01-16T15:00:00+00:00", "out_dir": str(root), "runs": manifests}, indent=2))
    logs = root.parent / "logs"
    logs.mkdir()
    (logs / "run_20260116_120000.log").write_text("\n".join([
        "[2026-01-16 09:00:00,100] [INFO] Starting run. Log file: x.log",
        "[2026-01-16 09:00:01,200] [INFO] GASOLINA: fetching page 1 (only) ...",
        f"[2026-01-16 09:00:01,500] [INFO] GASOLINA: wrote 2 rows (page 1) -> {root}/source=pricesite/anp=GASOLINA/dt=2026-01-16/run_id=run-a/data.jsonl",
        "[2026-01-16 09:00:02,000] [INFO] ETANOL: fetching page 1 (only) ...",
        "[2026-01-16 09:00:02,300] [INFO] ETANOL: wrote 0 rows (page 1) -> /elsewhere/run_id=run-lost/data.jsonl",
        "a line without the format",
    ]) + "\n")
    return str(root), str(logs)


def test_scan_raw_ignores_manifests(spark, tree):
    root, _ = tree
    r = rawsrc.scan_raw(spark, root)
    assert r.count() == 5
    assert {x.run_id for x in r.select("run_id").distinct().collect()} == {"run-a", "run-b"}
    assert r.filter(F.col("dt").isNull()).count() == 0


def test_silver_types_and_dedup(spark, tree):
    root, _ = tree
    typed = silver.silver_typed(silver.silver_flatten(rawsrc.scan_raw(spark, root)))
    assert typed.filter(F.col("price_ts").isNull()).count() == 1           # unparseable timestamp -> null
    d = silver.silver_dedup(typed).collect()
    assert len(d) == 3                                                    # re-collected row once, bad ts out
    first = [x for x in d if x.cnpj == 1 and x.price_unit == 5.0][0]
    assert first.run_id == "run-a"                                        # earliest collection kept
    v = {(x.rule, x.failed) for x in silver.silver_validate(typed).collect()}
    assert ("key_missing", 1) in v and ("ts_after_collection", 0) in v


def test_manifests_and_rollup(spark, tree):
    root, _ = tree
    m = rawsrc.scan_manifest(spark, root)
    assert m.count() == 2 and m.filter(F.col("run_id").isNull()).count() == 0
    o = rawsrc.scan_overall_manifest(spark, os.path.join(root, "overall_manifest.json"))
    assert o.count() == 2
    roll = runs.run_rollup(m, gap="4 hours").collect()
    assert len(roll) == 1 and roll[0].n_runs == 2 and roll[0].finished_at_utc == "2026-01-16T15:00:00+00:00"


def test_logs_and_reconcile(spark, tree):
    root, logs = tree
    lg = rawsrc.scan_run_log(spark, logs)
    assert lg.count() == 6 and lg.filter(F.col("ts").isNull()).count() == 1
    rec = {r.run_id: r for r in runs.run_reconcile(lg, rawsrc.scan_raw(spark, root), rawsrc.scan_manifest(spark, root)).collect()}
    assert rec["run-lost"].status == "log_only"
    assert rec["run-a"].status == "ok" and rec["run-a"].coverage == 2 / 40
    assert rec["run-b"].status == "not_logged"


def test_envelope_null_resultado(spark):
    rows = [("2026-01-16T12:00:00+00:00", "r1", "GASOLINA", None, None),
            ("2026-01-16T12:00:00+00:00", "r2", "GASOLINA", None, [])]
    from pumpline.schema import ITEM_STRUCT, QUERY_STRUCT, RESPONSE_SCHEMA
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("collected_at_utc", T.StringType()), T.StructField("run_id", T.StringType()),
                           T.StructField("anp", T.StringType()), T.StructField("query", QUERY_STRUCT),
                           T.StructField("items", T.ArrayType(ITEM_STRUCT))])
    df = spark.createDataFrame(rows, schema).select(
        "collected_at_utc", "run_id", "anp", "query",
        F.struct(F.lit(None).cast("string").alias("totalPaginas"), F.lit("7").alias("totalRegistros"),
                 F.lit(None).cast("string").alias("registrosdaPagina"), F.col("items").alias("resultado")
                 ).cast(RESPONSE_SCHEMA).alias("response"))
    assert runs.snapshot_envelope(df).count() == 0
    chk = {r.run_id: r for r in runs.response_check(df).collect()}
    assert chk["r1"].total_pages == 1 and chk["r1"].total_records == 7 and chk["r1"].page_records == 0
    assert chk["r1"].resultado_ok is False and chk["r2"].resultado_ok is True


def test_corrupt_lines_are_counted(spark, tree):
    root, _ = tree
    import pathlib
    bad = pathlib.Path(root) / "source=pricesite" / "anp=GASOLINA" / "dt=2026-01-16" / "run_id=run-c"
    bad.mkdir(parents=True)
    good = json.dumps({"collected_at_utc": "2026-01-16T18:00:00+00:00", "run_id": "run-c", "source": "pricesite",
                       "anp": "GASOLINA", "query": QUERY, "raw": _item(9, "P9", 5.5, "2026-01-16 17:00:00-00:00")})
    no_item = json.dumps({"collected_at_utc": "2026-01-16T18:00:00+00:00", "run_id": "run-c", "anp": "GASOLINA"})
    (bad / "data.jsonl").write_text(good + "\n{not json\n" + no_item + "\n")
    q = {r.run_id: r for r in runs.raw_line_quality(rawsrc.scan_raw(spark, root, keep_corrupt=True)).collect()}
    assert (q["run-c"].lines, q["run-c"].corrupt_lines, q["run-c"].lines_without_item) == (3, 1, 1)
    # an unparseable time is present text: it is caught after typing (silver_validate key_missing)
    assert q["run-a"].corrupt_lines == 0 and q["run-b"].lines_without_key == 0


def test_run_folders_are_compressed_and_whole(spark, sf_small):
    """Lines are mostly repeated names; they read back as the rows they are made of."""
    import glob
    import gzip
    import os

    from pumpline.operators.silver import silver_flatten, silver_typed
    from pumpline.plans import snapshots
    from pumpline.schema import SILVER_COLUMNS
    from pumpline.session import scratch_path
    from pumpline.sources import raw as rawsrc, testdata
    snap = snapshots.snapshot_rows(testdata.silver(spark, sf_small, with_obs_id=True))
    root = scratch_path(spark, "narrow")
    snapshots.write_runs(snap, root)
    files = glob.glob(f"{root.removeprefix('file:')}/**/part-*", recursive=True)
    text = sum(len(gzip.open(f).read()) for f in files)
    assert text > 500 * snap.count() and sum(map(os.path.getsize, files)) < text / 3
    read = rawsrc.scan_raw(spark, root)
    assert read.count() == snap.count() == snap.select("obs_id", "run_id").distinct().count()
    rows = silver_typed(silver_flatten(read)).select(*SILVER_COLUMNS).exceptAll(snap.select(*SILVER_COLUMNS))
    assert rows.isEmpty()
