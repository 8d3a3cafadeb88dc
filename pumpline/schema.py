"""Schemas of the raw snapshot layer and the silver / gold tables."""

from __future__ import annotations

from pyspark.sql import types as T

QUERY_STRUCT = T.StructType([
    T.StructField("horas", T.LongType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("ordenar", T.StringType()),
    T.StructField("pagina", T.LongType()),
    T.StructField("raio", T.LongType()),
])

PRODUTO_STRUCT = T.StructType([
    T.StructField("score", T.StringType()),
    T.StructField("codProduto", T.StringType()),
    T.StructField("farmaciaPopular", T.BooleanType()),
    T.StructField("tipoNFe", T.LongType()),
    T.StructField("gtin", T.LongType()),
    T.StructField("anp", T.StringType()),
    T.StructField("ncm", T.LongType()),
    T.StructField("cod_nfce", T.StringType()),
    T.StructField("ncmGrupo", T.StringType()),
    T.StructField("descricao", T.StringType()),
    T.StructField("precoUnitario", T.DoubleType()),
    T.StructField("precoLiquido", T.DoubleType()),
    T.StructField("precoBruto", T.DoubleType()),
    T.StructField("desconto", T.DoubleType()),
    T.StructField("unidade", T.StringType()),
    T.StructField("data", T.StringType()),
    T.StructField("intervalo", T.StringType()),
    T.StructField("timeSpan", T.LongType()),
    T.StructField("foto", T.StringType()),
])

ESTABELECIMENTO_STRUCT = T.StructType([
    T.StructField("nomeEstabelecimento", T.StringType()),
    T.StructField("endLogradouro", T.StringType()),
    T.StructField("endNumero", T.StringType()),
    T.StructField("cep", T.StringType()),
    T.StructField("bairro", T.StringType()),
    T.StructField("codMunicipio", T.LongType()),
    T.StructField("municipio", T.StringType()),
    T.StructField("uf", T.StringType()),
    T.StructField("cnpj", T.LongType()),
    T.StructField("farmaciaPopular", T.BooleanType()),
    T.StructField("telefone", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("tentativa", T.DoubleType()),
    T.StructField("distancia", T.DoubleType()),
])

ITEM_STRUCT = T.StructType([
    T.StructField("produto", PRODUTO_STRUCT),
    T.StructField("estabelecimento", ESTABELECIMENTO_STRUCT),
])

# One JSON line of a snapshot file.  Partition columns (source, anp, dt,
# run_id) come from the directory names; ``source``/``anp``/``run_id`` are
# also in the body, Spark keeps the path value when both exist.
RAW_SCHEMA = T.StructType([
    T.StructField("collected_at_utc", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("anp", T.StringType()),
    T.StructField("query", QUERY_STRUCT),
    T.StructField("raw", ITEM_STRUCT),
])

RAW_PARTITIONS = ["source", "anp", "dt", "run_id"]

RESPONSE_STATS_STRUCT = T.StructType([
    T.StructField("totalPaginas_reported", T.LongType()),
    T.StructField("totalRegistros_reported", T.LongType()),
    T.StructField("registrosdaPagina_reported", T.LongType()),
    T.StructField("rows_written", T.LongType()),
])

MANIFEST_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("collected_at_utc", T.StringType()),
    T.StructField("anp", T.StringType()),
    T.StructField("base_url", T.StringType()),
    T.StructField("out_root", T.StringType()),
    T.StructField("data_file", T.StringType()),
    T.StructField("query", QUERY_STRUCT),
    T.StructField("response_stats", RESPONSE_STATS_STRUCT),
])

OVERALL_MANIFEST_SCHEMA = T.StructType([
    T.StructField("finished_at_utc", T.StringType()),
    T.StructField("out_dir", T.StringType()),
    T.StructField("runs", T.ArrayType(MANIFEST_SCHEMA)),
])

# A whole response page as the source returns it (input of snapshot_envelope).
RESPONSE_SCHEMA = T.StructType([
    T.StructField("totalPaginas", T.StringType()),
    T.StructField("totalRegistros", T.StringType()),
    T.StructField("registrosdaPagina", T.StringType()),
    T.StructField("resultado", T.ArrayType(ITEM_STRUCT)),
])

# A line of saved pages as read: ``resultado`` as its JSON text, so that a
# page whose value is no list is seen rather than lost.
PAGE_SCHEMA = T.StructType([
    T.StructField("collected_at_utc", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("anp", T.StringType()),
    T.StructField("query", QUERY_STRUCT),
    T.StructField("response", T.StructType([T.StructField(f.name, T.StringType()) for f in RESPONSE_SCHEMA.fields])),
])

# Silver: one typed row per price observation.  Times are UTC wall clock
# (timestamp_ntz) so results do not move with the session time zone.
SILVER_COLUMNS = [
    "fuel_type", "product_code", "product_desc", "unit",
    "cnpj", "station_name", "city", "uf", "district", "street", "number", "zip_code",
    "lat", "lng", "distance_km",
    "price_ts", "price_unit", "price_net", "price_gross", "discount",
    "run_id", "collected_at",
]



_DOUBLES = {"lat", "lng", "distance_km", "price_unit", "price_net", "price_gross", "discount"}
_TIMES = {"price_ts", "collected_at"}
SILVER_SCHEMA = T.StructType([
    T.StructField(c, T.DoubleType() if c in _DOUBLES else T.TimestampNTZType() if c in _TIMES
                  else T.LongType() if c == "cnpj" else T.StringType())
    for c in SILVER_COLUMNS])
# As stored: with the day partition.
STORED_SILVER_SCHEMA = T.StructType(SILVER_SCHEMA.fields + [T.StructField("obs_date", T.DateType())])


# Observation identity (dedup key) and the gold key.
OBS_KEY = ["cnpj", "product_code", "price_ts"]
GOLD_KEY = ["cnpj", "product_code"]

# Fixed values of the collector's query (must equal the source's for the
# stored distance and the listing parameters to agree).
QUERY_LAT = -12.97111
QUERY_LNG = -38.51083
QUERY_HOURS = 72
QUERY_RADIUS_KM = 100
QUERY_ORDER = "preco.asc"
PAGE_ROWS = 25
SOURCE_NAME = "pricesite"      # value of the source= partition written for derived snapshots
