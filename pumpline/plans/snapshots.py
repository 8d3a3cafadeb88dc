"""Collector-shaped raw data derived from silver observations.

The collector queries the source every few hours for the last 72 hours, so
consecutive runs overlap and the same observation is collected more than
once.  ``snapshot_rows`` reproduces that from observations: collection i
happens at ``T - i * step`` (T = newest observation) and holds every
observation of the ``window`` hours before it; each observation is copied
into the (at most ceil(window / step)) runs that see it, by a bounded explode
per row (no join, no driver loop).  One run per fuel and collection.

``write_raw_tree`` turns those rows into the collector's on-disk layout —
partitioned JSONL, per-run manifests, a roll-up manifest per collection and
log lines — under a fresh folder of the shared checkpoint area.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import runs as runops
from ..schema import (MANIFEST_SCHEMA, PAGE_ROWS, QUERY_HOURS, QUERY_LAT, QUERY_LNG, QUERY_ORDER, QUERY_RADIUS_KM,
                      SOURCE_NAME)
from ..session import app_key, scratch_path
from ..sinks import raw as rawsink

STEP_HOURS = 48
WINDOW_HOURS = QUERY_HOURS
LOCAL_OFFSET_HOURS = -3          # collector's local clock (UTC-3): log times and dt folders
US_PER_HOUR = 3_600_000_000

# Unit spellings the source uses for litres, cycled over rows so
# the canonical-unit step has work to do.
UNIT_SPELLINGS = ["L", "LT", "LTS", "LITRO"]


def _lag_us(newest: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.col("price_ts"), newest)


def collected_span(obs: DataFrame, step_hours: int = STEP_HOURS) -> tuple[str, int]:
    """Time of the newest observation, as text, and the number of collections
    down to the oldest one."""
    newest = F.max("price_ts")
    last = F.floor(F.timestamp_diff("MICROSECOND", F.min("price_ts"), newest) / F.lit(step_hours * US_PER_HOUR))
    return tuple(obs.agg(newest.cast("string"), last + 1).first())


def snapshot_rows(obs: DataFrame, step_hours: int = STEP_HOURS, window_hours: int = WINDOW_HOURS,
                  collections: tuple[int, int] | None = None, newest: str | None = None) -> DataFrame:
    """One row per (observation, run that collected it), with run_id,
    collection index ``collection``, ``collected_at`` and local date ``dt``.

    ``collections``: only those from the first to the last given, both
    included; observations that none of them holds are left out as they are
    read.  ``newest``: the time of ``collected_span`` where it is known, which
    saves a pass over ``obs``."""
    if not 0 < step_hours <= window_hours:
        raise ValueError("step_hours must be in (0, window_hours] so runs overlap and cover every row")
    newest = obs.agg(F.max("price_ts")).scalar() if newest is None else F.lit(newest).cast("timestamp_ntz")
    step, win = F.lit(step_hours * US_PER_HOUR), F.lit(window_hours * US_PER_HOUR)
    lag = _lag_us(newest)
    first = F.greatest(F.lit(0).cast("bigint"), F.floor((lag - win) / step) + 1)
    last = F.floor(lag / step)
    if collections is not None:
        lo, hi = collections
        hours = lambda n: F.make_dt_interval(F.lit(0), F.lit(n))
        obs = obs.filter((F.col("price_ts") <= newest - hours(lo * step_hours)) & (F.col("price_ts") > newest - hours(hi * step_hours + window_hours)))
        first, last = F.greatest(F.lit(lo).cast("bigint"), first), F.least(F.lit(hi).cast("bigint"), last)
    x = obs.withColumn("collection", F.explode(F.sequence(first, last)))
    collected = newest - F.make_dt_interval(F.lit(0), (F.col("collection") * step_hours).cast("int"))
    return (x.withColumn("collected_at", collected)
             .withColumn("run_id", F.concat(F.lit("run-"), F.lpad(F.col("collection").cast("string"), 4, "0"),
                                            F.lit("-"), F.col("fuel_type")))
             .withColumn("dt", F.to_date(F.col("collected_at") + F.make_dt_interval(
                 F.lit(0), F.lit(LOCAL_OFFSET_HOURS)))))


def _utc_text(ts: Column, sep: str, offset: str) -> Column:
    return F.concat(F.date_format(ts, f"yyyy-MM-dd{sep}HH:mm:ss.SSSSSS"), F.lit(offset))


def raw_records(snap: DataFrame) -> DataFrame:
    """Snapshot rows in the collector's line format (envelope + query + raw)."""
    lag_s = F.timestamp_diff("SECOND", F.col("price_ts"), F.col("collected_at"))
    unit = F.element_at(F.array(*[F.lit(u) for u in UNIT_SPELLINGS]),
                        (F.pmod(F.col("obs_id"), F.lit(len(UNIT_SPELLINGS))) + 1).cast("int"))
    null_s, null_l, null_d = F.lit(None).cast("string"), F.lit(None).cast("bigint"), F.lit(None).cast("double")
    produto = F.struct(
        null_s.alias("score"), F.col("product_code").alias("codProduto"), F.lit(False).alias("farmaciaPopular"),
        F.lit(65).cast("bigint").alias("tipoNFe"), null_l.alias("gtin"), F.col("fuel_type").alias("anp"),
        null_l.alias("ncm"), F.col("obs_id").cast("string").alias("cod_nfce"), null_s.alias("ncmGrupo"),
        F.col("product_desc").alias("descricao"), F.col("price_unit").alias("precoUnitario"),
        F.col("price_net").alias("precoLiquido"), F.col("price_gross").alias("precoBruto"),
        F.col("discount").alias("desconto"), unit.alias("unidade"),
        _utc_text(F.col("price_ts"), " ", "-00:00").alias("data"), null_s.alias("intervalo"),
        F.pmod(lag_s, F.lit(86400)).alias("timeSpan"), null_s.alias("foto"))
    estab = F.struct(
        F.col("station_name").alias("nomeEstabelecimento"), F.col("street").alias("endLogradouro"),
        F.col("number").alias("endNumero"), F.col("zip_code").alias("cep"), F.col("district").alias("bairro"),
        null_l.alias("codMunicipio"), F.col("city").alias("municipio"), F.col("uf").alias("uf"),
        F.col("cnpj").alias("cnpj"), F.lit(False).alias("farmaciaPopular"), null_s.alias("telefone"),
        F.col("lat").alias("latitude"), F.col("lng").alias("longitude"), null_d.alias("tentativa"),
        F.col("distance_km").alias("distancia"))
    return snap.select(
        _utc_text(F.col("collected_at"), "'T'", "+00:00").alias("collected_at_utc"),
        F.col("run_id"), F.lit(SOURCE_NAME).alias("source"), F.col("fuel_type").alias("anp"),
        query_struct().alias("query"),
        F.struct(produto.alias("produto"), estab.alias("estabelecimento")).alias("raw"),
        F.col("dt"))


def write_runs(snap: DataFrame, root: str) -> None:
    """Write snapshot rows as run folders.  They are brought together by run
    as they are and take the several times wider line format only then."""
    rows = rawsink.clustered(snap.drop("collection", "unit"), ["fuel_type", "dt", "run_id"])
    rawsink.write_raw_jsonl(raw_records(rows), root, by_run=True)


def query_struct() -> Column:
    return F.struct(F.lit(QUERY_HOURS).cast("bigint").alias("horas"), F.lit(QUERY_LAT).alias("latitude"),
                    F.lit(QUERY_LNG).alias("longitude"), F.lit(QUERY_ORDER).alias("ordenar"),
                    F.lit(1).cast("bigint").alias("pagina"), F.lit(QUERY_RADIUS_KM).cast("bigint").alias("raio"))


@dataclass
class RawTree:
    data_root: str
    manifest_root: str
    overall_root: str
    log_root: str


def run_number(run_id: str = "run_id") -> Column:
    return F.substring(run_id, 5, 4).cast("bigint")


def reported(written: DataFrame) -> DataFrame:
    """What the source is taken to have reported for each derived run: three
    records more than it returned for every earlier collection, on pages of
    PAGE_ROWS."""
    n = written.groupBy("run_id").agg(F.count(F.lit(1)).alias("page_records"))
    total = F.col("page_records") + 3 * run_number()
    return n.select("run_id", F.ceil(total / F.lit(PAGE_ROWS)).alias("total_pages"), total.alias("total_records"), "page_records")


# Faults planted by run number modulo FAULT_EVERY, so that reconciling has
# something to find: runs whose manifest counts one row too many, runs that
# only the log knows (numbered from GHOSTS on), runs without a manifest.
FAULT_EVERY, SHORT, GHOST, NO_MANIFEST = 7, 2, 3, 5
GHOSTS, GHOST_ROWS = 5000, 7


def _faulty(manifests: DataFrame) -> DataFrame:
    kind = run_number() % FAULT_EVERY
    stats = F.col("response_stats").withField("rows_written", F.col("response_stats.rows_written") + F.when(kind == SHORT, 1).otherwise(0))
    return manifests.filter(kind != NO_MANIFEST).withColumn("response_stats", stats)


def _ghosts(manifests: DataFrame) -> DataFrame:
    ghost = manifests.filter(run_number() % FAULT_EVERY == GHOST)
    run = F.concat(F.lit("run-"), (run_number() + GHOSTS).cast("string"), F.lit("-"), F.col("anp"))
    return ghost.withColumn("out_root", F.replace("out_root", "run_id", run)).withColumn("run_id", run).withColumn(
        "response_stats", F.col("response_stats").withField("rows_written", F.lit(GHOST_ROWS).cast("bigint")))


def write_raw_tree(spark: SparkSession, obs: DataFrame, root: str | None = None) -> RawTree:
    """Write snapshots, manifests, roll-ups and logs; returns their paths.

    The snapshot rows are written once; manifests and logs are computed from
    the written files (what a run actually left on disk), not from memory.
    """
    root = root or scratch_path(spark, "raw-tree")
    tree = RawTree(f"{root}/raw_out", f"{root}/manifests", f"{root}/overall", f"{root}/logs")
    write_runs(snapshot_rows(obs), tree.data_root)
    from ..sources.raw import scan_raw
    written = scan_raw(spark, tree.data_root)
    manifests = _faulty(runops.run_manifest(written, out_root=tree.data_root, reported=reported(written)))
    rawsink.write_manifests(manifests, tree.manifest_root)
    man = spark.read.schema(MANIFEST_SCHEMA).json(tree.manifest_root)
    runops.run_rollup(man, out_dir=tree.data_root).write.mode("overwrite").json(tree.overall_root)
    rawsink.write_text_lines(runops.run_log_lines(man.unionByName(_ghosts(man)), tree.data_root), tree.log_root, "log")
    return tree


_TREES: dict[str, RawTree] = {}


def raw_tree_for(spark: SparkSession, sf_dir: str, obs_factory) -> RawTree:
    """The raw tree derived from ``sf_dir``'s tables, written once per
    application and reused by later queries in it."""
    key = f"{app_key(spark)}|{sf_dir}"
    tree = _TREES.get(key)
    if tree is None:
        tree = write_raw_tree(spark, obs_factory(spark, sf_dir))
        _TREES[key] = tree
    return tree
