"""The raw -> silver -> gold layers as lazy DataFrames.

:class:`Layers` builds every table by name without running anything; a
caller either reads one table (Catalyst prunes the rest of the lineage away)
or materialises the layers with :func:`materialize`, which writes silver to
a shared folder, rebuilds gold on the written silver tables (cutting the
lineage, so a lost executor recomputes from files, not from raw) and writes
gold.  Table order is the reference's statement order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.plans import gold, silver
from plantlens.sources import standins
from plantlens.sources.staging import current_version, latest_partition

# Fixed as-of date for ages and savings (H11: the reference uses CURRENT_DATE).
DEFAULT_AS_OF = "2025-06-30"


class Layers:
    """Lazily built silver and gold tables over a dict of raw DataFrames.

    ``small_dimensions`` is the caller's statement that the spec table and the
    price list are bounded (plants x lines x products; keys x days): they are
    then broadcast.  Without it Spark's size threshold and AQE decide, and
    ``salt_buckets`` salts the joins that shuffle.  ``pre_aggregate`` combines
    loads before the product fan-out of the cost exposure
    (see ``gold.cost_exposure``).
    """

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], as_of: str = DEFAULT_AS_OF,
                 small_dimensions: bool = False, salt_buckets: int = 0, pre_aggregate: bool = False):
        self.spark, self.raw, self.as_of = spark, raw, as_of
        self.small_dimensions, self.salt_buckets, self.pre_aggregate = small_dimensions, salt_buckets, pre_aggregate
        self._cache: dict[str, DataFrame] = {}
        self._folders: dict[str, str] = {}

    def use_written(self, name: str, table: DataFrame, folder: str | None = None) -> None:
        """From now on read ``name`` from ``table`` and not from its plan.
        ``folder`` holds its files; then the latest day is read off its partitions."""
        self._cache[name] = table
        if folder:
            self._folders[name] = folder

    def _memo(self, name, fn):
        if name not in self._cache:
            self._cache[name] = fn()
        return self._cache[name]

    # ---- silver -------------------------------------------------------
    def specs(self):
        return self._memo("silver_product_specifications",
                          lambda: silver.product_specs(self.raw["raw_product_specifications"]))

    def costs(self):
        return self._memo("silver_variety_costs", lambda: silver.variety_costs(self.raw["raw_variety_costs"]))

    def revenue(self):
        return self._memo("silver_revenue_by_line",
                          lambda: silver.revenue_by_line(self.raw["raw_revenue_by_line"]))

    def demand(self):
        return self._memo("silver_product_demand", lambda: silver.product_demand(self.raw["raw_product_demand"]))

    def loads(self):
        return self._memo("silver_potato_load_quality",
                          lambda: silver.load_quality(self.raw["raw_potato_load_quality"]))

    def events(self):
        return self._memo("silver_line_quality_events",
                          lambda: silver.line_quality_events(self.raw["raw_line_quality_events"]))

    def oee(self):
        return self._memo("silver_oee_events", lambda: silver.oee_events(self.raw["raw_oee_events"]))

    def equipment(self):
        return self._memo("silver_line_equipment",
                          lambda: silver.line_equipment(self.raw["raw_line_equipment"], self.as_of))

    def downtime(self):
        return self._memo("silver_downtime_events", lambda: silver.downtime_events(self.raw["raw_oee_events"]))

    # ---- gold ---------------------------------------------------------
    def spine(self):
        return self._memo("gold_date_spine", lambda: gold.date_spine_between(self.loads(), "arrival_date"))

    def hourly(self):
        return self._memo("gold_line_hourly_quality",
                          lambda: gold.line_hourly_quality(self.events(), self.specs(), small=self.small_dimensions))

    def readings(self):
        return self._memo("gold_reading_quality",
                          lambda: gold.reading_quality(self.events(), self.specs(), small=self.small_dimensions))

    def weekly(self):
        """From the written hourly table where there is one, else from the readings."""
        return self._memo("gold_quality_weekly", lambda: gold.quality_weekly(self.hourly()) if "gold_line_hourly_quality" in self._folders
                          else gold.quality_weekly_of_readings(self.events(), self.specs(), small=self.small_dimensions))

    def oee_daily(self):
        return self._memo("gold_oee_kpis", lambda: gold.oee_kpis(self.oee()))

    def exposure(self):
        return self._memo("gold_cost_exposure", lambda: gold.cost_exposure(
            self.loads(), self.costs(), self.specs(), small=self.small_dimensions, pre_aggregate=self.pre_aggregate,
            salt_buckets=self.salt_buckets))

    def cumulative(self):
        return self._memo("gold_cumulative_costs", lambda: gold.cumulative_costs(self.exposure(), self.revenue()))

    def line_daily(self):
        return self._memo("gold_line_daily_metrics", lambda: gold.line_daily_metrics(self.hourly()))

    def alignment(self):
        return self._memo("gold_change_alignment", lambda: gold.change_alignment(
            self.hourly(), self.oee(), salt_buckets=self.salt_buckets))

    # The trailing KPIs need the last days only.  Over a written table the latest
    # day comes from its partition names and the range prunes the partitions;
    # before that the source is read once and reduced to one row a day.
    def _latest_day(self, name: str):
        folder = self._folders.get(name)
        day = latest_partition(self.spark, folder, PARTITION_COLUMNS[name]) if folder else None
        return None if day is None else F.lit(day).cast("date")

    def kpi_tons(self):
        return gold.kpi_total_tons_30d(self.oee_daily(), self._latest_day("gold_oee_kpis"))

    def kpi_spend(self):
        return gold.kpi_raw_spend_30d(self.exposure(), self._latest_day("gold_cost_exposure"))

    def kpi_performance(self):
        return gold.kpi_oee_performance_7d(self.oee_daily(), self._latest_day("gold_oee_kpis"))

    def kpi_downgrade(self):
        return gold.kpi_downgrade_30d(self.exposure(), self._latest_day("gold_cost_exposure"))

    def scenarios(self):
        return self._memo("gold_scenario_recommendations", lambda: gold.scenario_recommendations(self.equipment()))

    def silver_tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, how)() for name, how in SILVER.items()}

    def gold_tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, how)() for name, how in GOLD.items()}

    def tables(self) -> dict[str, DataFrame]:
        """Every table, in the reference's statement order."""
        return self.silver_tables() | self.gold_tables()


# Table -> method of Layers, in statement order.
SILVER = {
    "silver_product_specifications": "specs",
    "silver_variety_costs": "costs",
    "silver_revenue_by_line": "revenue",
    "silver_product_demand": "demand",
    "silver_potato_load_quality": "loads",
    "silver_line_quality_events": "events",
    "silver_oee_events": "oee",
    "silver_line_equipment": "equipment",
    "silver_downtime_events": "downtime",
}
GOLD = {
    "gold_date_spine": "spine",
    "gold_line_hourly_quality": "hourly",
    "gold_quality_weekly": "weekly",
    "gold_oee_kpis": "oee_daily",
    "gold_cost_exposure": "exposure",
    "gold_cumulative_costs": "cumulative",
    "gold_line_daily_metrics": "line_daily",
    "gold_change_alignment": "alignment",
    "gold_counter_total_tons_last_30d": "kpi_tons",
    "gold_counter_raw_potato_spend_last_30d": "kpi_spend",
    "gold_counter_oee_performance_avg_last_7d": "kpi_performance",
    "gold_counter_downgrade_rework_last_30d": "kpi_downgrade",
    "gold_scenario_recommendations": "scenarios",
}


def from_raw_folder(spark: SparkSession, base_path: str, as_of: str = DEFAULT_AS_OF) -> Layers:
    """Layers over raw tables stored as ``{base_path}/raw_<name>/*.parquet``
    (the raw sink's layout).  Each folder is read with its declared schema;
    timestamps stored as ISO text are parsed back, 'NaT' becoming NULL."""
    from plantlens.sources.readers import read_parquet_dir
    from plantlens.sources.schemas import RAW_SCHEMAS

    raw = {name: read_parquet_dir(spark, f"{base_path.rstrip('/')}/{name}", schema)
           for name, schema in RAW_SCHEMAS.items()}
    return Layers(spark, raw, as_of)


def from_test_tables(spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF) -> Layers:
    """Layers over the raw stand-ins projected from the shared test tables.  Their
    specs and prices have at most 48 and 3,360 rows, whatever the input."""
    return Layers(spark, standins.raw_tables(spark, sf_dir), as_of, small_dimensions=True)


# Table descriptions attached as table comments.
TABLE_COMMENTS = {
    "silver_product_specifications": "Product specs per plant, line and product: dry-matter limits, colour caps.",
    "silver_variety_costs": "Variety price list by effective date, region, supplier and dry-matter band.",
    "silver_revenue_by_line": "Daily revenue per line and product with region and guarded price per kg.",
    "silver_product_demand": "Orders and forecast per day, region, channel and product.",
    "silver_potato_load_quality": "Loads with region, variety, arrival day, tons, colour shares and band.",
    "silver_line_quality_events": "Hourly readings with day, hour, week start and colour shares.",
    "silver_oee_events": "Run segments and downtime in minutes with the parsed end time.",
    "silver_line_equipment": "Machines with age and depreciated throughput as of a fixed date.",
    "silver_downtime_events": "Downtime events for display, with key-hash ids.",
    "gold_date_spine": "One row per day with day of week, weekend flag and week start.",
    "gold_line_hourly_quality": "Readings per line flagged against the spec with a tolerance.",
    "gold_quality_weekly": "Weekly plant quality: means, dominant colour class, breach hours.",
    "gold_oee_kpis": "Daily line totals of run and downtime minutes, packed kg, kg per minute.",
    "gold_cost_exposure": "Daily spend, over-quality waste and downgrade exposure per plant and product.",
    "gold_cumulative_costs": "Running spend, waste and margin per region.",
    "gold_line_daily_metrics": "Daily line and product means and flagged hours.",
    "gold_change_alignment": "Readings aligned with the day's downtime per code on their line.",
    "gold_counter_total_tons_last_30d": "Tons packed over the trailing 30 days.",
    "gold_counter_raw_potato_spend_last_30d": "Raw spend over the trailing 30 days.",
    "gold_counter_oee_performance_avg_last_7d": "Mean daily kg per minute over the trailing 7 days.",
    "gold_counter_downgrade_rework_last_30d": "Downgrade exposure over the trailing 30 days.",
    "gold_scenario_recommendations": "Per-machine upgrade or reallocation suggestions with savings.",
}

# Date partitioning of the large materialised tables (partition pruning for
# day filters such as the trailing KPIs and event windows).
PARTITION_COLUMNS = {
    "silver_potato_load_quality": "arrival_date",
    "silver_line_quality_events": "date",
    "silver_oee_events": "date",
    "gold_line_hourly_quality": "date",
    "gold_cost_exposure": "date",
    "gold_oee_kpis": "date",
}


def materialize(layers: Layers, base_path: str, database: str | None = None) -> dict[str, str]:
    """Write every table in statement order; each is read back for the tables
    that build on it, so nothing is computed twice and a lost executor
    recomputes one statement.

    ``base_path`` is a folder every executor can read (on a cluster, the
    shared storage the job is configured with).  Returns table -> name."""
    from plantlens.sources.sinks import save_table

    spark = layers.spark
    work = Layers(spark, layers.raw, layers.as_of, layers.small_dimensions, layers.salt_buckets, layers.pre_aggregate)
    names = {}
    for name, how in (SILVER | GOLD).items():
        names[name] = save_table(spark, getattr(work, how)(), name, database, f"{base_path.rstrip('/')}/{name}",
                                 TABLE_COMMENTS.get(name), PARTITION_COLUMNS.get(name))
        work.use_written(name, spark.table(names[name]), current_version(spark, f"{base_path.rstrip('/')}/{name}"))
    return names
