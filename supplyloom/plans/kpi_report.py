"""KPI report: a template row per valid period, team, customer unit and KPI, filled with counts, followed by
the counted combinations that have no place in the template."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplyloom.functions.dates import in_periods, period_of, valid_at
from supplyloom.functions.labels import KPI_RECEIVED, KPI_TEAMS, REQUEST_TYPE_KPIS, request_type_to_kpi
from supplyloom.functions.text import same_text, text_key
from supplyloom.operators.joins import cross_periods, hiding_windows, is_hidden, join_top_level, unmatched
from supplyloom.operators.updates import fill_measures
from supplyloom.operators.windows import first_per_key, global_row_number, number_in_cells
from supplyloom.sources import versions

# fixed values
PRODUCT = "Supplier Qualification"
KPI_KINDS = (1, 3)
INVALID = " - invalid combination"
INVALID_PRODUCT_RECEIVED = " Supplier Qualification"
INPUT_LEVEL = "inputed"
FINISHED_STATUSES = ("Finished", "Finished not qualified")

CUSTOMERS_PER_RANGE = 1_000

MEASURE_KEYS = ["team", "customer_name", "kpi"]
Tables = Mapping[str, DataFrame]


def kpi_template(t: Tables, hierarchy: DataFrame, periods: Sequence[str], consolidation: DataFrame | None = None) -> DataFrame:
    """Template rows: period, team, product, kpi, customer_name, value (NULL), and their sort columns (see ``kpi_offers``)."""
    offers = kpi_offers(t, hierarchy, periods, consolidation)
    return cross_periods(offers, F.col("periods")).select("period", *[c for c in offers.columns if c != "periods"])


def kpi_offers(t: Tables, hierarchy: DataFrame, periods: Sequence[str], consolidation: DataFrame | None = None) -> DataFrame:
    """The template with one row for all ``periods`` of an offer, an array in the order of the report, never empty.

    Tables: team_customer, customer, team, service, service_name, kpi, kpi_name, customer_visibility.
    ``hierarchy`` gives the top-level customer of every customer (``id``, ``root_id``). ``consolidation``
    (customer_unit_id, team_id, service_name_id, period, consolidation) restricts the rows to the input
    level; without it every row counts as such.

    All joins run on rows without period, those of the report too. The periods multiply them last and in place;
    all validity bounds are tested together where they are listed.
    """
    if not periods:
        raise ValueError("at least one period is needed")

    def bounded(df: DataFrame, prefix: str, **columns: str) -> DataFrame:
        """Columns by new name with the validity bounds, for rows valid in some part of the report."""
        overlaps = (F.col("valid_to").isNull() | (F.col("valid_to") >= min(periods))) & (
            F.col("valid_from").isNull() | (F.col("valid_from") <= max(periods))
        )
        bounds = [F.col("valid_from").alias(f"{prefix}_from"), F.col("valid_to").alias(f"{prefix}_to")]
        return df.filter(overlaps).select(*[F.col(old).alias(new) for new, old in columns.items()], *bounds)

    owner = bounded(t["team_customer"], "tc", team_customer_id="id", team_id="team_id", owner_id="customer_id")
    service = bounded(
        t["service"], "s", service_id="id", team_customer_id="team_customer_id", service_name_id="service_name_id"
    )
    kpi = bounded(t["kpi"], "k", service_id="service_id", kpi_name_id="kpi_name_id")
    unit = bounded(t["customer"], "cu", customer_unit_id="id", customer_name="name")
    service_name = t["service_name"].filter(same_text(F.col("name"), PRODUCT)).select(
        F.col("id").alias("service_name_id"), F.col("name").alias("product")
    )
    kpi_name = t["kpi_name"].filter(F.col("kpi_kind").isin(*KPI_KINDS)).select(
        F.col("id").alias("kpi_name_id"), F.col("name").alias("kpi"), F.col("priority").alias("kpi_priority")
    )
    team = t["team"].select(F.col("id").alias("team_id"), F.col("name").alias("team"))

    offered = owner.join(team, "team_id").join(service, "team_customer_id").join(service_name, "service_name_id")
    measured = offered.join(kpi, "service_id").join(kpi_name, "kpi_name_id")
    units = hierarchy.join(unit, F.col("id") == F.col("customer_unit_id")).drop("customer_unit_id")
    rows = join_top_level(measured, units, "owner_id").withColumnRenamed("node_id", "customer_unit_id")
    # Small as bytes, these rows would share one task, and the periods multiply them there. They are dealt out
    # by number, which AQE leaves alone, and by the keys of the next join, which then finds them in place.
    keys = ["team_id", "service_name_id", "customer_unit_id"]
    spark = rows.sparkSession
    rows = rows.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)
    rows = rows.join(hiding_windows(t["customer_visibility"]), keys, "left")
    if consolidation is not None:
        level = consolidation.filter(same_text(F.col("consolidation"), INPUT_LEVEL) & F.col("period").isin(*periods))
        rows = rows.join(level.groupBy(*keys).agg(F.collect_set("period").alias("_input")), keys)

    def offered_in(period: Column) -> Column:
        shown = ~is_hidden(period)
        for prefix in ("tc", "s", "k", "cu"):
            shown = shown & valid_at(period, F.col(f"{prefix}_from"), F.col(f"{prefix}_to"))
        return shown if consolidation is None else shown & F.array_contains("_input", period)

    listed = F.filter(F.array(*[F.lit(p) for p in periods]), offered_in)
    return rows.select(
        listed.alias("periods"), "team", "product", "kpi", "customer_name", F.lit(None).cast("double").alias("value"),
        "customer_unit_id", "kpi_priority",
    ).filter(F.size("periods") > 0)


def _template_order() -> list[Column]:
    """Newest period, highest customer id, KPI priority and name; ties by team and product."""
    return [F.desc("period"), F.desc("customer_unit_id"), *[F.col(c) for c in ("kpi_priority", "kpi", "team", "product")]]


def template_row_id(template: DataFrame) -> DataFrame:
    """Number the template in its order."""
    return global_row_number(template, _template_order(), "id")


def template_row_id_by_range(template: DataFrame, customers: int = CUSTOMERS_PER_RANGE) -> DataFrame:
    """The same numbers from the counts per period and range of ``customers`` ids, without a stored or sorted template."""
    cells = [(F.col("period"), True), (F.floor(F.col("customer_unit_id") / customers), True)]
    return number_in_cells(template, _template_order(), cells, "id")


def team_names(team: DataFrame, dc: DataFrame, names: Sequence[str] = KPI_TEAMS) -> DataFrame:
    """Teams that report under their own name, with their delivery center."""
    centers = dc.select(F.col("id").alias("dc_id"), F.col("name").alias("_center"))
    return team.filter(same_text(F.col("name"), *names)).join(centers, "dc_id", "left").select(
        F.col("name").alias("_team"), text_key(F.col("_center")).alias("_dc")
    )


def measure_counts(
    data: DataFrame, teams: DataFrame, day: str, periods: Sequence[str], kpi, per_period: bool = False
) -> DataFrame:
    """Records per delivery center, team, customer and KPI whose ``day`` falls in ``periods``.

    Records are counted per center and customer first; the teams of a center join the counts.
    ``data`` has record_id, delivery_center, customer_name, doubles and the day.
    """
    per = [period_of(F.col(day)).alias("period")] if per_period else []
    names = ["period"] if per_period else []
    counted = (
        data.filter(in_periods(F.col(day), periods) & (F.col("doubles") == 0))
        .groupBy(
            text_key(F.col("delivery_center")).alias("_dc"), text_key(F.col("customer_name")).alias("_customer"),
            kpi.alias("kpi"), *per,
        )
        .agg(
            F.min("delivery_center").alias("_center"), F.min("customer_name").alias("customer_name"),
            F.count("record_id").alias("n_records"),
        )
    )
    return counted.join(teams, "_dc", "left").select(
        F.coalesce("_team", "_center").alias("team"), "customer_name", "kpi", *names, "n_records", F.col("_dc").alias("center_key")
    )


def received_counts(data: DataFrame, teams: DataFrame, periods: Sequence[str], per_period: bool = False) -> DataFrame:
    return measure_counts(data, teams, "input_received", periods, F.lit(KPI_RECEIVED), per_period)


def finished_counts(data: DataFrame, teams: DataFrame, periods: Sequence[str], per_period: bool = False) -> DataFrame:
    """Finished records by the KPI of their request type; other types have a NULL KPI."""
    finished = data.filter(same_text(F.col("status"), *FINISHED_STATUSES))
    kpi = request_type_to_kpi(F.col("request_type"))
    return measure_counts(finished, teams, "finished_date", periods, kpi, per_period)


def all_counts(data: DataFrame, teams: DataFrame, periods: Sequence[str], per_period: bool = False) -> DataFrame:
    """Received and finished records under the product they are reported as; their KPIs have different names."""
    return (
        received_counts(data, teams, periods, per_period)
        .withColumn("product", F.lit(INVALID_PRODUCT_RECEIVED))
        .unionByName(finished_counts(data, teams, periods, per_period).withColumn("product", F.lit(PRODUCT)))
    )


def kpi_report(
    template: DataFrame, data: DataFrame, teams: DataFrame, periods: Sequence[str], per_period: bool = False
) -> DataFrame:
    """Filled template plus invalid combinations, unsorted (see ``sorted_report``).

    By default every period row of a combination shows the count over all periods, as the report always
    did; ``per_period=True`` splits the counts. Where several centers report one team and customer, the
    first center by name fills the template.
    """
    return report_from_counts(template, all_counts(data, teams, periods, per_period), per_period)


def report_from_counts(template: DataFrame, counts: DataFrame, per_period: bool = False) -> DataFrame:
    """The report from counted records, one pass over the template for all KPIs.

    ``template`` has a row per period, or one per offer with the array ``periods`` (``kpi_offers``); offers meet the counts
    before the periods multiply them.
    """
    listed = ("periods", "period") if "periods" in template.columns else None
    keys = MEASURE_KEYS + (["period"] if per_period else [])
    columns = ["period", "team", "product", "kpi", "customer_name", "value"]
    one = first_per_key(
        counts.withColumns({f"_{k}": text_key(F.col(k)) for k in keys}), [f"_{k}" for k in keys], [F.col("center_key")]
    )
    own = ["periods" if listed and c == "period" else c for c in columns]
    filled = fill_measures(template.select(*own), one, keys, [KPI_RECEIVED, *REQUEST_TYPE_KPIS.values()], listed)
    known = (template, MEASURE_KEYS, listed) if listed and per_period else (template, keys)
    invalid = unmatched(counts, *known).select(
        F.lit(INVALID).alias("period"), "team", "product", "kpi", "customer_name", F.col("n_records").cast("double").alias("value")
    )
    return filled.unionByName(invalid)


def store_counts(data: DataFrame, teams: DataFrame, path: str, run_id: str, periods: Sequence[str]) -> versions.Version:
    """Count the records of ``periods`` and store them as one run; counting them again replaces that run only.

    A period belongs to one run. The counts are split by period, so runs add up to any selection of periods.
    """
    return versions.append_run(all_counts(data, teams, periods, per_period=True), path, run_id)


def stored_counts(spark: SparkSession, path: str, periods: Sequence[str], per_period: bool = False) -> DataFrame:
    """The counts of ``periods`` from all runs, added up unless ``per_period``; no record is read."""
    found = versions.read(spark, path).filter(F.col("period").isin(*periods))
    if per_period:
        return found
    names = {f"_{c}": text_key(F.col(c)) for c in ("team", "customer_name")}
    added = found.withColumns(names).groupBy("center_key", "product", "kpi", *names).agg(
        F.min("team").alias("team"), F.min("customer_name").alias("customer_name"), F.sum("n_records").alias("n_records")
    )
    return added.drop(*names)


def sorted_report(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc("period"), "product", "team", "kpi", "customer_name")
