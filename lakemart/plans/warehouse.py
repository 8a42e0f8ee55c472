"""The warehouse: raw zone, clean lines and the star, written once and read by every report."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.operators import cleanse, dims, fact, quality
from lakemart.session import shuffle_width, work_dir
from lakemart.sinks.tables import write_bucketed, write_table
from lakemart.sources import retail

RUN_ID = "ETL_RUN"
LOADED_AT = "2001-09-01 00:00:00"


@dataclass(frozen=True)
class Settings:
    """What a load needs besides the lines. Time and run id are fixed once, when the settings are made."""

    as_of: str | None = None
    run_id: str = field(default_factory=lambda: f"ETL_{uuid4().hex}")
    loaded_at: str = field(default_factory=lambda: datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S"))
    product_classes: list | None = None
    monetary_bins: tuple | None = None
    tier_bins: tuple | None = None
    recency_bins: tuple | None = None

    def as_of_column(self) -> Column | None:
        return F.lit(self.as_of).cast("date") if self.as_of else None


@dataclass(frozen=True)
class Star:
    """The star schema as frames over written tables."""

    fact: DataFrame
    date: DataFrame
    customer: DataFrame
    product: DataFrame
    location: DataFrame
    channel: DataFrame
    tops: dict[str, int] = field(default_factory=dict)     # largest value of the dense keys

    def tables(self) -> dict[str, DataFrame]:
        return {
            "DimDate": self.date, "DimCustomer": self.customer, "DimProduct": self.product,
            "DimLocation": self.location, "DimChannel": self.channel, "FactSales": self.fact,
        }


def key_tops(lines: DataFrame, customer: DataFrame, product: DataFrame, location: DataFrame) -> DataFrame:
    """One row with the largest value of every dense key (0 where a table is empty)."""
    tops = {"InvoiceKey": lines, "CustomerKey": customer, "ProductKey": product, "LocationKey": location}
    one = lines.sparkSession.range(1)
    return one.select(*[
        F.coalesce(table.agg(F.max(key)).scalar(), F.lit(0)).cast("long").alias(key) for key, table in tops.items()])


class Warehouse:
    """Builds each table on first use and writes it under ``root``."""

    def __init__(self, spark: SparkSession, root: str, raw: Callable[[], DataFrame],
                 geo: DataFrame | None = None, settings: Settings | None = None, dealt: int | None = None,
                 whole: bool = False):
        """``dealt`` says that the raw lines come dealt by the hash of InvoiceNo into that many partitions,
        ``whole`` that the fact is written with all its columns, as other sessions read it."""
        self.spark, self.root, self.geo, self.dealt, self.whole = spark, root, geo, dealt, whole
        self.settings = settings or Settings()
        self._raw = raw
        self._tables: dict[str, DataFrame] = {}
        self._tops: dict[str, int] | None = None
        self._score: float | None = None

    def _table(self, name: str, build: Callable[[], DataFrame], partition_by: list[str] | None = None,
               dealt: bool = False) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = write_table(build(), f"{self.root}/{name}", partition_by, dealt)
        return self._tables[name]

    def keep(self, name: str, df: DataFrame, partition_by: list[str] | None = None, dealt: bool = False) -> DataFrame:
        """Write a table built elsewhere into this warehouse's folder and return it read back."""
        return self._table(name, lambda: df, partition_by, dealt)

    @property
    def width(self) -> int:
        """Partitions that lines lie in by invoice."""
        return self.dealt or shuffle_width(self.spark)

    def keep_by_invoice(self, name: str, df: DataFrame, dealt: bool = True) -> DataFrame:
        """``keep`` for lines, written by invoice; ``dealt`` says that they lie so already."""
        if name not in self._tables:
            self._tables[name] = write_bucketed(df, f"{self.root}/{name}", ["InvoiceNo"], self.width, dealt)
        return self._tables[name]

    def replace(self, name: str, df: DataFrame) -> None:
        """Let a frame over written tables stand for a table from now on."""
        self._tables[name] = df

    def members_of(self, lines: DataFrame, root: str) -> Warehouse:
        """A warehouse with the dimensions of the given clean lines of this one's raw zone: itself where it has its own lines."""
        if "lines" in self._tables:
            return self
        other = Warehouse(self.spark, root, lambda: self.raw, self.geo, self.settings, self.dealt)
        other.replace("lines", lines)
        return other

    @property
    def raw(self) -> DataFrame:
        if self.dealt and "raw" not in self._tables:
            self._tables["raw"] = write_bucketed(self._raw(), f"{self.root}/raw", ["InvoiceNo"], self.dealt, dealt=True)
        return self._table("raw", self._raw)

    @property
    def typed(self) -> DataFrame:
        return cleanse.typed_lines(self.raw)

    @property
    def counted(self) -> DataFrame:
        """Different lines with reason and copies; one shuffle for clean lines, quarantine and funnel.

        The shuffle is by invoice, of which all copies of a line share one, and the table lies by
        invoice: the totals of an invoice and their way back to its lines need no other. Lines
        that come dealt by invoice need none at all.
        """
        if "counted" not in self._tables:
            # read the raw zone where it is written, else go straight from the source
            source = self._tables.get("raw")
            typed = cleanse.typed_lines(source if source is not None else self._raw())
            self.keep_by_invoice("counted", cleanse.counted_lines(
                typed if self.dealt else typed.repartition(self.width, "InvoiceNo")))
        return self._tables["counted"]

    @property
    def lines(self) -> DataFrame:
        def build() -> DataFrame:
            if not self.dealt:
                return cleanse.with_invoice(cleanse.clean_from(self.counted), self._by_invoice)
            if "counted" in self._tables:
                return cleanse.with_invoice_in_place(cleanse.clean_from(self.counted), self.dealt)
            # both sides of the join read the same shuffle, or the raw zone: folding twice is cheaper than one more table
            source = self._tables.get("raw")
            typed = cleanse.typed_lines(source if source is not None else self._raw())
            return cleanse.with_invoice_in_place(cleanse.clean_from(cleanse.counted_lines(typed)), self.dealt)

        if "lines" not in self._tables:
            self.keep_by_invoice("lines", build())
        return self._tables["lines"]

    @property
    def _by_invoice(self) -> str:
        """How lines meet their invoice: of lines that come dealt, a partition's invoices are few enough to be hashed."""
        return "shuffle_hash" if self.dealt else "merge"

    @property
    def date(self) -> DataFrame:
        return self._table("dim_date", lambda: dims.dim_date(self.lines))

    @property
    def location(self) -> DataFrame:
        return self._table("dim_location", lambda: dims.dim_location(self.lines, self.geo))

    @property
    def customer(self) -> DataFrame:
        s = self.settings

        def build() -> DataFrame:
            metrics = self._table("customer_metrics", lambda: dims.customer_metrics(self.lines))
            return dims.dim_customer(
                self.lines, s.as_of_column(), s.monetary_bins, s.tier_bins, s.recency_bins, metrics
            )

        return self._table("dim_customer", build)

    @property
    def product(self) -> DataFrame:
        def build() -> DataFrame:
            metrics = self._table("product_metrics", lambda: dims.product_metrics(self.lines, "InvoiceNo"))
            return dims.dim_product(self.lines, self.settings.product_classes, metrics)

        return self._table("dim_product", build)

    @property
    def channel(self) -> DataFrame:
        return self._table("dim_channel", lambda: dims.dim_channel(self.spark))

    def assemble_fact(self) -> DataFrame:
        """The fact without its line and invoice keys: its lines meet the dimensions once, for checks and rows."""
        return self.star().fact.drop("SalesKey", "InvoiceKey")

    @property
    def unscored(self) -> DataFrame:
        """The fact, written once: its checks read it, and their score is added where it is read.

        A load's parts are read by other sessions and are written whole. A warehouse over order tables
        writes keys and values only; what is constant or follows from them is added where they are read. Only
        DaysToDeliver is written with them: a plan that names it once scans the fact once.
        """
        s, months, at = self.settings, ["SaleYear", "SaleMonth"], F.lit(self.settings.loaded_at).cast("timestamp_ntz")
        if self.dealt and not self.whole and "fact_sales" not in self._tables:
            rows = self._table("fact_rows", lambda: fact.rows_by_month(
                fact.with_buyer(self.lines.drop("TotalRevenue"), self.customer, self._by_invoice, self.dealt), self.date, self.customer,
                self.product, self.location).withColumn("DaysToDeliver", F.lit(0)), months, dealt=True)
            self._tables["fact_sales"] = fact.from_rows(rows, s.run_id, at)
        return self._table("fact_sales", lambda: fact.fact_by_month(
            fact.with_buyer(fact.with_sales_key(self.lines.drop("TotalRevenue")), self.customer, self._by_invoice, self.dealt),
            self.date, self.customer, self.product, self.location, s.run_id, at), months, dealt=True)

    @property
    def checks(self) -> DataFrame:
        return self._table("fact_checks", lambda: quality.run_all_checks(self.unscored, "FactSales", ["SalesKey"]))

    @property
    def score(self) -> float:
        if self._score is None:
            self._score = float(quality.quality_score(self.checks).first()[0])
        return self._score

    @property
    def fact(self) -> DataFrame:
        return fact.scored(self.unscored, self.score)

    @property
    def tops(self) -> dict[str, int]:
        """Largest value of every dense key: one row."""
        row = self._table("key_tops", lambda: key_tops(self.lines, self.customer, self.product, self.location)).first()
        return row.asDict()

    def write(self, name: str) -> DataFrame:
        """Build and write one table by its attribute name."""
        return getattr(self, name)

    def star(self) -> Star:
        """All tables. The dimensions do not depend on each other, so their jobs run side by side."""
        if "fact_sales" not in self._tables:
            self.write("lines")
            with ThreadPoolExecutor(4) as pool:
                list(pool.map(self.write, ("customer", "product", "location", "date")))
        if self._tops is None:
            self._tops = self.tops
        return Star(self.fact, self.date, self.customer, self.product, self.location, self.channel, self._tops)


_OPEN: dict[tuple, Warehouse] = {}


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Changes whenever a source file does: one aggregate over the file listing."""
    names = ("lineitem", "orders", "customer", "nation", "region", "part")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(
        [f"{sf_dir}/{n}.parquet" for n in names]
    )
    mark = files.agg(F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)"))).first()[0]
    return str(abs(int(mark or 0)))


# --- cut-offs for the driver's money scale, one literal per branch -----------
DRIVER_SETTINGS = Settings(
    as_of="2001-09-01",
    run_id=RUN_ID,
    loaded_at=LOADED_AT,
    product_classes=[
        (["widget", "gizmo"], ("Bags", "Handbags", "Accessories")),
        (["anvil"], ("Clothing", "Tops", "Apparel")),
        (["gear"], ("Home", "Lighting", "Decor")),
        (["plate"], ("Home", "Storage", "Organization")),
        (["bolt"], ("Office", "Stationery", "Supplies")),
        (["rod"], ("Toys", "Games", "Entertainment")),
    ],
    monetary_bins=([0, 580000, 772000, 928000, None], ["Low", "Medium", "High", "Premium"]),
    tier_bins=([0, 580000, 772000, 928000, None], ["Bronze", "Silver", "Gold", "Platinum"]),
    recency_bins=([0, 60, 120, 300, None], ["Champions", "Loyal", "Potential", "At Risk"]),
)


def new_warehouse(spark: SparkSession, sf_dir: str, root: str) -> Warehouse:
    """A warehouse over a folder of order tables, written under ``root``."""
    width = retail.invoice_width(spark, sf_dir)
    return Warehouse(spark, root, lambda: retail.retail_lines(spark, sf_dir, width), retail.country_lookup(spark, sf_dir),
                     DRIVER_SETTINGS, width)


def open_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse over a folder of order tables; built once per session and source state."""
    mark = _fingerprint(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, mark)
    if key not in _OPEN:
        _OPEN[key] = new_warehouse(spark, sf_dir, work_dir(spark, "warehouse", mark))
    return _OPEN[key]
