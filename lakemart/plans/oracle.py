"""The registered queries as plain SQL over the order tables, for checking results."""

from __future__ import annotations

AS_OF = "DATE '2001-09-01'"

# --- building blocks: named subqueries, in dependency order -------------------
BLOCKS: dict[str, str] = {}

BLOCKS["raw"] = """
  SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country
  FROM (
    SELECT
      CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_orderkey % 3 = 0
           THEN 'C' || CAST(l_orderkey AS VARCHAR) ELSE CAST(l_orderkey AS VARCHAR) END AS InvoiceNo,
      'P' || CAST(l_partkey AS VARCHAR) AS StockCode,
      CASE WHEN l_partkey % 89 = 4 THEN '' ELSE upper(p_name) END AS Description,
      CASE WHEN l_orderkey % 50 = 7 THEN -CAST(l_quantity AS INTEGER) ELSE CAST(l_quantity AS INTEGER) END AS Quantity,
      CASE WHEN l_orderkey % 97 = 3 THEN NULL ELSE o_orderdate END AS InvoiceDate,
      CASE WHEN l_partkey % 101 = 5 THEN CAST(0 AS DECIMAL(10,2)) ELSE CAST(p_retailprice AS DECIMAL(10,2)) END AS UnitPrice,
      CASE WHEN o_custkey % 20 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
      n_name AS Country,
      unnest(CASE WHEN l_orderkey % 40 = 1 THEN [0, 1] ELSE [0] END) AS copy
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN part ON l_partkey = p_partkey
  )
"""
BLOCKS["typed"] = """
  SELECT * REPLACE (coalesce(CustomerID, 'UNKNOWN') AS CustomerID) FROM raw
"""
BLOCKS["judged"] = """
  SELECT *, CASE
      WHEN starts_with(InvoiceNo, 'C') THEN 'cancelled_orders'
      WHEN Quantity IS NULL OR Quantity <= 0 OR Quantity > 100000 THEN 'invalid_quantities'
      WHEN UnitPrice IS NULL OR UnitPrice <= 0 OR UnitPrice > 50000 THEN 'invalid_prices'
      WHEN InvoiceDate IS NULL THEN 'missing_critical_data' END AS reason
  FROM typed
"""
BLOCKS["kept"] = "SELECT * EXCLUDE (reason) FROM judged WHERE reason IS NULL"
BLOCKS["unique_lines"] = "SELECT DISTINCT * FROM kept"
BLOCKS["lines"] = """
  SELECT *, CAST(Quantity * UnitPrice AS DECIMAL(12,2)) AS TotalRevenue,
         CAST(sum(Quantity) OVER (PARTITION BY InvoiceNo) AS BIGINT) AS OrderQuantity
  FROM unique_lines WHERE trim(StockCode) <> '' AND trim(Description) <> ''
"""
BLOCKS["d"] = """
  SELECT CAST(row_number() OVER (ORDER BY FullDate) AS BIGINT) AS DateKey, FullDate,
    CAST(day(FullDate) AS INTEGER) AS Day, CAST(month(FullDate) AS INTEGER) AS Month,
    CAST(year(FullDate) AS INTEGER) AS Year, CAST(quarter(FullDate) AS INTEGER) AS Quarter,
    CAST(isodow(FullDate) - 1 AS INTEGER) AS DayOfWeek, CAST(dayofyear(FullDate) AS INTEGER) AS DayOfYear,
    CAST(weekofyear(FullDate) AS INTEGER) AS WeekNumber, strftime(FullDate, '%a') AS DayName,
    strftime(FullDate, '%B') AS MonthName, 'Q' || CAST(quarter(FullDate) AS VARCHAR) AS QuarterName,
    isodow(FullDate) >= 6 AS IsWeekend, FALSE AS IsHoliday, isodow(FullDate) < 6 AS IsBusinessDay,
    CAST(CASE WHEN month(FullDate) >= 4 THEN year(FullDate) ELSE year(FullDate) - 1 END AS INTEGER) AS FiscalYear,
    CAST(CASE WHEN month(FullDate) >= 4 THEN quarter(FullDate) ELSE 4 END AS INTEGER) AS FiscalQuarter,
    CAST(CASE WHEN month(FullDate) >= 4 THEN month(FullDate) - 3 ELSE month(FullDate) + 9 END AS INTEGER) AS FiscalMonth,
    CAST(CASE quarter(FullDate) WHEN 1 THEN 4 ELSE quarter(FullDate) - 1 END AS INTEGER) AS FiscalQuarterApr,
    CASE WHEN month(FullDate) IN (12, 1, 2) THEN 'Winter' WHEN month(FullDate) IN (3, 4, 5) THEN 'Spring'
         WHEN month(FullDate) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS Season,
    month(FullDate) = 12 AS IsPeakSeason
  FROM (SELECT DISTINCT CAST(InvoiceDate AS DATE) AS FullDate FROM lines)
"""
BLOCKS["geo"] = """
  SELECT n_name AS Country, r_name || CASE WHEN n_nationkey % 2 = 0 THEN ' North' ELSE ' South' END AS Region,
         r_name AS Continent, substr(r_name, 1, 3) AS Currency, n_nationkey = 0 AS IsPrimaryMarket
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 9 <> 8
"""
BLOCKS["l"] = """
  SELECT CAST(row_number() OVER (ORDER BY p.Country) AS BIGINT) AS LocationKey, p.Country AS Country,
    coalesce(Region, 'Unknown') AS Region, coalesce(Continent, 'Unknown') AS Continent, 'Unknown' AS City,
    'Unknown' AS PostalCode, CAST(NULL AS DOUBLE) AS Latitude, CAST(NULL AS DOUBLE) AS Longitude,
    CAST(NULL AS DOUBLE) AS GDP, CAST(NULL AS INTEGER) AS Population,
    coalesce(Currency, 'Unknown') AS Currency, 'Unknown' AS TimeZone, 'Unknown' AS MarketSize,
    'Unknown' AS MarketMaturity, coalesce(IsPrimaryMarket, FALSE) AS IsPrimaryMarket
  FROM (SELECT DISTINCT Country FROM lines) p LEFT JOIN geo ON p.Country = geo.Country
"""
BLOCKS["cm"] = """
  SELECT CustomerID, first(Country ORDER BY InvoiceDate, InvoiceNo, Country) AS Country,
    CAST(min(InvoiceDate) AS DATE) AS FirstPurchaseDate, CAST(max(InvoiceDate) AS DATE) AS LastPurchaseDate,
    count(InvoiceDate) AS TotalOrders, sum(TotalRevenue) AS rev,
    CAST(sum(TotalRevenue) AS DOUBLE) / count(TotalRevenue) AS AverageOrderValue,
    CAST(sum(Quantity) AS BIGINT) AS TotalQuantity
  FROM lines GROUP BY CustomerID
"""
BLOCKS["ck"] = """
  SELECT *, CAST(row_number() OVER (ORDER BY CustomerID) AS BIGINT) AS CustomerKey,
    CAST(%s - LastPurchaseDate AS INTEGER) AS rec
  FROM cm WHERE CustomerID <> 'UNKNOWN'
""" % AS_OF
BLOCKS["c"] = """
  SELECT CustomerKey, CustomerID, Country,
    coalesce(rb, 'nan') || '_' || coalesce(mb, 'nan') AS CustomerSegment,
    CASE WHEN rev > 0 AND rev <= 580000 THEN 'Bronze' WHEN rev > 580000 AND rev <= 772000 THEN 'Silver'
         WHEN rev > 772000 AND rev <= 928000 THEN 'Gold' WHEN rev > 928000 THEN 'Platinum' END AS CustomerTier,
    rb AS RecencySegment,
    CASE WHEN TotalOrders > 0 AND TotalOrders <= 1 THEN 'New' WHEN TotalOrders > 1 AND TotalOrders <= 3 THEN 'Occasional'
         WHEN TotalOrders > 3 AND TotalOrders <= 10 THEN 'Regular' WHEN TotalOrders > 10 THEN 'VIP' END AS FrequencySegment,
    mb AS MonetarySegment, CAST(rev AS DOUBLE) AS CustomerLifetimeValue, rec AS CustomerRecency,
    TotalOrders AS CustomerFrequency, CAST(rev AS DOUBLE) AS CustomerMonetary, FirstPurchaseDate, LastPurchaseDate,
    TotalOrders, CAST(rev AS DOUBLE) AS TotalRevenue, AverageOrderValue, TotalQuantity,
    'Unknown' AS AgeGroup, 'Unknown' AS Gender, NOT rec > 365 AS IsActive,
    CASE WHEN rec > 730 THEN 'Churned' WHEN rec > 365 THEN 'Inactive' ELSE 'Active' END AS CustomerStatus
  FROM (SELECT *,
      CASE WHEN rec > 0 AND rec <= 60 THEN 'Champions' WHEN rec > 60 AND rec <= 120 THEN 'Loyal'
           WHEN rec > 120 AND rec <= 300 THEN 'Potential' WHEN rec > 300 THEN 'At Risk' END AS rb,
      CASE WHEN rev > 0 AND rev <= 580000 THEN 'Low' WHEN rev > 580000 AND rev <= 772000 THEN 'Medium'
           WHEN rev > 772000 AND rev <= 928000 THEN 'High' WHEN rev > 928000 THEN 'Premium' END AS mb
    FROM ck)
  UNION ALL
  SELECT 0, 'UNKNOWN', 'UNKNOWN', 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown', 0, NULL, 0, 0, NULL, NULL,
    0, 0, 0, 0, 'Unknown', 'Unknown', FALSE, 'Unknown'
"""
BLOCKS["pm"] = """
  SELECT StockCode, first(Description ORDER BY InvoiceDate, InvoiceNo, Description) AS Description,
    sum(TotalRevenue) AS rev, CAST(sum(TotalRevenue) AS DOUBLE) / count(*) AS AverageRevenue,
    CAST(sum(Quantity) AS BIGINT) AS TotalQuantitySold, CAST(sum(Quantity) AS DOUBLE) / count(*) AS AverageOrderQuantity,
    CAST(sum(UnitPrice) AS DOUBLE) / count(*) AS AveragePrice, min(UnitPrice) AS MinPrice, max(UnitPrice) AS MaxPrice,
    count(DISTINCT InvoiceNo) AS UniqueOrders
  FROM lines GROUP BY StockCode
"""
BLOCKS["p"] = """
  SELECT CAST(row_number() OVER (ORDER BY StockCode) AS BIGINT) AS ProductKey, StockCode, Description,
    CASE WHEN Description = '' THEN 'Unknown' WHEN t LIKE '%widget%' OR t LIKE '%gizmo%' THEN 'Bags'
      WHEN t LIKE '%anvil%' THEN 'Clothing' WHEN t LIKE '%gear%' THEN 'Home' WHEN t LIKE '%plate%' THEN 'Home'
      WHEN t LIKE '%bolt%' THEN 'Office' WHEN t LIKE '%rod%' THEN 'Toys' ELSE 'General' END AS ProductCategory,
    CASE WHEN Description = '' THEN 'Unknown' WHEN t LIKE '%widget%' OR t LIKE '%gizmo%' THEN 'Handbags'
      WHEN t LIKE '%anvil%' THEN 'Tops' WHEN t LIKE '%gear%' THEN 'Lighting' WHEN t LIKE '%plate%' THEN 'Storage'
      WHEN t LIKE '%bolt%' THEN 'Stationery' WHEN t LIKE '%rod%' THEN 'Games' ELSE 'Miscellaneous' END AS ProductSubcategory,
    'Unknown' AS ProductBrand,
    CASE WHEN Description = '' THEN 'Unknown' WHEN t LIKE '%widget%' OR t LIKE '%gizmo%' THEN 'Accessories'
      WHEN t LIKE '%anvil%' THEN 'Apparel' WHEN t LIKE '%gear%' THEN 'Decor' WHEN t LIKE '%plate%' THEN 'Organization'
      WHEN t LIKE '%bolt%' THEN 'Supplies' WHEN t LIKE '%rod%' THEN 'Entertainment' ELSE 'Other' END AS ProductLine,
    AveragePrice AS StandardPrice, AveragePrice * 0.6::DOUBLE AS CostPrice,
    round((AveragePrice - AveragePrice * 0.6::DOUBLE) / AveragePrice * 100, 2) AS ProfitMargin,
    'Unknown' AS ProductSize, 'Unknown' AS ProductColor, 'Unknown' AS ProductMaterial,
    CAST(NULL AS DOUBLE) AS ProductWeight, TotalQuantitySold, CAST(rev AS DOUBLE) AS TotalRevenue, AverageRevenue,
    AverageOrderQuantity, CAST(MinPrice AS DOUBLE) AS MinPrice, CAST(MaxPrice AS DOUBLE) AS MaxPrice, UniqueOrders,
    TRUE AS IsActive, 'Active' AS ProductStatus, CAST(NULL AS DATE) AS LaunchDate,
    CAST(NULL AS DATE) AS DiscontinuationDate
  FROM (SELECT *, lower(Description) AS t FROM pm)
"""
BLOCKS["f"] = """
  SELECT d.DateKey, coalesce(ck.CustomerKey, 0) AS CustomerKey, p.ProductKey, l.LocationKey, 1 AS ChannelKey,
    lines.InvoiceNo, 1 AS LineItemNo, lines.Quantity, lines.UnitPrice, lines.TotalRevenue, lines.OrderQuantity,
    d.FullDate, d.Year AS Year, d.Month AS Month
  FROM lines
  JOIN d ON CAST(lines.InvoiceDate AS DATE) = d.FullDate
  JOIN p ON lines.StockCode = p.StockCode
  JOIN l ON lines.Country = l.Country
  LEFT JOIN ck ON lines.CustomerID = ck.CustomerID
"""
NEEDS = {
    "raw": [], "typed": ["raw"], "judged": ["typed"], "kept": ["judged"], "unique_lines": ["kept"],
    "lines": ["unique_lines"], "d": ["lines"], "geo": [], "l": ["lines", "geo"], "cm": ["lines"], "ck": ["cm"],
    "c": ["ck"], "pm": ["lines"], "p": ["pm"], "f": ["lines", "d", "p", "l", "ck"],
}
STAR = ("f", "d", "c", "p", "l")


def _with(final: str, *blocks: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a SELECT with the blocks it needs."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS[name]:
            add(need)
        if name not in wanted:
            wanted.append(name)

    for block in blocks:
        add(block)
    # the early blocks are inlined: they feed several readers with different columns
    inline = {"raw", "typed", "judged", "kept"}
    parts = [f"{name} AS {'NOT MATERIALIZED ' if name in inline else ''}({BLOCKS[name]})" for name in wanted]
    parts += [f"{name} AS ({body})" for name, body in (extra or {}).items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + final


def _avg(col: str) -> str:
    return f"CAST(sum({col}) AS DOUBLE) / count({col})"


def _std(col: str) -> str:
    return f"round(stddev_samp(CAST({col} AS DOUBLE)), 4)"


REV = "CAST(sum(f.TotalRevenue) AS DOUBLE) AS TotalRevenue"
PIECES = "CAST(sum(f.Quantity) AS BIGINT) AS TotalQuantity"
FILTERED = (
    "l.Country IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_5', 'NATION_8', 'NATION_13') "
    "AND c.CustomerSegment IN ('Champions_Premium', 'Loyal_High', 'Potential_Low', 'At Risk_Medium', 'Champions_Low') "
    "AND p.ProductCategory IN ('Bags', 'Home', 'Office')"
)
JOINED = (
    "FROM f JOIN c ON f.CustomerKey = c.CustomerKey JOIN p ON f.ProductKey = p.ProductKey "
    "JOIN l ON f.LocationKey = l.LocationKey JOIN d ON f.DateKey = d.DateKey"
)

SQL: dict[str, str] = {}

# --- sources, typing, cleansing ------------------------------------------------
SQL["src_csv_roundtrip"] = _with("SELECT * REPLACE (CAST(UnitPrice AS DOUBLE) AS UnitPrice) FROM typed", "typed")
SQL["incr_extract"] = _with(
    "SELECT * REPLACE (CAST(UnitPrice AS DOUBLE) AS UnitPrice) FROM raw WHERE InvoiceDate >= TIMESTAMP '2000-01-01'", "raw"
)
SQL["ml_source_sales"] = _with(
    "SELECT InvoiceNo, FullDate AS InvoiceDate, CustomerKey, ProductKey, Quantity, "
    "CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(TotalRevenue AS DOUBLE) AS TotalRevenue FROM f", "f"
)
SQL["schema_check"] = _with(
    """SELECT u.column_name, TRUE AS present, u.data_type, TRUE AS type_ok,
  CASE WHEN u.column_name IN ('InvoiceDate', 'CustomerID') THEN NULL ELSE 5 END IS NULL OR n >= 5 AS filled
FROM (VALUES ('InvoiceNo', 'string'), ('StockCode', 'string'), ('Description', 'string'), ('Quantity', 'int'),
  ('InvoiceDate', 'timestamp_ntz'), ('UnitPrice', 'decimal(10,2)'), ('CustomerID', 'string'), ('Country', 'string'))
  u(column_name, data_type), (SELECT count(*) AS n FROM raw)""", "raw"
)
SQL["meta_filter_values"] = _with(
    "SELECT DISTINCT 'countries' AS list_name, Country AS value FROM l UNION "
    "SELECT 'segments', CustomerSegment FROM c WHERE CustomerSegment IS NOT NULL UNION "
    "SELECT 'categories', ProductCategory FROM p", "c", "p", "l"
)
SQL["etl_typed_raw"] = _with(
    "SELECT InvoiceNo, StockCode, Description, CASE WHEN Quantity = 13 THEN NULL ELSE Quantity END AS Quantity, "
    "InvoiceDate, CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID, Country FROM typed", "typed"
)
SQL["etl_reject_funnel"] = _with(
    """SELECT * FROM (
  SELECT 0 AS step, 'initial_records' AS rule, count(*) AS records FROM judged
  UNION ALL SELECT 1, 'cancelled_orders', count(*) FROM judged WHERE reason = 'cancelled_orders'
  UNION ALL SELECT 2, 'invalid_quantities', count(*) FROM judged WHERE reason = 'invalid_quantities'
  UNION ALL SELECT 3, 'invalid_prices', count(*) FROM judged WHERE reason = 'invalid_prices'
  UNION ALL SELECT 4, 'missing_critical_data', count(*) FROM judged WHERE reason = 'missing_critical_data'
  UNION ALL SELECT 5, 'duplicates', (SELECT count(*) FROM kept) - (SELECT count(*) FROM unique_lines)
  UNION ALL SELECT 6, 'empty_product_info', (SELECT count(*) FROM unique_lines) - (SELECT count(*) FROM lines)
  UNION ALL SELECT 7, 'final_records', count(*) FROM lines)""", "judged", "lines"
)
SQL["etl_quarantine"] = _with(
    """SELECT * REPLACE (CAST(UnitPrice AS DOUBLE) AS UnitPrice) FROM (
  SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country,
    reason AS reject_reason, count(*) AS copies FROM judged WHERE reason IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT *, 'duplicates', count(*) - 1 FROM kept GROUP BY ALL HAVING count(*) > 1
  UNION ALL
  SELECT *, 'empty_product_info', 1 FROM unique_lines WHERE trim(StockCode) = '' OR trim(Description) = '')""",
    "judged", "unique_lines"
)
SQL["etl_dedup"] = _with("SELECT * REPLACE (CAST(UnitPrice AS DOUBLE) AS UnitPrice) FROM unique_lines", "unique_lines")
SQL["etl_clean_lines"] = _with(
    "SELECT * EXCLUDE (OrderQuantity) REPLACE (CAST(UnitPrice AS DOUBLE) AS UnitPrice, "
    "CAST(TotalRevenue AS DOUBLE) AS TotalRevenue) FROM lines", "lines"
)
SQL["etl_enriched"] = _with(
    """SELECT InvoiceNo, StockCode, Quantity, CAST(TotalRevenue AS DOUBLE) AS TotalRevenue, OrderQuantity, 1 AS LineItemNo,
  d.FullDate AS InvoiceDateDate, Year AS InvoiceYear, Month AS InvoiceMonth, Quarter AS InvoiceQuarter,
  DayOfWeek AS InvoiceDayOfWeek, DayOfYear AS InvoiceDayOfYear, IsWeekend, IsBusinessDay, Season, IsPeakSeason
FROM lines JOIN d ON CAST(InvoiceDate AS DATE) = d.FullDate""", "lines", "d"
)
SQL["enrich_customer_value"] = _with(
    """SELECT CustomerID, CASE WHEN total > 900000 THEN 'High Value' WHEN total > 600000 THEN 'Medium Value'
  ELSE 'Low Value' END AS CustomerSegment, count(*) AS line_count, CAST(sum(TotalRevenue) AS DOUBLE) AS revenue
FROM (SELECT *, sum(TotalRevenue) OVER (PARTITION BY CustomerID) AS total FROM lines) GROUP BY ALL""", "lines"
)
SQL["fn_clean_text"] = (
    "SELECT t.cleaned, count(*) AS records FROM (SELECT CASE WHEN lower(trim(raw_text)) IN ('', 'nan') THEN NULL "
    "ELSE trim(raw_text) END AS cleaned FROM (SELECT CASE WHEN p_partkey % 7 = 0 THEN '   ' WHEN p_partkey % 7 = 1 "
    "THEN ' NaN ' ELSE '  ' || p_name || ' ' END AS raw_text FROM part)) t GROUP BY ALL"
)
SQL["fn_validate"] = (
    "SELECT count(*) AS records, count(*) FILTER (WHERE coalesce(q BETWEEN 1 AND 100000 AND q > 0, FALSE)) AS valid_quantity, "
    "count(*) FILTER (WHERE coalesce(p BETWEEN 0.01 AND 50000 AND p > 0, FALSE)) AS valid_price FROM ("
    "SELECT CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 50 = 7 THEN -l_quantity ELSE l_quantity END AS q, "
    "CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_extendedprice END AS p FROM lineitem)"
)

# --- dimensions and fact ----------------------------------------------------------
SQL["dim_date"] = _with("SELECT * FROM d", "d")
SQL["dim_date_basic"] = _with(
    "SELECT DateKey, FullDate, Day, Month, Year, Quarter, DayOfWeek, DayName, MonthName, IsWeekend, IsHoliday FROM d", "d"
)
SQL["dim_location"] = _with("SELECT * FROM l", "l")
SQL["dim_customer"] = _with("SELECT *, CAST(NULL AS VARCHAR) AS Region, CAST(NULL AS VARCHAR) AS Continent, "
                            "CAST(NULL AS VARCHAR) AS City FROM c", "c")
SQL["dim_customer_basic"] = _with(
    """SELECT CAST(row_number() OVER (ORDER BY CustomerID) AS BIGINT) AS CustomerKey, CustomerID, Country,
  CASE WHEN rev > 900000 THEN 'High Value' WHEN rev > 600000 THEN 'Medium Value' ELSE 'Low Value' END AS CustomerSegment,
  FirstPurchaseDate, LastPurchaseDate, CAST(rev AS DOUBLE) AS TotalRevenue, TotalQuantity, TRUE AS IsActive,
  'Active' AS CustomerStatus FROM cm""", "cm"
)
SQL["dim_product"] = _with("SELECT * FROM p", "p")
SQL["dim_product_basic"] = _with(
    """SELECT CAST(row_number() OVER (ORDER BY StockCode) AS BIGINT) AS ProductKey, StockCode, Description,
  CASE WHEN lower(Description) LIKE '%widget%' THEN 'Bags' WHEN lower(Description) LIKE '%anvil%' THEN 'Clothing'
    WHEN lower(Description) LIKE '%gear%' THEN 'Home' WHEN lower(Description) LIKE '%plate%' THEN 'Storage'
    ELSE 'General' END AS ProductCategory,
  AveragePrice AS AvgPrice, CAST(MinPrice AS DOUBLE) AS MinPrice, CAST(MaxPrice AS DOUBLE) AS MaxPrice,
  CAST(rev AS DOUBLE) AS TotalRevenue, TotalQuantitySold AS TotalQuantity, TRUE AS IsActive, 'Active' AS ProductStatus
FROM pm""", "pm"
)
SQL["surrogate_keys"] = _with(
    "SELECT 'customer' AS dimension, CustomerID AS natural_key, CustomerKey AS surrogate_key FROM ck "
    "UNION ALL SELECT 'product', StockCode, ProductKey FROM p", "ck", "p"
)
SQL["fact_sales"] = _with(
    """SELECT DateKey, CustomerKey, ProductKey, LocationKey, ChannelKey, InvoiceNo, LineItemNo, Quantity,
  CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(TotalRevenue AS DOUBLE) AS TotalRevenue, 0::DOUBLE AS CostAmount,
  CAST(TotalRevenue AS DOUBLE) AS GrossProfit, 100::DOUBLE AS GrossMargin, 0::DOUBLE AS DiscountAmount,
  CAST(TotalRevenue AS DOUBLE) AS NetRevenue, 0::DOUBLE AS TaxAmount, OrderQuantity, 0 AS ReturnQuantity,
  0::DOUBLE AS ReturnAmount, 0 AS DaysToShip, 0 AS DaysToDeliver, TIMESTAMP '2001-09-01' AS LoadTimestamp,
  'Online_Retail' AS SourceSystem, 0.5::DOUBLE AS DataQualityScore, 'ETL_RUN' AS ETLRunID,
  Year AS SaleYear, Month AS SaleMonth FROM f""", "f"
)
SQL["fact_fk_missing"] = _with(
    """SELECT count(*) AS records, count(*) FILTER (WHERE d.DateKey IS NULL) AS missing_DateKey,
  count(*) FILTER (WHERE lines.CustomerID <> 'UNKNOWN' AND ck.CustomerKey IS NULL) AS missing_CustomerKey,
  count(*) FILTER (WHERE p.ProductKey IS NULL) AS missing_ProductKey, count(*) FILTER (WHERE l.LocationKey IS NULL) AS missing_LocationKey,
  CAST(0 AS BIGINT) AS missing_ChannelKey,
  count(*) FILTER (WHERE d.DateKey IS NULL OR (lines.CustomerID <> 'UNKNOWN' AND ck.CustomerKey IS NULL) OR p.ProductKey IS NULL
    OR l.LocationKey IS NULL) AS missing_any
FROM lines
LEFT JOIN (SELECT * FROM d WHERE Month <> 7) d ON CAST(lines.InvoiceDate AS DATE) = d.FullDate
LEFT JOIN (SELECT * FROM p WHERE ProductKey % 10 <> 0) p ON lines.StockCode = p.StockCode
LEFT JOIN l ON lines.Country = l.Country
LEFT JOIN (SELECT * FROM ck WHERE CustomerKey % 25 <> 0) ck ON lines.CustomerID = ck.CustomerID""",
    "lines", "d", "p", "l", "ck"
)
SQL["fact_validation"] = _with(
    "SELECT count(*) FILTER (WHERE TotalRevenue <= 0) AS invalid_revenue, count(*) FILTER (WHERE InvoiceNo IS NULL OR Quantity IS NULL OR UnitPrice IS NULL) "
    "AS missing_critical, count(*) FILTER (WHERE Quantity > 40) AS extreme_quantity, count(*) FILTER (WHERE UnitPrice > 950) AS extreme_price FROM f", "f"
)
SQL["fact_unknown_fanout"] = _with(
    """SELECT CustomerID, count(*) AS line_count, CAST(sum(TotalRevenue) AS DOUBLE) AS revenue FROM (
  SELECT CustomerID, TotalRevenue FROM lines
  UNION ALL SELECT CustomerID, TotalRevenue FROM lines WHERE CustomerID = 'UNKNOWN') GROUP BY CustomerID""", "lines"
)

# --- key figures -------------------------------------------------------------------
SQL["kpi_global"] = _with(
    f"SELECT {REV}, count(DISTINCT CustomerKey) AS UniqueCustomers, {PIECES}, count(DISTINCT ProductKey) AS UniqueProducts, "
    "count(DISTINCT InvoiceNo) AS TotalOrders, "
    "round(CAST(sum(f.TotalRevenue) AS DOUBLE) / count(*), 2) AS AvgTransactionValue FROM f", "f"
)
OVERVIEW = (
    f"SELECT count(DISTINCT f.InvoiceNo) AS TotalOrders, count(DISTINCT f.CustomerKey) AS UniqueCustomers, "
    f"count(DISTINCT f.ProductKey) AS UniqueProducts, {PIECES}, {REV}, {_avg('f.TotalRevenue')} AS AvgOrderValue "
)
SQL["kpi_overview_filtered"] = _with(f"{OVERVIEW} {JOINED} WHERE {FILTERED}", *STAR)
SQL["kpi_date_range"] = _with(
    f"{OVERVIEW} FROM f WHERE FullDate BETWEEN DATE '1997-03-15' AND DATE '1999-10-02'", "f"
)
SQL["kpi_monthly"] = _with(
    "SELECT d.Year, d.Month, d.MonthName, CAST(sum(f.TotalRevenue) AS DOUBLE) AS MonthlyRevenue, "
    f"count(DISTINCT InvoiceNo) AS NumOrders, {PIECES}, count(DISTINCT CustomerKey) AS NumCustomers "
    "FROM f JOIN d ON f.DateKey = d.DateKey GROUP BY ALL", "f", "d"
)
SQL["kpi_monthly_filtered"] = _with(
    "SELECT d.Year, d.Month, d.MonthName, CAST(sum(f.TotalRevenue) AS DOUBLE) AS MonthlyRevenue, "
    f"count(DISTINCT f.InvoiceNo) AS MonthlyOrders {JOINED} WHERE {FILTERED} GROUP BY ALL", *STAR
)
SQL["kpi_segments"] = _with(
    f"SELECT c.CustomerSegment, count(DISTINCT c.CustomerKey) AS CustomerCount, {REV}, {_avg('f.TotalRevenue')} AS AvgRevenue "
    f"{JOINED} WHERE c.CustomerSegment IS NOT NULL GROUP BY ALL", *STAR
)
SQL["kpi_top_customers"] = _with(
    f"SELECT c.CustomerID, c.Country, c.CustomerSegment, count(DISTINCT f.InvoiceNo) AS TotalOrders, {REV}, "
    f"{_avg('f.TotalRevenue')} AS AvgOrderValue {JOINED} WHERE c.CustomerID <> 'UNKNOWN' "
    "GROUP BY c.CustomerKey, c.CustomerID, c.Country, c.CustomerSegment ORDER BY sum(f.TotalRevenue) DESC, c.CustomerKey LIMIT 20", *STAR
)
SQL["kpi_top_products_filtered"] = _with(
    f"SELECT p.StockCode, p.Description, p.ProductCategory, count(DISTINCT f.InvoiceNo) AS TotalOrders, {PIECES}, {REV}, "
    f"{_avg('f.UnitPrice')} AS AvgUnitPrice {JOINED} WHERE {FILTERED} "
    "GROUP BY p.ProductKey, p.StockCode, p.Description, p.ProductCategory "
    "ORDER BY sum(f.TotalRevenue) DESC, p.ProductKey LIMIT 20", *STAR
)
SQL["kpi_categories"] = _with(
    f"SELECT p.ProductCategory, count(DISTINCT p.ProductKey) AS ProductCount, {REV}, {_avg('f.TotalRevenue')} AS AvgRevenue "
    "FROM f JOIN p ON f.ProductKey = p.ProductKey GROUP BY ALL", "f", "p"
)
SQL["kpi_countries"] = _with(
    f"SELECT l.Country, l.Region, l.Continent, count(DISTINCT f.InvoiceNo) AS TotalOrders, {REV}, "
    "count(DISTINCT f.CustomerKey) AS UniqueCustomers FROM f JOIN l ON f.LocationKey = l.LocationKey GROUP BY ALL", "f", "l"
)
SQL["kpi_regions"] = _with(
    f"SELECT l.Region, l.Continent, count(DISTINCT l.Country) AS CountryCount, {REV}, "
    "count(DISTINCT f.CustomerKey) AS UniqueCustomers FROM f JOIN l ON f.LocationKey = l.LocationKey GROUP BY ALL", "f", "l"
)
SQL["kpi_region_rollup"] = _with(
    f"SELECT l.Continent, l.Region, {REV}, CAST(grouping(l.Continent, l.Region) AS INTEGER) AS Level "
    "FROM f JOIN l ON f.LocationKey = l.LocationKey GROUP BY ROLLUP (l.Continent, l.Region)", "f", "l"
)
SQL["kpi_country_totals"] = _with(
    f"SELECT l.Country, {REV}, count(DISTINCT CustomerKey) AS NumCustomers, count(DISTINCT ProductKey) AS NumProducts, {PIECES} "
    "FROM f JOIN l ON f.LocationKey = l.LocationKey GROUP BY ALL", "f", "l"
)
TOP_DESCRIPTIONS = (
    f"SELECT p.Description, {REV}, {PIECES}, count(DISTINCT f.InvoiceNo) AS NumOrders, {_avg('f.UnitPrice')} AS AvgPrice "
    "FROM f JOIN p ON f.ProductKey = p.ProductKey WHERE p.Description IS NOT NULL AND p.Description <> '' "
    "GROUP BY p.Description ORDER BY sum(f.TotalRevenue) DESC, p.Description LIMIT 20"
)
SQL["kpi_top_products"] = _with(TOP_DESCRIPTIONS, "f", "p")
SQL["kpi_top_products_qty"] = _with(
    f"SELECT * FROM ({TOP_DESCRIPTIONS}) ORDER BY TotalQuantity DESC, Description LIMIT 10", "f", "p"
)
SQL["kpi_customers_by_country"] = _with(
    f"SELECT c.Country, count(DISTINCT c.CustomerKey) AS NumCustomers, {REV}, {_avg('f.TotalRevenue')} AS AvgRevenuePerCustomer "
    "FROM f JOIN c ON f.CustomerKey = c.CustomerKey WHERE c.CustomerID <> 'UNKNOWN' GROUP BY ALL", "f", "c"
)
SQL["kpi_day_of_week"] = _with(
    f"SELECT d.DayName, d.IsWeekend, {REV}, count(DISTINCT InvoiceNo) AS NumOrders "
    "FROM f JOIN d ON f.DateKey = d.DateKey GROUP BY ALL", "f", "d"
)
SQL["kpi_date_bounds"] = _with("SELECT min(FullDate) AS min_date, max(FullDate) AS max_date FROM d", "d")
COUNTS = (
    "SELECT 'DimDate' AS table_name, count(*) AS records FROM d UNION ALL SELECT 'DimCustomer', count(*) FROM c "
    "UNION ALL SELECT 'DimProduct', count(*) FROM p UNION ALL SELECT 'DimLocation', count(*) FROM l "
    "UNION ALL SELECT 'DimChannel', 1 UNION ALL SELECT 'FactSales', count(*) FROM f"
)
SQL["wh_table_counts"] = _with(f"SELECT *, min(records) OVER () > 0 AS healthy FROM ({COUNTS})", *STAR)
SQL["load_summary"] = _with(
    f"SELECT *, 'ETL_RUN' AS etl_run_id FROM ({COUNTS} UNION ALL SELECT 'total_records', CAST(sum(records) AS BIGINT) FROM ({COUNTS}))",
    *STAR
)
SQL["wh_sanity"] = _with(
    f"SELECT count(*) AS TotalRecords, count(DISTINCT CustomerKey) AS UniqueCustomers, "
    f"count(DISTINCT ProductKey) AS UniqueProducts, {REV} FROM f", "f"
)
SQL["wh_summary"] = _with(
    "SELECT table_name AS TableName, records AS RowCount, "
    "CASE WHEN table_name = 'FactSales' THEN TIMESTAMP '2001-09-01' END AS FirstLoad, "
    "CASE WHEN table_name = 'FactSales' THEN TIMESTAMP '2001-09-01' END AS LastLoad "
    f"FROM ({COUNTS}) WHERE table_name <> 'DimChannel'", *STAR
)
SQL["load_roundtrip"] = _with(
    """SELECT 'DimDate' AS table_name, count(*) AS records, CAST(sum(DateKey) AS BIGINT) AS key_sum FROM d
UNION ALL SELECT 'DimCustomer', count(*), CAST(sum(CustomerKey) AS BIGINT) FROM c
UNION ALL SELECT 'DimProduct', count(*), CAST(sum(ProductKey) AS BIGINT) FROM p
UNION ALL SELECT 'DimLocation', count(*), CAST(sum(LocationKey) AS BIGINT) FROM l
UNION ALL SELECT 'DimChannel', 1, 1
UNION ALL SELECT 'FactSales', count(*), CAST(sum(DateKey + CustomerKey + ProductKey + LocationKey) AS BIGINT) FROM f""", *STAR
)
SQL["lineage_log"] = _with(
    """SELECT 'RawLines' AS SourceTable, 'CleanLines' AS TargetTable, (SELECT count(*) FROM raw) AS SourceRecordCount,
  (SELECT count(*) FROM lines) AS TargetRecordCount, 'Transform' AS TransformationType, 'success' AS Status
UNION ALL SELECT 'CleanLines', 'FactSales', (SELECT count(*) FROM lines), (SELECT count(*) FROM f), 'Load', 'success'""",
    "raw", "lines", "f"
)

# --- business reports -----------------------------------------------------------------
RFM = f"""
  SELECT *, RecencyScore + FrequencyScore + MonetaryScore AS RFMScore,
    CASE WHEN RecencyScore >= 4 AND FrequencyScore >= 4 AND MonetaryScore >= 4 THEN 'Champions'
      WHEN RecencyScore >= 3 AND FrequencyScore >= 3 AND MonetaryScore >= 3 THEN 'Loyal Customers'
      WHEN RecencyScore >= 4 AND FrequencyScore <= 2 AND MonetaryScore >= 3 THEN 'Potential Loyalists'
      WHEN RecencyScore >= 3 AND FrequencyScore >= 2 AND MonetaryScore <= 2 THEN 'New Customers'
      WHEN RecencyScore >= 3 AND FrequencyScore <= 2 AND MonetaryScore <= 2 THEN 'Promising'
      WHEN RecencyScore <= 2 AND FrequencyScore >= 3 AND MonetaryScore >= 3 THEN 'Need Attention'
      WHEN RecencyScore <= 2 AND FrequencyScore >= 2 AND MonetaryScore >= 2 THEN 'About to Sleep'
      WHEN RecencyScore <= 2 AND FrequencyScore <= 2 AND MonetaryScore >= 3 THEN 'At Risk'
      WHEN RecencyScore <= 2 AND FrequencyScore <= 2 AND MonetaryScore <= 2 THEN 'Cannot Lose Them'
      ELSE 'Others' END AS RFMSegment
  FROM (
    SELECT *,
      CASE WHEN LastPurchaseDate >= {AS_OF} - 60 THEN 5 WHEN LastPurchaseDate >= {AS_OF} - 120 THEN 4
        WHEN LastPurchaseDate >= {AS_OF} - 200 THEN 3 WHEN LastPurchaseDate >= {AS_OF} - 300 THEN 2 ELSE 1 END AS RecencyScore,
      CASE WHEN Frequency >= 13 THEN 5 WHEN Frequency >= 10 THEN 4 WHEN Frequency >= 8 THEN 3
        WHEN Frequency >= 6 THEN 2 ELSE 1 END AS FrequencyScore,
      CASE WHEN Monetary >= 1130000 THEN 5 WHEN Monetary >= 928000 THEN 4 WHEN Monetary >= 772000 THEN 3
        WHEN Monetary >= 580000 THEN 2 ELSE 1 END AS MonetaryScore
    FROM (
      SELECT c.CustomerKey, c.CustomerID, c.Country, c.CustomerSegment, max(f.FullDate) AS LastPurchaseDate,
        count(DISTINCT f.InvoiceNo) AS Frequency, CAST(sum(f.TotalRevenue) AS DOUBLE) AS Monetary,
        {_avg('f.TotalRevenue')} AS AvgOrderValue
      FROM f JOIN c ON f.CustomerKey = c.CustomerKey WHERE c.CustomerID <> 'UNKNOWN'
      GROUP BY c.CustomerKey, c.CustomerID, c.Country, c.CustomerSegment))
"""
CLV = f"""
  SELECT CustomerKey, CustomerID, Country, TotalOrders, rev AS TotalRevenue, AvgOrderValue, FirstPurchaseDate,
    LastPurchaseDate, years AS CustomerLifespanYears, ActiveDays,
    CASE WHEN years > 0 THEN rev / years ELSE rev END AS AnnualRevenue,
    CASE WHEN ActiveDays > 0 THEN CAST(TotalOrders AS DOUBLE) / (CAST(ActiveDays AS DOUBLE) / 30.0::DOUBLE) ELSE 0 END
      AS MonthlyOrderFrequency,
    CASE WHEN rev >= 1130000 THEN 'Premium' WHEN rev >= 928000 THEN 'Gold' WHEN rev >= 772000 THEN 'Silver'
      WHEN rev >= 580000 THEN 'Bronze' ELSE 'Basic' END AS CustomerTier
  FROM (
    SELECT c.CustomerKey, c.CustomerID, c.Country, count(DISTINCT f.InvoiceNo) AS TotalOrders,
      CAST(sum(f.TotalRevenue) AS DOUBLE) AS rev, {_avg('f.TotalRevenue')} AS AvgOrderValue,
      min(f.FullDate) AS FirstPurchaseDate, max(f.FullDate) AS LastPurchaseDate,
      CAST(max(f.FullDate) - min(f.FullDate) AS DOUBLE) / 365.0::DOUBLE AS years, count(DISTINCT f.FullDate) AS ActiveDays
    FROM f JOIN c ON f.CustomerKey = c.CustomerKey WHERE c.CustomerID <> 'UNKNOWN'
    GROUP BY c.CustomerKey, c.CustomerID, c.Country)
"""
PER_MONTH = (
    "CASE WHEN ActiveDays > 0 AND ActiveDays < 365 THEN {0} * 30.0::DOUBLE / CAST(ActiveDays AS DOUBLE) "
    "WHEN ActiveDays >= 365 THEN {0} * 30.0::DOUBLE / 365.0::DOUBLE ELSE {0} END"
)
PRODUCTS = f"""
  SELECT ProductKey, StockCode, Description, OriginalCategory, TotalOrders, TotalQuantity, rev AS TotalRevenue, AvgUnitPrice,
    UniqueCustomers, ActiveDays, FirstSaleDate, LastSaleDate,
    {PER_MONTH.format('CAST(TotalQuantity AS DOUBLE)')} AS MonthlyQuantity, {PER_MONTH.format('rev')} AS MonthlyRevenue,
    CASE WHEN UniqueCustomers > 0 THEN TotalOrders // UniqueCustomers ELSE 0 END AS OrdersPerCustomer,
    CASE WHEN TotalQuantity > 0 THEN rev / CAST(TotalQuantity AS DOUBLE) ELSE 0 END AS RevenuePerUnit,
    CASE WHEN ActiveDays > 0 THEN rev / CAST(ActiveDays AS DOUBLE) ELSE 0 END AS DailyRevenue,
    CASE WHEN ActiveDays <= 30 THEN 'New' WHEN ActiveDays <= 90 THEN 'Growing' WHEN ActiveDays <= 365 THEN 'Mature'
      ELSE 'Established' END AS LifecycleStage,
    CASE WHEN rev >= 800000 AND TotalOrders >= 30 THEN 'Star' WHEN rev >= 680000 AND TotalOrders >= 26 THEN 'Cash Cow'
      WHEN rev >= 600000 AND TotalOrders >= 24 THEN 'Question Mark' WHEN rev >= 500000 THEN 'Potential' ELSE 'Dog' END
      AS ProductCategory
  FROM (
    SELECT p.ProductKey, p.StockCode, p.Description, p.ProductCategory AS OriginalCategory,
      count(DISTINCT f.InvoiceNo) AS TotalOrders, CAST(sum(f.Quantity) AS BIGINT) AS TotalQuantity,
      CAST(sum(f.TotalRevenue) AS DOUBLE) AS rev, {_avg('f.UnitPrice')} AS AvgUnitPrice,
      count(DISTINCT f.CustomerKey) AS UniqueCustomers, count(DISTINCT f.FullDate) AS ActiveDays,
      min(f.FullDate) AS FirstSaleDate, max(f.FullDate) AS LastSaleDate
    FROM f JOIN p ON f.ProductKey = p.ProductKey
    GROUP BY p.ProductKey, p.StockCode, p.Description, p.ProductCategory) WHERE rev > 0
"""
BREADTH = (
    f"count(DISTINCT f.InvoiceNo) AS TotalOrders, {PIECES}, {REV}, {_avg('f.TotalRevenue')} AS AvgOrderValue, "
    "count(DISTINCT f.CustomerKey) AS UniqueCustomers, count(DISTINCT f.ProductKey) AS UniqueProducts"
)
MARKETS = f"""
  SELECT l.Country, l.Region, l.Continent, {BREADTH},
    CASE WHEN sum(f.TotalRevenue) >= 55000000 THEN 'Major Market' WHEN sum(f.TotalRevenue) >= 48000000 THEN 'Important Market'
      WHEN sum(f.TotalRevenue) >= 42000000 THEN 'Growing Market' ELSE 'Emerging Market' END AS MarketSegment
  FROM f JOIN l ON f.LocationKey = l.LocationKey GROUP BY l.Country, l.Region, l.Continent
"""
SQL["rfm"] = _with(RFM, "f", "c")
SQL["rfm_summary"] = _with(
    "SELECT RFMSegment, count(*) AS CustomerCount, round(CAST(sum(CAST(Monetary AS DECIMAL(22,2))) AS DOUBLE) / count(*), 2) "
    "AS AvgMonetary, round(CAST(sum(Frequency) AS DOUBLE) / count(*), 2) AS AvgFrequency FROM r GROUP BY RFMSegment",
    "f", "c", extra={"r": RFM}
)
SQL["clv"] = _with(CLV, "f", "c")
SQL["clv_summary"] = _with(
    "SELECT CustomerTier, count(*) AS CustomerCount, "
    "round(CAST(sum(CAST(TotalRevenue AS DECIMAL(22,2))) AS DOUBLE) / count(*), 2) AS AvgRevenue, "
    "CAST(sum(CAST(TotalRevenue AS DECIMAL(22,2))) AS DOUBLE) AS SumRevenue, "
    "round(avg(MonthlyOrderFrequency), 2) AS AvgOrderFrequency FROM v GROUP BY CustomerTier", "f", "c", extra={"v": CLV}
)
SQL["clv_histogram"] = _with(
    """SELECT CAST(least(CASE WHEN (hi - lo) / 20 > 0 THEN floor((TotalRevenue - lo) / ((hi - lo) / 20)) ELSE 0 END, 19) + 1 AS INTEGER)
  AS bin, count(*) AS records, min(TotalRevenue) AS smallest, max(TotalRevenue) AS largest
FROM v, (SELECT min(TotalRevenue) AS lo, max(TotalRevenue) AS hi FROM v) GROUP BY 1""", "f", "c", extra={"v": CLV}
)
SQL["clv_box"] = _with(
    """SELECT CustomerTier, records, smallest, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, largest,
  round(q1 - (q3 - q1) * 1.5::DOUBLE, 4) AS lower_fence, round(q3 + (q3 - q1) * 1.5::DOUBLE, 4) AS upper_fence FROM (
  SELECT CustomerTier, count(*) AS records, min(TotalRevenue) AS smallest, max(TotalRevenue) AS largest,
    quantile_cont(TotalRevenue, 0.25) AS q1, quantile_cont(TotalRevenue, 0.5) AS median,
    quantile_cont(TotalRevenue, 0.75) AS q3 FROM v GROUP BY CustomerTier)""", "f", "c", extra={"v": CLV}
)
SQL["product_performance"] = _with(PRODUCTS, "f", "p")
SQL["product_category_summary"] = _with(
    "SELECT ProductCategory, count(*) AS ProductCount, CAST(sum(CAST(TotalRevenue AS DECIMAL(22,2))) AS DOUBLE) AS TotalRevenue, "
    "round(CAST(sum(CAST(TotalRevenue AS DECIMAL(22,2))) AS DOUBLE) / count(*), 2) AS AvgRevenue, "
    "round(avg(MonthlyRevenue), 4) AS AvgMonthlyRevenue, round(avg(MonthlyQuantity), 4) AS AvgMonthlyQuantity "
    "FROM g GROUP BY ProductCategory", "f", "p", extra={"g": PRODUCTS}
)
SQL["product_value_counts"] = _with(
    "SELECT 'ProductCategory' AS attribute, ProductCategory AS value, count(*) AS products FROM g GROUP BY ALL "
    "UNION ALL SELECT 'LifecycleStage', LifecycleStage, count(*) FROM g GROUP BY ALL", "f", "p", extra={"g": PRODUCTS}
)
SQL["product_meaningful"] = _with(
    "SELECT count(*) AS total_products, count(*) FILTER (WHERE MonthlyQuantity > 1 AND MonthlyRevenue > 1) AS above_one, "
    "count(*) FILTER (WHERE MonthlyQuantity > 0 OR MonthlyRevenue > 0) AS above_zero, count(*) FILTER (WHERE MonthlyQuantity = 0) AS zero_quantity, "
    "count(*) FILTER (WHERE MonthlyRevenue = 0) AS zero_revenue, min(MonthlyQuantity) AS min_quantity, max(MonthlyQuantity) AS max_quantity, "
    "min(MonthlyRevenue) AS min_revenue, max(MonthlyRevenue) AS max_revenue FROM g", "f", "p", extra={"g": PRODUCTS}
)
SQL["product_top50"] = _with(
    "SELECT StockCode, Description, MonthlyQuantity, MonthlyRevenue, UniqueCustomers, ProductCategory, TotalOrders, LifecycleStage "
    "FROM g WHERE MonthlyQuantity > 1 AND MonthlyRevenue > 1 ORDER BY MonthlyRevenue DESC, ProductKey LIMIT 50",
    "f", "p", extra={"g": PRODUCTS}
)
SQL["seasonal"] = _with(
    f"SELECT d.Year, d.Month, d.MonthName, d.Quarter, {BREADTH} FROM f JOIN d ON f.DateKey = d.DateKey GROUP BY ALL", "f", "d"
)
SQL["geographic"] = _with(MARKETS, "f", "l")
COHORT = """
  SELECT f.CustomerKey, strftime(first_day, '%Y-%m') AS CohortMonth,
    CAST((year(FullDate) - year(first_day)) * 12 + month(FullDate) - month(first_day) AS INTEGER) AS PeriodNumber
  FROM f JOIN (SELECT CustomerKey, min(FullDate) AS first_day FROM f GROUP BY CustomerKey) s ON f.CustomerKey = s.CustomerKey
  WHERE f.CustomerKey <> 0
"""
SQL["cohort_literal"] = _with(
    "SELECT CohortMonth, PeriodNumber, count(DISTINCT CustomerKey) AS Customers, "
    "count(DISTINCT CASE WHEN PeriodNumber = 0 THEN CustomerKey END) AS CohortSize FROM h GROUP BY CohortMonth, PeriodNumber "
    "HAVING count(DISTINCT CASE WHEN PeriodNumber = 0 THEN CustomerKey END) > 0", "f", extra={"h": COHORT}
)
SQL["cohort_retention"] = _with(
    "SELECT h.CohortMonth, PeriodNumber, count(DISTINCT CustomerKey) AS Customers, CohortSize, "
    "CAST(count(DISTINCT CustomerKey) AS DOUBLE) / CohortSize AS RetentionRate FROM h JOIN "
    "(SELECT CohortMonth, count(DISTINCT CustomerKey) AS CohortSize FROM h GROUP BY CohortMonth) z ON h.CohortMonth = z.CohortMonth "
    "GROUP BY h.CohortMonth, PeriodNumber, CohortSize", "f", extra={"h": COHORT}
)
SQL["insights"] = _with(
    """SELECT section, metric, CAST(value AS DOUBLE) AS value, CAST(text AS VARCHAR) AS text FROM (
  SELECT 'rfm' AS section, 'total_customers' AS metric, count(*)::DOUBLE AS value, NULL AS text FROM r
  UNION ALL SELECT 'rfm', 'champions', count(*) FILTER (WHERE RFMSegment = 'Champions'), NULL FROM r
  UNION ALL SELECT 'rfm', 'at_risk', count(*) FILTER (WHERE RFMSegment = 'At Risk'), NULL FROM r
  UNION ALL SELECT 'rfm', 'new_customers', count(*) FILTER (WHERE RFMSegment = 'New Customers'), NULL FROM r
  UNION ALL SELECT 'rfm', 'avg_rfm_score', CAST(sum(RFMScore) AS DOUBLE) / count(*), NULL FROM r
  UNION ALL SELECT 'clv', 'avg_clv', CAST(sum(CAST(TotalRevenue AS DECIMAL(22,2))) AS DOUBLE) / count(*), NULL FROM v
  UNION ALL SELECT 'clv', 'premium_customers', count(*) FILTER (WHERE CustomerTier = 'Premium'), NULL FROM v
  UNION ALL SELECT 'clv', 'avg_order_frequency', round(avg(MonthlyOrderFrequency), 6), NULL FROM v
  UNION ALL SELECT 'products', 'total_products', count(*), NULL FROM g
  UNION ALL SELECT 'products', 'star_products', count(*) FILTER (WHERE ProductCategory = 'Star'), NULL FROM g
  UNION ALL SELECT 'products', 'top_product_revenue', max(TotalRevenue), NULL FROM g
  UNION ALL SELECT 'products', 'avg_product_revenue', CAST(sum(CAST(TotalRevenue AS DECIMAL(22,2))) AS DOUBLE) / count(*), NULL FROM g
  UNION ALL SELECT 'geography', 'total_countries', count(*), NULL FROM k
  UNION ALL SELECT 'geography', 'major_markets', count(*) FILTER (WHERE MarketSegment = 'Major Market'), NULL FROM k
  UNION ALL SELECT 'geography', 'top_country_revenue', max(TotalRevenue), NULL FROM k
  UNION ALL SELECT 'geography', 'top_country', NULL, max_by(Country, TotalRevenue) FROM k)""",
    *STAR, extra={"r": RFM, "v": CLV, "g": PRODUCTS, "k": MARKETS}
)

# --- declared tables --------------------------------------------------------------------
SQL["agg_daily_sales"] = _with(
    f"SELECT DateKey, CustomerKey, LocationKey, {REV}, {PIECES}, count(DISTINCT InvoiceNo) AS OrderCount, "
    "count(DISTINCT ProductKey) AS UniqueProducts, CAST(sum(f.TotalRevenue) AS DOUBLE) / count(DISTINCT InvoiceNo) AS AverageOrderValue "
    "FROM f GROUP BY DateKey, CustomerKey, LocationKey", "f"
)
MONTHLY = """SELECT {names}, rev AS TotalRevenue, q AS TotalQuantity, OrderCount,
  CAST(1 AS BIGINT) AS UniqueCustomers, UniqueProducts,
  CASE WHEN lag(rev) OVER w <> 0 THEN 100.0::DOUBLE * (rev - lag(rev) OVER w) / lag(rev) OVER w END AS RevenueGrowth,
  CASE WHEN lag(q) OVER w <> 0 THEN 100.0::DOUBLE * (q::DOUBLE - (lag(q) OVER w)::DOUBLE) / (lag(q) OVER w)::DOUBLE END AS QuantityGrowth,
  CASE WHEN lag(1) OVER w <> 0 THEN 0::DOUBLE END AS CustomerGrowth
FROM (SELECT {groups}, CAST(sum(TotalRevenue) AS DOUBLE) AS rev, CAST(sum(Quantity) AS BIGINT) AS q,
    count(DISTINCT InvoiceNo) AS OrderCount, count(DISTINCT {product}) AS UniqueProducts
  FROM {rows} GROUP BY ALL)
WINDOW w AS (PARTITION BY {member} ORDER BY Year, Month)"""
SQL["agg_monthly_sales"] = _with(MONTHLY.format(
    names="Year, Month, CustomerKey, LocationKey", groups="Year, Month, CustomerKey, LocationKey", product="ProductKey",
    rows="f", member="CustomerKey, LocationKey"), "f")
SQL["agg_daily_kept"] = _with(
    "SELECT CAST(InvoiceDate AS DATE) AS FullDate, CustomerID, Country, CAST(sum(TotalRevenue) AS DOUBLE) AS TotalRevenue, "
    "CAST(sum(Quantity) AS BIGINT) AS TotalQuantity, count(DISTINCT InvoiceNo) AS OrderCount, "
    "count(DISTINCT StockCode) AS UniqueProducts, "
    "CAST(sum(TotalRevenue) AS DOUBLE) / count(DISTINCT InvoiceNo) AS AverageOrderValue FROM lines GROUP BY ALL", "lines"
)
SQL["agg_monthly_kept"] = _with(MONTHLY.format(
    names="Year, Month, CustomerID, Country", product="StockCode", rows="lines", member="CustomerID, Country",
    groups="CAST(year(InvoiceDate) AS INTEGER) AS Year, CAST(month(InvoiceDate) AS INTEGER) AS Month, CustomerID, Country",
), "lines")
SESSIONS = """
  SELECT user_id, session, min(ts) AS session_start, max(ts) AS session_end,
    datediff('microsecond', min(ts), max(ts)) AS micros, count(*) AS events, count(*) FILTER (WHERE event_type = 'view') AS views,
    count(*) FILTER (WHERE event_type = 'click') AS clicks, count(*) FILTER (WHERE event_type = 'purchase') AS purchases
  FROM (SELECT *, sum(CASE WHEN prev IS NULL OR ts - prev >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
      OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session
    FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events))
  GROUP BY user_id, session
"""
SQL["behavior_daily"] = _with(
    """SELECT user_id AS UserID, CAST(session_start AS DATE) AS ActivityDate,
  CAST(sum(micros) AS DOUBLE) / 60000000.0::DOUBLE AS SessionDuration, CAST(sum(views) AS BIGINT) AS PageViews,
  CAST(sum(clicks) AS BIGINT) AS Clicks, 100.0::DOUBLE * count(*) FILTER (WHERE events = 1) / count(*)::DOUBLE AS BounceRate,
  100.0::DOUBLE * count(*) FILTER (WHERE purchases > 0) / count(*)::DOUBLE AS ConversionRate,
  CAST(sum(micros) AS DOUBLE) / 60000000.0::DOUBLE AS TimeOnSite, count(*) - 1 AS ReturnVisits,
  CASE WHEN count(*) FILTER (WHERE clicks > 0) > 0 THEN 100.0::DOUBLE * count(*) FILTER (WHERE clicks > 0 AND purchases = 0) / count(*) FILTER (WHERE clicks > 0)::DOUBLE END
    AS CartAbandonmentRate
FROM s GROUP BY user_id, CAST(session_start AS DATE)""", extra={"s": SESSIONS}
)
SQL["behavior_sessions"] = _with(
    "SELECT user_id, session_start, session_end, events, views, clicks, purchases FROM s", extra={"s": SESSIONS}
)
SQL["inventory_snapshot"] = _with(
    """SELECT StockCode, Country, StockDate, EndingStock - net AS BeginningStock, StockReceived, StockSold, StockReturned,
  CAST(0 AS BIGINT) AS StockAdjusted, EndingStock, CAST((EndingStock - net) * cost AS DOUBLE) AS BeginningValue,
  CAST(EndingStock * cost AS DOUBLE) AS EndingValue, CAST(cost AS DOUBLE) AS AverageCost,
  CASE WHEN (2 * EndingStock - net) <> 0 THEN CAST(StockSold AS DOUBLE) / (CAST(2 * EndingStock - net AS DOUBLE) / 2.0::DOUBLE) END AS StockTurnover,
  CASE WHEN EndingStock <= 0 THEN 1 ELSE 0 END AS StockoutDays
FROM (SELECT *, CAST(sum(net) OVER (PARTITION BY StockCode, Country ORDER BY StockDate) AS BIGINT) AS EndingStock,
    CAST(max(price) OVER (PARTITION BY StockCode, Country) * CAST(0.6 AS DECIMAL(3,1)) AS DECIMAL(14,3)) AS cost
  FROM (SELECT StockCode, Country, StockDate, CAST(sum(r) AS BIGINT) AS StockReceived, CAST(sum(s) AS BIGINT) AS StockSold,
      CAST(sum(b) AS BIGINT) AS StockReturned, CAST(sum(r) - sum(s) + sum(b) AS BIGINT) AS net, max(price) AS price
    FROM (
      SELECT StockCode, Country, CAST(InvoiceDate AS DATE) AS StockDate, 0 AS r, Quantity AS s, 0 AS b, UnitPrice AS price FROM lines
      UNION ALL SELECT StockCode, Country, CAST(InvoiceDate AS DATE), 0, 0, -Quantity, UnitPrice FROM judged
        WHERE reason = 'invalid_quantities' AND Quantity < 0 AND InvoiceDate IS NOT NULL
      UNION ALL SELECT 'P' || CAST(l_partkey AS VARCHAR), n_name, CAST(l_shipdate AS DATE), CAST(l_quantity AS INTEGER), 0, 0,
        CAST(p_retailprice AS DECIMAL(10,2))
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey WHERE l_linestatus = 'O')
    GROUP BY StockCode, Country, StockDate))""", "lines", "judged"
)

# --- features -----------------------------------------------------------------------------
SEGMENTATION = f"""
  SELECT CustomerKey, CAST({AS_OF} - max(FullDate) AS INTEGER) AS Recency, count(*) AS Frequency,
    CAST(sum(TotalRevenue) AS DOUBLE) AS Monetary,
    CAST(sum(Quantity) AS DOUBLE) / CAST(count(DISTINCT InvoiceNo) AS DOUBLE) AS AvgOrderSize,
    CAST(sum(TotalRevenue) AS DOUBLE) / CAST(count(DISTINCT InvoiceNo) AS DOUBLE) AS RevenuePerOrder,
    CAST(max(FullDate) - min(FullDate) AS INTEGER) AS CustomerLifespan
  FROM f WHERE CustomerKey <> 0 GROUP BY CustomerKey
"""
SQL["feat_segmentation"] = _with(SEGMENTATION, "f")
SQL["incr_load"] = _with(
    "SELECT InvoiceNo, StockCode, CustomerID, Country, CAST(InvoiceDate AS DATE) AS FullDate, Quantity, "
    "CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(TotalRevenue AS DOUBLE) AS TotalRevenue, OrderQuantity FROM lines", "lines"
)
SQL["ml_run_status"] = _with(
    "SELECT 'customer_segmentation' AS analysis, 'completed' AS status, CAST(5 AS BIGINT) AS records, CAST(NULL AS VARCHAR) AS message "
    "UNION ALL SELECT 'churn_prediction', 'completed', count(*), NULL FROM s "
    "UNION ALL SELECT 'demand_forecasting', 'completed', (count(DISTINCT Country) + 1) * 2 * 30, NULL FROM lines "
    "UNION ALL SELECT 'anomaly_detection', 'completed', count(DISTINCT InvoiceNo), NULL FROM f", "f", "lines", extra={"s": SEGMENTATION}
)
SQL["st_tumbling_late"] = """
WITH e AS (SELECT *, time_bucket(INTERVAL '1 hour', ts) AS w FROM events),
b AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events)
SELECT w AS window_start, w + INTERVAL '1 hour' AS window_end, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM e, b
WHERE ts >= make_timestamp((CAST(floor((floor(epoch(lo)) + floor(epoch(hi))) / 2) AS BIGINT)) * 1000000)
GROUP BY w, hi HAVING w + INTERVAL '1 hour' <= hi - INTERVAL '1 hour'
"""
SQL["feat_describe"] = _with(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 4) AS mean, "
    f"round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
    + ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), {q}), 4) AS q{int(q * 100)}" for q in (0.25, 0.5, 0.75)) + " FROM s"
    for c in ("Recency", "Frequency", "Monetary", "AvgOrderSize", "RevenuePerOrder", "CustomerLifespan")
), "f", extra={"s": SEGMENTATION})
SQL["model_roundtrip"] = _with("SELECT count(*) AS customers, CAST(0 AS BIGINT) AS differing FROM s", "f", extra={"s": SEGMENTATION})
SQL["feat_scaled"] = _with(
    "SELECT CustomerKey, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}_scaled"
        for c in ("Recency", "Frequency", "Monetary", "AvgOrderSize", "RevenuePerOrder", "CustomerLifespan")
    ) + " FROM s", "f", extra={"s": SEGMENTATION}
)
SCALED = "SELECT CustomerKey, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS x{i}"
    for i, c in enumerate(("Recency", "Frequency", "Monetary", "AvgOrderSize", "RevenuePerOrder", "CustomerLifespan"))
) + " FROM s"
DENSITY = {
    "s": SEGMENTATION,
    "z": SCALED,
    "near": "SELECT a.CustomerKey AS a, b.CustomerKey AS b FROM z a JOIN z b ON "
            + " + ".join(f"(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})" for i in range(6)) + " <= 0.5 * 0.5",
    "core": "SELECT a FROM near GROUP BY a HAVING count(*) >= 5",
    "e": "SELECT near.a, near.b FROM near JOIN core x ON near.a = x.a JOIN core y ON near.b = y.a",
    "r(a, b)": "SELECT a, a FROM core UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a",
    "low": "SELECT a, min(b) AS low FROM r GROUP BY a",
    "own": "SELECT a, dense_rank() OVER (ORDER BY low) - 1 AS n FROM low",
    "border": "SELECT near.a, min(own.n) AS n FROM near JOIN own ON near.b = own.a GROUP BY near.a",
    "segmented": "SELECT z.CustomerKey, CAST(coalesce(own.n, border.n, -1) AS INTEGER) AS Segment "
                 "FROM z LEFT JOIN own ON z.CustomerKey = own.a LEFT JOIN border ON z.CustomerKey = border.a",
}


def _density(final: str) -> str:
    return _with(final, "f", extra=DENSITY).replace("WITH ", "WITH RECURSIVE ", 1)


SQL["ml_dbscan"] = _density("SELECT * FROM segmented")
SQL["feat_churn"] = _with(
    f"""SELECT *, TotalRevenue_Mean / (TotalRevenue_Std + 1) AS RevenueTrend,
  TotalOrders_Sum / (AvgRecency + 1) AS OrderFrequency, TotalRevenue_Sum / (TotalOrders_Sum + 1) AS ValuePerOrder
FROM (SELECT CustomerKey, CAST(rev AS DOUBLE) AS TotalRevenue_Sum, CAST(rev AS DOUBLE) AS TotalRevenue_Mean,
    0::DOUBLE AS TotalRevenue_Std, CAST(TotalOrders AS DOUBLE) AS TotalOrders_Sum, CAST(TotalOrders AS DOUBLE) AS TotalOrders_Mean,
    CAST(rec AS DOUBLE) AS AvgRecency, CAST(TotalOrders AS DOUBLE) AS AvgFrequency, CAST(rev AS DOUBLE) AS AvgMonetary,
    CAST(rec AS DOUBLE) AS DaysSinceLastPurchase, CASE WHEN rec > 90 THEN 1 ELSE 0 END AS IsChurned FROM ck)""", "ck"
)
SQL["feat_invoice"] = _with(
    f"""SELECT *, TotalRevenue_Sum / (Quantity_Sum + 1) AS RevenuePerItem,
  Quantity_Sum / CAST(UniqueCustomers + 1 AS DOUBLE) AS ItemsPerCustomer, UniqueProducts AS ProductsPerOrder
FROM (SELECT InvoiceNo, CAST(sum(TotalRevenue) AS DOUBLE) AS TotalRevenue_Sum, {_avg('TotalRevenue')} AS TotalRevenue_Mean,
    coalesce({_std('TotalRevenue')}, 0) AS TotalRevenue_Std, CAST(sum(Quantity) AS DOUBLE) AS Quantity_Sum,
    {_avg('Quantity')} AS Quantity_Mean, coalesce({_std('Quantity')}, 0) AS Quantity_Std, {_avg('UnitPrice')} AS UnitPrice_Mean,
    coalesce({_std('UnitPrice')}, 0) AS UnitPrice_Std, count(DISTINCT CustomerKey) AS UniqueCustomers,
    count(DISTINCT ProductKey) AS UniqueProducts FROM f GROUP BY InvoiceNo)""", "f"
)
SERIES = """
  SELECT CAST(x.day AS DATE) AS Date, coalesce(CAST(sum(TotalRevenue) AS DOUBLE), 0) AS Revenue,
    coalesce(CAST(sum(Quantity) AS BIGINT), 0) AS Quantity, count(DISTINCT InvoiceNo) AS Orders,
    count(DISTINCT CustomerKey) AS Customers
  FROM (SELECT unnest(generate_series((SELECT min(FullDate) FROM f), (SELECT max(FullDate) FROM f), INTERVAL 1 DAY)) AS day) x
  LEFT JOIN f ON f.FullDate = CAST(x.day AS DATE) GROUP BY x.day
"""
SQL["ts_daily"] = _with(SERIES, "f")
for _unit in ("week", "month"):
    SQL[f"ts_{_unit}ly"] = _with(
        f"SELECT CAST(date_trunc('{_unit}', Date) AS DATE) AS Date, CAST(sum(CAST(Revenue AS DECIMAL(22,2))) AS DOUBLE) AS Revenue, "
        "CAST(sum(Quantity) AS BIGINT) AS Quantity, CAST(sum(Orders) AS BIGINT) AS Orders, CAST(sum(Customers) AS BIGINT) AS Customers "
        "FROM s GROUP BY 1", "f", extra={"s": SERIES}
    )

# --- data quality -----------------------------------------------------------------------------
CHECK = "check_name, table_name, check_type, severity, records_checked, records_failed, failure_rate"


def _check_row(name: str, table: str, kind: str, failed: str, severity: str, source: str, always: bool,
               message: str, complement: bool = False) -> str:
    rate = "1::DOUBLE - CAST(n - bad AS DOUBLE) / CAST(n AS DOUBLE)" if complement else "CAST(bad AS DOUBLE) / CAST(n AS DOUBLE)"
    keep = "" if always else " WHERE bad > 0"
    return (
        f"SELECT '{name}' AS check_name, '{table}' AS table_name, '{kind}' AS check_type, {severity} AS severity, "
        f"n AS records_checked, bad AS records_failed, rate AS failure_rate, {message} AS error_message FROM ("
        f"SELECT n, bad, {rate} AS rate FROM (SELECT count(*) AS n, count(*) FILTER (WHERE coalesce({failed}, FALSE)) AS bad FROM {source})){keep}"
    )


def _completeness(table: str, columns: list[str], source: str) -> list[str]:
    return [
        _check_row(
            f"Completeness_{c}", table, "completeness", f"{c} IS NULL",
            "CASE WHEN 1 - rate < 0.95 THEN 'critical' ELSE 'low' END", source, True,
            f"printf('Column {c} has %d null values (%.2f%%%% completeness)', bad, (n - bad) * 100.0 / n)".replace("%%%%", "%%"),
            True,
        ) for c in columns
    ]


def _accuracy(table: str, ranges: dict, source: str) -> list[str]:
    return [
        _check_row(
            f"Accuracy_{c}_Range", table, "accuracy", f"{c} < {low} OR {c} > {high}",
            "CASE WHEN rate > 0.05 THEN 'high' ELSE 'medium' END", source, True,
            f"printf('Column {c} has %d values outside range [{low}, {high}]', bad)",
        ) for c, (low, high) in ranges.items()
    ]


def _validity(table: str, formats: dict, source: str) -> list[str]:
    return [
        _check_row(
            f"Validity_{c}_Format", table, "validity",
            f"NOT regexp_matches(coalesce(CAST({c} AS VARCHAR), 'nan'), '{pattern}')",
            "CASE WHEN rate < 0.1 THEN 'medium' ELSE 'high' END", source, False,
            f"printf('Column {c} has %d records with invalid format', bad)",
        ) for c, pattern in formats.items()
    ]


FACT_REQUIRED = ["DateKey", "CustomerKey", "ProductKey", "LocationKey", "Quantity", "UnitPrice", "TotalRevenue"]
RANGES = {"Quantity": (1, 100000), "UnitPrice": (0.01, 50000.0), "TotalRevenue": (0.01, 1000000.0)}
RAW_RANGES = {"Quantity": (1, 100000), "UnitPrice": (0.01, 50000.0)}
FORMATS = {"InvoiceNo": "^[0-9]+$|^C[0-9]+$", "StockCode": "^[A-Z0-9]+$", "CustomerID": "^[0-9]+$|^UNKNOWN$"}
REQUIRED_RAW = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]


def _union(rows: list[str]) -> str:
    return " UNION ALL ".join(f"({r})" for r in rows)


SQL["dq_completeness"] = _with(
    f"SELECT {CHECK}, error_message FROM (" + _union(_completeness("RawLines", REQUIRED_RAW, "raw")) + ")", "raw"
)
SQL["dq_accuracy"] = _with(
    f"SELECT {CHECK}, error_message FROM (" + _union(_accuracy("RawLines", RAW_RANGES, "raw")) + ")", "raw"
)
SQL["dq_date_range"] = _with(
    _check_row("Accuracy_InvoiceDate_DateRange", "RawLines", "accuracy",
               "CAST(InvoiceDate AS DATE) < DATE '1996-01-01' OR CAST(InvoiceDate AS DATE) > DATE '2000-12-31'",
               "CASE WHEN rate > 0.05 THEN 'high' ELSE 'medium' END", "raw", True,
               "printf('Column InvoiceDate has %d values outside range [1996-01-01, 2000-12-31]', bad)"), "raw"
)
SQL["dq_consistency"] = _with(
    _check_row("Consistency_Revenue_Calculation", "FactSales", "consistency",
               "abs(TotalRevenue - Quantity * UnitPrice) > 0.01", "'critical'", "x", False,
               "printf('TotalRevenue calculation inconsistent in %d records', bad)"), "lines",
    extra={"x": "SELECT Quantity, UnitPrice, CASE WHEN Quantity = 17 THEN TotalRevenue + 1 ELSE TotalRevenue END AS TotalRevenue FROM lines"}
)
SQL["dq_validity"] = _with(
    f"SELECT {CHECK}, error_message FROM (" + _union(_validity("RawLines", FORMATS, "raw")) + ")", "raw"
)


def _unique_row(key: str, table: str, source: str) -> str:
    return (
        f"SELECT 'Uniqueness_{key}' AS check_name, '{table}' AS table_name, 'uniqueness' AS check_type, 'high' AS severity, "
        f"n AS records_checked, n - u AS records_failed, CAST(n - u AS DOUBLE) / n AS failure_rate, "
        f"printf('Column {key} has %d duplicate values', n - u) AS error_message "
        f"FROM (SELECT count(*) AS n, count(DISTINCT {key}) AS u FROM {source}) WHERE n > u"
    )


SQL["dq_uniqueness"] = _with(_union([_unique_row(k, "RawLines", "raw") for k in ("InvoiceNo", "StockCode")]), "raw")
ALL_RAW = _union(
    _accuracy("RawLines", RAW_RANGES, "raw") + _validity("RawLines", FORMATS, "raw") + [_unique_row("InvoiceNo", "RawLines", "raw")]
)
ALL_FACT = _union(_completeness("FactSales", FACT_REQUIRED, "f") + _accuracy("FactSales", RANGES, "f"))
SQL["dq_all"] = _with(f"{ALL_RAW} UNION ALL {ALL_FACT}", "raw", "f")
LOG = (
    f"SELECT *, TIMESTAMP '2001-09-01' AS check_timestamp, 'ETL_RUN' AS etl_run_id, 'ETL_Pipeline' AS source_system "
    f"FROM ({ALL_RAW} UNION ALL {ALL_FACT})"
)
SQL["dq_log"] = _with(LOG, "raw", "f")
SQL["dq_log_summary"] = _with(
    "SELECT check_type, severity, count(*) AS CheckCount, CAST(sum(records_failed) AS BIGINT) AS TotalFailedRecords, "
    "round(avg(failure_rate), 6) AS AvgFailureRate FROM g GROUP BY check_type, severity", "raw", "f", extra={"g": LOG}
)
SQL["dq_recent_issues"] = _with(
    "SELECT check_name, table_name, severity, records_failed, failure_rate, error_message, check_timestamp FROM g "
    "WHERE records_failed > 0 ORDER BY check_timestamp DESC, check_name, table_name LIMIT 20", "raw", "f", extra={"g": LOG}
)
SQL["dq_summary"] = _with(
    "SELECT section, name, CAST(value AS DOUBLE) AS value FROM ("
    "SELECT 'totals' AS section, 'total_checks' AS name, count(*)::DOUBLE AS value FROM g "
    "UNION ALL SELECT 'totals', 'failed_checks', count(*) FILTER (WHERE records_failed > 0) FROM g "
    "UNION ALL SELECT 'totals', 'success_rate', CAST(count(*) FILTER (WHERE records_failed = 0) AS DOUBLE) / count(*) FROM g "
    + "".join(f"UNION ALL SELECT 'severity', '{s}', count(*) FILTER (WHERE severity = '{s}') FROM g " for s in ("critical", "high", "medium", "low"))
    + "".join(f"UNION ALL SELECT 'check_type', '{s}', count(*) FILTER (WHERE check_type = '{s}') FROM g " for s in (
        "completeness", "accuracy", "consistency", "validity", "uniqueness", "timeliness")) + ")",
    "raw", "f", extra={"g": LOG}
)
GATE = _union(_completeness("RawLines", REQUIRED_RAW, "x"))
SQL["dq_gate"] = _with(
    "SELECT critical_checked, critical_failed, coalesce(CAST(critical_failed AS DOUBLE) / nullif(critical_checked, 0), 0) AS critical_rate, "
    "coalesce(CAST(critical_failed AS DOUBLE) / nullif(critical_checked, 0) <= 0.05, TRUE) AS proceed FROM ("
    "SELECT CAST(coalesce(sum(CASE WHEN severity = 'critical' THEN records_checked END), 0) AS BIGINT) AS critical_checked, "
    "CAST(coalesce(sum(CASE WHEN severity = 'critical' THEN records_failed END), 0) AS BIGINT) AS critical_failed FROM g)",
    "raw", extra={"x": "SELECT * REPLACE (CASE WHEN Quantity > 45 THEN NULL ELSE CustomerID END AS CustomerID) FROM raw", "g": GATE}
)
SQL["dq_score"] = _with(
    "SELECT greatest(0, 1 - (count(*) FILTER (WHERE severity = 'critical') * 0.2::DOUBLE + count(*) FILTER (WHERE severity <> 'critical') * 0.05::DOUBLE)) "
    "AS quality_score FROM g", "f", extra={"g": ALL_FACT}
)
SQL["dq_score_failed_only"] = _with(
    "SELECT greatest(0, 1 - (count(*) FILTER (WHERE severity = 'critical') * 0.2::DOUBLE + count(*) FILTER (WHERE severity <> 'critical') * 0.05::DOUBLE)) "
    "AS quality_score FROM g WHERE records_failed > 0", "raw", extra={"g": ALL_RAW}
)
SQL["dq_frame_metrics"] = _with(
    "SELECT n AS total_rows, CAST(missing AS BIGINT) AS missing_values, CAST(missing AS DOUBLE) / (CAST(n AS DOUBLE) * 8) * 100 AS missing_percentage, "
    "n - u AS duplicate_rows, CAST(whole AS DOUBLE) / CAST(n AS DOUBLE) * 100 AS completeness_score FROM (SELECT count(*) AS n, "
    "sum(" + " + ".join(f"({c} IS NULL)::INTEGER" for c in REQUIRED_RAW) + ") AS missing, "
    "count(*) FILTER (WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in REQUIRED_RAW) + ") AS whole FROM raw), "
    "(SELECT count(*) AS u FROM (SELECT DISTINCT * FROM raw))", "raw"
)
SQL["dq_timeliness"] = _with(
    f"SELECT 'Timeliness_InvoiceDate' AS check_name, 'RawLines' AS table_name, 'timeliness' AS check_type, "
    f"CASE WHEN age > 30 THEN 'high' ELSE 'low' END AS severity, n AS records_checked, "
    "CASE WHEN age > 30 THEN n ELSE 0 END AS records_failed, CASE WHEN age > 30 THEN 1.0::DOUBLE ELSE 0 END AS failure_rate, "
    "printf('Newest InvoiceDate is %d days old', age) AS error_message "
    f"FROM (SELECT count(*) AS n, {AS_OF} - CAST(max(InvoiceDate) AS DATE) AS age FROM raw)", "raw"
)
SQL["dq_score_stats"] = _with(
    "SELECT 0.5::DOUBLE AS AvgQuality, 0.5::DOUBLE AS MinQuality, 0.5::DOUBLE AS MaxQuality FROM f LIMIT 1", "f"
)
SQL["dq_bad_rows"] = _with(
    "SELECT count(*) FILTER (WHERE DateKey IS NULL OR CustomerKey IS NULL OR ProductKey IS NULL OR LocationKey IS NULL) AS null_keys, "
    "count(*) FILTER (WHERE TotalRevenue < 0) AS negative_revenue, count(*) FILTER (WHERE Quantity <= 0) AS zero_quantity FROM f", "f"
)
BROKEN = {
    "DateKey": "SELECT DateKey FROM d WHERE Month <> 7", "CustomerKey": "SELECT CustomerKey FROM c WHERE CustomerKey % 25 <> 3",
    "ProductKey": "SELECT ProductKey FROM p WHERE ProductKey % 10 <> 0", "LocationKey": "SELECT LocationKey FROM l",
}
SQL["dq_orphans"] = _with(
    " UNION ALL ".join(
        f"SELECT '{k}' AS foreign_key, count(*) AS orphan_rows FROM f WHERE {k} NOT IN ({s})" for k, s in BROKEN.items()
    ), *STAR
)
SQL["dq_referential"] = _with(
    " UNION ALL ".join(
        f"SELECT 'Referential_Integrity_{k}' AS check_name, 'FactSales' AS table_name, 'consistency' AS check_type, "
        f"'critical' AS severity, n AS records_checked, u AS records_failed, CAST(u AS DOUBLE) / n AS failure_rate, "
        f"printf('Found %d orphaned {k} values in FactSales', u) AS error_message FROM "
        f"(SELECT count(*) AS n FROM f), (SELECT count(DISTINCT {k}) AS u FROM f WHERE {k} NOT IN ({s})) WHERE u > 0"
        for k, s in BROKEN.items()
    ), *STAR
)

SQL["fact_fk_bucketed"] = SQL["fact_fk_missing"]
SQL["incr_new_lines"] = _with(
    "SELECT CAST(year(InvoiceDate) AS INTEGER) AS sale_year, CAST(month(InvoiceDate) AS INTEGER) AS sale_month, count(*) AS lines, "
    "CAST(sum(Quantity) AS BIGINT) AS pieces, CAST(sum(TotalRevenue) AS DOUBLE) AS revenue FROM lines "
    "WHERE InvoiceDate >= TIMESTAMP '1998-01-01' GROUP BY ALL", "lines"
)

# --- profiling -----------------------------------------------------------------------------------
def _profile_head(c: str, kind: str) -> str:
    return (
        f"SELECT '{c}' AS column_name, '{kind}' AS data_type, count(*) - count({c}) AS null_count, "
        f"CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100 AS null_percentage, count(DISTINCT {c}) AS unique_count, "
        f"CAST(count(DISTINCT {c}) AS DOUBLE) / count(*) * 100 AS unique_percentage, "
    )


SQL["profile_numeric"] = _with(" UNION ALL ".join(
    _profile_head(c, kind) + f"CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value, {_avg(c)} AS mean_value, "
    f"{_std(c)} AS std_value, count(*) FILTER (WHERE {c} = 0) AS zero_count, count(*) FILTER (WHERE {c} < 0) AS negative_count, "
    f"round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS median_value FROM raw"
    for c, kind in (("Quantity", "int"), ("UnitPrice", "decimal(10,2)"))
), "raw")
SQL["profile_string"] = _with(" UNION ALL ".join(
    _profile_head(c, "string") + f"CAST(min(length(coalesce({c}, 'nan'))) AS INTEGER) AS min_length, "
    f"CAST(max(length(coalesce({c}, 'nan'))) AS INTEGER) AS max_length, "
    f"CAST(sum(length(coalesce({c}, 'nan'))) AS DOUBLE) / count(*) AS avg_length, "
    f"count(*) FILTER (WHERE {c} = '') AS empty_string_count, count(*) FILTER (WHERE trim({c}) = '') AS whitespace_count FROM raw"
    for c in ("InvoiceNo", "StockCode", "Description", "CustomerID", "Country")
), "raw")
SQL["profile_date"] = _with(
    _profile_head("InvoiceDate", "timestamp") + "CAST(min(InvoiceDate) AS DATE) AS min_date, CAST(max(InvoiceDate) AS DATE) AS max_date, "
    "CAST(CAST(max(InvoiceDate) AS DATE) - CAST(min(InvoiceDate) AS DATE) AS INTEGER) AS date_range_days FROM raw", "raw"
)
def _merged(c: str, kind: str, m: str) -> str:
    return (
        f"SELECT '{c}' AS column_name, '{kind}' AS data_type, count(*) AS records, count(*) - count({c}) AS null_count, "
        f"CAST(min({m}) AS DOUBLE) AS min_value, CAST(max({m}) AS DOUBLE) AS max_value, "
        f"round(CAST(sum({m}) AS DOUBLE) / count({c}), 4) AS mean_value, round(stddev_samp(CAST({m} AS DOUBLE)), 4) AS std_value, "
        f"count(*) FILTER (WHERE {m} = 0) AS zero_count, count(*) FILTER (WHERE {m} < 0) AS negative_count, "
        "true AS unique_within, true AS median_within FROM lines"
    )


SQL["profile_merged"] = _with(" UNION ALL ".join(
    [_merged(c, kind, c) for c, kind in (("Quantity", "int"), ("UnitPrice", "decimal(10,2)"), ("TotalRevenue", "decimal(12,2)"))]
    + [_merged(c, "string", f"length({c})") for c in ("InvoiceNo", "StockCode", "Description", "CustomerID", "Country")]
), "lines")
OUTLIER_COLUMNS = ("Quantity", "UnitPrice", "TotalRevenue")
BOUNDS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, q1, q3, q1 - (q3 - q1) * 1.5::DOUBLE AS lower_bound, q3 + (q3 - q1) * 1.5::DOUBLE AS upper_bound "
    f"FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM lines)"
    for c in OUTLIER_COLUMNS
)
SQL["outlier_bounds"] = _with(
    "SELECT column_name, round(q1, 4) AS q1, round(q3, 4) AS q3, round(lower_bound, 4) AS lower_bound, "
    "round(upper_bound, 4) AS upper_bound FROM b", "lines", extra={"b": BOUNDS}
)
SQL["outliers_iqr"] = _with(
    "SELECT InvoiceNo, StockCode, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice, outlier_columns FROM ("
    "SELECT InvoiceNo, StockCode, Quantity, UnitPrice, concat_ws(',', " + ", ".join(
        f"CASE WHEN {c} < (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) * 2.5::DOUBLE - quantile_cont(CAST({c} AS DOUBLE), 0.75) * 1.5::DOUBLE FROM typed) "
        f"OR {c} > (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.75) * 2.5::DOUBLE - quantile_cont(CAST({c} AS DOUBLE), 0.25) * 1.5::DOUBLE FROM typed) "
        f"THEN '{c}' END" for c in ("Quantity", "UnitPrice")
    ) + ") AS outlier_columns FROM typed) WHERE outlier_columns <> ''", "typed"
)

# --- models: the parts with an exact answer ---------------------------------------------------
def _mean2(col: str) -> str:
    return f"round(CAST(sum(CAST({col} AS DECIMAL(28,6))) AS DOUBLE) / count(*), 2)"


def _segment_stats(segment: str, rows: str) -> str:
    return f"""SELECT Segment, Avg_Recency, Avg_Frequency, Avg_Monetary, Avg_OrderSize, Avg_RevenuePerOrder, Avg_Lifespan, Customer_Count,
  CASE WHEN Segment = -1 THEN 'Noise/Outliers'
    WHEN Avg_Recency < 100 AND Avg_Frequency > 41 AND Avg_Monetary > 860000 THEN 'Champions'
    WHEN Avg_Recency < 110 AND Avg_Frequency > 38 AND Avg_Monetary > 500000 THEN 'Loyal Customers'
    WHEN Avg_Recency < 100 AND Avg_Frequency < 41 AND Avg_Monetary > 500000 THEN 'Potential Loyalists'
    WHEN Avg_Recency > 100 AND Avg_Frequency > 5 AND Avg_Monetary > 500000 THEN 'At Risk'
    ELSE 'Segment ' || CAST(Segment AS VARCHAR) END AS Description
FROM (SELECT {segment} AS Segment, {_mean2("Recency")} AS Avg_Recency,
    {_mean2("Frequency")} AS Avg_Frequency, {_mean2("Monetary")} AS Avg_Monetary, {_mean2("AvgOrderSize")} AS Avg_OrderSize,
    {_mean2("RevenuePerOrder")} AS Avg_RevenuePerOrder, {_mean2("CustomerLifespan")} AS Avg_Lifespan,
    count(*) AS Customer_Count FROM {rows} GROUP BY 1)"""


SQL["ml_segment_stats"] = _with(_segment_stats("CAST(CustomerKey % 6 - 1 AS INTEGER)", "s"), "f", extra={"s": SEGMENTATION})
SQL["ml_dbscan_stats"] = _density(_segment_stats("Segment", "s JOIN segmented USING (CustomerKey)"))
SQL["ml_confusion_metrics"] = _with(
    """SELECT label, prec AS precision, rec AS recall,
  CASE WHEN prec + rec > 0 THEN 2.0::DOUBLE * prec * rec / (prec + rec) ELSE 0 END AS f1, support, accuracy
FROM (SELECT label, coalesce(CAST(hits AS DOUBLE) / nullif(guessed, 0), 0) AS prec, CAST(hits AS DOUBLE) / support AS rec,
    support, accuracy
  FROM (SELECT label, count(*) AS support, count(*) FILTER (WHERE label = guess) AS hits FROM x GROUP BY label) a
  LEFT JOIN (SELECT guess, count(*) AS guessed FROM x GROUP BY guess) b ON label = guess,
  (SELECT CAST(count(*) FILTER (WHERE label = guess) AS DOUBLE) / count(*) AS accuracy FROM x))""", "ck",
    extra={"x": "SELECT CASE WHEN rec > 90 THEN 1 ELSE 0 END AS label, CASE WHEN CAST(TotalOrders AS DOUBLE) / (rec + 1) > 0.4 "
                "THEN 0 ELSE 1 END AS guess FROM ck"}
)
FC_SERIES = """SELECT spine.series, spine.Date, coalesce(CAST(v AS DOUBLE), 0) AS value
FROM (SELECT series, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS Date FROM x GROUP BY series) spine
LEFT JOIN (SELECT series, day, sum(TotalRevenue) AS v FROM x GROUP BY series, day) t ON spine.series = t.series AND spine.Date = t.day"""
FC_DAYS = {"x": "SELECT Country AS series, CAST(InvoiceDate AS DATE) AS day, TotalRevenue FROM lines UNION ALL "
                "SELECT 'ALL', CAST(InvoiceDate AS DATE), TotalRevenue FROM lines"}
SQL["fc_series"] = _with(FC_SERIES, "lines", extra=FC_DAYS)
SQL["fits_roundtrip"] = _with(
    "SELECT CAST(sum(CASE WHEN n >= 3 THEN 30 ELSE 1 END + CASE WHEN n >= 24 THEN 30 ELSE 1 END) AS BIGINT) AS forecasts, "
    f"CAST(0 AS BIGINT) AS differing FROM (SELECT series, count(*) AS n FROM ({FC_SERIES}) GROUP BY series)",
    "lines", extra=FC_DAYS)
SQL["forest_roundtrip"] = _with(
    "SELECT count(DISTINCT InvoiceNo) AS invoices, CAST(0 AS BIGINT) AS differing FROM f", "f")

# --- streams: the whole input in one go -----------------------------------------------------------
STREAMED = (
    "SELECT *, CAST(Quantity * UnitPrice AS DECIMAL(12,2)) AS TotalRevenue FROM kept "
    "WHERE trim(StockCode) <> '' AND trim(Description) <> ''"
)
SQL["st_cleanse"] = _with(
    "SELECT * REPLACE (CAST(UnitPrice AS DOUBLE) AS UnitPrice, CAST(TotalRevenue AS DOUBLE) AS TotalRevenue) FROM x",
    "kept", extra={"x": STREAMED}
)
SQL["st_dedup"] = "SELECT event_id, user_id, event_type, value FROM events"
SQL["st_enrich"] = _with(
    """SELECT x.InvoiceNo, d.DateKey, coalesce(ck.CustomerKey, 0) AS CustomerKey, p.ProductKey, l.LocationKey, x.Quantity,
  CAST(x.TotalRevenue AS DOUBLE) AS TotalRevenue
FROM x JOIN d ON CAST(x.InvoiceDate AS DATE) = d.FullDate JOIN p ON x.StockCode = p.StockCode
JOIN l ON x.Country = l.Country LEFT JOIN ck ON x.CustomerID = ck.CustomerID""", "kept", "d", "p", "l", "ck", extra={"x": STREAMED}
)
SQL["st_tumbling"] = (
    "SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, "
    "count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY ALL"
)
SQL["st_sliding"] = (
    "SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, count(*) AS events, "
    "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM (SELECT value, unnest(["
    + ", ".join(f"time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL {m} MINUTE" for m in (0, 15, 30, 45))
    + "]) AS s FROM events) GROUP BY s"
)
SQL["st_sessions"] = _with(
    "SELECT user_id, session_start, events, views, clicks, purchases FROM s", extra={"s": SESSIONS}
)
SQL["st_gate_load"] = _with("SELECT 'loaded' AS outcome, count(*) AS records FROM raw", "raw")
