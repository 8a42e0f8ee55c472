"""Thresholds, word lists and lookup tables used across the library.

Everything here is a default: the operators take these values as parameters.
"""

from __future__ import annotations

# --- fixed values: cleansing thresholds -------------------------------------
UNKNOWN = "UNKNOWN"
CANCEL_PREFIX = "C"
MIN_QUANTITY = 1
MAX_QUANTITY = 100000
MIN_UNIT_PRICE = 0.01
MAX_UNIT_PRICE = 50000.0
SOURCE_SYSTEM = "Online_Retail"
DQ_SOURCE_SYSTEM = "ETL_Pipeline"
REQUIRED_COLUMNS = [
    "InvoiceNo", "StockCode", "Description", "Quantity",
    "InvoiceDate", "UnitPrice", "CustomerID", "Country",
]

# --- fixed values: product keyword classes, first match wins ----------------
PRODUCT_CLASSES = [
    (["bag", "handbag", "purse", "wallet"], ("Bags", "Handbags", "Accessories")),
    (["t-shirt", "shirt", "top", "blouse"], ("Clothing", "Tops", "Apparel")),
    (["candle", "holder", "light", "lamp"], ("Home", "Lighting", "Decor")),
    (["box", "storage", "container"], ("Home", "Storage", "Organization")),
    (["card", "paper", "stationery"], ("Office", "Stationery", "Supplies")),
    (["toy", "game", "puzzle"], ("Toys", "Games", "Entertainment")),
]
PRODUCT_DEFAULT = ("General", "Miscellaneous", "Other")
PRODUCT_EMPTY = ("Unknown", "Unknown", "Unknown")

# The shorter five-class list of the basic product dimension.
BASIC_CLASSES = [
    (["bag", "handbag", "purse"], "Bags"),
    (["t-shirt", "shirt", "top"], "Clothing"),
    (["candle", "holder", "light"], "Home"),
    (["box", "storage"], "Storage"),
]
BASIC_DEFAULT = "General"

# --- fixed values: country, region, continent, currency, primary market -----
GEO_COLUMNS = "Country string, Region string, Continent string, Currency string, IsPrimaryMarket boolean"
GEO = [
    ("United Kingdom", "Europe", "Europe", "GBP", True),
    ("Germany", "Europe", "Europe", "EUR", False),
    ("France", "Europe", "Europe", "EUR", False),
    ("Netherlands", "Europe", "Europe", "EUR", False),
    ("EIRE", "Europe", "Europe", "EUR", False),
    ("Australia", "Oceania", "Oceania", "AUD", False),
    ("USA", "North America", "North America", "USD", False),
    ("Canada", "North America", "North America", "CAD", False),
]
# The second loader knows six of these and keeps region and continent only.
BASIC_GEO_COUNTRIES = ["United Kingdom", "Germany", "France", "Netherlands", "Australia", "USA"]

# --- fixed values: the one sales channel -------------------------------------
CHANNEL_COLUMNS = (
    "ChannelKey int, ChannelCode string, ChannelName string, ChannelType string, "
    "ChannelDescription string, IsActive boolean, LaunchDate string, "
    "CostPerAcquisition double, ConversionRate double"
)
CHANNEL = (1, "ONLINE", "Online Retail", "Online", "Online retail channel", True, "2010-01-01", 10.0, 2.5)

# --- fixed values: customer dimension bins, right-closed ---------------------
RECENCY_BINS = ([0, 30, 90, 180, None], ["Champions", "Loyal", "Potential", "At Risk"])
FREQUENCY_BINS = ([0, 1, 3, 10, None], ["New", "Occasional", "Regular", "VIP"])
MONETARY_BINS = ([0, 100, 500, 1000, None], ["Low", "Medium", "High", "Premium"])
TIER_BINS = ([0, 200, 500, 1000, None], ["Bronze", "Silver", "Gold", "Platinum"])
INACTIVE_DAYS = 365
CHURNED_DAYS = 730
COST_SHARE = 0.6

# --- fixed values: report cut-offs -------------------------------------------
RFM_RECENCY_DAYS = [30, 60, 90, 180]
RFM_FREQUENCY = [50, 20, 10, 5]
RFM_MONETARY = [5000, 2000, 1000, 500]
CLV_TIERS = [(10000, "Premium"), (5000, "Gold"), (2000, "Silver"), (1000, "Bronze")]
CLV_DEFAULT = "Basic"
PRODUCT_GRADES = [
    (50000, 100, "Star"),
    (20000, 50, "Cash Cow"),
    (10000, 20, "Question Mark"),
    (5000, 0, "Potential"),
]
PRODUCT_GRADE_DEFAULT = "Dog"
LIFECYCLE = [(30, "New"), (90, "Growing"), (365, "Mature")]
LIFECYCLE_DEFAULT = "Established"
MARKETS = [(100000, "Major Market"), (50000, "Important Market"), (10000, "Growing Market")]
MARKET_DEFAULT = "Emerging Market"
VALUE_SEGMENTS = [(1000, "High Value"), (500, "Medium Value")]
VALUE_SEGMENT_DEFAULT = "Low Value"

# --- fixed values: data-quality rules ----------------------------------------
DQ_REQUIRED = {
    "FactSales": ["DateKey", "CustomerKey", "ProductKey", "LocationKey", "Quantity", "UnitPrice", "TotalRevenue"],
    "DimCustomer": ["CustomerKey", "CustomerID", "Country"],
    "DimProduct": ["ProductKey", "StockCode"],
    "DimDate": ["DateKey", "FullDate", "Year", "Month"],
    "DimLocation": ["LocationKey", "Country"],
}
DQ_COMPLETENESS_THRESHOLD = 0.95
DQ_RANGES = {
    "Quantity": (1, 100000),
    "UnitPrice": (0.01, 50000.0),
    "TotalRevenue": (0.01, 1000000.0),
}
DQ_DATE_RANGES = {"InvoiceDate": ("2010-01-01", "2012-12-31")}
DQ_FORMATS = {
    "InvoiceNo": "^[0-9]+$|^C[0-9]+$",
    "StockCode": "^[A-Z0-9]+$",
    "CustomerID": "^[0-9]+$|^UNKNOWN$",
}
DQ_FOREIGN_KEYS = {
    "DateKey": "DimDate",
    "CustomerKey": "DimCustomer",
    "ProductKey": "DimProduct",
    "LocationKey": "DimLocation",
}
DQ_SEVERITIES = ["critical", "high", "medium", "low"]
DQ_CHECK_TYPES = ["completeness", "accuracy", "consistency", "validity", "uniqueness", "timeliness"]

# --- fixed values: machine-learning feature lists ----------------------------
SEGMENT_FEATURES = [
    "Recency", "Frequency", "Monetary", "AvgOrderSize", "RevenuePerOrder", "CustomerLifespan",
]
CHURN_FEATURES = [
    "TotalRevenue_Sum", "TotalRevenue_Mean", "TotalRevenue_Std", "TotalOrders_Sum",
    "TotalOrders_Mean", "AvgRecency", "AvgFrequency", "AvgMonetary",
    "DaysSinceLastPurchase", "RevenueTrend", "OrderFrequency", "ValuePerOrder",
]
INVOICE_FEATURES = [
    "TotalRevenue_Sum", "TotalRevenue_Mean", "TotalRevenue_Std", "Quantity_Sum",
    "Quantity_Mean", "Quantity_Std", "UnitPrice_Mean", "UnitPrice_Std",
    "UniqueCustomers", "UniqueProducts", "RevenuePerItem", "ItemsPerCustomer", "ProductsPerOrder",
]
MIN_ROWS_FOR_ML = 1000
