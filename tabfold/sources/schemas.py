"""Declared schemas of the CSV inputs."""

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# Column names, order and types of the flights file.
FLIGHTS = StructType(
    [
        StructField(name, StringType() if name == "Carrier" else IntegerType(), nullable=False)
        for name in (
            "DayofMonth",
            "DayOfWeek",
            "Carrier",
            "OriginAirportID",
            "DestAirportID",
            "DepDelay",
            "ArrDelay",
        )
    ]
)

# Numeric columns of the customers file, in feature order.
CUSTOMER_FEATURES = (
    "Age",
    "MaritalStatus",
    "IncomeRange",
    "Gender",
    "TotalChildren",
    "ChildrenAtHome",
    "Education",
    "Occupation",
    "HomeOwner",
    "Cars",
)


# The customers file as described; for files in this column order.
CUSTOMERS = StructType(
    [
        StructField("CustomerName", StringType()),
        *[StructField(name, IntegerType()) for name in CUSTOMER_FEATURES],
    ]
)
