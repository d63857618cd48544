"""Record and table schemas.

Files are always read with an explicit schema: JSON inference leaves
``timestamp`` a string and CSV inference makes it zone-aware.
"""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Raw reading, one JSON object per reading.
RAW_READING = StructType(
    [
        StructField("sensor_id", StringType()),
        StructField("timestamp", TimestampNTZType()),
        StructField("temperature", DoubleType()),
        StructField("status", StringType()),
    ]
)

# What did not parse, as read: the whole record.
CORRUPT = "_corrupt_record"

# Clean reading = raw reading + Fahrenheit, as written to the clean CSV.
CLEAN_READING = StructType(RAW_READING.fields + [StructField("temperature_f", DoubleType())])

# Table and column names, types and widths of the two tables.
# Columns of the warehouse fact (without the defaulted created_at).
SENSOR_TARGET_COLUMNS = ["sensor_id", "timestamp", "temperature_c", "temperature_f", "reading_date"]

SENSOR_READINGS_DDL = """
    sensor_id VARCHAR(50),
    timestamp TIMESTAMP_NTZ,
    temperature_c FLOAT,
    temperature_f FLOAT,
    created_at TIMESTAMP DEFAULT current_timestamp(),
    reading_date DATE
"""

CUSTOMERS_DDL = """
    user_id VARCHAR(50),
    income INT,
    loan_amt INT,
    credit_score INT,
    grade VARCHAR(10),
    created_at TIMESTAMP DEFAULT current_timestamp()
"""

CUSTOMER_COLUMNS = ["user_id", "income", "loan_amt", "credit_score", "grade"]

# Scorer contracts: every field required.
SCORE_REQUEST = StructType(
    [
        StructField("user_id", StringType(), False),
        StructField("income", IntegerType(), False),
        StructField("loan_amt", IntegerType(), False),
    ]
)

SCORE_RESPONSE = StructType(
    [
        StructField("user_id", StringType(), False),
        StructField("credit_score", IntegerType(), False),
        StructField("grade", StringType(), False),
    ]
)

# Text timestamps are written as 'yyyy-MM-dd HH:mm:ss', as in the day files, with
# the fraction only where there is one, and read without a pattern, which takes
# that text, ISO 'T', and any number of fraction digits.
