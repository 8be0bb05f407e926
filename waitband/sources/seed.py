"""Specialty (treatment function) reference table.

A fixed 24-row dimension.  It is joined with ``F.broadcast``: its size is
bounded by definition (one row per published specialty code), not by data
volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SEED_SCHEMA = T.StructType([
    T.StructField("treatment_function_code", T.StringType(), False),
    T.StructField("treatment_function_name", T.StringType(), True),
    T.StructField("specialty_group", T.StringType(), True),
    T.StructField("is_surgical", T.BooleanType(), True),
])

# The published specialty seed, in its published order
# (code, name, group, is_surgical).
TREATMENT_FUNCTIONS = [
    ("C_999", "Total", "Summary", False),
    ("C_100", "General Surgery Service", "Surgical", True),
    ("C_101", "Urology Service", "Surgical", True),
    ("C_110", "Trauma and Orthopaedic Service", "Surgical", True),
    ("C_120", "Ear Nose and Throat Service", "Surgical", True),
    ("C_130", "Ophthalmology Service", "Surgical", True),
    ("C_140", "Oral Surgery Service", "Surgical", True),
    ("C_150", "Neurosurgery Service", "Surgical", True),
    ("C_160", "Plastic Surgery Service", "Surgical", True),
    ("C_170", "Cardiothoracic Surgery Service", "Surgical", True),
    ("C_190", "General Medicine Service", "Medical", False),
    ("C_300", "Dermatology Service", "Medical", False),
    ("C_301", "Gastroenterology Service", "Medical", False),
    ("C_320", "Cardiology Service", "Medical", False),
    ("C_330", "Dermatology Service", "Medical", False),
    ("C_340", "Respiratory Medicine Service", "Medical", False),
    ("C_400", "Neurology Service", "Medical", False),
    ("C_410", "Rheumatology Service", "Medical", False),
    ("C_502", "Gynaecology Service", "Surgical", True),
    ("C_504", "Obstetrics Service", "Medical", False),
    ("C_711", "Diagnostic Imaging Service", "Diagnostic", False),
    ("X02", "Other - Medical Services", "Other", False),
    ("X05", "Other - Surgical Services", "Other", True),
    ("X09", "Other - Mental Health Services", "Other", False),
]


def treatment_functions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TREATMENT_FUNCTIONS, SEED_SCHEMA)


def read_seed_csv(spark: SparkSession, path: str) -> DataFrame:
    """Load a seed CSV with the declared (not inferred) types."""
    return spark.read.option("header", True).schema(SEED_SCHEMA).csv(path)


def seed_values_sql() -> str:
    """The same rows as a SQL ``VALUES`` list (for SQL engines / oracles)."""
    def q(s):
        return "'" + s.replace("'", "''") + "'"
    rows = ",\n".join(
        f"({q(c)}, {q(n)}, {q(g)}, {'true' if s else 'false'})" for c, n, g, s in TREATMENT_FUNCTIONS
    )
    return rows
