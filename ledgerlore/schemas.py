"""Typed contracts of the tables that enter and leave the library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CHUNKS = T.StructType(
    [
        T.StructField("chunk_id", T.StringType(), False),
        T.StructField("source_file", T.StringType()),
        T.StructField("policy_name", T.StringType()),
        T.StructField("page_number", T.IntegerType()),
        T.StructField("content", T.StringType()),
        T.StructField("char_count", T.IntegerType()),
    ]
)

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("dob", T.DateType()),
        T.StructField("policy_number", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("signup_date", T.DateType()),
    ]
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("customer_id", T.StringType()),
        T.StructField("policy_number", T.StringType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("status", T.StringType()),
    ]
)

POLICIES = T.StructType(
    [
        T.StructField("filename", T.StringType()),
        T.StructField("policy_name", T.StringType()),
        T.StructField("policy_number", T.StringType(), False),
        T.StructField("insurer", T.StringType()),
        T.StructField("coverage_type", T.StringType()),
        T.StructField("sum_insured", T.StringType()),
        T.StructField("premium", T.StringType()),
        T.StructField(
            "waiting_periods",
            T.ArrayType(T.StructType([T.StructField("period", T.StringType()), T.StructField("length", T.StringType())])),
        ),
        T.StructField("inclusions", T.ArrayType(T.StringType())),
        T.StructField("exclusions", T.ArrayType(T.StringType())),
        T.StructField("claim_process", T.ArrayType(T.StringType())),
        T.StructField("network_note", T.StringType()),
    ]
)

TURN = T.StructType(
    [
        T.StructField("question", T.StringType()),
        T.StructField("source_used", T.StringType()),
        T.StructField("answer", T.StringType()),
    ]
)

RESPONSE = T.StructType(
    [
        T.StructField("question", T.StringType()),
        T.StructField("source_used", T.StringType()),
        T.StructField("answer", T.StringType()),
        T.StructField("sql_query", T.StringType()),
        T.StructField("sql_rows_returned", T.IntegerType()),
        T.StructField("sql_error", T.StringType()),
        T.StructField("vector_chunks_used", T.IntegerType()),
        T.StructField("vector_search_error", T.StringType()),
    ]
)


def require_columns(df: DataFrame, columns: dict[str, type[T.DataType] | tuple[type[T.DataType], ...]]) -> None:
    """Fail while the plan is built, not on an executor, when an input misses a column or has another type."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for name, kinds in columns.items():
        if name not in fields:
            problems.append(f"column {name!r} is missing")
        elif not isinstance(fields[name], kinds):
            problems.append(f"column {name!r} is {fields[name].simpleString()}")
    if problems:
        raise ValueError("; ".join(problems))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to the contract, in its column order."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the contract: {missing}")
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
