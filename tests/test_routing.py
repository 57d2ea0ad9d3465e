import pytest
from pyspark.sql import functions as F

from ledgerlore.functions.routing import normalise_label, route


def routed(spark, question, previous=None):
    df = spark.createDataFrame([(question, previous)], "q string, p string")
    return df.select(route(F.col("q"), F.col("p")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "question,expected",
    [("What is the waiting period for pre-existing diseases under the Family Floater policy?", "VECTOR"),
     ("How many customers are on the Senior Citizen policy?", "SQL"),
     ("What is excluded under the Critical Illness policy?", "VECTOR"),
     ("How much total claim payout has been made for the Diabetes Safe policy?", "SQL"),
     ("Is maternity covered, and how much has been paid out in claims so far?", "HYBRID"),
     ("How many premium payments has customer C001 made?", "SQL"),
     ("Was customer C001's last claim covered under their policy's exclusions?", "HYBRID"),
     ("What does my policy cover and what have I paid so far?", "HYBRID"),
     ("How many claims are there for customers in Hyderabad?", "SQL"),
     ("How do I file a cashless claim?", "VECTOR"),
     ("Is maternity covered and what is the waiting period?", "VECTOR"),
     ('What is the policy coverage for "Diabetes Safe"?', "VECTOR"),
     ("", "VECTOR")],
)
def test_questions_alone(spark, question, expected):
    assert routed(spark, question) == expected


@pytest.mark.parametrize(
    "question,previous,expected",
    [("give me the details", "SQL", "SQL"), ("give me the details", "HYBRID", "HYBRID"),
     ("give me the details", "ERROR", "VECTOR"), ("give me the details", None, "VECTOR"),
     ("what is the premium for this?", "VECTOR", "VECTOR"), ("How many customers?", "VECTOR", "SQL")],
)
def test_follow_ups(spark, question, previous, expected):
    assert routed(spark, question, previous) == expected


@pytest.mark.parametrize(
    "raw,label",
    [("SQL", "SQL"), ("sql.", "SQL"), ("MYSQL", "SQL"), ("vector", "VECTOR"), ("Hybrid (SQL + VECTOR)", "HYBRID"),
     ("VECTOR or SQL", "SQL"), ("none", "VECTOR"), ("", "VECTOR"), (None, "VECTOR")],
)
def test_labels(spark, raw, label):
    df = spark.createDataFrame([(raw,)], "raw string")
    assert df.select(normalise_label(F.col("raw")).alias("l")).first()["l"] == label
