"""What a question is about: names of customers, policies, coverages and cities in free text, and the kind of answer.

Names are matched as runs of words: every run of a question up to the longest name is looked up in a name table, and
where matches overlap the longest one wins, the earlier one among equally long ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlore.operators.analytics import MONEY, latest_per_customer, money
from ledgerlore.operators.joins import join_shared
from ledgerlore.operators.postings import terms_of
from ledgerlore.session import materialise

CUSTOMER, POLICY, COVERAGE, CITY = "customer", "policy", "coverage", "city"

# Fixed values that decide results: kinds of answers in the order in which they are tried, each with its cue and what
# it is asked about.
KINDS = (
    ("last_claim", r"last claim", CUSTOMER),
    ("premiums_paid", r"premiums?|paid|payments?", CUSTOMER),
    ("claims_in_city", r"claims?|payouts?", CITY),
    ("customers_on_policy", r"customers?", POLICY),
    ("claims_on_policy", r"claims?|payouts?|paid", POLICY),
    ("claims_on_coverage", r"claims?|payouts?|paid", COVERAGE),
)


def name_words(text: Column) -> Column:
    """Words of a name or a question; a customer's number is written without leading zeros."""
    return F.transform(terms_of(text), lambda t: F.regexp_replace(t, r"^c0+([0-9])", "c$1"))


def name_table(customers: DataFrame, policies: DataFrame) -> DataFrame:
    """``(gram, words, entity_type, entity_id)`` of every name, as a written table; a name may stand for several things."""

    def named(df: DataFrame, kind: str, ident: str, name: Column) -> DataFrame:
        words = name_words(name)
        return df.select(
            F.array_join(words, " ").alias("gram"), F.size(words).alias("words"), F.lit(kind).alias("entity_type"), F.col(ident).cast("string").alias("entity_id")
        )

    number = F.concat(F.lit("C"), F.col("customer_id").cast("string"))
    names = (
        named(customers, CUSTOMER, "customer_id", number)
        .unionByName(named(customers, CUSTOMER, "customer_id", F.col("name")))
        .unionByName(named(policies, POLICY, "policy_number", F.col("policy_name")))
        .unionByName(named(policies, COVERAGE, "coverage_type", F.col("coverage_type")))
        .unionByName(named(customers.select("city").distinct(), CITY, "city", F.col("city")))
    )
    return materialise(names.where(F.col("words") > 0).distinct(), "names")


def mentions(questions: DataFrame, names: DataFrame, *, key: str = "qid", text: str = "question") -> DataFrame:
    """``(key, mentions)`` for the questions that name something: (start, words, entity_type, entity_id), in order."""
    longest = names.agg(F.max("words")).first()[0] or 1
    words = questions.select(F.col(key).alias("__key"), name_words(F.col(text)).alias("w"))

    def runs(n: int) -> Column:
        starts = F.sequence(F.lit(0), F.size("w") - n)
        whole = F.transform(starts, lambda i: F.struct(i.alias("start"), F.array_join(F.slice("w", i + 1, F.lit(n)), " ").alias("gram")))
        return F.when(F.size("w") >= n, whole).otherwise(F.array().cast("array<struct<start:int,gram:string>>"))

    grams = words.select("__key", F.explode(F.concat(*[runs(n) for n in range(1, longest + 1)])).alias("g")).select("__key", "g.*")
    asked = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("times"))
    entities = F.collect_set(F.struct("words", "entity_type", "entity_id")).alias("entities")
    known = materialise(asked.join(names.groupBy("gram").agg(entities), "gram"), "known-names")
    found = join_shared(grams, known, "gram", "times").select("__key", "start", F.explode("entities").alias("e")).select("__key", "start", "e.*")
    per_question = found.groupBy("__key").agg(
        F.array_sort(F.collect_set(F.struct("start", "words", "entity_type", "entity_id"))).alias("all"),
        F.collect_set(F.struct("start", "words")).alias("spans"),
    )

    def beaten(m: Column) -> Column:
        return F.exists(
            "spans",
            lambda o: (o["start"] < m["start"] + m["words"])
            & (m["start"] < o["start"] + o["words"])
            & ((o["words"] > m["words"]) | ((o["words"] == m["words"]) & (o["start"] < m["start"]))),
        )

    def standing(spans: Column) -> Column:
        return F.filter("all", lambda m: F.exists(spans, lambda o: (o["start"] == m["start"]) & (o["words"] == m["words"])))

    # Many things may share a name, so spans are compared and not mentions. One-element transform: the spans that stand are
    # found once and not per mention.
    kept = F.flatten(F.transform(F.array(F.filter("spans", lambda m: ~beaten(m))), standing))
    return per_question.select(F.col("__key").alias(key), kept.alias("mentions"))


def asked_for(question: Column, found: Column) -> Column:
    """``(kind, entity_id)`` of the first kind whose cue the text has and whose entity it names; null without one."""

    def named(entity: str) -> Column:
        return F.filter(found, lambda m: m["entity_type"] == entity)

    chain = None
    for kind, cue, entity in KINDS:
        fitting = named(entity)
        hit = question.rlike(rf"(?i)\b({cue})\b") & (F.size(fitting) > 0)
        value = F.struct(F.lit(kind).alias("kind"), F.get(fitting, F.lit(0))["entity_id"].alias("entity_id"))
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return chain


def table_answers(
    asked: DataFrame, customers: DataFrame, transactions: DataFrame, policies: DataFrame, *, premium: str, claim: str
) -> DataFrame:
    """``(kind, entity_id, n, amount)`` for each of ``asked`` (kind, entity_id): number and sum behind an answer.

    Facts shrink to one row per customer before they meet anything else, and only asked customers get rows of their own.
    """
    asked = materialise(asked.distinct(), "asked-entities")
    own = F.col("customer_id").cast("string").alias("entity_id")
    typed = transactions.where(F.col("transaction_type").isin(premium, claim))
    per_type = typed.groupBy("customer_id", "transaction_type").agg(F.count("transaction_id").alias("n"), F.sum(money("amount")).alias("amount"))
    per_type = materialise(per_type, "per-customer")
    claims = per_type.where(F.col("transaction_type") == claim)
    held = claims.join(customers.select("customer_id", "city", "policy_number"), "customer_id")

    def summed(rows: DataFrame, kind: str, ident: Column) -> DataFrame:
        totals = rows.groupBy(ident.cast("string").alias("entity_id")).agg(F.sum("n").alias("n"), F.sum("amount").cast(MONEY).alias("amount"))
        return totals.select(F.lit(kind).alias("kind"), "entity_id", "n", "amount")

    one = [F.lit(1).cast("long").alias("n"), F.col("amount").cast(MONEY).alias("amount")]
    wanted = asked.where(F.col("kind") == "last_claim").select(F.col("entity_id").alias("customer_id"))
    last = transactions.where(F.col("transaction_type") == claim)
    last = last.join(wanted.select(F.col("customer_id").cast(customers.schema["customer_id"].dataType)), "customer_id", "left_semi")
    held_by = customers.groupBy(F.col("policy_number").cast("string").alias("entity_id")).agg(F.count("customer_id").alias("n"))
    answers = [
        latest_per_customer(last).select(F.lit("last_claim").alias("kind"), own, *one),
        per_type.where(F.col("transaction_type") == premium).select(F.lit("premiums_paid").alias("kind"), own, "n", F.col("amount").cast(MONEY).alias("amount")),
        summed(held, "claims_in_city", F.col("city")),
        held_by.select(F.lit("customers_on_policy").alias("kind"), "entity_id", "n", F.lit(None).cast(MONEY).alias("amount")),
        summed(held, "claims_on_policy", F.col("policy_number")),
        summed(held.join(policies.select("policy_number", "coverage_type"), "policy_number"), "claims_on_coverage", F.col("coverage_type")),
    ]
    known = answers[0]
    for more in answers[1:]:
        known = known.unionByName(more)
    found = asked.join(known, ["kind", "entity_id"], "left")
    return found.select("kind", "entity_id", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "amount")
