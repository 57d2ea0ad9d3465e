"""Policy documents from policy records and the clauses that all policies share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlore.functions.ordered import BLOCK_BITS, totals_before

# Fixed values that decide results.
BENEFIT_NOTES = (
    "Up to 10% of Sum Insured",
    "Up to 15% of Sum Insured",
    "Covered up to actuals (network hospital)",
    "Up to 20% of Sum Insured per event",
    "As per Reasonable and Customary Charges",
)
# The shared text becomes part of every document value.
MAX_SHARED_BYTES = 64 << 20
OWN_SECTIONS = (
    "Policy", "Waiting Periods", "Inclusions / What's Covered", "Exclusions / What's Not Covered",
    "Claim Process", "Network Hospitals",
)


def benefit_note(position: Column) -> Column:
    """The coverage note of a listed procedure: the notes take turns."""
    turn = F.pmod(position, F.lit(len(BENEFIT_NOTES)))
    cases = [(turn == i, note) for i, note in enumerate(BENEFIT_NOTES[:-1])]
    return reduce(lambda acc, c: acc.when(*c), cases[1:], F.when(*cases[0])).otherwise(BENEFIT_NOTES[-1])


def procedure_benefits(procedures: DataFrame, *, order: str, name: str, bits: int = BLOCK_BITS) -> DataFrame:
    """``(position, procedure, note)`` of a procedure list in key order, numbered without a global window."""
    counted = totals_before(procedures.select(order, name), [], order, {"__n": ("sum", F.lit(1))}, bits=bits)
    position = F.coalesce("__n", F.lit(0))
    return counted.select(position.alias("position"), F.col(name).alias("procedure"), benefit_note(position).alias("note"))


def waiting_period_rows(policies: DataFrame) -> DataFrame:
    """One row per waiting period of a policy, with its place in the policy's list."""
    return policies.select("policy_number", F.posexplode("waiting_periods").alias("ordinal", "entry")).select(
        "policy_number", "ordinal", "entry.period", "entry.length"
    )


def _own_lines() -> list[tuple[int, Column]]:
    def listed(column: str) -> Column:
        return F.coalesce(F.col(column), F.array().cast("array<string>"))

    return [
        (
            1,
            F.array(
                F.col("policy_name"),
                F.concat(F.lit("Insurer: "), F.col("insurer")),
                F.concat(F.lit("Policy Number: "), F.col("policy_number").cast("string")),
                F.concat(F.lit("Coverage Type: "), F.col("coverage_type")),
                F.concat(F.lit("Sum Insured: "), F.col("sum_insured")),
                F.concat(F.lit("Premium: "), F.col("premium")),
            ),
        ),
        (2, F.transform("waiting_periods", lambda e: F.concat(e["period"], F.lit(": "), e["length"]))),
        (3, listed("inclusions")),
        (4, listed("exclusions")),
        (5, listed("claim_process")),
        (6, F.array(F.col("network_note"))),
    ]


def policy_sections(policies: DataFrame, clauses: DataFrame) -> DataFrame:
    """``(policy_number, section_no, ordinal, heading, text)``: sections of every policy and the shared ones.

    A shared clause is one row with a null policy: it belongs to all policies and is not copied for each.
    ``clauses`` is ``(section_no, ordinal, heading, text)`` with section numbers above the policies' own.
    """
    def section(no: int, values: Column) -> Column:
        return F.transform(
            values,
            lambda text, i: F.struct(
                F.lit(no).alias("section_no"),
                i.alias("ordinal"),
                F.lit(OWN_SECTIONS[no - 1]).alias("heading"),
                text.alias("text"),
            ),
        )

    lines = F.flatten(F.array(*[section(no, values) for no, values in _own_lines()]))
    own = policies.select("policy_number", F.inline(lines))
    shared = clauses.select(
        F.lit(None).cast(policies.schema["policy_number"].dataType).alias("policy_number"),
        F.col("section_no").cast("int").alias("section_no"),
        F.col("ordinal").cast("int").alias("ordinal"),
        "heading",
        "text",
    )
    return own.unionByName(shared)


def shared_text(clauses: DataFrame) -> DataFrame:
    """The shared sections as one text, in order; it is part of every document and rendered once."""
    sections = (
        clauses.groupBy("section_no", "heading")
        .agg(F.array_sort(F.collect_list(F.struct("ordinal", "text"))).alias("lines"))
        .select("section_no", F.concat_ws("\n", "heading", F.array_join("lines.text", "\n")).alias("body"))
    )
    return sections.agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("section_no", "body"))).getField("body"), "\n").alias("text")
    )


def policy_documents(policies: DataFrame, clauses: DataFrame) -> DataFrame:
    """``(policy_number, policy_name, document)``: own sections, then the shared ones.

    The lists of a policy are columns of its row and the shared text is a scalar subquery, so documents are
    built where the policies lie: no product of policies and clauses, and no shuffle of the policies. Every
    document holds the shared text, so its size is checked first; beyond the bound ``policy_sections`` keeps
    documents as rows.
    """
    size = clauses.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > MAX_SHARED_BYTES:
        raise ValueError(f"{size} bytes of shared clauses are too much for one value; use policy_sections")
    own = [F.concat_ws("\n", F.lit(OWN_SECTIONS[no - 1]), F.array_join(values, "\n")) for no, values in _own_lines()]
    return policies.select(
        "policy_number",
        "policy_name",
        F.concat_ws("\n", *own, shared_text(clauses).scalar()).alias("document"),
    )
