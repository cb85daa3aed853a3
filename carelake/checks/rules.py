"""Schema rules as batch validation (O-D1 .. O-D9).

In the workload these are table constraints and triggers that reject a
write.  Over data already landed they become a validation job:
``rule_violations`` gives one row per violating record and rule,
``rule_counts`` one row per rule with the number of them.

* row rules (not null, domain, range, cross-column, time validity, string
  length) are SQL predicates, like the CHECK clauses they come from.  All
  row rules of a table are evaluated in **one** pass over it.  A NULL
  predicate passes, as a CHECK does.
* unique / primary key: rows whose non-NULL key occurs more than once.
  Keys are dealt by their hash before they are counted in part and then
  added up.  A repeated primary key is the record key already and comes
  once per counted row; other repeated keys are joined back to their rows.
* foreign key: non-NULL references with no target, one anti join each on
  the native key type.
* specialty cardinality: doctors with 0 or more than 5 specialties.

What a key count or an anti join finds is rebalanced before the union.
Each of them so is a stage of its own, which AQE deals over all cores by
its own size.  In the union's stage the cores would be shared out among
all of them, with tasks of the largest advised size.

Nearly every key is another one, so a count in part where the table is
read would hold every key of a file's row group, however large that is.
Dealt by hash, AQE sizes these counts too, and parts a hot key's rows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.sources.roles import Hospital
from carelake.sources.schemas import DOMAINS, MAX_LENGTHS, SCHEMAS


@dataclass(frozen=True)
class Rule:
    rule_id: str
    family: str
    table: str
    column: str
    violation: str | None = None        # row rules: SQL predicate, TRUE = violated
    key: tuple[str, ...] = ()           # unique rules
    ref: tuple[str, str] | None = None  # foreign keys: (table, column)


# Keys, references and checks declared by the workload's DDL.
PRIMARY_KEYS = {
    "department": ("dept_name",), "ward": ("ward_id",), "bed": ("bed_id",), "staff": ("staff_id",),
    "doctor": ("doctor_id",), "specialty": ("specialty_name",),
    "doctorspecialty": ("doctor_id", "specialty_name"), "nurse": ("nurse_id",),
    "patient": ("patient_id",), "admission": ("admission_id",),
    "plannedadmission": ("admission_id",), "emergencyadmission": ("admission_id",),
    "billingstatement": ("billing_id",), "invoice": ("invoice_id",), "payment": ("payment_id",),
}
UNIQUE_KEYS = (("staff", "email"), ("doctor", "medical_license_number"),
               ("plannedadmission", "reference_number"), ("billingstatement", "admission_id"),
               ("payment", "transaction_id"))
FOREIGN_KEYS = (
    ("ward", "dept_name", "department", "dept_name"), ("bed", "ward_id", "ward", "ward_id"),
    ("staff", "dept_name", "department", "dept_name"), ("doctor", "doctor_id", "staff", "staff_id"),
    ("doctorspecialty", "doctor_id", "doctor", "doctor_id"),
    ("doctorspecialty", "specialty_name", "specialty", "specialty_name"),
    ("nurse", "nurse_id", "staff", "staff_id"), ("admission", "patient_id", "patient", "patient_id"),
    ("admission", "nurse_id", "nurse", "nurse_id"), ("admission", "doctor_id", "doctor", "doctor_id"),
    ("admission", "bed_id", "bed", "bed_id"),
    ("plannedadmission", "admission_id", "admission", "admission_id"),
    ("emergencyadmission", "admission_id", "admission", "admission_id"),
    ("emergencyadmission", "triage_nurse_id", "nurse", "nurse_id"),
    ("billingstatement", "admission_id", "admission", "admission_id"),
    ("invoice", "billing_id", "billingstatement", "billing_id"),
    ("payment", "invoice_id", "invoice", "invoice_id"),
)
RANGE_CHECKS = (  # (table, column, predicate that must hold)
    ("department", "staff_headcount", "staff_headcount >= 0"),
    ("ward", "bed_capacity", "bed_capacity > 0"),
    ("bed", "bed_length", "bed_length > 0 AND bed_length <= 2.13"),
    ("bed", "bed_width", "bed_width > 0 AND bed_width <= 1.27"),
    ("bed", "mattress_thickness", "mattress_thickness >= 15.24 AND mattress_thickness <= 17.78"),
    ("bed", "bed_cost", "bed_cost >= 0"),
    ("staff", "salary", "salary > 0"),
    ("specialty", "min_years_training", "min_years_training >= 0"),
    ("billingstatement", "total_cost", "total_cost > 0 AND total_cost <= 50000"),
    ("billingstatement", "insurance_covered_amount", "insurance_covered_amount >= 0"),
    ("invoice", "amount_due", "amount_due >= 0"),
    ("payment", "payment_amount", "payment_amount > 0"),
)
CROSS_CHECKS = (
    ("admission", "discharge_date", "discharge_date IS NULL OR discharge_date >= CAST(admission_date AS DATE)"),
    ("billingstatement", "insurance_covered_amount", "insurance_covered_amount <= total_cost"),
    ("invoice", "due_date", "due_date IS NULL OR due_date >= issue_date"),
)
MAX_SPECIALTIES = 5
HASH_VALUES = 1 << 16  # by which keys are dealt before they are counted, far more than there are shuffle partitions
COPIES_AT_ONCE = 4096  # rows that one array holds while a repeated key is written out


def _lit_date(as_of) -> str:
    if isinstance(as_of, dt.date):
        as_of = as_of.isoformat()
    return f"DATE '{as_of}'"


def rules(as_of) -> list[Rule]:
    """Every rule of the schema, with time-dependent ones evaluated at ``as_of``."""
    today = _lit_date(as_of)
    out: list[Rule] = []
    for table, schema in SCHEMAS.items():
        for f in schema.fields:
            if not f.nullable:
                out.append(Rule(f"not_null.{table}.{f.name}", "not_null", table, f.name, f"{f.name} IS NULL"))
    for table, key in PRIMARY_KEYS.items():
        out.append(Rule(f"primary_key.{table}", "unique", table, ",".join(key), key=key))
    for table, col in UNIQUE_KEYS:
        out.append(Rule(f"unique.{table}.{col}", "unique", table, col, key=(col,)))
    for table, col, ref_table, ref_col in FOREIGN_KEYS:
        out.append(Rule(f"foreign_key.{table}.{col}", "foreign_key", table, col, ref=(ref_table, ref_col)))
    for (table, col), values in DOMAINS.items():
        allowed = ", ".join("'" + v + "'" for v in values)
        out.append(Rule(f"domain.{table}.{col}", "domain", table, col, f"NOT ({col} IN ({allowed}))"))
    for table, col, check in RANGE_CHECKS:
        out.append(Rule(f"range.{table}.{col}", "range", table, col, f"NOT ({check})"))
    for table, col, check in CROSS_CHECKS:
        out.append(Rule(f"cross_column.{table}.{col}", "cross_column", table, col, f"NOT ({check})"))
    out.append(Rule("validity.doctor.license", "validity", "doctor", "license_expiry_date",
                    f"NOT (medical_license_number IS NULL OR "
                    f"(license_expiry_date IS NOT NULL AND license_expiry_date > {today}))"))
    out.append(Rule("validity.nurse.wwcc", "validity", "nurse", "wwcc_expiry_date",
                    f"NOT (wwcc_clearance = FALSE OR (wwcc_clearance = TRUE AND wwcc_expiry_date IS NOT NULL "
                    f"AND wwcc_expiry_date > {today}))"))
    for (table, col), n in MAX_LENGTHS.items():
        out.append(Rule(f"length.{table}.{col}", "length", table, col, f"length({col}) > {n}"))
    out.append(Rule("cardinality.doctor.specialties", "cardinality", "doctor", "doctor_id"))
    return out


def _union_all(parts: list[DataFrame]) -> DataFrame:
    """Union pairwise (log depth): a left-deep chain re-checks the growing plan on every call."""
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def _meta(r: Rule):
    return (F.lit(r.rule_id).alias("rule_id"), F.lit(r.family).alias("family"),
            F.lit(r.table).alias("table_name"), F.lit(r.column).alias("column_name"))


def _violated(sql: str):
    return F.coalesce(F.expr(sql), F.lit(False))


def specialty_count_violations(h: Hospital) -> DataFrame:
    """Doctors with no specialty or more than five (the trigger's rule, both ends)."""
    counts = h.doctorspecialty.groupBy("doctor_id").agg(F.count(F.lit(1)).alias("_n"))
    n = F.coalesce(F.col("_n"), F.lit(0)).cast("bigint")
    return (h.doctor.select("doctor_id").join(counts, "doctor_id", "left")
            .filter((n == 0) | (n > MAX_SPECIALTIES))
            .select("doctor_id", n.alias("specialty_count")))


def _record_key(table: str):
    """The primary key of a record as text, parts joined by a bar, NULL as nothing."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in PRIMARY_KEYS[table]])


def _found(df: DataFrame, r: Rule) -> DataFrame:
    return df.select(F.lit(r.rule_id).alias("rule_id"), _record_key(r.table).alias("record_key"))


def _rebalanced(found: DataFrame) -> DataFrame:
    """What a join found, so that the join is a stage of its own (see above)."""
    return found.hint("rebalance", "record_key")


def _row_violations(h: Hospital, table: str, rs: list[Rule]) -> DataFrame:
    """All row rules of one table in one pass."""
    hits = F.filter(F.array(*[F.when(_violated(r.violation), F.lit(r.rule_id)) for r in rs]), lambda x: x.isNotNull())
    return getattr(h, table).select(F.explode(hits).alias("rule_id"), _record_key(table).alias("record_key"))


def _copies(df: DataFrame) -> DataFrame:
    """Every row ``_n`` times, by arrays of a bounded length."""
    last = F.col("_n") - 1
    return (df.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("bigint"), last, F.lit(COPIES_AT_ONCE).cast("bigint"))))
            .withColumn("_copy", F.explode(F.sequence("_from", F.least(F.col("_from") + (COPIES_AT_ONCE - 1), last)))))


def _key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the number ``_n`` of their rows, counted in tasks that AQE has sized (see above)."""
    dealt = df.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(HASH_VALUES)).alias("_hash")).hint("rebalance", "_hash")
    return dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def _unique_violations(h: Hospital, r: Rule) -> DataFrame:
    df = getattr(h, r.table)
    keys = list(r.key)
    filled = df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    again = _key_counts(filled, keys).filter(F.col("_n") > 1)
    if r.key == PRIMARY_KEYS[r.table]:  # the record key itself: no rows to look up
        return _found(_copies(again.hint("rebalance", *keys)), r)
    # a stage of its own, so that AQE sees how few keys there are before it sorts all rows for them
    again = again.select(*keys).repartition(*keys)
    return _rebalanced(_found(filled.join(again, keys, "left_semi"), r))


def _foreign_key_violations(h: Hospital, r: Rule) -> DataFrame:
    ref_table, ref_col = r.ref
    target = getattr(h, ref_table).select(F.col(ref_col).alias("_target"))
    child = getattr(h, r.table).filter(F.col(r.column).isNotNull())
    return _rebalanced(_found(child.join(target, F.col(r.column) == F.col("_target"), "left_anti"), r))


def _violations(h: Hospital, rs: list[Rule]) -> DataFrame:
    """``(rule_id, record_key)`` of every violating record."""
    by_table: dict[str, list[Rule]] = {}
    for r in rs:
        if r.violation is not None:
            by_table.setdefault(r.table, []).append(r)
    parts = [_row_violations(h, table, trs) for table, trs in by_table.items()]
    for r in rs:
        if r.family == "unique":
            parts.append(_unique_violations(h, r))
        elif r.family == "foreign_key":
            parts.append(_foreign_key_violations(h, r))
        elif r.family == "cardinality":
            parts.append(_rebalanced(_found(specialty_count_violations(h), r)))
    return _union_all(parts)


def _rule_list(h: Hospital, rs: list[Rule]) -> DataFrame:
    return h.spark.range(1).select(F.explode(F.array(*[F.struct(*_meta(r)) for r in rs])).alias("_r")).select("_r.*")


def rule_violations(h: Hospital, as_of) -> DataFrame:
    """``(rule_id, family, table_name, column_name, record_key)``, one row per violating record and rule."""
    rs = rules(as_of)
    return _violations(h, rs).join(F.broadcast(_rule_list(h, rs)), "rule_id").select(
        "rule_id", "family", "table_name", "column_name", "record_key")


def rule_counts(h: Hospital, as_of) -> DataFrame:
    """``(rule_id, family, table_name, column_name, violations)``, one row per rule, zeros included."""
    rs = rules(as_of)
    counts = _violations(h, rs).groupBy("rule_id").agg(F.count(F.lit(1)).alias("_n"))
    return _rule_list(h, rs).join(F.broadcast(counts), "rule_id", "left").select(
        "rule_id", "family", "table_name", "column_name",
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("violations")).orderBy("rule_id")
