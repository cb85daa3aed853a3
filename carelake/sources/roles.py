"""Role mapping: the fifteen hospital tables derived from the driver's tables.

The correctness oracle only sees the driver's TPC-H-like tables, so the
hospital tables are *derived* from them, here with the DataFrame API and
in ``roles_sql`` with the same rules as DuckDB SQL.  Every table grows
with the scale factor; key arithmetic only assigns attributes (which
doctor, which bed, which status, which second); no source row is left out.

    department        <- region            (5 rows at every scale)
    ward              <- nation x region   (25 rows; ward 24 gets no beds)
    bed               <- part
    staff             <- supplier x nation x region
    doctor / nurse    <- staff by type
    specialty         <- distinct part brands
    doctorspecialty   <- part: small parts name a doctor each, the others of a brand one doctor
    patient           <- customer
    admission         <- orders
    planned/emergency <- admission by type
    billingstatement  <- discharged orders
    invoice           <- 0..2 per bill,    payment <- 0..2 per invoice
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.sources.schemas import SCHEMAS, WEEK

# The date the driver tables are evaluated at (their last order date).
DRIVER_AS_OF = "2001-08-01"


class Hospital:
    """The fifteen hospital tables, each built on first access and then reused.

    A query touches only the tables it reads, so it pays driver-side plan
    construction for those alone.
    """

    def __init__(self, builders: dict[str, Callable[["Hospital"], DataFrame]], spark: SparkSession):
        self._builders = builders
        self._cache: dict[str, DataFrame] = {}
        self.spark = spark

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self.__dict__.get("_builders", {}):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = conform(self._builders[name](self), name)
        return self._cache[name]

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in SCHEMAS}

    def register(self) -> None:
        """Expose every table as a temp view (for the SQL API)."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast the columns of ``table`` in schema order; the week of a partitioned table comes last."""
    week = [F.col(WEEK)] if WEEK in df.columns else []
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[table].fields] + week)


def _pick(key: Column, values: tuple[str, ...]) -> Column:
    """``values[key % len(values)]`` as a CASE expression."""
    expr = None
    for i, v in enumerate(values):
        cond = (key % len(values)) == i
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr


def _txt(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def from_driver_tables(spark: SparkSession, sf_dir: str) -> Hospital:
    """Hospital tables derived from the driver's parquet tables under ``sf_dir``."""

    @cache
    def src(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def n_rows(name: str, even_keys_only: bool = False) -> Column:
        # Key-space sizes used to assign doctors / beds: a scalar subquery, run with the
        # query (Spark reuses identical ones), so that no count outlives the data.
        df = src(name)
        if even_keys_only:
            df = df.filter(F.col("s_suppkey") % 2 == 0)
        return df.select(F.count(F.lit(1))).scalar()

    def department(h):
        return src("region").select(
            F.col("r_name").alias("dept_name"),
            F.when(F.col("r_regionkey") == 2, F.lit("24 Hours"))
            .otherwise(F.lit("08:00 AM - 06:00 PM")).alias("operating_hours"),
            F.lit(0).alias("staff_headcount"))

    def ward(h):
        nation, region = src("nation"), src("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_nationkey").alias("ward_id"),
            F.col("n_name").alias("ward_name"),
            F.col("r_name").alias("dept_name"),
            F.when(F.col("n_nationkey") % 5 == 0, F.lit("ICU")).otherwise(F.lit("General")).alias("ward_type"),
            (F.col("n_nationkey") + 10).alias("bed_capacity"))

    pk = F.col("p_partkey")

    def bed(h):
        return src("part").select(
            pk.alias("bed_id"),
            (pk % 24).alias("ward_id"),
            F.lit(2.0).alias("bed_length"), F.lit(1.0).alias("bed_width"),
            F.lit(16.0).alias("mattress_thickness"),
            F.when(F.col("p_size") > 25, F.lit("Premium")).otherwise(F.lit("Standard")).alias("comfort_level"),
            F.col("p_retailprice").alias("bed_cost"),
            _pick(F.col("p_size"), ("Occupied", "Available", "Maintenance", "Reserved")).alias("bed_status"))

    sk = F.col("s_suppkey")

    def staff(h):
        supplier, nation, region = src("supplier"), src("nation"), src("region")
        return (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
                .join(region, F.col("n_regionkey") == region.r_regionkey)
                .select(
                    sk.alias("staff_id"),
                    F.col("s_name").alias("full_name"),
                    F.when(sk % 13 != 5, F.concat(_txt("staff", sk), F.lit("@hospital.example"))).alias("email"),
                    _txt("04", sk).alias("mobile"),
                    F.concat(F.col("s_nationkey").cast("string"), F.lit(" Hospital Rd")).alias("address"),
                    (F.abs(F.col("s_acctbal")).cast("decimal(10,2)") + F.lit(1).cast("decimal(10,2)"))
                    .alias("salary"),
                    F.when(sk % 17 != 16, F.col("r_name")).alias("dept_name"),
                    F.when(sk % 2 == 0, F.lit("Doctor")).when(sk % 10 == 9, F.lit("Allied Health"))
                    .otherwise(F.lit("Nurse")).alias("staff_type")))

    did = F.col("staff_id")

    def doctor(h):
        return h.staff.filter(F.col("staff_type") == "Doctor").select(
            did.alias("doctor_id"),
            _txt("MED", did).alias("medical_license_number"),
            F.date_add(F.to_date(F.lit("2001-01-01")), (did * 37 % 700).cast("int")).alias("license_expiry_date"),
            F.lit("NSW").alias("license_state"))

    def nurse(h):
        return h.staff.filter(F.col("staff_type") == "Nurse").select(
            did.alias("nurse_id"),
            (did % 3 != 0).alias("wwcc_clearance"),
            F.when(did % 3 != 0, F.date_add(F.to_date(F.lit("2001-01-01")), (did * 53 % 500).cast("int")))
            .alias("wwcc_expiry_date"))

    def specialty(h):
        return src("part").groupBy("p_brand").agg(F.min("p_size").alias("min_size")).select(
            F.col("p_brand").alias("specialty_name"),
            _pick(F.substring(F.col("p_brand"), -1, 1).cast("int"),
                  ("Other", "Surgical", "Medical", "Diagnostic", "Emergency", "Pediatric"))
            .alias("specialty_category"),
            F.lit(True).alias("certification_required"),
            (F.col("min_size") % 8).alias("min_years_training"),
            F.concat(F.lit("Specialty "), F.col("p_brand")).alias("description"))

    def doctorspecialty(h):
        # Doctor ids are the even supplier keys.  A small part names a doctor by its
        # key, any other one by its brand, so doctors have none, a few or many brands.
        n_doctors = n_rows("supplier", even_keys_only=True)
        brand = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("long")
        return (
            src("part")
            .select((F.when(F.col("p_size") <= 5, pk % n_doctors).otherwise(brand * 7 % n_doctors) * 2)
                    .alias("doctor_id"), F.col("p_brand").alias("specialty_name"), "p_partkey", "p_size")
            .groupBy("doctor_id", "specialty_name")
            .agg(F.min("p_partkey").alias("first_part"), F.max("p_partkey").alias("last_part"),
                 F.min("p_size").alias("min_size"))
            .select("doctor_id", "specialty_name",
                    F.date_add(F.to_date(F.lit("1990-01-01")), (F.col("first_part") % 3650).cast("int"))
                    .alias("training_date"),
                    _pick(F.col("last_part"), ("Beginner", "Intermediate", "Advanced", "Expert"))
                    .alias("proficiency_level"),
                    (F.col("min_size") == 1).alias("is_primary_specialty")))

    ck = F.col("c_custkey")

    def patient(h):
        return src("customer").select(
            ck.alias("patient_id"),
            F.col("c_name").alias("full_name"),
            F.concat(_txt("patient", ck), F.lit("@mail.example")).alias("email"),
            F.concat(F.col("c_nationkey").cast("string"), F.lit(" Patient St")).alias("address"),
            F.date_add(F.to_date(F.lit("1940-01-01")), (ck * 97 % 25000).cast("int")).alias("date_of_birth"),
            _txt("05", ck).alias("mobile"),
            F.concat(F.lit("Contact of "), F.col("c_name")).alias("emergency_contact_name"),
            _txt("06", ck).alias("emergency_contact_phone"),
            _txt("INS", ck).alias("insurance_number"),
            _pick(F.col("c_nationkey"), ("A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-", "Unknown"))
            .alias("blood_type"),
            F.when(ck % 4 == 0, F.lit("None")).otherwise(F.col("c_mktsegment")).alias("allergies"))

    ok = F.col("o_orderkey")
    open_stay = F.col("o_orderstatus") == "O"
    discharge = F.date_add(F.to_date(F.col("o_orderdate")), (ok % 21).cast("int"))

    def admission(h):
        n_staff, n_beds = n_rows("supplier"), n_rows("part")
        return src("orders").select(
            ok.alias("admission_id"),
            F.col("o_custkey").alias("patient_id"),
            # admissions differ by microseconds too, so that time order is tested exactly
            (F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(
                hours=(ok % 24).cast("int"), secs=(ok * 7919 % 1000000 / 1000000).cast("decimal(18,6)")))
            .alias("admission_date"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("Emergency"))
            .otherwise(F.lit("Planned")).alias("admission_type"),
            F.when(ok % 11 != 0, (ok * 2 + 1) % n_staff).alias("nurse_id"),
            F.when(ok % 29 != 0, (ok * 2) % n_staff).alias("doctor_id"),
            F.when(ok % 31 != 0, ok % n_beds).alias("bed_id"),
            F.when(~open_stay, discharge).alias("discharge_date"),
            _txt("Dx-", F.col("o_custkey") % 37).alias("primary_diagnosis"),
            F.lit(None).cast("string").alias("discharge_summary"),
            F.when(~open_stay, F.when(ok % 10 == 0, F.lit("Transfer")).when(ok % 10 == 1, F.lit("Deceased"))
                   .when(ok % 10 == 2, F.lit("Against Medical Advice")).otherwise(F.lit("Home")))
            .alias("discharge_disposition"))

    aid = F.col("admission_id")

    def plannedadmission(h):
        return h.admission.filter(F.col("admission_type") == "Planned").select(
            aid, _txt("Dr. Referrer ", F.col("patient_id") % 100).alias("referring_practitioner"),
            _txt("REF", aid).alias("reference_number"))

    def emergencyadmission(h):
        return h.admission.filter(F.col("admission_type") == "Emergency").select(
            aid, F.col("nurse_id").alias("triage_nurse_id"),
            _txt("Condition ", aid % 13).alias("patient_condition"),
            _pick(aid, ("Critical", "High", "Medium", "Low")).alias("severity_level"))

    def billingstatement(h):
        total = (F.col("o_totalprice").cast("decimal(12,2)") % 49900 + 100).cast("decimal(10,2)")
        bills = src("orders").filter(~open_stay).select(
            ok.alias("billing_id"), ok.alias("admission_id"), discharge.alias("discharge_date"),
            _txt("Services for admission ", ok).alias("services_description"),
            total.alias("total_cost"), (ok % 5 * 250).cast("decimal(10,2)").alias("copay"))
        covered = (F.col("total_cost") - F.least(F.col("total_cost"), F.col("copay"))).cast("decimal(10,2)")
        # Generated column (O-S5): remaining_balance = total_cost - insurance_covered_amount.
        return (bills.withColumn("insurance_covered_amount", covered)
                .withColumn("remaining_balance",
                            (F.col("total_cost") - F.col("insurance_covered_amount")).cast("decimal(10,2)")))

    def invoice(h):
        bid, k = F.col("billing_id"), F.col("k")
        n_inv = (bid % 3).cast("int")
        return (h.billingstatement
                .select(bid, "discharge_date", "remaining_balance",
                        F.explode(F.when(n_inv > 0, F.sequence(F.lit(1), n_inv))).alias("k"))
                .select((bid * 3 + k).alias("invoice_id"), bid,
                        F.date_add(F.col("discharge_date"), k).alias("issue_date"),
                        F.when((bid + k) % 7 != 0, F.date_add(F.col("discharge_date"), k + 30)).alias("due_date"),
                        F.when(k == 1, F.col("remaining_balance")).otherwise(F.lit(50).cast("decimal(10,2)"))
                        .alias("amount_due"),
                        _pick(bid + k, ("Paid", "Unpaid", "Partially Paid", "Overdue")).alias("payment_status")))

    def payment(h):
        iid, j = F.col("invoice_id"), F.col("j")
        n_pay = (iid % 3).cast("int")
        return (h.invoice
                .select(iid, "issue_date", "amount_due",
                        F.explode(F.when(n_pay > 0, F.sequence(F.lit(1), n_pay))).alias("j"))
                .select((iid * 3 + j).alias("payment_id"), iid,
                        F.when(j == 1, F.lit("Credit Card")).otherwise(F.lit("Bank Transfer")).alias("payment_method"),
                        _txt("Holder ", iid).alias("cardholder_name"),
                        F.lpad((iid % 10000).cast("string"), 4, "0").alias("card_last_four"),
                        F.when(j == 1, F.lit("Visa")).alias("card_type"),
                        F.lit("Stripe").alias("payment_processor"),
                        _txt("TXN", iid * 3 + j).alias("transaction_id"),
                        F.lit(None).cast("string").alias("payment_token"),
                        F.date_add(F.col("issue_date"), j * 5).alias("payment_date"),
                        F.when(j == 1, F.col("amount_due") + F.lit(1).cast("decimal(10,2)"))
                        .otherwise(F.lit(25).cast("decimal(10,2)")).alias("payment_amount"),
                        F.when((iid + j) % 5 == 0, F.lit("Failed")).when((iid + j) % 7 == 0, F.lit("Pending"))
                        .otherwise(F.lit("Completed")).alias("payment_status")))

    builders = dict(department=department, ward=ward, bed=bed, staff=staff, doctor=doctor,
                    specialty=specialty, doctorspecialty=doctorspecialty, nurse=nurse, patient=patient,
                    admission=admission, plannedadmission=plannedadmission,
                    emergencyadmission=emergencyadmission, billingstatement=billingstatement,
                    invoice=invoice, payment=payment)
    return Hospital(builders, spark)
