"""Mapping uploaded exports onto the canonical schema, for many exports at once.

A catalog table `(company_id, position, column_name)` describes the exports. It is as wide
as the exports are, so collecting one export's columns into an array is bounded."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskloom.functions.scalars import anonymize_id, normalize_name, parse_date
from riskloom.operators.joins import alias_lookup

# Header names that stand for a field; where two fit, the earlier one wins.
COLUMN_ALIASES = {
    "customer_id": [
        "customerid", "custid", "userid", "accountid", "subscriberid", "clientid", "id",
        "customer", "email",
    ],
    "tenure": [
        "tenure", "tenuremonths", "monthsactive", "monthssubscribed", "accountagemonths",
        "customerage", "ageinmonths",
    ],
    "monthly_spend": [
        "monthlyspend", "mrr", "monthlyrecurringrevenue", "monthlyrevenue", "monthlyamount",
        "subscriptionamount", "recurringamount", "planprice", "amount", "revenue", "spend",
        "price",
    ],
    "usage_frequency": [
        "usagefrequency", "loginfrequency", "logincount", "sessions", "sessioncount",
        "activedays", "eventcount", "usagecount", "visits", "logins", "usage",
    ],
    "support_tickets": [
        "supporttickets", "ticketcount", "tickets", "numtickets", "supportrequests",
        "casecount", "complaints", "issues",
    ],
    "plan_type": [
        "plantype", "plan", "plyname", "planname", "subscriptiontier", "tier", "productname",
        "package", "subscription", "product",
    ],
    "review_text": [
        "reviewtext", "review", "comment", "comments", "feedback", "description", "body",
        "message", "text", "content", "verbatim",
    ],
    "date": ["date", "day", "reportdate", "activitydate", "period", "ds"],
    "active_users": ["activeusers", "dau", "dailyactiveusers", "users", "activeaccounts"],
    "signups": ["signups", "newusers", "registrations", "newcustomers", "acquisitions"],
}
# Names of a signup-date column, in order of preference.
SIGNUP_DATE_ALIASES = [
    "signupdate", "createdat", "created", "startdate", "subscriptionstart", "joindate",
    "firstseen", "registrationdate", "customersince", "activationdate",
]
CUSTOMER_FIELDS = [
    "customer_id", "tenure", "monthly_spend", "usage_frequency", "support_tickets", "plan_type",
]
SAFE_DEFAULTS = {"support_tickets": 0, "usage_frequency": 0}
MIN_CONTAINED_ALIAS = 4
DAYS_PER_MONTH = 30.44
PART_ROWS = 250_000

# Conversions of the raw SaaS churn table.
LOGIN_FREQUENCY = {"Daily": 30, "Weekly": 4, "Monthly": 1, "Rarely": 0}
TICKET_RISK_TERMS = [
    "support", "bug", "issue", "confusing", "cancel", "waiting", "problem", "error", "broken",
]
SOURCE_CHURN_COLUMNS = [
    "Customer_ID", "Account_Age_Days", "Login_Frequency", "Daily_Usage_Mins",
    "Last_Support_Ticket", "Churn",
]


def _by_export(catalog: DataFrame) -> DataFrame:
    """The rows of an export together, in parts of about `PART_ROWS` rows: what a task sorts does not grow with the catalog."""
    n = max(int(catalog.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-catalog.count() // PART_ROWS))
    return catalog.repartition(n, "company_id")


def unique_columns(catalog: DataFrame) -> DataFrame:
    """One row per (company, normalised name): the last spelling, the first position."""
    return (
        _by_export(catalog).withColumn("norm", normalize_name(F.col("column_name")))
        .groupBy("company_id", "norm")
        .agg(
            F.max_by("column_name", "position").alias("column_name"),
            F.min("position").alias("position"),
        )
    )


def _alias_table(targets: list[str]) -> Column:
    """All (field, tier, place, alias) options as one constant: 1 the field's own name, 2 an
    alias equal to the column, 3 an alias inside the column name, longer ones first."""
    rows = []
    for field_no, field in enumerate(targets):
        aliases = COLUMN_ALIASES.get(field, [])
        inside = [a for a in sorted(aliases, key=len, reverse=True) if len(a) >= MIN_CONTAINED_ALIAS]
        options = [[field.replace("_", "")], aliases, inside]
        rows += [
            {"field_no": field_no, "tier": tier, "place": place, "alias": alias}
            for tier, names in enumerate(options, start=1)
            for place, alias in enumerate(names)
        ]
    return F.from_json(
        F.lit(json.dumps(rows)), "array<struct<field_no:int,tier:int,place:int,alias:string>>"
    )


def _hits(norm: Column, targets: list[str]) -> Column:
    """The options a normalised column name fulfils."""
    return F.filter(
        _alias_table(targets),
        lambda o: F.when(o["tier"] == 3, norm.contains(o["alias"])).otherwise(norm == o["alias"]),
    )


def detect_column_mapping(catalog: DataFrame, targets: list[str] | None = None) -> DataFrame:
    """`(company_id, field_no, field, column_name, confidence)`, one row per target field.

    Fields pick in target order and a column is taken once. One shuffle brings an export's
    columns together; the picking is a fold over the field numbers inside the row."""
    targets = targets or list(COLUMN_ALIASES)
    columns = unique_columns(catalog).withColumn("hits", _hits(F.col("norm"), targets))
    offers = F.transform("hits", lambda h: F.struct(
        h["field_no"].alias("field_no"), h["tier"].alias("tier"), h["place"].alias("place"),
        F.col("position").cast("bigint").alias("position"), F.col("column_name").alias("column_name"),
    ))
    grouped = columns.groupBy("company_id").agg(F.flatten(F.collect_list(offers)).alias("offers"))

    def pick(state: Column, i: Column) -> Column:
        best = F.array_min(F.filter(
            "offers",
            lambda o: (o["field_no"] == i) & ~F.array_contains(state["taken"], o["column_name"]),
        ))
        return F.struct(
            F.array_append(state["taken"], F.coalesce(best["column_name"], F.lit(""))).alias("taken"),
            F.array_append(state["picks"], best).alias("picks"),
        )

    start = F.expr(
        "struct(cast(array() as array<string>) as taken, cast(array() as array<struct<field_no:int,"
        "tier:int,place:int,position:bigint,column_name:string>>) as picks)"
    )
    fields = F.sequence(F.lit(0), F.lit(len(targets) - 1))
    names = F.array(*[F.lit(f) for f in targets])
    levels = F.array(F.lit("exact"), F.lit("likely"), F.lit("guess"))
    folded = grouped.select("company_id", F.aggregate(fields, start, pick)["picks"].alias("picks"))
    return folded.select("company_id", F.posexplode("picks").alias("field_no", "pick")).select(
        "company_id", "field_no", F.get(names, F.col("field_no")).alias("field"),
        F.col("pick.column_name").alias("column_name"),
        F.get(levels, F.col("pick.tier") - 1).alias("confidence"),
    )


def best_match_per_field(catalog: DataFrame, targets: list[str] | None = None) -> DataFrame:
    """Every field's best column when columns may be shared between fields."""
    targets = targets or list(COLUMN_ALIASES)
    names = F.array(*[F.lit(f) for f in targets])
    options = unique_columns(catalog).select(
        "company_id", "column_name", "position", F.explode(_hits(F.col("norm"), targets)).alias("h")
    )
    return options.groupBy("company_id", F.get(names, F.col("h.field_no")).alias("field")).agg(
        F.min_by("column_name", F.struct("h.tier", "h.place", "position")).alias("column_name")
    )


def looks_like_dates(cells: DataFrame, sample_size: int = 25, threshold: float = 0.8) -> DataFrame:
    """`cells(company_id, column_name, row_no, value)`: do the first values parse as dates?

    Columns without any value are absent, which reads as no."""
    window = Window.partitionBy("company_id", "column_name").orderBy("row_no")
    sample = (
        cells.where(F.col("value").isNotNull())
        .withColumn("n", F.row_number().over(window))
        .where(F.col("n") <= sample_size)
    )
    share = F.avg(F.when(parse_date(F.col("value")).isNotNull(), 1.0).otherwise(0.0))
    return sample.groupBy("company_id", "column_name").agg(
        (share > threshold).alias("looks_like_dates")
    )


def detect_signup_date_column(catalog: DataFrame, date_like: DataFrame) -> DataFrame:
    """`(company_id, column_name)`: a known alias first, else the first date-named column
    whose cells parse. Exports without one keep a NULL."""
    columns = unique_columns(catalog)
    norm = F.col("norm")
    alias_rank = F.array_position(F.array(*[F.lit(a) for a in SIGNUP_DATE_ALIASES]), norm)
    named = norm.contains("date") | norm.contains("created") | norm.contains("since")
    joined = columns.join(date_like, ["company_id", "column_name"], "left")
    rank = F.when(alias_rank > 0, F.struct(F.lit(0).alias("kind"), alias_rank.alias("rank"))).when(
        named & F.coalesce("looks_like_dates", F.lit(False)),
        F.struct(F.lit(1).alias("kind"), F.col("position").cast("bigint").alias("rank")),
    )
    return joined.groupBy("company_id").agg(F.min_by("column_name", rank).alias("column_name"))


def whole_months(signup: Column, reference: Column) -> Column:
    """Months between two timestamps: full days / 30.44, half-even, missing or below 1 is 1."""
    seconds = F.unix_seconds(reference.cast("timestamp_ntz").cast("timestamp")) - F.unix_seconds(
        signup.cast("timestamp_ntz").cast("timestamp")
    )
    months = F.bround(F.floor(seconds / 86400) / F.lit(DAYS_PER_MONTH), 0)
    return F.greatest(F.coalesce(months, F.lit(1)).cast("int"), F.lit(1))


def derive_tenure(rows: DataFrame, date_column: str, company: str | None = "company_id",
                  reference_date: Column | None = None) -> DataFrame:
    """Add `tenure` in months since `date_column`, seen from the company's latest date."""
    parsed = rows.withColumn("__signup", parse_date(F.col(f"`{date_column}`")))
    if reference_date is not None:
        return parsed.withColumn(
            "tenure", whole_months(F.col("__signup"), reference_date)
        ).drop("__signup")
    by = [company] if company else []
    latest = parsed.groupBy(*by).agg(F.max("__signup").alias("__latest"))
    joined = parsed.join(latest, by, "left") if by else parsed.crossJoin(F.broadcast(latest))
    return joined.withColumn("tenure", whole_months(F.col("__signup"), F.col("__latest"))).drop(
        "__signup", "__latest"
    )


def apply_mapping(raw: DataFrame, mapping: dict[str, str | None], derive_tenure_from: str | None = None,
                  defaults: dict | None = None, company: str | None = "company_id") -> DataFrame:
    """Project a raw export onto canonical names, derive tenure and add defaults."""
    carried = [company] if company else []
    present = {f: c for f, c in mapping.items() if c and c in raw.columns}
    if "tenure" not in present and derive_tenure_from:
        raw = derive_tenure(raw, derive_tenure_from, company)
        present["tenure"] = "tenure"
    missing = {f: v for f, v in (defaults or {}).items() if f not in present}
    return raw.select(
        *carried,
        *[F.col(f"`{c}`").alias(f) for f, c in present.items()],
        *[F.lit(v).alias(f) for f, v in missing.items()],
    )


def mapping_summary(mapping: DataFrame) -> DataFrame:
    """Matched and unmatched fields per company, in target order."""
    found = F.col("column_name").isNotNull()

    def names(keep: Column) -> Column:
        picked = F.sort_array(F.collect_list(F.when(keep, F.struct("field_no", "field"))))
        return F.transform(picked, lambda p: p["field"])

    return mapping.groupBy("company_id").agg(
        names(found).alias("matched"), names(~found).alias("unmatched")
    )


def unmapped_fields(mapping: DataFrame, signup: DataFrame) -> DataFrame:
    """Fields that block scoring: no column, no default, and tenure not derivable."""
    derivable = signup.select("company_id", F.col("column_name").alias("signup_column"))
    return (
        mapping.where(F.col("field").isin(CUSTOMER_FIELDS) & F.col("column_name").isNull())
        .where(~F.col("field").isin("customer_id", *SAFE_DEFAULTS))
        .join(derivable, "company_id", "left")
        .where((F.col("field") != "tenure") | F.col("signup_column").isNull())
        .select("company_id", "field_no", "field")
    )


def missing_fields(catalog: DataFrame, required: list[str]) -> DataFrame:
    """Required column names an export does not have, one row each. Rows without an export's name count as an export without columns."""
    if not required:
        return catalog.select("company_id", "column_name").limit(0)
    # one row of flags for each export
    exports = _by_export(catalog.select("company_id", "column_name")).groupBy("company_id").agg(
        *[F.coalesce(F.bool_or(F.col("column_name") == c), F.lit(False)).alias(f"__has_{i}") for i, c in enumerate(required)])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__has_{i}").alias("has")) for i, c in enumerate(required)])
    return exports.select("company_id", F.inline(cells)).where(~F.col("has") | F.col("company_id").isNull()).drop("has")


def standardize_source_churn(raw: DataFrame) -> DataFrame:
    """The raw SaaS churn table in canonical columns; spend and plan restate usage minutes."""
    absent = [c for c in SOURCE_CHURN_COLUMNS if c not in raw.columns]
    if absent:
        raise ValueError(f"SaaS churn files are missing columns: {absent}")
    minutes = F.col("Daily_Usage_Mins").cast("double")
    ticket = F.lower(F.coalesce(F.col("Last_Support_Ticket"), F.lit("nan")))
    plan = (
        F.when((minutes > -1) & (minutes <= 25), "basic")
        .when((minutes > 25) & (minutes <= 80), "pro")
        .when(minutes > 80, "enterprise")
        .otherwise("nan")
    )
    spend = F.least(F.greatest(minutes * 0.85 + 25, F.lit(10.0)), F.lit(200.0))
    months = F.bround(F.col("Account_Age_Days") / 30, 0).cast("int")
    return raw.select(
        *[c for c in ("company_id",) if c in raw.columns],
        anonymize_id(F.col("Customer_ID")).alias("customer_id"),
        F.greatest(months, F.lit(1)).alias("tenure"),
        (F.rint(spend * 100) / 100).alias("monthly_spend"),
        alias_lookup(F.col("Login_Frequency"), LOGIN_FREQUENCY, 0).alias("usage_frequency"),
        F.when(ticket.rlike("|".join(TICKET_RISK_TERMS)), 1).otherwise(0).alias("support_tickets"),
        plan.alias("plan_type"),
        F.col("Churn").cast("int").alias("churn_label"),
    )
