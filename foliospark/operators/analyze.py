"""Findings over extracted records: duplicates, expiring contracts, spend, quality flags.

A record has doc_id (unique), document_name, document_type, extraction_status, error and one
column per field; amounts may be numbers or text as written. Names may repeat, so rows of a
large group are spread by doc_id.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark import rules
from foliospark.functions import dates as D
from foliospark.functions import exact as X
from foliospark.functions import money as M
from foliospark.functions import text as T
from foliospark.functions.binding import bind
from foliospark.operators.skew import groups_of, lookup_join, rows_of_groups, with_ordinal

GROUP_KEYS = ("vendor_name", "invoice_number", "amount")


def succeeded(status: str = "extraction_status") -> Column:
    return F.coalesce(F.col(status).startswith("success"), F.lit(False))


def _fingerprint() -> dict[str, Column]:
    """What invoices are compared by: vendor and number without case and outer blanks, and amount."""
    def clean(name: str) -> Column:
        return F.lower(T.strip(F.col(name)))

    return {
        "vendor_name": clean("vendor_name"),
        "invoice_number": clean("invoice_number"),
        "amount": M.parse_money(F.col("total_amount")),
    }


def _is_invoice() -> Column:
    return (F.col("document_type") == "invoice") & succeeded()


def _usable(key: dict[str, Column]) -> Column:
    return (key["vendor_name"] != "unknown") & (key["invoice_number"] != "unknown") & (key["amount"] > 0)


def invoice_fingerprints(records: DataFrame) -> DataFrame:
    """Successful invoices with a usable fingerprint: known vendor and number, amount > 0.

    Vendor and number are compared without case and outer blanks.
    """
    keyed = records.where(_is_invoice()).select(
        "doc_id", "document_name", *(c.alias(name) for name, c in _fingerprint().items())
    )
    return bind(keyed, list(GROUP_KEYS)).where(_usable({k: F.col(k) for k in GROUP_KEYS}))


def duplicate_groups(records: DataFrame) -> DataFrame:
    """One row per fingerprint that several invoices share, with their number."""
    return groups_of(invoice_fingerprints(records), GROUP_KEYS).withColumnRenamed(
        "group_rows", "document_count"
    )


def duplicate_invoices(records: DataFrame, salts: int | None = None) -> DataFrame:
    """One row per document of a duplicate group, with the group's keys and size.

    Members stay rows: a group may be as large as a third of the table.
    """
    return rows_of_groups(
        invoice_fingerprints(records), GROUP_KEYS, ["doc_id"], 2, salts
    ).withColumnRenamed("group_rows", "document_count")


def duplicate_group_lists(
    records: DataFrame, list_rows: int = 1000, salts: int | None = None
) -> DataFrame:
    """Members as arrays of about `list_rows` names, with `list_number` from 0 and `lists`, the
    number of arrays of the group: a group of any size has rows of the same form."""
    lists = F.ceil(F.col("document_count") / list_rows).cast("bigint")
    return (
        duplicate_invoices(records, salts)
        .withColumn("lists", lists)
        .withColumn("list_number", F.pmod(F.xxhash64("doc_id"), F.col("lists")).cast("bigint"))
        .groupBy(*GROUP_KEYS, "document_count", "lists", "list_number")
        .agg(F.sort_array(F.collect_list("document_name")).alias("documents"))
    )


def duplicate_alert_rows(records: DataFrame, salts: int | None = None) -> DataFrame:
    """Duplicate members with the number of their group (from 1, in key order).

    Only members of groups are matched with the numbers; which rows those are comes from one
    shuffled count of the fingerprints.
    """
    members = rows_of_groups(invoice_fingerprints(records), GROUP_KEYS, ["doc_id"], 2, salts)
    numbered = with_ordinal(duplicate_groups(records), GROUP_KEYS, "group_number")
    members = lookup_join(
        members.drop("group_rows"), numbered.drop("document_count"), GROUP_KEYS, ["doc_id"], "inner", salts
    )
    return members.select(
        F.concat(F.lit("GROUP "), F.col("group_number").cast("string")).alias("alert_group"),
        "document_name", "vendor_name", "invoice_number", "amount",
    )


def _contract_dates(records: DataFrame) -> DataFrame:
    contracts = records.where(
        (F.col("document_type") == "contract")
        & succeeded()
        & (F.coalesce("termination_date", F.lit("")) != "")
    )
    dated = contracts.withColumn("_expiry", D.iso_timestamp(F.col("termination_date")))
    return bind(dated, ["_expiry"])


def expiring_contracts(
    records: DataFrame, as_of: str, days: int = rules.CONTRACT_EXPIRY_DAYS
) -> DataFrame:
    """Contracts that end within 0 to `days` days of `as_of`, soonest first.

    `as_of` has a time of day and days are rounded down, so a contract that ends on the same
    date is already over.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    parties = F.coalesce("contracting_parties", F.array().cast("array<string>"))
    return (
        _contract_dates(records)
        .withColumn("days_to_expiry", D.days_between(now, F.col("_expiry")))
        .where(F.col("days_to_expiry").between(0, days))
        .select("document_name", "termination_date", "days_to_expiry", parties.alias("parties"))
        .orderBy("days_to_expiry", "document_name")
    )


def unparsable_dates(records: DataFrame) -> DataFrame:
    """Contracts whose end date is not an ISO date without offset."""
    return _contract_dates(records).where(F.col("_expiry").isNull()).select(
        "document_name", "termination_date"
    )


def _spend_amounts(records: DataFrame) -> DataFrame:
    """(vendor_name, _sign, _exact, _rest) of the records whose amount counts: the amount as a decimal,
    or, where that does not hold it, as a double."""
    total = F.col("total_amount")
    sign = F.when(F.col("document_type") == "credit_note", -1).otherwise(1)
    amounts = records.where(F.col("document_type").isin(*rules.SPEND_TYPES) & succeeded()).select(
        "vendor_name",
        sign.alias("_sign"),
        M.parse_money(total).alias("_amount"),
        M.parse_money_exact(total).alias("_exact"),
    )
    kept = amounts.where((F.coalesce("vendor_name", F.lit("")) != "") & (F.col("_amount") > 0))
    return kept.withColumn("_rest", F.when(F.col("_exact").isNull(), F.col("_amount")))


def vendor_net_spend(records: DataFrame) -> DataFrame:
    """Spend per vendor, credit notes subtracted, largest first.

    Every amount above zero counts. Sums are exact, whatever the order of the rows: decimals, and
    for amounts too large or too fine for them, limbs of doubles (see `functions.exact`).
    """
    nothing = F.array(F.lit(None).cast(X.LIMB))
    limbs = F.when(F.col("_rest").isNull(), nothing).otherwise(
        F.array_append(X.limbs_of(F.col("_rest") * F.col("_sign")), F.lit(None).cast(X.LIMB))
    )
    # one row for the amount itself, which is counted, and one for each limb
    rows = _spend_amounts(records).select("vendor_name", (F.col("_exact") * F.col("_sign")).alias("_exact"), F.explode(limbs).alias("_l"))
    sums = rows.groupBy("vendor_name", F.col("_l.place").alias("place")).agg(
        F.sum("_l.limb").alias("limb"),
        F.sum(F.when(F.col("_l").isNull(), F.col("_exact"))).alias("_exact"),
        F.count_if(F.col("_l").isNull()).alias("_n"),
    )
    rest = F.collect_list(F.when(F.col("place").isNotNull(), F.struct("place", "limb")))
    exact = F.sum("_exact")
    spend = F.when(F.size(rest) == 0, F.round(exact, 2).cast("double")).otherwise(
        F.round(F.coalesce(exact.cast("double"), F.lit(0.0)) + X.from_limbs(rest), 2)
    )
    return (
        sums.groupBy("vendor_name")
        .agg(spend.alias("net_spend"), F.sum("_n").alias("doc_count"))
        .orderBy(F.desc("net_spend"), "vendor_name")
    )


@dataclass(frozen=True)
class QualityRule:
    """A flag for one document type, raised where `broken` (a function of no arguments) holds."""

    document_type: str
    issue: str
    details: str
    broken: object


def _absent(field: str):
    return lambda: F.coalesce(F.col(field).cast("string"), F.lit("")) == ""


def _no_amount(field: str):
    return lambda: M.money_or_zero(F.col(field)) <= 0


QUALITY_RULES = (
    QualityRule("invoice", rules.ISSUE_MISSING, rules.DETAIL_NUMBER, _absent("invoice_number")),
    QualityRule("invoice", rules.ISSUE_INVALID, rules.DETAIL_TOTAL, _no_amount("total_amount")),
    QualityRule(
        "receipt", rules.ISSUE_MISSING, rules.DETAIL_TRANSACTION_DATE, _absent("transaction_date")
    ),
    QualityRule("receipt", rules.ISSUE_INVALID, rules.DETAIL_TOTAL, _no_amount("total_amount")),
    QualityRule(
        "contract", rules.ISSUE_MISSING, rules.DETAIL_EFFECTIVE_DATE, _absent("effective_date")
    ),
    QualityRule(
        "contract", rules.ISSUE_INVALID, rules.DETAIL_PARTIES,
        lambda: F.coalesce(F.size("contracting_parties"), F.lit(0)) < 2,
    ),
)


def _flags(quality_rules: Sequence[QualityRule]) -> Column:
    """The flags that a record raises, as an array of (issue, details)."""
    ok = succeeded()
    failed = F.when(
        ~ok,
        F.struct(
            F.lit(rules.ISSUE_FAILED).alias("issue"),
            F.coalesce("error", F.lit(rules.DETAIL_UNKNOWN)).alias("details"),
        ),
    )
    flags = [failed] + [
        F.when(
            ok & (F.col("document_type") == r.document_type) & r.broken(),
            F.struct(F.lit(r.issue).alias("issue"), F.lit(r.details).alias("details")),
        )
        for r in quality_rules
    ]
    return F.array_compact(F.array(*flags))


def data_quality_flags(
    records: DataFrame, quality_rules: Sequence[QualityRule] = QUALITY_RULES
) -> DataFrame:
    """One row per flag; a record may raise several. One pass, no shuffle."""
    return records.select(
        "document_name", "document_type", F.explode(_flags(quality_rules)).alias("_f")
    ).select("document_name", "document_type", "_f.issue", "_f.details")


def finding_counts(
    records: DataFrame,
    as_of: str,
    days: int = rules.CONTRACT_EXPIRY_DAYS,
    quality_rules: Sequence[QualityRule] = QUALITY_RULES,
) -> DataFrame:
    """One row: duplicates (groups of them), expiring contracts, flags and vendors with spend, from one
    pass over the records.

    Each record lists what it counts for, with the key it counts by; keys are combined before they
    are shuffled, so a popular one costs one row per task.
    """
    left = D.days_between(F.lit(as_of).cast("timestamp_ntz"), D.iso_timestamp(F.col("termination_date")))
    contract = (
        (F.col("document_type") == "contract") & succeeded() & (F.coalesce("termination_date", F.lit("")) != "")
    )
    spender = (
        F.col("document_type").isin(*rules.SPEND_TYPES) & succeeded() & (F.coalesce("vendor_name", F.lit("")) != "")
    )
    key = _fingerprint()
    seen = records.select(
        "vendor_name",
        F.when(_is_invoice(), F.struct(*(c.alias(name) for name, c in key.items()))).alias("_print"),
        (spender & (key["amount"] > 0)).alias("_spends"),
        F.when(contract, left.between(0, days)).alias("_expires"),
        F.size(_flags(quality_rules)).alias("_flags"),
    )
    seen = bind(seen, ["_print", "_spends", "_expires", "_flags"])
    usable = _usable({k: F.col("_print")[k] for k in GROUP_KEYS})
    nothing = F.lit(None).cast(seen.schema["_print"].dataType)
    name = F.lit(None).cast("string")

    def entry(kind: str, fingerprint: Column, vendor: Column, value: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"), fingerprint.alias("print"), vendor.alias("vendor"), value.cast("bigint").alias("value")
        )

    entries = F.array(
        F.when(usable, entry("duplicates", F.col("_print"), name, F.lit(1))),
        F.when(F.col("_spends"), entry("vendors", nothing, F.col("vendor_name"), F.lit(1))),
        F.when(F.col("_expires"), entry("expiring", nothing, name, F.lit(1))),
        F.when(F.col("_flags") > 0, entry("flags", nothing, name, F.col("_flags"))),
    )
    by_key = (
        seen.select(F.inline(F.array_compact(entries)))
        .groupBy("kind", "print", "vendor")
        .agg(F.sum("value").alias("value"))
    )
    kind, value = F.col("kind"), F.col("value")
    return by_key.agg(
        F.count_if((kind == "duplicates") & (value > 1)).alias("duplicates"),
        F.coalesce(F.sum(F.when(kind == "expiring", value)), F.lit(0)).alias("expiring"),
        F.coalesce(F.sum(F.when(kind == "flags", value)), F.lit(0)).alias("flags"),
        F.count_if(kind == "vendors").alias("vendors"),
    )
