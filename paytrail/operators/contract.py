"""The contract of raw payment events: typed rows for those that keep it, one reason for each other.

Arrivals are JSON texts with an ordinal.  Types are judged on the parsed variant, so
that 1.0, "1" or true is no integer.  Reasons are tried in a fixed order and the
first that holds is given.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.secrets import customer_token, escape_non_ascii, is_plain, may_be_prohibited, normalised, prohibited_keys, redacted
from ..functions.times import instant, time_reason
from ..vocabulary import (
    CURRENCIES,
    EVENT_TYPES,
    IDENTIFIER_PATTERN,
    OPTIONAL_FIELD,
    OUTBOX_OPERATIONS,
    OUTBOX_TABLE,
    REQUIRED_FIELDS,
    SCHEMA_VERSION,
)
from .identity import CONFLICT

IDENTIFIERS = ("event_id", "transaction_id", "source_id", "processor_id", "merchant_id")


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _field(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


FIELDS = (*REQUIRED_FIELDS, OPTIONAL_FIELD)
TIMES = ("event_time", "received_at")


TEXTS = "map<string,string>"


def extracted(rows: DataFrame, column: str = "value") -> DataFrame:
    """rows (payload, _enveloped) with keys, and kind and text of every contract field.

    Kinds are those of the variant.  Keys and texts come of one reading of the JSON text, which costs
    half of what casts of a variant's fields do; an object that repeats keys is written out anew first.
    """
    payload = F.col("payload")
    own_text = F.when(F.col("_enveloped"), F.to_json(payload)).when(payload.isNotNull(), F.col(column))
    read = rows.withColumns(
        {
            "_read": F.from_json(own_text, TEXTS),
            "_values": F.try_variant_get(payload, "$", f"struct<{','.join(f'{name}:variant' for name in FIELDS)}>"),
        }
    )
    keyed = read.withColumn("_keys", F.array_distinct(F.map_keys("_read")))
    repeats = F.size("_keys") < F.size(F.map_keys("_read"))
    keyed = keyed.withColumn("_texts", F.when(repeats, F.from_json(F.to_json(payload), TEXTS)).otherwise(F.col("_read")))
    kinds = {f"_kind_{name}": _kind(F.col("_values")[name]) for name in FIELDS}
    texts = {f"_raw_{name}": F.try_element_at("_texts", F.lit(name)) for name in FIELDS}
    unexpected = F.array_except("_keys", F.array(*map(F.lit, FIELDS)))
    return keyed.withColumns({"_unexpected": unexpected} | kinds | texts).drop("_read", "_texts", "_values")


def _text(name: str) -> Column:
    """A field that is a string, else null."""
    return F.when(F.col(f"_kind_{name}") == "STRING", F.col(f"_raw_{name}"))


def _integer(name: str) -> Column:
    """A field that is a whole number of at most 64 bits, else null."""
    return F.when(F.col(f"_kind_{name}") == "BIGINT", F.col(f"_raw_{name}").cast("long"))


def is_object(v: Column) -> Column:
    return F.coalesce(F.startswith(_kind(v), F.lit("OBJECT")), F.lit(False))


def last_of_repeated(rows: DataFrame) -> None:
    """Has Spark take the last value of a key that an object repeats; else it refuses the text."""
    rows.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def unwrap(arrivals: DataFrame, column: str = "value", keep: bool = False) -> DataFrame:
    """arrivals with payload (variant) and unwrap_reason.

    A direct event is its own payload.  A change-data envelope must be an insert or load
    into the outbox table, and its data is the payload.  keep leaves _enveloped, which tells them apart.
    """
    last_of_repeated(arrivals)
    parsed = arrivals.withColumn("_v", F.try_parse_json(F.col(column)))
    v = F.col("_v")
    meta, data = _field(v, "$.metadata"), _field(v, "$.data")
    # A JSON null counts as absent.
    absent = lambda x: F.coalesce(_kind(x), F.lit("VOID")) == "VOID"
    an_object = F.col(column).rlike(r"\A\s*\{")  # of a text that parses
    enveloped = F.col("_enveloped")
    parsed = parsed.withColumn("_enveloped", an_object & ~(absent(meta) & absent(data)))
    table, operation = (F.try_variant_get(v, f"$.metadata['{k}']", "string") for k in ("table-name", "operation"))
    reason = (
        F.when(v.isNull(), "invalid_json")
        .when(~an_object, "non_object_event")
        .when(~enveloped, None)
        .when(~(is_object(meta) & is_object(data)), "invalid_cdc_envelope")
        .when(F.coalesce(table != OUTBOX_TABLE, F.lit(True)), "unsupported_cdc_table")
        .when(F.coalesce(~operation.isin(*OUTBOX_OPERATIONS), F.lit(True)), "non_insert_outbox_mutation")
    )
    return parsed.withColumns({"unwrap_reason": reason, "payload": F.when(enveloped, data).otherwise(v)}).drop("_v", *([] if keep else ["_enveloped"]))


def prohibited(text: Column, parsed: Column) -> Column:
    """Sorted, comma-joined prohibited keys at any depth, or null; only suspected texts are written out anew and searched."""
    return F.when(may_be_prohibited(text), prohibited_keys(F.to_json(parsed)))


def fingerprint(keys: Column) -> Column:
    """SHA-256 of the identity fields that are present, in order, of a row that keeps the contract.

    Its texts but the address are plain ASCII without quotes, by their rules, so they are
    JSON as they are.  received_at is no part of the identity; an address that is null is.
    """
    parts = []
    for name in sorted({*FIELDS} - {"received_at"}):
        raw = F.col(f"_raw_{name}")
        if name == OPTIONAL_FIELD:
            address = normalised(raw)
            quoted = F.regexp_extract(F.to_json(F.struct(address.alias("x"))), r"(?s)\A\{\"x\":(.*)\}\z", 1)
            as_json = F.when(is_plain(raw), F.concat(F.lit('"'), address, F.lit('"'))).otherwise(escape_non_ascii(quoted))
            value = F.when(raw.isNotNull(), as_json).otherwise("null")
            parts.append(F.when(F.array_contains(keys, name), F.concat(F.lit(f'"{name}":'), value)))
        elif name in ("amount_minor", "transaction_version"):
            parts.append(F.concat(F.lit(f'"{name}":'), raw))
        else:
            parts.append(F.concat(F.lit(f'"{name}":"'), raw, F.lit('"')))
    return F.sha2(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")), 256)


def _reasons(keys: Column, with_key: bool) -> list[Column]:
    """Reasons in their order; each is null if its rule is kept."""
    listed = lambda names: F.array(*map(F.lit, names))
    joined = lambda xs: F.array_join(F.array_sort(xs), ",")
    missing = F.array_except(listed(REQUIRED_FIELDS), keys)
    unexpected = F.col("_unexpected")
    fails = lambda kept, reason: F.when(~F.coalesce(kept, F.lit(False)), F.lit(reason))
    email = _text(OPTIONAL_FIELD)
    no_email = F.coalesce(F.col(f"_kind_{OPTIONAL_FIELD}"), F.lit("VOID")) == "VOID"
    return [
        F.when(F.col("_prohibited").isNotNull(), F.concat(F.lit("prohibited_fields:"), F.col("_prohibited"))),
        F.when(F.size(missing) > 0, F.concat(F.lit("missing_fields:"), joined(missing))),
        F.when(F.size(unexpected) > 0, F.concat(F.lit("unexpected_fields:"), joined(unexpected))),
        fails(_text("schema_version") == SCHEMA_VERSION, "unsupported_schema_version"),
        *(fails(_text(name).rlike(IDENTIFIER_PATTERN), f"invalid_{name}") for name in IDENTIFIERS),
        F.when(F.col("_contract").isNull(), "unknown_source"),
        fails(F.col("_contract") == "payment_event", "source_contract_mismatch"),
        fails(_integer("transaction_version") >= 1, "invalid_transaction_version"),
        fails(_text("event_type").isin(*EVENT_TYPES), "unsupported_event_type"),
        fails(_integer("amount_minor") > 0, "invalid_amount_minor"),
        fails(_text("currency").isin(*CURRENCIES), "unsupported_currency"),
        *(time_reason(_text(name), name, F.col(f"_at_{name}")) for name in TIMES),
        fails(no_email | email.contains("@"), "invalid_customer_email"),
        *([] if with_key else [F.when(~no_email, "token_key_too_short")]),
    ]


def check(arrivals: DataFrame, registry: DataFrame, key: bytes, column: str = "value") -> DataFrame:
    """arrivals (ordinal, value) with reason (null if valid), the typed event columns and fingerprint.

    registry (source_id, contract, ...) has a row for each source; it is a control table of
    some dozens of rows and goes to every task.
    """
    contracts = registry.select(F.col("source_id").alias("_source"), F.col("contract").alias("_contract"))
    unwrapped = unwrap(arrivals, column, keep=True)
    own = unwrapped.withColumn("payload", F.when(F.col("unwrap_reason").isNull(), F.col("payload")))
    # A contract field is no prohibited key, so one is beside them or in a value that is nested.
    nested = reduce(or_, (F.coalesce(F.startswith(F.col(f"_kind_{name}"), F.lit(kind)), F.lit(False)) for name in FIELDS for kind in ("OBJECT", "ARRAY")))
    found = F.when((F.size("_unexpected") > 0) | nested, prohibited(F.col(column), F.col("payload")))
    joined = extracted(own, column).withColumn("_prohibited", found).join(F.broadcast(contracts), _text("source_id") == F.col("_source"), "left")
    # Each time is read once; rules and typed columns look at it.
    joined = joined.withColumns({f"_at_{name}": instant(_text(name)) for name in TIMES})
    judged = joined.withColumn("reason", F.coalesce(F.col("unwrap_reason"), *_reasons(F.col("_keys"), len(key) >= 32)))
    ok = F.col("reason").isNull()
    typed = {name: F.when(ok, _text(name)) for name in (*IDENTIFIERS, "event_type", "currency")}
    typed |= {name: F.when(ok, _integer(name)) for name in ("transaction_version", "amount_minor")}
    typed |= {name: F.when(ok, F.col(f"_at_{name}")) for name in TIMES}
    typed["customer_token"] = F.when(ok, customer_token(_text(OPTIONAL_FIELD), key)) if len(key) >= 32 else F.lit(None).cast("string")
    typed["fingerprint"] = F.when(ok, fingerprint(F.col("_keys")))
    return judged.withColumns(typed).select(*arrivals.columns, "reason", *EVENT_COLUMNS, "fingerprint")


EVENT_COLUMNS = (
    "event_id",
    "transaction_id",
    "transaction_version",
    "source_id",
    "processor_id",
    "merchant_id",
    "event_type",
    "amount_minor",
    "currency",
    "event_time",
    "received_at",
    "customer_token",
)


#: Reasons of arrivals that are no payload of the gate's at all.
UNREADABLE = ("invalid_json", "non_object_event", "invalid_cdc_envelope", "unsupported_cdc_table", "non_insert_outbox_mutation")


def readable(reason: Column) -> Column:
    """Whether an arrival with that reason (null if valid) may be kept as it came: it has a payload, without prohibited fields."""
    return F.coalesce(~reason.isin(*UNREADABLE) & ~F.startswith(reason, F.lit("prohibited_fields")), F.lit(True))


def conflicts(judged: DataFrame) -> DataFrame:
    """(ordinal, reason, payload) of valid events whose identifier is taken: their safe columns, which hold no clear address."""
    own = F.to_json(F.struct(*EVENT_COLUMNS), {"ignoreNullFields": "false"})
    return judged.filter(F.col("reason") == CONFLICT[1]).select("ordinal", "reason", own.alias("payload"))


def quarantine(rejected: DataFrame, column: str = "value") -> DataFrame:
    """(ordinal, reason, payload) of refused rows, personal data replaced."""
    last_of_repeated(rejected)
    return rejected.select("ordinal", "reason", redacted(F.col(column)).alias("payload"))
