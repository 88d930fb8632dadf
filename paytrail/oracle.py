"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from .sources.generator import EVENT_SOURCES
from .sources.sample import DEFECTS
from .vocabulary import FAMILIES, POSTING_RULES, STATE, STATUSES

EVENTS = """
o AS (SELECT o_orderkey AS k, o_custkey AS custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS auth, o_orderdate AS event_time FROM orders),
l0 AS (SELECT l_orderkey AS k, *, CASE WHEN l_returnflag <> 'R' THEN 'capture' WHEN l_linestatus = 'F' THEN 'refund' ELSE 'chargeback' END AS et FROM lineitem),
l AS (SELECT k, et,
  row_number() OVER (PARTITION BY k ORDER BY CASE WHEN k % 11 = 0 THEN 0 WHEN l_returnflag = 'R' THEN 1 ELSE 0 END,
    l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_returnflag, l_linestatus) AS rn,
  count(*) FILTER (WHERE et = 'capture') OVER (PARTITION BY k) AS ncap,
  count(*) FILTER (WHERE et <> 'capture') OVER (PARTITION BY k) AS nrev FROM l0),
h AS (
  SELECT k, custkey, event_time, 0 AS seq, CAST(1 AS BIGINT) AS v,
    CASE WHEN k % 137 = 0 THEN 'refund' WHEN k % 139 = 0 OR k % 113 = 0 THEN 'capture' ELSE 'authorization' END AS kind, auth AS amount, 0 AS p, 0 AS m, 0 AS c FROM o
  UNION ALL
  SELECT k, custkey, event_time, rn,
    CASE WHEN k % 131 = 0 THEN rn WHEN k % 127 = 0 THEN rn + 2 ELSE rn + 1 END,
    CASE WHEN k % 137 = 0 THEN 'refund' WHEN rn = 1 AND (k % 139 = 0 OR k % 109 = 0) THEN 'authorization' ELSE et END,
    greatest(1, CAST(CASE WHEN et = 'capture' THEN
        CASE WHEN k % 3 = 0 THEN floor(CAST(auth AS DOUBLE) / (2 * ncap)) WHEN k % 13 = 0 THEN auth
          WHEN rn = 1 AND k % 11 <> 0 THEN auth - floor(CAST(auth AS DOUBLE) / ncap) * (ncap - 1) ELSE floor(CAST(auth AS DOUBLE) / ncap) END
      ELSE CASE WHEN k % 4 = 0 THEN floor(CAST(auth AS DOUBLE) / nrev) ELSE floor(CAST(auth AS DOUBLE) / (8 * nrev)) END END AS BIGINT)),
    CASE WHEN k % 101 = 0 THEN 1 ELSE 0 END, CASE WHEN k % 107 = 0 THEN 1 ELSE 0 END, CASE WHEN k % 103 = 0 THEN 1 ELSE 0 END
  FROM l JOIN o USING (k)),
full_events AS (SELECT 'txn-' || k || ':e' || seq AS event_id, 'txn-' || k AS transaction_id, v AS transaction_version, kind AS event_type, amount AS amount_minor,
  'processor-0' || ((k + p) % 3 + 1) AS processor_id, 'merchant-' || ((custkey + m) % 250) AS merchant_id,
  ['INR', 'USD', 'EUR', 'GBP'][(k + c) % 4 + 1] AS currency, event_time, k, seq, custkey FROM h),
ev AS MATERIALIZED (SELECT * EXCLUDE (k, seq, custkey) FROM full_events)"""

ASSESSED = (
    EVENTS
    + """,
g AS (SELECT transaction_id, count(*) AS n_events, count(DISTINCT transaction_version) AS n_versions, min(transaction_version) AS min_version, max(transaction_version) AS max_version,
  count(DISTINCT currency) AS n_cur, count(DISTINCT processor_id) AS n_pro, count(DISTINCT merchant_id) AS n_mer,
  count(*) FILTER (WHERE event_type = 'authorization') AS n_authorizations,
  max(amount_minor) FILTER (WHERE event_type = 'authorization') AS authorized_minor,
  CAST(coalesce(sum(amount_minor) FILTER (WHERE event_type = 'capture'), 0) AS BIGINT) AS captured_minor,
  CAST(coalesce(sum(amount_minor) FILTER (WHERE event_type = 'refund'), 0) AS BIGINT) AS refunded_minor,
  CAST(coalesce(sum(amount_minor) FILTER (WHERE event_type = 'chargeback'), 0) AS BIGINT) AS chargeback_minor,
  min(transaction_version) FILTER (WHERE event_type = 'authorization') AS first_authorization,
  min(transaction_version) FILTER (WHERE event_type = 'capture') AS first_capture,
  min(transaction_version) FILTER (WHERE event_type IN ('refund', 'chargeback')) AS first_reversal
  FROM ev GROUP BY transaction_id),
a AS (SELECT *, CASE
  WHEN n_versions < n_events THEN 'transaction_version_conflict'
  WHEN min_version <> 1 OR max_version <> n_events THEN 'transaction_version_gap'
  WHEN n_cur > 1 THEN 'currency_mutation' WHEN n_pro > 1 THEN 'processor_mutation' WHEN n_mer > 1 THEN 'merchant_mutation'
  WHEN n_authorizations > 1 THEN 'duplicate_authorization'
  WHEN n_authorizations = 0 AND captured_minor > 0 THEN 'capture_without_authorization'
  WHEN n_authorizations = 0 THEN 'missing_authorization'
  WHEN first_capture <= first_authorization THEN 'capture_before_authorization'
  WHEN captured_minor = 0 AND refunded_minor + chargeback_minor > 0 THEN 'reversal_without_capture'
  WHEN first_reversal <= first_capture THEN 'reversal_before_capture'
  WHEN captured_minor > authorized_minor THEN 'capture_exceeds_authorization'
  WHEN refunded_minor + chargeback_minor > captured_minor THEN 'refund_or_chargeback_exceeds_capture' END AS business_error FROM g),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_version DESC, event_id DESC) AS r FROM ev) WHERE r = 1),
st AS (SELECT transaction_id, max_version AS current_version, event_id AS current_event_id, CASE
  WHEN captured_minor > 0 AND chargeback_minor > 0 AND refunded_minor + chargeback_minor = captured_minor THEN 'CHARGEDBACK'
  WHEN chargeback_minor > 0 THEN 'PARTIALLY_CHARGEDBACK' WHEN captured_minor > 0 AND refunded_minor = captured_minor THEN 'REFUNDED'
  WHEN refunded_minor > 0 THEN 'PARTIALLY_REFUNDED' WHEN captured_minor = authorized_minor THEN 'CAPTURED'
  WHEN captured_minor > 0 THEN 'PARTIALLY_CAPTURED' ELSE 'AUTHORIZED' END AS status,
  authorized_minor, captured_minor, refunded_minor, chargeback_minor, currency, processor_id, merchant_id
  FROM a JOIN latest USING (transaction_id) WHERE business_error IS NULL),
ex AS (SELECT ev.*, authorized_minor, captured_minor, refunded_minor, chargeback_minor, business_error FROM ev JOIN a USING (transaction_id) WHERE business_error IS NOT NULL),
po AS (SELECT ev.* FROM ev JOIN a USING (transaction_id) WHERE business_error IS NULL AND event_type IN ('capture', 'refund', 'chargeback')),
rules(event_type, "position", account, multiplier, version) AS (VALUES """
    + ", ".join(f"('{kind}', {i}, '{account}', {times}, 1)" for kind, lines in POSTING_RULES.items() for i, (account, times) in enumerate(lines, 1))
    + """),
le AS (SELECT event_id || ':' || "position" AS entry_id, event_id, transaction_id, processor_id, merchant_id, currency, event_time, account,
  amount_minor * multiplier AS signed_minor, version AS posting_rule_version FROM po JOIN rules USING (event_type)),
ep AS (SELECT CAST(event_time AS DATE) AS business_date, processor_id, currency,
  CAST(sum(CASE event_type WHEN 'capture' THEN amount_minor ELSE -amount_minor END) AS BIGINT) AS expected_minor FROM po GROUP BY ALL),
kept AS (SELECT * FROM ep WHERE NOT (day(business_date) % 7 = 3 AND currency = 'EUR')),
evd AS (SELECT '1.0' AS schema_version, business_date, processor_id, currency, expected_minor - CASE WHEN day(business_date) % 5 = 0 AND processor_id = 'processor-02' THEN 101 ELSE 0 END AS amount_minor FROM kept
  UNION ALL SELECT DISTINCT '1.0', business_date, 'processor-99', 'INR', CAST(500 AS BIGINT) FROM kept WHERE day(business_date) = 1),
co AS (SELECT business_date, processor_id, currency, coalesce(expected_minor, 0) AS expected_minor, coalesce(amount_minor, 0) AS actual_minor,
  coalesce(expected_minor, 0) - coalesce(amount_minor, 0) AS delta_minor FROM ep FULL JOIN evd USING (business_date, processor_id, currency)),
sx AS (SELECT * FROM co WHERE delta_minor <> 0)"""
)


#: What the defects of k % 97 lead to, in the order of the contract's rules.
REASONS = (
    (1, "prohibited_fields:card_number"),
    (2, "missing_fields:merchant_id"),
    (3, "unexpected_fields:surprise"),
    (4, "unsupported_schema_version"),
    (5, "invalid_event_id"),
    (6, "invalid_processor_id"),
    (7, "unknown_source"),
    (8, "source_contract_mismatch"),
    (9, "invalid_transaction_version"),
    (10, "unsupported_event_type"),
    (11, "invalid_amount_minor"),
    (12, "unsupported_currency"),
    (13, "invalid_event_time"),
    (14, "timezone_required:received_at"),
    (15, "invalid_customer_email"),
    (16, "invalid_amount_minor"),
)

ARRIVALS = (
    EVENTS
    + """,
ar AS (SELECT CAST((k * 64 + seq) * 4 + copy AS BIGINT) AS ordinal, *, CASE WHEN copy = 2 THEN 1 ELSE 0 END AS bump,
  CASE WHEN seq = 0 THEN CASE k % 97 """
    + " ".join(f"WHEN {n} THEN '{reason}'" for n, reason in REASONS)
    + """ END END AS reason
  FROM (SELECT *, unnest(CASE WHEN seq = 0 AND k % 83 = 0 THEN [0, 1] WHEN seq = 0 AND k % 89 = 0 THEN [0, 2] ELSE [0] END) AS copy FROM full_events)),
va AS (SELECT ordinal, event_id, transaction_id, transaction_version, 'checkout-0' || (k % 5 + 1) AS source_id, processor_id, merchant_id, event_type,
  amount_minor + bump AS amount_minor, currency, event_time, event_time + to_seconds(k % 240 + 60 * copy) AS received_at, copy, custkey FROM ar WHERE reason IS NULL),
ou AS (SELECT ordinal, CASE WHEN reason IS NOT NULL THEN 'QUARANTINED' WHEN copy = 1 THEN 'DUPLICATE' WHEN copy = 2 THEN 'QUARANTINED' ELSE 'ACCEPTED' END AS outcome,
  CASE WHEN reason IS NOT NULL THEN reason WHEN copy = 1 THEN 'exact_event_replay' WHEN copy = 2 THEN 'identity_payload_conflict' ELSE 'contract_and_identity_passed' END AS reason FROM ar)"""
)


def _a(select: str) -> str:
    return f"WITH {ASSESSED}\n{select}"


def _r(select: str) -> str:
    return f"WITH {ARRIVALS}\n{select}"


FIGURES = "transaction_id, n_events, min_version, max_version, n_authorizations, authorized_minor, captured_minor, refunded_minor, chargeback_minor, first_authorization, first_capture, first_reversal, business_error"
NUMBER = "CAST(substr(transaction_id, 5) AS BIGINT)"
HALVES = f"""t AS (SELECT transaction_id, status, captured_minor FROM st WHERE {NUMBER} % 3 <> 0), s AS (SELECT transaction_id, 'NEW_' || status AS status, captured_minor FROM st WHERE {NUMBER} % 2 = 0)"""
#: HMAC-SHA256 with the sample key, whose padded inner and outer blocks are constants here.
_KEY = b"sample-key-for-registered-queries-only".ljust(64, b"\0")
_INNER, _OUTER = ("".join(f"\\x{k ^ pad:02X}" for k in _KEY) for pad in (0x36, 0x5C))
FINGERPRINTED = """'{"amount_minor":' || amount_minor || ',"currency":"' || currency || '","customer_email":"customer' || custkey % 10000 || '@example.test","event_id":"' || event_id
  || '","event_time":"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S') || '+00:00","event_type":"' || event_type || '","merchant_id":"' || merchant_id || '","processor_id":"' || processor_id
  || '","schema_version":"1.0","source_id":"' || source_id || '","transaction_id":"' || transaction_id || '","transaction_version":' || transaction_version || '}'"""

#: The arrivals' own JSON, fields in order; DEFECTS are the sample's.
_FIELDS = {
    "amount_minor": "CAST(amount_minor + bump AS VARCHAR)",
    "currency": "'\"' || currency || '\"'",
    "event_id": "'\"' || event_id || '\"'",
    "event_time": "'\"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S') || '+00:00\"'",
    "event_type": "'\"' || event_type || '\"'",
    "merchant_id": "'\"' || merchant_id || '\"'",
    "processor_id": "'\"' || processor_id || '\"'",
    "received_at": "'\"' || strftime(event_time + to_seconds(k % 240 + 60 * copy), '%Y-%m-%dT%H:%M:%S') || '+00:00\"'",
    "schema_version": "'\"1.0\"'",
    "source_id": "'\"checkout-0' || (k % 5 + 1) || '\"'",
    "transaction_id": "'\"' || transaction_id || '\"'",
    "transaction_version": "CAST(transaction_version AS VARCHAR)",
}


def _safe_field(name: str) -> str:
    """A field of an arrival's JSON after redaction, or null where it has none."""
    hidden = name in ("card_number", "customer_email")
    own = {n: "'\"<redacted>\"'" if hidden else "NULL" if value is None else f"'{value}'" for n, field, value in DEFECTS if field == name}
    plain = "'\"<redacted>\"'" if name == "customer_email" else _FIELDS.get(name, "NULL")
    cases = " ".join(f"WHEN seq = 0 AND k % 97 = {n} THEN {value}" for n, value in own.items())
    return f"""'"{name}":' || """ + (f"(CASE {cases} ELSE {plain} END)" if cases else f"({plain})")


SAFE = "'{' || concat_ws(',', " + ", ".join(map(_safe_field, sorted([*_FIELDS, "card_number", "customer_email", "surprise"]))) + ") || '}'"
CASE_NUMBER = "(ordinal // 256 + ordinal // 4 % 64 + ordinal % 4) % 10"
CDC = (
    ARRIVALS
    + f""",
env AS (SELECT ordinal, event_id, reason, CAST({CASE_NUMBER} AS BIGINT) AS n FROM ar)"""
)

SQL = {
    "payment_events_adapter": f"WITH {EVENTS}\nSELECT * FROM ev",
    "accepted_typed_projection": _r("SELECT * EXCLUDE (ordinal, copy, custkey) FROM va"),
    "contract_reason_histogram": _r("SELECT coalesce(reason, 'valid') AS reason, count(*) AS n FROM ar GROUP BY ALL"),
    "identity_outcomes": _r("SELECT ordinal, outcome, reason FROM ou"),
    "outcome_histogram": _r("SELECT outcome, reason, count(*) AS n FROM ou GROUP BY ALL UNION ALL SELECT 'ARRIVAL', 'raw_record_read', count(*) FROM ou"),
    "raw_conservation": _r("""SELECT count(*) AS arrivals, count(*) FILTER (WHERE outcome = 'ACCEPTED') AS accepted, count(*) FILTER (WHERE outcome = 'DUPLICATE') AS duplicates,
  count(*) FILTER (WHERE outcome = 'QUARANTINED') AS quarantined, count(*) = count(*) FILTER (WHERE outcome IN ('ACCEPTED', 'DUPLICATE', 'QUARANTINED')) AS conserved FROM ou"""),
    "customer_token_hmac": _r(f"""SELECT ordinal, sha256('{_OUTER}'::BLOB || unhex(sha256('{_INNER}'::BLOB || encode('customer' || custkey % 10000 || '@example.test')))) AS customer_token FROM va"""),
    "identity_fingerprint": _r(f"SELECT ordinal, sha256({FINGERPRINTED}) AS fingerprint FROM va"),
    "redacted_payloads": _r(f"""SELECT ordinal, '{{"customer_email":"<redacted>","held":[' || {SAFE} || '],'
  || CASE WHEN {CASE_NUMBER} < 5 THEN '"list":[{{"CVV":"<redacted>","deep":{{"Card_Number":"<redacted>"}}}}],' ELSE '' END || '"note":"\\"pin\\": 1"}}' AS payload FROM ar"""),
    "prohibited_key_scan": _r(f"""SELECT ordinal, CASE WHEN {CASE_NUMBER} < 5 THEN 'card_number,cvv' WHEN seq = 0 AND k % 97 = 1 THEN 'card_number' END AS prohibited FROM ar"""),
    "cdc_unwrap": f"""WITH {CDC}
SELECT ordinal, CASE n WHEN 9 THEN 'invalid_cdc_envelope' WHEN 7 THEN 'unsupported_cdc_table' WHEN 8 THEN 'non_insert_outbox_mutation' END AS unwrap_reason,
  CASE WHEN n NOT IN (7, 8, 9) THEN CASE WHEN reason = 'invalid_event_id' THEN 'bad id' ELSE event_id END END AS event_id FROM env""",
    "source_registry_expand": f"""WITH {ARRIVALS},
src AS (SELECT family || '-' || lpad(CAST(i AS VARCHAR), 2, '0') AS source_id, family, mode, contract, owner, CAST(freshness_minutes AS INTEGER) AS freshness_minutes FROM
  (SELECT *, unnest(range(1, instances + 1)) AS i FROM (VALUES {", ".join(str(x) for x in FAMILIES)}) f(family, instances, mode, contract, owner, freshness_minutes)))
SELECT src.*, coalesce(n, 0) AS n_valid FROM src LEFT JOIN (SELECT source_id, count(*) AS n FROM va GROUP BY source_id) USING (source_id)""",
    "posting_rules": _a("SELECT rules.*, coalesce(n, 0) AS n_posted FROM rules LEFT JOIN (SELECT event_type, count(*) AS n FROM po GROUP BY event_type) USING (event_type)"),
    "txn_assessment": _a(f"SELECT {FIGURES} FROM a"),
    "txn_assessment_window_form": _a(f"SELECT {FIGURES} FROM a"),
    "business_exceptions": _a("SELECT * FROM ex"),
    "payment_state_current": _a("SELECT * FROM st"),
    "payment_state_status_counts": _a("SELECT status, count(*) AS n FROM st GROUP BY status"),
    "business_error_counts": _a("SELECT business_error, count(*) AS n FROM a WHERE business_error IS NOT NULL GROUP BY business_error"),
    "touched_history": f"WITH {EVENTS}\nSELECT * FROM ev SEMI JOIN (SELECT DISTINCT transaction_id FROM ev WHERE CAST(event_time AS DATE) = DATE '1995-03-15') t USING (transaction_id)",
    "posted_events": _a("SELECT * FROM po"),
    "ledger_lines": _a("SELECT * FROM le"),
    "ledger_balance_check": _a("SELECT event_id, currency, CAST(sum(signed_minor) AS BIGINT) AS balance_minor FROM le GROUP BY ALL HAVING sum(signed_minor) <> 0"),
    "ledger_unbalanced_injected": _a(
        f"SELECT event_id, currency, CAST(sum(signed_minor) AS BIGINT) AS balance_minor FROM le WHERE NOT ({NUMBER} % 7 = 0 AND entry_id LIKE '%:2') GROUP BY ALL HAVING sum(signed_minor) <> 0"
    ),
    "account_trial_balance": _a("SELECT account, currency, CAST(sum(signed_minor) AS BIGINT) AS balance_minor, count(*) AS entry_count FROM le GROUP BY ALL"),
    "fct_ledger_daily": _a(
        "SELECT CAST(event_time AS DATE) AS business_date, processor_id, merchant_id, currency, account, count(*) AS entry_count, CAST(sum(signed_minor) AS BIGINT) AS signed_minor FROM le WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.transaction_id = le.transaction_id) GROUP BY ALL"
    ),
    "dim_payment_current": _a("SELECT *, captured_minor - refunded_minor - chargeback_minor AS net_processor_receivable_minor FROM st WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.transaction_id = st.transaction_id)"),
    "fct_settlement_exception": _a("SELECT *, 'settlement_delta' AS exception_reason FROM sx"),
    "expected_settlement": _a("SELECT * FROM ep"),
    "settlement_reconciliation": _a("SELECT * FROM co"),
    "settlement_gate_summary": _a("SELECT count(*) AS exception_count, CAST(coalesce(sum(abs(delta_minor)), 0) AS BIGINT) AS absolute_delta_minor, count(*) = 0 AS gate_open FROM sx"),
    "settlement_contract_violations": _a("""SELECT * FROM (SELECT CASE WHEN day(business_date) = 5 AND processor_id = 'processor-03' THEN '2.0' ELSE schema_version END AS schema_version, business_date, processor_id,
  CASE WHEN day(business_date) = 2 AND processor_id = 'processor-03' THEN NULL WHEN day(business_date) = 3 AND processor_id = 'processor-03' THEN 'JPY' ELSE currency END AS currency,
  CASE WHEN day(business_date) = 4 AND processor_id = 'processor-03' THEN NULL ELSE amount_minor END AS amount_minor FROM evd)
WHERE schema_version <> '1.0' OR currency IS NULL OR currency NOT IN ('INR', 'USD', 'EUR', 'GBP') OR amount_minor IS NULL"""),
    "settlement_duplicate_keys": _a("SELECT business_date, processor_id, currency, CAST(2 AS BIGINT) AS record_count FROM evd WHERE day(business_date) = 6"),
    "manifest_control_totals": _a("SELECT currency, CAST(sum(amount_minor) AS BIGINT) AS total_minor, count(*) AS record_count FROM evd GROUP BY currency"),
    "revision_registry_decision": f"""WITH {EVENTS},
days AS (SELECT DISTINCT CAST(CAST(event_time AS DATE) AS VARCHAR) AS business_date, day(event_time) AS n FROM ev),
known AS (SELECT business_date, 2 + n % 2 AS r, sha256(business_date) AS s FROM days WHERE n % 7 <> 0),
new AS (SELECT business_date, CAST(1 + n % 4 AS INTEGER) AS revision, sha256(business_date || CASE WHEN n % 5 = 0 THEN 'x' ELSE '' END) AS sha256 FROM days)
SELECT new.*, CASE WHEN r IS NULL OR r < revision THEN 'ACTIVE' WHEN r = revision AND s = sha256 THEN 'DUPLICATE' WHEN r > revision THEN 'STALE' ELSE 'CONFLICT' END AS decision
FROM new LEFT JOIN known USING (business_date)""",
    "merge_insert_only": _a(f"SELECT * FROM t UNION ALL SELECT * FROM s WHERE transaction_id NOT IN (SELECT transaction_id FROM t)").replace("\nSELECT * FROM t", f",\n{HALVES}\nSELECT * FROM t", 1),
    "merge_upsert": _a(f"SELECT * FROM s UNION ALL SELECT * FROM t WHERE transaction_id NOT IN (SELECT transaction_id FROM s)").replace("\nSELECT * FROM s", f",\n{HALVES}\nSELECT * FROM s", 1),
    "overwrite_where": _a("SELECT * FROM sx WHERE day(business_date) <> 10"),
    "audit_settlement_ranked": _a("SELECT * FROM sx WHERE business_date = DATE '1995-03-05' ORDER BY abs(delta_minor) DESC"),
    "audit_payment_trace": f"WITH {EVENTS}\nSELECT transaction_id, transaction_version, event_type, amount_minor, currency, event_time, processor_id FROM ev WHERE transaction_id = 'txn-1' ORDER BY transaction_version",
    "dq_unique": _a("SELECT entry_id, count(*) AS n FROM le GROUP BY entry_id HAVING count(*) > 1"),
    "dq_not_null": _a("SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in ("entry_id", "event_id", "transaction_id", "signed_minor")) + " FROM le"),
    "dq_accepted_values": _a(f"SELECT * FROM st WHERE status NOT IN {STATUSES}"),
    "dq_relationships": _a("SELECT * FROM le WHERE event_id NOT IN (SELECT event_id FROM ev)"),
    "dq_no_invalid_current": _a("SELECT st.*, captured_minor - refunded_minor - chargeback_minor AS net_processor_receivable_minor FROM st WHERE transaction_id IN (SELECT transaction_id FROM ex)"),
    "dq_no_zero_delta": _a("SELECT * FROM sx WHERE delta_minor = 0"),
    "freshness_lag": _r("SELECT source_id, max(event_time) AS latest_event, max(received_at) AS latest_arrival, max(CAST(epoch(received_at) - epoch(event_time) AS BIGINT)) AS longest_lag_seconds FROM va GROUP BY source_id"),
    "freshness_verdicts": f"""WITH {ARRIVALS},
src AS (SELECT family || '-' || lpad(CAST(i AS VARCHAR), 2, '0') AS source_id, CAST(freshness_minutes AS INTEGER) AS freshness_minutes FROM
  (SELECT *, unnest(range(1, instances + 1)) AS i FROM (VALUES {", ".join(str(x) for x in FAMILIES)}) f(family, instances, mode, contract, owner, freshness_minutes)) WHERE contract = 'payment_event'),
lag AS (SELECT source_id, freshness_minutes, (epoch(TIMESTAMP '1998-08-01 00:10:00') - epoch(latest)) / 60 AS m
  FROM src LEFT JOIN (SELECT source_id, max(received_at) AS latest FROM va GROUP BY source_id) USING (source_id))
SELECT source_id, CAST(floor(m) AS BIGINT) AS minutes, freshness_minutes,
  CASE WHEN m IS NULL OR m > 4 * freshness_minutes THEN 'error' WHEN m > freshness_minutes THEN 'warn' ELSE 'pass' END AS verdict FROM lag""",
    "incremental_projection": _a("""SELECT st.*, coalesce(n_lines, 0) AS n_lines, coalesce(turnover_minor, 0) AS turnover_minor FROM st
LEFT JOIN (SELECT transaction_id, count(*) AS n_lines, CAST(sum(abs(signed_minor)) AS BIGINT) AS turnover_minor FROM le GROUP BY transaction_id) USING (transaction_id)"""),
    "state_hash": _a(
        "SELECT count(*) AS n_rows, sha256(count(*) || '|' || coalesce(sum(CAST('0x' || substr(d, 1, 15) AS HUGEINT)), 0) || '|' || coalesce(sum(CAST('0x' || substr(d, 16, 15) AS HUGEINT)), 0)) AS state_sha256 FROM (SELECT md5("
        + " || ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in sorted(f.name for f in STATE.fields))
        + ") AS d FROM st)"
    ),
    "stream_identity_gate": _r("SELECT ordinal, outcome, reason FROM ou"),
    "generated_lifecycle": f"""WITH n AS (SELECT o_orderkey + 1 AS n FROM orders), b AS (SELECT n, 10000 + (n * 7919) % 490000 AS amount FROM n),
e AS (SELECT n, 1 AS v, 'authorization' AS kind, amount FROM b UNION ALL SELECT n, 2, 'capture', amount FROM b
  UNION ALL SELECT n, 3, CASE WHEN n % 5 = 0 THEN 'refund' ELSE 'chargeback' END, CASE WHEN n % 5 = 0 THEN amount // 4 ELSE amount // 5 END FROM b WHERE n % 5 = 0 OR n % 7 = 0),
x AS (SELECT *, 'txn-' || lpad(CAST(n AS VARCHAR), 10, '0') AS t, TIMESTAMP '2026-01-01' + to_seconds(10 * n + 60 * v) AS moment FROM e)
SELECT '1.0' AS schema_version, t || ':v' || v AS event_id, t AS transaction_id, CAST(v AS BIGINT) AS transaction_version, {list(EVENT_SOURCES)}[(n - 1) % {len(EVENT_SOURCES)} + 1] AS source_id,
  'processor-0' || (n % 3 + 1) AS processor_id, 'merchant-' || lpad(CAST(n % 250 AS VARCHAR), 3, '0') AS merchant_id, kind AS event_type, CAST(amount AS BIGINT) AS amount_minor,
  ['INR', 'USD', 'EUR', 'GBP'][n % 4 + 1] AS currency, strftime(moment, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS event_time,
  strftime(moment + to_seconds((17 * n + 11 * v) % 240), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS received_at, 'customer' || n % 10000 || '@example.test' AS customer_email FROM x""",
}
SQL["incremental_ledger_daily"] = SQL["fct_ledger_daily"]
SQL["stream_conservation"] = SQL["raw_conservation"]
