"""Redaction inside the JVM, against a plain rewriting of the parsed value."""

from __future__ import annotations

import hashlib
import json
import random

from pyspark.sql import functions as F

from paytrail.functions import secrets
from paytrail.operators import contract
from paytrail.vocabulary import OPTIONAL_FIELD, PROHIBITED_FIELDS, REDACTED

from .test_payments import lines

HIDDEN = frozenset(PROHIBITED_FIELDS) | {OPTIONAL_FIELD}


def plainly(value):
    if isinstance(value, dict):
        return {k: REDACTED if k.casefold() in HIDDEN else plainly(v) for k, v in value.items()}
    return list(map(plainly, value)) if isinstance(value, list) else value


def drawn(pick, depth):
    kind = pick.random()
    if depth and kind < 0.45:
        keys = [pick.choice([*sorted(PROHIBITED_FIELDS), OPTIONAL_FIELD.upper(), "Pin", "x", "a,\"pin\":", "{", "é", "", "pin ", "tracK_data"]) for _ in range(pick.randint(0, 4))]
        return {k: drawn(pick, depth - 1) for k in keys}
    if depth and kind < 0.65:
        return [drawn(pick, depth - 1) for _ in range(pick.randint(0, 4))]
    return pick.choice(["", 'a"b', "\\", '\\"', '{"pin":1}', '","pin":[{', "]}", "é\u0001\n/", "🙂", 0, -5, 12345678901, True, False, None, "x" * 3_000, '"' * 2_000])


def test_equals_plain_rewriting(spark):
    pick = random.Random(4)
    values = [drawn(pick, 6) for _ in range(600)]
    got = {r["ordinal"]: r["out"] for r in lines(spark, *map(json.dumps, values)).select("ordinal", secrets.redacted(F.col("value")).alias("out")).collect()}
    for i, value in enumerate(values):
        assert got[i] == json.dumps(plainly(value), sort_keys=True, separators=(",", ":")), value


def test_no_python_worker_and_bounds(spark):
    deep = lambda n, inner: json.dumps({"pin": 0})[:-2] + "[" * n + inner + "]" * n + "}"
    texts = [deep(60, '"4111"'), deep(200, '"4111"'), '{"a":' + "[" * 900 + "]" * 900 + ',"pin":1}', json.dumps({"pin": ["y" * 200_000, {"z": '"' * 50_000}], "k": list(range(50_000))}), "{", None, '{"pin":1,"pin":{"a":2},"b":1,"b":2}']
    contract.last_of_repeated(lines(spark))
    frame = lines(spark, *texts).select("ordinal", secrets.redacted(F.col("value")).alias("out"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    out = [r["out"] for r in frame.orderBy("ordinal").collect()]
    own = texts[1].encode()
    assert json.loads(out[0]) == {"pin": REDACTED}
    assert json.loads(out[1]) == {"unreadable_bytes": len(own), "unreadable_sha256": hashlib.sha256(own).hexdigest()}
    assert json.loads(out[2])["pin"] == REDACTED and json.loads(out[3]) == {"pin": REDACTED, "k": list(range(50_000))}
    assert json.loads(out[4])["unreadable_bytes"] == 1 and out[5] is None
    assert json.loads(out[6]) == {"pin": REDACTED, "b": 2}
