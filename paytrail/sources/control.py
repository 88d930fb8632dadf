"""Control data: the source registry, posting rules, manifests.  Small files, read and checked on the driver."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from ..operators.posting import check_rules
from ..vocabulary import FAMILIES, SOURCE_CONTRACTS, SOURCE_MODES

FAMILY_FIELDS = ("family", "instances", "mode", "contract", "owner", "freshness_minutes")
REGISTRY = "source_id string, family string, mode string, contract string, owner string, freshness_minutes int"


def read_json(spark: SparkSession, path: str) -> object:
    """A whole JSON file from any store that Spark reads."""
    return json.loads(spark.read.option("wholetext", True).text(path).first()[0])


def _whole(x: object) -> bool:
    return isinstance(x, int) and not isinstance(x, bool) and x >= 1


def expand_families(families: list[dict]) -> list[tuple]:
    """A source for each instance of each family, ``family-NN``; refuses what isn't a registry."""
    out: dict[str, tuple] = {}
    for f in families:
        if missing := sorted(set(FAMILY_FIELDS) - set(f)):
            raise ValueError("source_family_missing:" + ",".join(missing))
        if f["mode"] not in SOURCE_MODES:
            raise ValueError(f"unsupported_source_mode:{f['mode']}")
        if f["contract"] not in SOURCE_CONTRACTS:
            raise ValueError(f"unsupported_source_contract:{f['contract']}")
        if not _whole(f["instances"]):
            raise ValueError("invalid_source_instances")
        if not _whole(f["freshness_minutes"]):
            raise ValueError("invalid_freshness_minutes")
        for i in range(1, f["instances"] + 1):
            name = f"{f['family']}-{i:02d}"
            if name in out:
                raise ValueError(f"duplicate_source:{name}")
            out[name] = (name, f["family"], f["mode"], f["contract"], f["owner"], f["freshness_minutes"])
    if not out:
        raise ValueError("empty_source_registry")
    return list(out.values())


def registry(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The registry in a file, or the shipped one."""
    families = read_json(spark, path)["families"] if path else [dict(zip(FAMILY_FIELDS, x, strict=True)) for x in FAMILIES]
    return spark.createDataFrame(expand_families(families), REGISTRY)


def posting_rules(spark: SparkSession, path: str) -> tuple[dict, int]:
    """({event type: ((account, multiplier), ...)}, version) of a rule file, checked."""
    held = read_json(spark, path)
    rules = {kind: tuple((x["account"], x["multiplier"]) for x in lines) for kind, lines in held["rules"].items()}
    check_rules(rules, held.get("version"), held.get("currency_unit"))
    return rules, held["version"]
