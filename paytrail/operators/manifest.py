"""Settlement manifests: made from a file, checked against it, registered by revision."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.arrivals import delivery
from ..sources.control import read_json
from ..sources.files import Files
from ..sources.tables import CommitConflict
from ..vocabulary import MANIFEST
from .revisions import decide

def _whole(most: int):
    return lambda x: isinstance(x, int) and not isinstance(x, bool) and 1 <= x <= most


#: What each field of a manifest must be.
CONTROLS = {
    "version": lambda x: x == 1 and not isinstance(x, bool),
    "revision": _whole((1 << 31) - 1),
    "file_name": lambda x: isinstance(x, str) and x != "",
    "byte_size": _whole(5_000_000_000),
    "record_count": _whole((1 << 63) - 1),
    "sha256": lambda x: isinstance(x, str) and re.fullmatch(r"[0-9a-f]{64}", x) is not None,
    "raw_control_totals_minor": lambda x: isinstance(x, dict),
}
assert set(CONTROLS) == set(MANIFEST.fieldNames())


def raw_totals(lines: DataFrame) -> tuple[int, dict[str, int]]:
    """(records, total amount by currency) of JSON lines as delivered, invalid records included.

    Only whole-number amounts with a currency that is text are added up.
    """
    v = F.try_parse_json("value")
    amount = F.when(F.schema_of_variant(F.try_variant_get(v, "$.amount_minor", "variant")) == "BIGINT", F.try_variant_get(v, "$.amount_minor", "bigint"))
    currency = F.when(F.schema_of_variant(F.try_variant_get(v, "$.currency", "variant")) == "STRING", F.try_variant_get(v, "$.currency", "string"))
    got = lines.select(amount.alias("amount"), currency.alias("currency")).groupBy("currency").agg(F.count("*").alias("n"), F.sum("amount").alias("total")).collect()
    return sum(r["n"] for r in got), {r["currency"]: r["total"] for r in got if r["currency"] is not None and r["total"] is not None}


def observe(spark: SparkSession, path: str, contents: bool = True) -> dict:
    """What a manifest of the file would have to say of it; without contents, only what the bytes tell."""
    files = Files(spark)
    seen = {"file_name": path.rsplit("/", 1)[-1], "byte_size": files.size(path), "sha256": files.sha256(path)}
    if contents:
        count, totals = raw_totals(spark.read.text(path))
        seen |= {"record_count": count, "raw_control_totals_minor": totals}
    return seen


def build(spark: SparkSession, path: str, revision: int = 1) -> dict:
    return {"version": 1, "revision": revision} | observe(spark, path)


def require_same(manifest: dict, observed: dict) -> None:
    """Stops if the manifest says other than what was observed, naming every such field."""
    if other := [name for name, value in observed.items() if manifest.get(name) != value]:
        raise ValueError("manifest_differs:" + ",".join(other))


def verify(spark: SparkSession, manifest: dict, path: str) -> None:
    require_same(manifest, observe(spark, path))


def check_controls(manifest: object) -> dict:
    """The manifest, if it has exactly the fields of one, with values that can be."""
    held = manifest if isinstance(manifest, dict) else {}
    if held.keys() ^ CONTROLS.keys():
        raise ValueError("manifest_fields:" + ",".join(sorted(map(str, held.keys() ^ CONTROLS.keys()))))
    if bad := [name for name, right in CONTROLS.items() if not right(held[name])]:
        raise ValueError("manifest_values:" + ",".join(bad))
    return held


def load(spark: SparkSession, bucket: str, key: str, verified: str, store) -> dict:
    """Takes in the manifest at bucket/key: checks, copies the data, registers the revision.

    store is a TableStore with table settlement_publication.  The answer's status is
    VERIFIED, STALE_MANIFEST, DUPLICATE_MANIFEST for a revision that is reconciled, or
    RECOVERED_DUPLICATE for one that is registered but was never carried through.
    """
    place = delivery(key)
    listed = check_controls(read_json(spark, f"{bucket}/{key}"))
    require_same(listed, observe(spark, f"{bucket}/{place.data}", contents=False))
    target = f"{verified}/settlements/business_date={place.day}/revision={listed['revision']}/sha256={listed['sha256']}/data.jsonl"
    files = Files(spark)
    files.copy(f"{bucket}/{place.data}", target)
    require_same(listed, {"sha256": files.sha256(target)})
    answer = {"business_date": place.day, "revision": listed["revision"], "sha256": listed["sha256"], "verified_path": target, "record_count": listed["record_count"], "manifest": listed}
    return answer | {"status": _register(spark, store, answer)}


PUBLICATION = "business_date string, revision int, sha256 string, verified_path string, status string"


def _register(spark: SparkSession, store, answer: dict) -> str:
    new = spark.createDataFrame([(answer["business_date"], answer["revision"], answer["sha256"], answer["verified_path"], "PROCESSING")], PUBLICATION)
    known = store.read("settlement_publication") if store.has("settlement_publication") else new.limit(0)
    decision = decide(known, new).first()["decision"]
    if decision == "CONFLICT":
        raise ValueError(f"revision_has_other_content:{answer['business_date']}:{answer['revision']}")
    if decision == "ACTIVE":
        # Fails, to be tried again, if another revision is registered meanwhile.
        with store.commit(f"revision-{answer['business_date']}-{answer['revision']}-{answer['sha256'][:16]}") as change:
            if change.has("settlement_publication") and decide(change.read("settlement_publication"), new).first()["decision"] != decision:
                raise CommitConflict("another revision was registered")
            change.upsert("settlement_publication", new, ["business_date"])
        return "VERIFIED"
    if decision == "STALE":
        return "STALE_MANIFEST"
    done = known.filter((F.col("business_date") == answer["business_date"]) & (F.col("status") == "RECONCILED"))
    return "RECOVERED_DUPLICATE" if done.isEmpty() else "DUPLICATE_MANIFEST"
