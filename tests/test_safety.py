"""Commits beside each other, unfinished files, records and manifests that fail, identities over restarts."""

from __future__ import annotations

import json
import random
import threading
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from paytrail.operators import contract, identity, manifest
from paytrail.sources import control
from paytrail.sources.tables import CommitConflict, TableStore
from paytrail.streaming import gate, identities, metrics

from .test_payments import BASE, KEY, lines


@pytest.fixture
def store(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/t")
    with store.commit("start") as change:
        change.append("a", frame(spark, 0, 1, 2))
    return store


def frame(spark, *ks, v="v"):
    return spark.createDataFrame([(k, f"{v}{k}") for k in ks], "k int, v string")


def keys(store, table="a"):
    return sorted(r["k"] for r in store.read(table).collect())


def test_of_two_overlapping_upserts_one_fails_and_can_begin_anew(spark, store):
    with pytest.raises(CommitConflict, match="a"), store.commit("slow") as slow:
        slow.upsert("a", frame(spark, 3), ["k"])
        with store.commit("fast") as fast:
            fast.upsert("a", frame(spark, 4), ["k"])
    assert keys(store) == [0, 1, 2, 4] and store.done("fast") and not store.done("slow")
    store.retried("slow", lambda change: change.upsert("a", frame(spark, 3), ["k"]))
    assert keys(store) == [0, 1, 2, 3, 4]


def test_plain_appends_never_conflict(spark, store):
    with store.commit("outer") as outer:
        outer.append("a", frame(spark, 5))
        for i in (6, 7):
            with store.commit(f"inner{i}") as inner:
                inner.append("a", frame(spark, i))
                inner.append("b", frame(spark, i))
    assert keys(store) == [0, 1, 2, 5, 6, 7] and keys(store, "b") == [6, 7]
    assert all(store.done(r) for r in ("outer", "inner6", "inner7"))


@pytest.mark.parametrize("how", ["append", "upsert", "drop"])
def test_compaction_beside_other_commits(spark, store, how):
    def other(change):
        if how == "drop":
            change.drop("a")
        else:
            getattr(change, how)("a", frame(spark, 10, 11), *([["k"]] if how == "upsert" else []))

    taken = store._current()["tables"]["a"]
    if how == "append":
        with store.commit("compaction") as change:
            change.swap("a", taken, change.read("a").repartition(1))
            change.seen.discard("a")
            store.retried("other", other)
        assert keys(store) == [0, 1, 2, 10, 11] and store.n_directories("a") == 2
        return
    with pytest.raises(CommitConflict), store.commit("compaction") as change:
        change.swap("a", taken, frame(spark, 0, 1, 2))
        store.retried("other", other)
    assert not store.has("a") if how == "drop" else keys(store) == [0, 1, 2, 10, 11]


def test_many_writers_at_once_lose_nothing(spark, store):
    def write(i):
        store.retried(f"w{i}", lambda change: change.append("a", frame(spark, 100 + i)))

    threads = [threading.Thread(target=write, args=(i,)) for i in range(6)] + [threading.Thread(target=store.compact, args=("a", 1))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert keys(store) == [0, 1, 2, *range(100, 106)]


@pytest.mark.parametrize("content", [b"", b'{"run": "torn", "added'])
def test_an_unfinished_pointer_stops_nobody(spark, store, tmp_path, content):
    (tmp_path / "t" / "_commits" / f"{1:012d}").write_bytes(content)
    assert keys(store) == [0, 1, 2] and store.has("a") and not store.done("torn")
    store.retried("after", lambda change: change.upsert("a", frame(spark, 3), ["k"]))
    store.compact("a", 1)
    assert keys(store) == [0, 1, 2, 3] and store.done("after")
    store.expire(7, now=4e9)
    assert keys(store) == [0, 1, 2, 3] and store.done("after") and not store.done("torn")
    assert not [p for p in (tmp_path / "t" / "_commits").iterdir() if p.name.endswith(".tmp")]


def test_a_note_without_its_commit_is_not_done_after_expiry(spark, store, monkeypatch):
    with monkeypatch.context() as patched:
        patched.setattr(TableStore, "_publish", lambda self, change: self._write_json(f"_runs/{__import__('uuid').uuid5(__import__('uuid').NAMESPACE_URL, 'lost')}", {"run": "lost", "commit": 1}))
        with store.commit("lost") as change:
            change.append("a", frame(spark, 9))
    store.retried("next", lambda change: change.append("a", frame(spark, 3)))
    assert not store.done("lost")
    store.expire(7, now=4e9)
    assert not store.done("lost") and keys(store) == [0, 1, 2, 3]


def stream_of(spark, tmp_path, store, at_once=1):
    stream = spark.readStream.schema(gate.ARRIVAL).option("maxFilesPerTrigger", at_once).parquet(f"file://{tmp_path}/in")
    return lambda: gate.start(stream, control.registry(spark), KEY, store, f"file://{tmp_path}/checkpoint", partition_by={}).awaitTermination()


def test_a_record_that_fails_is_set_apart_and_the_rest_taken_in(spark, tmp_path, monkeypatch):
    store = TableStore(spark, f"file://{tmp_path}/tables")
    rows = [BASE | {"event_id": f"e-{i}"} for i in range(9)] + [BASE | {"event_id": "e-3"}, BASE | {"pin": 1}]
    lines(spark, *rows).coalesce(1).write.parquet(f"file://{tmp_path}/in")
    readable = contract.readable
    poison = lambda reason: readable(reason) & F.when(F.col("event_id") == "e-5", F.raise_error(F.lit("poison")).cast("boolean")).otherwise(True)
    with monkeypatch.context() as patched:
        patched.setattr(gate.contract, "readable", poison)
        stream_of(spark, tmp_path, store)()
    dead = store.read("dead_letter").collect()
    assert [(r["ordinal"], r["tries"]) for r in dead] == [(5, gate.TRIES)] and "poison" in dead[0]["reason"]
    got = {r["ordinal"]: r["outcome"] for r in store.read("outcomes").collect()}
    assert got == {i: "ACCEPTED" for i in range(9) if i != 5} | {9: "DUPLICATE", 10: "QUARANTINED"}
    assert store.read("accepted_event").count() == 8 and store.read("quarantine").count() == 1  # a refusal is no dead letter


def test_a_crash_while_setting_apart_repeats_no_part(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/tables")
    rows = spark.createDataFrame([(i, f"v{i}") for i in range(8)], gate.ARRIVAL)
    crashed = []

    def write(part, run):
        if not part.filter("ordinal = 6").isEmpty():
            if not crashed and part.count() < 3:
                crashed.append(run)
                raise KeyboardInterrupt
            raise RuntimeError("bad record")
        with store.commit(run) as change:
            change.append("taken", part)

    with pytest.raises(KeyboardInterrupt):
        gate.set_apart(store, rows, "batch-0", write)
    gate.set_apart(store, rows, "batch-0", write)
    assert sorted(r["ordinal"] for r in store.read("taken").collect()) == [0, 1, 2, 3, 4, 5, 7]
    assert [r["ordinal"] for r in store.read("dead_letter").collect()] == [6]


def test_a_manifest_before_its_data_is_taken_in_later(spark, tmp_path):
    root, day = f"file://{tmp_path}", "2026-01-01"
    store = TableStore(spark, f"{root}/tables")
    folder = tmp_path / "in" / f"business_date={day}"
    folder.mkdir(parents=True)
    (folder / "a.jsonl").write_text('{"amount_minor":1,"currency":"INR"}\n')
    (folder / "a.manifest.json").write_text(json.dumps(manifest.build(spark, f"{root}/in/business_date={day}/a.jsonl")))
    (folder / "never.manifest.json").write_text((folder / "a.manifest.json").read_text().replace("a.jsonl", "never.jsonl"))
    (folder / "a.jsonl").rename(tmp_path / "later")
    run = lambda: gate.start_manifests(spark, f"{root}/in", f"{root}/verified", store, f"{root}/checkpoint").awaitTermination()
    run()
    name = lambda r: r["path"].rsplit("/", 1)[-1].split(".")[0]
    assert {(name(r), r["status"]) for r in store.read("manifest_outcome").collect()} == {("a", "RETRY"), ("never", "RETRY")}
    (tmp_path / "later").rename(folder / "a.jsonl")
    for _ in range(gate.TRIES):
        run()
    told = [(name(r), r["status"]) for r in store.read("manifest_outcome").collect()]
    assert told.count(("a", "VERIFIED")) == 1 and told.count(("a", "RETRY")) == 1
    assert told.count(("never", "RETRY")) == gate.TRIES - 1 and told.count(("never", "DEAD")) == 1
    assert store.read("manifest_retry").isEmpty() and store.read("dead_letter").count() == 1


def test_identities_outlive_restarts_and_batches_read_no_table_of_them(spark, tmp_path, monkeypatch):
    store = TableStore(spark, f"file://{tmp_path}/tables")
    (tmp_path / "in").mkdir()
    run = stream_of(spark, tmp_path, store)
    reads = []
    whole = TableStore._frame
    monkeypatch.setattr(TableStore, "_frame", lambda self, state, table: reads.append(table) or whole(self, state, table))
    want = {}
    progress = metrics.Progress(store)
    spark.streams.addListener(progress)
    for turn in range(3):
        rows = [BASE | {"event_id": f"e-{turn}-{i}"} for i in range(4)] + [BASE | {"event_id": "e-0-1"}, BASE | {"event_id": "e-0-2", "amount_minor": 77}, BASE | {"event_id": None}]
        more = lines(spark, *rows).withColumn("ordinal", F.col("ordinal") + 100 * turn)
        more.coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        run()
        want |= {100 * turn + i: "ACCEPTED" for i in range(4)} | {100 * turn + 4: "DUPLICATE", 100 * turn + 5: "QUARANTINED", 100 * turn + 6: "QUARANTINED"}
    assert not reads
    counted = [tuple(r)[:5] for r in store.read("batch_metrics").orderBy("batch").collect()]
    assert counted == [(0, 7, 5, 0, 2), (1, 7, 4, 1, 2), (2, 7, 4, 1, 2)] or sum(c[1] for c in counted) == 21
    assert metrics.conservation(store.read("batch_metrics")).first()["conserved"]
    assert {r["ordinal"]: r["outcome"] for r in store.read("outcomes").collect()} == want
    for _ in range(100):  # the listener is told a little later
        if store.has("stream_progress") and store.read("stream_progress").count() >= 3:
            break
        time.sleep(0.2)
    spark.streams.removeListener(progress)
    told = {r["batch"]: r for r in store.read("stream_progress").collect()}
    assert sum(r["input_rows"] for r in told.values()) == 21 and max(r["state_rows"] for r in told.values()) >= 12
    times = store.read("accepted_event").select("event_time", "received_at").distinct().collect()
    assert [tuple(map(str, t)) for t in times] == [tuple(map(str, contract.check(lines(spark, BASE), control.registry(spark), KEY).select("event_time", "received_at").first()))]


class Held:
    """State of one bucket as the state store's handle gives it, with the calls counted."""

    def __init__(self):
        self.calls, self.size, self.pages = 0, None, {}

    def getValueState(self, name, schema):
        return self

    def getMapState(self, name, key, value):
        return self

    def get(self):
        self.calls += 1
        return self.size

    def update(self, size):
        self.calls += 1
        self.size = size

    def getValue(self, key):
        self.calls += 1
        return self.pages.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.pages[key] = value


def test_a_bucket_of_identifiers_is_judged_by_few_calls_of_its_state():
    """the same as one identifier at a time; few calls for many, and one identifier reads no more with many held."""
    held, seen, draw = Held(), {}, random.Random(7)
    frame = lambda rows: pd.DataFrame([(str(r[0]), *r[1:], 0) for r in rows], columns=[*identities.THROUGH, "_bucket"])
    for batch in range(6):
        rows = [(100_000 * batch + i, "v", None, f"e-{draw.randrange(4000)}", f"f{draw.randrange(2)}", "{}") for i in range(1500)]
        draw.shuffle(rows)
        rows += [(-1 - i, "v", "invalid_json", None, None, None) for i in range(2)]
        processor = identities.FirstSeen()
        processor.init(held)
        before = held.calls
        (judged,) = processor.handleInputRows((0,), iter([frame(rows[:700]), frame(rows[700:])]), None)
        got = {int(r.ordinal): (r.outcome, r.reason) for r in judged.itertuples()}
        assert held.calls - before < 600  # for some 1,250 identifiers, of which each took two
        want = {-1: ("QUARANTINED", "invalid_json"), -2: ("QUARANTINED", "invalid_json")}
        for ordinal, _, _, name, fingerprint, _ in sorted(r for r in rows if r[3]):
            want[ordinal] = identity.ACCEPTED if name not in seen else identity.DUPLICATE if seen[name] == fingerprint else identity.CONFLICT
            seen.setdefault(name, fingerprint)
        assert got == want
    held_now = {k: v for (text,) in held.pages.values() for k, v in json.loads(text).items()}
    assert held_now == seen and len(held.pages) == held.size[0] and held.size[1] == len(seen) > 3000
    assert max(len(json.loads(text)) for (text,) in held.pages.values()) < 4 * identities.PAGE
    before = held.calls
    for name, most in (("e-new", 7), (next(iter(seen)), 2)):
        (judged,) = processor.handleInputRows((0,), iter([frame([(1, "v", None, name, "f", "{}")])]), None)
        assert len(judged) == 1 and held.calls - before <= most
        before = held.calls


def test_rows_of_one_file_are_dealt_to_all_tasks(spark, tmp_path, monkeypatch):
    """the contract isn't judged by as many tasks as there are files."""
    far = (1 << 62) + 1  # ordinals go through state whole
    lines(spark, BASE, BASE, BASE | {"pin": 1}).withColumn("ordinal", F.col("ordinal") + far).coalesce(1).write.parquet(f"file://{tmp_path}/in")
    dealt = []
    check = contract.check
    monkeypatch.setattr(gate.contract, "check", lambda rows, *more: dealt.append(rows._jdf.queryExecution().analyzed().toString()) or check(rows, *more))
    store = TableStore(spark, f"file://{tmp_path}/tables")
    stream_of(spark, tmp_path, store)()
    assert "RepartitionByExpression [ordinal" in dealt[0]
    assert {r["ordinal"]: r["outcome"] for r in store.read("outcomes").collect()} == {far: "ACCEPTED", far + 1: "DUPLICATE", far + 2: "QUARANTINED"}
