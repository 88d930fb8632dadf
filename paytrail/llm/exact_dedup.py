"""Exact deduplication through a log-structured merge index of text digests.

Rows arrive in batches.  A batch is a memtable: its digests are summed up (one
identifier, the smallest or the largest if asked, and the number of rows for each) and
flushed as a sorted run with a filter, a bitmap of hashed digests.  The digests of a new run
are tested against the filters of the runs there are; those that pass are looked
up in these runs, so the index knows which digests several runs hold.  Compaction merges the
runs of a level when there are FANOUT of them: only the digests that several
runs hold are shuffled and summed up, all others are copied as they are.

Rows then find their digest among those with copies, and every such row is compared with
the kept row byte by byte; digests under which texts differ are settled by the
texts themselves.  A digest with very many rows is split by a salt wherever rows meet it.

Only built-in DataFrame functions are used.

Defined results: a null text is an empty text.  Null identifiers lose against any
other; a group that has no other keeps all its rows.  Rows that repeat both
identifier and text are one document and are all kept or all dropped (drop_copies()
keeps one of them).  deduplicate() reads the identifier and the text alone; drop_copies()
gives all columns, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, ascii_lower, fresh, without

#: Digests that may be broadcast (up to 60 bytes each).
BROADCAST_HITS = 200_000
#: Batches that a table is taken in by, and runs of a level that are merged.
BATCHES = FANOUT = 4
#: Bits of a run's filter for each of its digests: about one in 16 unknown digests passes.
FILTER_BITS = 16
#: Bits of one piece of a filter, and pieces that may be broadcast.
PIECE_BITS, BROADCAST_PIECES = 32_768, 4_096
#: Rows of a digest that meet in one place; digests with more are split, of which there are at most so many.
HEAVY_ROWS, MOST_HEAVY = 1_000, 100_000


def read_once(df: DataFrame, most: int = BROADCAST_HITS) -> DataFrame:
    """df, a written table, to be broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= most else df


class DigestIndex:
    """Runs of (digest, keep_id, n), by level; level 0 is as flushed."""

    def __init__(self, spark: SparkSession, scratch: Scratch, keep: str = "smallest"):
        if keep not in ("smallest", "largest"):
            raise ValueError("keep is smallest or largest")
        self.spark, self.scratch = spark, scratch
        self.best = F.min if keep == "smallest" else F.max
        self.levels: list[list[str]] = [[]]
        self.bits: dict[str, int] = {}
        self.shared: list[DataFrame] = []  # digests that several runs hold
        self.made = 0

    def _runs(self) -> list[str]:
        return [x for level in self.levels for x in level]

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.scratch.at(name))

    def _write(self, rows: DataFrame, level: int) -> str:
        """A sorted run with its filter."""
        name, self.made = f"run{self.made}", self.made + 1
        run = self.scratch.keep(rows.sortWithinPartitions("digest"), name)
        bits = PIECE_BITS
        while bits < FILTER_BITS * run.count():
            bits *= 2
        at = F.pmod(F.xxhash64("digest"), F.lit(bits))
        pieces = run.select(F.bitmap_bucket_number(at).alias("piece"), F.bitmap_bit_position(at).alias("bit")).groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
        self.scratch.keep(pieces, f"{name}-filter")
        self.bits[name] = bits
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        return name

    def _held_before(self, run: DataFrame, older: list[str]) -> DataFrame:
        """Digests of run that older runs hold: their filters are asked, then the runs for what passes."""
        filters = reduce(DataFrame.unionByName, (self._table(f"{x}-filter").withColumn("run", F.lit(x)) for x in older))
        asked = F.explode(F.array(*(F.struct(F.lit(x).alias("run"), F.pmod(F.xxhash64("digest"), F.lit(self.bits[x])).alias("at")) for x in older)))
        asked = run.select("digest", asked.alias("q")).select("digest", "q.run", F.bitmap_bucket_number("q.at").alias("piece"), F.bitmap_bit_position("q.at").alias("bit"))
        few = F.broadcast(filters) if sum(self.bits[x] for x in older) <= PIECE_BITS * BROADCAST_PIECES else filters
        byte = F.conv(F.hex(F.substring("bitmap", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.pmod(F.floor(byte / F.pow(F.lit(2), F.col("bit") % 8)), F.lit(2)) == 1
        passed = asked.join(few, ["run", "piece"]).filter(is_set).select("digest", "run")
        holders = reduce(DataFrame.unionByName, (self._table(x).select("digest", F.lit(x).alias("run")) for x in older))
        return passed.join(holders, ["digest", "run"], "left_semi").select("digest").distinct()

    def add(self, entries: DataFrame) -> None:
        """Takes in a batch of (digest, doc_id)."""
        older = self._runs()
        name = self._write(entries.groupBy("digest").agg(self.best("doc_id").alias("keep_id"), F.count("*").alias("n")), 0)
        if older:
            found = self._held_before(self._table(name), older)
            self.shared.append(self.scratch.keep(found, f"{name}-shared"))
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= FANOUT:
                self.compact(level)

    def _merged(self, names: list[str]) -> DataFrame:
        """One row for each digest of the runs: those that several may hold are summed up, others are as they are."""
        rows = reduce(DataFrame.unionByName, map(self._table, names))
        if len(names) == 1 or not self.shared:
            return rows
        several = read_once(self.scratch.keep(reduce(DataFrame.unionByName, self.shared).distinct(), f"several{self.made}"))
        alone = rows.join(several, "digest", "left_anti")
        held = rows.join(several, "digest", "left_semi")
        return alone.unionByName(held.groupBy("digest").agg(self.best("keep_id").alias("keep_id"), F.sum("n").alias("n")))

    def compact(self, level: int = 0) -> None:
        """Merges all runs of a level, and those of the next, into one sorted run of the next level."""
        old = [*self.levels[level], *(self.levels[level + 1] if len(self.levels) > level + 1 else [])]
        if not old:
            return
        self.levels[level] = []
        if len(self.levels) > level + 1:
            self.levels[level + 1] = []
        self._write(self._merged(old), level + 1)
        self.scratch.drop(*old, *(f"{x}-filter" for x in old))

    def lookup(self) -> DataFrame:
        """(digest, keep_id, n): one row for each digest over all levels."""
        return self._merged(self._runs())


def sha256_bytes(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


class Copies:
    """Digests with copies, and how rows meet them: few by broadcast, else by shuffle, digests with many rows by salt."""

    def __init__(self, hits: DataFrame, n_rows: int):
        self.hits, self.few = hits, hits.count() <= BROADCAST_HITS
        self.most = max(HEAVY_ROWS, n_rows // MOST_HEAVY)

    def meet(self, rows: DataFrame, how: str) -> DataFrame:
        """rows (digest, doc_id, ...) joined with keep_id and n."""
        if self.few:
            return rows.join(F.broadcast(self.hits), "digest", how)
        heavy = self.hits.filter(F.col("n") > self.most).select("digest", self.parts().alias("_parts"))
        salted = rows.join(F.broadcast(heavy), "digest", "left").withColumn("_salt", self.salt(F.coalesce("_parts", F.lit(1)))).drop("_parts")
        hits = self.hits.withColumn("_salt", F.explode(F.sequence(F.lit(0), self.parts() - 1)))
        return salted.join(hits, ["digest", "_salt"], how).drop("_salt")

    def parts(self) -> Column:
        return F.ceil(F.col("n") / self.most).cast("int")

    def salt(self, parts: Column) -> Column:
        return F.pmod(F.xxhash64("doc_id", F.lit("salt")), parts).cast("int")

    def unequal(self, members: DataFrame) -> DataFrame:
        """Digests of which some row's text is not, byte by byte, that of the kept row; members is what meet() gave, with body."""
        kept = members.filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("digest", "n").agg(F.min("body").alias("kept_body"))
        kept = kept.select("digest", "kept_body", F.explode(F.sequence(F.lit(0), self.parts() - 1)).alias("_salt"))
        return members.withColumn("_salt", self.salt(self.parts())).join(kept, ["digest", "_salt"]).filter("body <> kept_body").select("digest")


def deduplicate(docs: DataFrame, keep: str = "largest", digest=sha256_bytes, batches: list[DataFrame] | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row of docs.

    docs has doc_id and text.  digest makes the index key from the normalised
    text; a weak one costs time, not correctness.  batches, if given, are parts of
    docs that are taken in one after the other, as they arrive; else a hash of the
    identifier deals the rows to BATCHES.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    body = ascii_lower(F.col("text"))
    sha = [] if digest is sha256_bytes else [F.sha2(body, 256).alias("text_sha256")]
    keyed = lambda rows, batch: rows.select("doc_id", digest(body).alias("digest"), *sha, batch.cast("int").alias("batch"))
    if batches:
        rows = reduce(DataFrame.unionByName, (keyed(part, F.lit(i)) for i, part in enumerate(batches)))
    else:
        rows = keyed(docs, F.pmod(F.xxhash64("doc_id"), F.lit(BATCHES)))
    # Texts are read for their digests once, and again for the digests with copies alone.
    entries = scratch.keep(rows, "entries")
    if digest is sha256_bytes:
        entries = entries.withColumn("text_sha256", F.lower(F.hex("digest")))
    index = DigestIndex(docs.sparkSession, scratch, keep)
    for i in range(len(batches) if batches else BATCHES):
        index.add(entries.filter(F.col("batch") == i).select("digest", "doc_id"))
    copies = Copies(scratch.keep(index.lookup().filter("n > 1"), "hits"), entries.count())
    found = copies.meet(entries, "left")
    single = F.col("n").isNull()
    keep_id = F.when(single, F.col("doc_id")).otherwise(F.col("keep_id"))
    result = found.select("doc_id", keep_id.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), F.col("doc_id").eqNullSafe(keep_id).alias("kept"), "text_sha256", "digest")
    members = scratch.keep(copies.meet(docs.select("doc_id", digest(body).alias("digest"), body.alias("body")), "inner"), "members")
    wrong = scratch.keep(copies.unequal(members), "unequal")
    scratch.drop("members")
    if not wrong.isEmpty():
        result = _settle(docs, digest, keep, result, wrong.distinct())
    return result.drop("digest")


def _settle(docs: DataFrame, digest, keep: str, result: DataFrame, wrong: DataFrame) -> DataFrame:
    """Groups the rows of colliding digests by whole text."""
    best = F.min if keep == "smallest" else F.max
    body = ascii_lower(F.col("text"))
    rows = docs.select("doc_id", digest(body).alias("digest"), body.alias("body")).join(wrong, "digest", "left_semi")
    groups = rows.groupBy("body").agg(best("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    settled = rows.join(groups, "body").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.sha2("body", 256).alias("text_sha256"), "digest"
    )
    return result.join(wrong, "digest", "left_anti").unionByName(settled)


def drop_copies(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows of docs that stay, with all their columns; of rows equal in identifier and text, one."""
    scratch = Scratch(docs.sparkSession, "drop-copies")
    verdict = scratch.keep(deduplicate(docs.select("doc_id", "text"), keep), "verdict")
    sha = F.sha2(ascii_lower(F.col("text")), 256)
    rest = without(docs, verdict.filter("not kept").select("doc_id", F.col("text_sha256").alias("key")), sha, scratch)
    ties = verdict.filter("kept and group_size > 1").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id", F.col("text_sha256").alias("key"))
    ties = scratch.keep(ties, "ties")
    if ties.isEmpty():
        return rest
    other = without(rest, ties, sha, Scratch(docs.sparkSession, "drop-copies"))
    own, tied_id, tied_sha = (fresh(c, rest.columns) for c in ("own_sha", "tied_id", "tied_sha"))
    tied = rest.withColumn(own, sha)
    tied = tied.join(ties.select(F.col("doc_id").alias(tied_id), F.col("key").alias(tied_sha)), F.col("doc_id").eqNullSafe(F.col(tied_id)) & (F.col(own) == F.col(tied_sha)), "left_semi")
    return other.unionByName(tied.dropDuplicates(["doc_id", own]).drop(own))
