"""Repeated passages, benchmark leaks, packing and archives."""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from paytrail.llm import decontamination, packing, suffix_dedup, warc
from paytrail.llm.common import Scratch

from .texts import DOCS, corpus, prose, words


def repeated_spans(rows, least=suffix_dedup.LEAST):
    held = [(i, words(t)) for i, t in rows]
    seen = Counter(tuple(w[j : j + least]) for _, w in held for j in range(len(w) - least + 1))
    out = []
    for i, w in held:
        cover = np.zeros(len(w) + 2, dtype=int)
        for j in range(len(w) - least + 1):
            if seen[tuple(w[j : j + least])] > 1:
                cover[j + 1 : j + least + 1] = 1
        edges = np.flatnonzero(np.diff(cover))
        out += [(i, int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return sorted(out, key=str)


@pytest.mark.parametrize("broadcast", [2_000_000, 0])
def test_spans_equal_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(suffix_dedup, "BROADCAST_ROWS", broadcast)
    rows = corpus()
    out = suffix_dedup.repeated_passages(spark.createDataFrame(rows, DOCS))
    # Rows equal in identifier and text share their spans.
    assert sorted({(r["doc_id"], r["start_word"], r["end_word"]) for r in out.collect()}, key=str) == sorted(set(repeated_spans(rows)), key=str)


def test_partners_far_from_their_neighbours_are_found(spark):
    """Passages of 51 words that two texts share, among texts that share more of either side with them, but not both."""
    rows = []
    for g in range(4):
        fresh = iter(range(10**6))
        new = lambda n, g=g, it=fresh: [f"w{g}x{next(it)}" for _ in range(n)]
        passage = new(51)
        beyond, before = new(20), new(12)
        for k in range(2):
            rows.append((1000 * g + k, " ".join(new(60) + before[6:] + passage + beyond[:8] + new(60))))
        for k in range(16):
            rows.append((1000 * g + 100 + k, " ".join(new(60) + passage[30:] + beyond + new(60))))
            rows.append((1000 * g + 200 + k, " ".join(new(60) + before + passage[:30] + new(60))))
    base = prose(200, 31, 3_000).split()
    for k in range(300):  # copies with a word of their own every 30 words
        own = list(base)
        for at in range(k % 30, 200, 30):
            own[at] = f"e{k}x{at}"
        rows.append((50_000 + k, " ".join(own)))
    for k in range(200):  # copies that end and begin anywhere
        rows.append((60_000 + k, " ".join(prose(20, 8_000 + k, 3_000).split() + base[(7 * k) % 120 : (7 * k) % 120 + 40 + k % 30] + prose(20, 9_000 + k, 3_000).split())))
    out = suffix_dedup.repeated_passages(spark.createDataFrame(rows, DOCS))
    assert sorted({(r["doc_id"], r["start_word"], r["end_word"]) for r in out.collect()}, key=str) == repeated_spans(rows)


def test_no_spans_in_nothing(spark):
    assert suffix_dedup.repeated_passages(spark.createDataFrame([], DOCS)).count() == 0
    assert suffix_dedup.repeated_passages(spark.createDataFrame([(1, None), (2, "a b"), (3, prose(300, 1))], DOCS)).count() == 0


ITEM = "item_id long, text string"


def test_leaks_are_found_and_clean_texts_left_alone(spark):
    items = [(i, prose(12 + 4 * i, 300 + i, 5_000)) for i in range(10)] + [(90, None), (91, ""), (92, "a b"), (93, prose(40, 303, 5_000))]
    rows, leaks = [], set()
    for i in range(60):
        text = prose(80, 400 + i, 5_000)
        if i % 6 == 0:
            text = f"{text} {items[i // 6][1].upper() if i % 12 else items[i // 6][1]} {prose(30, 800 + i, 5_000)}"
            leaks.add((i, i // 6))
        rows.append((i, text))
    rows += [(None, None), (70, ""), (71, "word " * 20_000)]
    docs, benchmark = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEM)
    out = decontamination.contaminated(docs, benchmark)
    assert {(r["doc_id"], r["item_id"]) for r in out.collect()} >= leaks
    assert {r["doc_id"] for r in out.collect()} == {i for i, _ in leaks}
    by_join = decontamination.contaminated(docs, benchmark, held_windows=0)
    assert sorted(map(tuple, by_join.collect())) == sorted(map(tuple, out.collect()))
    kept = decontamination.clean_documents(docs.withColumn("row", F.lit("own")), benchmark)
    assert kept.columns == ["doc_id", "text", "row"]
    assert kept.count() == len(rows) - len(leaks)


def test_new_values_must_be_consistent(spark):
    item = "A train leaves Boston at 60 mph and another leaves Denver at 70 mph. How far is Boston from Denver after 60 minutes?"
    same = "so: A train leaves Paris at 50 mph and another leaves Lyon at 80 mph. How far is Paris from Lyon after 50 minutes? yes"
    other = "A train leaves Paris at 50 mph and another leaves Lyon at 80 mph. How far is Nice from Lyon after 55 minutes?"
    docs = spark.createDataFrame([(1, same), (2, other), (3, item)], DOCS)
    out = {r["doc_id"]: r for r in decontamination.contaminated(docs, spark.createDataFrame([(1, item)], ITEM)).collect()}
    assert set(out) == {1, 3}
    assert (out[1]["new_values"], out[3]["new_values"]) == (4, 0)


def test_items_of_numbers_and_short_items_match_verbatim_copies(spark):
    items = [(1, "Compute 3 + 4 * 12 - 7 / 2 + 9 * 5"), (2, "How many cm are in 3 m"), (3, "What is 12 + 30?"), (4, "2 + 2")]
    copies = [(i, f"{prose(40, 60 + i, 5_000)} {t} {prose(30, 80 + i, 5_000)}") for i, t in items[:3]] + [(4, f"{prose(20, 64)}\n2 + 2\n{prose(20, 65)}")]
    others = [(11, "Compute 8 + 1 * 12 - 6 / 3 + 4 * 7"), (12, "How many cm are in 5 m"), (13, "What is 12 - 31?"), (14, f"so 2 + 2 is {prose(20, 66)}")]
    docs, benchmark = spark.createDataFrame(copies + others, DOCS), spark.createDataFrame(items, ITEM)
    for held in (decontamination.HELD_WINDOWS, 0):
        out = decontamination.contaminated(docs, benchmark, held_windows=held)
        assert sorted((r["doc_id"], r["item_id"]) for r in out.collect()) == [(i, i) for i, _ in items]


UNITS = set(decontamination.UNITS)
PUNCTUATION = "".join(chr(c) for c in (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)))


def template(text):
    """(plain code, code with names, value) of each token of an ASCII text."""
    out, before = [], None
    for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
        raw = m.group()
        word = raw.strip(PUNCTUATION)
        begins = before is None or before.group()[-1] in ".!?:;" or "\n" in text[before.end() - 1 : m.start()]
        before = m
        if word:
            number = any(c.isdigit() for c in word)
            plain = "<n>" if number else "<u>" if word.lower() in UNITS else word.lower()
            name = "A" <= word[0] <= "Z" and (len(word) == 1 or ord(word[1]) >= 97) and not begins and not number
            out.append((plain, "<name>" if name else plain, word.lower()))
    return out


def brute_leaks(docs, items):
    """Pairs of texts and items that share enough consistent template windows, by comparing every window with every other."""
    slot = ("<n>", "<u>", "<name>")
    found = set()
    for d, text in docs:
        t = template(text)
        for i, item in items:
            own = template(item)
            size = min(decontamination.WINDOW, len(own))
            at = defaultdict(lambda: (set(), set()))
            for a in range(len(own) - size + 1):
                for b in range(len(t) - size + 1):
                    for kind in (0, 1):
                        x, y = own[a : a + size], t[b : b + size]
                        codes = [w[kind] for w in x]
                        if codes == [w[kind] for w in y] and sum(c not in slot for c in codes) >= min(4, size) and (not kind or "<name>" in codes):
                            cover, values = at[b - a]
                            cover.update(range(a, a + size))
                            values.update((p[2], q[2]) for p, q, c in zip(x, y, codes, strict=True) if c in slot)
            for cover, values in at.values():
                olds, news = {v for v, _ in values}, {w for _, w in values}
                same = len(olds) == len(news) == len(values) or 2 * sum(v != w for v, w in values) <= len(values)
                if same and len(cover) >= min(decontamination.COVERED, np.ceil(decontamination.SHARE * len(own))):
                    found.add((d, i))
    return found


def test_leaks_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    names, places = ["Ann", "Bob", "Eve", "Joe"], ["Rome", "Oslo", "Bonn"]

    def question(k):
        a, b = rng.choice(names, 2, replace=False)
        return f"{a} walks {rng.integers(2, 99)} km from {rng.choice(places)} and meets {b} who carries {rng.integers(2, 99)} kg of apples, so topic{k} says how much {a} must pay for item{k % 3}."

    items = [(k, question(k)) for k in range(8)]
    docs = []
    for j in range(40):
        k = int(rng.integers(0, 8))
        own = [question(k), items[k][1], " ".join(items[k][1].split()[: rng.integers(6, 20)]), question(99)][j % 4]
        docs.append((j, f"Text {j} begins. {own} And some words follow it: {question(50 + j)[:40]}"))
    out = decontamination.contaminated(spark.createDataFrame(docs * 2, DOCS), spark.createDataFrame(items, ITEM)).collect()
    want = brute_leaks(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in out} == want and 10 < len(want) < 320
    assert len(out) == len(want)  # repeated rows of documents give one row


def test_empty_tables_match_nothing(spark):
    docs, items = spark.createDataFrame([(1, prose(40, 1))], DOCS), spark.createDataFrame([], ITEM)
    assert decontamination.contaminated(docs, items).count() == 0
    assert decontamination.clean_documents(docs, items).count() == 1
    assert decontamination.contaminated(docs.limit(0), spark.createDataFrame([(1, prose(40, 1))], ITEM)).count() == 0


def test_every_token_is_in_one_bin(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", bin_id int")
    out = packing.pack(docs, lengths=(64, 128, 512)).collect()
    tokens = Counter()
    bins = defaultdict(list)
    for r in out:
        tokens[r["doc_id"]] += r["n_tokens"]
        bins[r["bin_id"]].append(r)
    want = Counter()
    for i, t in rows:
        want[i] += len(words(t)) + 1
    assert tokens == want
    for own in bins.values():
        own.sort(key=lambda r: r["bin_offset"])
        used = 0
        for r in own:
            assert r["bin_offset"] == used
            used += r["n_tokens"]
        assert used == own[0]["bin_tokens"] and own[0]["bin_length"] == min(n for n in (64, 128, 512) if n >= used)
    assert sum(r["n_tokens"] for r in out) / sum(own[0]["bin_length"] for own in bins.values()) > 0.9
    pieces = sorted((r["piece"], r["start_token"]) for r in out if r["doc_id"] == 600)
    assert pieces == [(i, 512 * i) for i in range(len(pieces))]


def best_fit(sizes, lengths):
    """The same packing with lists that are searched for each piece: bin and offset of each, lengths, and the capacities opened."""
    bins, out, left = [], [], list(sizes)
    fit = lambda used: min(n for n in lengths if n >= used)
    looked, seen = len(left), None

    def cost(capacity, piece):
        room = capacity - piece
        sums = {0}
        for n in seen:
            sums |= {t + n for t in sums if t + n <= room}
        share = min(1, sum(n for n in seen if n <= room) / (sum(b["room"] for b in bins) + room)) if room else 0
        expected = piece + share * max(sums)
        return (fit(int(np.ceil(expected))) + packing.BIN_OVERHEAD) / expected

    for size in sizes:
        left.remove(size)
        open_ = [b for b in bins if b["room"] >= size]
        if open_:
            own = min(open_, key=lambda b: (b["room"], b["n"]))
        else:
            if len(left) <= looked:
                seen, looked = list(left), len(left) - max(1, len(left) // packing.RENEWALS)
            capacity = min((n for n in lengths if n >= size), key=lambda n: (cost(n, size), n))
            own = {"n": len(bins), "room": capacity, "capacity": capacity, "used": 0}
            bins.append(own)
        out.append((own["n"], own["used"]))
        own["used"] += size
        own["room"] -= size
    return out, [fit(b["used"]) for b in bins], [b["capacity"] for b in bins]


def test_pieces_go_where_they_fit_best(spark):
    """Against brute force, the choice of lengths included."""
    rng = np.random.default_rng(8)
    rows = [(i, "w " * int(n)) for i, n in enumerate(rng.integers(0, 700, 600))]
    out = packing.pack(spark.createDataFrame(rows, DOCS), lengths=(256, 512)).collect()
    shards = defaultdict(list)
    for r in out:
        shards[r["bin_id"] >> 32].append(r)
    assert len(shards) == 2
    for own in shards.values():
        own.sort(key=lambda r: (-r["n_tokens"], r["doc_id"], r["piece"]))
        want, length, opened = best_fit([r["n_tokens"] for r in own], (256, 512))
        assert set(opened) == {256, 512}
        assert [(r["bin_id"] & 0xFFFFFFFF, r["bin_offset"]) for r in own] == want
        assert all(r["bin_length"] == length[r["bin_id"] & 0xFFFFFFFF] for r in own)


def test_a_shard_keeps_all_bins_open():
    sizes = sorted((40 + i % 24 for i in range(20_000)), reverse=True) + [1]
    packer = packing.Packer((64, 128), 0, np.array(sizes))
    for size in sizes:
        number, _, full = packer.add(size)
    # The last one went where there is least room, among thousands.
    assert len(packer.held) > 5_000 and full == (packer.held[number][0] == packer.held[number][1])


def spent(sizes, lengths):
    """Cost of all bins, and how many of each length there are in the end."""
    cut = [n for s in sizes for n in [max(lengths)] * ((s - 1) // max(lengths)) + [(s - 1) % max(lengths) + 1]]
    packer = packing.Packer(lengths, 0, np.array(cut))
    for size in sorted(cut, reverse=True):
        packer.add(size)
    ends = Counter(packer.close(n)[0] for n in list(packer.held))
    return sum((n + packing.BIN_OVERHEAD) * k for n, k in ends.items()), ends


def test_several_lengths_cost_less_than_any_one():
    rng = np.random.default_rng(3)
    both = [int(n) for n in rng.integers(1_400, 1_480, 400)] + [int(n) for n in rng.integers(3_900, 4_090, 300)]
    cost, ends = spent(both, (1_500, 4_096))
    assert ends[1_500] >= 390 and ends[4_096] >= 290
    assert all(cost < 0.95 * spent(both, (n,))[0] for n in (1_500, 4_096))
    for scale in (60, 300, 1_200):  # and where one is best, it is the one that is taken
        sizes = np.clip(rng.lognormal(np.log(scale), 0.8, 4_000), 1, None).astype(int)
        assert spent(sizes, packing.LENGTHS)[0] <= 1.005 * min(spent(sizes, (n,))[0] for n in packing.LENGTHS)


def test_long_documents_make_shards_by_pieces(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_A_SHARD", 50)
    docs = spark.createDataFrame([(i, None, 640) for i in range(100)], DOCS + ", size int")  # ten pieces each
    out = packing.pack(docs, lengths=(64,), size=F.col("size"))
    assert out.count() == 1_000 and max(r["n"] for r in out.groupBy(F.shiftright("bin_id", 32)).agg(F.count("*").alias("n")).collect()) <= 60


def test_packing_nothing(spark):
    assert packing.pack(spark.createDataFrame([], DOCS)).count() == 0


PAGE = "page_id long, url string, html string"


def pages():
    big = "<p>" + "é text " * 400 + "</p>"
    rows = [(i, f"http://a.example/{i}?q=é b", f"<html>{i} {prose(100 * i, i)}</html>") for i in range(1, 8)]
    rows += [(20 + i, None, big) for i in range(12)] + [(40, "u", "small"), (41, "u", "small"), (42, "u", None), (43, "u", ""), (44, "u", "a\r\n\r\nb" * 300), (31, "again", big), (None, "v", big)]
    return rows


def test_archives_give_back_every_page(spark):
    rows = pages()
    out = sorted((tuple(r) for r in warc.round_trip(spark, spark.createDataFrame(rows, PAGE)).drop("target_uri").collect()), key=str)
    last = {}
    for i, _, html in rows:
        last[html or ""] = max(last.get(html or "", -1), -1 if i is None else i)
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        again = len(raw) >= 1000 and i != last[html or ""]
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", last[html or ""] if again else None))
    assert out == sorted(want, key=str)


def test_a_revisit_of_another_payload_is_refused(spark):
    rows = [(1, 1000, "aa", "response", "<a>", None, "u"), (2, 1000, "aa", "revisit", "<b>", "<a>", "u"), (3, 1000, "bb", "revisit", "<c>", "<a>", "u"), (4, 1000, "aa", "revisit", "<d>", "<z>", "u")]
    records = spark.createDataFrame(rows, warc.RECORD)
    good = {r["page_id"]: r["refers_to"] for r in warc.resolved(records.filter("page_id < 3")).collect()}
    assert good == {1: None, 2: 1}
    for bad in (3, 4):
        with pytest.raises(Exception, match="refers to no response"):
            warc.resolved(records.filter(F.col("page_id").isin(1, bad))).collect()


def test_a_page_that_was_crawled_again_is_a_record_of_its_own(spark):
    a, b = "A" * 1_500, "B" * 1_500
    rows = [(1, "u", a), (1, "u", b), (0, "v", a), (0, "w", b), (1, "u", "short"), (1, "u", "short"), (2, "u", b), (2, "u", b)]
    frame = spark.createDataFrame(rows, PAGE).selectExpr("*", "'own' AS digest", "1 AS payload", "'x' AS record_type", "9 AS refers_to")
    got = sorted(tuple(r) for r in warc.round_trip(spark, frame).select("page_id", "record_type", F.coalesce("refers_to", F.lit(-1))).collect())
    assert got == sorted([(1, "response", -1), (0, "revisit", 1), (0, "revisit", 2), (1, "revisit", 2), (1, "response", -1), (1, "response", -1), (2, "response", -1), (2, "response", -1)])


def test_archives_rotate_and_an_empty_table_has_none(spark, tmp_path):
    rows = warc.with_roles(spark.createDataFrame(pages(), PAGE), Scratch(spark, "test")).coalesce(1)
    listing = warc.write_archives(rows, f"file://{tmp_path}", most_bytes=2_000).collect()
    assert len(listing) > 3 and sum(r["n_records"] for r in listing) == len(pages())
    assert warc.round_trip(spark, spark.createDataFrame([], PAGE)).count() == 0


def member(**changed):
    row = {"page_id": 1, "url": "http://x/", "payload": b"abc" * 500, "record_type": "response", "refers_to": None} | changed
    return warc.record(**row)


def test_reader_takes_members_one_by_one_and_sees_damage():
    whole = b"".join(warc.gzip_member(member(page_id=i)) for i in range(5))
    read = [warc.read_record(p)["page_id"] for p in warc.members(io.BytesIO(whole))]
    assert read == list(range(5))
    assert gzip.decompress(whole).count(b"WARC/1.1") == 5
    with pytest.raises(warc.DamagedArchive, match="ends within"):
        [warc.read_record(p) for p in warc.members(io.BytesIO(whole[:-9]))]
    for bad, why in ((member().replace(b"abcabc", b"abcabd", 1), "digest"), (member()[:-4] + b"x\r\n\r\n", "Content-Length")):
        with pytest.raises(warc.DamagedArchive, match=why):
            [warc.read_record(p) for p in warc.members(io.BytesIO(warc.gzip_member(bad)))]


def test_a_highly_compressed_payload_is_read_in_pieces():
    record = warc.gzip_member(member(payload=b"\0" * 5_000_000))
    (pieces,) = [list(p) for p in warc.members(io.BytesIO(record))]
    assert max(map(len, pieces)) <= warc.PIECE


NAMES = "Alice Bob Carla Dmitri Elena Farid Greta Hugo Irina Jonas".split()
THINGS = "apples pears books stones shells coins stamps cards lamps ropes".split()
VERBS = "bought sold found lost packed counted hid moved drew washed".split()
SHORT_ITEMS = [f"{{name}} {VERBS[i]} {{n}} {THINGS[i]} and {VERBS[-i - 1]} {{m}} {THINGS[-i - 1]}" for i in range(10)]
LONG_ITEMS = [f"{{name}} {VERBS[i]} {{n}} {THINGS[i]} at the old market on the hill and then gave {{m}} of them to a friend called {{other}} who keeps {{n}} {THINGS[-i - 1]} in a box of {{k}} {{unit}} under the stairs" for i in range(10)]
FIRST = {"name": "Tom", "other": "Anna", "n": "12", "m": "3", "k": "40", "unit": "kg"}
CHANGED = {
    "numbers": {"n": "17", "m": "5", "k": "8"},
    "number words": {"n": "twenty", "m": "seven", "k": "forty-two"},
    "names": {"name": "Sam", "other": "Lucy"},
    "units": {"unit": "pounds"},
    "all": {"name": "Lucy", "other": "Sam", "n": "nineteen", "m": "6", "k": "11", "unit": "lb"},
}


@pytest.mark.parametrize("kind", list(CHANGED))
def test_recall_of_items_with_other_values(spark, kind):
    items = [(i, t.format(**FIRST)) for i, t in enumerate(SHORT_ITEMS + LONG_ITEMS)]
    docs = []
    for i, t in enumerate(SHORT_ITEMS + LONG_ITEMS):
        own = FIRST | CHANGED[kind]
        head = "" if i % 2 else prose(30, i) + ". "
        docs.append((i, f"{head}{t.format(**own)}. {prose(20, 90 + i)}"))
    docs += [(100 + i, prose(120, 300 + i)) for i in range(50)]
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEM)).collect()}
    assert len({d for d, i in got if d == i}) >= 18, sorted(set(range(20)) - {d for d, i in got if d == i})
    assert not [d for d, _ in got if d >= 100]


def test_likeness_of_shape_alone_is_no_copy(spark):
    """Sentences of the same words with inconsistent values, or with one plain word changed, aren't the item."""
    item = "Alice bought 3 apples and sold 3 pears"
    texts = ["Bob bought 5 apples and sold 4 pears", "Bob found 5 apples and sold 5 pears", "He bought apples and sold pears", "Alice bought 3 apples"]
    got = decontamination.contaminated(spark.createDataFrame(list(enumerate(texts)), DOCS), spark.createDataFrame([(1, item)], ITEM)).collect()
    assert not got
