from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paytrail.llm import fill_in_middle as fim
from paytrail.llm import registry

from .texts import corpus, prose

SHA = lambda t: hashlib.sha256(t.encode()).hexdigest()


def by_slices(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) without trees."""
    text = text or ""
    h = SHA(f"1:{'' if doc_id is None else doc_id}")
    a, b, c, d = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    lo, hi = sorted((a % (n + 1), b % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or c % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:lo], text[lo:hi], text[hi:]
    if d % 100 < 20:
        return n, "spm", lo, hi - lo, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", lo, hi - lo, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_every_kind_of_text_equals_slices(spark):
    rows = corpus() + [(800 + i, t) for i, t in enumerate(["<P>", "a<S>b", "<M", "<<P", "P>", "<P" * 50, "🙂é\u0000x" * 700, "S><M"])]
    rows += [(1000 + i, f"text {i} <") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = fim.fill_in_middle(docs)
    got = sorted(((r["doc_id"], r["text"], r["n_units"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in made.collect()), key=str)
    assert got == sorted(((i, t, *by_slices(i, t)) for i, t in rows), key=str)
    assert {g[3] for g in got} == {"plain", "psm", "spm"}
    back = made.withColumn("back", fim.restored(made["output"], made["form"]))
    assert back.filter("back <> coalesce(text, '')").count() == 0


def test_query_equals_slices_on_the_smallest_sample(spark):
    sample = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sample}/documents.parquet").collect()}
    got = registry.queries()["op11_fill_in_middle"](spark, sample).collect()
    assert len(got) == len(docs)
    for r in got:
        n, form, prefix, middle, output = by_slices(r["doc_id"], docs[r["doc_id"]])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output_sha256"]) == (n, form, prefix, middle, SHA(output))
        assert r["restored_sha256"] == SHA(docs[r["doc_id"]] or "")


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=400), st.integers(0, 500), st.sampled_from(["char", "word", "line"]), st.integers(1, 9))
def test_splitting_anywhere_loses_nothing(text, rank, unit, size):
    whole = fim.build(text, unit, size)
    pieces = list(text) if unit == "char" else [m.group() for m in fim.UNITS[unit].finditer(text)]
    assert str(whole) == text == "".join(pieces) and (whole.units, whole.chars) == (len(pieces), len(text))
    a, b = fim.split(whole, rank, unit)
    assert str(a) == "".join(pieces[:rank]) and str(b) == "".join(pieces[rank:])
    assert (a.units, b.units) == (len(pieces[:rank]), len(pieces[rank:])) and (a.chars, b.chars) == (len(str(a)), len(str(b)))


def depth(node):
    return 0 if node.text is not None else 1 + max(depth(node.left), depth(node.right))


def test_trees_stay_shallow():
    whole = fim.build("x" * 5_000_000)
    assert depth(whole) == 13
    a, b = fim.split(whole, 3_333_333)
    assert depth(fim.concat(b, a)) <= 14


@pytest.mark.parametrize("unit", ["word", "line"])
def test_words_and_lines_stay_whole(spark, unit):
    rows = [(i, prose(200 + 40 * i, i)) for i in range(40)] + [(90, " \n "), (91, "one")]
    made = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), unit=unit)
    made = made.withColumn("back", fim.restored(made["output"], made["form"]))
    for r in made.collect():
        assert r["back"] == r["text"]
        if r["form"] != "plain":
            pieces = [m.group() for m in fim.UNITS[unit].finditer(r["text"])]
            ends = {0, *(sum(map(len, pieces[: i + 1])) for i in range(len(pieces)))}
            assert {r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]} <= ends and r["n_units"] == len(pieces)


def test_own_sentinels_clashing_columns_and_empty_tables(spark):
    use = fim.Format("<|pre|>", "<|suf|>", "<|mid|>", plain_percent=0, spm_percent=50)
    random.seed(3)
    docs = spark.createDataFrame([(str(i), f"a <P> b {i} " * 9, "own", 1.5) for i in range(60)], "name string, text string, form string, output double").selectExpr("*", "array(1) AS `odd``name`", "'x' AS _made", "interval 1 day AS gap")
    made = fim.fill_in_middle(docs, key="name", use=use)
    assert made.columns == ["name", "text", "odd`name", "_made", "gap", *fim.OUTPUTS]
    rows = made.withColumn("back", fim.restored(made["output"], made["form"], use)).collect()
    assert {r["form"] for r in rows} == {"psm", "spm"} and all(r["back"] == r["text"] and r["_made"] == "x" for r in rows)
    assert fim.fill_in_middle(docs.limit(0), key="name").count() == 0
    with pytest.raises(ValueError):
        fim.fill_in_middle(docs, key="name", unit="page")
