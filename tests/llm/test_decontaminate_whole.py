"""Passages wherever they stand and however they are written, against a search of all shifts."""

import pytest
import regex

from tests.llm import test_decontaminate as plain
from tests.llm.helpers import documents, odd_documents
from tests.llm.test_decontaminate import ITEM, bench, found
from tripmill.llm import decontaminate as dc

LETTER = rf"(?:(?![{dc.UNSPACED}])\p{{L}})"


def words(text):
    return regex.findall(rf"{LETTER}+|\p{{L}}|[0-9]+(?:[.,][0-9]+)*", text or "")


def agrees(slots):
    return len({s[:2] for s in slots}) == len({(s[0], s[2]) for s in slots}) == len(set(slots))


def leaks(doc, item):
    a, b = words(doc), words(item)
    ta, tb = plain.template(a), plain.template(b)
    la, lb = [w.lower() for w in a], [w.lower() for w in b]
    n = min(dc.RUN, len(b))
    for i in range(len(a) - n + 1):
        for k in range(len(b) - n + 1):
            if n and la[i : i + n] == lb[k : k + n]:
                return True
            if len(b) >= dc.WINDOW and ta[i : i + n] == (kinds := tb[k : k + n]):
                literal = [t not in dc.SLOTS for t in kinds]
                says = any(sum(literal[j : j + dc.WINDOW]) >= dc.LITERALS for j in range(n - dc.WINDOW + 1))
                if says and agrees([z for z in zip(kinds, lb[k : k + n], la[i : i + n]) if z[0] in dc.SLOTS]):
                    return True
    return False


def check(spark, texts, items):
    got = set(found(odd_documents(spark, texts), bench(spark, *items)))
    assert got == {(d, i) for d, t in enumerate(texts) for i, b in enumerate(items) if leaks(t, b)}
    return got


def test_other_case(spark):
    texts = [ITEM.upper(), ITEM.lower(), ITEM.title(), "Before it " + ITEM.swapcase() + " after", "CLEAN WORDS " * 40]
    assert check(spark, texts, [ITEM]) == {(i, 0) for i in range(4)}


def test_one_edited_value_beside_a_whole_run(spark):
    long = " ".join(f"word{chr(97 + i)}" for i in range(25))
    item = f"Tom has 7 apples and {long} then we go on with the other part where 7 pears are left over"
    texts = [
        ITEM.replace("Alice", "Carol", 1),
        item.replace("7 pears", "9 pears"),
        ITEM.replace("Alice", "Bob"),
        " ".join(ITEM.replace("Alice", "Carol", 1).split()[:13]),
    ]
    assert check(spark, texts, [ITEM, item]) >= {(0, 0), (1, 1)}


def test_every_place_in_the_document(spark):
    part = ITEM.split()
    names = "Ann Bob Cid Dan Eve Fay Gus said that this was all Hal Ian Joe Kim Lee Max".split()
    texts = ["x " * k + " ".join(p[j : j + 13]) + " y" for p in (part, names) for k in range(6) for j in range(0, len(p) - 12, 3)]
    check_all = check(spark, texts, [ITEM, " ".join(names)])
    assert {d for d, _ in check_all} == set(range(len(texts)))


def test_short_items_and_scripts_without_spaces(spark):
    items = ["What is the capital of France?", "日本で一番高い山は富士山ですか", "ประเทศไทยมีเมืองหลวงชื่ออะไร", "水は何度で沸騰する", "7"]
    texts = ["Quiz: what is the capital of FRANCE, please", "What is the capital of Spain?", *[f"前{i}後" for i in items[1:4]], "富士山は高い", "a 7.", "77"]
    assert check(spark, texts, items) == {(0, 0), (2, 1), (3, 2), (4, 3), (6, 4)}


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_documents_against_all_shifts(spark, limit, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_WINDOWS", limit)
    docs, benchmark = documents(spark).where("doc_id < 60"), documents(spark, table="benchmark")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = {r["item_id"]: r["text"] for r in benchmark.collect()}
    assert set(found(docs, benchmark)) == {(d, i) for d, t in texts.items() for i, b in items.items() if leaks(t, b)}


def test_documents_with_a_run_in_any_case(spark):
    docs, benchmark = documents(spark, "sf0.1"), documents(spark, "sf0.1", "benchmark")
    runs = lambda t: {tuple(w[i : i + dc.RUN]) for w in [[x.lower() for x in words(t)]] for i in range(len(w) - dc.RUN + 1)}
    leaked = set().union(*[runs(r["text"]) for r in benchmark.collect()])
    verbatim = {r["doc_id"] for r in docs.collect() if not leaked.isdisjoint(runs(r["text"]))}
    got = {d for d, _ in found(docs, benchmark)}
    print(len(verbatim), len(got))
    assert verbatim and verbatim <= got


def test_rows_go_whatever_their_ids(spark):
    rows = [(None, ITEM), (None, "clean words"), (1, ITEM), (1, "other clean words"), (2, ITEM), (3, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = dc.clean(docs, bench(spark, ITEM))
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in docs.collect() if r["text"] != ITEM)
