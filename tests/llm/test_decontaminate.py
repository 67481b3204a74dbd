import re
from functools import lru_cache
from operator import eq

import regex

from tests.llm.helpers import ODD_TEXTS, documents, odd_documents
from tripmill.llm import decontaminate as dc

ITEM = (
    "Alice buys 12 apples at 3.50 dollars each and gives 4 apples to Bob before she walks 2 km to the market"
    " where Alice sells the rest of them for 5 dollars each."
)


LETTER = rf"(?:(?![{dc.UNSPACED}])\p{{L}})"


@lru_cache(None)
def words(text):
    return regex.findall(rf"{LETTER}+|\p{{L}}|[0-9]+(?:[.,][0-9]+)*", text or "")


def template(raw):
    out = []
    for i, w in enumerate(raw):
        if w[0] in "0123456789":
            out.append("#")
        elif w.lower() in dc.UNITS and i and raw[i - 1][0] in "0123456789":
            out.append("%")
        else:
            out.append("@" if w[0] != w[0].lower() else w.lower())
    return out


@lru_cache(None)
def forms(text):
    """Words of a text, their templates and their lower case."""
    raw = words(text)
    return raw, template(raw), [w.lower() for w in raw]


def agrees(slots):
    return len({s[:2] for s in slots}) == len({(s[0], s[2]) for s in slots}) == len(set(slots))


def compare(doc, item):
    """Best alignment over every shift, found without windows or hashes."""
    (a, ta, la), (b, tb, lb) = forms(doc), forms(item)
    need, window, best = min(dc.RUN, len(b)), min(dc.WINDOW, len(b)), None
    for shift in range(-len(b), len(a)):
        lo, hi = max(0, -shift), min(len(b), len(a) - shift)
        # every word of a passage is equal or alike: with fewer than a passage has, there is none
        if sum(map(eq, la[shift + lo : shift + hi], lb[lo:hi])) + sum(map(eq, ta[shift + lo : shift + hi], tb[lo:hi])) < need:
            continue
        at = [shift + k if 0 <= shift + k < len(a) else None for k in range(len(b))]
        equal = [i is not None and la[i] == lb[k] for k, i in enumerate(at)]
        alike = [i is not None and ta[i] == tb[k] for k, i in enumerate(at)]
        slot = lambda k: (tb[k], lb[k], la[at[k]])

        def passage(s):
            stretch = range(s, s + need)
            if all(equal[k] for k in stretch):
                return True
            says = any(sum(tb[k] not in dc.SLOTS for k in range(j, j + dc.WINDOW)) >= dc.LITERALS for j in range(s, s + need - dc.WINDOW + 1))
            return len(b) >= dc.WINDOW and says and all(alike[k] for k in stretch) and agrees([slot(k) for k in stretch if tb[k] in dc.SLOTS])

        if not need or not any(passage(s) for s in range(len(b) - need + 1)):
            continue
        runs = [(m.start(), m.end()) for m in re.finditer("1+", "".join("01"[e or t] for e, t in zip(equal, alike)))]
        inside = [k for s, e in runs if e - s >= window for k in range(s, e)]
        changed = {slot(k) for k in inside if tb[k] in dc.SLOTS and lb[k] != la[at[k]]}
        found = (max(e - s for s, e in runs), len(inside), len(b), len(changed))
        best = max(best or found, found)
    return best


def bench(spark, *texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "item_id long, text string, doc string")


def found(docs, benchmark):
    return {tuple(r)[:2]: tuple(r)[2:] for r in dc.leaks(docs, benchmark).collect()}


VARIANTS = [
    ITEM,
    "Some words before. " + ITEM + " And after.",
    ITEM.replace("Alice", "Carol").replace("Bob", "Dan").replace("12", "30").replace("km", "miles"),
    ITEM.replace("Alice", "Carol", 1),  # one name stands for two
    ITEM.replace("Alice", "Bob"),  # two names become one
    " ".join(ITEM.split()[:12]),  # too short a run
    " ".join(ITEM.split()[:14]),
    ITEM.replace(" ", "\n,, "),
    "clean words " * 40,
]


def test_variants(spark):
    docs = odd_documents(spark, VARIANTS)
    rows = found(docs, bench(spark, ITEM))
    assert rows == {(i, 0): c for i, v in enumerate(VARIANTS) if (c := compare(v, ITEM))}
    # one edited name leaves a long run of equal words beside it
    assert {d for d, _ in rows} == {0, 1, 2, 3, 4, 6, 7}
    assert rows[0, 0][3] == 0 and rows[2, 0][3] == 4 and rows[3, 0][3] == rows[4, 0][3] == 1
    assert sorted(r["doc_id"] for r in dc.clean(docs, bench(spark, ITEM)).collect()) == [5, 8]


def test_documents_against_brute_force(spark):
    docs, benchmark = documents(spark).where("doc_id < 100"), documents(spark, table="benchmark")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = {r["item_id"]: r["text"] for r in benchmark.collect()}
    assert found(docs, benchmark) == {(d, i): c for d, t in texts.items() for i, b in items.items() if (c := compare(t, b))}


def test_all_whole_passages_are_found_and_few_others(spark):
    docs, benchmark = documents(spark, "sf0.01"), documents(spark, "sf0.01", "benchmark")
    items = [r["text"] for r in benchmark.collect()]
    planted = {r["doc_id"] for r in docs.collect() if any(i in r["text"] for i in items)}
    assert planted and {d for d, _ in found(docs, benchmark)} >= planted


def test_odd_texts_empty_tables_nulls(spark):
    assert found(odd_documents(spark), bench(spark, ITEM, None, "", "short one")) == {}
    assert found(odd_documents(spark, []), bench(spark, ITEM)) == {}
    assert found(odd_documents(spark), bench(spark).limit(0)) == {}
    docs = spark.createDataFrame([(None, ITEM), (1, ITEM), (1, ITEM), (1, "x")], "doc_id long, text string")
    assert list(found(docs, bench(spark, ITEM))) == [(1, 0)]
    assert [tuple(r) for r in dc.clean(docs, bench(spark, ITEM)).collect()] == [(1, "x")]  # by row, whatever the id
    assert dc.clean(odd_documents(spark), bench(spark, ITEM)).count() == len(ODD_TEXTS)


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_WINDOWS", 0)
    assert {d for d, _ in found(odd_documents(spark, VARIANTS), bench(spark, ITEM))} == {0, 1, 2, 3, 4, 6, 7}


def test_no_python_in_the_plan(spark):
    plan = dc.leaks(documents(spark), documents(spark, table="benchmark"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_clean_keeps_columns_of_any_name(spark):
    docs = odd_documents(spark, VARIANTS).selectExpr("doc_id", "text", "doc_id as number", "doc_id as `_row`", "doc_id as `a.b`", "lang as row", "doc_id as doc")
    kept = dc.clean(docs, bench(spark, ITEM))
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == sorted(tuple(r) for r in docs.collect() if r["doc_id"] in (5, 8))


def test_whole_texts_are_shuffled_for_nothing(spark):
    docs, benchmark = documents(spark, "sf0.01"), documents(spark, "sf0.01", "benchmark")
    plan = dc.leaks(docs, benchmark)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning(doc_text" not in plan


def test_many_hits_in_one_document(spark, monkeypatch):
    monkeypatch.setattr(dc, "MOST_HITS", 10)
    text = " ".join([ITEM] * 40)
    assert found(odd_documents(spark, [text, "clean"]), bench(spark, ITEM, ITEM, "other " + ITEM)) == {
        (0, i): compare(text, b) for i, b in enumerate([ITEM, ITEM, "other " + ITEM])
    }
