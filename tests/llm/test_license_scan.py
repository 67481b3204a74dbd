import re

import pytest

from tests.llm.helpers import documents, odd_documents
from tripmill.llm import license_scan as ls


def brute(text):
    sentences = [re.sub(ls.NOT_IN_WORDS, " ", s.translate(str.maketrans(ls.UPPER, ls.LOWER))).strip(" ") for s in re.split(ls.ENDS, text or "")]
    numbers = [{v: ls.NUMBER[k] for k, v in ls.SENTENCES.items()}.get(s, 0) for s in sentences if s]
    found = []
    for rank, (licence, names) in enumerate(ls.RULES):
        want = [ls.NUMBER[n] for n in names]
        found += [(i, -len(want), rank, licence) for i in range(len(numbers)) if numbers[i : i + len(want)] == want]
    kept, end = [], -1
    for start, size, _, licence in sorted(found):
        if start - size > end:
            kept.append((start, -size, licence))
            end = start - size
    return kept


def expected(docs):
    return sorted((r["doc_id"], *m) for r in docs.select("doc_id", "text").collect() for m in brute(r["text"]))


def found(docs):
    return sorted(map(tuple, ls.scan(docs).collect()))


def test_documents(spark):
    docs = documents(spark, "sf0.01")
    assert found(docs) == expected(docs)
    assert len({r[3] for r in found(docs)}) >= 4


def mit(*names):
    return ". ".join(ls.SENTENCES[n].upper() for n in names) + "."


@pytest.mark.parametrize(
    ("text", "licences"),
    [
        (mit("mit-title", "mit-grant", "mit-notice", "as-is", "no-liability"), ["MIT"]),
        (mit("mit-grant", "mit-notice") + " Other words. " + mit("as-is"), ["MIT"]),
        (mit("isc-grant", "as-is") + "\n" + mit("mit-title"), ["ISC", "MIT"]),
        (mit("gpl-free-software") + " " + mit("gpl-3-terms"), ["GPL-3.0-or-later"]),
        ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
        ("!? " * 900 + "\n" + mit("mit-grant") + "\n" + "-" * 9000 + "\n" + mit("mit-notice"), ["MIT"]),
        ("It is not Licensed under CC BY-NC 4.0.", []),
        (" \n Licensed under the Apache License, Version 2.0!\n\n" * 3, ["Apache-2.0"] * 3),
    ],
)
def test_rules(spark, text, licences):
    docs = odd_documents(spark, [text])
    assert [r[3] for r in found(docs)] == licences
    assert found(docs) == expected(docs)


def test_odd_texts_nulls_repeats(spark):
    assert found(odd_documents(spark)) == []
    assert found(odd_documents(spark, [])) == []
    docs = spark.createDataFrame([(None, mit("all-rights")), (1, mit("all-rights")), (1, mit("all-rights"))], "doc_id long, text string")
    assert sorted(str(r["doc_id"]) for r in ls.scan(docs).collect()) == ["1", "1", "None"]


def test_very_long_text(spark):
    docs = odd_documents(spark, ["Released under the MIT License. Word. " * 1500])
    assert len(found(docs)) == 1500
