from collections import Counter

import pytest

from tests.llm.helpers import prose
from tierline.llm import rules


def plain(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").split("\n") if x.strip()]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeat = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeat)


def test_statistics_equal_plain_counts():
    texts = [None, "", " \n", "a b", "é|ü #x\né|ü #x\n", prose(1, 200) + "\n" + prose(1, 30), "w " * 40, prose(5, 9) * 3]
    for text in texts:
        assert rules.statistics(text)[:5] == plain(text)


@pytest.fixture(scope="module")
def corpus(documents):
    good = [prose(k, 40 + k) for k in range(300)]
    bad = [" | ".join(prose(k, 40).split()) for k in range(300, 340)]
    few = ["too short", None, "", "again and again this is the same old line here " * 9]
    return documents(good + bad + few)


def test_forest_tells_symbols_from_prose(spark, corpus):
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(0, 340, 2)] + [(1, None, 0), (None, 1, 0), (9999, 0, 0)], "doc_id long, quality int, toxic int")
    found = {r["doc_id"]: r for r in rules.assess(corpus, labels).collect()}
    assert len(found) == 344
    assert sum(found[i]["kept"] for i in range(300)) >= 297
    assert not any(found[i]["kept"] for i in range(300, 340))
    assert all(found[i]["base_failed"] and not found[i]["kept"] for i in range(340, 344))
    kept = {r["doc_id"] for r in rules.keep_good(corpus, labels).collect()}
    assert kept == {i for i, r in found.items() if r["kept"]}


def test_without_labels_the_base_rules_decide(spark, corpus, awkward):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert rules.assess(corpus, none).filter("kept = base_failed").count() == 0
    assert rules.assess(awkward, none).count() == awkward.count()
    kept = rules.keep_good(awkward, none)
    assert kept.columns == awkward.columns and 4 in {r["doc_id"] for r in kept.collect()}
    assert rules.keep_good(awkward.limit(0), none).count() == 0
